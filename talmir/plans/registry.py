"""Every operator as a query over the given tables: name to (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talmir.functions import squared_distance, truncate_rating
from talmir.operators import clusters, kmeans, ratings, silhouette, words
from talmir.plans.inputs import LABELS, documents, label_means, points, table, whole_points
from talmir.plans.inputs import ratings as read_given_ratings
from talmir.session import new_path
from talmir.sources import (
    partition_into,
    read_labelled_points,
    read_lines,
    read_points,
    read_ratings,
    split_bad_labelled_points,
    split_bad_points,
    split_bad_ratings,
    write_result,
)

Query = Callable[[SparkSession, str], DataFrame]

T, SEED = 20, 7
TRIALS = 5


def _written(spark: SparkSession, lines: DataFrame) -> str:
    """A new text file holding the lines, one row (or more, if it has line ends) each."""
    path = new_path(spark, "lines")
    lines.write.text(path)
    return path


def _by_dimension(df: DataFrame, array: str, *keys: str) -> DataFrame:
    """One row per coordinate, so that arrays compare as plain numbers."""
    return df.select(*keys, F.posexplode(array).alias("dim", "x"))


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _lines(spark, folder):
    path = _written(spark, documents(spark, folder).select("text"))
    return read_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


def _ratings_from_text(spark, folder):
    given = read_given_ratings(spark, folder)
    lines = given.select(F.concat_ws(",", "product", "user", "rating", "ts"))
    return read_ratings(spark, _written(spark, lines))


def _texts(point: str = "embedding") -> Column:
    return F.col(point).cast("array<string>")


def _labelled_points_from_text(spark, folder):
    given = table(spark, folder, "embeddings")
    lines = given.select(F.concat_ws(",", _texts(), F.col("label").cast("string")))
    return _by_dimension(read_labelled_points(spark, _written(spark, lines)), "point", "cluster")


def _points_from_text(spark, folder):
    lines = table(spark, folder, "embeddings").select(F.concat_ws("  ", _texts()))
    return _by_dimension(read_points(spark, _written(spark, lines)), "point")


def _partitions(spark, folder):
    parts = partition_into(table(spark, folder, "orders").select("o_orderkey"), 8)
    numbered = parts.select(F.spark_partition_id().alias("part"))
    return numbered.agg(
        F.count_distinct("part").alias("n_partitions"), F.count("*").alias("n_rows")
    )


def _last_reviews(spark, folder):
    reviews = table(spark, folder, "events").select(
        F.col("ts").cast("date").cast("string").alias("doc"),
        F.col("user_id").alias("user"),
        F.col("event_type").alias("product"),
        F.col("value").alias("rating"),
        F.struct("ts", "event_id").alias("position"),
    )
    return ratings.last_review_per_document(reviews)


def _top(spark, folder):
    return _rounded(ratings.top_products(read_given_ratings(spark, folder), 10), 6, "max_norm")


def _write_and_read(spark, folder):
    path = new_path(spark, "top-products")
    write_result(_top(spark, folder), path)
    return spark.read.parquet(path)


def _truncated_sums(spark, folder):
    whole = truncate_rating(F.col("value"))
    return table(spark, folder, "events").groupBy("event_type").agg(F.sum(whole).alias("total"))


def _reviews_as_text(df: DataFrame) -> DataFrame:
    texts = F.transform(
        "reviews", lambda r: F.concat_ws(":", r["product"], r["rating"], r["copies"])
    )
    return df.withColumn("reviews", F.array_join(texts, ","))


def _reviews_by_user(spark, folder):
    return _reviews_as_text(ratings.reviews_by_user(read_given_ratings(spark, folder), 1))


def _reviews_by_user_parts(spark, folder):
    given = read_given_ratings(spark, folder)
    return _reviews_as_text(ratings.reviews_by_user(given, 3))


def _review_pages(spark, folder):
    return _reviews_as_text(ratings.review_pages(read_given_ratings(spark, folder), 10))


def _user_totals(spark, folder):
    return ratings.user_totals(read_given_ratings(spark, folder))


def _norms(spark, folder):
    return _rounded(ratings.normalize_ratings(read_given_ratings(spark, folder)), 6, "norm")


def _norms_hot_users(spark, folder):
    # Small enough a limit that every user is spread over several join partitions.
    given = read_given_ratings(spark, folder)
    return _rounded(ratings.normalize_ratings(given, hot_rows=8), 6, "norm")


def _max_norms(spark, folder):
    given = read_given_ratings(spark, folder)
    return _rounded(ratings.max_normalized_rating(given), 6, "max_norm")


def _preview(spark, folder):
    rows = read_given_ratings(spark, folder).select("product", "user", "rating")
    return ratings.preview(rows, 7)


def _distance_to_own_mean(spark, folder):
    given = points(spark, folder)
    centres = label_means(given).withColumnRenamed("cid", "cluster")
    joined = given.join(F.broadcast(centres), "cluster")
    d = squared_distance(F.col("point"), F.col("centre"))
    return joined.select("vec_id", "cluster", F.round(d, 6).alias("d"))


def _sample(given: DataFrame, t=T, seed=SEED) -> DataFrame:
    return clusters.sample_clusters(given, t, seed, LABELS, "vec_id")


def _sample_rows(spark, folder):
    return _sample(points(spark, folder)).select("vec_id", "cluster")


def _sample_sizes(spark, folder):
    return clusters.sample_sizes(_sample(points(spark, folder)))


def _silhouette_points(spark, folder):
    given = points(spark, folder)
    scored = silhouette.silhouette_points(given, _sample(given), T, LABELS)
    return _rounded(scored.select("vec_id", "cluster", "a", "b", "s"), 6, "a", "b", "s")


def _silhouette_undrawn(spark, folder):
    # With t = 1 many clusters have no sampled point, or just the one that is scored.
    given = points(spark, folder)
    scored = None
    for seed in range(3):
        sample = _sample(given, 1, seed)
        part = silhouette.silhouette_points(given, sample, 1, LABELS)
        part = part.select(F.lit(seed).alias("seed"), "vec_id", F.round("s", 6).alias("s"))
        scored = part if scored is None else scored.unionByName(part)
    return scored


def _approx_silhouette(spark, folder):
    result = silhouette.approx_silhouette(points(spark, folder), T, LABELS, SEED, "vec_id")
    return _rounded(result, 5, "silhouette")


def _exact_sample_silhouette(spark, folder):
    result = silhouette.exact_sample_silhouette(points(spark, folder), T, LABELS, SEED, "vec_id")
    return _rounded(result, 5, "silhouette")


def _trials(spark, folder):
    result = silhouette.silhouette_trials(points(spark, folder), T, LABELS, TRIALS, "vec_id")
    return _rounded(result, 5, "approx", "exact")


def _repeated(spark, folder):
    result = silhouette.repeated_silhouette(points(spark, folder), T, LABELS, TRIALS, "vec_id")
    return _rounded(result, 5, "approx", "exact")


def _kmeans_random(spark, folder):
    """Whatever the start, each centre ends as the mean of the points nearest to it."""
    given = points(spark, folder).select("point")
    centres = kmeans.kmeans(given, 4, 200, 1)
    assigned = clusters.assign_clusters(given, centres)
    means = label_means(assigned).withColumnRenamed("centre", "mean")
    counts = clusters.cluster_sizes(assigned).withColumnRenamed("cluster", "cid")
    both = centres.join(means, "cid").join(counts, "cid")
    shift = squared_distance(F.col("centre"), F.col("mean"))
    return both.agg(
        F.count("*").alias("n_centres"),
        F.sum("n").alias("n_points"),
        F.round(F.max(shift), 3).alias("shift"),
    )


def _lloyd(spark, folder):
    centres = kmeans.lloyd_kmeans(points(spark, folder), 4, 2, 1, "vec_id")
    return _rounded(_by_dimension(centres, "centre", "cid"), 6, "x")


def _assigned(spark, folder):
    given = points(spark, folder)
    assigned = clusters.assign_clusters(given, label_means(given))
    return assigned.select("vec_id", "cluster")


def _k_sweep(spark, folder):
    result = kmeans.k_sweep(points(spark, folder), 2, 3, 2, 50, 1, "vec_id")
    return _rounded(result, 5, "silhouette")


def _k_sweep_random(spark, folder):
    result = kmeans.k_sweep(points(spark, folder), 2, 2, 5, 50, 1, "vec_id", random_start=True)
    return result.select("k", "n", F.col("silhouette").between(-1, 1).alias("in_range"))


def _sample_rows_no_id(spark, folder):
    sample = clusters.sample_clusters(whole_points(spark, folder), T, SEED, LABELS)
    text = F.concat_ws(",", F.col("point").cast("array<bigint>").cast("array<string>"))
    return sample.groupBy(text.alias("p"), "cluster").agg(F.count("*").alias("n"))


def _approx_silhouette_no_id(spark, folder):
    result = silhouette.approx_silhouette(whole_points(spark, folder), T, LABELS, SEED)
    return _rounded(result, 5, "silhouette")


def _last_reviews_from_text(spark, folder):
    """The events of a day as one document of rating lines, in their order."""
    line = F.concat_ws(",", "event_type", "user_id", "value", F.unix_seconds(F.col("ts").cast("timestamp")))
    placed = F.array_sort(F.collect_list(F.struct("ts", "event_id", line.alias("line"))))
    days = table(spark, folder, "events").groupBy(F.col("ts").cast("date").cast("string").alias("doc"))
    docs = days.agg(F.array_join(F.transform(placed, lambda x: x["line"]), "\n").alias("text"))
    last = ratings.last_review_per_document(ratings.split_reviews(docs))
    return last.withColumn("user", F.col("user").cast("bigint"))


def _rejected_ratings(spark, folder):
    """Every tenth product's ratings are no numbers."""
    given = read_given_ratings(spark, folder)
    rating = F.when(F.col("product") % 10 == 0, F.lit("none")).otherwise(F.col("rating").cast("string"))
    lines = given.select(F.concat_ws(",", "product", "user", rating, "ts").alias("value"))
    _, bad = split_bad_ratings(lines)
    return bad.groupBy("value").agg(F.count("*").alias("n"))


def _bad_rows(good: DataFrame, bad: DataFrame) -> DataFrame:
    """How often each rejected line and each accepted point (its label too) stands there."""
    names = F.concat_ws(",", F.array_join(F.col("point").cast("array<string>"), ","), *[c for c in good.columns if c != "point"])
    accepted = good.select(F.lit(True).alias("accepted"), names.alias("line"))
    rejected = bad.select(F.lit(False).alias("accepted"), F.col("value").alias("line"))
    return accepted.unionByName(rejected).groupBy("accepted", "line").agg(F.count("*").alias("n"))


def _rejected_labelled_points(spark, folder):
    """The label is no number where the first coordinate is a multiple of three."""
    given = whole_points(spark, folder).select("cluster", F.transform("point", lambda x: x.cast("bigint")).alias("p"))
    label = F.when(F.get("p", F.lit(0)) % 3 == 0, F.lit("none")).otherwise(F.col("cluster").cast("string"))
    lines = given.select(F.concat_ws(",", F.col("p").cast("array<string>"), label).alias("value"))
    good, bad = split_bad_labelled_points(lines, once=True)
    return _bad_rows(good.withColumn("point", F.col("point").cast("array<bigint>")), bad)


def _rejected_points(spark, folder):
    """A last coordinate is no number where the first is a multiple of three."""
    given = whole_points(spark, folder).select(F.transform("point", lambda x: x.cast("bigint")).alias("p"))
    last = F.when(F.get("p", F.lit(0)) % 3 == 0, F.lit("nan")).otherwise(F.lit(""))
    lines = given.select(F.concat_ws(" ", F.col("p").cast("array<string>"), last).alias("value"))
    good, bad = split_bad_points(lines, once=True)
    return _bad_rows(good.select(F.col("point").cast("array<bigint>")), bad)


def _assign_blocks(spark, folder):
    """As assign_clusters, with so small a limit that the centres are taken in blocks of three."""
    given = points(spark, folder)
    return clusters.assign_clusters(given, label_means(given), model_numbers=200).select("vec_id", "cluster")


def _sample_in_one_pass(spark, folder):
    sample = clusters.sample_in_one_pass(points(spark, folder), T, SEED, "vec_id")
    return sample.select("vec_id", "cluster")


def _norms_missing(spark, folder):
    """Every fourth rating is missing."""
    given = read_given_ratings(spark, folder)
    some = given.withColumn("rating", F.when(F.col("rating") % 4 != 0, F.col("rating")))
    return _rounded(ratings.normalize_ratings(some), 6, "norm")


def _on_documents(operator, *arguments) -> Query:
    return lambda spark, folder: operator(documents(spark, folder), *arguments)


QUERIES: dict[str, Query] = {
    "read_lines": _lines,
    "read_ratings": _ratings_from_text,
    "read_labelled_points": _labelled_points_from_text,
    "read_points": _points_from_text,
    "partition_into": _partitions,
    "last_review_per_document": _last_reviews,
    "write_result": _write_and_read,
    "doc_word_count": _on_documents(words.doc_word_count),
    "word_count": _on_documents(words.word_count),
    "word_count_salted": _on_documents(words.word_count_salted, 8),
    "word_count_salted_groupby": _on_documents(words.word_count_salted_groupby, 8),
    "word_count_by_partition": _on_documents(words.word_count_by_partition),
    "num_documents": _on_documents(words.num_documents),
    "num_distinct_words": _on_documents(words.num_distinct_words),
    "avg_distinct_word_length": _on_documents(words.avg_distinct_word_length),
    "truncated_rating_sum": _truncated_sums,
    "reviews_by_user": _reviews_by_user,
    "reviews_by_user_parts": _reviews_by_user_parts,
    "user_totals": _user_totals,
    "normalize_ratings": _norms,
    "normalize_ratings_hot_users": _norms_hot_users,
    "max_normalized_rating": _max_norms,
    "top_products": _top,
    "preview": _preview,
    "pairwise_squared_distance": _distance_to_own_mean,
    "cluster_sizes": lambda spark, folder: clusters.cluster_sizes(points(spark, folder)),
    "sample_clusters": _sample_rows,
    "sample_sizes": _sample_sizes,
    "silhouette_points": _silhouette_points,
    "silhouette_undrawn": _silhouette_undrawn,
    "approx_silhouette": _approx_silhouette,
    "exact_sample_silhouette": _exact_sample_silhouette,
    "silhouette_trials": _trials,
    "repeated_silhouette": _repeated,
    "kmeans_random": _kmeans_random,
    "lloyd_kmeans": _lloyd,
    "assign_clusters": _assigned,
    "k_sweep": _k_sweep,
    "k_sweep_random": _k_sweep_random,
    "sample_clusters_no_id": _sample_rows_no_id,
    "approx_silhouette_no_id": _approx_silhouette_no_id,
    "last_review_per_document_from_text": _last_reviews_from_text,
    "rejected_ratings": _rejected_ratings,
    "normalize_ratings_missing": _norms_missing,
    "review_pages": _review_pages,
    "rejected_labelled_points": _rejected_labelled_points,
    "rejected_points": _rejected_points,
    "assign_clusters_in_blocks": _assign_blocks,
    "sample_in_one_pass": _sample_in_one_pass,
}
