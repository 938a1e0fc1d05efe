"""Product ratings, normalized by the mean rating of the user who gave them.

Input columns: ``product``, ``user``, ``rating``. Ratings count by their whole part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talmir.functions import truncate_rating, unit_draw
from talmir.operators.joins import HOT_ROWS, join_back
from talmir.session import cut_lineage
from talmir.sources.text import parse_ratings

# Ranges for each shuffle partition that reviews are cut into before they are paged.
RANGES = 4


def split_reviews(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents of several rating lines to one row per review, with its ``position``."""
    kept = [c for c in docs.columns if c != text]
    lines = docs.select(*kept, F.posexplode(F.split(text, "\n", -1)).alias("position", "value"))
    return parse_ratings(lines)


def last_review_per_document(
    reviews: DataFrame, doc: str = "doc", position: str = "position"
) -> DataFrame:
    """(doc, user, product, rating): in each document, a user's later review wins."""
    last = F.max_by(F.struct("product", "rating"), position).alias("last")
    return reviews.groupBy(doc, "user").agg(last).select(doc, "user", "last.*")


def _totals(ratings: DataFrame) -> DataFrame:
    """(user, total, n, _rated). Combined on the map side, so no user's rows meet in one task."""
    whole = truncate_rating(F.col("rating"))
    return ratings.groupBy("user").agg(
        F.sum(whole).alias("total"), F.count("*").alias("n"), F.count("rating").alias("_rated")
    )


def _with_totals(ratings: DataFrame, hot_rows: int) -> DataFrame:
    rows = ratings.select("user", "product", "rating")
    return join_back(rows, _totals(ratings), "user", hot_rows=hot_rows)


def user_totals(ratings: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(user, product, total, n, rating): every review with its user's sum and count.

    A review without a rating counts in n, and adds nothing to the total.
    """
    return _with_totals(ratings, hot_rows).select("user", "product", "total", "n", "rating")


def normalize_ratings(ratings: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(product, norm): one row per review, its rating less the mean of its user's.

    The mean is over the ratings that are there; a review without one has norm NULL.
    """
    mean = F.try_divide(F.col("total").cast("double"), F.col("_rated"))
    norm = truncate_rating(F.col("rating")) - mean
    return _with_totals(ratings, hot_rows).select("product", norm.alias("norm"))


def max_normalized_rating(ratings: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(product, max_norm)."""
    norms = normalize_ratings(ratings, hot_rows)
    return norms.groupBy("product").agg(F.max("norm").alias("max_norm"))


def top_products(ratings: DataFrame, t: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The t products with the highest max_norm; ties go by product, ascending."""
    best = max_normalized_rating(ratings, hot_rows)
    return best.orderBy(F.desc("max_norm"), F.asc("product")).limit(max(t, 0))


def preview(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first n rows in the order of the given columns (all of them by default)."""
    return df.orderBy(*(keys or df.columns)).limit(max(n, 0))


def reviews_by_user(ratings: DataFrame, parts: int) -> DataFrame:
    """(user, part, n_reviews, reviews): each user's reviews as (product, rating, copies).

    ``parts`` is the caller's choice and holds for every user alike: with 1, a user has one row,
    which must hold all that is different among their reviews. With more, a hash of the review
    says which of a user's rows it is in. Equal reviews are counted on the map side before
    anything is collected.
    """
    if parts < 1:
        raise ValueError(f"there must be at least 1 part, got {parts}")
    bag = ratings.groupBy("user", "product", "rating").agg(F.count("*").alias("copies"))
    part = F.floor(unit_draw(0, F.col("product"), F.col("rating")) * parts).cast("int")
    grouped = bag.withColumn("part", part).groupBy("user", "part")
    return grouped.agg(
        F.sum("copies").alias("n_reviews"),
        F.array_sort(F.collect_list(F.struct("product", "rating", "copies"))).alias("reviews"),
    )


def review_pages(ratings: DataFrame, page_size: int) -> DataFrame:
    """(user, page, n_reviews, reviews): each user's different reviews in the order of (product,
    rating), NULLs first, as pages of ``page_size`` of (product, rating, copies).

    The pages of a user, in order, are the one row that :func:`reviews_by_user` has for them with
    one part, but no row holds more than a page, whatever a user has. Ranks are found without
    bringing a user into one task: reviews are cut into ranges of (user, product, rating), so a
    user with very many lies in many ranges. A review's rank is its place among the user's in its
    range, plus their numbers in the ranges before. Equal reviews are counted on the map side.
    """
    if page_size < 1:
        raise ValueError(f"a page must hold at least 1 review, got {page_size}")
    spark = ratings.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["user", "product", "rating"]
    bag = ratings.groupBy(*keys).agg(F.count("*").alias("copies"))
    # Stored, as ranges are drawn from samples, which a lost task might draw differently.
    ranged = cut_lineage(
        bag.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id())
    )
    sizes = ranged.groupBy("user", "_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("user").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("user").alias("_user"),
        F.col("_range").alias("_own_range"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
    )
    place = F.row_number().over(Window.partitionBy("user", "_range").orderBy("product", "rating"))
    same = F.col("user").eqNullSafe(F.col("_user")) & (F.col("_range") == F.col("_own_range"))
    ranked = ranged.withColumn("_place", place).join(starts, same)
    rank = F.col("_start") + F.col("_place") - 1
    review = F.struct("product", "rating", "copies")
    pages = ranked.withColumn("_rank", rank).groupBy(
        "user", F.floor(F.col("_rank") / page_size).cast("bigint").alias("page")
    )
    listed = F.array_sort(F.collect_list(F.struct("_rank", review.alias("review"))))
    return pages.agg(
        F.sum("copies").alias("n_reviews"), F.transform(listed, lambda x: x["review"]).alias("reviews")
    )
