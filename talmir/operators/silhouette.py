"""Silhouette of a clustering, against a sample of each cluster.

For a point p and a cluster i of n_i points, m_i is the sum of squared distances from p to
the sampled points of i, over min(t, n_i): the expected size of the sample, not the drawn
one, and p itself counts. With a = m of its own cluster and b = the least m of another, the
coefficient is (b - a) / max(a, b), or 0 where both are 0.

The distances never become pairs: count, mean and scatter of each cluster's sample are
enough. They are one row per cluster. Each function that scores points computes them when
it is called; the scores themselves are as lazy as any DataFrame.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talmir.functions import unit_draw
from talmir.operators.clusters import (
    check_k,
    check_labels,
    check_model,
    check_t,
    cluster_sizes,
    identified,
    identity_texts,
    sample_given_sizes,
    settled_sizes,
    with_sizes,
)
from talmir.operators.kernels import SCORES, ClusterStatistics, mean_distances, score_sums
from talmir.session import cut_lineage


def _summaries(sample: DataFrame, *keys: str) -> DataFrame:
    """(keys, ns, mean, scatter): summed-up squared deviations from the mean, and so on."""
    metrics = Summarizer.metrics("count", "mean", "variance")
    summary = metrics.summary(array_to_vector(F.col("point")))
    grouped = sample.groupBy(*keys).agg(summary.alias("summary"))
    variance = F.aggregate(
        vector_to_array("summary.variance"), F.lit(0.0), lambda total, x: total + x
    )
    ns = F.col("summary.count")
    return grouped.select(
        *keys,
        ns.alias("ns"),
        vector_to_array("summary.mean").alias("mean"),
        (variance * (ns - 1)).alias("scatter"),
    )


def _statistics(sizes: DataFrame, sample: DataFrame, t: float, *keys: str) -> DataFrame:
    # A cluster that nothing was drawn from stays, with ns = 0.
    joined = sizes.join(_summaries(sample, *keys), list(keys), "left")
    return joined.select(
        *keys,
        "n",
        F.coalesce("ns", F.lit(0)).alias("ns"),
        "mean",
        F.coalesce("scatter", F.lit(0.0)).alias("scatter"),
        F.least(F.lit(float(t)), F.col("n").cast("double")).alias("denominator"),
    )


def cluster_statistics(points: DataFrame, sample: DataFrame, t: float, k: int) -> DataFrame:
    """(cluster, n, ns, mean, scatter, denominator), one row per cluster that has points."""
    check_k(k, least=2)
    check_t(t)
    return _statistics(cluster_sizes(check_labels(points, k)), sample, t, "cluster")


def collected(statistics: DataFrame, *keys: str) -> dict[tuple, ClusterStatistics]:
    """The statistics, by the values of the keys. They are a model: a few rows per cluster."""
    groups: dict[tuple, list] = {}
    for row in statistics.collect():
        groups.setdefault(tuple(row[key] for key in keys), []).append(row)
    found = {key: ClusterStatistics(rows) for key, rows in groups.items()}
    rows = sum(len(s.clusters) for s in found.values())
    check_model(rows, max([1, *[s.dimensions or 1 for s in found.values()]]))
    return found


def _sampled(
    points: DataFrame, t: float, k: int, seed: int, id_column: str | None
) -> tuple[DataFrame, DataFrame]:
    """A stored sample, and the statistics of the clusters against it: two passes."""
    check_k(k, least=2)
    check_t(t)
    sizes = settled_sizes(points, k)
    sample = sample_given_sizes(points, sizes, t, seed, k, id_column)
    sample = cut_lineage(sample.select("point", "cluster"))
    return sample, _statistics(sizes, sample, t, "cluster")


def _coefficient(a: Column, b: Column) -> Column:
    """NULL where there is no other cluster."""
    larger = F.greatest(a, b)
    s = F.when(larger == 0, F.lit(0.0)).otherwise((b - a) / larger)
    return F.when(b != float("inf"), s)


def score_points(points: DataFrame, statistics: DataFrame) -> DataFrame:
    """The points with a, b and s, from :func:`cluster_statistics`; one pass, no shuffle."""
    model = collected(statistics).get((), ClusterStatistics([]))
    model = points.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in points.columns if c not in ("a", "b", "s")]
    m = mean_distances(model)(F.col("point"), F.col("cluster"))
    a, b = F.col("_m")["own"], F.col("_m")["other"]
    return points.select(*columns, m.alias("_m")).select(
        *columns,
        a.alias("a"),
        F.when(b != float("inf"), b).alias("b"),
        _coefficient(a, b).alias("s"),
    )


def silhouette_points(points: DataFrame, sample: DataFrame, t: float, k: int) -> DataFrame:
    """Every point with a, b and its coefficient s against the sample."""
    return score_points(points, cluster_statistics(points, sample, t, k))


def summed_scores(parts: DataFrame) -> DataFrame:
    """(key, n, mean) from the SCORES of all partitions."""
    grouped = parts.groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("scored").alias("scored"), F.sum("total").alias("total")
    )
    return grouped.select("key", "n", F.try_divide("total", "scored").alias("mean"))


def _mean_score(points: DataFrame, statistics: DataFrame) -> DataFrame:
    model = {0: collected(statistics).get((), ClusterStatistics([]))}
    model = points.sparkSession.sparkContext.broadcast(model)
    parts = points.select("point", "cluster").mapInArrow(score_sums(model), SCORES)
    total = parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.try_divide(F.sum("total"), F.sum("scored")).alias("silhouette"),
    )
    return total


def approx_silhouette(
    points: DataFrame, t: float, k: int, seed: int, id_column: str | None = None
) -> DataFrame:
    """One row (n, silhouette): mean over all points against a sample of them."""
    _, statistics = _sampled(points, t, k, seed, id_column)
    return _mean_score(points, statistics)


def exact_sample_silhouette(
    points: DataFrame, t: float, k: int, seed: int, id_column: str | None = None
) -> DataFrame:
    """One row (n, silhouette): mean over the sampled points only, same denominators."""
    sample, statistics = _sampled(points, t, k, seed, id_column)
    return _mean_score(sample, statistics)


def silhouette_trials(
    points: DataFrame,
    t: float,
    k: int,
    trials: int,
    id_column: str | None = None,
) -> DataFrame:
    """(trial, n, approx, n_sample, exact), for independent samples seeded 0 to trials - 1.

    The points are read three times, whatever the number of trials: for the sizes, for the
    samples of all trials (stored once), and for the scores of all trials.
    """
    check_k(k, least=2)
    check_t(t)
    if trials < 1:
        raise ValueError(f"there must be at least 1 trial, got {trials}")
    context = points.sparkSession.sparkContext
    sizes = settled_sizes(points, k)
    rows, ids = identified(points, id_column)
    rows = with_sizes(rows, sizes, k)
    texts = identity_texts(rows, ids)
    numbers = F.sequence(F.lit(0), F.lit(trials - 1))
    # Drawn before it is exploded: a point becomes as many rows as trials that drew it.
    drawn = F.filter(numbers, lambda i: unit_draw(i, *texts) < F.lit(float(t)) / F.col("_size"))
    sample = cut_lineage(rows.select("point", "cluster", F.explode(drawn).alias("_trial")))
    every_size = sizes.select("*", F.explode(numbers).alias("_trial"))
    found = collected(_statistics(every_size, sample, t, "_trial", "cluster"), "_trial")
    model = context.broadcast({i: found.get((i,), ClusterStatistics([])) for i in range(trials)})

    approx = summed_scores(points.select("point", "cluster").mapInArrow(score_sums(model), SCORES))
    exact = sample.select("point", "cluster", "_trial").mapInArrow(
        score_sums(model, keyed=True), SCORES
    )
    exact = summed_scores(exact).select(
        "key", F.col("n").alias("n_sample"), F.col("mean").alias("exact")
    )
    all_trials = points.sparkSession.range(trials).select(F.col("id").cast("int").alias("key"))
    return (
        all_trials.join(approx, "key", "left")
        .join(exact, "key", "left")
        .select(
            F.col("key").alias("trial"),
            F.coalesce("n", F.lit(0)).alias("n"),
            F.col("mean").alias("approx"),
            F.coalesce("n_sample", F.lit(0)).alias("n_sample"),
            "exact",
        )
    )


def repeated_silhouette(
    points: DataFrame, t: float, k: int, trials: int, id_column: str | None = None
) -> DataFrame:
    """One row (trials, approx, exact): means over independent samples."""
    each = silhouette_trials(points, t, k, trials, id_column)
    return each.agg(
        F.count("*").alias("trials"), F.avg("approx").alias("approx"), F.avg("exact").alias("exact")
    )
