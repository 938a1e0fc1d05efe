"""k-means by Lloyd's algorithm, and a sweep over the number of clusters.

Centres: (cid INT, centre ARRAY<DOUBLE>), k rows. As in any k-means, the k centres pass
through the driver between steps; the points do not.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talmir.functions import unit_draw
from talmir.functions.expressions import hash_key
from talmir.operators.clusters import check_k, check_model, check_t, identity_texts, number_copies
from talmir.operators.kernels import (
    SCORES,
    ClusterStatistics,
    first_points,
    nearest_in_sets,
    partial_means,
    score_sums,
)
from talmir.operators.silhouette import _statistics, collected, summed_scores
from talmir.session import cut_lineage

CENTRE_SCHEMA = "cid int, centre array<double>"

# Tasks that share the second round of a search for the k smallest hashes.
START_GROUPS = 64

Matrix = list[list[float]]


def _centres(points: DataFrame, centres: Matrix) -> DataFrame:
    return points.sparkSession.createDataFrame(list(enumerate(centres)), CENTRE_SCHEMA)


def _ml_centres(points: DataFrame, k: int, iters: int, seed: int) -> Matrix:
    vectors = points.select(array_to_vector(F.col("point")).alias("features"))
    if k == 1:  # which Spark ML refuses: the mean, if there are points
        mean = vectors.agg(Summarizer.mean(F.col("features")).alias("m"), F.count("*").alias("n"))
        row = mean.first()
        return [row["m"].toArray().tolist()] if row["n"] else []
    trainer = KMeans(k=k, maxIter=iters, initMode="random", seed=seed)
    return [centre.tolist() for centre in trainer.fit(vectors).clusterCenters()]


def _start_candidates(points: DataFrame, k: int, seed: int, id_column: str | None) -> DataFrame:
    """(hash, tie, point): the first k different points of each task, by a hash."""
    name = id_column or "point"
    text = F.col(name) if id_column else F.concat_ws(",", F.col(name).cast("array<string>"))
    drawn = points.select(hash_key(seed, text).alias("hash"), F.col(name).alias("tie"), "point")
    return drawn.mapInArrow(first_points(k), drawn.schema)


def _initial_centres(points: DataFrame, k: int, seed: int, id_column: str | None) -> Matrix:
    """The first k different points in the order of a hash; fewer if there are no more.

    Each task keeps k points, START_GROUPS tasks keep k of those, and only then does one task see
    the rest; so the shuffles hold k points a task, whatever k is and however often points repeat.
    """
    some = _start_candidates(points, k, seed, id_column)
    group = F.pmod(F.spark_partition_id(), F.lit(START_GROUPS))
    some = some.repartition(START_GROUPS, group).mapInArrow(first_points(k), some.schema)
    few = some.repartition(1).mapInArrow(first_points(k), some.schema)
    return [row["point"] for row in few.collect()]


def _step(points: DataFrame, sets: list[Matrix]) -> DataFrame:
    """(s, cid, n, mean) of the points nearest to each centre; no row where there are none."""
    matrices = [np.array(centres, dtype=np.float64) for centres in sets]
    model = points.sparkSession.sparkContext.broadcast(matrices)
    partial = points.select("point").mapInArrow(
        partial_means(model), "s int, cid int, n bigint, mean array<double>"
    )
    mean = Summarizer.mean(array_to_vector(F.col("mean")), F.col("n").cast("double"))
    return partial.groupBy("s", "cid").agg(
        F.sum("n").alias("n"), vector_to_array(mean).alias("mean")
    )


def _lloyd_centres(
    points: DataFrame, ks: list[int], iters: int, seed: int, id_column: str | None
) -> list[Matrix]:
    """Centres for each k. All of them share each pass over the points."""
    start = _initial_centres(points, max(ks), seed, id_column)
    sets = [start[:k] for k in ks]
    if not start:
        return sets
    check_model(sum(map(len, sets)), len(start[0]))
    for _ in range(iters):
        moved = [list(centres) for centres in sets]
        for row in _step(points, sets).collect():  # a row per centre
            moved[row["s"]][row["cid"]] = row["mean"]
        if moved == sets:
            break
        sets = moved
    return sets


def kmeans(points: DataFrame, k: int, iters: int, seed: int) -> DataFrame:
    """Centres by Spark ML, from random points. There may be fewer than k."""
    check_k(k)
    return _centres(points, _ml_centres(points, k, iters, seed))


def lloyd_kmeans(
    points: DataFrame, k: int, iters: int, seed: int, id_column: str | None = None
) -> DataFrame:
    """Centres after ``iters`` steps from k different points picked by hash; repeatable anywhere.

    With fewer than k different points there are as many centres as those. A centre that no
    point is nearest to stays where it is. A step is one pass over the
    points and a shuffle of one mean per centre and partition, so persist the points first
    if they are slow to read.
    """
    check_k(k)
    return _centres(points, _lloyd_centres(points, [k], iters, seed, id_column)[0])


def k_sweep(
    points: DataFrame,
    kstart: int,
    h: int,
    iters: int,
    m: float,
    seed: int,
    id_column: str | None = None,
    random_start: bool = False,
) -> DataFrame:
    """(k, n, silhouette) for each k from kstart to kstart + h - 1.

    About m points are sampled in all, so t = m / k, which need not be whole. Centres are
    those of :func:`kmeans` with ``random_start``, else of :func:`lloyd_kmeans`.

    All k share every pass: one for the start, one per step, and one each for sizes, samples and scores, which is iters + 4 in all. The samples are
    stored; the assignments are not, as the nearest centres are found again in each pass.
    With ``random_start`` Spark ML trains each k on its own.
    """
    check_k(kstart, least=2)
    check_t(m)
    ks = list(range(kstart, kstart + h))
    spark = points.sparkSession
    schema = "k int, n bigint, silhouette double"
    if random_start:
        sets = [_ml_centres(points, k, iters, seed) for k in ks]
    else:
        sets = _lloyd_centres(points, ks, iters, seed, id_column)
    if not all(sets):
        return spark.createDataFrame([(k, 0, None) for k in ks], schema)

    sizes = _step(points, sets).select("s", F.col("cid").alias("cluster"), "n").collect()
    share = [np.zeros(len(centres)) for centres in sets]
    for row in sizes:
        share[row["s"]][row["cluster"]] = m / ks[row["s"]] / row["n"]
    matrices = [np.array(centres, dtype=np.float64) for centres in sets]
    model = spark.sparkContext.broadcast(list(zip(matrices, share)))

    if id_column is None:
        # Copies are numbered before they are assigned, which is the same for all of them.
        rows = number_copies(points.select("point", F.lit(0).alias("cluster")))
        point, copy = identity_texts(rows, ["point", "_copy"])
        parts = lambda cid: [point, cid, copy]
    else:
        rows = points
        parts = lambda cid: [F.col(id_column)]
    assigned = rows.withColumn("_sets", nearest_in_sets(model)(F.col("point")))

    def numbered(x: Column, s: Column) -> Column:
        return F.struct(s.alias("s"), x["cid"].alias("cluster"), x["p"].alias("p"))

    drawn = F.filter(
        F.transform("_sets", numbered), lambda x: unit_draw(seed, *parts(x["cluster"])) < x["p"]
    )
    sample = cut_lineage(assigned.select("point", F.inline(drawn)))
    every_size = spark.createDataFrame(sizes, "s int, cluster int, n bigint")
    found: dict[int, ClusterStatistics] = {}
    for s, k in enumerate(ks):  # a few rows each, of the stored sample
        own = [df.filter(F.col("s") == s) for df in (every_size, sample)]
        statistics = _statistics(own[0].drop("s"), own[1], m / k, "cluster")
        found[s] = collected(statistics).get((), ClusterStatistics([]))
    scored = points.select("point").mapInArrow(
        score_sums(spark.sparkContext.broadcast(found), spark.sparkContext.broadcast(matrices)), SCORES
    )
    by_key = {r["key"]: r for r in summed_scores(scored).collect()}
    results = [(k, by_key[s]["n"], by_key[s]["mean"]) for s, k in enumerate(ks)]
    return spark.createDataFrame(results, schema)
