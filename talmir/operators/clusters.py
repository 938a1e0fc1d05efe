"""Labelled points: cluster sizes, reproducible per-cluster samples, nearest centres.

Points have a column ``point`` (ARRAY<DOUBLE>) and a label ``cluster`` (INT, 0 to k - 1).
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talmir.functions import require, unit_draw
from talmir.operators.joins import HOT_ROWS, join_back
from talmir.operators.kernels import nearest_centre, nearest_so_far, running_sample
from talmir.session import cut_lineage

# Up to this many clusters, their sizes are broadcast. Beyond it they are joined by a shuffle.
MAX_SMALL_K = 10_000

# Centres and statistics are models, which must fit the memory of the driver and of each task;
# assign_clusters takes larger ones in blocks.
MAX_MODEL_NUMBERS = 1 << 27

# Identical rows are numbered in runs of this length, each of them in one task.
COPY_RUN = 100_000


def check_k(k: int, least: int = 1) -> None:
    if k < least:
        raise ValueError(f"k must be at least {least}, got {k}")


def check_t(t: float) -> None:
    if not t > 0:
        raise ValueError(f"t must be above 0, got {t}")


def check_model(rows: int, dimensions: int) -> None:
    if rows * dimensions > MAX_MODEL_NUMBERS:
        raise ValueError(f"{rows} rows of {dimensions} numbers do not fit a broadcast model")


def check_labels(points: DataFrame, k: int) -> DataFrame:
    """The same points; the job fails if a label is outside 0 to k - 1."""
    inside = F.coalesce(F.col("cluster").between(0, k - 1), F.lit(False))
    label = F.coalesce(F.col("cluster").cast("string"), F.lit("NULL"))
    message = F.concat(F.lit("label not in 0 to "), F.lit(str(k - 1)), F.lit(": "), label)
    return points.filter(require(inside, message))


def cluster_sizes(points: DataFrame) -> DataFrame:
    """(cluster, n)."""
    return points.groupBy("cluster").agg(F.count("*").alias("n"))


def number_copies(points: DataFrame, copy_run: int = COPY_RUN) -> DataFrame:
    """(point, cluster, _copy): the same rows, identical ones numbered from 0.

    Copies are counted by a grouped aggregate, which combines them on the map side, and
    then written out again. A large group is first cut into runs that are spread over
    the cluster, so it is never in one task as a window over the group would have it.
    """
    groups = points.groupBy("point", "cluster").agg(F.count("*").alias("_copies"))

    def numbered(runs: DataFrame) -> DataFrame:
        last = F.least(F.col("_start") + copy_run, F.col("_copies")) - 1
        copy = F.explode(F.sequence(F.col("_start"), last)).alias("_copy")
        return runs.select("point", "cluster", copy)

    zero = F.lit(0).cast("bigint")
    small = groups.filter(F.col("_copies") <= copy_run).withColumn("_start", zero)
    large = groups.filter(F.col("_copies") > copy_run)
    starts = F.explode(F.sequence(zero, F.col("_copies") - 1, F.lit(copy_run).cast("bigint")))
    large = large.withColumn("_start", starts).repartition("point", "cluster", "_start")
    return numbered(small).unionByName(numbered(large))


def settled_sizes(points: DataFrame, k: int) -> DataFrame:
    """:func:`cluster_sizes`, computed now, for the several places that need them.

    This pass also checks the labels. So it returns at most k rows, which decides where
    they are kept.
    """
    sizes = cluster_sizes(check_labels(points.select("cluster"), k))
    if k > MAX_SMALL_K:
        return cut_lineage(sizes)
    return points.sparkSession.createDataFrame(sizes.collect(), sizes.schema)


def with_sizes(
    points: DataFrame, sizes: DataFrame, k: int | None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every point with its cluster's size as ``_size``; ``sizes`` has at most k rows."""
    sizes = sizes.select("cluster", F.col("n").alias("_size"))
    if k is not None and k <= MAX_SMALL_K:
        return points.join(F.broadcast(sizes), "cluster")
    return join_back(points, sizes, "cluster", n="_size", hot_rows=hot_rows)


def identity_texts(points: DataFrame, id_columns: list[str]) -> list[Column]:
    """What tells one point from every other, as texts."""
    texts = []
    for name in id_columns:
        column = F.col(name)
        if isinstance(points.schema[name].dataType, T.ArrayType):
            column = F.concat_ws(",", column.cast("array<string>"))
        texts.append(column)
    return texts


def draw(points: DataFrame, t: float, seed: int | Column, id_columns: list[str]) -> DataFrame:
    """Rows of ``points`` (with their cluster's ``_size``) that an independent draw keeps."""
    # A probability above 1 keeps every row, as the draw is below 1.
    u = unit_draw(seed, *identity_texts(points, id_columns))
    return points.filter(u < F.lit(float(t)) / F.col("_size"))


def identified(points: DataFrame, id_column: str | None) -> tuple[DataFrame, list[str]]:
    """The points, and the columns that tell one point from every other."""
    if id_column is not None:
        return points, [id_column]
    return number_copies(points), ["point", "cluster", "_copy"]


def sample_clusters(
    points: DataFrame,
    t: float,
    seed: int,
    k: int | None = None,
    id_column: str | None = None,
) -> DataFrame:
    """Each point independently with probability min(1, t / size of its cluster).

    The same for every partitioning. An id column must tell every row from the others.
    Without one, a point is identified by its values and its number among identical rows,
    so copies are drawn independently, and only ``point`` and ``cluster`` are returned.
    ``k`` is the number of clusters; without it none is assumed to be small.
    """
    check_t(t)
    if k is not None:
        points = check_labels(points, k)
    return sample_given_sizes(points, cluster_sizes(points), t, seed, k, id_column)


def sample_given_sizes(points, sizes, t, seed, k, id_column) -> DataFrame:
    """As :func:`sample_clusters`, where the sizes are already there."""
    rows, ids = identified(points, id_column)
    kept = points.columns if id_column is not None else ["point", "cluster"]
    return draw(with_sizes(rows, sizes, k), t, seed, ids).select(*kept)


def sample_in_one_pass(points: DataFrame, t: float, seed: int, id_column: str) -> DataFrame:
    """The rows of :func:`sample_clusters`, of points that are costly to read, such as text or a join.

    The points are read once, when this is called: each task keeps what a sample may need, knowing
    only how many rows of a cluster it has read so far, and counts. The sizes then say which
    of the kept rows, about t * (1 + ln(rows / t)) for each task and cluster, are in the sample.
    (From Parquet two passes are cheaper, as the first reads the labels only.)
    """
    check_t(t)
    u = unit_draw(seed, *identity_texts(points, [id_column]))
    rows = points.select("cluster", u.alias("u"), F.struct("*").alias("row"))
    kinds = {field.name: field.dataType.simpleString() for field in rows.schema}
    kept = rows.mapInArrow(
        running_sample(float(t)), f"cluster {kinds['cluster']}, n bigint, u double, row {kinds['row']}"
    )
    kept = cut_lineage(kept)
    sizes = kept.filter("n IS NOT NULL").groupBy(F.col("cluster").alias("label")).agg(F.sum("n").alias("size"))
    joined = kept.filter("n IS NULL").join(sizes, F.col("cluster").eqNullSafe(F.col("label")))
    sample = joined.filter(F.col("u") < F.lit(float(t)) / F.col("size"))
    return sample.select(*[F.col("row")[c].alias(c) for c in points.columns])


def sample_sizes(sample: DataFrame) -> DataFrame:
    """(cluster, n_sampled) of the sample that is actually used."""
    return sample.groupBy("cluster").agg(F.count("*").alias("n_sampled"))


def _model(points: DataFrame, rows: list):
    ids = np.array([row["cid"] for row in rows], dtype=np.int32)
    matrix = np.array([row["centre"] for row in rows], dtype=np.float64)
    return points.sparkSession.sparkContext.broadcast((ids, matrix))


def _blocks(centres: DataFrame, numbers: int):
    """The centres in the order of their ids, as lists of rows of so many numbers at most. Only one
    partition of them at a time is brought to the driver."""
    rows: list = []
    for row in centres.orderBy("cid").toLocalIterator():
        if rows and (len(rows) + 1) * len(row["centre"]) > numbers:
            yield rows
            rows = []
        rows.append(row)
    if rows:
        yield rows


def assign_clusters(
    points: DataFrame, centres: DataFrame, model_numbers: int = MAX_MODEL_NUMBERS
) -> DataFrame:
    """Every point with the ``cluster`` of its nearest centre; the lowest index wins ties.

    ``centres``: (cid INT, centre ARRAY<DOUBLE>). They are broadcast, so the points are read
    once and not shuffled, whatever their number. Coordinates must be finite; where all
    distances overflow the lowest index is taken.

    Centres of more than ``model_numbers`` numbers in all are taken in blocks of that many, in the
    order of their ids. Each block is broadcast on its own, and the points with the best centre so
    far are stored between blocks, so no task holds more than a block.
    """
    blocks = _blocks(centres, model_numbers)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        raise ValueError("there are no centres to assign points to")
    columns = [c for c in points.columns if c != "cluster"]
    if second is None:
        return points.select(*columns, nearest_centre(_model(points, first))(F.col("point")).alias("cluster"))
    # The points' own columns are packed, so that their names meet no others.
    none = F.struct(F.lit(float("nan")).alias("d"), F.lit(0).alias("cid"))
    found = points.select(F.struct(*columns).alias("row"), none.alias("best"))
    for rows in chain([first, second], blocks):
        nearer = nearest_so_far(_model(points, rows))(F.col("row.point"), F.col("best"))
        found = cut_lineage(found.select("row", nearer.alias("best")))
    return found.select(*[F.col("row")[c].alias(c) for c in columns], F.col("best.cid").alias("cluster"))
