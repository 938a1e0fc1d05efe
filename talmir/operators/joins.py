"""Joining per-key totals back to the rows they were computed from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several join partitions.
HOT_ROWS = 10_000_000

# No key with less than one part in HOT_PARTS of all rows is spread. So by counting, fewer keys
# than this are, and their list can be broadcast whatever the size of the table.
HOT_PARTS = 10_000


def join_back(
    rows: DataFrame, totals: DataFrame, key: str, n: str = "n", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every row with its key's totals. ``totals[n]`` is the number of rows of the key.

    A window over the key would bring a key's rows into one task, and a plain join would
    too. Here the keys with more than ``hot_rows`` rows, and more than one part in HOT_PARTS of
    all rows, are cut into slices of that size, and the join is on (key, slice).

    The slice comes from the number of the partition that a row is read from. So it
    spreads identical rows as well, and a retried task repeats its choice.
    """
    most = totals.agg(F.greatest(F.lit(float(hot_rows)), F.sum(n) / HOT_PARTS)).scalar()
    slices = F.ceil(F.col(n) / most).cast("int")
    sliced = totals.withColumn("_slices", F.greatest(slices, F.lit(1)))
    hot = sliced.filter(F.col("_slices") > 1).select(F.col(key).alias("_hot_key"), "_slices")

    placed = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot_key")), "left")
    slice_of_row = F.pmod(F.spark_partition_id(), F.coalesce("_slices", F.lit(1)))
    placed = placed.withColumn("_slice", slice_of_row).drop("_hot_key", "_slices")

    copies = F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))
    right = sliced.withColumn("_right_slice", copies).drop("_slices")
    right = right.withColumnRenamed(key, "_right_key")
    same = F.col(key).eqNullSafe(F.col("_right_key")) & (F.col("_slice") == F.col("_right_slice"))
    return placed.join(right, same).drop("_slice", "_right_slice", "_right_key")
