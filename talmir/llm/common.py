"""Helpers shared by the operators: words, stored tables, numbering, connected components."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talmir.session import new_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Separators of the words of licence and benchmark texts: all ASCII but digits and a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Rows that one task numbers at a time, on average.
NUMBER_RUN = 2_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: computed once, no lineage."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    result = df.sparkSession.read.schema(df.schema).parquet(path)
    result._stored_at = path
    return result


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again, and let go of finished shuffles.

    Spark drops shuffle files once the driver's JVM has collected their handles, which on a
    driver with memory to spare may take hours; so it is asked to.
    """
    spark = tables[0].sparkSession
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for table in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(configuration).delete(path, True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Words between SEPARATORS, ASCII letters in lower case."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS, -1), "")


def number_rows(
    df: DataFrame, name: str, keys: list[str], order: list[Column], buckets: int
) -> DataFrame:
    """The rows with ``name``: 0, 1, 2, ... within each value of the keys, without gaps.

    A window over the keys would bring a whole key into one task. Here each key is cut into
    hash buckets of its rows; a row's number is its place in its bucket, plus the sizes of
    the buckets before it. Rows that are equal in all of ``order`` are numbered in any order.
    """
    cut = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = cut.groupBy(*keys, "_bucket").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        F.col("_bucket").alias("_start_bucket"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
    )
    place = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    same = F.col("_bucket") == F.col("_start_bucket")
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_key_{i}"))
    joined = cut.withColumn("_place", place).join(starts, same)
    number = (F.col("_start") + F.col("_place") - 1).cast("bigint")
    return joined.select(*df.columns, number.alias(name))


def number_buckets(rows: int) -> int:
    return max(512, min(10_000, -(-rows // NUMBER_RUN)))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) is connected to.

    Each round, every node takes the smallest root among its neighbours', and then the root
    of its root, so that paths shorten quickly. Rounds are stored, so none is computed
    twice and a lost executor costs one round at most. Only nodes with an edge are held. Joins are
    by shuffle: stored edges and roots repeat few numbers, so files are far smaller than rows.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "edges")
    roots = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")), "roots")
    roots = roots.withColumnRenamed("a", "node")
    while True:
        near = (
            both.join(roots.select(F.col("node").alias("b"), "root").hint("merge"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        hop = roots.join(near.hint("merge"), "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        hop = stored(hop, "hop")
        up = hop.select(F.col("node").alias("root"), F.col("root").alias("up"))
        # A root is a node itself, so the join finds one row for each.
        jumped = hop.join(up.hint("merge"), "root").select(
            "node", "old", F.least("root", "up").alias("root")
        )
        jumped = stored(jumped, "roots")
        roots = jumped.select("node", "root")
        if jumped.filter("root <> old").isEmpty():
            return roots
