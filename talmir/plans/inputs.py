"""What the registered queries take from the given tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LABELS = 10  # embeddings.label is 0 to 9


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """A customer rates each part they order by its quantity."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").alias("product"),
        F.col("o_custkey").alias("user"),
        F.col("l_quantity").alias("rating"),
        (days.cast("bigint") * 86400).alias("ts"),
    )


def points(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("point"),
        F.col("label").cast("int").alias("cluster"),
    )


def label_means(points: DataFrame) -> DataFrame:
    """(cid, centre): the mean point of each label, at most LABELS rows."""
    mean = Summarizer.mean(array_to_vector(F.col("point")))
    means = points.groupBy(F.col("cluster").alias("cid"))
    return means.agg(vector_to_array(mean).alias("centre"))


def whole_points(spark: SparkSession, folder: str) -> DataFrame:
    """Points of three small whole numbers, without an id, many of them equal."""
    whole = F.transform(F.slice("embedding", 1, 3), lambda x: F.floor(x * 4).cast("double"))
    return table(spark, folder, "embeddings").select(
        whole.alias("point"), F.col("label").cast("int").alias("cluster")
    )
