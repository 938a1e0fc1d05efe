"""Word counting.

A word is what lies between two single spaces: empty words count, case matters and line
ends stay inside words. For one document per line, explode the lines first.

Every count below combines on the map side before its shuffle, so a word (or a document,
or a copy of one) that makes up a large share of the input costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _words(docs: DataFrame, text: str, *kept: str) -> DataFrame:
    return docs.select(*kept, F.explode(F.split(F.col(text), " ", -1)).alias("word"))


def _salt(k: int, *columns: str):
    if k < 1:
        raise ValueError(f"the number of salts must be at least 1, got {k}")
    # Hashed, not drawn: a retried task must send each row to the same place.
    return F.pmod(F.xxhash64(*columns), F.lit(k)).cast("int").alias("salt")


def _sum_per_word(counts: DataFrame) -> DataFrame:
    return counts.groupBy("word").agg(F.sum("cnt").alias("cnt"))


def doc_word_count(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, word, cnt): how often each word occurs in each document."""
    return _words(docs, text, doc).groupBy(doc, "word").agg(F.count("*").alias("cnt"))


def word_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, cnt) in one shuffle."""
    return _words(docs, text).groupBy("word").agg(F.count("*").alias("cnt"))


def word_count_salted(
    docs: DataFrame, k: int, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(word, cnt) in two rounds. A word gets one of k salts per document as it is read, so all
    its occurrences in a document share one."""
    words = _words(docs, text, doc).select("word", _salt(k, "word", doc))
    return _sum_per_word(words.groupBy("salt", "word").agg(F.count("*").alias("cnt")))


def word_count_salted_groupby(
    docs: DataFrame, k: int, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(word, cnt) in two rounds after the counts per document: these get the salts.

    Unlike :func:`word_count_salted` it counts each document's words first, which is a shuffle
    of every such pair more, and salts depend on that count too.
    """
    counts = doc_word_count(docs, doc, text).select("word", "cnt", _salt(k, "word", doc, "cnt"))
    return _sum_per_word(counts.groupBy("salt", "word").agg(F.sum("cnt").alias("cnt")))


def word_count_by_partition(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, cnt): counts combined inside each input partition, then summed per word.

    Spark's partial aggregation is that combine: it runs in the task that reads the
    partition, before the only shuffle. Grouping by the partition number as well would
    shuffle twice for the same counts.
    """
    ones = _words(docs, text).select("word", F.lit(1).cast("bigint").alias("cnt"))
    return _sum_per_word(ones)


def num_documents(docs: DataFrame) -> DataFrame:
    """One row: num_documents."""
    return docs.agg(F.count("*").alias("num_documents"))


def num_distinct_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: num_distinct_words."""
    return _words(docs, text).agg(F.count_distinct("word").alias("num_distinct_words"))


def avg_distinct_word_length(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: mean length of the distinct words, each counted once, in code points."""
    words = _words(docs, text).distinct()
    return words.agg(F.avg(F.length("word")).alias("avg_distinct_word_length"))
