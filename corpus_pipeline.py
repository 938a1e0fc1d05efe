"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

A stage takes (spark, docs, sf_dir) and works on every document that its predecessor kept. All
but the last return the columns of ``documents``, whatever other columns there are.

1. quality: documents that the classifier gives a score below 0.5 go. Without trusted positives
   none does.
2. near_duplicates: of documents linked by SimHash, the one with the smallest doc_id stays.
3. decontamination: documents that contain a benchmark item go.
4. secrets: found secrets are replaced by asterisks; no document goes.
5. tokens: SentencePiece ids, checked to decode to the text again.

NULL texts count as empty ones and stay NULL. SQL cannot express a trained model, SimHash
components or a tokenizer, so there is no ORACLE_SQL; tests compare with plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talmir.llm import decontaminate, quality, secrets, sentencepiece, simhash
from talmir.llm.common import table, text_or_empty
from talmir.llm.queries import SIMHASH_BITS, SIMHASH_SHINGLE, TOKENIZER
from talmir.session import new_path

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the labels not held out, accepts."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model, _ = quality.train(docs, labels)
    return docs.filter(model.score(F.col("text")) >= 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, "doc_id", "text", SIMHASH_SHINGLE, SIMHASH_BITS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark item."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.drop_leaks(docs, items)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked; a new ledger, so every text is scanned."""
    return secrets.mask_secrets(docs, new_path(spark, "ledger"))


def add_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``pieces`` (ids), ``n_pieces`` and ``round_trip``."""
    pieces = sentencepiece.Pieces(spark, TOKENIZER)
    # The documents' own columns are packed, so that their names meet no others.
    packed = docs.select(F.struct("*").alias("row"), pieces.encode_and_check(text_or_empty()).alias("coded"))
    kept = [c for c in docs.columns if c.lower() not in ("pieces", "n_pieces", "round_trip")]
    return packed.select(
        *[F.col("row")[c].alias(c) for c in kept],
        "coded.pieces",
        F.size("coded.pieces").cast("bigint").alias("n_pieces"),
        "coded.round_trip",
    )


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("tokens", add_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of this folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
