"""The operators as queries over the given tables: name to (spark, folder) -> DataFrame."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from talmir.llm import (
    alignment,
    audit,
    chunking,
    decontaminate,
    embeddings,
    licenses,
    phrases,
    quality,
    secrets,
    sentencepiece,
    sharding,
    simhash,
    warc,
)
from talmir.llm.common import stored, table, text_or_empty
from talmir.session import new_path


def op1_warc(spark, folder):
    """Every page written as a WARC record, and the archives read back, digests verified."""
    warc.register(spark)
    pages = table(spark, folder, "pages").select(
        "page_id",
        F.concat(F.lit("urn:page:"), F.col("page_id").cast("string")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    records = warc.with_revisits(pages, "page_id", "payload").select(
        "warc_type",
        "record_id",
        "target_uri",
        F.concat(F.lit("urn:page:"), F.col("refers_to").cast("string")).alias("refers_to"),
        F.length("payload").cast("bigint").alias("payload_length"),
        # A revisit's payload goes only as far as its digest.
        "payload",
    )
    path = new_path(spark, "archive")
    records.write.format("warc").mode("append").save(path)
    wanted = "warc_type string, record_id string, payload_digest string, refers_to string, payload_length bigint"
    back = spark.read.format("warc").schema(wanted).option("verify", "true").load(path)
    back = back.filter(F.col("warc_type").isin("response", "revisit"))
    page = lambda c: F.substring_index(c, ":", -1).try_cast("bigint")
    return back.select(
        page("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        page("refers_to").alias("refers_to"),
    )


def op2_secret_scan(spark, folder):
    """Secrets in all documents, through a new ledger: each different text is scanned once."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan(documents, new_path(spark, "ledger"))
    base = [rule.kind for rule in secrets.BASE_RULES]

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(joined(of(*base)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op3_license_scan(spark, folder):
    """License phrases and templates in all documents."""
    found = licenses.scan_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.array_distinct(F.col("places.label"))
    every = F.array_union(base, F.col("matches.label"))
    score = F.coalesce(F.array_max("matches.containment"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.place").alias("first_word"),
        F.array_max("places.place").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(score).alias("score"),
    )


def license_pairs(spark, folder):
    """Every pair of a document and a template that reaches the threshold in one of its blocks."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(documents, every=True)
    return found.select("doc_id", F.inline("contained"))


# Where the public tokenizer files are; never copied here.
TOKENIZER = os.environ.get("TALMIR_TOKENIZER", "/opt/tokenizers/piece_bpe_32k.model")


def op4_sentencepiece(spark, folder):
    """The pieces of all documents, and whether they decode to the text again."""
    pieces = sentencepiece.Pieces(spark, TOKENIZER)
    documents = table(spark, folder, "documents")
    coded = documents.select("doc_id", pieces.encode_and_check(text_or_empty()).alias("coded"))
    return coded.select(
        "doc_id",
        F.size("coded.pieces").cast("bigint").alias("n_pieces"),
        "coded.pieces",
        "coded.round_trip",
    )


SHARDS = 24


def op5_sharding(spark, folder):
    """All documents in 24 shards of equal numbers of rows, copies kept together."""
    text = text_or_empty()
    facts = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("copies"),
    )
    sharded = sharding.shard_rows(stored(facts, "facts"), "copies", ["doc_id", "copies"], SHARDS)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_quality(spark, folder):
    """All documents with the quality score of a model that has not seen the held-out labels."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    model, rows = quality.train(documents, labels)
    scored = rows.select(
        F.col("_id").alias("doc_id"), "held_out", model.score_features(F.col("features")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


SIMHASH_SHINGLE, SIMHASH_BITS = 3, 3


def op7_simhash(spark, folder):
    """All documents with their fingerprint and the smallest document they are linked to."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    groups = simhash.simhash_groups(
        documents, "doc_id", "text", SIMHASH_SHINGLE, SIMHASH_BITS
    )
    return groups.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op8_fingerprints(spark, folder):
    """Fingerprints of all documents and their edited texts, and what they have in common."""
    return chunking.compare_with_next(table(spark, folder, "documents").select("doc_id", "text"))


def op9_decontamination(spark, folder):
    """Every document that contains a benchmark item, with the item."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    items = table(spark, folder, "benchmark").select("item_id", "text")
    return decontaminate.find_leaks(documents, items)


def op10_phrases(spark, folder):
    """All documents without the words that repeat 20 words or more of an earlier place."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    kept = phrases.remove_repeats(documents)
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op11_filter_audit(spark, folder):
    """What five filters remove from all documents, in every order."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    labels = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    return audit.audit(documents, labels)


def op12_embedding_dedup(spark, folder):
    """All vectors with their links at cosine 0.98 within a label."""
    return embeddings.link_embeddings(table(spark, folder, "embeddings"))


# The byte-level vocabulary that the pieces are aligned with.
BYTE_TOKENIZER = os.environ.get("TALMIR_BYTE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")


def op13_alignment(spark, folder):
    """The tokens of two tokenizers over all documents, aligned, and counts of their id pairs."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return alignment.align_documents(documents, BYTE_TOKENIZER, TOKENIZER)


QUERIES = {
    "op1_warc": op1_warc,
    "op2_secret_scan": op2_secret_scan,
    "op3_license_scan": op3_license_scan,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_sharding": op5_sharding,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_fingerprints": op8_fingerprints,
    "op9_decontamination": op9_decontamination,
    "op10_phrases": op10_phrases,
    "op11_filter_audit": op11_filter_audit,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_alignment": op13_alignment,
    "license_pairs": license_pairs,
}
