"""Benchmark decontamination: short test items inside long documents, by MinHash sketches.

An item is contained in a document if at least ``threshold`` of the item's different word
shingles are among the document's. Items are partitioned by size (number of shingles), and the
size decides the sketch: an item of n shingles keeps the n - ceil(threshold * n) + 1 shingles
with the smallest hashes. A document that contains the item misses too few shingles to miss all
of these, so a document that meets no sketch value is no candidate, and none is lost. (Banded
signatures of equal length would lose items in long documents, where Jaccard similarity is
close to 0.) Candidates are verified by counting shared shingles, as text, not as hashes.

The items are the query set. They are taken in blocks of at most ``block`` sketch values, which
bounds what is broadcast whatever the size of the benchmark; each block is held against all
documents. Equal texts are searched and verified once, combined before any shuffle, and the
findings joined back by their digest. Likewise an item is known by the digest of its words, not
by its identity: different texts of one identity are items of their own, an item may lack an
identity, and identities are joined back at the end. Only built-in functions are used.

Defined results: NULL texts are empty and contain nothing; items without words are in no
document; texts or items with fewer words than a shingle are one shingle. Repeated rows get
equal results, and repeated items (same identity, NULL too, and words) count once. An identity
with several texts has a finding for each that a document contains.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talmir.llm.common import stored, text_or_empty, words

SHINGLE, THRESHOLD = 5, 0.8
BLOCK = 200_000


def _grams(w: str, size: int, make) -> Column:
    """``make`` of the words of each shingle of the array column; the whole if it is shorter."""
    column = F.col(w)
    count = F.size(column) - size + 1
    starts = F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)
    some = F.transform(starts, lambda i: make([F.get(column, i + j) for j in range(size)]))
    return F.when(F.size(column) > 0, some).otherwise(F.array())


def _hashes(w: str, size: int) -> Column:
    return _grams(w, size, lambda parts: F.xxhash64(*parts))


def _texts(w: str, size: int) -> Column:
    return _grams(w, size, lambda parts: F.concat_ws(" ", *parts))


def least_shared(n: Column, threshold: float) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.lit(threshold) * n - 1e-9)).cast("int")


def _item_key(text: str) -> Column:
    """What an item is known by: the digest of its words."""
    return F.unhex(F.sha2(F.concat_ws(" ", words(text_or_empty(text))).cast("binary"), 256))


def _item_shingles(items: DataFrame, text: str, size: int) -> DataFrame:
    """(_item, n, gram, hash): the different shingles of each different item."""
    split = items.select(_item_key(text).alias("_item"), words(text_or_empty(text)).alias("_w"))
    grams = split.select("_item", F.explode(_texts("_w", size)).alias("gram")).distinct()
    hashed = grams.withColumn("_w", F.split("gram", " "))
    hashed = hashed.select("_item", "gram", F.get(_hashes("_w", size), F.lit(0)).alias("hash"))
    return hashed.withColumn("n", F.count("*").over(Window.partitionBy("_item")))


def _sketches(shingles: DataFrame, threshold: float, block: int) -> DataFrame:
    """(_item, hash, part): the sketch values of each item, and the block it is in."""
    least = F.row_number().over(Window.partitionBy("_item").orderBy("hash", "gram"))
    kept = shingles.withColumn("_rank", least)
    kept = kept.filter(F.col("_rank") <= F.col("n") - least_shared(F.col("n"), threshold) + 1)
    total = kept.count()
    parts = max(1, math.ceil(2 * total / block))
    part = F.pmod(F.xxhash64("_item"), F.lit(parts)).cast("int")
    return kept.select("_item", "hash", part.alias("part")).withColumn("parts", F.lit(parts))


def _contained(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_text: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """(digest, _item, n_shingles, n_shared): items contained in the text with this SHA-256."""
    shingles = stored(_item_shingles(items, item_text, shingle), "item-shingles")
    sketches = stored(_sketches(shingles, threshold, block), "sketches")
    parts = sketches.agg(F.max("parts")).first()[0] or 0

    source = docs.select(text_or_empty(text).alias("_text"))
    digest = F.sha2(F.col("_text").cast("binary"), 256)
    split = source.select("_text", digest.alias("digest"), words(F.col("_text")).alias("_w"))
    hashed = split.select("digest", "_text", F.explode(_hashes("_w", shingle)).alias("hash"))
    candidates = None
    for part in range(parts):
        some = sketches.filter(F.col("part") == part).select("_item", "hash")
        # Only texts that meet a sketch leave the task that read them, each once.
        met = hashed.join(F.broadcast(some), "hash").groupBy("digest")
        met = met.agg(F.first("_text").alias("_text"), F.collect_set("_item").alias("_items"))
        met = stored(met, "candidates")
        candidates = met if candidates is None else candidates.unionByName(met)
    if candidates is None:
        candidates = docs.sparkSession.createDataFrame(
            [], "digest string, _text string, _items array<binary>"
        )

    pairs = candidates.select("digest", F.explode("_items").alias("_item"))
    texts = candidates.groupBy("digest").agg(F.first("_text").alias("_text"))
    grams = texts.select("digest", words(F.col("_text")).alias("_w"))
    grams = grams.select("digest", F.explode(F.array_distinct(_texts("_w", shingle))).alias("gram"))
    vocabulary = shingles.select("gram").distinct()
    # Few shingles of a document are in any item, so this comes before the join with pairs.
    # Joins are by shuffle: Spark does not count what a text or an item is exploded into.
    grams = grams.join(vocabulary.hint("merge"), "gram", "left_semi")
    pairs = pairs.join(shingles.select("_item", "gram", "n").hint("merge"), "_item")
    shared = pairs.join(grams.hint("merge"), ["digest", "gram"]).groupBy("digest", "_item")
    shared = shared.agg(F.first("n").alias("n_shingles"), F.count("*").alias("n_shared"))
    enough = F.col("n_shared") >= least_shared(F.col("n_shingles"), threshold)
    return stored(shared.filter(enough), "contained")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    **options,
) -> DataFrame:
    """(digest, item, n_shingles, n_shared): items contained in the text with this SHA-256."""
    found = _contained(docs, items, text, item_text, **options)
    known = items.select(_item_key(item_text).alias("_item"), F.col(item).alias("_identity"))
    named = found.join(known.distinct(), "_item")
    return named.select("digest", F.col("_identity").alias(item), "n_shingles", "n_shared")


def find_leaks(
    docs: DataFrame, items: DataFrame, identity: str = "doc_id", text: str = "text", item: str = "item_id", **options
) -> DataFrame:
    """(identity, item, n_shingles, n_shared, containment), a row per document and item in it."""
    found = contained_items(docs, items, text=text, item=item, **options)
    found = found.withColumnsRenamed({item: "_found_item"})
    digest = F.sha2(text_or_empty(text).cast("binary"), 256)
    rows = docs.select(F.col(identity).alias("_identity"), digest.alias("digest"))
    return rows.join(found, "digest").select(
        F.col("_identity").alias(identity),
        F.col("_found_item").alias(item),
        "n_shingles",
        "n_shared",
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that contain no item, with their own columns.

    The join is by shuffle whatever the number of leaks, which grows with the documents.
    """
    options.pop("item", None)  # which item it is does not matter
    leaks = _contained(docs, items, text=text, **options).select(F.col("digest").alias("leak")).distinct()
    # The documents' own columns are packed, so that their names meet no others.
    digest = F.sha2(text_or_empty(text).cast("binary"), 256)
    packed = docs.select(F.struct("*").alias("row"), digest.alias("digest"))
    kept = packed.join(leaks.hint("merge"), F.col("digest") == F.col("leak"), "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
