"""Document fingerprints by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where its bits match a mask. The
chunking is normalised: up to the average length the mask has more bits, and beyond it fewer,
so lengths stay close together. As the hash depends on the last 32 bytes only, an insertion
moves the boundaries near it and no others. A fingerprint is the set of the chunks' digests
with their lengths. How much of a text is contained in another is the share of its length in
chunks that both have.

The comparison with an edited text needs the document that follows in descending order of
identities. Texts are shuffled once for it, into ranges of identities; the first document of
each range is also sent to the range before, so each range is worked through as a stream,
whatever its length. The ranges' first documents, one row each, are all that is broadcast:
at most MAX_RANGES rows.

Defined results: a NULL text is an empty one, and two empty texts are alike (1.0), an empty and
another are not (0.0). NULL identities come last. Rows of equal identity follow each other in
the order of their texts' digests. The only document is followed by itself.
"""

from __future__ import annotations

import hashlib
import sys
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talmir.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST, AVERAGE, MOST = 16, 64, 256
# Bits that 32 bytes have an influence on; 6 bits give the average length of 64.
STRICT, LOOSE = np.uint64(0b1111111 << 25), np.uint64(0b11111 << 25)
OUT_ROWS = 512
RANGE_ROWS, MAX_RANGES = 5_000, 100_000


def _gear() -> np.ndarray:
    """256 mixed numbers: multiples of an odd constant, stirred twice."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


GEAR = _gear()


def gear_hashes(data: bytes) -> np.ndarray:
    """At each byte: the sum of the last 32 bytes' numbers, shifted by their distances."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        if len(h) > k:
            h = np.concatenate([h[:k], h[k:] + (h[:-k] << np.uint64(k))])
    return h


def chunk_ends(data: bytes) -> list[int]:
    h = gear_hashes(data)
    strict = np.flatnonzero((h & STRICT) == 0).tolist()
    loose = np.flatnonzero((h & LOOSE) == 0).tolist()
    ends, start, n = [], 0, len(data)
    while start < n:
        end = min(start + MOST, n)
        i = bisect_left(strict, start + LEAST - 1)
        if i < len(strict) and strict[i] < start + AVERAGE - 1:
            end = min(end, strict[i] + 1)
        else:
            i = bisect_left(loose, start + AVERAGE - 1)
            if i < len(loose):
                end = min(end, loose[i] + 1)
        ends.append(end)
        start = end
    return ends


def chunk_lengths(text: str | None) -> dict[str, int]:
    """Digest to length of the different chunks of a text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    found, start = {}, 0
    for end in chunk_ends(data):
        found[xxhash.xxh64_hexdigest(data[start:end])] = end - start
        start = end
    return found


def to_string(chunks: dict[str, int]) -> str:
    return ",".join(f"{digest}:{chunks[digest]}" for digest in sorted(chunks))


def containment(chunks: dict[str, int], other: dict[str, int]) -> float:
    """The share of the chunks' length that the other has too."""
    total = sum(chunks.values())
    if not total:
        return 0.0 if other else 1.0
    return sum(n for digest, n in chunks.items() if digest in other) / total


def fingerprint_column(text: Column) -> Column:
    @F.arrow_udf("string")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([to_string(chunk_lengths(t.as_py())) for t in texts], pa.string())

    return compute(text)


def edit(text: str, following: str) -> str:
    """The last third of the text replaced by the first as many characters of the next."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


COMPARED = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _ranges(docs: DataFrame, identity: str, rows_per_range: int) -> tuple[DataFrame, int]:
    """The documents with ``_range``, in the order of descending identities, and its number."""
    total = docs.count()
    count = max(2, min(MAX_RANGES, -(-total // rows_per_range)))
    as_double = docs.withColumn("_double", F.col(identity).cast("double"))
    quantiles = as_double.approxQuantile("_double", [i / count for i in range(1, count)], 0.2 / count)
    splits = [-float("inf"), *sorted(set(quantiles)), float("inf")]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    cut = Bucketizer(splits=splits, inputCol="_double", outputCol="_cut", handleInvalid="keep")
    count = len(splits) - 1
    # Without identity: after all others.
    number = F.when(F.col("_double").isNull(), F.lit(count)).otherwise(count - 1 - F.col("_cut"))
    cut_docs = cut.transform(as_double).withColumn("_range", number.cast("int"))
    return cut_docs.drop("_double", "_cut"), count + 1


def compare_with_next(
    docs: DataFrame, identity: str = "doc_id", text: str = "text", rows_per_range: int = RANGE_ROWS
) -> DataFrame:
    """(identity, and the columns of COMPARED): each text against its edited text and the next."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(identity).alias("_id"), content.alias("_text"))
    ranged, count = _ranges(rows, "_id", rows_per_range)
    order = F.struct(F.col("_id"), F.md5("_text").alias("digest"))
    heads = ranged.groupBy("_range").agg(F.max(order).alias("head"))
    heads = stored(heads, "range-heads")
    # Each range's first row goes to the range before as well; the very first to the last.
    by_range = Window.partitionBy().orderBy("_range")
    last = heads.agg(F.max("_range").alias("last")).first()["last"]
    to = heads.select(
        F.col("_range").alias("_head_range"),
        "head",
        F.coalesce(F.lag("_range").over(by_range), F.lit(last)).alias("_before"),
    )
    marked = ranged.join(F.broadcast(to), F.col("_range") == F.col("_head_range"))
    is_head = order.eqNullSafe(F.col("head"))
    places = F.array(F.struct(F.col("_range").alias("_place"), F.lit(0).alias("_ahead")))
    ahead = F.array(F.struct(F.col("_before").alias("_place"), F.lit(1).alias("_ahead")))
    placed = marked.select(
        "_id", "_text", F.inline(F.when(is_head, F.concat(places, ahead)).otherwise(places))
    )
    sent = placed.repartitionById(count, F.col("_place")).sortWithinPartitions(
        "_place", "_ahead", F.desc_nulls_last("_id"), F.md5("_text").desc()
    )
    id_type = sent.select("_id").schema[0].dataType
    kind = id_type.simpleString()

    def work(batches):
        pending, out = None, []

        def flush():
            columns = list(zip(*out))
            types = [id_arrow, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        names = ["_id"] + [c.split()[0] for c in COMPARED.split(", ")]
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                row_id, row_text, place, is_ahead = (c[i].as_py() for c in columns)
                if pending is None and is_ahead:
                    continue
                chunks = chunk_lengths(row_text)
                if pending is not None and pending[0] == place:
                    _, own_id, own_text, own = pending
                    edited = edit(own_text, row_text)
                    other = chunk_lengths(edited)
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append(
                        (own_id, len(own_text), sha, to_string(own), to_string(other),
                         containment(own, other), containment(own, chunks))
                    )
                    if len(out) >= OUT_ROWS:
                        yield flush()
                pending = None if is_ahead else (place, row_id, row_text, chunks)
        if out:
            yield flush()

    found = sent.select("_id", "_text", "_place", "_ahead").mapInArrow(work, f"_id {kind}, {COMPARED}")
    return found.withColumnRenamed("_id", identity)
