"""Near-duplicates by SimHash: fingerprints that differ in few bits, by deletion variants.

A fingerprint of 64 bits is cut into max_bits // 2 + 1 segments: fewer than the max_bits + 1
that would leave one segment untouched, and few enough that one of them differs by one bit at
most. So two fingerprints within ``max_bits`` agree in a segment as it is, or in a segment
with one bit left out. Each fingerprint is indexed under its segments, and under every segment
with one bit deleted; equality joins of these keys find the candidates, which are verified by
counting the bits that differ. For 3 bits there are 2 segments of 32 bits, so keys are long
and few fingerprints meet by chance.

A key with a deleted bit only joins fingerprints where that bit is 0 with those where it is 1.
So a pair meets once per segment, and a row goes to one side of the join only. Copies share a
fingerprint, and only different fingerprints are joined. Links are joined into components. All
joins are by shuffle, as both sides grow with the documents.

A segment value shared by very many different fingerprints, as those of a large group of near
copies, is cut further: within it, the rest of the bits must differ by ``max_bits`` at most, so
the rest is cut into segments in the same way, and the deeper keys replace the segment's.

Defined results: a NULL text is an empty one, with fingerprint zero, which links like any
other. NULL identities count for nothing in a component's smallest identity. Repeated rows get
equal results.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talmir.llm.common import components, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
BITS = 64
# Shingles whose bits are counted at a time.
BLOCK = 1 << 14


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the text's word shingles, as a signed 64-bit number.

    Words lie between ASCII white space, with A-Z in lower case. A bit is 1 if it is set in
    over half of the shingles' XXH64 hashes. Fewer words are one shingle, none give 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:count].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, count, BLOCK):
        pairs = zip(starts[i : i + BLOCK], stops[i : i + BLOCK])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > count, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    @F.arrow_udf("bigint")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x.as_py(), shingle) for x in texts], pa.int64())

    return compute.asNondeterministic()(text)


def _mask(size: int, deleted: int = -1) -> int:
    """The lowest bits set, but for the deleted one, as a signed number."""
    value = (1 << size) - 1 - (1 << deleted if deleted >= 0 else 0)
    return value - (1 << 64) if value >> 63 else value


def _segments(start: int, size: int, max_bits: int) -> list[tuple[int, int]]:
    """(start, size) of the segments of this stretch of bits."""
    count = max_bits // 2 + 1
    cuts = [start + size * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


def _part(start: int, size: int) -> Column:
    return F.shiftrightunsigned("value", start).bitwiseAND(F.lit(_mask(size)))


def _keys(segments: list[tuple[int, int]]) -> Column:
    """Array of (rest, which, side) of ``value``: side -1 for a whole segment, else the deleted
    bit's value. ``rest`` are the other bits, ``which`` says which segment and bit."""
    keys = []
    for start, size in segments:
        part = _part(start, size)
        for bit in [-1, *range(size)]:
            rest = part if bit < 0 else part.bitwiseAND(F.lit(_mask(size, bit)))
            side = F.lit(-1) if bit < 0 else F.shiftrightunsigned(part, bit).bitwiseAND(F.lit(1))
            which = F.lit(start * (BITS + 1) + bit + 1)
            keys.append(
                F.struct(rest.alias("rest"), which.alias("which"), side.cast("int").alias("side"))
            )
    return F.array(*keys)


def _joined(parts: list[tuple[DataFrame, DataFrame]], on: list[str], max_bits: int) -> DataFrame:
    """(a, b), a < b, of the values of two sides that share a key and differ in few bits.

    By shuffle whatever the size: Spark does not count the keys that a value has, takes a side for
    as small as the values, and would broadcast it.
    """
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    every = None
    for left, right in parts:
        met = left.withColumnRenamed("value", "a").join(
            right.withColumnRenamed("value", "b").hint("merge"), on
        )
        met = met.filter(near & (F.col("a") != F.col("b")))
        met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        every = met if every is None else every.unionByName(met)
    return every


def near_pairs(values: DataFrame, column: str, max_bits: int, dense: int = 256) -> DataFrame:
    """(a, b), a < b: all pairs of different values of the column that differ in few bits.

    ``dense``: a segment that more values share is cut further; the pairs found are the same.
    """
    values = values.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
    segments = _segments(0, BITS, max_bits)
    parts = F.array(
        *[F.struct(F.lit(s).alias("start"), _part(s, n).alias("part")) for s, n in segments]
    )
    cut = values.select("value", F.inline(parts))
    heavy = cut.groupBy("start", "part").agg(F.count("*").alias("n")).filter(F.col("n") > dense)
    heavy = heavy.select("start", "part", F.lit(True).alias("heavy"))
    cut = cut.join(heavy.hint("merge"), ["start", "part"], "left")
    cut = stored(cut.select("value", "start", F.coalesce("heavy", F.lit(False)).alias("heavy")), "segments")

    def keyed(rows: DataFrame, prefix: str, choose) -> DataFrame:
        """The rows with the keys of the segments that ``choose`` gives for their start."""
        array = None
        for start, size in segments:
            own = _keys(choose(start, size))
            array = own if array is None else F.when(F.col("start") == start, own).otherwise(array)
        names = [prefix + n for n in ("rest", "which", "side")]
        return rows.select(*rows.columns, F.inline(array).alias(*names))

    outer = keyed(cut, "", lambda start, size: [(start, size)])
    on = ["rest", "which"]

    def side(number: int, *conditions: str) -> DataFrame:
        rows = outer.filter(F.col("side") == number)
        for condition in conditions:
            rows = rows.filter(condition)
        return rows.select(*on, "value")

    light, thick = "NOT heavy", "heavy"
    pairs = _joined(
        [
            (side(-1, light), side(-1, light)),
            (side(0, light), side(1)),
            (side(0, thick), side(1, light)),
        ],
        on,
        max_bits,
    )
    if not cut.filter(thick).isEmpty():
        rest_of = lambda start, size: [
            piece
            for s, n in ((0, start), (start + size, BITS - start - size))
            if n
            for piece in _segments(s, n, max_bits)
        ]
        inner = keyed(outer.filter(thick), "in_", rest_of)
        deep_on = [*on, "in_rest", "in_which"]

        def both(number: int, inside: int) -> DataFrame:
            rows = inner.filter((F.col("side") == number) & (F.col("in_side") == inside))
            return rows.select(*deep_on, "value")

        deep = [
            (both(-1, -1), both(-1, -1)),
            (both(-1, 0), both(-1, 1)),
            (both(0, -1), both(1, -1)),
            (both(0, 0), both(1, 1)),
            (both(0, 1), both(1, 0)),
        ]
        pairs = pairs.unionByName(_joined(deep, deep_on, max_bits))
    return pairs.distinct()


def _linked(docs: DataFrame, identity: str, text: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows, values): rows (id, digest, fingerprint) of all documents, values (fingerprint, root)
    of the different fingerprints, where linked ones share a root. Both are stored.

    The texts are read once. Everything after works on one row per document or fingerprint.
    """
    marked = docs.select(
        F.col(identity).alias("id"),
        text_digest(F.col(text)).alias("digest"),
        fingerprint_column(F.col(text), shingle).alias("fingerprint"),
    )
    marked = stored(marked, "fingerprints")
    values = stored(marked.select("fingerprint").distinct(), "values")
    roots = components(near_pairs(values, "fingerprint", max_bits))
    # Most fingerprints have no link, and are their own component.
    grouped = values.join(roots.hint("merge"), F.col("fingerprint") == F.col("node"), "left")
    return marked, grouped.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def simhash_groups(
    docs: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """(identity, fingerprint, component): each row with the smallest identity it is linked to."""
    marked, roots = _linked(docs, identity, text, shingle, max_bits)
    least = marked.groupBy("fingerprint").agg(F.min("id").alias("least"))
    grouped = least.join(roots.hint("merge"), "fingerprint")
    smallest = grouped.groupBy(F.col("root").alias("top")).agg(F.min("least").alias("component"))
    component = grouped.join(smallest.hint("merge"), F.col("root") == F.col("top")).select(
        F.col("fingerprint").alias("value"), "component"
    )
    joined = marked.join(component.hint("merge"), F.col("fingerprint") == F.col("value"))
    return joined.select(F.col("id").alias(identity), "fingerprint", "component")


def keep_one(
    docs: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """The document with the smallest identity of each component, with its own columns.

    A row leaves only for one that it is linked to: rows of one identity with unlike texts each
    stay, if they are the smallest of theirs; of linked ones, and of repeated rows, one does. Rows
    without identity cannot be told apart and stay as they are.
    """
    marked, roots = _linked(docs, identity, text, shingle, max_bits)
    named = marked.filter("id IS NOT NULL").groupBy("fingerprint").agg(F.min(F.struct("id", "digest")).alias("first"))
    first = named.join(roots.hint("merge"), "fingerprint").groupBy("root").agg(F.min("first").alias("first"))
    first = first.select(F.col("first.id").alias("first_id"), F.col("first.digest").alias("first_digest"))
    # The documents' own columns are packed, so that their names meet no others.
    packed = docs.select(
        F.struct("*").alias("row"), F.col(identity).alias("id"), text_digest(F.col(text)).alias("digest")
    )
    same = (F.col("id") == F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    kept = packed.join(first.hint("merge"), same, "left_semi").dropDuplicates(["id", "digest"])
    every = kept.unionByName(packed.filter("id IS NULL"))
    return every.select(*[F.col("row")[c].alias(c) for c in docs.columns])
