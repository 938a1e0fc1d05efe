import random

import xxhash
import pytest
from pyspark.sql import functions as F

from talmir.llm import simhash
from talmir.llm.common import components
from tests.plans import final_plan


def plain_fingerprint(text, shingle=3):
    """The definition, bit by bit."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_groups(values, max_bits):
    """Smallest index reachable over all pairs of 64-bit values."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", "  \n ", "One", "a B", "A b c d", "É É x y Z", "the cat sat " * 40])
def test_fingerprint_by_definition(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_long_texts_are_counted_in_blocks(monkeypatch):
    words = " ".join(f"w{i * 7919 % 997}" for i in range(3000))
    whole = simhash.fingerprint(words)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(words) == whole
    assert whole % (1 << 64) == plain_fingerprint(words)


@pytest.mark.parametrize("max_bits, dense", [(3, 256), (3, 1), (3, 4), (1, 2), (2, 2), (5, 3)])
def test_near_pairs_equal_brute_force(spark, max_bits, dense):
    draw = random.Random(max_bits * 10 + dense)
    centres = [draw.getrandbits(64) for _ in range(6)]
    values = set(centres) | {0, (1 << 64) - 1, 1, 7, 15}
    for _ in range(150):
        value = draw.choice(centres)
        for _ in range(draw.randint(0, 4)):
            value ^= 1 << draw.randrange(64)
        values.add(value)
    # Many that share the low half exactly.
    values |= {(draw.getrandbits(6) << 40) | 0xABCDEF for _ in range(40)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed + signed[:5]], "v bigint")
    found = {tuple(r) for r in simhash.near_pairs(df, "v", max_bits, dense).collect()}
    expected = {
        (a, b) for a in signed for b in signed
        if a < b and ((a ^ b) % (1 << 64)).bit_count() <= max_bits
    }
    assert expected
    assert found == expected


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(10, 60)]
    star = [(100, i) for i in range(101, 140)]
    edges = spark.createDataFrame(path + star + [(200, 200)], "a bigint, b bigint")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {**{i: 10 for i in range(10, 61)}, **{i: 100 for i in range(100, 140)}}


def test_groups_equal_brute_force(spark):
    draw = random.Random(5)
    base = [" ".join(f"w{draw.randrange(500)}" for _ in range(60)) for _ in range(12)]
    texts = [None, "", "one", "One", "two words", *base, *base[:6]]
    for text in base * 3:
        words = text.split()
        words[draw.randrange(60)] = "changed"
        texts.append(" ".join(words))
    rows = [(1000 - i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component string")
    found = {r.doc_id: r for r in simhash.simhash_groups(df).collect()}
    assert len(found) == len(rows)
    order = sorted(rows)
    values = [plain_fingerprint(t) for _, t, _ in order]
    for (i, _, _), value, root in zip(order, values, plain_groups(values, 3)):
        assert found[i].fingerprint % (1 << 64) == value
        assert found[i].component == order[root][0]


def test_repeated_rows_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (4, "a b"), (4, "a b"), (None, None)], "doc_id bigint, text string")
    rows = sorted(((r.doc_id, r.component) for r in simhash.simhash_groups(df).collect()), key=str)
    assert rows == [(4, 4), (4, 4), (None, 4), (None, None)]
    assert simhash.simhash_groups(df.limit(0)).count() == 0
    assert simhash.simhash_groups(df).filter(F.col("fingerprint").isNull()).count() == 0


def test_one_of_each_group_stays(spark):
    """Unlike texts of one identity both stay; linked ones, copies and repeated rows do not."""
    words = " ".join(f"w{i}" for i in range(200))
    names = ["_kept", "row", "id", "digest", "first_id", "leak", "fingerprint", "a.b"]
    rows = [
        (1, "one text"), (1, "quite another"), (2, words), (2, words.upper()), (3, words), (4, "one text"),
        (5, "fifth"), (5, "fifth"), (None, "one text"), (None, None), (6, None), (7, ""), (8, None),
    ]
    df = spark.createDataFrame([(*r, *names) for r in rows], ["doc_id", "text", *names]).repartition(4)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    two = [t for i, t in found if i == 2]
    assert len(two) == 1 and two[0] in (words, words.upper())
    assert [f for f in found if f[0] != 2] == sorted([
        (1, "one text"), (1, "quite another"), (5, "fifth"), (6, None), (None, "one text"), (None, None)], key=str)
    assert all(list(r)[2:] == names for r in kept.collect())
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_no_side_of_a_join_is_broadcast(spark):
    """A value has dozens of keys, which Spark does not count when it sizes a side."""
    values = spark.range(300).select(F.xxhash64("id").alias("v"))
    values = values.unionByName(values.select(F.col("v").bitwiseXOR(F.lit(5)).alias("v")))
    # Values of one segment are cut further, so both kinds of keys are joined.
    values = values.unionByName(spark.range(300).select(F.col("id").alias("v")))
    assert "Broadcast" not in final_plan(simhash.near_pairs(values, "v", 3, dense=100))
    text = F.concat(F.lit("some words and "), (F.col("id") % 50).cast("string"))
    docs = spark.range(200).select(F.col("id").alias("doc_id"), text.alias("text"))
    assert "Broadcast" not in final_plan(simhash.simhash_groups(docs))
    assert "Broadcast" not in final_plan(simhash.keep_one(docs))
