import random
import re

import pytest

from talmir.llm import decontaminate


def shingles(text, size):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain(docs, items, size=5, threshold=0.8):
    found = set()
    for d, text in docs:
        own = shingles(text, size)
        for i, item in items:
            wanted = shingles(item, size)
            if wanted and len(wanted & own) >= threshold * len(wanted) - 1e-9:
                found.add((d, i, len(wanted), len(wanted & own)))
    return found


@pytest.mark.parametrize("block", [200_000, 10])
def test_search_equals_brute_force(spark, block):
    draw = random.Random(block)
    word = lambda: f"w{draw.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(draw.randrange(1, 40)))) for i in range(30)]
    items += [(30, None), (31, "!!"), (32, items[3][1]), (33, "Four Words Only Here")]
    docs = []
    for d in range(60):
        words = [word() for _ in range(draw.randrange(200))]
        if d % 2:
            passage = draw.choice(items[:30])[1].split() if d % 4 == 1 else items[5][1].split()
            for _ in range(draw.choice([0, 0, 1, 2])):
                passage[draw.randrange(len(passage))] = "changed"
            words[50:50] = passage
        docs.append((d, draw.choice([" ", ", "]).join(words)))
    docs += [(60, None), (61, ""), (62, "four words ONLY here"), (63, docs[1][1]), (63, docs[1][1])]
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id int, text string, digest string").repartition(4)
    queries = spark.createDataFrame(items, "item_id int, text string")
    found = decontaminate.find_leaks(df, queries, block=block).collect()
    expected = plain(docs, items)
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in found} == expected and expected
    assert len(found) == len(expected) + sum(1 for e in expected if e[0] == 63)
    kept = decontaminate.drop_leaks(df, queries, block=block)
    assert kept.columns == df.columns
    leaks = {e[0] for e in expected}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in leaks)


def test_nothing_to_search(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id int, text string")
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.find_leaks(df, none).count() == 0
    assert decontaminate.drop_leaks(df, none).count() == 1
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id int, text string")
    assert decontaminate.find_leaks(df.limit(0), items).count() == 0


@pytest.mark.parametrize("block", [200_000, 10])
def test_items_are_known_by_their_text(spark, block):
    """Several texts of one identity, and items without an identity."""
    draw = random.Random(7)
    passage = lambda: " ".join(f"w{draw.randrange(300)}" for _ in range(20))
    items = [(i, passage()) for i in (1, 1, 1, 2, None, None)]
    items += [(3, items[0][1]), (None, items[0][1]), (4, passage()), items[1], items[4]]
    docs = [(i, f"{passage()} {text} {passage()}") for i, (_, text) in enumerate(items)]
    docs += [(90, passage()), (91, f"{items[0][1]} {items[1][1]}"), (92, None)]
    df = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    queries = spark.createDataFrame(items, "item_id int, text string")
    # Each different (identity, text) is an item of its own.
    different = list(dict.fromkeys(items))
    numbered = plain(docs, [(k, text) for k, (_, text) in enumerate(different)])
    expected = sorted(str((d, different[k][0], n, shared)) for d, k, n, shared in numbered)
    found = decontaminate.find_leaks(df, queries, block=block).collect()
    assert sorted(str((r.doc_id, r.item_id, r.n_shingles, r.n_shared)) for r in found) == expected
    assert {i for i, _ in docs if i < 90} <= {r.doc_id for r in found}
    kept = decontaminate.drop_leaks(df, queries, block=block)
    assert sorted(r.doc_id for r in kept.collect()) == [90, 92]
