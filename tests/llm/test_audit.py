"""The audit against a plain walk through every order, document by document."""

import re
from collections import Counter
from itertools import permutations

import pytest

from talmir.llm.audit import ORDERS, audit

DOCS = "doc_id bigint, text string, lang string, n int, mask string, key string"
LABELS = "doc_id bigint, quality int, toxic int, part string"


def fails(docs):
    for doc_id, text, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": any((t or "") == text and i is not None and doc_id is not None and i < doc_id for i, t, *_ in docs),
        }
        yield {letter for letter, failed in found.items() if failed}


def plain(docs, labels):
    out = Counter()
    parts = {d[2] or "" for d in docs}
    for doc, failed in zip(docs, fails(docs)):
        own = [x for x in labels if x[0] is not None and x[0] == doc[0]]
        good, toxic = any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)
        for order in map("".join, permutations("ABCDE")):
            there = True
            for step, letter in enumerate(order, 1):
                at = (doc[2] or "", order, step)
                fail = letter in failed
                out[(*at, "kept")] += there and not fail
                out[(*at, "removed")] += there and fail
                out[(*at, "redundant")] += not there and fail
                out[(*at, "unique_fails")] += failed == {letter}
                out[(*at, "good_lost")] += there and fail and good
                out[(*at, "toxic_lost")] += there and fail and toxic
                out[(doc[2] or "", letter)] += there and fail
                there = there and not fail
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return sorted(
        (part, order, step, *(out[(part, order, step, n)] for n in names), out[(part, letter)])
        for part in parts for order in map("".join, permutations("ABCDE")) for step, letter in enumerate(order, 1)
    )


many = " ".join(f"w{i}" for i in range(120))
CASES = [
    (1, many, "en"), (2, many, "en"), (3, many, "de"), (4, many + " #", "en"), (5, "SHOUT " * 130, "en"),
    (6, None, None), (7, "", "en"), (7, "", "en"), (None, "", "en"), (None, many, None), (8, "é A|", "de"),
    (9, "a " * 200_000, "de"), (10, "W\x0bw\tv", ""), (3, "other text of an identity that repeats", "en"),
]
KNOWN = [(1, 1, 0, "x"), (2, 0, 1, "x"), (2, 1, None, "x"), (5, None, 1, "x"), (None, 1, 1, "x"), (77, 1, 1, "x")]


@pytest.mark.parametrize("docs, labels", [(CASES, KNOWN), (CASES[::-1], []), ([], KNOWN), (CASES[6:9], KNOWN)])
def test_equals_every_order_walked(spark, docs, labels):
    rows = spark.createDataFrame([(*d, 1, "m", "k") for d in docs], DOCS)
    found = audit(rows, spark.createDataFrame(labels, LABELS))
    assert sorted(map(tuple, found.collect())) == plain(docs, labels)


def test_all_orders_once():
    assert len(set(ORDERS)) == len(ORDERS) == 120
