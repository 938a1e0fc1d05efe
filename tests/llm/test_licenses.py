import math
import re
import textwrap

from pyspark.sql import functions as F

from talmir.llm import licenses

TEXTS = [
    None, "", "no words here of note", "All Rights Reserved. All rights reserved!", "x CC-BY y cc  by",
    "Licensed under the Apache License, Version 2.0", "licensed apache license version 2 0 under\nMIT",
    "the mit license was released under terms", "GNU General Public License version 3 licensed the under it all",
    "Released under the MIT License.\n" * 3, "general public\nlicense", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY",
    "word " * 5000 + "all rights reserved", "é cc by ñ",
]


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(text):
    words = split(text or "")
    places = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(places), plain_windows(text or "")


def plain_windows(text):
    """The best label of every window, each template's best containment."""
    words, matches = split(text), {}
    for span, labels in licenses.families(licenses.TEMPLATES, licenses.THRESHOLD):
        for i in range(len(words)):
            block, best = set(words[i : i + span]), []
            for label in labels:
                t = set(licenses.TEMPLATES[label].split())
                shared = len(t & block)
                if set(licenses.NEEDED[label]) <= block and shared >= math.ceil(licenses.THRESHOLD * len(t) - 1e-9):
                    best.append((-shared / len(t), -len(t), label))
            if best:
                containment, _, label = min(best)
                matches[label] = max(matches.get(label, 0), -containment)
    return sorted(matches.items())


def test_scan_equals_brute_force(spark):
    rows = [(i, t, "n", 1) for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, "doc_id int, text string, label string, rank int").repartition(4)
    found = licenses.scan_licenses(df).collect()
    assert len(found) == len(rows)
    for row in found:
        n, places, matches = plain(TEXTS[row.doc_id])
        assert row.n_words == n
        assert sorted((p.place, p.label) for p in row.places) == places
        assert [(m.label, m.containment) for m in row.matches] == matches
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_few_candidates_reach_the_join(spark):
    ranks = {w: i for i, w in enumerate(["mit", "released", "license", "under", "the"])}
    sets = spark.createDataFrame([([0, 1, 2, 3, 4],), ([2, 3, 4],), ([0, 2, 3, 4],), ([3, 4],)], "s array<int>")
    ranked = {"mit": sorted(ranks.values())}
    found = licenses.containment_join(sets, "s", ranked, 0.8).collect()
    assert sorted((r.s, r.containment) for r in found) == [([0, 1, 2, 3, 4], 1.0), ([0, 2, 3, 4], 0.8)]


def test_wrapped_notices_are_found(spark):
    texts, carried = [], []
    for label, template in licenses.TEMPLATES.items():
        for columns in (40, 50, 60, 70, 80):
            for mark, before in (("", ""), (" * ", "some words of prose go before " * 9)):
                texts.append(mark + f"\n{mark}".join(textwrap.wrap(before + template.capitalize(), columns)))
                carried.append(label)
    texts += ["\n".join(licenses.TEMPLATES.values()), "Released under\n" + "x " * 20 + "\nthe MIT license"]
    texts += [  # other licences, scattered words, and one label where three templates are alike
        "Released under the Apache license",
        "The book was released to the press, and under the law the fishing license costs ten",
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0. " + "x " * 30 + "Licensed under CC BY-SA 4.0",
    ]
    for drop in (2, 5):  # changed words over several lines; too few are left of five
        words = licenses.TEMPLATES["mit-notice"].split()
        texts.append("\n".join(" changed words ".join(words[i : i + 3]) for i in range(0, len(words) - drop, 3)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    found = {r.doc_id: [(m.label, m.containment) for m in r.matches] for r in licenses.scan_licenses(df).collect()}
    assert found == {i: plain_windows(t) for i, t in enumerate(texts)}
    for i, label in enumerate(carried):
        assert (label, 1.0) in found[i], texts[i]
    after = [[label for label, _ in found[len(carried) + i]] for i in range(1, 6)]
    assert after == [[], [], [], ["cc-by-nc-4.0"], ["cc-by-4.0", "cc-by-sa-4.0"]]


def test_columns_of_any_name(spark):
    names = ["_words", "_lines", "_sets", "_list", "_matches", "sets", "list", "salt", "row", "words", "Places", "a.b"]
    df = spark.createDataFrame([(1, "Released under the MIT license", *names)], ["doc_id", "text", *names])
    found = licenses.scan_licenses(df)
    kept = [n for n in names if n != "Places"]
    assert found.columns == ["doc_id", *kept, "n_words", "places", "matches"]
    row = found.first()
    assert list(row)[1 : 1 + len(kept)] == kept and row.matches[0].label == "mit"


def test_a_very_frequent_list_of_sets(spark):
    """Most rows have one notice: its rows are dealt over many join partitions."""
    text = F.when(F.col("id") % 3 > 0, "Released under the MIT license").otherwise(F.concat(F.lit("t"), F.col("id")))
    df = spark.range(0, 3000, 1, 40).select("id", text.alias("text"))
    found = licenses.scan_licenses(df).groupBy(F.size("matches").alias("n")).count().collect()
    assert {r.n: r["count"] for r in found} == {0: 1000, 1: 2000}


def plain_pairs(text):
    """(template, its best containment in any window, whether a window that contains it has its needed words)."""
    words, pairs = split(text or ""), {}
    for span, labels in licenses.families(licenses.TEMPLATES, licenses.THRESHOLD):
        for i in range(len(words)):
            block = set(words[i : i + span])
            for label in labels:
                t = set(licenses.TEMPLATES[label].split())
                shared = len(t & block)
                if shared >= math.ceil(licenses.THRESHOLD * len(t) - 1e-9):
                    containment, told = pairs.get(label, (0, False))
                    told |= set(licenses.NEEDED[label]) <= block
                    pairs[label] = (max(containment, shared / len(t)), told)
    return sorted((label, *pair) for label, pair in pairs.items())


def test_every_pair_that_reaches_the_threshold(spark):
    """Notices of one family side by side: one labels all blocks of the other."""
    beside = [("mit-notice", "boost"), ("cc-by-4.0", "cc-by-sa-4.0"), ("gpl-notice", "lgpl-notice"), ("isc", "mit")]
    texts = ["\n".join(licenses.TEMPLATES[x] for x in names) for names in beside + [x[::-1] for x in beside]]
    texts += ["Released under the Apache license", "Licensed under CC BY-NC 4.0.", "\n".join(licenses.TEMPLATES.values())]
    texts += [" ".join(licenses.TEMPLATES["mit-notice"].split()[:-2]) + " x" * 70 + " cc by 4", *TEXTS]
    rows = [(i, t, "replaced") for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id int, text string, Contained string").repartition(4)
    found = licenses.scan_licenses(df, every=True)
    assert found.columns == ["doc_id", "n_words", "places", "matches", "contained"]
    found = found.collect()
    assert len(found) == len(rows)
    for row in found:
        assert [tuple(c) for c in row.contained] == plain_pairs(texts[row.doc_id]), texts[row.doc_id]
        assert [tuple(m) for m in row.matches] == plain_windows(texts[row.doc_id] or "")
        for name in (beside + [x[::-1] for x in beside])[row.doc_id] if row.doc_id < 2 * len(beside) else ():
            assert (name, 1.0, True) in [tuple(c) for c in row.contained]
    nothing = licenses.scan_licenses(df.filter("doc_id = 8"), every=True).first()
    assert [tuple(c) for c in nothing.contained] == [("mit", 0.8, False)] and nothing.matches == []


def test_every_block_is_joined_whatever_is_returned(spark, monkeypatch):
    """A template's needed words decide about the label, not about which blocks are compared."""
    joined, join = [], licenses.containment_join
    monkeypatch.setattr(licenses, "containment_join", lambda *a: joined.append(join(*a)) or joined[-1])
    texts = ["Released under the Apache license", "Licensed under CC BY-NC 4.0.", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = licenses.scan_licenses(docs).collect()
    pairs = {(r.label, r.containment, r.told) for r in joined[0].collect()}
    assert pairs >= {pair for t in texts for pair in plain_pairs(t)} and ("mit", 0.8, False) in pairs
    assert {r.doc_id: [m.label for m in r.matches] for r in found} == {0: [], 1: ["cc-by-nc-4.0"], 2: []}
