import random
import re

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from talmir.llm import phrases


def plain(rows, window):
    """identity -> (n_words, n_removed, kept), by the first place of every window."""
    split = [(i, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for i, t in rows]
    first = {}
    for i, words in sorted(split):
        for s in range(len(words) - window + 1):
            place = first.setdefault(tuple(words[s : s + window]), (i, s))
            first[tuple(words[s : s + window])] = min(place, (i, s))
    result = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (i, s):
                gone |= set(range(s, s + window))
        kept = [w for n, w in enumerate(words) if n not in gone]
        result.append((i, len(words), len(gone), " ".join(kept)))
    return sorted(result, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    return sorted(map(tuple, phrases.remove_repeats(df, **options).collect()), key=str)


@pytest.mark.parametrize("size", [1, 2, 6, 7, 20])
def test_sequence_hashes(size):
    h = phrases.word_hashes([b"a", b"b", b"c"] * 9)
    expected = [
        sum(int(h[i + j]) * pow(int(phrases.MULTIPLIER), j, 1 << 64) for j in range(size)) % (1 << 64)
        for i in range(len(h) - size + 1)
    ]
    assert phrases.sequence_hashes(h, size).tolist() == expected
    assert len(phrases.sequence_hashes(h[:3], size)) == max(0, 4 - size)


def test_random_texts_with_shared_passages(spark):
    draw = random.Random(3)
    word = lambda: f"w{draw.randrange(4000)}"
    shared = [[word() for _ in range(n)] for n in (19, 20, 21, 35, 60)]
    rows = []
    for i in range(80):
        words = [word() for _ in range(draw.choice([0, 5, 30, 120]))]
        for passage in draw.sample(shared, draw.choice([0, 1, 2])):
            cut = draw.randrange(0, 8)
            at = draw.randrange(len(words) + 1)
            words[at:at] = passage[cut:] if draw.random() < 0.5 else passage
        rows.append((i * 7 % 80, draw.choice([" ", "\n", "  "]).join(words)))
    rows += [(100 + i, rows[i][1]) for i in range(0, 30, 3)]
    assert found(spark, rows) == plain(rows, 20)


def test_repetitive_texts(spark):
    rows = [
        (3, "same " * 50), (1, "a b c " * 30), (2, "b c a " * 12 + "x"), (5, None), (6, ""), (7, "short text"),
        (8, "é ü 漢 " * 9), (9, "same " * 20), (4, " ".join(map(str, range(45)))), (11, " ".join(map(str, range(20, 40)))),
    ]
    assert found(spark, rows) == plain(rows, 20)


@pytest.mark.parametrize("window, gram", [(5, 3), (8, 8), (7, 2)])
def test_other_windows(spark, window, gram):
    draw = random.Random(window)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(draw.randrange(40)))) for i in range(25)]
    assert found(spark, rows, window=window, gram=gram) == plain(rows, window)


def test_repeated_rows_and_no_rows(spark):
    text = " ".join(map(str, range(30)))
    rows = [(1, text), (1, text), (2, text)]
    assert [r[:3] for r in found(spark, rows)] == [(1, 30, 0), (1, 30, 0), (2, 30, 30)]
    empty = spark.createDataFrame([], "doc_id bigint, text string, n_words string")
    assert phrases.remove_repeats(empty).count() == 0
    rows = [(None, text), (None, text), (5, text)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in phrases.remove_repeats(df).collect()) == [(0, 30), (0, 30), (5, 0)]


def joined_one_by_one(repeats, window):
    """Repeats (doc, start, n, first_doc, first) of one document after the other, joined."""
    out = set()
    for doc in {r[0] for r in repeats}:
        current = None
        lines = sorted((fd, f - s, s, n) for d, s, n, fd, f in repeats if d == doc)
        for fd, shift, s, n in [*lines, (None, 0, 0, 0)]:
            if current and current[:2] == [fd, shift] and s <= current[3]:
                current[3] = max(current[3], s + n)
                continue
            if current:
                out.add((doc, current[0], current[2] + current[1], current[3] - current[2] + window - 1))
            current = [fd, shift, s, s + n]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_repeats_are_joined(seed):
    draw = random.Random(seed)
    places = range(draw.choice([4, 60]))
    repeats = {
        (draw.randrange(3), draw.choice(places), draw.choice([1, 1, 2, 9]), draw.randrange(-2, 2), draw.choice(places))
        for _ in range(draw.choice([0, 1, 200]))
    }
    columns = [np.array(x, np.int64) for x in (zip(*repeats) if repeats else [[]] * 5)]
    found = phrases.join_repeats(*columns, window=20)
    assert set(zip(*(x.tolist() for x in found))) == joined_one_by_one(repeats, 20)
    assert len(found[0]) == len(joined_one_by_one(repeats, 20))


def test_a_batch_of_many_repeats_takes_little_memory():
    """5,000 documents of 200 repeats each, in one batch: about the size of their arrays."""
    rows, each = 5_000, 200
    values = np.tile(np.arange(each) * 30, rows)
    struct = pa.StructArray.from_arrays(
        [pa.array(values, pa.int32()), pa.array(np.ones(rows * each), pa.int32()),
         pa.array(np.repeat(np.arange(rows) % 7, each), pa.int64()), pa.array(values + 5, pa.int32())],
        ["start", "n", "first_doc", "first"],
    )
    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * each, pa.int32()), struct)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(rows) + 10), lists], ["doc", "repeats"])
    tracemalloc.start()
    n = sum(out.num_rows for out in phrases._passages(20)([batch]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == rows * each and most < 100 << 20
    # A list longer than a slice, empty lists, and a batch that is itself a slice.
    ends = pa.array([0, 0, 3 * phrases.LISTED, 3 * phrases.LISTED, 3 * phrases.LISTED + 7], pa.int32())
    long = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.ListArray.from_arrays(ends, struct)], ["doc", "repeats"])
    assert sum(out.num_rows for out in phrases._passages(20)([long.slice(2)])) == 7
    assert sum(out.num_rows for out in phrases._passages(20)([long])) > 7


def test_several_automata_for_a_batch(spark, monkeypatch):
    """Near copies, each with long phrases of its own: the result does not depend on the parts."""
    draw = random.Random(8)
    base = [f"w{draw.randrange(900)}" for _ in range(400)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(4):
            words[draw.randrange(400)] = f"x{i}"
        rows.append((i, " ".join(words)))
    for size in (1, 3000):
        monkeypatch.setattr(phrases, "AUTOMATON", size)
        assert found(spark, rows) == plain(rows, 20)
    parts = list(phrases.parts_of({"a" * 2000: (0, 0, 1), "b" * 2000: (0, 1, 1), "c": (0, 2, 1)}))
    assert [len(p) for p in parts] == [2, 1] and list(phrases.parts_of({})) == []
