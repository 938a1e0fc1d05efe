import hashlib
import random

import pytest

from talmir.llm import chunking


def plain_ends(data):
    """Boundaries byte by byte."""
    ends, start = [], 0
    for i in range(len(data)):
        h = sum(int(chunking.GEAR[data[i - k]]) << k for k in range(min(32, i + 1))) % (1 << 64)
        size = i + 1 - start
        if size < chunking.LEAST:
            hit = False
        elif size < chunking.AVERAGE:
            hit = h & int(chunking.STRICT) == 0
        else:
            hit = h & int(chunking.LOOSE) == 0 or size == chunking.MOST
        if hit:
            ends.append(i + 1)
            start = i + 1
    if start < len(data):
        ends.append(len(data))
    return ends


def some_text(seed, words):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(words))


@pytest.mark.parametrize("words", [0, 1, 3, 40, 900])
def test_boundaries_byte_by_byte(words):
    data = some_text(words, words).encode()
    assert chunking.chunk_ends(data) == plain_ends(data)


def test_shift_resistance():
    text = some_text(1, 2000)
    moved = "inserted " + text
    assert chunking.containment(chunking.chunk_lengths(text), chunking.chunk_lengths(moved)) > 0.97


def expected(rows):
    """rows: (identity, text), in descending order, one after the other."""
    texts = [t or "" for _, t in rows]
    result = []
    for i, (identity, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(rows)]
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        own, other, following = map(chunking.chunk_lengths, (text, edited, after))
        result.append(
            (identity, len(text), hashlib.sha256(edited.encode()).hexdigest(), chunking.to_string(own),
             chunking.to_string(other), chunking.containment(own, other), chunking.containment(own, following))
        )
    return result


@pytest.mark.parametrize("rows_per_range", [1, 3, 7, 1000])
def test_every_document_meets_the_next(spark, rows_per_range):
    rows = [(i * 3, some_text(i, i * 5 % 70)) for i in range(40)]
    rows[5] = (15, None)
    rows[6] = (18, "")
    rows[7] = (21, "é\U0001f600" * 50)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = chunking.compare_with_next(df, rows_per_range=rows_per_range).collect()
    assert sorted(map(tuple, found)) == sorted(expected(rows[::-1]))


def test_one_document_no_documents_and_no_identity(spark):
    schema = "doc_id bigint, text string, n_chars string"
    one = spark.createDataFrame([(4, "some text here", "x")], schema)
    assert [tuple(r) for r in chunking.compare_with_next(one).collect()] == expected([(4, "some text here")])
    assert chunking.compare_with_next(one.limit(0)).count() == 0
    rows = [(9, "nine"), (2, "two and more words"), (None, "no identity at all")]
    df = spark.createDataFrame([(*r, "x") for r in rows], schema)
    found = sorted((tuple(r) for r in chunking.compare_with_next(df).collect()), key=str)
    assert found == sorted(expected(rows), key=str)


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "same words")] * 3 + [(2, "other")], "doc_id bigint, text string")
    found = chunking.compare_with_next(df, rows_per_range=1).collect()
    assert sorted(r.doc_id for r in found) == [1, 1, 1, 2]
    assert len({r.fingerprint for r in found if r.doc_id == 1}) == 1
