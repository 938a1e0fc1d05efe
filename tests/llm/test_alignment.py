"""The alignment against the public libraries and a plain walk over byte offsets."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from talmir.llm import alignment
from talmir.llm.common import table
from talmir.llm.queries import BYTE_TOKENIZER, TOKENIZER
from tests.conftest import TESTDATA
from tests.plans import plan


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_TOKENIZER)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)


@pytest.fixture(scope="module")
def own():
    with open(BYTE_TOKENIZER, "rb") as a, open(TOKENIZER, "rb") as b:
        return alignment.Tokenizers.load(a.read(), b.read())


def plain_groups(libraries, text):
    a, b = libraries
    letters = alignment.byte_of_letter()
    if not text:
        return []
    a_ids = a.encode(f" {text}", add_special_tokens=False).ids
    a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_ids = b.encode(text)
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in b_ids
    ]
    if not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
        return []
    groups, i, j = [], 0, 0
    while i < len(a_ids):
        p, q, x, y = i + 1, j + 1, len(a_bytes[i]), len(b_bytes[j])
        while x != y:
            if x < y:
                x += len(a_bytes[p])
                p += 1
            else:
                y += len(b_bytes[q])
                q += 1
        groups.append((a_ids[i:p], b_ids[j:q]))
        i, j = p, q
    return groups


def plain(libraries, texts):
    every = [plain_groups(libraries, t) for t in texts]
    links = [[(x, y) for a, b in groups for x in a for y in b] for groups in every]
    count = Counter(pair for each in links for pair in set(each))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    for groups, pairs in zip(every, links):
        line = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        yield (
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(pairs),
            sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs),
            hashlib.sha256(line.encode()).hexdigest() if groups else "",
        )


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  two  spaces  ", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "▁", "tab\tline\r\nend\n",
    "it's we'll 12345 ===== ////", "中文字 日本語 テキスト", "😀 🇩🇪 é é ​﻿", "\x00 \x7f", "a" * 5000, "=" * 3000,
    "ß" * 700 + "1" * 900, "same words", "same words", "word " * 3000,
]


def test_equals_plain_walk_on_odd_texts(spark, libraries):
    rows = [(None if i == 3 else i // 2, t, "x") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, codes string").repartition(3)
    found = alignment.align_documents(docs, BYTE_TOKENIZER, TOKENIZER).collect()
    expected = Counter((i, *facts) for (i, _, _), facts in zip(rows, plain(libraries, ODD)))
    assert Counter((r.doc_id, *(r[n] for n in NAMES)) for r in found) == expected


def test_equals_plain_walk_on_documents_in_small_chunks(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 20_000)
    docs = table(spark, f"{TESTDATA}/sf0.001", "documents")
    rows = docs.select("doc_id", "text").collect()
    found = alignment.align_documents(docs, BYTE_TOKENIZER, TOKENIZER).collect()
    expected = {r.doc_id: facts for r, facts in zip(rows, plain(libraries, [r.text for r in rows]))}
    assert {r.doc_id: tuple(r[n] for n in NAMES) for r in found} == expected


def test_rows_are_small_whatever_the_chunk(spark, libraries, monkeypatch):
    """One chunk of all documents is stored in rows of a document or of some pairs, and nothing collects it."""
    kept, store = [], alignment.stored
    monkeypatch.setattr(alignment, "stored", lambda df, name: kept.append(store(df, name)) or kept[-1])
    monkeypatch.setattr(alignment, "PAIRS", 500, raising=False)
    texts = [" ".join(f"{w}{i}" for w in "one two three four five six".split()) * 9 for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    aligned = alignment.align_documents(docs, BYTE_TOKENIZER, TOKENIZER)
    assert not [x for x in ("Broadcast", "collect_list") if x in plan(aligned)]
    found = {r.doc_id: tuple(r[n] for n in NAMES) for r in aligned.collect()}
    assert found == dict(enumerate(plain(libraries, texts)))
    sizes = kept[0].agg(F.max(F.size("places")), F.max(F.size("codes")), F.count_distinct("chunk")).first()
    assert sizes[0] <= 500 and sizes[1] <= 500 and sizes[2] == 1


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    found = alignment.align_documents(docs, BYTE_TOKENIZER, TOKENIZER)
    assert found.columns == ["doc_id", *NAMES] and found.count() == 0


def test_byte_level_ids_equal_the_library(libraries, own):
    rng = random.Random(5)
    letters = "abcdefgh 'stremldv \n\t0123456789.,;!?-_éßñ中文字　 ​😀ABC"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(2000)]
    # Every kind of character, with letters, digits, marks and spaces next to it.
    points = [c for c in range(1, 0x30000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts += [f"a{chr(c)} {chr(c)}1{chr(c)}.{chr(c)}" for c in points]
    encoded = libraries[0].encode_batch(texts, add_special_tokens=False)
    assert [e.ids for e in encoded] == [own.a.encode_ordinary(t) for t in texts]


def test_cut_texts_have_the_same_ids(libraries, own, monkeypatch):
    monkeypatch.setattr(alignment, "PART", 50)
    docs = [" ".join(["Some words, it's 3.5  two", "don't  x", "naïve 中文 text", "\tend\n"] * 40), "x y" * 300]
    for text in docs:
        a_ids, b_ids = own.encode(text)
        assert a_ids == libraries[0].encode(f" {text}", add_special_tokens=False).ids
        assert b_ids == libraries[1].encode(text)
        assert len(own.parts(text)) > 5


def test_a_very_long_text(libraries, own):
    text = ("Lorem ipsum dolor sit amet, consectetur 123 adipiscing elit. " * 20_000)[:-1]
    facts = alignment.Aligner(own).align(text)
    assert facts[:4] == next(plain(libraries, [text]))[:4]


def test_groups_with_many_links():
    """Groups of all sizes: id pairs of large ones are counted from the different ids."""
    rng = random.Random(1)
    sizes = [(300, 200), (1, 1), (3, 2), (1, 500), (2, 1)]
    n_a, n_b = (np.array(x) for x in zip(*sizes))
    a, b = (np.array([rng.randrange(9) for _ in range(n.sum())]) for n in (n_a, n_b))
    starts = [np.cumsum(n) - n for n in (n_a, n_b)]
    codes, weights = alignment.pairs(a, b, *starts, n_a, n_b)
    found = Counter()
    for code, weight in zip(codes.tolist(), weights.tolist()):
        found[code] += int(weight)
    expected = Counter()
    for s, t, n, m in zip(*starts, n_a, n_b):
        expected.update(int(x) << 32 | int(y) for x in a[s : s + n] for y in b[t : t + m])
    assert found == expected


@pytest.mark.parametrize("seed", range(40))
def test_skipping_equals_stepping(seed, monkeypatch):
    monkeypatch.setattr(alignment, "PROBE", [1, 2, 8][seed % 3])
    rng = random.Random(seed)
    total = rng.choice([1, 5, 40, 400])
    both = [{x for x in range(1, total) if rng.random() < rng.choice([0.1, 0.5, 0.95])} | {total} for _ in range(2)]
    shared = {x for x in range(1, total) if rng.random() < 0.7} if seed % 2 else set()
    a, b = (sorted(x | shared) for x in both)
    i, p, j, q = np.array(alignment.skip_diagonals(a, b), np.int64).reshape(-1, 4).T
    starts = alignment._starts(len(a), i, p), alignment._starts(len(b), j, q)
    ends = [[x[s - 1] for s in [*starts[side][1:], 0]] for side, x in enumerate((a, b))]
    assert ends[0] == ends[1] == sorted(set(a) & set(b))
