"""SentencePiece encoding and decoding, batched in numpy.

A text's words are cut where no piece of the vocabulary can cross, and each different word is
encoded once per batch. Words of equal length are rows of one matrix and advance together: the
hashes of their substrings come from prefix hashes, and are looked up by binary search among
the sorted hashes of all pieces.

For a unigram model this is Viterbi: position by position, the best of all pieces that end
there, by vectorised maxima, with backpointers. For a BPE model the best sum of scores is not
the tokenizer's result: it merges the best pair first, whatever that does to the sum. There,
each step merges every word's best pair, found by the same probes and maxima. (Words that are
done leave the matrix. Very long ones are merged one by one with a heap, to the same result.)

The model file is a parameter and is read by the driver; its tables, a few MB whatever the
corpus, are broadcast. Defined results: NULL and empty texts have no pieces. Decoding leaves
out control pieces and ids outside the vocabulary, and bytes that are not UTF-8 become U+FFFD.
U+2581 in a text is decoded as a space, as the format has it.
"""

from __future__ import annotations

import heapq
import re
import struct
import sys
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed numbers of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
UNKNOWN_SURFACE = " ⁇ "

FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
LONG_WORD = 256
CACHED_WORDS = 150_000
# Texts that are encoded at a time.
BATCH_TEXTS = 250


def _fields(data: bytes):
    """(number, value) of a protocol buffer message: ints, or the bytes of other values."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class Model:
    """The pieces of a vocabulary, and how texts are encoded with them."""

    pieces: list[str]
    scores: list[float]
    types: list[int]
    kind: int
    byte_fallback: bool
    dummy_prefix: bool

    def __post_init__(self):
        if USER_DEFINED in self.types:
            raise ValueError("user-defined pieces are not supported")

    @cached_property
    def unknown(self) -> int:
        return self.types.index(UNKNOWN)

    @cached_property
    def bytes_ids(self) -> dict[int, int]:
        return {int(p[3:-1], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}

    @cached_property
    def surfaces(self) -> list[bytes]:
        made = {
            CONTROL: lambda p: b"",
            BYTE: lambda p: bytes([int(p[3:-1], 16)]),
            UNKNOWN: lambda p: UNKNOWN_SURFACE.encode(),
        }
        plain = lambda p: p.replace(SPACE, " ").encode()
        return [made.get(t, plain)(p) for p, t in zip(self.pieces, self.types)]

    @cached_property
    def word_pattern(self) -> re.Pattern:
        """What a word is: no piece crosses from one to the next."""
        several = [p for p, t in zip(self.pieces, self.types) if t == NORMAL and len(p) > 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in several):
            return re.compile("(?s).+")
        inside = set("".join(several))
        alone = "".join(re.escape(chr(i)) for i in range(128) if chr(i) not in inside)
        single = f"[{alone}]|" if alone else ""
        return re.compile(f"{single}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")

    @cached_property
    def table(self):
        """Sorted first hashes, and with them second hashes, ids and scores of the pieces."""
        ids = [i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == NORMAL and p]
        keys = np.zeros((2, len(ids)), np.uint64)
        lengths = np.array([len(self.pieces[i]) for i in ids])
        for length in np.unique(lengths):
            group = np.flatnonzero(lengths == length)
            keys[:, group] = Hashes(codes_of([self.pieces[ids[n]] for n in group])).whole()
        order = np.argsort(keys[0], kind="stable")
        if len(np.unique(keys[0])) != len(ids):
            raise ValueError("two pieces have one hash")
        numbers = np.array(ids, np.int64)[order]
        return keys[0][order], keys[1][order], numbers, np.array(self.scores, np.float32)[numbers]

    @cached_property
    def longest(self) -> int:
        return max(len(p) for p, t in zip(self.pieces, self.types) if t == NORMAL)

    @cached_property
    def numbers(self) -> dict[str, int]:
        return {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == NORMAL}

    def probe(self, hashes: Hashes, rows, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1 for none) and scores (-inf) of substrings. The second hash confirms the first."""
        keys, others, ids, scores = self.table
        first = hashes.of(0, rows, start, end)
        at = np.searchsorted(keys, first)
        at[at == len(keys)] = 0
        there = keys[at] == first
        hits = np.nonzero(there)
        pick = [np.broadcast_to(x, there.shape)[hits] for x in (rows, start, end)]
        there[hits] = others[at[hits]] == hashes.of(1, *pick)
        return np.where(there, ids[at], -1), np.where(there, scores[at], np.float32(-np.inf))


def read_model(path: str) -> Model:
    with open(path, "rb") as file:
        return parse_model(file.read())


def parse_model(data: bytes) -> Model:
    pieces, scores, types = [], [], []
    trainer, normalizer = {}, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
            types.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    if normalizer.get(2) or normalizer.get(4, 1):
        raise ValueError("only models that leave characters and white space as they are")
    kind = trainer.get(3, UNIGRAM)
    if kind not in (UNIGRAM, BPE):
        raise ValueError(f"model type {kind} is neither unigram nor BPE")
    return Model(pieces, scores, types, kind, bool(trainer.get(35, 0)), bool(normalizer.get(3, 1)))


def codes_of(words: list[str]) -> np.ndarray:
    """Words of equal length as rows of code points."""
    joined = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32).reshape(len(words), -1).astype(np.uint64)


class Hashes:
    """Hashes of the substrings of words of equal length, from hashes of their prefixes."""

    def __init__(self, codes: np.ndarray):
        n, length = codes.shape
        self.powers, self.prefixes = [], []
        for factor in FACTORS:
            powers = np.full(length + 1, factor)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            prefix = np.zeros((n, length + 1), np.uint64)
            for i in range(length):
                prefix[:, i + 1] = prefix[:, i] * factor + codes[:, i] + np.uint64(1)
            self.powers.append(powers)
            self.prefixes.append(prefix)

    def of(self, which: int, rows, start, end) -> np.ndarray:
        prefix = self.prefixes[which]
        return prefix[rows, end] - prefix[rows, start] * self.powers[which][end - start]

    def whole(self) -> list[np.ndarray]:
        return [p[:, -1] for p in self.prefixes]


def _ids(model: Model, word: str, path) -> list[int]:
    """The ids of (id or -1, start, end); what no piece is for goes by bytes, or is unknown."""
    ids = []
    for number, start, end in path:
        if number >= 0:
            ids.append(number)
        elif model.byte_fallback:
            ids += [model.bytes_ids[b] for b in word[start:end].encode("utf-8", "surrogatepass")]
        else:
            ids.append(model.unknown)
    return ids


def _viterbi(model: Model, words: list[str]) -> list[list[int]]:
    """The ids of words of equal length, by the best sum of scores."""
    codes = codes_of(words)
    n, length = codes.shape
    hashes, rows = Hashes(codes), np.arange(n)
    best = np.full((n, length + 1), -np.inf, np.float32)
    best[:, 0] = 0
    back = np.zeros((n, length + 1), np.int64)
    ids = np.full((n, length + 1), -1, np.int64)
    unknown = np.float32(min(model.table[3], default=0.0) - UNKNOWN_PENALTY)
    for end in range(1, length + 1):
        # Longest first, so that equal sums go to the longest last piece.
        starts = np.arange(max(0, end - model.longest), end)
        found, scores = model.probe(hashes, rows[:, None], starts[None, :], end)
        scores[:, -1] = np.where(found[:, -1] < 0, unknown, scores[:, -1])
        sums = best[:, starts] + scores
        choice = np.argmax(sums, axis=1)
        best[:, end], back[:, end], ids[:, end] = sums[rows, choice], starts[choice], found[rows, choice]
    result = []
    for row in range(n):
        end, path = length, []
        while end:
            start = int(back[row, end])
            path.append((int(ids[row, end]), start, end))
            end = start
        result.append(_ids(model, words[row], path[::-1]))
    return result


def _merges(model: Model, words: list[str]) -> list[list[int]]:
    """The ids of words of equal length, by merging the best pair until there is none."""
    codes = codes_of(words)
    n, length = codes.shape
    hashes = Hashes(codes)
    rows = np.arange(n)
    bounds = np.tile(np.arange(length + 1), (n, 1))
    result: list = [None] * n
    none = np.float32(-np.inf)
    _, scores = model.probe(hashes, rows[:, None], bounds[:, :-2], bounds[:, 2:])
    while len(rows):
        width = bounds.shape[1] - 1  # tokens of each word
        going = scores.max(axis=1) > none if width > 1 else np.zeros(len(rows), bool)
        done = np.flatnonzero(~going)
        if len(done):
            own, b = rows[done], bounds[done]
            ids, _ = model.probe(hashes, own[:, None], b[:, :-1], b[:, 1:])
            whole = (ids >= 0).all(axis=1)
            for row, found in zip(own[whole].tolist(), ids[whole].tolist()):
                result[row] = found
            for i in np.flatnonzero(~whole).tolist():
                cuts = b[i].tolist()
                result[own[i]] = _ids(model, words[own[i]], zip(ids[i].tolist(), cuts, cuts[1:]))
            rows, bounds, scores = rows[going], bounds[going], scores[going]
        if not len(rows):
            break
        at = np.argmax(scores, axis=1)  # the leftmost of the best
        line = np.arange(len(rows))
        keep = np.ones(bounds.shape, bool)
        keep[line, at + 1] = False
        bounds = bounds[keep].reshape(len(rows), width)
        keep = np.ones(scores.shape, bool)
        keep[line, at] = False
        scores = scores[keep].reshape(len(rows), width - 2)
        for pair in (at - 1, at):
            ok = np.flatnonzero((pair >= 0) & (pair < width - 2))
            if len(ok):
                p = pair[ok]
                scores[ok, p] = model.probe(hashes, rows[ok], bounds[ok, p], bounds[ok, p + 2])[1]
    return result


def _merges_of_long(model: Model, word: str) -> list[int]:
    """As :func:`_merges`, for one word, in n log n."""
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end, alive, heap = list(range(1, n + 1)), [True] * n, []

    def offer(left):
        right = after[left]
        if left >= 0 and right < n:
            number = model.numbers.get(word[left : end[right]])
            if number is not None:
                heapq.heappush(heap, (-model.scores[number], left, end[right], right))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, left, stop, right = heapq.heappop(heap)
        if not (alive[left] and right < n and alive[right] and after[left] == right and end[right] == stop):
            continue
        alive[right], end[left], after[left] = False, stop, after[right]
        if after[left] < n:
            before[after[left]] = left
        if before[left] >= 0:
            offer(before[left])
        offer(left)
    spans = [(i, end[i]) for i in range(n) if alive[i]]
    return _ids(model, word, [(model.numbers.get(word[a:b], -1), a, b) for a, b in spans])


def encode_words(model: Model, words: list[str]) -> dict[str, list[int]]:
    """Each different word to its ids. ``words`` are in the model's form, with its spaces."""
    by_length: dict[int, list[str]] = {}
    for word in words:
        by_length.setdefault(len(word), []).append(word)
    encoded = {}
    for length, group in by_length.items():
        if model.kind == BPE and length > LONG_WORD:
            ids = [_merges_of_long(model, word) for word in group]
        else:
            ids = (_merges if model.kind == BPE else _viterbi)(model, group)
        encoded.update(zip(group, ids))
    return encoded


class Encoder:
    """Encodes batches of texts, and remembers words from batch to batch, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        model = self.model
        prefix = SPACE if model.dummy_prefix else ""
        find = model.word_pattern.findall
        split = [find(prefix + text.replace(" ", SPACE)) if text else [] for text in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = set(chain.from_iterable(split)).difference(self.known)
        self.known.update(encode_words(model, list(new)))
        result = [list(chain.from_iterable(map(self.known.__getitem__, words))) for words in split]
        if not model.byte_fallback:  # unknown characters in a row are one piece
            u = model.unknown
            result = [[x for x, y in zip(r, [None, *r]) if not (x == u == y)] for r in result]
        return result


def decode(model: Model, ids: list[int] | None) -> str:
    if not ids:
        return ""
    if min(ids) < 0 or max(ids) >= len(model.surfaces):
        ids = [i for i in ids if 0 <= i < len(model.surfaces)]
    data = b"".join(map(model.surfaces.__getitem__, ids))
    text = data.decode("utf-8", "replace")
    return text[1:] if model.dummy_prefix and text[:1] == " " else text


class Pieces:
    """The model as column expressions of a session."""

    def __init__(self, spark: SparkSession, path: str):
        model = read_model(path)
        model.table, model.numbers, model.word_pattern, model.surfaces  # made once, here
        self.model = spark.sparkContext.broadcast(model)

    def encode(self, text: Column) -> Column:
        """The ids of a text's pieces, ARRAY<INT>."""
        return self._coded(text, check=False)["pieces"]

    def encode_and_check(self, text: Column) -> Column:
        """(pieces, round_trip): the ids, and whether they decode to the text again.

        Both happen in one worker, so that a task needs the memory of one.
        """
        return self._coded(text, check=True)

    def _coded(self, text: Column, check: bool) -> Column:
        model = self.model

        @F.arrow_udf("struct<pieces: array<int>, round_trip: boolean>")
        def compute(batches: pa.Array) -> pa.Array:
            encoder = getattr(model.value, "_encoder", None)
            if encoder is None:
                encoder = model.value._encoder = Encoder(model.value)
            flat, sizes, same = [], [np.zeros(1, np.int32)], []
            for i in range(0, len(batches), BATCH_TEXTS):
                texts = batches.slice(i, BATCH_TEXTS).to_pylist()
                found = encoder.encode(texts)
                sizes.append(np.fromiter(map(len, found), np.int32, len(found)))
                flat.append(np.fromiter(chain.from_iterable(found), np.int32))
                for x, ids in zip(texts, found):
                    same.append(decode(model.value, ids) == (x or "").replace(SPACE, " ") if check else None)
            offsets = np.cumsum(np.concatenate(sizes)).astype(np.int32)
            ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
            pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            return pa.StructArray.from_arrays([pieces, pa.array(same, pa.bool_())], ["pieces", "round_trip"])

        return compute.asNondeterministic()(text)

    def decode(self, ids: Column) -> Column:
        model = self.model

        @F.arrow_udf("string")
        def compute(batches: pa.Array) -> pa.Array:
            texts = (decode(model.value, x.values.to_pylist() if x.is_valid else None) for x in batches)
            return pa.array(texts, pa.string(), size=len(batches))

        return compute(ids)
