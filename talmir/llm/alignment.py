"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Tokenizer A is a byte-level BPE (a JSON file of the tokenizers library), tokenizer B a
SentencePiece model, which puts a space before the text; A gets it put before. Each token has a
number of bytes, so a text is two arrays of token ends. Byte offsets where both end cut the
tokens into groups, and all A-B pairs of a group are linked.

Two tokenizers mostly cut alike, so the walk skips along diagonals. At the current shift between
the indices, the two arrays of ends are compared in stretches of 8, 16, 32, ... tokens; where a
stretch differs, halving comes near the first difference. All before it are groups of one token each.
Only the irregular group there is resolved token by token, which gives the next shift.

Id pairs are counted by documents. A task hands over chunks of documents, each with the
different pairs of the chunk and, for its documents, places among these. So pairs are shuffled
once per chunk, not per document, and the counts come back to a chunk. Tasks hold one chunk: about
``CHUNK_BYTES`` of text, or one longer document. Chunks are stored in small rows, one for each document
and one for each ``PAIRS`` pairs, as readers and writers of files hold many rows, and batches for
Python thousands.

A's vocabulary is encoded by tiktoken, which gives the same ids as the tokenizers library (a
test compares them) in a quarter of the time. Very long texts are cut, for both, before spaces
between ASCII letters, where no token of either goes across; the library refuses to cut for a
SentencePiece model with a piece that has a space after another character.

Defined results: texts that are NULL, empty, or not the bytes of their tokens (such as one with
U+2581) have no tokens, so zeros and an empty digest. Repeated rows and rows of one identity are
documents of their own; NULL identities too. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talmir.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 2 << 20
# Pairs that a stored row holds, and that a batch of documents holds together, but for longer ones.
PAIRS = 1 << 14
# Texts are cut into parts of about so many characters.
PART = 1 << 16
# Tokens that are compared first.
PROBE = 8
# Groups with more pairs than this are counted by their different ids.
SMALL_GROUP = 64
# An id pair is one number: the id of A in the upper bits.
SHIFT = 32
CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
# Fixed value: how byte-level BPE cuts a text into words.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a letter: printable Latin-1 characters stand for
    themselves, the other bytes, in order, for the characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Tokenizers:
    """Both tokenizers, with the bytes of every token. Made once per worker."""

    a: object
    b: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    cut: bool

    @staticmethod
    def load(a_file: bytes, b_file: bytes) -> Tokenizers:
        import sentencepiece
        import tiktoken

        described = json.loads(a_file)
        special = {token["content"] for token in described["added_tokens"]}
        letters = byte_of_letter()
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in described["model"]["vocab"].items()
            if token not in special
        }
        a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            a_bytes[i] = token
        b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        b_bytes = [
            bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        cut = not any("▁" in p.lstrip("▁") for p in pieces)
        return Tokenizers(a, b, a_bytes, b_bytes, cut)

    def parts(self, text: str) -> list[str]:
        """The text, cut before spaces that no token goes across."""
        if not self.cut or len(text) <= PART:
            return [text]
        cuts, last = [0], 0
        while (found := CUT.search(text, last + PART)) is not None:
            last = found.start()
            cuts.append(last)
        return [text[i:j] for i, j in zip(cuts, [*cuts[1:], len(text)])]

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of A and B; none where the tokens' bytes are not those of a space and the text."""
        if not text:
            return [], []
        a_ids: list[int] = []
        b_ids: list[int] = []
        for i, part in enumerate(self.parts(text)):
            a_ids += self.a.encode_ordinary(part if i else f" {part}")
            b_ids += self.b.encode(part[1:] if i else part, num_threads=1)
        whole = b" " + text.encode("utf-8", "surrogatepass")
        if self.a.decode_bytes(a_ids) != whole or b"".join(map(self.b_bytes.__getitem__, b_ids)) != whole:
            return [], []
        return a_ids, b_ids


def skip_diagonals(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int, int, int]]:
    """Irregular groups (i, end of i, j, end of j); all other tokens are one-to-one, in order.

    Both arrays rise and end with the same number.
    """
    groups = []
    i = j = 0
    stop = len(a_ends)
    while i < stop:
        step = PROBE
        while a_ends[i : i + step] == b_ends[j : j + step]:
            i += step
            j += step
            if i >= stop:
                return groups
            step *= 2
        while step > PROBE:  # of the next ``step`` some differ
            step //= 2
            if a_ends[i : i + step] == b_ends[j : j + step]:
                i += step
                j += step
        while a_ends[i] == b_ends[j]:
            i += 1
            j += 1
            if i == stop:
                return groups
        p, q = i, j
        x, y = a_ends[p], b_ends[q]
        while x != y:
            if x < y:
                p += 1
                x = a_ends[p]
            else:
                q += 1
                y = b_ends[q]
        groups.append((i, p + 1, j, q + 1))
        i, j = p + 1, q + 1
    return groups


def _starts(n: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where groups start among n tokens, if begins to ends are groups and the rest stand alone."""
    first = np.ones(n, bool)
    more = ends - begins - 1
    within = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    first[np.repeat(begins, more) + within + 1] = False
    return np.flatnonzero(first)


class Aligner:
    """The tokenizers with tables of what is needed of each token."""

    def __init__(self, tokenizers: Tokenizers):
        self.of = tokenizers
        self.size = [np.array([len(x) for x in t], np.int64) for t in (tokenizers.a_bytes, tokenizers.b_bytes)]

        def written(mark: str, count: int) -> np.ndarray:
            return np.array([f"{mark}{i}".encode() for i in range(count)], object)

        n_a, n_b = map(len, self.size)
        self.next = written(",", max(n_a, n_b))
        self.first = written(";", n_a), written("|", n_b)

    def align(self, text: str | None):
        """(n_a, n_b, n_groups, n_links, groups_sha256, codes, weights).

        codes: the different id pairs; weights: how many links each has.
        """
        ids = self.of.encode(text)
        if not len(ids[0]):
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = (np.array(x, np.int64) for x in ids)
        irregular = skip_diagonals(np.cumsum(self.size[0][a]).tolist(), np.cumsum(self.size[1][b]).tolist())
        i, p, j, q = np.array(irregular, np.int64).reshape(-1, 4).T
        starts = _starts(len(a), i, p), _starts(len(b), j, q)
        counts = [np.diff(np.append(s, len(x))) for s, x in zip(starts, (a, b))]
        codes, weights = pairs(a, b, *starts, *counts)
        different, at = np.unique(codes, return_inverse=True)
        weights = np.bincount(at, weights, len(different)).astype(np.int64)
        n_links = int((counts[0] * counts[1]).sum())
        return len(a), len(b), len(starts[0]), n_links, self.digest(a, b, starts, counts), different, weights

    def digest(self, a, b, starts, counts) -> str:
        """SHA-256 of the groups, a token of A after all of B in the groups before it, and so on."""
        line = np.empty(len(a) + len(b), object)
        before = starts[1], starts[0] + counts[0]
        for side, ids in enumerate((a, b)):
            tokens = self.next[ids]
            tokens[starts[side]] = self.first[side][ids[starts[side]]]
            line[np.arange(len(ids)) + np.repeat(before[side], counts[side])] = tokens
        return hashlib.sha256(b"".join(line.tolist())[1:]).hexdigest()


def pairs(a, b, a_start, b_start, n_a, n_b) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all links of the groups, with weights: large groups give each id pair once."""
    links = n_a * n_b
    few = links <= SMALL_GROUP
    n = links[few]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    x, y = np.divmod(within, np.repeat(n_b[few], n))
    found = [a[np.repeat(a_start[few], n) + x] << SHIFT | b[np.repeat(b_start[few], n) + y]]
    weights = [np.ones(len(found[0]))]
    for g in np.flatnonzero(~few):
        xs, n_xs = np.unique(a[a_start[g] : a_start[g] + n_a[g]], return_counts=True)
        ys, n_ys = np.unique(b[b_start[g] : b_start[g] + n_b[g]], return_counts=True)
        found.append((xs[:, None] << SHIFT | ys).ravel())
        weights.append((n_xs[:, None] * n_ys).ravel())
    return np.concatenate(found), np.concatenate(weights)


def _chunks(a_file, b_file):
    """Rows (id, text) to chunks of aligned documents."""

    def work(batches):
        aligner = Aligner(Tokenizers.load(a_file.value, b_file.value))
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        docs, held, kind = [], 0, None

        def chunk():
            """Rows of the chunk's documents, then rows of its pairs, PAIRS at most in each."""
            codes, at = np.unique(np.concatenate([d[6] for d in docs]), return_inverse=True)
            n_docs = np.bincount(at, minlength=len(codes))
            ends = np.cumsum([0, *(len(d[6]) for d in docs)])
            facts = list(zip(*(d[:6] for d in docs)))
            weights = np.concatenate([d[7] for d in docs])
            n = pa.int64()

            def lists(values, type_, offsets):
                return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, type_))

            def rows(count, **columns):
                columns["chunk"] = pa.array(np.full(count, number), n)
                arrays = [columns.get(f.name, pa.nulls(count, f.type)) for f in schema]
                return pa.RecordBatch.from_arrays(arrays, schema=schema)

            schema = pa.schema([("id", kind) if name == "id" else (name, type_) for name, type_ in CHUNK])
            # A batch is handed over as a whole, so rows of very long documents come in several.
            start = 0
            while start < len(docs):
                stop = start + 1
                while stop < len(docs) and ends[stop + 1] - ends[start] <= PAIRS:
                    stop += 1
                places = at[ends[start] : ends[stop]].astype(np.int32)
                offsets = ends[start : stop + 1] - ends[start]
                yield rows(
                    stop - start, id=pa.array(facts[0][start:stop], kind), digest=pa.array(facts[5][start:stop]),
                    **{name: pa.array(facts[k][start:stop], n) for k, name in enumerate(FACTS, 1)},
                    places=lists(places, pa.int32(), offsets),
                    weights=lists(weights[ends[start] : ends[stop]], n, offsets),
                )
                start = stop
            for first in range(0, len(codes), PAIRS):
                some = codes[first : first + PAIRS]
                of = [0, len(some)]
                yield rows(
                    1, first=pa.array([first], n), codes=lists(some, n, of), n_docs=lists(n_docs[first : first + PAIRS], n, of)
                )

        for batch in batches:
            kind = batch.schema.field(0).type
            for key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                docs.append((key.as_py(), *aligner.align(text)))
                held += len(text or "") + 64
                if held >= CHUNK_BYTES:
                    yield from chunk()
                    docs, held, number = [], 0, number + 1
        if docs:
            yield from chunk()

    return work


FACTS = ["n_a", "n_b", "n_groups", "n_links"]
# Columns of both kinds of rows; the type of ``id`` is the documents'.
CHUNK = [
    ("chunk", pa.int64()), ("id", None), *[(name, pa.int64()) for name in FACTS], ("digest", pa.string()),
    ("places", pa.list_(pa.int32())), ("weights", pa.list_(pa.int64())),
    ("first", pa.int64()), ("codes", pa.list_(pa.int64())), ("n_docs", pa.list_(pa.int64())),
]
RESULT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _finish(docs, pairs):
    """A chunk's documents, with the corpus counts of its pairs, to one row per document."""
    docs, pairs = docs.combine_chunks(), pairs.combine_chunks()
    at, counts, best = (pairs.column(name).to_numpy() for name in ("at", "count", "best"))
    # Counts come in the order of arrival.
    of = np.zeros(len(at), np.int64)
    is_best = np.zeros(len(at), np.int64)
    of[at] = counts
    is_best[at] = best

    def flat(name):
        column = docs.column(name)
        parts = [part.flatten().to_numpy(zero_copy_only=False) for part in column.chunks]
        return np.concatenate([np.zeros(0, np.int64), *parts])

    p, w = flat("places").astype(np.int64), flat("weights").astype(np.int64)
    sizes = pc.list_value_length(docs.column("places")).to_numpy()
    ends = np.cumsum(sizes)

    def per_document(values):
        total = np.concatenate([[0], np.cumsum(values)])
        return pa.array(total[ends] - total[ends - sizes], pa.int64())

    return pa.table(
        [docs.column("id"), *[docs.column(n) for n in FACTS], per_document(w * is_best[p]), per_document(w * of[p]), docs.column("digest")],
        ["id", *FACTS, "n_best", "count_sum", "groups_sha256"],
    )


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, identity: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(identity, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row.

    n_best: links whose id pair is in as many documents as any pair of its A id. count_sum: over
    all links, how many documents hold the link's id pair. The files are read by the driver.
    """
    spark = docs.sparkSession
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as file:
            files.append(spark.sparkContext.broadcast(file.read()))
    rows = docs.select(F.col(identity).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"chunk bigint, id {kind}, {', '.join(f'{n} bigint' for n in FACTS)}, digest string, places array<int>, "
        "weights array<bigint>, first bigint, codes array<bigint>, n_docs array<bigint>"
    )
    chunks = stored(rows.mapInArrow(_chunks(*files), schema), "aligned")

    # All joins are by shuffle: Spark does not count the pairs that a row is exploded into.
    pairs = chunks.filter("first IS NOT NULL").select(
        "chunk", "first", F.posexplode(F.arrays_zip("codes", "n_docs")).alias("i", "pair")
    )
    at = (F.col("first") + F.col("i")).alias("at")
    pairs = pairs.select("chunk", at, F.col("pair.codes").alias("code"), F.col("pair.n_docs").alias("n"))
    counts = pairs.groupBy("code").agg(F.sum("n").alias("count"))
    # A window holds the pairs of one A id: as many as B has ids, at most.
    of_a = Window.partitionBy(F.shiftright("code", SHIFT))
    counts = counts.select(
        F.col("code").alias("counted"), "count", (F.col("count") == F.max("count").over(of_a)).cast("bigint").alias("best")
    )
    met = pairs.join(counts.hint("merge"), F.col("code") == F.col("counted")).select("chunk", "at", "count", "best")
    facts = chunks.filter("first IS NULL").select(
        F.col("chunk").alias("own"), "id", *FACTS, "digest", "places", "weights"
    )
    # A task holds one chunk at a time, whatever the number of chunks.
    done = facts.groupBy("own").cogroup(met.groupBy("chunk")).applyInArrow(_finish, f"id {kind}, {RESULT}")
    return done.withColumnRenamed("id", identity)
