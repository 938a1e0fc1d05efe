"""Substring dedup: words that repeat an earlier passage are removed, by phrase automata.

A window is ``window`` words in a row. Recurring windows are found by hashes, in two steps that
keep the shuffled rows few. Of the grams of GRAM words in a window, the one with the smallest
hash is its anchor, so equal windows have equal anchors, and neighbouring windows mostly share
one (a run). Only runs whose anchor recurs are looked at again. Equal runs are counted as one
row, and only the first of them is taken apart into windows.

Each recurring window points to the first place where it stands; windows next to each other
that point to places next to each other are one passage. The words of the first place are
fetched and compiled into Aho-Corasick automata, in shards: each batch of documents gets the
phrases that its documents need, so an automaton's size is bounded by its batch, and documents
need not stream through the phrases of the whole corpus. Where a batch needs very many letters of
phrases, it gets several automata, one after the other. Every document is streamed through all
automata of its shard, which find every occurrence, word for word. An occurrence counts if its
phrase's first place is earlier. So hashes only find candidates; what is removed is exact.

Texts that an earlier document has word for word (by their digests) are removed as a whole and
take no part in the search, so a very frequent text is searched once.

Frequent phrases are combined before they are shuffled (first places are minima), and joins on
them are equality joins that Spark splits. Nothing is capped.

Defined results: NULL and empty texts have no words. Rows with one identity count as one
document; NULL identities as one that comes last.
"""

from __future__ import annotations

import hashlib
import sys

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talmir.llm.common import discard, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A long gram recurs in few places where the window does not; a short one gives fewer anchors.
WINDOW, GRAM = 20, 10
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
LAST = (1 << 63) - 1
# Documents that share an automaton, at most, and bytes of their texts.
SHARD_ROWS, SHARD_BYTES = 64, 512 << 10
# Letters of the phrases of an automaton, about.
AUTOMATON = 1 << 18
# Rows or windows that a task gathers before it hands them over.
HELD = 100_000
# Repeats that a task sorts at a time, and characters of phrases that it hands over at a time.
LISTED, PHRASE_BYTES = 200_000, 8 << 20


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def sequence_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` numbers in a row, from those of powers of two."""
    def power(n: int) -> np.uint64:
        return np.uint64(pow(int(MULTIPLIER), n, 1 << 64))

    total, done, part, width = None, 0, h, 1
    left = size
    while left:
        if left & 1:
            if total is None:
                total = part
            else:
                total = total[: len(part) - done] + power(done) * part[done:]
            done += width
        left >>= 1
        if left:
            part = part[: len(part) - width] + power(width) * part[width:]
            width *= 2
    return total[: max(0, len(h) - size + 1)]


def runs_of(h: np.ndarray, window: int, gram: int):
    """(anchor hashes, anchor places, first windows, numbers of windows) of the runs."""
    grams = sequence_hashes(h, gram)
    wide = window - gram + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, wide).argmin(axis=1)
    places = at + np.arange(len(at))
    starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    counts = np.diff(np.append(starts, len(places)))
    return grams[places[starts]], places[starts], starts, counts


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def _anchors(window: int, gram: int):
    """ANCHOR of every run: ``content`` is a hash of the whole text, ``twice`` says whether the
    anchor stands at another place of it too."""

    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()]

    def batch_of(found):
        columns = [pa.array(np.concatenate(c).astype(t.to_pandas_dtype())) for c, t in zip(zip(*found), types)]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "doc", "place", "content", "twice"])

    def work(batches):
        found, held = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                words = split_words(text.as_py())
                if len(words) < window:
                    continue
                anchors, places, _, _ = runs_of(word_hashes(words), window, gram)
                content = xxhash.xxh3_64_intdigest(text.as_py().encode("utf-8", "surrogatepass")) >> 1
                _, which, times = np.unique(anchors, return_inverse=True, return_counts=True)
                n = len(places)
                found.append((_signed(anchors), np.full(n, doc.as_py()), places, np.full(n, content), times[which] > 1))
                held += n
                if held >= HELD:
                    yield batch_of(found)
                    found, held = [], 0
        if found:
            yield batch_of(found)

    return work


ANCHOR = "anchor bigint, doc bigint, place int, content bigint, twice boolean"
RUN = "anchor bigint, low bigint, high bigint, n int, doc bigint, start int, hashes array<bigint>"


def _runs(window: int, gram: int):
    """The runs whose anchors recur, with the hashes of their windows. A run is known by its
    first and last window, as these hold all its words."""

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]

    def batch_of(found, flat):
        c = [np.concatenate(x) for x in zip(*found)]
        ends = np.concatenate([[0], np.cumsum(c[3])])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat), pa.int64()))
        return pa.RecordBatch.from_arrays(
            [*[pa.array(x, t) for x, t in zip(c, types)], lists],
            ["anchor", "low", "high", "n", "doc", "start", "hashes"],
        )

    def work(batches):
        found, flat, held = [], [], 0
        for batch in batches:
            for doc, text, wanted in zip(batch.column(0), batch.column(1), batch.column(2)):
                h = word_hashes(split_words(text.as_py()))
                if len(h) < window:
                    continue
                anchors, places, starts, counts = runs_of(h, window, gram)
                keep = np.flatnonzero(np.isin(places, wanted.values.to_numpy()))
                if not len(keep):
                    continue
                hashes = _signed(sequence_hashes(h, window))
                starts, counts = starts[keep], counts[keep]
                found.append(
                    (_signed(anchors[keep]), hashes[starts], hashes[starts + counts - 1], counts,
                     np.full(len(keep), doc.as_py()), starts)
                )
                within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                flat.append(hashes[np.repeat(starts, counts) + within])
                held += len(flat[-1])
                if held >= HELD:
                    yield batch_of(found, flat)
                    found, flat, held = [], [], 0
        if found:
            yield batch_of(found, flat)

    return work


def _slices(offsets: np.ndarray):
    """(row, end) ranges of lists with about LISTED elements together, or one longer list."""
    row = 0
    while row < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[row] + LISTED, side="right")) - 1
        end = min(max(end, row + 1), len(offsets) - 1)
        yield row, end
        row = end


def _field(lists: pa.Array, name: str) -> np.ndarray:
    return lists.values.field(name).to_numpy(zero_copy_only=False)


def join_repeats(doc, start, n, first_doc, first, window: int):
    """(doc, first_doc, first, size) arrays: repeats joined where both places go on.

    Sorted by document, first document and the shift between the places, repeats that go on are
    neighbours; a passage ends where the next starts after the greatest end so far.
    """
    order = np.lexsort((start, first - start, first_doc, doc))
    doc, start, n, first_doc, first = (x[order] for x in (doc, start, n, first_doc, first))
    shift = first - start
    change = np.zeros(len(doc), bool)
    change[:1] = True
    for x in (doc, first_doc, shift):
        change[1:] |= x[1:] != x[:-1]
    # Greatest ends within each group: later groups have greater numbers in front.
    group = np.cumsum(change)
    span = int((start + n).max(initial=0)) + 1
    reach = np.maximum.accumulate(group * span + start + n) - group * span
    change[1:] |= start[1:] > reach[:-1]
    begin = np.flatnonzero(change)
    last = np.append(begin[1:], len(doc))[: len(begin)] - 1
    size = reach[last] - start[begin] + window - 1
    found = np.stack([doc[begin], first_doc[begin], start[begin] + shift[begin], size])
    return np.unique(found, axis=1)


def _passages(window: int):
    """(doc, first_doc, first, size): a document's repeats, joined where both places go on."""

    def work(batches):
        for batch in batches:
            docs = batch.column(0).to_numpy()
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            for row, end in _slices(offsets):
                some = slice(offsets[row], offsets[end])
                fields = (_field(lists, f)[some].astype(np.int64) for f in ("start", "n", "first_doc", "first"))
                which = np.repeat(docs[row:end], np.diff(offsets[row : end + 1]))
                doc, first_doc, first, size = join_repeats(which, *fields, window)
                arrays = [pa.array(doc), pa.array(first_doc)]
                arrays += [pa.array(x.astype(np.int32)) for x in (first, size)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "first_doc", "first", "size"])

    return work


def _phrases(batches):
    """(first_doc, first, size, phrase): the words of first places, joined by spaces."""
    names = ["first_doc", "first", "size", "phrase"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string()]
    for batch in batches:
        docs = batch.column(0).to_pylist()
        lists = batch.column(2)
        offsets, firsts, sizes = lists.offsets.to_numpy(), _field(lists, "first"), _field(lists, "size")
        out, held = [], 0
        for row, (doc, text) in enumerate(zip(docs, batch.column(1))):
            words = split_words(text.as_py())
            some = slice(offsets[row], offsets[row + 1])
            for first, size in zip(firsts[some].tolist(), sizes[some].tolist()):
                phrase = words[first : first + size]
                if len(phrase) == size:
                    out.append((doc, first, size, b" ".join(phrase).decode("utf-8", "surrogatepass")))
                    held += len(out[-1][3])
                if held > PHRASE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out), types)], names)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out), types)], names)


def parts_of(phrases: dict[str, tuple[int, int, int]]):
    """The phrases in parts of about AUTOMATON letters; an automaton takes some 60 bytes for each."""
    part, held = {}, 0
    for phrase, place in phrases.items():
        part[phrase] = place
        held += len(phrase)
        if held >= AUTOMATON:
            yield part
            part, held = {}, 0
    if part:
        yield part


def automaton_of(phrases: dict[str, tuple[int, int, int]]):
    """Aho-Corasick automaton of whole-word phrases; a phrase gives (doc, first word, words)."""
    automaton = ahocorasick.Automaton()
    for phrase, place in phrases.items():
        automaton.add_word(f" {phrase} ", (len(phrase) + 2, *place))
    automaton.make_automaton()
    return automaton


def repeated_words(words: list[str], doc: int, automaton) -> np.ndarray:
    """Which words an occurrence of a phrase covers whose first place is earlier."""
    covered = np.zeros(len(words) + 1, np.int64)
    if len(words):
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])  # of the space before each word
        stream = f" {' '.join(words)} "
        for last, (length, first_doc, first, size) in automaton.iter(stream):
            at = int(np.searchsorted(starts, last + 1 - length))
            if (first_doc, first) < (doc, at):
                covered[at] += 1
                covered[at + size] -= 1
    return np.cumsum(covered[:-1]) > 0


KEPT = "n_words bigint, n_removed bigint, kept string"


def _is_copy(text: str, copies) -> bool:
    return bool(copies) and hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest() in copies


def _remove(window: int):
    def work(batches):
        def shards(batch):
            rows, held = [], 0
            for doc, key, text, phrases, copies in zip(*(batch.column(i) for i in range(5))):
                row = (doc.as_py(), key.as_py(), text.as_py() or "", phrases, copies)
                rows.append(row)
                held += len(row[2])
                if len(rows) >= SHARD_ROWS or held >= SHARD_BYTES:
                    yield rows
                    rows, held = [], 0
            if rows:
                yield rows

        for batch in batches:
            for shard in shards(batch):
                known: dict[str, tuple[int, int, int]] = {}
                for _, _, _, phrases, _ in shard:
                    for p in phrases.as_py() or []:
                        place = (p["first_doc"], p["first"], p["size"])
                        known[p["phrase"]] = min(place, known.get(p["phrase"], place))
                split = [[w.decode("utf-8", "surrogatepass") for w in split_words(row[2])] for row in shard]
                whole = [len(w) >= window and _is_copy(row[2], row[4].as_py()) for w, row in zip(split, shard)]
                gone = [np.full(len(words), copy) for words, copy in zip(split, whole)]
                for some in parts_of(known):
                    automaton = automaton_of(some)
                    for i, (words, row) in enumerate(zip(split, shard)):
                        if not whole[i]:
                            gone[i] |= repeated_words(words, row[1], automaton)
                    del automaton
                out = []
                for words, lost, row in zip(split, gone, shard):
                    kept = [w for w, g in zip(words, lost.tolist()) if not g]
                    out.append((row[0], len(words), int(lost.sum()), " ".join(kept)))
                types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.string()]
                arrays = [pa.array(list(x), t) for x, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "n_words", "n_removed", "kept"])

    return work


def find_copies(texts: DataFrame) -> DataFrame:
    """(doc, digests, whole) of documents with texts that an earlier one has word for word.

    ``whole`` says that all texts of this identity are such; there is more than one only where
    identities repeat.
    """
    keyed = texts.select("doc", F.md5(F.coalesce("text", F.lit(""))).alias("digest")).distinct()
    firsts = keyed.groupBy("digest").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    firsts = firsts.filter("first_doc < last_doc").select("digest", "first_doc")
    copied = keyed.join(firsts, "digest", "left").groupBy("doc").agg(
        F.collect_set(F.when(F.col("doc") > F.col("first_doc"), F.col("digest"))).alias("digests"),
        F.count("*").alias("n"),
    )
    copied = copied.filter(F.size("digests") > 0)
    return stored(copied.select("doc", "digests", (F.size("digests") == F.col("n")).alias("whole")), "copies")


def find_repeats(
    texts: DataFrame, copies: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc, repeats) for texts (doc, text): arrays of (start, n, first_doc, first).

    n windows from word ``start`` equal those from word ``first`` of ``first_doc``, which is
    earlier, and stands first of all. Documents all of whose texts are ``copies`` are left out:
    their windows are those of the document that they copy.
    """
    places = stored(texts.mapInArrow(_anchors(window, gram), ANCHOR), "anchors")
    # In different texts, or at different places of one: copies alone make nothing recur.
    often = places.groupBy("anchor").agg(
        F.min("content").alias("low"), F.max("content").alias("high"), F.max("twice").alias("twice")
    )
    # Stored, so that the join reads both sides as they are, and can split a very frequent anchor.
    often = stored(often.filter("low < high OR twice").select("anchor"), "recurring-anchors")
    wanted = places.select("anchor", "doc", "place").join(often, "anchor")
    wanted = wanted.groupBy("doc").agg(F.collect_set("place").alias("places"))
    wanted = wanted.join(copies.filter("whole").select("doc"), "doc", "left_anti")
    wanted = stored(wanted.withColumnRenamed("doc", "wanted_doc"), "recurring")
    discard(places, often)

    joined = texts.join(wanted, F.col("doc") == F.col("wanted_doc")).select("doc", "text", "places")
    runs = stored(joined.mapInArrow(_runs(window, gram), RUN), "runs")
    discard(wanted)

    run = ["anchor", "low", "high", "n"]
    first = F.min(F.struct("doc", "start", "hashes")).alias("first")
    firsts = stored(runs.groupBy(*run).agg(first, F.count("*").alias("copies")), "first-runs")
    earlier = firsts.filter("copies > 1").select(
        *run, F.col("first.doc").alias("first_doc"), F.col("first.start").alias("first")
    )
    later = F.struct("doc", "start") > F.struct(
        F.col("first_doc").alias("doc"), F.col("first").alias("start")
    )
    repeats = ["doc", "start", "n", "first_doc", "first"]
    whole = runs.drop("hashes").join(earlier, run).filter(later).select(*repeats)

    windows = firsts.select(
        "anchor", F.col("first.doc").alias("doc"), F.posexplode("first.hashes").alias("i", "hash"), F.col("first.start").alias("s")
    ).select("anchor", "hash", "doc", (F.col("s") + F.col("i")).alias("start"))
    least = windows.groupBy("anchor", "hash").agg(
        F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("copies")
    )
    least = least.filter("copies > 1").select(
        "anchor", "hash", F.col("first.doc").alias("first_doc"), F.col("first.start").alias("first")
    )
    single = windows.join(least, ["anchor", "hash"]).filter(later)
    single = single.withColumn("n", F.lit(1)).select(*repeats)
    every = whole.unionByName(single).groupBy("doc").agg(
        F.collect_set(F.struct("start", "n", "first_doc", "first")).alias("repeats")
    )
    every = stored(every, "repeats")
    discard(runs, firsts)
    return every


def remove_repeats(
    docs: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """(identity, n_words, n_removed, kept): each row's words without those that repeat an
    earlier passage of ``window`` words or more, joined by single spaces."""
    rows = docs.select(
        F.col(identity).alias("id"),
        F.coalesce(F.col(identity).cast("bigint"), F.lit(LAST)).alias("doc"),
        F.col(text).cast("string").alias("text"),
    )
    texts = rows.select("doc", "text")
    copies = find_copies(texts)
    repeats = find_repeats(texts, copies, window, gram)
    passages = stored(
        repeats.mapInArrow(_passages(window), "doc bigint, first_doc bigint, first int, size int"), "passages"
    )
    discard(repeats)
    needed = passages.groupBy(F.col("first_doc").alias("needed_doc")).agg(
        F.collect_set(F.struct("first", "size")).alias("places")
    )
    sources = texts.join(needed, F.col("doc") == F.col("needed_doc")).select("doc", "text", "places")
    phrases = sources.mapInArrow(_phrases, "first_doc bigint, first int, size int, phrase string")
    phrases = stored(phrases, "phrases")
    found = passages.join(phrases, ["first_doc", "first", "size"]).groupBy(F.col("doc").alias("own_doc"))
    found = found.agg(F.collect_set(F.struct("first_doc", "first", "size", "phrase")).alias("phrases"))
    copied = copies.select(F.col("doc").alias("own_doc"), F.col("digests").alias("copies"))
    known = found.join(copied, "own_doc", "full")
    joined = rows.join(known, F.col("doc") == F.col("own_doc"), "left")
    joined = joined.select("id", "doc", "text", "phrases", "copies")
    kind = rows.select("id").schema[0].dataType.simpleString()
    return joined.mapInArrow(_remove(window), f"doc {kind}, {KEPT}").withColumnRenamed("doc", identity)
