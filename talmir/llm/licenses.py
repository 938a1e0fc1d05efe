"""License scans: an exact containment join of text blocks with license templates.

A block is a window of a text's words, across line ends, so notices in their usual hard wrapping
are found; a record is the set of its words. A template is found in a block that contains at least
``threshold`` of the template's different words, and all of the few words that tell it from other
licences. Templates of which one could pass for another, such as those of one series, are a
family, and the blocks of a family are every run of twice as many consecutive words as its longest
template has. (As long for all families would find the short ones by scattered words.) A block
gets the label of its best contained template only, and of the one with most words among equally
contained ones. The join finds all templates that reach the threshold in a block, with or without
their needed words, and the label is chosen among them; with ``every`` they are returned too. The sets of each family are only compared with its templates, their ranks being
moved to a range of their own. The join is exact and compares few pairs:

- Words are ranked by how often they occur in the whole corpus, rarest first. Only words of
  the templates matter, as no other word can be shared, so the ranking has as many rows as
  the templates have words, whatever the size of the corpus.
- Prefix filter: a pair that shares ``least`` words shares one in the first
  ``size - least + 1`` of both. Template prefixes hold the rarest words, so nearly all
  blocks leave here, in the task that read them.
- Length filter: a block with fewer words than ``least`` cannot match. No window can in a text
  that has fewer of them as a whole, so the windows of few texts are made.
- Positional filter: where the first shared word stands bounds what can be shared in all.

Equal block sets of a document, and equal lists of sets of different documents, are joined
once; results come back by an equality join on the list of sets, which Spark splits at a list
that is very frequent. Templates are a parameter, at most MAX_TEMPLATES of MAX_TEMPLATE_WORDS
words, so their index is broadcast.

Base phrases are looked up as consecutive words. Defined results: NULL texts are empty; a text
without words has no places, score 0 and labels ''. Repeated rows get equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talmir.llm.common import stored, text_or_empty, words

MAX_TEMPLATES, MAX_TEMPLATE_WORDS = 1000, 2000

# Words of a window for each word of the longest template.
WINDOW = 2
# Join partitions that the rows of one list of sets are dealt over, at least.
SALTS = 16

# The base phrases with their labels, and the templates of this library.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Wordings of notices, lower case without marks, each with the words that must be there.
NOTICES = {
    "apache-2.0": ("licensed under the apache license version 2 0", "apache license"),
    "apache-notice": (
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        "apache compliance obtain",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "redistribution binary forms",
    ),
    "boost": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of "
        "the software and accompanying documentation covered by this license",
        "organization accompanying",
    ),
    "cc-by-4.0": ("licensed under cc by 4 0", "cc by 4"),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", "cc by nc 4"),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", "cc by sa 4"),
    "cc0-1.0": ("this work is dedicated to the public domain under cc0 1 0", "cc0"),
    "gpl-3.0": ("licensed under the gnu general public license version 3", "gnu public 3"),
    "gpl-notice": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation",
        "gnu general redistribute foundation",
    ),
    "lgpl-notice": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license "
        "as published by the free software foundation",
        "gnu lesser redistribute foundation",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee "
        "is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        "permission fee purpose",
    ),
    "mit": ("released under the mit license", "mit license"),
    "mit-notice": (
        "permission is hereby granted free of charge to any person obtaining a copy of "
        "this software and associated documentation files",
        "permission charge associated",
    ),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public",
    ),
    "no-warranty": (
        "the software is provided as is without warranty of any kind express or implied",
        "warranty express implied",
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain",
        "unencumbered domain",
    ),
}
TEMPLATES = {label: words for label, (words, _) in NOTICES.items()}
NEEDED = {label: words.split() for label, (_, words) in NOTICES.items()}
THRESHOLD = 0.8


def _phrase_places(w: Column, phrases: dict[str, str]) -> Column:
    """Array of (place, label): where a phrase's words stand one after the other."""

    def at(word: Column, i: Column) -> Column:
        label = F.lit(None).cast("string")
        for phrase, name in phrases.items():
            first, *rest = phrase.split(" ")
            same = word == first
            for offset, other in enumerate(rest, 1):
                same = same & F.coalesce(F.get(w, i + offset) == other, F.lit(False))
            label = F.when(same, F.lit(name)).otherwise(label)
        return F.struct(i.cast("bigint").alias("place"), label.alias("label"))

    found = F.filter(F.transform(w, at), lambda x: x["label"].isNotNull())
    lasts = F.array(*[F.lit(phrase.split(" ")[-1]) for phrase in phrases])
    none = F.array().cast("array<struct<place: bigint, label: string>>")
    return F.when(F.arrays_overlap(w, lasts), found).otherwise(none)


def least_shared(size: int, threshold: float) -> int:
    """Words that a block must share with a template of so many different words."""
    return max(1, math.ceil(threshold * size - 1e-9))


def template_words(templates: dict[str, str]) -> dict[str, set[str]]:
    sets = {name: set(text.split()) for name, text in templates.items()}
    if len(sets) > MAX_TEMPLATES or any(len(s) > MAX_TEMPLATE_WORDS for s in sets.values()):
        raise ValueError(f"at most {MAX_TEMPLATES} templates of {MAX_TEMPLATE_WORDS} words")
    return {name: s for name, s in sets.items() if s}


def rank_words(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Each word of the vocabulary to its rank by frequency in all the texts, rarest first."""
    counts = (
        docs.select(F.explode(words(text_or_empty())).alias("word"))
        .filter(F.col("word").isin(vocabulary))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    n = {row["word"]: row["n"] for row in counts.collect()}  # as many rows as the vocabulary
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (n.get(w, 0), w)))}


def families(templates: dict[str, str], threshold: float) -> list[tuple[int, list[str]]]:
    """(words of a window, labels): templates of which one could pass for another, by its words,
    directly or through others."""
    sets = template_words(templates)
    groups: list[list[str]] = []
    for name in sets:
        alike = [
            g
            for g in groups
            if any(
                len(sets[name] & sets[x]) >= least_shared(min(len(sets[name]), len(sets[x])), threshold) for x in g
            )
        ]
        groups = [g for g in groups if g not in alike] + [[x for g in alike for x in g] + [name]]
    return [(WINDOW * max(len(templates[x].split()) for x in g), sorted(g)) for g in groups]


def _window_sets(w: Column, ranks: dict[str, int], kinds: list[dict]) -> Column:
    """Different rank sets of the windows of the words that the same filters leave.

    Each of ``kinds`` has a family's window ``span``, the ``ranks`` of its templates, their
    ``leasts``, and by how much ranks are ``moved``.
    """
    names = {rank: word for word, rank in ranks.items()}
    rank_of = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    described = []
    for kind in kinds:
        own = sorted({rank for r in kind["ranks"] for rank in r})
        first = {x for r, n in zip(kind["ranks"], kind["leasts"]) for x in r[: len(r) - n + 1]}
        described.append(
            F.struct(
                F.lit(kind["span"]).alias("span"),
                F.lit(min(kind["leasts"])).alias("least"),
                F.lit(kind["moved"]).alias("moved"),
                F.array(*[F.lit(names[x]) for x in own]).alias("own"),
                F.array(*[F.lit(names[x]) for x in sorted(first)]).alias("first"),
                F.array(*[F.lit(x) for x in sorted(first)]).alias("first_ranks"),
            )
        )
    every = F.array(*[F.lit(word) for word in ranks])

    def sets(kind: Column) -> Column:
        place = F.transform(w, lambda x, i: F.when(F.array_contains(kind["own"], x), i))
        marked = F.transform(
            F.array_compact(place),
            lambda i: F.struct(
                i.alias("i"), F.try_element_at(rank_of, F.get(w, i)).alias("rank")
            ),
        )

        # Runs that start between one of the words and the next hold the same words from there on,
        # but end earlier or later; all runs together have at most twice as many sets as words.
        def windows(m: Column) -> Column:
            def of_start(x: Column, j: Column) -> Column:
                near = F.filter(
                    F.slice(m, j + 1, kind["span"]), lambda y: y["i"] < x["i"] + kind["span"]
                )

                def ends(n: Column) -> Column:
                    before = F.coalesce(F.get(m, j - 1)["i"], F.lit(-1))
                    least = F.size(F.filter(n, lambda y: y["i"] <= before + kind["span"]))
                    return F.transform(
                        F.sequence(F.greatest(least, F.lit(1)), F.size(n)),
                        lambda c: F.array_sort(F.array_distinct(F.slice(n, F.lit(1), c)["rank"])),
                    )

                return F.flatten(F.transform(F.array(near), ends))

            return F.filter(
                F.flatten(F.transform(m, of_start)),
                lambda s: (F.size(s) >= kind["least"]) & F.arrays_overlap(s, kind["first_ranks"]),
            )

        found = F.flatten(F.transform(F.array(marked), windows))
        # As strings, which are compared by hash.
        keys = F.array_distinct(F.transform(found, lambda s: F.array_join(s.cast("array<string>"), ",")))
        return F.transform(
            keys,
            lambda k: F.transform(F.split(k, ","), lambda x: x.cast("int") + kind["moved"]),
        )

    def made(present: Column) -> Column:
        likely = F.filter(
            F.array(*described),
            lambda kind: (F.size(F.array_intersect(kind["own"], present)) >= kind["least"])
            & F.arrays_overlap(kind["first"], present),
        )
        return F.flatten(F.transform(likely, sets))

    return F.flatten(F.transform(F.array(F.array_intersect(w, every)), made))


def containment_join(
    sets: DataFrame,
    column: str,
    ranked: dict[str, list[int]],
    threshold: float,
    needed: dict[str, list[int]] | None = None,
) -> DataFrame:
    """(column, label, containment, t_size, told) of the rank sets that contain a template.

    ``sets`` are different; ``ranked`` has each template's ranks in order, ``needed`` those that
    are all among a set's if it is ``told``.
    """
    index = []
    for name, ranks in ranked.items():
        least = least_shared(len(ranks), threshold)
        for place, rank in enumerate(ranks[: len(ranks) - least + 1]):
            index.append((rank, place, name, ranks, least, (needed or {}).get(name, [])))
    schema = "rank int, t_place int, label string, t_ranks array<int>, least int, needed array<int>"
    templates = sets.sparkSession.createDataFrame(index, schema)
    probes = sets.select(column, F.posexplode(column).alias("b_place", "rank"))
    size, t_size = F.size(column), F.size("t_ranks")
    rest = F.least(size - F.col("b_place"), t_size - F.col("t_place"))
    candidates = (
        probes.join(F.broadcast(templates), "rank")
        .filter((size >= F.col("least")) & (F.col("b_place") <= size - F.col("least")))
        .filter(rest >= F.col("least"))
        .withColumn("told", F.size(F.array_except("needed", column)) == 0)
        .select(column, "label", "t_ranks", "least", "told")
        .distinct()
    )
    shared = F.size(F.array_intersect(column, "t_ranks"))
    return candidates.filter(shared >= F.col("least")).select(
        column, "label", (shared / F.size("t_ranks")).alias("containment"), F.size("t_ranks").alias("t_size"), "told"
    )


def mark_best(found: DataFrame, column: str) -> DataFrame:
    """``found`` with ``best``: whether it is its set's best contained template that is told, with most
    words among equally contained ones; labels decide the rest."""
    order = [F.col("told").desc(), F.col("containment").desc(), F.col("t_size").desc(), F.col("label")]
    first = F.row_number().over(Window.partitionBy(column).orderBy(*order)) == 1
    return found.withColumn("best", F.col("told") & first)


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    needed: dict[str, list[str]] = NEEDED,
    every: bool = False,
) -> DataFrame:
    """Every row of ``docs`` (its ``text`` replaced by what was found).

    Adds n_words, places (array of (place, label) of base phrases), and matches (array of
    (label, containment), the best of each template over the blocks that it labels); columns of
    these names, in any case, are replaced. ``needed``: words of a template that a block must have.

    With ``every``, adds contained too: array of (label, containment, told), every template that
    reaches the threshold in a block, also where another labels the block or needed words are
    missing; its best containment, and whether a block that reaches the threshold has them.
    """
    added = ["n_words", "places", "matches"] + ["contained"] * every
    names = [c for c in docs.columns if c.lower() not in ("text", *added)]
    sets = template_words(templates)
    vocabulary = sorted({w for s in sets.values() for w in s})
    ranks = rank_words(docs, vocabulary)

    # Each family has ranks of its own, and so its own entries for the join.
    kinds, searched, searched_needed = [], {}, {}
    for i, (span, labels) in enumerate(families(templates, threshold)):
        ranked = {x: sorted(ranks[w] for w in sets[x]) for x in labels}
        must = {x: [w for w in needed.get(x, []) if w in sets[x]] for x in labels}
        moved = i * len(ranks)
        kinds.append(
            {
                "span": span,
                "moved": moved,
                "ranks": list(ranked.values()),
                "leasts": [least_shared(len(r), threshold) for r in ranked.values()],
            }
        )
        searched |= {x: [rank + moved for rank in ranked[x]] for x in labels}
        searched_needed |= {x: [ranks[w] + moved for w in must[x]] for x in labels}

    # The documents' own columns are packed, so that their names meet no others.
    split = docs.select(F.struct("*").alias("row"), words(text_or_empty()).alias("words"))
    none = F.array().cast("array<array<int>>")
    facts = split.select(
        F.struct(*[F.col("row")[c].alias(c) for c in names]).alias("row") if names else F.lit(0).alias("row"),
        F.size("words").cast("bigint").alias("n_words"),
        _phrase_places(F.col("words"), phrases).alias("places"),
        F.array_sort(_window_sets(F.col("words"), ranks, kinds)).alias("sets") if ranks else none.alias("sets"),
    )
    facts = stored(facts, "license-sets")
    lists = facts.filter(F.size("sets") > 0).select("sets").distinct()
    blocks = lists.select(F.explode("sets").alias("set")).distinct()
    pairs = containment_join(blocks, "set", searched, threshold, searched_needed)
    found = mark_best(pairs, "set")
    best = (
        lists.select("sets", F.explode("sets").alias("set"))
        .join(found if every else found.filter("best"), "set")
        .groupBy("sets", "label")
        .agg(
            F.max(F.when(F.col("best"), F.col("containment"))).alias("labelled"),
            F.max("containment").alias("containment"),
            F.max("told").alias("told"),
        )
        .groupBy(F.col("sets").alias("list"))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.when(
                        F.col("labelled").isNotNull(), F.struct("label", F.col("labelled").alias("containment"))
                    )
                )
            ).alias("matches"),
            F.array_sort(F.collect_list(F.struct("label", "containment", "told"))).alias("contained"),
        )
    )
    # A list may be very frequent: its rows are dealt over SALTS, by the partition they are read from.
    best = best.withColumn("list_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    some = facts.filter(F.size("sets") > 0).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    joined = some.join(best, (F.col("sets") == F.col("list")) & (F.col("salt") == F.col("list_salt")), "left")
    none = {
        "matches": F.array().cast("array<struct<label: string, containment: double>>"),
        "contained": F.array().cast("array<struct<label: string, containment: double, told: boolean>>"),
    }
    arrays = [c for c in added if c in none]
    joined = joined.select("row", "n_words", "places", *[F.coalesce(c, none[c]).alias(c) for c in arrays])
    rest = facts.filter(F.size("sets") == 0).select("row", "n_words", "places", *[none[c].alias(c) for c in arrays])
    return joined.unionByName(rest).select(*[F.col("row")[c].alias(c) for c in names], *added)
