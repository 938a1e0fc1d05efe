"""Shards of equal numbers of rows, by balanced label propagation along groups of documents.

Documents of a group (here: of equal texts) are linked. They start dealt over the shards in
turn. In each round, the documents of a group move towards the shard where most of their
neighbours are, as far as quotas allow: as many may move from one shard to another as want to
move the other way, plus the free room of the target. So no round leaves a shard above its
capacity. Every second round only offers shards with free room, so that a group too large for
one shard goes on to fill the next. Unlinked documents, which are indifferent, take the room
that is left at the end. Then the law of equal rows holds exactly: numbers differ by one at
most.

Documents of a group that are in the same shard have the same neighbours, so the state of a
round is one row per group and shard with a number of documents, however large the group.
Rounds are joins and sums of these rows, stored after each round. Flows and loads, at most
shards * shards numbers, are all that the driver sees.

Rounds go on until neither kind moves anything. That they end needs no bound: a document only moves
to a shard with at least as many of its group as its own, so the sum of the squares of all such
numbers grows with every move, and it cannot grow for ever.

A group with very many documents is cut into slices, by the partition that a row is read from,
before its documents are joined with what is known of it. Only built-in functions are used.
Defined results: rows whose group is NULL are unlinked, repeated rows are placed like any others,
and an empty table gives an empty one.
"""

from __future__ import annotations

import warnings
from itertools import accumulate, count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talmir.llm.common import number_buckets, number_rows, stored
from talmir.operators.joins import join_back

# Groups with more documents than this (and than a ten-thousandth of all) are cut into slices.
HOT_ROWS = 1_000


def _pick(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), index + 1)


def _interval(number: Column, sizes: list[int]) -> Column:
    """Which of the intervals of these sizes, laid end to end, the number is in."""
    ends = F.array(*[F.lit(e).cast("bigint") for e in accumulate(sizes)])
    return F.size(F.filter(ends, lambda end: end <= number))


def _loads(state: DataFrame, shards: int) -> list[int]:
    loads = [0] * shards
    for row in state.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        loads[row["shard"]] = row["n"]
    return loads


def _wishes(state: DataFrame, offered: list[bool]) -> DataFrame:
    """(group, source, target, n): documents that would move to where more neighbours are."""
    rank = F.struct("n", F.pmod(F.xxhash64("group", "shard"), F.lit(1 << 30)).alias("tie"))
    best = (
        state.filter(F.col("shard").isin([j for j, there in enumerate(offered) if there]))
        .groupBy("group")
        .agg(F.max_by(F.struct("shard", rank.alias("rank")), rank).alias("best"))
    )
    return (
        state.join(best, "group")
        .filter((F.col("shard") != F.col("best.shard")) & (rank < F.col("best.rank")))
        .select("group", F.col("shard").alias("source"), F.col("best.shard").alias("target"), "n")
    )


def _quotas(demand: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], int]:
    quotas, left = {}, list(free)
    for (i, j), wanted in sorted(demand.items(), key=lambda x: (-x[1], x[0])):
        swap = min(wanted, demand.get((j, i), 0))
        extra = min(wanted - swap, left[j])
        left[j] -= extra
        quotas[i, j] = swap + extra
    return quotas


def _granted(wishes: DataFrame, demand: dict, quotas: dict, shards: int, buckets: int) -> DataFrame:
    """(group, source, target, n) of the moves made, as many of each flow as its quota."""
    flow = F.col("source") * shards + F.col("target")
    flat = [quotas.get((i, j), 0) for i in range(shards) for j in range(shards)]
    quota = _pick(flat, flow)
    if all(quotas[k] >= demand[k] for k in demand):
        return wishes
    # Groups are served in the order of a hash; sums of hash buckets come first, so that no
    # flow is summed up in one task.
    cut = wishes.withColumn("_bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
    totals = cut.groupBy("source", "target", "_bucket").agg(F.sum("n").alias("_total"))
    earlier = Window.partitionBy("source", "target").orderBy("_bucket")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "source", "target", "_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("source", "target", "_bucket").orderBy("group")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    served = cut.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    served = served.join(totals, ["source", "target", "_bucket"])
    taken = F.least(F.col("n"), quota - F.col("_before") - F.col("_inside"))
    return served.withColumn("n", taken).filter("n > 0").select("group", "source", "target", "n")


def propagate(
    state: DataFrame, capacities: list[int], buckets: int, most_rounds: int | None = None
) -> DataFrame:
    """Rounds of moves on (group, shard, n) until neither kind of round moves anything.

    ``most_rounds``: the caller's bound on the work; a warning says that it was met.
    """
    shards, still = len(capacities), 0
    for number in count():
        if number == most_rounds:
            warnings.warn(f"documents would still move after {number} rounds", stacklevel=2)
            break
        free = [c - n for c, n in zip(capacities, _loads(state, shards))]
        offered = [number % 2 == 0 or room > 0 for room in free]
        wishes = _wishes(state, offered)
        rows = wishes.groupBy("source", "target").agg(F.sum("n").alias("n")).collect()
        demand = {(r["source"], r["target"]): r["n"] for r in rows}
        quotas = _quotas(demand, free)
        if not sum(quotas.values()):
            still += 1
            if still == 2:
                break
            continue
        still = 0
        moves = _granted(wishes, demand, quotas, shards, buckets)
        out = moves.select("group", F.col("source").alias("shard"), (-F.col("n")).alias("n"))
        into = moves.select("group", F.col("target").alias("shard"), "n")
        state = state.select("group", "shard", "n").unionByName(out).unionByName(into)
        state = stored(state.groupBy("group", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "round")
    return state


def shard_rows(
    rows: DataFrame, group: str, order: list[str], shards: int, most_rounds: int | None = None
) -> DataFrame:
    """The rows with ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... within the shard); columns
    of these names, in any case, are replaced.

    ``group`` names the column whose equal values link rows; ``order`` names columns that tell
    rows apart. Keep texts out of ``rows``: they are read several times.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    # The rows' own columns are packed, so that their names meet no others.
    packed = rows.select(
        F.struct("*").alias("row"),
        F.col(group).alias("group"),
        F.xxhash64(*order).alias("hash"),
        F.struct(*order).alias("tie"),
    )
    key = [F.col("hash"), F.col("tie")]
    total = packed.count()
    buckets = number_buckets(total)
    capacities = [total // shards + (j < total % shards) for j in range(shards)]

    # Unlike join keys, NULL is a group here, of rows that are not linked.
    copies = packed.groupBy("group").agg(F.count("*").alias("n"))
    marked = stored(join_back(packed, copies, "group", hot_rows=HOT_ROWS), "linked")
    is_linked = (F.col("n") > 1) & F.col("group").isNotNull()
    linked = marked.filter(is_linked).drop("n")
    dealt = number_rows(linked, "turn", [], key, buckets)
    shard = F.pmod("turn", F.lit(shards)).cast("int")
    state = dealt.groupBy("group", shard.alias("shard"))
    state = stored(state.agg(F.count("*").alias("n")), "round")
    state = propagate(state, capacities, buckets, most_rounds)

    # Members of a group go to its shards in turn; which of them goes where is all one.
    ends = Window.partitionBy("group").orderBy("shard")
    ranges = state.select("group", "shard", "n", F.sum("n").over(ends).alias("end"))
    ranges = ranges.groupBy("group").agg(
        F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("end", "shard"))).alias("ranges")
    )
    members = number_rows(linked, "member", ["group"], key, buckets)
    placed = join_back(members, ranges, "group", hot_rows=HOT_ROWS)
    number = F.col("member")
    place = F.get(F.filter("ranges", lambda x: x["end"] > number), F.lit(0))["shard"]
    placed = placed.select("row", "hash", "tie", place.alias("shard"))

    free = [c - n for c, n in zip(capacities, _loads(state, shards))]
    rest = number_rows(marked.filter(~is_linked), "turn", [], key, buckets)
    rest = rest.select("row", "hash", "tie", _interval(F.col("turn"), free).cast("int").alias("shard"))
    every = stored(placed.unionByName(rest), "sharded")
    numbered = number_rows(every, "slot", ["shard"], key, buckets)
    return numbered.select(*[F.col("row")[c].alias(c) for c in kept], "shard", "slot")


def cut_links(sharded: DataFrame, group: str) -> DataFrame:
    """One row (links, cut): documents beyond the first of their group, and how many of them are
    outside the shard that holds most of it."""
    counts = sharded.filter(F.col(group).isNotNull()).groupBy(group, "shard").agg(F.count("*").alias("n"))
    groups = counts.groupBy(group).agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    return groups.agg(
        F.sum(F.col("n") - 1).alias("links"), F.sum(F.col("n") - F.col("most")).alias("cut")
    )
