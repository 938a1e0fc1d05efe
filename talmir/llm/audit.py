"""What every order of five filters removes: a filter interaction audit.

Every document gets a mask of five bits, one for each filter that it fails. The mask says all
about the document that any order of the filters can see, so documents are counted by (part,
mask): 32 cells a part at most, however many documents there are. Each cell folds across the
array of all 120 orders, a constant of the plan: ``transform`` goes over the orders, and
``aggregate`` goes along one order with the state "still there". That gives 600 structs, one for
each order and step, weighted by the cell's counts. The cells of a part are added element by
element, and the sums of 600 structs are the part's rows.

Whether a text stands at a smaller identity is found by its SHA-256: rows are counted by
(digest, part, mask, labels, identity) and again without the identity, so that a very frequent
text is a few rows before it meets the least identity of its digest.

Defined results: a NULL text is an empty one, a NULL part the empty string. A row without
identity has no smaller one and no labels, and is no smaller one for others. Repeated rows count
each; one does not repeat the other, as their identities are equal. Of several labels of a
document, one that says 1 suffices; NULL labels say nothing. An empty table has no parts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talmir.llm.common import UPPER

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
WHITE = r"[\x20\x09-\x0D]+"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def content_mask(text: Column) -> Column:
    """The bits of the filters that look at the text alone: A is bit 0, D is bit 3.

    A: under 100 words. B: under 80 % of the words are different. C: over 10 % of the code points
    are in A-Z. D: one of # $ % & * | is there.
    """
    words = F.array_remove(F.split(text, WHITE, -1), "")

    def bits(w: Column) -> Column:
        n = F.size(w)
        few = n < 100
        repeated = F.size(F.array_distinct(w)) * 100 < n * 80
        capitals = F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
        loud = capitals.cast("bigint") * 100 > F.char_length(text).cast("bigint") * 10
        odd = text.rlike("[#$%&*|]")
        tests = [few, repeated, loud, odd]
        return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))

    # An array of one element, so that the text is cut into words once.
    return F.transform(F.array(words), bits)[0]


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail just these filters.

    docs: (doc_id, text, lang); labels: (doc_id, quality, toxic).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    facts = docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        content_mask(text).alias("mask"),
    )
    # A key for rows without identity too: it meets no label, and does not gather them in one task.
    key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("-"), F.hex("digest")))
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("string").alias("key"))
    known = known.agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    marked = facts.withColumn("key", key).join(known, "key", "left").select(
        "id",
        "part",
        "digest",
        "mask",
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )
    alike = ["digest", "part", "mask", "good", "toxic"]
    each = marked.groupBy(*alike, "id").agg(F.count("*").alias("n"))
    # Structs are ordered by the identity first; rows without one are never the least.
    named = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    copies = each.groupBy(*alike).agg(
        F.sum("n").alias("n"),
        F.min(named).alias("first"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
    )
    least = copies.groupBy(F.col("digest").alias("least_digest")).agg(F.min("first.id").alias("least"))
    met = copies.join(least, F.col("digest") == F.col("least_digest"))
    is_first = F.col("first.id") == F.col("least")
    fresh = F.col("unnamed") + F.when(is_first, F.col("first.n")).otherwise(0)
    repeated = F.struct(
        F.col("mask").bitwiseOR(F.lit(1 << FILTERS.index("E"))).alias("mask"),
        (F.col("n") - F.col("fresh")).alias("n"),
    )
    split = met.withColumn("fresh", fresh).select(
        "part",
        "good",
        "toxic",
        F.inline(F.array(F.struct("mask", F.col("fresh").alias("n")), repeated)),
    )
    return split.filter("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


def fold_orders(failing: Column, n: Column, good: Column, toxic: Column, orders: Column) -> Column:
    """Array of a struct for each order and step: COUNTS of a cell's documents.

    ``failing`` has the letters of the filters that fail. The fold's state is whether the
    documents are still there, which is the same for all of a cell.
    """
    zero = F.lit(0).cast("bigint")
    kind = f"array<struct<{', '.join(c + ': bigint' for c in COUNTS)}>>"
    places = F.sequence(F.lit(1), F.lit(len(FILTERS)))

    def along(order: Column) -> Column:
        def step(state: Column, place: Column) -> Column:
            fails = F.contains(failing, F.substr(order, place, F.lit(1)))
            there = state["there"]
            weights = [
                F.when(there & ~fails, n).otherwise(zero),
                F.when(there & fails, n).otherwise(zero),
                F.when(~there & fails, n).otherwise(zero),
                F.when(fails & (F.length(failing) == 1), n).otherwise(zero),
                F.when(there & fails, good).otherwise(zero),
                F.when(there & fails, toxic).otherwise(zero),
            ]
            row = F.struct(*[w.alias(c) for w, c in zip(weights, COUNTS)])
            return F.struct(
                (there & ~fails).alias("there"),
                F.concat(state["rows"], F.array(row)).alias("rows"),
            )

        start = F.struct(F.lit(True).alias("there"), F.array().cast(kind).alias("rows"))
        return F.aggregate(places, start, step, lambda state: state["rows"])

    return F.flatten(F.transform(orders, along))


def add_rows(left: Column, right: Column) -> Column:
    """Two arrays of COUNTS, added element by element."""
    return F.zip_with(
        left, right, lambda a, b: F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, COUNTS, shapley) for each part, order and step.

    ``shapley`` is what the step's filter removes, added over all orders.
    """
    orders = F.split(F.lit(",".join(ORDERS)), ",")
    letters = [
        F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) > 0, x).otherwise("") for i, x in enumerate(FILTERS)
    ]
    counted = cells(docs, labels).withColumn("failing", F.concat(*letters))
    folded = counted.select("part", fold_orders(*map(F.col, ("failing", "n", "good", "toxic")), orders).alias("rows"))
    # At most 32 cells a part.
    merged = folded.groupBy("part").agg(F.collect_list("rows").alias("cells"))
    total = F.aggregate(F.slice("cells", F.lit(2), F.size("cells")), F.col("cells")[0], add_rows)
    steps = len(FILTERS)
    each = merged.select("part", F.posexplode(total).alias("at", "row")).select(
        "part",
        orders[F.floor(F.col("at") / steps).cast("int")].alias("filter_order"),
        (F.col("at") % steps + 1).cast("int").alias("step"),
        *[F.col("row")[c].alias(c) for c in COUNTS],
    )
    # 120 rows of each part and filter.
    own = Window.partitionBy("part", F.substr("filter_order", F.col("step"), F.lit(1)))
    return each.withColumn("shapley", F.sum("removed").over(own))
