"""Near-duplicate embeddings by an exact metric range join.

Unit vectors with cosine c are sqrt(2 - 2 c) apart, so a least cosine is a greatest distance r,
and distances obey the triangle inequality. Pivots, vectors drawn from the data that lie well
apart, cut a large label into cells: a vector's home is its nearest pivot's cell. If y of cell j
is within r of x of cell i, then d(x, pivot j) <= d(x, pivot i) + 2 r, and d(x, pivot j) is at
most r over the greatest distance of cell j's own vectors. Only to such cells, and only to those
before its own, is x replicated; so each pair meets in one cell, and cells are joined
independently. Nothing is lost, wherever the pivots lie: they only decide about the work.

Equal vectors of a label are one class with a number of copies, so copies are never paired. A
cell with more members than a task should hold is cut into blocks that meet in pairs. Within a
task, tiles of a matrix product give the cosines; those next to the threshold are computed
again, exactly rounded. A task hands back one row per linked class: how many vectors it links
to, and the least class that it is connected to there. So a dense group of n different vectors
costs n rows, never n * n, though its pairs are all compared.

Random vectors of many dimensions lie all about equally far from any pivot, and are replicated
to most cells: then the work grows with the square of a label. That is the data's doing, and the
bounds above are the best that the triangle inequality gives; the README has figures.

Defined results: a vector that is NULL, empty, zero, or holds NULL, NaN or infinity links with
nothing, as does one without label, and vectors of unlike length. Repeated rows are vectors of
their own. NULL identities are the smallest only where there is no other; a row is kept if its
identity is the component's. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talmir.llm.common import components, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Members that a task should hold of a cell, and pivots at most. Both only decide about the work.
CELL, MAX_PIVOTS = 1024, 1024
# A label or cell counts as large beyond this part of all classes, so there are fewer than this.
LARGE_PARTS = 10_000
TILE = 1024
# Added to bounds and taken as "next to the threshold": far above what rounding can do.
SLACK = 1e-6


def _rows(column: pa.Array):
    """Each row's numbers; None where there is a vector that links with nothing."""
    numbers = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    there = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        v = numbers[ends[i] : ends[i + 1]]
        yield v if there[i] and len(v) and np.isfinite(v).all() and v.any() else None


def vector_digest(vector: Column) -> Column:
    """MD5 of the vector's numbers; NULL for one that links with nothing."""

    @F.arrow_udf("binary")
    def compute(vectors: pa.Array) -> pa.Array:
        # Adding zero makes -0.0 and 0.0 one number.
        found = [None if v is None else hashlib.md5((v + 0.0).tobytes()).digest() for v in _rows(vectors)]
        return pa.array(found, pa.binary())

    return compute(vector)


def units(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors of one length, scaled to length 1; neither very large nor tiny ones overflow."""
    v = np.array(vectors, np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine from sums that are rounded once. Scaling by powers of two changes no digit."""
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max())[1]) for x in (a, b))
    dot, aa, bb = (math.fsum((x * y).tolist()) for x, y in ((a, b), (a, a), (b, b)))
    return dot / math.sqrt(aa * bb)


def choose_pivots(sample: list[np.ndarray], most: int, radius: float) -> np.ndarray:
    """Unit vectors of the sample, in its order, that lie over 4 radii apart."""
    if not sample:
        return np.zeros((0, 0))
    sizes = [len(v) for v in sample]
    size = max(set(sizes), key=sizes.count)
    every = units([v for v in sample if len(v) == size])
    chosen = np.zeros((0, size))
    for v in every:
        if len(chosen) == most:
            break
        if not len(chosen) or (chosen @ v).max() < 1 - (4 * radius) ** 2 / 2:
            chosen = np.vstack([chosen, v])
    return chosen


def _homes(batch, pivots: np.ndarray):
    """(rows, distances to all pivots, home cells) of a batch's (cid, large, n, vector) rows that
    are cut into cells."""
    large = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
    vectors = list(_rows(batch.column(3)))
    rows = [i for i, v in enumerate(vectors) if large[i] and pivots.size and len(v) == pivots.shape[1]]
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, len(pivots))), np.zeros(0, np.int64)
    unit = units([vectors[i] for i in rows])
    far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (unit @ pivots.T)))
    return np.array(rows), far, far.argmin(axis=1)


def _greatest(pivots):
    """(cell, distance): how far a cell's own vectors lie from its pivot, at most."""

    def work(batches):
        most = np.full(len(pivots.value), -1.0)
        for batch in batches:
            _, far, home = _homes(batch, pivots.value)
            np.maximum.at(most, home, far[np.arange(len(home)), home])
        found = np.flatnonzero(most >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(most[found])], ["cell", "distance"]
        )

    return work


def _members(pivots, reach, radius: float):
    """(cid, cells): the cells that a class belongs to, its home first. Cell -1 is a label's only
    one, or that of vectors of another length than the pivots'."""

    def work(batches):
        for batch in batches:
            cells = [[-1]] * batch.num_rows
            rows, far, home = _homes(batch, pivots.value)
            if len(rows):
                own = far[np.arange(len(rows)), home]
                near = (far <= own[:, None] + 2 * radius + SLACK) & (far <= reach.value + radius + SLACK)
                near &= np.arange(far.shape[1]) < home[:, None]
                for i, h, others in zip(rows.tolist(), home.tolist(), near):
                    cells[i] = [h, *np.flatnonzero(others).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cells, pa.list_(pa.int32()))], ["cid", "cells"]
            )

    return work


def _block_join(least: float):
    """Links of block u with block v, as (cid, links, root) of the classes that have any.

    Side 0 is compared with side 1, and with itself where a block meets itself.
    """

    def work(key, table):
        itself = key[2].as_py() == key[3].as_py()
        table = table.combine_chunks()
        cid, n, side = (table.column(c).to_numpy() for c in ("cid", "n", "side"))
        vectors = list(_rows(table.column("vector").combine_chunks()))
        links = np.zeros(len(cid), np.int64)
        root = np.arange(len(cid))

        def find(x):
            while True:
                up = root[x]
                if (root[up] == up).all():
                    return up
                root[x] = root[up]

        for size in {len(v) for v in vectors}:
            rows = np.array([i for i, v in enumerate(vectors) if len(v) == size])
            rows = rows[np.argsort(side[rows], kind="stable")]
            unit = units([vectors[i] for i in rows])
            n_left = int((side[rows] == 0).sum())
            for start in range(0, n_left, TILE):
                stop = min(start + TILE, n_left)
                cosines = unit[start:stop] @ unit[start:].T
                hits = cosines >= least
                for x, y in zip(*np.nonzero(np.abs(cosines - least) < SLACK)):
                    hits[x, y] = exact_cosine(vectors[rows[start + x]], vectors[rows[start + y]]) >= least
                # Each pair once: later rows only.
                after = np.arange(start, stop)[:, None] if itself else n_left - 1
                hits &= np.arange(start, len(rows)) > after
                links[rows[start:stop]] += hits @ n[rows[start:]]
                links[rows[start:]] += hits.T @ n[rows[start:stop]]
                for x in np.flatnonzero(hits.any(axis=1)):
                    met = rows[np.append(start + np.flatnonzero(hits[x]), start + x)]
                    tops = find(met)
                    root[tops] = tops[cid[tops].argmin()]
        some = np.flatnonzero(links)
        # The least class of each is at the top, as tops are merged under their least.
        top = find(some) if len(some) else some
        return pa.table({"cid": cid[some], "links": links[some], "root": cid[top]})

    return work


def _large(counted: DataFrame, keys: list[str], n_classes: int, column: str) -> DataFrame:
    """The keys with more than CELL rows and more than one part in LARGE_PARTS of all rows; by
    counting, their list may be broadcast."""
    most = max(CELL, -(-n_classes // LARGE_PARTS))
    blocks = F.ceil(F.col("members") / (2 * most)).cast("int").alias(column)
    return counted.filter(F.col("members") > most).select(*[F.col(k).alias(f"large_{k}") for k in keys], blocks)


def _links(classes: DataFrame, least: float) -> DataFrame:
    """(cid, links, root) for classes (cid, label, n, vector): links found in one block, to how
    many vectors of other classes, and the least class connected there."""
    spark = classes.sparkSession
    radius = math.sqrt(2 - 2 * least)
    sizes = classes.groupBy("label").agg(F.count("*").alias("members"))
    facts = sizes.agg(F.coalesce(F.sum("members"), F.lit(0)), F.coalesce(F.max("members"), F.lit(0))).first()
    n_classes, largest = facts
    labels = _large(sizes, ["label"], n_classes, "label_blocks")
    marked = classes.join(F.broadcast(labels), F.col("label") == F.col("large_label"), "left").select(
        "cid", F.col("label_blocks").isNotNull().alias("large"), "n", "vector", "label"
    )
    most = min(MAX_PIVOTS, -(-largest // CELL))
    pivots = np.zeros((0, 0))
    if most > 1:
        # About 8 candidates a pivot, by a hash, so that none is missed only by where it stands.
        share = min(1.0, 8 * most / n_classes)
        drawn = marked.filter("large").filter(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(share * (1 << 30)))
        sample = drawn.select("vector").limit(16 * most).toArrow().column(0).combine_chunks()
        pivots = choose_pivots(list(_rows(sample)), most, radius)
    shared = spark.sparkContext.broadcast(pivots)
    reach = np.full(len(pivots), -1.0)
    facts = marked.select("cid", "large", "n", "vector")
    if len(pivots):
        farthest = facts.mapInArrow(_greatest(shared), "cell int, distance double")
        for cell, distance in farthest.groupBy("cell").agg(F.max("distance")).collect():
            reach[cell] = distance
    member = facts.mapInArrow(_members(shared, spark.sparkContext.broadcast(reach), radius), "cid bigint, cells array<int>")
    member = stored(member, "cells")
    placed = marked.join(member.withColumnRenamed("cid", "member"), F.col("cid") == F.col("member"))
    spread = placed.select("cid", "label", "n", "vector", F.posexplode("cells").alias("at", "cell"))
    counted = spread.groupBy("label", "cell").agg(F.count("*").alias("members"))
    cut = F.broadcast(_large(counted, ["label", "cell"], n_classes, "blocks"))
    same = (F.col("label") == F.col("large_label")) & (F.col("cell") == F.col("large_cell"))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    every = F.sequence(F.lit(0), blocks - 1)

    # A home vector meets all blocks as the left side, and as a right side the homes before it.
    # A replica meets homes only.
    def met(u: Column, v: Column, side: int) -> Column:
        return F.struct(u.cast("int").alias("u"), v.cast("int").alias("v"), F.lit(side).alias("side"))

    left = F.transform(every, lambda v: met(own, v, 0))
    right = F.transform(F.filter(every, lambda u: u < own), lambda u: met(u, own, 1))
    replica = F.transform(every, lambda u: met(u, own, 1))
    spread = spread.join(cut, same, "left").select(
        "cid", "label", "n", "vector", "cell",
        F.inline(F.when(F.col("at") == 0, F.concat(left, right)).otherwise(replica)),
    )
    return spread.groupBy("label", "cell", "u", "v").applyInArrow(
        _block_join(least), "cid bigint, links bigint, root bigint"
    )


def link_embeddings(
    rows: DataFrame,
    identity: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.98,
) -> DataFrame:
    """(identity, n_links, component_id, kept) of each row.

    Vectors of one label are linked if their cosine is at least ``least``. n_links counts the
    other vectors linked; component_id is the smallest identity reachable by links.
    """
    facts = rows.select(
        F.col(identity).alias("id"),
        F.when(F.col(label).isNotNull(), vector_digest(F.col(vector))).alias("digest"),
        F.col(label).alias("label"),
        F.col(vector).alias("vector"),
    )
    classes = facts.filter("digest IS NOT NULL").groupBy("label", "digest").agg(
        F.min("id").alias("least"), F.count("*").alias("n"), F.first("vector").alias("vector")
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = stored(_links(classes, least), "links")
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("cid").agg(F.sum("links").alias("links"))
    linked = linked.join(roots, F.col("cid") == F.col("node")).select(
        F.col("cid").alias("linked"), "links", "root"
    )
    named = classes.select("cid", "label", "digest", "least", "n").join(
        linked, F.col("cid") == F.col("linked"), "left"
    )
    named = named.withColumn("root", F.coalesce("root", "cid"))
    smallest = named.groupBy(F.col("root").alias("top")).agg(F.min("least").alias("smallest"))
    named = named.join(smallest, F.col("root") == F.col("top")).select(
        F.col("label").alias("own_label"),
        F.col("digest").alias("own_digest"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
        "smallest",
    )
    # Rows without links get keys of their own, or they would all meet in one task.
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string")).cast("binary")
    placed = facts.select("id", "label", F.coalesce("digest", alone).alias("digest"))
    same = F.col("label").eqNullSafe(F.col("own_label")) & (F.col("digest") == F.col("own_digest"))
    component = F.coalesce("smallest", "id")
    return placed.join(named, same, "left").select(
        F.col("id").alias(identity),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
