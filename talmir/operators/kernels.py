"""Distances from a batch of points to k centres, as Arrow functions.

Spark partitions the points and hands each task its rows in Arrow batches. Only the point
crosses to Python; every other column stays in the JVM. The same sums
written with higher-order functions cost about 200 ns of a core per coordinate, against
about 2 ns here (and 3 us to hand over a point of 64 dimensions), which decides the run time
once there are many points, dimensions or centres.

Centres and statistics are a model of k rows. They are broadcast, and each task goes through
them in one pass over its points, whatever k is.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F

# Sent to the workers with each function, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows handled at a time, so that a block of 64-dimensional points fits a core's cache.
BLOCK_ROWS = 2048


def to_matrix(points: pa.Array, dimensions: int) -> np.ndarray:
    """An Arrow array of coordinate lists as an n x d matrix."""
    same = pc.all(pc.equal(pc.list_value_length(points), dimensions)).as_py()
    values = points.flatten()
    if points.null_count or values.null_count or same is False:
        raise ValueError(f"every point must have {dimensions} coordinates, none of them NULL")
    matrix = values.to_numpy(zero_copy_only=False).reshape(len(points), dimensions)
    if not np.isfinite(matrix).all():
        raise ValueError("a coordinate is NaN or infinite")
    return matrix


def _once(function):
    # Else a filter on the result would be pushed below it, and compute it a second time.
    return function.asNondeterministic()


def _squared_distances(matrix: np.ndarray, centre: np.ndarray) -> np.ndarray:
    # Differences first: exact zeros stay exact, whatever the size of the coordinates.
    with np.errstate(over="ignore"):
        difference = matrix - centre
        return np.einsum("ij,ij->i", difference, difference)


def _blocks(n: int):
    return (slice(start, start + BLOCK_ROWS) for start in range(0, n, BLOCK_ROWS))


def nearest(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of each row's nearest centre. The first wins ties, and where all overflow."""
    result = np.zeros(len(matrix), dtype=np.int32)
    for rows in _blocks(len(matrix)):
        best_d = np.full(len(matrix[rows]), np.inf)
        for index, centre in enumerate(centres):
            distance = _squared_distances(matrix[rows], centre)
            closer = distance < best_d
            best_d[closer] = distance[closer]
            result[rows][closer] = index
    return result


def nearest_centre(model):
    """Function of a point to the id of the nearest centre; ``model``: broadcast (ids, matrix)."""

    @F.arrow_udf("int")
    def find(point: pa.Array) -> pa.Array:
        ids, centres = model.value
        return pa.array(ids[nearest(to_matrix(point, centres.shape[1]), centres)])

    return _once(find)


def nearest_in_sets(model):
    """Function of a point to one (cid, p) for each set; ``model``: broadcast list of
    (matrix of centres, a number p for each of them)."""

    @F.arrow_udf("array<struct<cid: int, p: double>>")
    def find(point: pa.Array) -> pa.Array:
        sets = model.value
        matrix = to_matrix(point, sets[0][0].shape[1])
        cids = np.column_stack([nearest(matrix, centres) for centres, _ in sets])
        p = np.column_stack([own[cids[:, s]] for s, (_, own) in enumerate(sets)])
        pairs = pa.StructArray.from_arrays([pa.array(cids.ravel()), pa.array(p.ravel())], ["cid", "p"])
        return pa.ListArray.from_arrays(np.arange(len(matrix) + 1, dtype=np.int32) * len(sets), pairs)

    return _once(find)


def partial_means(model):
    """Function of batches of points to (s, cid, n, mean): a row per set of centres, centre and
    partition. Each point counts for its nearest centre of each set; ``model``: broadcast list
    of matrices."""

    def combine(batches):
        sets = model.value
        counts = [np.zeros(len(centres), dtype=np.int64) for centres in sets]
        sums = [np.zeros_like(centres) for centres in sets]
        for batch in batches:
            matrix = to_matrix(batch.column(0), sets[0].shape[1])
            for rows in _blocks(len(matrix)):
                for s, centres in enumerate(sets):
                    best = nearest(matrix[rows], centres)
                    counts[s] += np.bincount(best, minlength=len(centres))
                    for index in np.unique(best):
                        sums[s][index] += matrix[rows][best == index].sum(axis=0)
        for s in range(len(sets)):
            used = np.flatnonzero(counts[s])
            means = sums[s][used] / counts[s][used, None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), s), pa.int32()),
                    pa.array(used, pa.int32()),
                    pa.array(counts[s][used], pa.int64()),
                    pa.array(list(means), pa.list_(pa.float64())),
                ],
                ["s", "cid", "n", "mean"],
            )

    return combine


def first_points(count: int):
    """Function of batches (hash, tie, point) to the ``count`` different points that come first by
    (hash, tie), in this order.

    It holds 2 * count points at most, and once it has that many looks at smaller hashes only.
    Firsts of firsts are the firsts of all, so parts can be combined in any number of rounds.
    """

    def keep(batches):
        kept: dict[bytes, tuple] = {}
        schema, least = None, None

        def prune():
            return dict(sorted(kept.items(), key=lambda x: x[1][:2])[:count])

        for batch in batches:
            schema = batch.schema
            if least is not None:
                batch = batch.filter(pc.less_equal(batch.column(0), least))
            if not batch.num_rows:
                continue
            matrix = to_matrix(batch.column(2), len(batch.column(2)[0]))
            hashes, ties = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row in sorted(range(len(hashes)), key=hashes.__getitem__):
                point = (matrix[row] + 0.0).tobytes()  # -0.0 is 0.0
                found = (hashes[row], ties[row], matrix[row])
                if point not in kept or found[:2] < kept[point][:2]:
                    kept[point] = found
                if len(kept) >= 2 * count:
                    kept = prune()
                    least = max(x[0] for x in kept.values())
                    if hashes[row] > least:  # the rest of the batch comes later still
                        break
        if kept:
            columns = list(zip(*prune().values()))
            columns[2] = [x.tolist() for x in columns[2]]
            arrays = [pa.array(list(x), field.type) for x, field in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return keep


def nearest_so_far(model):
    """Function of (point, best) to best (d, cid): the nearest of a block of centres and those
    before; ``model``: broadcast (ids, matrix)."""

    @F.arrow_udf("struct<d: double, cid: int>")
    def find(point: pa.Array, best: pa.Array) -> pa.Array:
        ids, centres = model.value
        matrix = to_matrix(point, centres.shape[1])
        d = best.field("d").to_numpy(zero_copy_only=False).copy()
        cid = best.field("cid").to_numpy(zero_copy_only=False).copy()
        index = nearest(matrix, centres)
        own = _squared_distances(matrix, centres[index])
        # NULL (NaN here) stands for none yet. Earlier blocks have lower ids, which win ties.
        closer = np.isnan(d) | (own < d)
        d[closer], cid[closer] = own[closer], ids[index[closer]]
        return pa.StructArray.from_arrays([pa.array(d), pa.array(cid.astype(np.int32))], ["d", "cid"])

    return _once(find)


def running_sample(t: float):
    """Function of batches (cluster, u, row) to (cluster, n, u, row): rows that a sample may need, and
    then, with row NULL, how many rows of each cluster the task has read.

    A row is kept if u < t / (rows of its cluster so far, itself included). The cluster has at
    least as many rows in all, so what u < t / size keeps is kept here; a task keeps about
    t * (1 + ln(rows / t)) rows of a cluster.
    """

    def keep(batches):
        counts: dict = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            labels, which = np.unique(np.array(batch.column(0).to_pylist(), object).astype(str), return_inverse=True)
            order = np.argsort(which, kind="stable")
            sizes = np.bincount(which, minlength=len(labels))
            place = np.empty(len(which), np.int64)
            place[order] = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            firsts = order[np.cumsum(sizes) - sizes]
            before = np.array([counts.get(label, (0,))[0] for label in labels], np.int64)
            u = batch.column(1).to_numpy(zero_copy_only=False)
            some = pa.array(u < t / (before[which] + place + 1))
            for label, size, first in zip(labels, sizes.tolist(), firsts.tolist()):
                n, value = counts.get(label, (0, batch.column(0)[first]))
                counts[label] = n + size, value
            found = batch.filter(some)
            n = pa.nulls(found.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [found.column(0), n, found.column(1), found.column(2)], ["cluster", "n", "u", "row"]
            )
        if counts:
            n, values = zip(*counts.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v.as_py() for v in values], schema.field(0).type), pa.array(n, pa.int64()),
                 pa.nulls(len(n), pa.float64()), pa.nulls(len(n), schema.field(2).type)],
                ["cluster", "n", "u", "row"],
            )

    return keep


class ClusterStatistics:
    """Per cluster: what the mean distance of any point to its sample depends on.

    The squared distances from p to the sampled points of a cluster add up to
    ``ns * |p - mean|^2 + scatter``. No term is negative, so nothing cancels.
    """

    def __init__(self, rows):
        sampled = [row["mean"] for row in rows if row["mean"] is not None]
        self.dimensions = len(sampled[0]) if sampled else None
        self.clusters = [
            (
                row["cluster"],
                float(row["ns"]),
                None if row["mean"] is None else np.array(row["mean"], dtype=np.float64),
                row["scatter"],
                row["denominator"],
            )
            for row in rows
        ]

    def distances(self, points: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's mean distance to its own cluster, and the least one to another (or inf)."""
        matrix = None if self.dimensions is None else to_matrix(points, self.dimensions)
        own, other = np.full(len(labels), np.nan), np.full(len(labels), np.inf)
        for rows in _blocks(len(labels)):
            block_labels, block_own, block_other = labels[rows], own[rows], other[rows]
            for cluster, ns, mean, scatter, denominator in self.clusters:
                if mean is None:
                    # Nothing drawn from this cluster: its sum, and so its mean, is 0.
                    distance = np.zeros(len(block_labels))
                else:
                    sums = ns * _squared_distances(matrix[rows], mean) + scatter
                    distance = sums / denominator
                mine = block_labels == cluster
                block_own[mine] = distance[mine]
                np.minimum(block_other, distance, out=block_other, where=~mine)
        return own, other

    def coefficients(self, points: pa.Array, labels: np.ndarray) -> np.ndarray:
        """(b - a) / max(a, b), 0 where both are 0; only of rows that have another cluster."""
        own, other = self.distances(points, labels)
        there = other < np.inf
        own, other = own[there], other[there]
        larger = np.maximum(own, other)
        return np.divide(other - own, larger, out=np.zeros(len(own)), where=larger != 0)


def mean_distances(model):
    """Function of (point, cluster) to (own, other); ``model``: broadcast statistics."""

    @F.arrow_udf("struct<own: double, other: double>")
    def fold(point: pa.Array, cluster: pa.Array) -> pa.Array:
        both = model.value.distances(point, cluster.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x) for x in both], ["own", "other"])

    return _once(fold)


SCORES = "key int, n bigint, scored bigint, total double"


def score_sums(model, centres=None, keyed: bool = False):
    """Function of batches (point, cluster) to SCORES: per key of the statistics and partition,
    the points, those with a coefficient, and the sum of these.

    ``model``: broadcast statistics by key. Labels come from the batch, or for key i are the
    nearest of the i-th matrix of ``centres``. ``keyed``: a third column names the one key that
    a row belongs to; else every row counts for every key.
    """

    def combine(batches):
        statistics = model.value
        sums = {key: [0, 0, 0.0] for key in statistics}

        def add(key, points, labels):
            values = statistics[key].coefficients(points, labels)
            sums[key][0] += len(labels)
            sums[key][1] += len(values)
            sums[key][2] += float(values.sum())

        for batch in batches:
            points = batch.column(0)
            if centres is not None:
                matrix = to_matrix(points, centres.value[0].shape[1])
                for key in statistics:
                    add(key, points, nearest(matrix, centres.value[key]))
                continue
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            if not keyed:
                for key in statistics:
                    add(key, points, labels)
                continue
            keys = batch.column(2).to_numpy(zero_copy_only=False)
            for key in np.unique(keys).tolist():
                rows = np.flatnonzero(keys == key)
                add(key, points.take(pa.array(rows)), labels[rows])
        rows = [(key, *values) for key, values in sums.items() if values[0]]
        if rows:
            types = [pa.int32(), pa.int64(), pa.int64(), pa.float64()]
            arrays = [pa.array(list(x), t) for x, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "n", "scored", "total"])

    return combine
