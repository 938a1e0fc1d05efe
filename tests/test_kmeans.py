import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talmir.operators import clusters, kmeans, silhouette
from talmir.operators.kernels import first_points
from tests.plans import plan
from tests.test_clusters import frame


@pytest.fixture(scope="module")
def cloud():
    return np.random.default_rng(5).normal(size=(200, 4))


def centres_of(df):
    return np.array([r.centre for r in df.orderBy("cid").collect()])


def by_hand(points, k, iters, seed):
    def order(i):
        return hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i

    centres = points[sorted(range(len(points)), key=order)[:k]].copy()
    for _ in range(iters):
        distances = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
        labels = distances.argmin(axis=1)
        for c in set(labels.tolist()):
            centres[c] = points[labels == c].mean(axis=0)
    return centres


@pytest.mark.parametrize("k, iters", [(1, 3), (3, 0), (3, 1), (5, 6)])
@pytest.mark.parametrize("partitions", [1, 7])
def test_lloyd_equals_a_plain_loop(spark, cloud, k, iters, partitions):
    df = frame(spark, cloud, [0] * len(cloud)).repartition(partitions)
    actual = centres_of(kmeans.lloyd_kmeans(df, k, iters, 2, "id"))
    np.testing.assert_allclose(actual, by_hand(cloud, k, iters, 2), rtol=1e-10, atol=1e-12)


def test_lloyd_without_ids_is_repeatable(spark, cloud):
    df = frame(spark, cloud, [0] * len(cloud))
    one = centres_of(kmeans.lloyd_kmeans(df.repartition(1), 4, 3, 1))
    other = centres_of(kmeans.lloyd_kmeans(df.repartition(9), 4, 3, 1))
    np.testing.assert_allclose(one, other)


def test_empty_cluster_keeps_its_centre(spark):
    # All points move to the first centre by hash, or to the other: one stays behind.
    sets = [[[0.0], [100.0], [200.0]]]
    df = frame(spark, [[0.0], [2.0], [101.0]], [0] * 3)
    moved = {(r.s, r.cid): r["mean"] for r in kmeans._step(df, sets).collect()}
    assert moved == {(0, 0): [1.0], (0, 1): [101.0]}


@pytest.mark.parametrize("id_column", ["id", None])
def test_start_points_differ(spark, id_column):
    points = [[0.0, 0.0]] * 50 + [[1.0, 1.0]] * 50 + [[5.0, 5.0], [6.0, 6.0], [7.0, 7.0]]
    df = frame(spark, points, [0] * len(points))
    centres = kmeans._initial_centres(df, 3, 3, id_column)
    assert len({tuple(c) for c in centres}) == 3
    every = kmeans._initial_centres(df, 9, 3, id_column)
    assert sorted(c[0] for c in every) == [0, 1, 5, 6, 7]


def test_start_looks_past_copies(spark):
    # The first hundreds by hash are copies of one point.
    df = frame(spark, [[0.0]] * 3000 + [[1.0], [2.0]], [0] * 3002)
    assert sorted(kmeans._initial_centres(df, 3, 1, None)) == [[0.0], [1.0], [2.0]]


def test_one_cluster_is_the_mean(spark, cloud):
    df = frame(spark, cloud, [0] * len(cloud))
    for trainer in (kmeans.kmeans, kmeans.lloyd_kmeans):
        np.testing.assert_allclose(centres_of(trainer(df, 1, 3, 1))[0], cloud.mean(axis=0))


@pytest.mark.parametrize("h", [1, 3])
def test_sweep_reads_its_source_no_more_for_more_k(spark, cloud, tmp_path, h):
    frame(spark, cloud, [0] * len(cloud)).write.parquet(str(tmp_path / "points"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches

    source = spark.read.parquet(str(tmp_path / "points")).coalesce(1)
    df = source.mapInArrow(counted, source.schema)
    iters = 2
    kmeans.k_sweep(df, 2, h, iters, 40, 1, "id").collect()
    assert reads.value <= iters + 4


def test_fewer_points_than_centres(spark):
    df = frame(spark, [[0.0], [4.0]], [0, 0])
    centres = centres_of(kmeans.lloyd_kmeans(df, 5, 2, 1, "id"))
    assert sorted(centres.ravel().tolist()) == [0.0, 4.0]


def test_random_start_finds_separate_groups(spark):
    rng = np.random.default_rng(1)
    points = np.vstack([rng.normal(0, 0.1, (60, 2)), rng.normal(9, 0.1, (60, 2))])
    centres = centres_of(kmeans.kmeans(frame(spark, points, [0] * 120), 2, 10, 3))
    np.testing.assert_allclose(sorted(centres[:, 0]), [0, 9], atol=0.2)


@pytest.mark.parametrize("k", [0, -1])
def test_no_clusters(spark, cloud, k):
    df = frame(spark, cloud, [0] * len(cloud))
    for trainer in (kmeans.kmeans, kmeans.lloyd_kmeans):
        with pytest.raises(ValueError, match="at least 1"):
            trainer(df, k, 1, 1)


def test_sweep(spark, cloud):
    df = frame(spark, cloud, [0] * len(cloud))
    rows = kmeans.k_sweep(df, 2, 3, 2, 40, 1, "id").collect()
    assert [r.k for r in rows] == [2, 3, 4]
    for row in rows:
        centres = kmeans.lloyd_kmeans(df, row.k, 2, 1, "id")
        assigned = clusters.assign_clusters(df, centres)
        # t is 40 / 3 for k = 3: not a whole number.
        one = silhouette.approx_silhouette(assigned, 40 / row.k, row.k, 1, "id").first()
        assert (row.n, row.silhouette) == (200, pytest.approx(one.silhouette))


def test_sweep_with_random_start(spark, cloud):
    df = frame(spark, cloud, [0] * len(cloud))
    rows = kmeans.k_sweep(df, 2, 2, 5, 100, 1, "id", random_start=True).collect()
    assert [(r.k, r.n) for r in rows] == [(2, 200), (3, 200)]
    assert all(-1 <= r.silhouette <= 1 for r in rows)


def test_sweep_needs_two_clusters(spark, cloud):
    with pytest.raises(ValueError, match="at least 2"):
        kmeans.k_sweep(frame(spark, cloud, [0] * 200), 1, 2, 1, 10, 1)


def test_start_search_shuffles_few_points_for_many_centres(spark):
    """k = 2000: each of 5 tasks hands over the first 2000 of its 6000 different points, at most."""
    k, rows = 2000, 60_000
    x = F.col("id") % 30_000  # each point twice
    df = spark.range(0, rows, 1, 5).select("id", F.array(x.cast("double"), F.lit(0.5)).alias("point"))
    candidates = kmeans._start_candidates(df, k, 3, "id")
    assert candidates.count() <= 5 * k
    text = plan(candidates)
    assert "MapInArrow" in text and "Exchange" not in text and "Window" not in text
    centres = kmeans._initial_centres(df, k, 3, "id")
    first = sorted(range(rows), key=lambda i: hashlib.md5(f"{i}:3".encode()).hexdigest())
    expected = list(dict.fromkeys([i % 30_000 for i in first]))[:k]
    assert [c[0] for c in centres] == expected


@pytest.mark.parametrize("count", [1, 3, 50])
def test_first_points_of_firsts_are_the_firsts(count):
    """Any cut into batches and rounds, points that repeat, and equal hashes."""
    rng = np.random.default_rng(count)
    # Zeros of both signs are one point; no two rows have the same hash and tie.
    rows = [(f"{rng.integers(40):02}", i, [float(rng.integers(30)) * rng.choice([-0.0, 1.0])]) for i in range(300)]
    schema = pa.schema([("hash", pa.string()), ("tie", pa.int64()), ("point", pa.list_(pa.float64()))])

    def batch(some):
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    keep = first_points(count)
    parts = [keep(iter([batch(rows[i : i + 10]) for i in range(a, a + 100, 10)])) for a in (0, 100, 200)]
    found = [tuple(r.values()) for out in keep(b for part in parts for b in part) for r in out.to_pylist()]
    best = {}
    for h, t, (x,) in rows:
        best[x] = min((h, t), best.get(x, (h, t)))
    assert found == [(h, t, [x]) for x, (h, t) in sorted(best.items(), key=lambda i: i[1])][:count]
    assert list(keep(iter([]))) == []
