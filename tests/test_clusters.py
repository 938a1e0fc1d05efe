import numpy as np
import pytest
from pyspark.sql import functions as F

from talmir.functions import squared_distance, unit_draw
from talmir.operators import clusters, silhouette
from talmir.operators.kernels import running_sample, to_matrix
from tests.plans import plan, uses_python

SCHEMA = "id bigint, point array<double>, cluster int"


def frame(spark, points, labels):
    rows = [(i, [float(x) for x in p], int(c)) for i, (p, c) in enumerate(zip(points, labels))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def blobs():
    """Three well separated groups of 300, 40 and 8 points, far from the origin."""
    rng = np.random.default_rng(3)
    labels = np.repeat([0, 1, 2], [300, 40, 8])
    centres = np.array([[40.0, -74.0, 0.0], [41.0, -73.0, 1.0], [40.5, -72.0, 2.0]])
    return centres[labels] + rng.normal(scale=0.2, size=(len(labels), 3)), labels


def by_pairs(points, labels, sampled, t):
    """a, b and s of every point, from all pairs of a point and a sampled point."""
    points, labels = np.array(points, dtype=float), np.array(labels)
    present = sorted(set(labels.tolist()))
    result = []
    for p, own in zip(points, labels):
        m = {}
        for c in present:
            q = points[sampled & (labels == c)]
            m[c] = ((q - p) ** 2).sum() / min(t, (labels == c).sum())
        a = m[own]
        b = min(v for c, v in m.items() if c != own)
        result.append((a, b, 0.0 if max(a, b) == 0 else (b - a) / max(a, b)))
    return np.array(result)


def scored(df):
    rows = df.orderBy("id").select("a", "b", "s").collect()
    return np.array([tuple(r) for r in rows])


def ids(df):
    return sorted(r.id for r in df.collect())


def mask(n, kept):
    return np.isin(np.arange(n), kept)


def test_squared_distance_has_no_root(spark):
    df = spark.createDataFrame([([0.0, 3.0], [4.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(squared_distance(F.col("a"), F.col("b"))).first()[0] == 25.0


def test_draws_look_uniform(spark):
    df = spark.range(20_000).select(unit_draw(1, F.col("id")).alias("u"))
    low, high, mean, tenth = df.agg(
        F.min("u"), F.max("u"), F.avg("u"), F.avg((F.col("u") < 0.1).cast("int"))
    ).first()
    assert 0 <= low and high < 1
    assert mean == pytest.approx(0.5, abs=0.01)
    assert tenth == pytest.approx(0.1, abs=0.01)


def test_sizes(spark, blobs):
    sizes = {tuple(r) for r in clusters.cluster_sizes(frame(spark, *blobs)).collect()}
    assert sizes == {(0, 300), (1, 40), (2, 8)}


def test_small_clusters_are_sampled_whole(spark, blobs):
    sample = clusters.sample_clusters(frame(spark, *blobs), 50, 1, 3, "id")
    sizes = {r.cluster: r.n_sampled for r in clusters.sample_sizes(sample).collect()}
    assert (sizes[1], sizes[2]) == (40, 8)
    assert 25 < sizes[0] < 80


@pytest.mark.parametrize("id_column", ["id", None])
def test_sample_does_not_depend_on_partitions_or_on_k(spark, blobs, id_column):
    points = np.vstack([blobs[0], np.repeat(blobs[0][:1], 30, axis=0)])
    labels = np.concatenate([blobs[1], np.zeros(30, dtype=int)])
    df = frame(spark, points, labels)
    samples = []
    for n in (1, 4, 16):
        for k in (3, None, clusters.MAX_SMALL_K + 1):
            sample = clusters.sample_clusters(df.repartition(n), 30, 5, k, id_column)
            samples.append(sorted(str((r.point, r.cluster)) for r in sample.collect()))
    assert all(s == samples[0] for s in samples)
    assert clusters.sample_clusters(df, 30, 6, 3, id_column).collect() != samples[0]


def test_copies_are_drawn_independently(spark):
    df = frame(spark, [[1.0, 2.0]] * 4000, [0] * 4000)
    n = clusters.sample_clusters(df, 1000, 1, 1).count()
    assert 880 < n < 1120


@pytest.mark.parametrize("copy_run", [1, 7, 1000])
def test_copies_are_numbered_from_zero(spark, copy_run):
    df = frame(spark, [[1.0]] * 20 + [[2.0]] * 3 + [[1.0]] * 5, [0] * 23 + [1] * 5)
    rows = clusters.number_copies(df, copy_run).collect()
    assert sorted((r.point[0], r.cluster, r._copy) for r in rows) == (
        [(1.0, 0, i) for i in range(20)]
        + [(1.0, 1, i) for i in range(5)]
        + [(2.0, 0, i) for i in range(3)]
    )


@pytest.mark.parametrize("t", [1, 2.5, 10, 1000])
@pytest.mark.parametrize("seed", [0, 1])
def test_coefficients_equal_those_from_pairs(spark, blobs, t, seed):
    points, labels = blobs
    df = frame(spark, points, labels)
    sample = clusters.sample_clusters(df, t, seed, 3, "id")
    actual = scored(silhouette.silhouette_points(df, sample, t, 3))
    expected = by_pairs(points, labels, mask(len(labels), ids(sample)), t)
    np.testing.assert_allclose(actual, expected, rtol=1e-10, atol=1e-12)
    assert (np.abs(actual[:, 2]) <= 1).all()


def test_undrawn_cluster_is_at_distance_zero(spark):
    points, labels = [[0.0], [1.0], [9.0], [10.0]], [0, 0, 1, 1]
    df = frame(spark, points, labels)
    sample = df.filter("cluster = 0")
    rows = scored(silhouette.silhouette_points(df, sample, 2, 2))
    np.testing.assert_allclose(rows, by_pairs(points, labels, mask(4, [0, 1]), 2))
    assert (rows[:2, 2] == -1).all()


def test_only_sampled_point_of_its_cluster_has_a_of_exactly_zero(spark):
    points, labels = [[0.1, 1 / 3], [0.7, 5.0], [123.4, 0.3]], [0, 0, 1]
    df = frame(spark, points, labels)
    rows = scored(silhouette.silhouette_points(df, df.filter("id = 0"), 1, 2))
    assert rows[0].tolist() == [0, 0, 0]
    assert rows[1][2] == -1


def test_identical_points_in_two_clusters(spark):
    df = frame(spark, [[2.0, 2.0]] * 2, [0, 1])
    assert scored(silhouette.silhouette_points(df, df, 5, 2))[:, 2].tolist() == [0, 0]


def test_nothing_sampled_at_all(spark):
    df = frame(spark, [[1.0], [2.0]], [0, 1])
    assert scored(silhouette.silhouette_points(df, df.limit(0), 5, 2))[:, 2].tolist() == [0, 0]


def test_own_mean_is_not_corrected_for_the_point_itself(spark):
    df = frame(spark, [[0.0], [2.0], [10.0]], [0, 0, 1])
    a = scored(silhouette.silhouette_points(df, df, 10, 2))[0][0]
    assert a == 2.0


def test_approximate_equals_exact_when_all_is_sampled(spark, blobs):
    points, labels = blobs
    df = frame(spark, points, labels)
    approx = silhouette.approx_silhouette(df, 300, 3, 9, "id").first()
    exact = silhouette.exact_sample_silhouette(df, 300, 3, 9, "id").first()
    whole = by_pairs(points, labels, np.full(len(labels), True), 300)[:, 2].mean()
    assert approx.n == exact.n == len(labels)
    assert approx.silhouette == pytest.approx(whole, abs=1e-12)
    assert exact.silhouette == pytest.approx(whole, abs=1e-12)


def test_results_do_not_depend_on_partitions(spark, blobs):
    df = frame(spark, *blobs)
    values = {
        round(silhouette.approx_silhouette(df.repartition(n), 20, 3, 1, "id").first().silhouette, 9)
        for n in (1, 4, 16)
    }
    assert len(values) == 1


@pytest.mark.parametrize("k", [1, 0, -3])
def test_one_cluster_is_refused(spark, blobs, k):
    df = frame(spark, *blobs)
    with pytest.raises(ValueError, match="at least 2"):
        silhouette.approx_silhouette(df, 5, k, 1, "id")
    with pytest.raises(ValueError, match="at least 2"):
        silhouette.silhouette_points(df, df, 5, k)


@pytest.mark.parametrize("label", [3, -1, None])
def test_labels_outside_the_range_fail(spark, label):
    df = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], label)], SCHEMA)
    with pytest.raises(Exception, match="label not in 0 to 2"):
        silhouette.approx_silhouette(df, 5, 3, 1, "id").collect()


def test_unused_labels_are_ignored(spark):
    points, labels = [[0.0], [1.0], [9.0]], [0, 0, 4]
    df = frame(spark, points, labels)
    rows = scored(silhouette.silhouette_points(df, df, 3, 9))
    np.testing.assert_allclose(rows, by_pairs(points, labels, mask(3, [0, 1, 2]), 3))


def test_single_used_label_has_no_coefficient(spark):
    df = frame(spark, [[0.0], [1.0]], [0, 0])
    assert silhouette.approx_silhouette(df, 3, 2, 1, "id").first().silhouette is None


def test_no_points(spark):
    df = spark.createDataFrame([], SCHEMA)
    for operator in (silhouette.approx_silhouette, silhouette.exact_sample_silhouette):
        assert tuple(operator(df, 3, 2, 1, "id").first()) == (0, None)


def test_points_of_different_dimensions_fail(spark):
    df = frame(spark, [[0.0, 1.0], [1.0], [2.0, 3.0]], [0, 0, 1])
    with pytest.raises(Exception, match="(?i)coordinates|dimension|size|length"):
        silhouette.silhouette_points(df, df.filter("id <> 1"), 3, 2).collect()


def test_matrix_of_a_slice():
    import pyarrow as pa

    array = pa.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]]).slice(1)
    assert to_matrix(array, 2).tolist() == [[3.0, 4.0], [5.0, 6.0]]
    with pytest.raises(ValueError, match="2 coordinates"):
        to_matrix(pa.array([[1.0, 2.0], [3.0]]), 2)
    with pytest.raises(ValueError, match="2 coordinates"):
        to_matrix(pa.array([[1.0, None]]), 2)


def test_many_clusters_do_not_rewrite_the_points(spark, blobs, monkeypatch):
    df = frame(spark, *blobs)
    expected = scored(silhouette.silhouette_points(df, df, 400, 3))
    rows = [(i, [float(i), 0.0, 0.0]) for i in range(300)]
    centres = spark.createDataFrame(rows, "cid int, centre array<double>")
    assigned = ids(clusters.assign_clusters(df, centres).filter("cluster >= 0"))

    def refuse(_):
        raise AssertionError("the points were written")

    monkeypatch.setattr(clusters, "MAX_SMALL_K", 2)
    monkeypatch.setattr(clusters, "cut_lineage", refuse)
    monkeypatch.setattr(silhouette, "cut_lineage", refuse)
    np.testing.assert_allclose(scored(silhouette.silhouette_points(df, df, 400, 3)), expected)
    assert ids(clusters.assign_clusters(df, centres).filter("cluster >= 0")) == assigned


def test_models_have_a_bound(spark, monkeypatch):
    df = frame(spark, [[0.0, 1.0]], [0])
    centres = spark.createDataFrame([(0, [0.0, 0.0])] * 3, "cid int, centre array<double>")
    monkeypatch.setattr(clusters, "MAX_MODEL_NUMBERS", 5)
    with pytest.raises(ValueError, match="do not fit"):
        clusters.assign_clusters(df, centres)


@pytest.mark.parametrize("t", [0, -1, float("nan")])
def test_sample_size_must_be_positive(spark, blobs, t):
    df = frame(spark, *blobs)
    for call in (
        lambda: clusters.sample_clusters(df, t, 1, 3, "id"),
        lambda: silhouette.approx_silhouette(df, t, 3, 1, "id"),
        lambda: silhouette.exact_sample_silhouette(df, t, 3, 1, "id"),
        lambda: silhouette.silhouette_points(df, df, t, 3),
        lambda: silhouette.silhouette_trials(df, t, 3, 2, "id"),
    ):
        with pytest.raises(ValueError, match="above 0"):
            call()


def test_other_columns_may_have_any_name(spark, blobs):
    names = ["n", "copy", "trial", "own", "_row", "key", "mean", "start"]
    plain = frame(spark, *blobs)
    df = plain.select("*", *[F.lit("x").alias(name) for name in names])
    sample = clusters.sample_clusters(df, 20, 1, 3, "id")
    assert ids(sample) == ids(clusters.sample_clusters(plain, 20, 1, 3, "id"))
    assert clusters.sample_clusters(df, 20, 1, 3).count() == clusters.sample_clusters(plain, 20, 1, 3).count()
    for operator in (silhouette.approx_silhouette, silhouette.exact_sample_silhouette):
        assert operator(df, 20, 3, 1, "id").first() == operator(plain, 20, 3, 1, "id").first()
    assert silhouette.silhouette_trials(df, 20, 3, 2, "id").count() == 2
    points = silhouette.silhouette_points(df, sample, 20, 3)
    assert set(names) < set(points.columns) and points.count() == plain.count()


@pytest.mark.parametrize("bad", [float("nan"), float("inf")])
def test_points_must_be_finite(spark, bad):
    df = frame(spark, [[bad, 1.0], [0.0, 0.0]], [0, 1])
    centres = spark.createDataFrame([(0, [0.0, 0.0])], "cid int, centre array<double>")
    with pytest.raises(Exception, match="NaN or infinite"):
        clusters.assign_clusters(df, centres).collect()
    with pytest.raises(Exception, match="NaN or infinite"):
        silhouette.approx_silhouette(df, 5, 2, 1, "id").collect()


def test_overflowing_distances_go_to_the_first_centre(spark):
    df = frame(spark, [[1e200, 1e200], [3.0, 0.0]], [0, 0])
    centres = spark.createDataFrame([(4, [0.0, 0.0]), (7, [3.0, 0.0])], "cid int, centre array<double>")
    assert [r.cluster for r in clusters.assign_clusters(df, centres).orderBy("id").collect()] == [4, 7]


def test_trials(spark, blobs):
    df = frame(spark, *blobs)
    together = silhouette.silhouette_trials(df, 6, 3, 4, "id").orderBy("trial").collect()
    assert [r.trial for r in together] == [0, 1, 2, 3]
    for one in together:
        single = silhouette.approx_silhouette(df, 6, 3, one.trial, "id").first().silhouette
        assert one.approx == pytest.approx(single)
        exact = silhouette.exact_sample_silhouette(df, 6, 3, one.trial, "id").first()
        assert (one.n, one.n_sample) == (len(blobs[1]), exact.n)
        assert one.exact == pytest.approx(exact.silhouette)
    mean = silhouette.repeated_silhouette(df, 6, 3, 4, "id").first()
    assert mean.trials == 4
    assert mean.approx == pytest.approx(np.mean([r.approx for r in together]))
    assert mean.exact == pytest.approx(np.mean([r.exact for r in together]))


def test_trials_without_ids(spark, blobs):
    row = silhouette.repeated_silhouette(frame(spark, *blobs), 500, 3, 2).first()
    assert row.approx == pytest.approx(row.exact)
    with pytest.raises(ValueError, match="at least 1 trial"):
        silhouette.silhouette_trials(frame(spark, *blobs), 5, 3, 0)


def test_nearest_centre_and_ties(spark):
    df = frame(spark, [[0.0], [1.0], [1.1], [-5.0], [1e9]], [7] * 5)
    centres = spark.createDataFrame(
        [(2, [2.0]), (0, [0.0]), (1, [2.0])], "cid int, centre array<double>"
    )
    rows = clusters.assign_clusters(df, centres).orderBy("id").collect()
    assert [r.cluster for r in rows] == [0, 0, 1, 0, 1]
    assert set(rows[0].asDict()) == {"id", "point", "cluster"}


def test_no_centres(spark, blobs):
    none = spark.createDataFrame([], "cid int, centre array<double>")
    with pytest.raises(ValueError, match="no centres"):
        clusters.assign_clusters(frame(spark, *blobs), none)


def test_plans(spark, blobs, tmp_path):
    frame(spark, *blobs).write.parquet(str(tmp_path / "points"))
    df = spark.read.parquet(str(tmp_path / "points"))
    sample = plan(clusters.sample_clusters(df, 20, 1, 3, "id"))
    assert "BroadcastHashJoin" in sample
    assert "CartesianProduct" not in sample and "NestedLoop" not in sample
    assert not uses_python(sample)
    points = plan(silhouette.silhouette_points(df, df, 20, 3).select("id", "s"))
    assert "Exchange" not in points
    assert points.count("ArrowEvalPython") == 1
    # A filter on the label does not compute it twice.
    centres = spark.createDataFrame([(0, [0.0] * 3)], "cid int, centre array<double>")
    assigned = plan(clusters.assign_clusters(df, centres).filter("cluster = 0"))
    assert assigned.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("numbers", [1, 4, 7, 8, 1000])
def test_centres_in_blocks_give_the_same_clusters(spark, numbers):
    rng = np.random.default_rng(4)
    points = np.vstack([rng.normal(size=(60, 2)), [[0.5, 0.5], [1e200, 1e200]]])
    centres = [(i * 3, [float(x) for x in c]) for i, c in enumerate(rng.normal(size=(9, 2)))]
    centres += [(40, centres[2][1]), (41, [0.0, 0.5]), (42, [1.0, 0.5])]  # ties
    model = spark.createDataFrame(centres[::-1], "cid int, centre array<double>")
    df = frame(spark, points, [0] * len(points)).withColumns({"row": F.lit(1), "best": F.lit(2)})
    whole = clusters.assign_clusters(df, model)
    blocks = clusters.assign_clusters(df, model, model_numbers=numbers)
    assert blocks.columns == whole.columns
    assert sorted(map(str, blocks.collect())) == sorted(map(str, whole.collect()))
    assert clusters.assign_clusters(df.limit(0), model, model_numbers=numbers).count() == 0


@pytest.mark.parametrize("partitions, t", [(1, 3), (5, 3), (5, 0.5), (3, 1000)])
def test_one_pass_gives_the_same_sample(spark, partitions, t):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(i, [float(i), 1.0], None if i % 50 == 0 else i % 7 % 3, "x", i) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, point array<double>, cluster int, row string, n long").repartition(partitions)
    df.persist().count()
    counted = df.mapInArrow(count, df.schema)
    sample = clusters.sample_in_one_pass(counted, t, 5, "id")
    assert sample.columns == df.columns
    found = sorted(map(str, sample.collect()))
    assert found == sorted(map(str, clusters.sample_clusters(df, t, 5, id_column="id").select(*df.columns).collect()))
    assert sample.count() == len(found) and seen.value == 900
    assert clusters.sample_in_one_pass(df.limit(0), t, 5, "id").count() == 0


def test_one_pass_keeps_few_rows(spark):
    """About t * (1 + ln(n / t)) of each cluster and task."""
    df = spark.range(0, 40_000, 1, 4).select("id", F.array(F.col("id").cast("double")).alias("point"), (F.col("id") % 2).cast("int").alias("cluster"))
    rows = df.select("cluster", unit_draw(1, F.col("id")).alias("u"), F.struct("*").alias("row"))
    kept = rows.mapInArrow(running_sample(20.0), "cluster int, n long, u double, row struct<id: long, point: array<double>, cluster: int>")
    each = 20 * (1 + np.log(5000 / 20))
    assert kept.filter("n IS NULL").count() < 1.3 * 8 * each
    assert kept.filter("n IS NOT NULL").agg(F.sum("n")).first()[0] == 40_000
