"""The metric range join against all pairs."""

import math

import numpy as np
import pytest

from talmir.llm import embeddings
from talmir.llm.common import table
from tests.conftest import TESTDATA

SCHEMA = "vec_id bigint, embedding array<double>, label int, cid int, cells string"


def plain(rows, least=0.98):
    """Sorted (identity, n_links, component_id, kept)."""

    def good(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))
    unit = [np.array(r[1]) if good(r[1], r[2]) else None for r in rows]
    for i in range(n):
        for j in range(i):
            if unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if embeddings.exact_cosine(unit[i], unit[j]) >= least:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [a if x == b else x for x in root]
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((r[0], links[i], component, r[0] == component))
    return sorted(out, key=str)


def found(spark, rows, parts=3, schema=SCHEMA, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], schema).repartition(parts)
    return sorted(map(tuple, embeddings.link_embeddings(df, **options).collect()), key=str)


def clouds(seed, n, size, labels=2, centres=12, noise=0.08):
    """Vectors around centres, exact copies, chains of neighbours, other lengths."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, size))
    rows = []
    for i in range(n):
        v = middle[rng.integers(centres)] * rng.uniform(0.5, 2) + noise * rng.normal(size=size) * rng.integers(0, 4)
        if rows and rng.random() < 0.2:
            v = np.array(rows[rng.integers(len(rows))][1][:size])
        rows.append((i * 7 % n, [float(x) for x in v], int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("seed, size, cell", [(1, 3, 10), (2, 6, 5), (3, 16, 25), (4, 2, 4), (5, 6, 10_000)])
def test_equals_all_pairs(spark, monkeypatch, seed, size, cell):
    """Small cells, so that there are pivots, replicas and blocks."""
    monkeypatch.setattr(embeddings, "CELL", cell)
    monkeypatch.setattr(embeddings, "TILE", 7)
    rows = clouds(seed, 160, size)
    assert found(spark, rows) == plain(rows)


ODD = [
    (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [float("nan"), 1.0], 0),
    (6, [float("inf"), 1.0], 0), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (8, [1.0, 0.0], 0), (9, [2.0, -0.0], 0),
    (None, [1.0, 0.0], 0), (None, [1.0, 1e-3], 0), (10, [1e300, 0.0], 0), (11, [1e-300, 1e-302], 0),
    (12, [1.0, 0.0, 0.0], 0), (13, [-1.0, 0.0], 0), (None, [0.0, 1.0], 1), (None, None, None), (8, [0.0, 1.0], 2),
]


def test_odd_vectors(spark):
    assert found(spark, ODD) == plain(ODD)


def test_threshold_itself_is_a_link(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [0.6, 0.8], 0), (3, [0.6 - 1e-12, 0.8], 0), (4, [3.0, 4.0], 0)]
    assert found(spark, rows, least=0.6) == plain(rows, 0.6)


def test_one_dense_group_in_blocks(spark, monkeypatch):
    """A third of all vectors around one centre, more than a cell should hold."""
    monkeypatch.setattr(embeddings, "CELL", 8)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(120)]
    rows += [(1000 + i, (np.ones(8) + 0.02 * rng.normal(size=8)).tolist(), 0) for i in range(60)]
    assert found(spark, rows) == plain(rows)
    assert max(r[1] for r in plain(rows)) == 59


def test_no_rows(spark):
    assert found(spark, []) == []


def test_given_vectors_with_planted_copies(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 20)
    given = [(r.vec_id, r.embedding, r.label) for r in table(spark, f"{TESTDATA}/sf0.001", "embeddings").collect()]
    rng = np.random.default_rng(2)
    near = [(10_000 + i, (np.array(v) + 0.01 * rng.normal(size=len(v))).tolist(), x) for i, v, x in given[:40]]
    far = [(20_000 + i, (np.array(v) + 0.05 * rng.normal(size=len(v))).tolist(), x) for i, v, x in given[:40]]
    rows = (given + near + far)[-200:]
    assert found(spark, rows) == plain(rows)


def test_pivots_lie_apart():
    rng = np.random.default_rng(1)
    sample = [rng.normal(size=4) for _ in range(300)] + [np.ones(3)]
    pivots = embeddings.choose_pivots(sample, 50, 0.2)
    gaps = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))[np.triu_indices(len(pivots), 1)]
    assert 5 < len(pivots) <= 50 and gaps.min() > 0.8
