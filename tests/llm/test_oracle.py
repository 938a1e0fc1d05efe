"""Every query of the operators on the given tables: against its SQL where there is some, else
against what its contract says of every row."""

import os
import zlib

import pytest

from talmir.llm.common import table
from talmir.llm.oracle import ORACLE_SQL
from talmir.llm.queries import QUERIES
from tests.conftest import TESTDATA
from tests.test_oracle import assert_matches_sql, database  # noqa: F401

FOLDER = os.path.join(TESTDATA, "sf0.01")
# op6, op7 and op13 as queries are tested beside their operators, or below.
WITH_SQL = sorted(n for n in QUERIES if n in ORACLE_SQL)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_sql(spark, database, name):  # noqa: F811
    assert_matches_sql(spark, database, name)


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in table(spark, FOLDER, "documents").collect()}


def test_every_query_is_tested_here():
    rest = {"op4_sentencepiece", "op5_sharding", "op6_quality", "op7_simhash", "op8_fingerprints", "op13_alignment"}
    assert set(QUERIES) == set(WITH_SQL) | rest


def test_op4_pieces_decode_to_the_text(spark, documents):
    rows = QUERIES["op4_sentencepiece"](spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == documents.keys() and len(rows) == len(documents)
    assert all(r.round_trip and r.n_pieces == len(r.pieces) and bool(r.pieces) == bool(documents[r.doc_id]) for r in rows)


def test_op5_law_of_rows(spark, documents):
    rows = QUERIES["op5_sharding"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    shards = {}
    for r in rows:
        data = documents[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
        shards.setdefault(r.shard, []).append(r.slot)
    assert set(shards) == set(range(24))
    assert all(sorted(slots) == list(range(len(slots))) for slots in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    places = {}
    for r in rows:
        places.setdefault(documents[r.doc_id], []).append(r.shard)
    # A group that fits its shard is not cut, but for groups that quotas leave no room for.
    cut = sum(len(s) - max(map(s.count, s)) for s in places.values())
    assert cut <= 0.1 * sum(len(s) - 1 for s in places.values())


def test_op7_components_equal_brute_force(spark, documents):
    from tests.llm.test_simhash import plain_fingerprint, plain_groups

    ids = sorted(documents)
    values = [plain_fingerprint(documents[i]) for i in ids]
    expected = {i: (f"{v:016x}", ids[root]) for i, v, root in zip(ids, values, plain_groups(values, 3))}
    rows = QUERIES["op7_simhash"](spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == expected


def test_op8_edited_texts(spark, documents):
    import hashlib

    ids = sorted(documents, reverse=True)
    rows = {r.doc_id: r for r in QUERIES["op8_fingerprints"](spark, FOLDER).collect()}
    assert rows.keys() == documents.keys()
    known = {}
    for i, after in zip(ids, [*ids[1:], ids[0]]):
        text, other = documents[i], documents[after]
        n = len(text) // 3
        edited = text[: len(text) - n] + other[:n]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
        for t, f in ((text, rows[i].fingerprint), (edited, rows[i].edited_fingerprint)):
            assert known.setdefault(t, f) == f
        if text == other:
            assert rows[i].near_next == 1


def test_op13_counts(spark, documents):
    rows = QUERIES["op13_alignment"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        assert r.n_groups <= min(r.n_a, r.n_b) and r.n_links >= max(r.n_a, r.n_b)
        assert 0 <= r.n_best <= r.n_links <= r.count_sum <= r.n_links * len(documents)
        assert bool(r.groups_sha256) == bool(r.n_a)
