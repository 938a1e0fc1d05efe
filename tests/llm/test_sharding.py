import pytest
from pyspark.sql import functions as F

from talmir.llm import sharding
from talmir.llm.common import number_rows


def graph(spark, n, hot, groups):
    """A third of n rows in one group (if hot), a third in so many groups, the others alone."""
    kind = F.col("id") % 3
    group = F.when((kind == 0) & F.lit(hot), F.lit("hot")).when(
        kind == 1, F.concat(F.lit("g"), (F.col("id") % groups).cast("string"))
    )
    return spark.range(n).select(F.col("id").alias("doc_id"), group.alias("g"), F.lit(1).alias("shard"))


@pytest.mark.parametrize("n, hot, groups", [(0, False, 1), (1, False, 1), (5, True, 2), (240, False, 60), (301, True, 30)])
def test_law_of_equal_rows_and_gapless_slots(spark, n, hot, groups):
    df = graph(spark, n, hot, groups)
    rows = sharding.shard_rows(df, "g", ["doc_id"], 8).collect()
    assert sorted(r.doc_id for r in rows) == list(range(n))
    sizes = [0] * 8
    slots = {}
    for r in rows:
        sizes[r.shard] += 1
        slots.setdefault(r.shard, []).append(r.slot)
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_small_groups_stay_together(spark):
    sharded = sharding.shard_rows(graph(spark, 240, False, 60), "g", ["doc_id"], 8)
    links, cut = sharding.cut_links(sharded, "g").first()
    assert links == 60 and cut == 0


def test_a_hot_group_fills_whole_shards(spark):
    sharded = sharding.shard_rows(graph(spark, 600, True, 20), "g", ["doc_id"], 8)
    hot = [r["count"] for r in sharded.filter("g = 'hot'").groupBy("shard").count().collect()]
    assert max(hot) == 75


def test_rounds_respect_capacity(spark):
    rows = [("a", 0, 5), ("a", 1, 4), ("a", 2, 1), ("b", 1, 6), ("b", 0, 2)]
    state = spark.createDataFrame(rows, "group string, shard int, n bigint")
    for capacities in ([7, 10, 1], [8, 12, 3], [30, 30, 30]):
        end = sharding.propagate(state, capacities, 4, 20)
        loads = sharding._loads(end, 3)
        assert sum(loads) == 18 and all(x <= c for x, c in zip(loads, capacities))
    assert {(r.group, r.shard, r.n) for r in end.collect()} == {("a", 0, 10), ("b", 1, 8)}


def test_repeated_and_null_rows(spark):
    df = spark.createDataFrame([(1, "x")] * 5 + [(None, None)] * 4, "doc_id bigint, g string")
    rows = sharding.shard_rows(df, "g", ["doc_id"], 3).collect()
    assert len(rows) == 9 and sorted((r.shard, r.slot) for r in rows) == [(s, i) for s in range(3) for i in range(3)]


def test_numbers_have_no_gaps(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), (F.col("id") % 40).alias("v"))
    rows = number_rows(df, "number", ["k"], [F.col("v")], 7).collect()
    for k in range(3):
        numbers = sorted(r.number for r in rows if r.k == k)
        assert numbers == list(range(len(numbers)))


def test_a_group_of_very_many_shards_is_filled(spark):
    """Half of the rows are one group, over 20 of 40 shards: rounds go on until all are filled."""
    half = F.when(F.col("id") % 2 == 0, F.lit("hot"))
    df = spark.range(400).select(F.col("id").alias("doc_id"), half.alias("g"))
    sharded = sharding.shard_rows(df, "g", ["doc_id"], 40).persist()
    hot = [r["count"] for r in sharded.filter("g = 'hot'").groupBy("shard").count().collect()]
    assert sorted(hot) == [10] * 20
    assert sharding.cut_links(sharded, "g").first() == (199, 190)
    with pytest.warns(UserWarning, match="after 1 rounds"):
        few = sharding.shard_rows(df, "g", ["doc_id"], 40, most_rounds=1)
    assert {r["count"] for r in few.groupBy("shard").count().collect()} == {10}


def test_columns_of_any_name_and_slices_of_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(sharding, "HOT_ROWS", 20)
    names = ["_linked", "_turn", "_member", "row", "group", "hash", "tie", "n", "turn", "Slot", "a.b"]
    df = graph(spark, 300, True, 20).withColumns({n: F.lit(n) for n in names})
    df = df.unionByName(df.filter("doc_id < 5"))  # repeated rows
    sharded = sharding.shard_rows(df, "g", ["doc_id"], 8)
    kept = [n for n in names if n != "Slot"]
    assert sharded.columns == ["doc_id", "g", *kept, "shard", "slot"]
    rows = sharded.collect()
    assert len(rows) == 305 and all(list(r)[2 : 2 + len(kept)] == kept for r in rows)
    sizes = [sum(r.shard == j for r in rows) for j in range(8)]
    assert max(sizes) - min(sizes) <= 1
