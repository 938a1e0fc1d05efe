import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from talmir.functions import truncate_rating
from talmir.operators import ratings
from talmir.operators.joins import join_back
from tests.plans import final_plan, plan, uses_python

# Means: u1 2.5, u2 4, u3 1, u4 3.5. Largest norms: tea 1.5, oil 1, rye 1, nut 0, fig 0.5.
OWN = [
    ("oil", "u2", 5.0), ("rye", "u2", 3.0), ("tea", "u1", 4.0), ("rye", "u1", 1.0), ("nut", "u3", 1.0),
    ("fig", "u4", 4.0), ("oil", "u4", 3.0), ("rye", "u5", 2.0), ("nut", "u5", 0.0),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "product string, user string, rating double")


def skewed(spark, n=3000):
    """A third of all reviews are copies of one, by one user."""
    copies = [("p0", "hot", 4.0)] * (n // 3)
    others = [(f"p{i % 50}", f"u{i % 90}", float(i % 6)) for i in range(n - n // 3)]
    return frame(spark, copies + others).repartition(8)


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def pairs_of(df):
    return [tuple(r) for r in df.collect()]


def test_ratings_are_truncated_toward_zero(spark):
    df = spark.createDataFrame([(4.7,), (-4.7,), (5.0,)], "r double")
    assert [r[0] for r in df.select(truncate_rating(F.col("r"))).collect()] == [4, -4, 5]
    text = spark.createDataFrame([("5.0",), ("-0.9",)], "r string")
    assert [r[0] for r in text.select(truncate_rating(F.col("r"))).collect()] == [5, 0]


def test_top_products_with_ties_in_product_order(spark):
    rows = [tuple(r) for r in ratings.top_products(frame(spark, OWN), 9).collect()]
    assert rows == [("tea", 1.5), ("oil", 1.0), ("rye", 1.0), ("fig", 0.5), ("nut", 0.0)]


@pytest.mark.parametrize("t, expected", [(0, 0), (-1, 0), (2, 2), (99, 5)])
def test_top_t(spark, t, expected):
    assert ratings.top_products(frame(spark, OWN), t).count() == expected


def test_one_review_per_user_is_neutral(spark):
    df = frame(spark, [(f"p{i}", f"u{i}", float(i)) for i in range(6)])
    assert {r.norm for r in ratings.normalize_ratings(df).collect()} == {0.0}


def test_reviewing_a_product_twice_counts_twice(spark):
    df = frame(spark, [("a", "u", 1.0), ("a", "u", 5.0), ("b", "u", 3.0)])
    assert pairs(ratings.normalize_ratings(df)) == [("a", -2.0), ("a", 2.0), ("b", 0.0)]


def test_user_totals(spark):
    rows = pairs(ratings.user_totals(frame(spark, [("a", "u", 1.9), ("b", "u", 5.0)])))
    assert rows == [("u", "a", 6, 2, 1.9), ("u", "b", 6, 2, 5.0)]


@pytest.mark.parametrize("hot_rows", [1, 7, 100, 10_000])
@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_hot_users_change_nothing_in_the_result(spark, hot_rows, partitions):
    df = skewed(spark).repartition(partitions)
    whole = F.col("rating").cast("bigint")
    norm = whole - F.avg(whole).over(Window.partitionBy("user"))
    expected = df.select("product", norm.alias("norm"))
    actual = ratings.normalize_ratings(df, hot_rows)
    for mine, theirs in zip(pairs(actual), pairs(expected), strict=True):
        assert mine[0] == theirs[0]
        assert mine[1] == pytest.approx(theirs[1], abs=1e-12)


def test_copies_of_a_hot_users_review_are_spread(spark):
    df = skewed(spark, 30_000)
    totals = df.groupBy("user").agg(F.count("*").alias("n"))
    # As in a join that is too large to broadcast, or to run in few tasks.
    large = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in large.items():
        spark.conf.set(name, value)
    try:
        joined = join_back(df, totals, "user", hot_rows=1000)
        hot = joined.filter(F.col("user") == "hot").select(F.spark_partition_id().alias("part"))
        sizes = [r["count"] for r in hot.groupBy("part").count().collect()]
    finally:
        for name in large:
            spark.conf.unset(name)
    assert sum(sizes) == 10_000
    assert len(sizes) >= 3
    assert max(sizes) <= 6_000


def test_rows_without_a_user_are_kept(spark):
    df = frame(spark, [("a", None, 1.0), ("b", None, 3.0), ("c", "u", 2.0)])
    assert pairs(ratings.normalize_ratings(df)) == [("a", -1.0), ("b", 1.0), ("c", 0.0)]


def test_norms_of_a_user_add_up_to_zero(spark):
    df = skewed(spark)
    totals = ratings.user_totals(df)
    norm = F.col("rating").cast("bigint") - F.col("total") / F.col("n")
    for row in totals.groupBy("user").agg(F.sum(norm).alias("x")).collect():
        assert row.x == pytest.approx(0, abs=1e-9)


def test_preview_is_in_key_order(spark):
    rows = ratings.preview(frame(spark, OWN), 3, "user", "product").collect()
    assert [(r.user, r.product) for r in rows] == [("u1", "rye"), ("u1", "tea"), ("u2", "oil")]
    assert ratings.preview(frame(spark, OWN), 0).count() == 0


def test_missing_ratings_do_not_count_in_the_mean(spark):
    df = frame(spark, [("a", "u", None), ("b", "u", 3.0), ("c", "u", 5.0), ("d", "v", None)])
    assert sorted(map(str, pairs_of(ratings.normalize_ratings(df)))) == sorted(
        map(str, [("a", None), ("b", -1.0), ("c", 1.0), ("d", None)])
    )


def test_reviews_by_user(spark):
    df = frame(spark, [*OWN, ("oil", "u4", 3.0)])
    rows = {r.user: r for r in ratings.reviews_by_user(df, 1).collect()}
    assert [tuple(x) for x in rows["u4"].reviews] == [("fig", 4.0, 1), ("oil", 3.0, 2)]
    assert rows["u4"].n_reviews == 3
    assert {r.part for r in rows.values()} == {0} and len(rows) == 5
    with pytest.raises(ValueError, match="at least 1"):
        ratings.reviews_by_user(df, 0)


def test_reviews_in_parts_lose_nothing(spark):
    df = skewed(spark)
    parts = ratings.reviews_by_user(df, 4)
    rows = parts.select("user", F.explode("reviews").alias("r")).select("user", "r.*")
    expected = df.groupBy("user", "product", "rating").agg(F.count("*").alias("copies"))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, expected.collect()))
    assert parts.agg(F.max("part"), F.sum("n_reviews")).first() == (3, df.count())


def test_rows_by_user_do_not_depend_on_size(spark):
    df = skewed(spark, 300)
    larger = df
    for _ in range(4):
        larger = larger.unionByName(larger)
    keys = ["user", "part"]
    small, large = (sorted(map(tuple, ratings.reviews_by_user(x, 2).select(keys).collect())) for x in (df, larger))
    assert small == large


def test_more_hot_users_than_the_old_bound(spark):
    # 12,000 users of 3 rows each. Few rows in all, so the share of a user does not count as hot.
    df = spark.range(36_000).select(
        (F.col("id") % 7).cast("string").alias("product"),
        (F.col("id") % 12_000).cast("string").alias("user"),
        (F.col("id") % 5).cast("double").alias("rating"),
    )
    plain = ratings.user_totals(df).orderBy("user", "product", "rating").collect()
    assert ratings.user_totals(df, hot_rows=2).orderBy("user", "product", "rating").collect() == plain


def test_later_review_in_a_document_wins(spark):
    docs = spark.createDataFrame(
        [(1, "pen,ann,4,1\ncup,bob,2,1\nhat,ann,3.5,2"), (2, "pen,ann,1,9")],
        "doc int, text string",
    )
    last = ratings.last_review_per_document(ratings.split_reviews(docs))
    assert pairs(last) == [(1, "ann", "hat", 3.5), (1, "bob", "cup", 2.0), (2, "ann", "pen", 1.0)]


def test_plan_of_top_products(spark):
    df = skewed(spark)
    text = plan(ratings.top_products(df, 3))
    assert "TakeOrderedAndProject(limit=3" in text
    assert "Window" not in text
    assert not uses_python(text)
    # The list of hot users and the join read one shuffle of the totals.
    assert "ReusedExchange" in final_plan(ratings.top_products(df, 3, hot_rows=10))


def pages_by_hand(rows, size):
    bags = {}
    for product, user, rating, _ in rows:
        bag = bags.setdefault(user, {})
        bag[product, rating] = bag.get((product, rating), 0) + 1
    order = lambda r: tuple((x is not None, x) for x in r[0])
    out = []
    for user, bag in bags.items():
        listed = [(*r, n) for r, n in sorted(bag.items(), key=order)]
        for page in range(-(-len(listed) // size)):
            some = listed[page * size : page * size + size]
            out.append((user, page, sum(n for *_, n in some), some))
    return sorted(out, key=str)


@pytest.mark.parametrize("size, partitions", [(1, 3), (4, 1), (4, 6), (1000, 2)])
def test_review_pages(spark, size, partitions):
    rows = [(f"p{i * 7 % 23}", f"u{i % 5}", float(i % 3), i) for i in range(300)]
    rows += [(f"p{i}", "hot", 1.0, i) for i in range(150)] * 2
    rows += [(None, "u1", 2.0, 0), ("p1", None, 2.0, 0), (None, None, None, 0), (None, None, None, 0), ("p2", "u1", None, 1)]
    df = spark.createDataFrame(rows, "product string, user string, rating double, ts long").repartition(partitions)
    found = ratings.review_pages(df, size).collect()
    found = sorted(((r.user, r.page, r.n_reviews, [tuple(x) for x in r.reviews]) for r in found), key=str)
    assert found == pages_by_hand(rows, size)
    assert ratings.review_pages(df.limit(0), size).count() == 0
    with pytest.raises(ValueError, match="at least 1"):
        ratings.review_pages(df, 0)


def test_review_pages_spread_a_hot_user(spark):
    """One user has a third of all different reviews: no partition holds over twice the median of
    what is ranked, and no page is longer than its size."""
    user = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 5000).cast("string")))
    df = spark.range(90_000).select(user.alias("user"), F.col("id").alias("product"), F.lit(3.0).alias("rating"))
    pages = ratings.review_pages(df, 50).persist()
    assert pages.agg(F.max(F.size("reviews"))).first()[0] == 50
    assert pages.filter("user = 'hot'").count() == 600
    text = final_plan(ratings.review_pages(df, 50))
    assert "Window" in text
    ranged = df.repartitionByRange(ratings.RANGES * 8, "user", "product", "rating")
    keyed = ranged.withColumn("r", F.spark_partition_id()).repartition(8, "user", "r")
    sizes = sorted(r["count"] for r in keyed.groupBy(F.spark_partition_id().alias("t")).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
