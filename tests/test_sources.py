from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from talmir.session import CHECKPOINT_CONF, cut_lineage, new_path, shared_folder
from talmir.sources import (
    parse_labelled_points,
    parse_points,
    parse_ratings,
    partition_into,
    read_labelled_points,
    read_lines,
    read_points,
    read_ratings,
    split_bad_labelled_points,
    split_bad_points,
    split_bad_ratings,
    write_result,
)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_byte_order_mark_and_line_ends_are_dropped(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfpen,ann,4,10\r\ncup,bob,-2.5,11\r\n")
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == [
        "pen,ann,4,10",
        "cup,bob,-2.5,11",
    ]
    rows = read_ratings(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("pen", "ann", 4.0, 10), ("cup", "bob", -2.5, 11)]


def test_quotes_are_plain_characters(spark):
    rows = parse_ratings(lines(spark, '"x,y",3,9')).collect()
    assert [tuple(r) for r in rows] == [('"x', 'y"', 3.0, 9)]


def test_timestamp_is_not_checked(spark):
    assert parse_ratings(lines(spark, "a,b,1,soon")).first().ts is None


@pytest.mark.parametrize("bad", ["a,b,1", "a,b,1,2,3", "", "a,b,good,1", "a,b,NaN,1", "a,b,,1"])
def test_strict_ratings_fail_on_a_bad_line(spark, bad):
    with pytest.raises(Exception, match="malformed line"):
        parse_ratings(lines(spark, "a,b,1,2", bad)).count()


def test_permissive_ratings_keep_bad_lines_aside(spark):
    good, bad = split_bad_ratings(lines(spark, "a,b,1,2", "a,b", "c,d,5.0,3"))
    assert [r.product for r in good.collect()] == ["a", "c"]
    assert [r.value for r in bad.collect()] == ["a,b"]


def test_labelled_points_of_any_dimension(spark, tmp_path):
    (tmp_path / "p.csv").write_text("1.5,-2,0\n 7 , 8 , 9 , 1 \n4,2\n")
    rows = read_labelled_points(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [([1.5, -2.0], 0), ([7.0, 8.0, 9.0], 1), ([4.0], 2)]


@pytest.mark.parametrize("bad", ["", "3", "1,x,0", "1,2,0.5", "1,,0"])
def test_bad_labelled_points(spark, bad):
    with pytest.raises(Exception, match="malformed line"):
        parse_labelled_points(lines(spark, bad)).count()
    good, rejected = split_bad_labelled_points(lines(spark, bad, "1,2,0"))
    assert good.count() == 1
    assert [r.value for r in rejected.collect()] == [bad]


def test_points_split_on_any_white_space(spark, tmp_path):
    (tmp_path / "p.txt").write_bytes(b"1 2\n\t1   2 \r\n1\t2\n")
    assert [r.point for r in read_points(spark, str(tmp_path)).collect()] == [[1.0, 2.0]] * 3


def test_white_space_is_the_same_as_in_plain_python(spark):
    spaces = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    texts = [f"{c}1{c}{c}2{c}" for c in spaces]
    points = parse_points(lines(spark, *texts)).collect()
    assert [r.point for r in points] == [[float(x) for x in t.split()] for t in texts]


@pytest.mark.parametrize("bad", ["", "  ", "1 x", "1\u200b2"])
def test_bad_points(spark, bad):
    with pytest.raises(Exception, match="malformed line"):
        parse_points(lines(spark, bad)).count()
    good, rejected = split_bad_points(lines(spark, bad, "1 2"))
    assert (good.count(), rejected.count()) == (1, 1)


def test_lines_are_parsed_once(spark):
    for parsed in (
        parse_points(lines(spark, "1 2")),
        parse_labelled_points(lines(spark, "1,2,0")),
        parse_ratings(lines(spark, "a,b,1,2")),
    ):
        optimized = parsed._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate inline" in optimized
        assert "split(" not in optimized.split("Generate inline")[0]


def test_other_columns_are_carried_through(spark):
    df = lines(spark, "1 2").withColumn("id", F.lit(5))
    assert parse_points(df).columns == ["id", "point"]


@pytest.mark.parametrize("n", [1, 4, 16])
def test_partition_into(spark, n):
    parts = partition_into(spark.range(1000), n)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == n
    assert sum(sizes) == 1000
    assert max(sizes) - min(sizes) <= n


def test_write_result_reads_back(spark, tmp_path):
    path = str(tmp_path / "out")
    write_result(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception, match="(?i)exists"):
        write_result(spark.range(5), path)


def test_shared_folder_is_the_one_that_the_session_names(spark):
    session = SimpleNamespace(conf={CHECKPOINT_CONF: "hdfs:///shared/"})
    assert shared_folder(session) == "hdfs:///shared/"
    assert new_path(session, "x").startswith("hdfs:///shared/x-")
    own = shared_folder(spark)
    assert own == shared_folder(spark)


def test_cut_lineage_keeps_the_rows(spark):
    df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert sorted(r.x for r in df.collect()) == list(range(0, 20, 2))


@pytest.mark.parametrize(
    "split, lines",
    [
        (split_bad_ratings, ["p,u,4.5,7", "p,u,x,7", "", "p,u,1", "q,u,-2,x", None]),
        (split_bad_labelled_points, ["1,2,0", "1,nan,2", "x", "3,4,z", "", None]),
        (split_bad_points, ["1 2", " ", "1 inf", "\t3  4\r", "x", None]),
    ],
)
def test_one_pass_gives_the_same_two_outputs(spark, split, lines):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, good int").repartition(2)
    rows.persist().count()
    both = [sorted(map(str, df.collect())) for df in split(rows)]
    counted = rows.mapInArrow(count, rows.schema)
    found = split(counted, once=True)
    assert [sorted(map(str, df.collect())) for df in found] == both
    assert [df.columns for df in found] == [df.columns for df in split(rows)]
    assert found[0].count() + found[1].count() == len(lines)
    assert seen.value == len(lines)  # read once, however often the outputs are used
    assert [df.count() for df in split(rows.limit(0), once=True)] == [0, 0]
