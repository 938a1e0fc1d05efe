import gzip

import pytest
from pyspark.sql import functions as F

from talmir.llm import warc

SCHEMA = "warc_type string, record_id string, target_uri string, refers_to string, payload binary"


def write(spark, rows, path, **options):
    warc.register(spark)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df.write.format("warc").options(**options).mode("append").save(path)


def read(spark, path, schema=None, **options):
    reader = spark.read.format("warc").options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


ROWS = [
    ("response", "urn:a", "http://x/1", None, b"hello"),
    ("response", "urn:b", "http://x/\r\n2", None, b""),
    ("response", "urn:c", None, None, None),
    ("response", "urn:d", "http://x/4", None, b"WARC/1.1\r\n\r\nnot a record\r\n\r\n" * 3000),
    ("revisit", "urn:e", "http://x/5", "urn:a", b"hello"),
    ("response", "urn:f", "http://x/6", None, "é漢\U0001f600\0".encode() * 999),
]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, tmp_path, compression):
    path = str(tmp_path / "archive")
    write(spark, ROWS, path, compression=compression)
    write(spark, ROWS[:1], path, compression=compression)
    found = {r.record_id: r for r in read(spark, path, verify="true").collect()}
    assert len(found) == 6
    assert read(spark, path).count() == 7
    for kind, name, uri, refers, payload in ROWS:
        row = found[name]
        assert row.warc_type == kind and row.refers_to == refers
        assert row.target_uri == (uri and uri.replace("\r", "%0D").replace("\n", "%0A"))
        assert row.payload_digest == warc.digest(payload or b"")
        assert row.payload_length == len(payload or b"")
        assert row.payload == (None if kind == "revisit" else bytes(payload or b""))


def test_filters_reach_the_reader(spark, tmp_path):
    path = str(tmp_path / "archive")
    write(spark, ROWS, path)
    some = read(spark, path).filter("warc_type = 'revisit' AND target_uri LIKE 'http://x/%'")
    assert [r.record_id for r in some.collect()] == ["urn:e"]
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter " not in text
    several = read(spark, path).filter(F.col("record_id").isin("urn:a", "urn:f") & (F.length("payload") > 9))
    assert [r.record_id for r in several.collect()] == ["urn:f"]


def test_unwanted_payloads_are_not_read(tmp_path):
    reads = []

    class File:
        def __init__(self, data):
            self.data, self.at = data, 0

        def size(self):
            return len(self.data)

        def seek(self, at):
            self.at = at

        def read(self, n):
            part = self.data[self.at : self.at + n]
            self.at += len(part)
            reads.append(len(part))
            return part

    import os

    big = {"warc_type": "response", "record_id": "r", "payload": os.urandom(1 << 20)}
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField("record_id", StringType())])
    for pack in (warc.gzip_member, lambda x: x):
        reads.clear()
        file = File(pack(warc.record_bytes(big, "d")) * 5)
        reader = warc.WarcReader(schema, {"path": str(tmp_path)})
        assert len(list(reader._file(file))) == 5
        assert sum(reads) <= 5 * warc.FIRST_READ


def test_archives_of_other_writers(spark, tmp_path):
    record = warc.record_bytes({"warc_type": "response", "record_id": "r", "payload": b"p" * 9000}, "2020-01-01T00:00:00Z")
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(record) * 3)
    (tmp_path / "two.warc").write_bytes(record * 2)
    warc.register(spark)
    rows = read(spark, str(tmp_path)).collect()
    assert [(r.date, len(r.payload)) for r in rows] == [("2020-01-01T00:00:00Z", 9000)] * 5
    (tmp_path / "cut.warc").write_bytes(record[:4000])
    with pytest.raises(Exception, match="cut off"):
        read(spark, str(tmp_path)).collect()


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    path = tmp_path / "archive"
    write(spark, ROWS, str(path))
    (path / "part-lost.warc").write_bytes(b"half a rec")
    assert read(spark, str(path)).count() == 6


def test_empty_archive(spark, tmp_path):
    write(spark, ROWS[:0], str(tmp_path / "none"))
    assert read(spark, str(tmp_path / "none")).count() == 0


def test_revisits(spark):
    pages = spark.createDataFrame(
        [(1, b"a", 0), (5, b"a", 0), (5, b"a", 0), (None, b"a", 0), (2, b"b", 0), (3, b"", 0), (4, b"", 0),
         (None, b"z", 0), (None, b"z", 0)],
        "page_id bigint, payload binary, n int",
    )
    rows = [(r.page_id, bytes(r.payload), r.warc_type, r.refers_to) for r in warc.with_revisits(pages, "page_id", "payload").collect()]
    assert sorted(rows, key=str) == sorted(
        [(1, b"a", "revisit", 5), (5, b"a", "response", None), (5, b"a", "response", None), (None, b"a", "revisit", 5),
         (2, b"b", "response", None), (3, b"", "revisit", 4), (4, b"", "response", None),
         (None, b"z", "response", None), (None, b"z", "response", None)], key=str)
    least = warc.with_revisits(pages, "page_id", "payload", 1).filter("warc_type = 'revisit'")
    assert sorted(bytes(r.payload) for r in least.collect()) == [b"a", b"a"]
