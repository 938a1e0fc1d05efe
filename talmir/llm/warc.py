"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``.write``.

The reader plans partitions of whole files. Filters on ``warc_type`` and on header columns are
pushed down: a record's headers are parsed first, and the payload of a record that fails a
filter is skipped by a seek. A payload is only read where the schema asks for ``payload``, or
where the option ``verify`` asks for its digest to be checked.

Files are plain, or gzip with one member per record. A member written here names its own
compressed length in a gzip extra field, so it is skipped by a seek as well; members of other
writers are inflated and thrown away.

The writer leaves one file per task, under a name of that attempt. Only files of attempts that
were committed are listed in the manifest, which is what a reader goes by; files without any
manifest are read by their names. Archives lie where pyarrow's file systems reach, for a
cluster in a shared folder.

Defined results: a NULL payload is empty, a NULL header is left out and read as NULL, an
archive without records is an empty table, and line ends in header values are written as %0D
and %0A. A record that is cut off fails the job.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import sys
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = (
    "warc_type string, record_id string, target_uri string, date string, content_type string, "
    "content_length bigint, payload_digest string, refers_to string, payload_length bigint, "
    "payload binary"
)
# Fixed names of the format.
HEADERS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_READ = 4096
NEXT_READ = 1 << 15
END = b"\r\n\r\n"
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4096


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _clean(value: object) -> str:
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict, date: str) -> bytes:
    """One record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    payload = row.get("payload") or b""
    revisit = row["warc_type"] == "revisit"
    length = row.get("payload_length")
    length = len(payload) if length is None else length
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
    block = block.encode() + (b"" if revisit else payload)
    fields = {
        "WARC-Type": row["warc_type"],
        "WARC-Record-ID": None if row.get("record_id") is None else f"<{row['record_id']}>",
        "WARC-Date": row.get("date") or date,
        "WARC-Target-URI": row.get("target_uri"),
        "WARC-Payload-Digest": "sha1:" + (row.get("payload_digest") or digest(payload)),
        "WARC-Refers-To": None if row.get("refers_to") is None else f"<{row['refers_to']}>",
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "".join(f"{k}: {_clean(v)}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + END


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """A gzip member whose extra field ``sl`` holds the length of the whole member."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff"
    total = len(head) + 2 + 12 + len(body) + 8
    extra = struct.pack("<H", 12) + b"sl" + struct.pack("<HQ", 8, total)
    return head + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class _Written(WriterCommitMessage):
    def __init__(self, file: str | None, size: int):
        self.file, self.size = file, size


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator):
        files, folder = open_folder(self.path)
        files.create_dir(folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.gzip else "")
        size, out = 0, None
        for batch in iterator:
            for row in batch.to_pylist():
                out = out or files.open_output_stream(f"{folder}/{name}", compression=None)
                data = record_bytes(row, self.date)
                data = gzip_member(data) if self.gzip else data
                out.write(data)
                size += len(data)
        if out:
            out.close()
        return _Written(name if out else None, size)

    def commit(self, messages):
        files, folder = open_folder(self.path)
        files.create_dir(folder, recursive=True)
        listed = [[m.file, m.size] for m in messages if m and m.file]
        with files.open_output_stream(f"{folder}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages):
        files, folder = open_folder(self.path)
        for m in messages:
            if m and m.file:
                files.delete_file(f"{folder}/{m.file}")


class _Record:
    """The bytes of one record, read no further than asked for."""

    def __init__(self, file, at: int, total: int):
        self.file, self.at, self.total, self.data = file, at, total, bytearray()
        file.seek(at)
        head = file.read(FIRST_READ)
        self.inflate, self.skip = None, None
        if head[:2] == b"\x1f\x8b":
            start = self._gzip_start(head)
            while start > len(head) and len(head) + at < total:
                head += file.read(NEXT_READ)
                start = self._gzip_start(head)
            self.inflate = zlib.decompressobj(-15)
            self.raw = len(head)
            self.data += self.inflate.decompress(head[start:])
        else:
            self.data += head

    def _gzip_start(self, head: bytes) -> int:
        flags, start = head[3], 10
        if flags & 4:
            size = int.from_bytes(head[10:12], "little")
            extra, start = head[12 : 12 + size], 12 + size
            while len(extra) >= 4:
                n = int.from_bytes(extra[2:4], "little")
                if extra[:2] == b"sl" and len(extra) >= 12:
                    self.skip = int.from_bytes(extra[4:12], "little")
                extra = extra[4 + n :]
        for flag in (8, 16):  # a name, a comment
            if flags & flag:
                end = head.find(b"\0", start)
                start = len(head) + 1 if end < 0 else end + 1
        return start + (2 if flags & 2 else 0)

    def more(self, least: int = 0) -> bool:
        if self.inflate is None:
            new = self.file.read(max(least, NEXT_READ))
            self.data += new
            return bool(new)
        if self.inflate.eof:
            return False
        new = self.file.read(self.skip - self.raw if self.skip else NEXT_READ)
        self.raw += len(new)
        self.data += self.inflate.decompress(new)
        return bool(new)

    def find_end(self, start: int = 0) -> int:
        while (end := self.data.find(END, start)) < 0:
            if not self.more():
                raise ValueError(f"a record is cut off at byte {self.at}")
        return end + len(END)

    def upto(self, n: int) -> None:
        while len(self.data) < n:
            if not self.more(n - len(self.data)):
                raise ValueError(f"a record is cut off at byte {self.at}")

    def after(self, length: int) -> int:
        """Where the next record begins; ``length`` is this one's, headers and block."""
        if self.inflate is None:
            return self.at + length + len(END)
        if self.skip:
            return self.at + self.skip
        while not self.inflate.eof:
            if not self.more():
                raise ValueError(f"a record is cut off at byte {self.at}")
            self.data.clear()
        return self.at + self.raw - len(self.inflate.unused_data) + 8


def _headers(data: bytes) -> dict[str, str]:
    found = {}
    for line in data.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def _bare(value: str | None) -> str | None:
    if value is not None and value[:1] == "<" and value[-1:] == ">":
        return value[1:-1]
    return value


class _Files(InputPartition):
    def __init__(self, names: list[tuple[str, int]]):
        self.names = names


class WarcReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.path = options["path"]
        self.names = [field.name for field in schema.fields]
        self.verify = options.get("verify", "false") == "true"
        self.partition_bytes = int(options.get("partitionBytes", 128 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Takes filters on header columns; the others are left to Spark."""
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column in HEADERS and column != "content_length":
                if isinstance(f, EqualTo):
                    self.tests.append((column, "in", (f.value,)))
                    continue
                if isinstance(f, In):
                    self.tests.append((column, "in", tuple(f.value)))
                    continue
                if isinstance(f, StringStartsWith):
                    self.tests.append((column, "starts", f.value))
                    continue
                if isinstance(f, IsNotNull):
                    self.tests.append((column, "there", None))
                    continue
            yield f

    def partitions(self):
        files, folder = open_folder(self.path)
        listed = []
        infos = files.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
        manifests = [x.path for x in infos if x.base_name.startswith("_manifest-")]
        for manifest in manifests:
            with files.open_input_stream(manifest) as source:
                listed += [(f"{folder}/{name}", size) for name, size in json.loads(source.read())]
        if not manifests:
            endings = (".warc", ".warc.gz")
            listed = [(x.path, x.size) for x in infos if x.base_name.endswith(endings)]
        parts, size = [[]], 0
        for item in sorted(listed):
            if parts[-1] and size + item[1] > self.partition_bytes:
                parts.append([])
                size = 0
            parts[-1].append(item)
            size += item[1]
        return [_Files(part) for part in parts]

    def _passes(self, values: dict) -> bool:
        for column, kind, wanted in self.tests:
            value = values[column]
            if value is None:
                return False
            if kind == "in" and value not in wanted:
                return False
            if kind == "starts" and not value.startswith(wanted):
                return False
        return True

    def read(self, partition):
        schema = pa.schema(
            [
                (n, pa.binary() if n == "payload" else pa.int64() if n.endswith("_length") else pa.string())
                for n in self.names
            ]
        )
        files, _ = open_folder(self.path)
        rows, held = [], 0
        for path, _ in partition.names:
            with files.open_input_file(path) as file:
                for row in self._file(file):
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def _file(self, file):
        at, total = 0, file.size()
        while at < total:
            record = _Record(file, at, total)
            start = record.find_end()
            found = _headers(bytes(record.data[:start]))
            values = {k: found.get(v.lower()) for k, v in HEADERS.items()}
            length = int(values["content_length"] or 0)
            values["content_length"] = length
            values["record_id"] = _bare(values["record_id"])
            values["refers_to"] = _bare(values["refers_to"])
            if (named := values["payload_digest"]) is not None:
                values["payload_digest"] = named.removeprefix("sha1:")
            if self._passes(values):
                yield self._row(record, values, start, length)
            at = record.after(start + length)

    def _row(self, record, values: dict, start: int, length: int) -> dict:
        wants = {"payload", "payload_length"} & set(self.names)
        http = (values["content_type"] or "").startswith("application/http")
        full = values["warc_type"] != "revisit"
        payload = None
        if wants or self.verify:
            body, stated = start, None
            if http and length:
                body = record.find_end(start)
                line = _headers(bytes(record.data[start:body])).get("content-length")
                stated = int(line) if line else None
            if full and ("payload" in self.names or self.verify):
                record.upto(start + length)
                payload = bytes(record.data[body : start + length])
                if self.verify and values["payload_digest"] not in (None, digest(payload)):
                    raise ValueError(f"the payload of {values['record_id']} has another digest")
            values["payload_length"] = start + length - body if full else stated
        values["payload"] = payload
        return {name: values.get(name) for name in self.names}


class WarcSource(DataSource):
    """Format ``warc``. Options: path, compression (gzip, none), date, verify, partitionBytes."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only added to: use mode append")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def with_revisits(
    pages: DataFrame, identity: str, payload: str, least_bytes: int = 0
) -> DataFrame:
    """The pages with ``warc_type`` and ``refers_to``, by equality of payloads.

    Of pages with equal payloads of at least ``least_bytes``, the one with the largest identity
    is the response, and the others revisit it. Repeated rows of that identity are responses
    too, as is every page if none of a group has an identity. Only keys of payloads that occur
    more than once are joined, so unlike pages are not shuffled if those are few; otherwise
    Spark splits the join at a payload that is very frequent.
    """
    key = F.when(F.length(payload) >= least_bytes, F.sha1(payload))
    keyed = pages.withColumn("_payload_key", key)
    repeated = (
        keyed.groupBy("_payload_key")
        .agg(F.max(identity).alias("_last"), F.count("*").alias("_copies"))
        .filter("_payload_key IS NOT NULL AND _copies > 1 AND _last IS NOT NULL")
        .select("_payload_key", "_last")
    )
    joined = keyed.join(repeated, "_payload_key", "left")
    revisits = F.col("_last").isNotNull() & ~F.col(identity).eqNullSafe(F.col("_last"))
    return joined.select(
        *pages.columns,
        F.when(revisits, F.lit("revisit")).otherwise(F.lit("response")).alias("warc_type"),
        F.when(revisits, F.col("_last")).alias("refers_to"),
    )
