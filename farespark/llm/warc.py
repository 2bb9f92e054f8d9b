"""Web archives (WARC 1.1) as a Spark data source, and the archive of a page table.

``WarcSource`` is a Python data source, ``spark.read.format("warc")``. Its
reader plans file partitions: small files are read together, large ones are
cut at record marks that the writer left in its manifest. Predicates on the
record type and on other named headers are pushed down. A record's headers are
parsed first; where they fail a predicate, or the payload is not among the
columns asked for, the payload is neither inflated nor read: each record is a
gzip member of its own whose extra field ``sl`` tells its length, so the
reader seeks to the next one. Archives of others work as well: plain files
(blocks are sought past), members without that field, one member for a whole
file (inflated and dropped piece by piece).

The writer gives every file a name of its own and lists the files of all
tasks in one manifest when the job commits, so files of lost or repeated
tasks are never read. ``overwrite`` names the manifests it replaces.

``write_pages`` writes one record a page. Pages with equal payloads are one
response (that of the largest page_id; of equal ones the largest url) and
revisits that name it. Each distinct payload is shuffled about once, rows of
one payload are pre-aggregated, and revisits travel without payload.

Defined results: a null html is an empty payload; empty payloads are equal
payloads. A null page_id counts as smaller than any other and stays null, also
in ``refers_to``. Of fully repeated rows one is the response at most, and each
row has its record. Null urls have no target header; control characters and
white space in urls are percent-encoded in the header. No page gives an
archive without records of pages. Other columns are not looked at. A damaged
archive raises ValueError with the file and the place.
"""

from __future__ import annotations

import datetime as dt
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farespark.llm.common import table
from farespark.session import scratch_path

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, refers_to string, payload_digest string, "
    "content_type string, content_length long, headers map<string,string>, payload binary"
)
#: Columns that are headers, by their names in the file.
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
    "content_length": "content-length",
}
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_FROM, _BY = "X-Page-Id", "X-Payload-Bytes"
#: Bytes that a header may have at most, and that a batch of rows has about.
MAX_HEADER, BATCH = 1 << 20, 4 << 20


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


# -- reading -------------------------------------------------------------------------------------------------------


class Inflated:
    """The bytes of a gzip file from a member's start, as one stream; ``skip`` seeks past a member's rest where it can."""

    def __init__(self, f, start: int):
        self.f, self.at, self.inflated = f, start, 0
        f.seek(start)
        self.buf, self.z, self.left, self.end = b"", None, None, None

    @property
    def between(self) -> bool:
        """True at the start of a member, with nothing left of the one before."""
        if not self.buf and self.z is not None:
            self._more()
        return not self.buf and self.z is None

    def _open(self) -> bool:
        head = self.f.read(10)
        if not head:
            return False
        if len(head) < 10 or head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {self.at}")
        size, flags = 10, head[3]
        self.left = self.end = None
        if flags & 4:
            n = struct.unpack("<H", self.f.read(2))[0]
            extra, size = self.f.read(n), size + 2 + n
            while len(extra) >= 4:
                n = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and n == 8:
                    packed, plain = struct.unpack("<II", extra[4:12])
                    if packed != 0xFFFFFFFF and plain != 0xFFFFFFFF:
                        self.left, self.end = plain, self.at + packed
                extra = extra[4 + n :]
        for bit in (8, 16):  # name and comment, each up to a zero byte
            if flags & bit:
                while (c := self.f.read(1)) not in (b"\0", b""):
                    size += 1
                size += 1
        if flags & 2:
            self.f.read(2)
            size += 2
        self.at += size
        self.z = zlib.decompressobj(-15)
        return True

    def _more(self, most: int = 1 << 16) -> bool:
        """Inflates some more bytes into the buffer; False at the end of the file."""
        if self.z is None and not self._open():
            return False
        data = self.z.unconsumed_tail or self.f.read(1 << 14)
        if not data and not self.z.eof:
            raise ValueError(f"a gzip member ends early at byte {self.at}")
        before = len(self.z.unconsumed_tail)
        self.at += len(data) - before
        out = self.z.decompress(data, most)
        self.inflated += len(out)
        if self.left is not None:
            self.left -= len(out)
        self.buf += out
        if self.z.eof:
            self.at += 8 - len(self.z.unused_data)
            self.f.seek(self.at)
            self.z = self.left = self.end = None
        return True

    def until(self, mark: bytes) -> bytes:
        """The bytes up to and with ``mark``; empty at the end of the file."""
        while (i := self.buf.find(mark)) < 0:
            if len(self.buf) > MAX_HEADER:
                raise ValueError(f"a header of more than {MAX_HEADER} bytes before byte {self.at}")
            if not self._more(1 << 12):
                if self.buf.strip():
                    raise ValueError("the file ends within a header")
                return b""
        out, self.buf = self.buf[: i + len(mark)], self.buf[i + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.buf], len(self.buf)
        while have < n:
            self.buf = b""
            if not self._more(min(max(n - have, 1 << 12), 1 << 20)):
                raise ValueError("the file ends within a record")
            parts.append(self.buf)
            have += len(self.buf)
        whole = b"".join(parts)
        self.buf = whole[n:]
        return whole[:n]

    def skip(self, n: int) -> None:
        if self.end is not None and self.left is not None and n == self.left + len(self.buf):
            self.at = self.end
            self.f.seek(self.at)
            self.buf, self.z, self.left, self.end = b"", None, None, None
            return
        while n:
            n -= len(self.take(min(n, 1 << 20)))


class Plain:
    """The same over a file that is not compressed."""

    def __init__(self, f, start: int):
        self.f, self.at, self.inflated = f, start, 0
        f.seek(start)

    between = True

    def until(self, mark: bytes) -> bytes:
        out = b""
        while not out.endswith(mark):
            line = self.f.readline(MAX_HEADER)
            if not line:
                if out.strip():
                    raise ValueError("the file ends within a header")
                return b""
            out += line
            if len(out) > MAX_HEADER:
                raise ValueError(f"a header of more than {MAX_HEADER} bytes at byte {self.at}")
        self.at += len(out)
        return out

    def take(self, n: int) -> bytes:
        out = self.f.read(n)
        if len(out) < n:
            raise ValueError("the file ends within a record")
        self.at += n
        self.inflated += n
        return out

    def skip(self, n: int) -> None:
        self.at += n
        self.f.seek(self.at)


def parse_head(raw: bytes) -> dict[str, str]:
    """Headers by lower-case name; lines that go on are joined, of repeated ones the first stays."""
    lines = raw.lstrip(b"\r\n").decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    name = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out.setdefault(name, value.strip())
    return out


def value_of(head: dict[str, str], column: str):
    v = head.get(HEADERS[column])
    return int(v) if v is not None and column == "content_length" else v


_COMPARE = {
    ds.EqualTo: lambda a, b: a == b,
    ds.GreaterThan: lambda a, b: a > b,
    ds.GreaterThanOrEqual: lambda a, b: a >= b,
    ds.LessThan: lambda a, b: a < b,
    ds.LessThanOrEqual: lambda a, b: a <= b,
    ds.In: lambda a, b: a in b,
    ds.StringStartsWith: str.startswith,
    ds.StringEndsWith: str.endswith,
    ds.StringContains: str.__contains__,
}


def pushable(f: ds.Filter) -> bool:
    if isinstance(f, ds.Not):
        return pushable(f.child)
    known = type(f) in _COMPARE or isinstance(f, (ds.EqualNullSafe, ds.IsNull, ds.IsNotNull))
    return known and len(f.attribute) == 1 and f.attribute[0] in HEADERS


def holds(f: ds.Filter, head: dict[str, str]) -> bool | None:
    """SQL's answer: None where the header or the value is missing."""
    if isinstance(f, ds.Not):
        got = holds(f.child, head)
        return None if got is None else not got
    have = value_of(head, f.attribute[0])
    if isinstance(f, ds.IsNull):
        return have is None
    if isinstance(f, ds.IsNotNull):
        return have is not None
    if isinstance(f, ds.EqualNullSafe):
        return have == f.value
    if have is None or f.value is None:
        return None
    got = _COMPARE[type(f)](have, f.value)
    return None if isinstance(f, ds.In) and not got and None in f.value else got


def records(stream, stop: int, filters: list, payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload or None) of the records that start before ``stop`` and pass the filters."""
    while not (stream.between and stream.at >= stop):
        raw = stream.until(b"\r\n\r\n")
        if not raw:
            return
        head = parse_head(raw)
        size = int(head.get("content-length") or 0)
        if not all(holds(f, head) for f in filters) or not payload:
            if all(holds(f, head) for f in filters):
                yield head, None
            stream.skip(size + 4)
            continue
        block = stream.take(size)
        if head.get("content-type", "").replace(" ", "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        yield head, block
        stream.skip(4)


@dataclass
class Ranges(ds.InputPartition):
    """Parts of files that one task reads: (path, first byte, stop)."""

    parts: list[tuple[str, int, int]] = field(default_factory=list)


def _listed(fs: pafs.FileSystem, root: str) -> list[dict]:
    """Files with their marks: those of the manifests, or every archive below a folder that has none."""
    if fs.get_file_info(root).type == pafs.FileType.File:
        return [{"path": root, "bytes": fs.get_file_info(root).size, "marks": []}]
    infos = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    names = [i.path for i in infos if i.base_name.startswith("_manifest-")]
    if not names:
        found = [i for i in infos if i.type == pafs.FileType.File and i.base_name.endswith((".warc", ".warc.gz"))]
        return [{"path": i.path, "bytes": i.size, "marks": []} for i in sorted(found, key=lambda i: i.path)]
    told = {n.rsplit("/", 1)[1]: json.loads(fs.open_input_stream(n).read()) for n in sorted(names)}
    gone = {r for m in told.values() for r in m["replaces"]}
    return [f | {"path": f"{root}/{f['name']}"} for n, m in told.items() if n not in gone for f in m["files"]]


def plan(files: list[dict], goal: int) -> list[Ranges]:
    """About ``goal`` bytes a partition: files are cut at their marks, small ones read together."""
    out, now, size = [], Ranges(), 0
    for f in files:
        cuts = [0]
        for m in f["marks"]:
            if m - cuts[-1] >= goal:
                cuts.append(m)
        for a, b in zip(cuts, [*cuts[1:], f["bytes"]]):
            if now.parts and size + b - a > goal:
                out.append(now)
                now, size = Ranges(), 0
            now.parts.append((f["path"], a, b))
            size += b - a
    return [*out, now] if now.parts else out


class WarcReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = schema.fieldNames()
        self.path, self.goal = options["path"], int(options.get("partitionBytes", 64 << 20))
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            if pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        return plan(_listed(*filesystem(self.path)), self.goal)

    def read(self, partition):
        if not isinstance(partition, Ranges):  # nothing was planned
            return
        fs, _ = filesystem(self.path)
        want = "payload" in self.names
        kinds = {"content_length": pa.int64(), "headers": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in self.names])
        rows, size = [], 0
        for path, start, stop in partition.parts:
            with fs.open_input_file(path) as raw:
                f = io.BufferedReader(raw, 1 << 18)
                stream = Inflated(f, start) if path.endswith(".gz") else Plain(f, start)
                try:
                    for head, payload in records(stream, stop, self.filters, want):
                        made = {"headers": list(head.items()), "payload": payload}
                        rows.append([made[n] if n in made else value_of(head, n) for n in self.names])
                        size += 400 + len(payload or b"")
                        if size >= BATCH:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, size = [], 0
                except (ValueError, zlib.error) as e:
                    raise ValueError(f"{path}, near byte {stream.at}: {e}") from e
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


# -- writing -------------------------------------------------------------------------------------------------------


def member(record: bytes, level: int) -> bytes:
    """A gzip member that tells its own length."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    packed, plain = len(body) + 32, len(record)
    known = packed < 0xFFFFFFFF and plain < 0xFFFFFFFF
    extra = b"sl" + struct.pack("<HII", 8, *((packed, plain) if known else (0xFFFFFFFF, 0xFFFFFFFF)))
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra))
    return head + extra + body + struct.pack("<II", zlib.crc32(record), plain & 0xFFFFFFFF)


def header_text(value: str) -> str:
    """A value that stays on its line: control characters and white space percent-encoded."""
    return "".join(quote(c) if c <= " " or "\x7f" <= c <= "\xa0" or c in "  " else c for c in value)


def record(kind: str, headers: dict[str, str | None], payload: bytes) -> bytes:
    if kind == "response":
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        block = payload
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers.items() if v is not None), f"Content-Length: {len(block)}"]
    return b"\r\n".join([VERSION, *(x.encode("utf-8", "replace") for x in lines), b"", block, b"", b""])


@dataclass
class Written(ds.WriterCommitMessage):
    files: list[dict]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.level = int(options.get("level", 6))
        self.file_bytes, self.mark_bytes = int(options.get("fileBytes", 1 << 30)), int(options.get("markBytes", 16 << 20))
        self.date = options.get("date") or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator) -> Written:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        files, out = [], None
        try:
            for batch in iterator:
                cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                for i in range(batch.num_rows):
                    row = {n: c[i].as_py() for n, c in cols.items()}
                    if out is None:
                        name = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz"
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                        files.append({"name": name, "bytes": 0, "marks": []})
                        self._put(out, files[-1], {"record_type": "warcinfo", "record_id": f"<urn:uuid:{uuid.uuid4()}>", "payload": b"software: farespark\r\n", "content_type": "application/warc-fields"})
                    self._put(out, files[-1], row)
                    if files[-1]["bytes"] >= self.file_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def _put(self, out, told: dict, row: dict) -> None:
        kind = row.get("record_type") or "resource"
        named = {
            "WARC-Record-ID": row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>",
            "WARC-Date": row.get("warc_date") or self.date,
            "WARC-Target-URI": None if row.get("target_uri") is None else header_text(row["target_uri"]),
            "WARC-Refers-To": row.get("refers_to"),
            "WARC-Payload-Digest": row.get("payload_digest"),
            "WARC-Profile": PROFILE if kind == "revisit" else None,
            "Content-Type": "application/http;msgtype=response" if kind == "response" else row.get("content_type"),
        }
        more = {k: None if v is None else header_text(v) for k, v in (row.get("headers") or [])}
        made = member(record(kind, named | more, row.get("payload") or b""), self.level)
        if told["bytes"] - (told["marks"][-1] if told["marks"] else 0) >= self.mark_bytes:
            told["marks"].append(told["bytes"])
        out.write(made)
        told["bytes"] += len(made)

    def commit(self, messages) -> None:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        old = [i for i in fs.get_file_info(pafs.FileSelector(root)) if i.base_name.startswith("_manifest-")] if self.overwrite else []
        told = {"files": [f for m in messages if m is not None for f in m.files], "replaces": [i.base_name for i in old]}
        name = uuid.uuid4().hex
        with fs.open_output_stream(f"{root}/.{name}", compression=None) as out:
            out.write(json.dumps(told).encode())
        fs.move(f"{root}/.{name}", f"{root}/_manifest-{name}.json")

    def abort(self, messages) -> None:
        fs, root = filesystem(self.path)
        for m in messages:
            for f in m.files if m is not None else []:
                fs.delete_file(f"{root}/{f['name']}")


class WarcSource(ds.DataSource):
    """``spark.read.format("warc")``; a schema with fewer columns reads only those."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets Spark push predicates into it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    register(spark)
    kinds = dict(c.split(" ", 1) for c in SCHEMA.split(", "))
    reader = spark.read.format("warc")
    if columns:
        reader = reader.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return reader.load(path)


# -- pages ---------------------------------------------------------------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a binary as 32 base32 digits, from eight groups of five hexadecimal digits."""
    digest, out = F.sha1(payload), []
    for i in range(8):
        v = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.lit(BASE32).substr(F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def page_records(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(responses, revisits) of pages (page_id, url, html) as rows of the source's columns."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("key", F.sha2("payload", 256))
    who = F.struct("page_id", "url")
    distinct = rows.groupBy("key").agg(F.max(who).alias("lead"), F.any_value("payload").alias("payload"))

    def name(page: Column, url: Column, key: Column, copy: Column) -> Column:
        page, url = F.coalesce(page.cast("string"), F.lit("null")), F.hex(F.xxhash64(url))
        return F.format_string("<urn:x-page:%s:%s:%s:%d>", page, key, url, copy)

    def extras(page: Column, size: Column) -> Column:
        given = F.create_map(F.lit(_BY), size.cast("string"))
        return F.when(page.isNotNull(), F.map_concat(given, F.create_map(F.lit(_FROM), page.cast("string")))).otherwise(given)

    first = F.lit(0).cast("long")
    responses = distinct.select(
        F.lit("response").alias("record_type"),
        name(F.col("lead.page_id"), F.col("lead.url"), F.col("key"), first).alias("record_id"),
        F.col("lead.url").alias("target_uri"),
        F.lit(None).cast("string").alias("refers_to"),
        F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))).alias("payload_digest"),
        extras(F.col("lead.page_id"), F.octet_length("payload")).alias("headers"),
        "payload",
    )
    # Copies without their payload: equal rows are counted before the shuffle, and all but the leading row of a payload go on.
    slim = rows.select("key", "page_id", "url", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").alias("size"))
    copies = slim.groupBy("key", "page_id", "url").agg(F.count(F.lit(1)).alias("n"), F.any_value("digest").alias("digest"), F.any_value("size").alias("size"))
    lead = slim.groupBy("key").agg(F.max(who).alias("lead"), F.count(F.lit(1)).alias("all")).where("all > 1").drop("all")
    leads = F.col("page_id").eqNullSafe(F.col("lead.page_id")) & F.col("url").eqNullSafe(F.col("lead.url"))
    others = copies.join(lead, "key").withColumn("copy", F.when(leads, F.lit(1)).otherwise(F.lit(0)).cast("long")).where("copy < n")
    revisits = others.withColumn("copy", F.explode(F.expr("sequence(copy, n - 1)"))).select(
        F.lit("revisit").alias("record_type"),
        name(F.col("page_id"), F.col("url"), F.col("key"), F.col("copy")).alias("record_id"),
        F.col("url").alias("target_uri"),
        name(F.col("lead.page_id"), F.col("lead.url"), F.col("key"), first).alias("refers_to"),
        F.concat(F.lit("sha1:"), F.col("digest")).alias("payload_digest"),
        extras(F.col("page_id"), F.col("size")).alias("headers"),
        F.lit(b"").alias("payload"),
    )
    return responses, revisits


def write_pages(pages: DataFrame, path: str) -> None:
    """Writes an archive of ``pages`` to the folder ``path``."""
    spark = pages.sparkSession
    register(spark)
    for df in page_records(pages):
        df.write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page's record; responses are hashed anew."""
    page = F.lower(F.lit(_FROM))
    full = read_warc(spark, path, ["record_type", "headers", "payload"]).where("record_type = 'response'")
    short = read_warc(spark, path, ["record_type", "payload_digest", "refers_to", "headers"]).where("record_type = 'revisit'")
    lead = F.regexp_extract("refers_to", "^<urn:x-page:(-?[0-9]+):", 1)
    return full.select(
        F.element_at("headers", page).cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        short.select(
            F.element_at("headers", page).cast("long").alias("page_id"),
            F.element_at("headers", F.lower(F.lit(_BY))).cast("long").alias("payload_bytes"),
            F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
            "record_type",
            F.when(lead != "", lead.cast("long")).alias("refers_to"),
        )
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_pages(table(spark, sf_dir, "pages"), path)
    return read_pages(spark, path)


# The digest's 160 bits as 32 digits of five bits, from the hexadecimal digest.
SQL = f"""
with p as (
  select page_id, url, encode(coalesce(html, '')) as payload, sha1(encode(coalesce(html, ''))) as hex from pages
), d as (
  select page_id, url, octet_length(payload) as payload_bytes, sha256(payload) as key,
    list_aggregate(list_transform(range(0, 32), lambda i: substr('{BASE32}',
      1 + ((strpos('0123456789abcdef', substr(hex, 1 + (i * 5) // 4, 1)) - 1) * 16
        + greatest(strpos('0123456789abcdef', substr(hex || '0', 2 + (i * 5) // 4, 1)) - 1, 0)
      ) // (1 << (3 - (i * 5) % 4)) % 32, 1)), 'string_agg', '') as payload_digest
  from p
), r as (
  select *, row_number() over (partition by key order by page_id desc nulls last, url desc nulls last) as place,
    first_value(page_id) over (partition by key order by page_id desc nulls last, url desc nulls last) as lead_id
  from d
)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when place = 1 then 'response' else 'revisit' end as record_type,
  case when place > 1 then lead_id end as refers_to
from r
"""
