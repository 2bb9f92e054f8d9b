"""The archive source: round trips, archives of other writers, predicates and what they skip."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farespark.llm import warc
from farespark.session import scratch_path
from tests.llm.conftest import bag, rows_of


def plain(rows) -> list[tuple]:
    """The result by groups of equal payloads."""
    groups: dict[str, list] = {}
    for r in rows:
        groups.setdefault(r["html"] or "", []).append((r["page_id"] is not None, r["page_id"] or 0, r["url"] is not None, r["url"] or "", r["page_id"]))
    out = []
    for html, members in groups.items():
        raw, members = html.encode(), sorted(members)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        lead = members[-1][4]
        out += [(m[4], len(raw), digest, "revisit", lead) for m in members[:-1]] + [(lead, len(raw), digest, "response", None)]
    return out


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op11(spark, request, where):
    d = request.getfixturevalue(where)
    got = warc.op11_warc(spark, d).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert bag(got) == bag(plain(rows_of(spark, d, "pages")))


def test_payloads_and_headers_come_back(spark, edge):
    path = scratch_path(spark, "warc-test")
    warc.write_pages(warc.table(spark, edge, "pages"), path)
    rows = warc.read_warc(spark, path).collect()
    assert {r["record_type"] for r in rows} == {"response", "revisit", "warcinfo"}
    want = {(r["html"] or "").encode() for r in rows_of(spark, edge, "pages")}
    assert {bytes(r["payload"]) for r in rows if r["record_type"] == "response"} == want
    assert len({r["record_id"] for r in rows}) == len(rows)
    assert all(r["target_uri"] is None or " " not in r["target_uri"] and "\n" not in r["target_uri"] for r in rows)
    assert "http://b.example/x%20y%09z" in {r["target_uri"] for r in rows}
    # A record's own text looks like a record and is none.
    assert sum(r["record_type"] == "response" for r in rows) == len(want)
    again = warc.read_warc(spark, path).where("record_type = 'response'")
    warc.write_pages(warc.table(spark, edge, "pages").where("page_id = 9"), path)
    assert again.count() == len(want) + 1
    again.write.format("warc").mode("overwrite").save(path)
    assert warc.read_warc(spark, path).where("record_type = 'response'").count() == len(want) + 1
    assert warc.read_warc(spark, path).where("record_type = 'revisit'").count() == 0


def record(kind: str, uri: str, block: bytes, more: str = "") -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\n{more}Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"


@pytest.fixture(scope="module")
def foreign(tmp_path_factory) -> str:
    """A folder with a plain archive, one with a member a record, and one that is a single member."""
    d = tmp_path_factory.mktemp("foreign")
    http = "Content-Type: application/http; msgtype=response\r\n"
    made = [record("response", f"http://h{i % 7}.example/{i}", HTTP + bytes([65 + i % 26]) * (50 * i), http) for i in range(60)]
    made += [record("metadata", "m", b"a: b\r\n\r\nc"), record("request", "q", HTTP, "X-Long: one\r\n two\r\n")]
    (d / "sub").mkdir()
    (d / "a.warc").write_bytes(b"".join(made))
    (d / "sub" / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in made))
    (d / "c.warc.gz").write_bytes(gzip.compress(b"".join(made)))
    (d / "notes.txt").write_text("no archive")
    return str(d)


def test_archives_of_others(spark, foreign):
    df = warc.read_warc(spark, foreign)
    assert df.count() == 3 * 62
    got = {r["target_uri"]: bytes(r["payload"]) for r in df.where("record_type = 'response'").collect()}
    assert got == {f"http://h{i % 7}.example/{i}": bytes([65 + i % 26]) * (50 * i) for i in range(60)}
    assert [bytes(r["payload"]) for r in df.where("record_type = 'metadata'").collect()] == [b"a: b\r\n\r\nc"] * 3
    assert {r["headers"]["x-long"] for r in df.where("record_type = 'request'").collect()} == {"one two"}
    assert warc.read_warc(spark, f"{foreign}/a.warc", ["target_uri"]).count() == 62


@pytest.mark.parametrize(
    "where",
    [
        "record_type in ('response', 'request') and content_length > 900",
        "target_uri like 'http://h3.%'",
        "target_uri like '%/7' or record_type = 'metadata'",
        "not record_type = 'response'",
        "payload_digest is null and record_type <=> 'metadata'",
        "warc_date is not null",
        "record_type = 'response' and length(payload) = 100",
        "content_length between 100 and 300 and record_type not in ('request', 'metadata')",
    ],
)
def test_predicates_change_no_result(spark, foreign, where):
    """Pushed down and applied afterwards to everything: the same rows."""
    held = warc.read_warc(spark, foreign)
    every = spark.createDataFrame(held.collect(), held.schema)
    key = F.concat_ws("|", "record_type", "target_uri", "content_length")
    assert bag(held.where(where).select(key).collect()) == bag(every.where(where).select(key).collect())


def test_filters_are_taken_by_the_source(spark, foreign):
    reader = warc.WarcSource({"path": foreign}).reader(StructType().add("record_type", "string"))
    asked = [ds.EqualTo(("record_type",), "response"), ds.Not(ds.StringStartsWith(("target_uri",), "http")), ds.EqualTo(("payload",), b"x"), ds.IsNull(("headers", "a"))]
    assert list(reader.pushFilters(asked)) == asked[2:]
    assert reader.filters == asked[:2]
    plan = warc.read_warc(spark, foreign).where("record_type = 'response'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter [" not in plan


def test_unwanted_payloads_are_not_inflated():
    big = bytes(range(256)) * 8000
    parts = [warc.member(warc.record(k, {"WARC-Target-URI": k}, big), 6) for k in ("metadata", "resource", "metadata")]
    data = b"".join(parts)
    for filters, payload, least in ([[], True, 3 * len(big)], [[ds.EqualTo(("record_type",), "resource")], True, len(big)], [[], False, 0]):
        stream = warc.Inflated(io.BytesIO(data), 0)
        got = list(warc.records(stream, len(data), filters, payload))
        assert len(got) == (1 if filters else 3)
        assert all(p == big for _, p in got) if payload else all(p is None for _, p in got)
        assert least <= stream.inflated < least + (1 << 15)


def test_large_files_are_cut_at_marks(spark, edge):
    path = scratch_path(spark, "warc-marks")
    responses, _ = warc.page_records(warc.table(spark, edge, "pages"))
    warc.register(spark)
    responses.coalesce(1).write.format("warc").option("markBytes", 500).option("level", 0).mode("append").save(path)
    fs, root = warc.filesystem(path)
    (told,) = warc._listed(fs, root)
    parts = warc.plan([told], 1000)
    assert len(parts) > 2
    assert [p[1] for part in parts for p in part.parts][1:] == [p[2] for part in parts for p in part.parts][:-1]
    df = spark.read.format("warc").option("partitionBytes", 1000).load(path)
    assert df.rdd.getNumPartitions() == len(parts)
    assert df.where("record_type = 'response'").count() == responses.count()


@pytest.mark.parametrize("spoil", [lambda b: b[:-40], lambda b: b[:30] + b"\0\0\0\0" + b[34:], lambda b: b"no archive"])
def test_damaged_archives_are_named(tmp_path, spoil):
    data = spoil(warc.member(warc.record("resource", {}, b"some payload" * 20), 6))
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    reader = warc.WarcSource({"path": str(path)}).reader(StructType().add("payload", "binary"))
    with pytest.raises(ValueError, match="x.warc.gz"):
        for p in reader.partitions():
            list(reader.read(p))
