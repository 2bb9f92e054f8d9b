"""Winnowing against a plain version, its match guarantee, and the plan without Python."""

from __future__ import annotations

import hashlib
import re
import struct
import unicodedata

import pytest
import xxhash
from pyspark.sql import functions as F

from farespark.llm import winnowing
from tests.llm.conftest import bag, rows_of


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def tokens(text: str) -> list[str]:
    out, run = [], ""
    for c in [*text, "\n"]:
        wordy = unicodedata.category(c)[0] in "LN"
        if not wordy:
            out += [run] if 0 < len(run) <= winnowing.RUN else list(run)
            run = ""
        if wordy:
            run += c
        elif not re.match(r"[ \t\n\x0b\f\r]", c):
            out.append(c)
    return out


def chosen(text: str) -> list[tuple[int, int]]:
    t = tokens(text)
    one = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in t]
    if not t:
        return []
    if len(t) < winnowing.K:
        grams = [signed(xxhash.xxh64_intdigest(" ".join(t).encode(), 42))]
    else:
        grams = []
        for i in range(len(t) - winnowing.K + 1):
            h = one[i]
            for x in one[i + 1 : i + winnowing.K]:
                first = xxhash.xxh64_intdigest(struct.pack("<q", h), 42)
                h = signed(xxhash.xxh64_intdigest(struct.pack("<q", x), first))
            grams.append(h)
    grams = [h & 0xFFFFFFFF for h in grams]
    out = []
    for i in range(max(1, len(grams) - winnowing.W + 1)):
        window = grams[i : i + winnowing.W]
        at = max(i + n for n, h in enumerate(window) if h == min(window))
        if (grams[at], at) not in out:
            out.append((grams[at], at))
    return out


def likeness(a, b) -> float:
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def written(c) -> str:
    return "".join(f"{h:08x}" for h, _ in c)


def naive(docs) -> list[tuple]:
    docs = [(i, t or "") for i, t in docs]
    # Distinct documents in order; Spark's hash of the text decides among equal ids.
    key = lambda x: (x[0] is not None, x[0] or 0, signed(xxhash.xxh64_intdigest(x[1].encode(), 42)) & -2 | (x[0] is None))
    order = sorted(set(docs), key=key)
    nxt = dict(zip(order, order[1:] + order[:1]))
    out = []
    for d in docs:
        i, text = d
        n = len(text) // 4
        edited = text[: len(text) - n] + nxt[d][1][:n]
        a, b = chosen(text), chosen(edited)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), likeness(a, b), likeness(a, chosen(nxt[d][1]))))
    return out


@pytest.mark.parametrize("where", ["edge", "empty"])
def test_op10(spark, request, where):
    d = request.getfixturevalue(where)
    docs = [(r["doc_id"], r["text"]) for r in rows_of(spark, d, "documents") if len(r["text"] or "") < 10_000]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got, want = bag(winnowing.edited_likeness(df).collect()), bag(naive(docs))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(a[5:] == pytest.approx(b[5:]) for a, b in zip(got, want))


def test_whole_edge_table(spark, edge):
    docs = rows_of(spark, edge, "documents")
    got = winnowing.op10_winnowing(spark, edge).collect()
    assert bag((r["doc_id"], r["n_chars"]) for r in got) == bag((r["doc_id"], len(r["text"] or "")) for r in docs)
    by_text = {}
    for r in got:
        assert by_text.setdefault((r["doc_id"], r["n_chars"]), r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_shared_run_shares_a_hash(spark):
    """K + W - 1 tokens in common give a hash in common, at the places of the run."""
    run = " ".join(f"tok{i}" for i in range(winnowing.K + winnowing.W - 1))
    df = spark.createDataFrame([(f"a b c {run} d e f",), (f"x {run} y z x y z x y",)], "text string")
    rows = winnowing.fingerprint(df, F.col("text"), "fp").select(winnowing.with_places(F.col("fp")).alias("p")).collect()
    a, b = ({x["hash"]: x["place"] for x in r["p"]} for r in rows)
    assert any(a[h] - b[h] == 2 for h in a.keys() & b.keys())


def test_runs_match_at_any_offset(spark):
    """What two unbroken runs share is found wherever the runs began."""
    letters = "".join(chr(97 + (i * i // 7 + i) % 26) for i in range(400))
    df = spark.createDataFrame([(letters,), ("x" + letters,), (letters[3:] + " end",)], "text string")
    a, b, c = ({h for h, _ in r["p"]} for r in winnowing.fingerprint(df, F.col("text"), "fp").select(winnowing.with_places(F.col("fp")).alias("p")).collect())
    assert len(a & b) / len(a | b) > 0.9 and len(a & c) / len(a | c) > 0.9


def test_plan_has_no_python(spark, small):
    plan = winnowing.op10_winnowing(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
