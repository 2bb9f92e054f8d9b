"""Mixing and resharding against plain versions."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from farespark.llm import mixing, sharding
from tests.llm.conftest import bag, rows_of


@pytest.mark.parametrize("seed", range(20))
def test_min_cost_flow_moves_the_fewest_bytes(seed):
    rng = np.random.default_rng(seed)
    m, n = int(rng.integers(1, 4)), int(rng.integers(1, 4))
    supply = rng.integers(0, 4, m).tolist()
    total, cuts = sum(supply), np.sort(rng.integers(0, sum(supply) + 1, n - 1))
    demand = np.diff([0, *cuts, total]).tolist()
    cost = rng.integers(0, 4, (m, n)).tolist()
    flow = sharding.min_cost_flow(supply, demand, cost)
    assert [sum(r) for r in flow] == supply and [sum(c) for c in zip(*flow)] == demand
    units = [i for i, s in enumerate(supply) for _ in range(s)]
    seats = [j for j, d in enumerate(demand) for _ in range(d)]
    # A relaxed check by all ways to seat the units, where there are few.
    if len(units) <= 7:
        best = min(sum(cost[i][j] for i, j in zip(units, p)) for p in set(itertools.permutations(seats)))
        assert sum(flow[i][j] * cost[i][j] for i in range(m) for j in range(n)) == best


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op4(spark, request, where):
    d = request.getfixturevalue(where)
    docs = rows_of(spark, d, "documents")
    got = sharding.op4_sharding(spark, d).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs]
    assert bag((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == bag(want)
    assert all(r["law"] == "bytes" and 0 <= r["shard"] < 8 and r["grown_shard"] is None for r in got)
    size, slots, group = Counter(), defaultdict(list), Counter()
    for r in got:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        group[r["text_crc32"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if where == "small":
        total = sum(size.values())
        assert max(abs(size[j] - total / 8) for j in range(8)) <= 2 * max(group.values())


def test_op4_groups_stay_whole(spark, small):
    """Copies part only where they fill over half a shard; then sizes are still near equal."""
    size, shards, group = Counter(), defaultdict(set), Counter()
    for r in sharding.op4_sharding(spark, small).collect():
        size[r["shard"]] += r["size"]
        shards[r["text_crc32"]].add(r["shard"])
        group[r["text_crc32"]] += r["size"]
    assert not [t for t, s in shards.items() if len(s) > 1 and group[t] <= sharding.WHOLE * sum(size.values()) / sharding.N_NEW]


def test_op4_large_groups_leave_the_sizes_equal(spark, tmp_path):
    """A hot text of a third of all rows parts, groups of a twelfth of a shard do not, and no shard is off by more than a part of them."""
    rows = [(i, "hot" if i % 3 == 0 else f"group {i % 96}" if i % 3 == 1 else f"text {i}") for i in range(9_000)]
    got = _resharded(spark, rows, tmp_path)
    shards, size = defaultdict(set), Counter()
    texts = dict(rows)
    for r in got:
        shards[texts[r["doc_id"]]].add(r["shard"])
        size[r["shard"]] += r["size"]
    assert len(got) == len(rows) and len(shards.pop("hot")) > 1
    assert all(len(s) == 1 for s in shards.values())
    mean = sum(size.values()) / 8
    assert max(abs(size[j] - mean) for j in range(8)) < 0.02 * mean


def test_only_affected_shards_are_written():
    blocks = [sharding.Transfer(0, 0, 0, 5, 9), sharding.Transfer(1, 1, 0, 4, 3), sharding.Transfer(1, 3, 4, 9, 2), sharding.Transfer(2, 2, 0, 9, 5)]
    assert sharding.affected(blocks, 3, 4) == [1, 3]


def _old_shards(spark, rows) -> list[list[tuple]]:
    """The rows (doc_id, text) by the old shard that they have in a small table."""
    docs = sharding.sized(spark.createDataFrame(rows, "doc_id long, text string"))
    out = [[] for _ in range(sharding.N_OLD)]
    for r in docs.select("doc_id", "text", F.pmod(sharding._order(docs, sharding.N_NEW), F.lit(sharding.N_OLD)).alias("old")).collect():
        out[r["old"]].append((r["doc_id"], r["text"]))
    return out


def _resharded(spark, rows, tmp_path) -> list:
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return sharding.op4_sharding(spark, str(tmp_path)).collect()


def test_op4_keeps_the_one_null_text(spark, tmp_path):
    row = _old_shards(spark, [(i, None) for i in range(60)])[0][0]
    got = _resharded(spark, [row], tmp_path)
    assert [(r["doc_id"], r["shard"], r["slot"]) for r in got] == [(row[0], 0, 0)]


def test_op4_keeps_a_shard_that_holds_its_capacity(spark, tmp_path):
    """Of 240 bytes old shard 0 has 30, which is its capacity: it gives and takes nothing, the others change."""
    old = _old_shards(spark, [(i, f"t{i:03d}") for i in range(400)])
    rows = old[0][:6] + [x for shard, n in zip(old[1:], (10, 9, 8, 8, 7)) for x in shard[:n]]
    got = _resharded(spark, rows, tmp_path)
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    assert sorted(r["doc_id"] for r in got if r["shard"] == 0) == sorted(i for i, _ in rows[:6])
    assert sorted(r["slot"] for r in got if r["shard"] == 0) == list(range(6))


def test_deal_gives_shortage_to_siblings_first():
    half = Fraction(1, 2)
    assert mixing.deal(100, [(half, 10), (half, 500)]) == [10, 90]
    assert mixing.deal(100, [(Fraction(1), 10), (Fraction(1), 20)]) == [10, 20]
    assert sum(mixing.deal(101, [(Fraction(1), 1000)] * 3)) == 101
    assert mixing.deal(10, [(Fraction(0), 50), (Fraction(1), 4)]) == [0, 4]
    leaves = {("a", "x", "1"): 10, ("a", "y", "2"): 1000, ("b", "x", "3"): 1000}
    mix = mixing.Mixture(domains={"a": 1, "b": 1}, max_epochs=1)
    assert mixing.solve(leaves, mix, 400) == {("a", "x", "1"): 10, ("a", "y", "2"): 190, ("b", "x", "3"): 200}


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op7(spark, request, where):
    d = request.getfixturevalue(where)
    docs = rows_of(spark, d, "documents")
    got = mixing.op7_mixing(spark, d).collect()
    domain = ("web", "books", "reference")
    held, most = Counter(), Counter()
    for r in docs:
        n = len(re.findall(r"[^ \t\n\x0b\f\r]+", r["text"] or ""))
        digits = "".join(itertools.takewhile(str.isdigit, reversed(r["source"] or "")))[::-1]
        leaf = (domain[int(digits or 0) % 3], r["lang"], r["source"])
        held[leaf] += n
        most[leaf] = max(most[leaf], n)
    budget = int(Fraction(str(mixing.PLAN.fraction)) * sum(held.values()))
    parts = mixing.solve(held, mixing.PLAN, budget)
    taken = Counter()
    for r in got:
        taken[(r["domain"], r["lang"], r["source"])] += r["n_tokens"] * r["copies"]
        assert 1 <= r["copies"] <= mixing.PLAN.max_epochs
    for leaf, part in parts.items():
        # The next document of the order would go beyond; rows that tie count together.
        assert taken[leaf] <= part and part - taken[leaf] < 4 * most[leaf] + 1
    again = mixing.op7_mixing(spark, d).collect()
    assert bag(again) == bag(got)


def test_take_mix_keeps_columns(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    out = mixing.take_mix(docs)
    assert out.columns == docs.columns and out.count() > 0


def _leaves(rows, n_tokens) -> Counter:
    domain = ("web", "books", "reference")
    out = Counter()
    for r in rows:
        digits = re.search(r"[0-9]*$", r["source"] or "")[0]
        out[(domain[int(digits or 0) % 3], r["lang"], r["source"])] += n_tokens(r)
    return out


def _words(r) -> int:
    return len(re.findall(r"[^ \t\n\x0b\f\r]+", r["text"] or ""))


def _realised(parts: dict) -> dict:
    return {k: n for k, n in parts.items() if n}


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op7_realises_the_weights(spark, request, where):
    d = request.getfixturevalue(where)
    docs = rows_of(spark, d, "documents")
    held = _leaves(docs, _words)
    parts = mixing.solve(held, mixing.PLAN, int(Fraction(str(mixing.PLAN.fraction)) * sum(held.values())))
    got = mixing.op7_mixing(spark, d).collect()
    assert _realised(_leaves(got, lambda r: r["n_tokens"] * r["copies"])) == _realised(parts)


@pytest.mark.parametrize("seed", range(3))
def test_take_mix_gives_each_leaf_its_part_of_skewed_documents(spark, seed):
    """Leaves that one very long document dominates, repeated rows, and odd white space."""
    rows = [(0, " \n" + "long\t word  " * 5000, "en", "src0"), (1, "only one document of its leaf " * 40, "de", "src1")]
    rows += [(10 + i, f"short text\n{i} " * 25, "en", "src0") for i in range(130)]
    rows += [(500, "the same row again and again", "fr", "src2")] * 7 + [(501, None, "fr", "src2"), (502, "", "fr", "src2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mix = mixing.Mixture(fraction=0.8, max_epochs=1, seed=seed)
    held = _leaves(docs.collect(), _words)
    parts = mixing.solve(held, mix, int(Fraction(str(mix.fraction)) * sum(held.values())))
    got = mixing.take_mix(docs, mix).collect()
    assert _realised(_leaves(got, _words)) == _realised(parts)
    whole = {r[0]: r[1] or "" for r in rows}
    assert all(whole[r["doc_id"]].startswith(r["text"] or "") for r in got)
    assert not Counter(r["doc_id"] for r in got) - Counter(r[0] for r in rows)
    cut = Counter((r["lang"], r["source"]) for r in got if (r["text"] or "") != whole[r["doc_id"]])
    assert all(n == 1 for n in cut.values())


def test_mixing_keeps_columns_of_any_name(spark):
    """Columns called as the operator's own come back as they were."""
    names = ["_domain", "_language", "_source", "_key", "_tokens", "_text_hash", "_copies", "_take", "_r", "_leaf_domain", "c0", "_epoch"]
    docs = spark.range(50).select(
        F.col("id").alias("doc_id"), F.format_string("word%d of text", "id").alias("text"), F.lit("en").alias("lang"), F.lit("src1").alias("source"), *[F.lit(f"own {n}").alias(n) for n in names]
    )
    got = mixing.take_mix(docs, mixing.PLAN, F.lit("one domain"))
    assert got.columns == docs.columns
    rows = got.collect()
    assert rows and all(r[n] == f"own {n}" for r in rows for n in names)
