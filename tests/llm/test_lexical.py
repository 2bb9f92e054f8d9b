"""Ranked search against scores of every document."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from farespark.llm import lexical
from farespark.session import scratch_path
from tests.llm.conftest import bag, rows_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text) -> list[str]:
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, top: int) -> list[tuple]:
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    n_all, l_all = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c, n in counts:
            m = 50 + 50 * n * n_all // l_all
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(scored)[:top])]
    return out


def test_terms():
    text = "Ab9_ÄÖ×x\x7f[z]`q{\U0001f600}É 中文a b"
    assert [t.decode() for t in lexical.terms_of(text)] == terms(text)
    assert lexical.terms_of(None) == lexical.terms_of("") == []


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op12(spark, request, where):
    d = request.getfixturevalue(where)
    docs = [(r["doc_id"], r["text"]) for r in rows_of(spark, d, "documents")]
    items = [(r["item_id"], r["text"]) for r in rows_of(spark, d, "benchmark")]
    got = lexical.op12_k2_treap(spark, d).select("item_id", "rank", "doc_id", "score").collect()
    assert bag(got) == bag(plain(docs, items, 50))


@pytest.mark.parametrize(("cells", "block", "top"), [(40, 30, 3), (1, 1_000_000, 7), (400, 10, 1)])
def test_small_shards_and_blocks(spark, small, cells, block, top):
    """Ties among many copies, one document a shard, several blocks of items."""
    docs = [(r["doc_id"], (r["text"] or "")[:300]) for r in rows_of(spark, small, "documents")][:60]
    docs += [(1000 + i, docs[3][1]) for i in range(20)] + [(1000, docs[3][1])]
    items = [(r["item_id"], r["text"]) for r in rows_of(spark, small, "benchmark")][:9] + [(77, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    index = lexical.Index.write(df, scratch_path(spark, "lexical-test"), cells)
    got = index.search(spark.createDataFrame(items, "item_id int, text string"), top, block)
    assert bag(got.collect()) == bag(plain(docs, items, top))


@pytest.mark.parametrize("shape", [(1, 1), (1, 40), (40, 1), (300, 20), (7, 257)])
def test_tree(shape):
    rng = np.random.default_rng(sum(shape))
    grid = rng.integers(0, 100_000, shape) * (rng.random(shape) < 0.3)
    grid[-1, -1] = 5
    row, col = np.nonzero(grid)
    by = rng.permutation(len(row))
    tree = lexical.Tree(*lexical.build(row[by], col[by], grid[row[by], col[by]]))
    nodes = tree.rows_at(np.arange(shape[0]), tree.height - (shape[1] - 1).bit_length())
    ids = np.arange(shape[1])
    for _ in range(20):
        rows = rng.permutation(shape[0])[: rng.integers(1, 9)]
        w = rng.integers(0, 50, len(rows))
        score = w @ grid[rows]
        want = sorted((-s, c) for c, s in enumerate(score.tolist()) if s > 0)[:5]
        got = lexical.best(tree, tree.height - (shape[1] - 1).bit_length(), rows, nodes[rows], w, ids, 5, None)
        assert sorted((-s, c) for s, c in got if s > 0) == want


def test_shards_are_read_whole(spark, small, tmp_path):
    """A shard is one file of rows that hold a slice of each column: no row has a shard's bytes in one, and no split of files parts a shard."""
    docs = [(r["doc_id"], r["text"]) for r in rows_of(spark, small, "documents")]
    items = [(r["item_id"], r["text"]) for r in rows_of(spark, small, "benchmark")][:20]
    index = lexical.Index.write(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), str(tmp_path / "index"), 5000)
    per_file = index.rows().selectExpr("_metadata.file_path as f", "octet_length(drops) as n").groupBy("f").agg({"*": "count", "n": "max", "f": "first"}).collect()
    assert len(per_file) > 3 and {r["count(1)"] for r in per_file} == {lexical.PIECES}
    whole = index.rows().selectExpr("_metadata.file_path as f", "octet_length(drops) as n").groupBy("f").sum("n").agg({"sum(n)": "max"}).first()[0]
    assert max(r["max(n)"] for r in per_file) <= whole // lexical.PIECES + 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")  # splits smaller than a file
    try:
        got = index.search(spark.createDataFrame(items, "item_id int, text string"), 5).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert bag(got) == bag(plain(docs, items, 5))
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "4096"
