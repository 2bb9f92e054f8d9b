"""The pipeline on sf0.001: its stages against their operators, and odd tables."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import numpy as np
import pytest

from farespark.llm import bpe
from tests.llm.conftest import bag, rows_of


def stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"documents": docs}
    for name, f in corpus_pipeline.STAGES:
        f(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = out[name] = spark.read.parquet(str(tmp_path / name))
    return out


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_stages(spark, request, tmp_path, where):
    d = request.getfixturevalue(where)
    got = stages(spark, d, tmp_path)
    docs = got["documents"]
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert got[name].columns == docs.columns
    n = {name: df.count() for name, df in got.items()}
    assert n["documents"] >= n["toxicity"] >= n["simhash"] == n["passages"] >= n["mixing"] == n["bpe"]
    encoder, want = bpe.encoder(bpe.multi_ranks_path()), []
    for r in got["mixing"].collect():
        (ids,) = encoder.encode([r["text"] or ""])
        want.append((r["doc_id"], len(np.frombuffer(ids, "<u4")), hashlib.sha256(ids).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert bag(got["bpe"].collect()) == bag(want)


def test_run_is_its_stages(spark, small, tmp_path):
    assert bag(corpus_pipeline.run(spark, small).collect()) == bag(stages(spark, small, tmp_path)["bpe"].collect())


def test_toxic_documents_go(spark, small, tmp_path):
    labels = {r["doc_id"]: r["toxic"] for r in rows_of(spark, small, "labels")}
    kept = {r["doc_id"] for r in stages(spark, small, tmp_path)["toxicity"].select("doc_id").collect()}
    clean = [i for i, y in labels.items() if y == 0]
    assert np.mean([i in kept for i in clean]) > 0.9
