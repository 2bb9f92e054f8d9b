"""Token shards and BPE against the libraries."""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import tokenizers

from farespark.llm import bpe, token_shards
from farespark.session import scratch_path
from tests.llm.conftest import bag, texts_of


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def multi():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op1(spark, request, library, where):
    d = request.getfixturevalue(where)
    got = token_shards.op1_token_shards(spark, d).collect()
    docs = texts_of(spark, d)
    ids = [np.array([*e.ids, 0], "<u4") for e in library.encode_batch([t for _, t in docs], add_special_tokens=False)]
    assert bag((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == bag((i, len(x), zlib.crc32(x.tobytes())) for (i, _), x in zip(docs, ids))
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))


def test_lookup_by_key(spark, edge, library):
    path = scratch_path(spark, "test-shards")
    token_shards.write_ids(spark.read.parquet(f"{edge}/documents.parquet"), path, token_shards.tokenizer_path(), shard_tokens=500)
    docs = texts_of(spark, edge)
    for i in (0, 4, 6, 13, -5):
        want = [[*library.encode(t, add_special_tokens=False).ids, 0] for n, t in docs if n == i]
        assert sorted(token_shards.lookup(spark, path, i)) == sorted(want)
    assert token_shards.lookup(spark, path, 12345) == []


def test_op1_added_tokens(spark, tmp_path):
    """Against the library as it comes: added tokens have ids of their own."""
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [end, f"one {end} two{end}{end}three", f" {end}\n {end} it's", "none of them <|endoftext |>", "", None, "a plain text " * 300 + end]
    docs = list(enumerate(texts))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = token_shards.op1_token_shards(spark, str(tmp_path)).collect()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in docs}
    assert ids[0] == [50256, 0]
    want = [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids.items()]
    assert bag((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == bag(want)


def test_every_code_point(library, multi):
    """Classes show in the slices: each code point between a digit and a letter, those of the first blocks also after a space, twice and after a quote."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    ours, theirs = token_shards.LibraryEncoder(P.path("byte_bpe_50k.json")), bpe.encoder(bpe.multi_ranks_path())
    for at in range(0, len(points), 100_000):
        texts = [f"1{c}a {c}{c} 's{c}" if c < "\u3100" else f"1{c}a" for c in points[at : at + 100_000]]
        want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [t for t, a, b in zip(texts, ours.encode(texts), want) if a != b] == []
        want = [np.array(x, "<u4").tobytes() for x in multi.encode_ordinary_batch(texts)]
        assert [t for t, a, b in zip(texts, theirs.encode(texts), want) if a != b] == []


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 20_000])
def test_perfect_hash(n):
    keys = token_shards.key_hashes(np.arange(n) * 17 - 5, np.zeros(n, bool))
    at = np.arange(n, dtype=np.int64) * 3
    index = token_shards.MphIndex.from_bytes(token_shards.MphIndex.build(keys, at, at + 1).to_bytes())
    known, offset, count = index.find(keys)
    assert known.all() and (offset == at).all() and (count == at + 1).all()
    if n:
        assert len(set(index.slots(keys).tolist())) == n
        foreign = token_shards.key_hashes(np.arange(n) * 17 + 10**9, np.zeros(n, bool))
        assert index.find(foreign)[0].mean() < 0.01


@pytest.mark.parametrize("where", ["small", "edge", "empty"])
def test_op2(spark, request, multi, where):
    d = request.getfixturevalue(where)
    got = bpe.op2_bpe(spark, d).collect()
    want = []
    for i, t in texts_of(spark, d):
        ids = np.array(multi.encode_ordinary(t), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert bag((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == bag(want)


def test_decode_span():
    enc = bpe.encoder(bpe.multi_ranks_path())
    text = "Spans — of naïve bytes, 中文 and more words' ends. " * 20
    data = text.encode()
    (ids,) = enc.encode([text])
    ends = enc.ends(ids)
    for a, b in ((0, 1), (3, 40), (100, 101), (0, len(data)), (len(data) - 7, len(data))):
        assert enc.decode_span(ids, ends, a, b) == data[a:b]
