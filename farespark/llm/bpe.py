"""Byte-level BPE encoding and decoding.

``pretokens`` cuts the texts of a batch into slices by array scans; each
distinct slice is merged once by the ranks and cached, and a text's ids are
its slices' ids in turn. ``encode`` keeps the byte offset at which each token
ends, so ``decode`` lays the tokens' bytes out at known places, and
``decode_span`` finds the tokens of a byte range without decoding the rest.

Ids are little-endian unsigned 32-bit integers in a binary value, offsets
(ends of tokens in bytes, from the start of the text) likewise 64-bit.

Defined results: null and empty texts have no ids and decode to no bytes. The
path of the rank file is a parameter; each Python worker reads it once. Other
columns stay as they are, also one called like the struct's fields.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.llm.common import table, text_of
from farespark.llm.pretokens import split_batch

#: Distinct slices of a generation; a worker keeps two generations, and slices that are asked for again move to the newer one.
CACHE = 150_000


class SliceCache:
    """Ids of the slices met lately, ``learn`` for those not known; slices over ``LONG`` code points are not kept."""

    LONG = 64

    def __init__(self, learn, most: int = CACHE):
        self.learn, self.most, self.new, self.old = learn, most, {}, {}

    def ids(self, slices: list[str]) -> bytes:
        """The slices' ids in turn, little-endian unsigned 32-bit."""
        known = list(map(self.new.get, slices))
        if None in known:
            for i in [i for i, k in enumerate(known) if k is None]:
                known[i] = self._found(slices[i])
        return b"".join(known)

    def _found(self, piece: str) -> bytes:
        got = self.new.get(piece) or self.old.get(piece) or self.learn(piece)
        if len(piece) <= self.LONG:
            self.new[piece] = got
            if len(self.new) >= self.most:
                self.old, self.new = self.new, {}
        return got


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of lowest rank merges first, the leftmost of equals."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    if n <= SHORT:
        return _merge_short(piece, ranks)
    end = list(range(1, n + 1))  # of the part that starts here
    prev = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = ranks.get(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if gone[i] or j >= n or end[j] != stop:
            continue
        gone[j] = 1
        end[i] = stop
        if stop < n:
            prev[stop] = i
            r = ranks.get(piece[i : end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        p = prev[i]
        if p >= 0:
            r = ranks.get(piece[p:stop])
            if r is not None:
                heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


#: Slices up to so many bytes are merged by scanning their pairs; longer ones by a heap.
SHORT = 32
_NEVER = 1 << 60


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    get = ranks.get
    cut = list(range(len(piece) + 1))
    pair = [get(piece[i : i + 2], _NEVER) for i in range(len(piece) - 1)]
    while pair:
        low = min(pair)
        if low == _NEVER:
            break
        i = pair.index(low)
        del cut[i + 1], pair[i]
        if i < len(pair):
            pair[i] = get(piece[cut[i] : cut[i + 2]], _NEVER)
        if i:
            pair[i - 1] = get(piece[cut[i - 1] : cut[i + 1]], _NEVER)
    return [ranks[piece[a:b]] for a, b in zip(cut, cut[1:])]


class Encoder:
    """Encodes and decodes by a rank file (base64 token and rank on each line)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.cache = SliceCache(lambda piece: array("I", merge(piece.encode("utf-8", "surrogatepass"), ranks)).tobytes())
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            tokens[r] = t
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.cache.ids(slices) for slices in split_batch(texts)]

    def ends(self, ids: bytes) -> np.ndarray:
        """Byte offset at which each token ends."""
        return np.cumsum(self.size[np.frombuffer(ids, "<u4")])

    def decode(self, ids: bytes, ends: np.ndarray | None = None) -> bytes:
        got = np.frombuffer(ids, "<u4")
        if not len(got):
            return b""
        ends = self.ends(ids) if ends is None else ends
        size = self.size[got]
        src = np.arange(int(ends[-1])) + np.repeat(self.start[got] - (ends - size), size)
        return self.bytes[src].tobytes()

    def decode_span(self, ids: bytes, ends: np.ndarray, start: int, stop: int) -> bytes:
        """Bytes start to stop of the text, decoding only the tokens that hold them."""
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        before = int(ends[a - 1]) if a else 0
        return self.decode(ids[4 * a : 4 * b], ends[a:b] - before)[max(0, start - before) : max(0, stop - before)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(read_ranks(path))


def encoded(text: Column, path: str, batch: int = 500) -> Column:
    """Struct of a text's ids and the offsets at which its tokens end."""

    @F.pandas_udf("ids binary, ends binary")
    def of(texts: pd.Series) -> pd.DataFrame:
        enc, ids = encoder(path), []
        for part in itertools.batched(texts.tolist(), batch):
            ids += enc.encode([t or "" for t in part])
        return pd.DataFrame({"ids": ids, "ends": [enc.ends(x).astype("<i8").tobytes() for x in ids]})

    return of(text)


def decoded(ids: Column, ends: Column, path: str) -> Column:
    """The bytes of ids and their offsets."""

    @F.pandas_udf("binary")
    def of(ids: pd.Series, ends: pd.Series) -> pd.Series:
        enc = encoder(path)
        return pd.Series([enc.decode(i, np.frombuffer(e, "<i8")) if i is not None else None for i, e in zip(ids, ends)], dtype=object)

    return of(ids, ends)


def _digests(path: str, kind: pa.DataType, some: int = 200):
    schema = pa.schema([("doc_id", kind), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, some):
                part, told = b.slice(at, some), []
                for ids in enc.encode([t or "" for t in part.column(1).to_pylist()]):
                    told.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(enc.decode(ids, enc.ends(ids))).hexdigest()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*told), schema.types[1:]))], schema=schema)

    return run


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document: encoded, and decoded by the offsets, in one pass."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_digests(path, pa.int64()), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def multi_ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), multi_ranks_path())
