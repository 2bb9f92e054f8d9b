"""Token ids in binary shards with a minimal perfect hash index.

Documents are ordered by (doc_id, hash of the text), encoded with a library
tokenizer, ended with an end id and packed into shards of about
``SHARD_TOKENS`` ids. A shard is one row of a Parquet file, so that Spark's
committer takes care of lost executors and any store that Spark writes to will do:

    part, seq      order of the shards: writing task, shard within it
    n_docs, n_tokens, first_id, last_id
    keys           document ids, little-endian signed 64-bit, in order (null: 0)
    nulls          one byte for each key, 1 where the id is null
    payload        raw ids of all documents, little-endian unsigned 16-bit, or 32-bit
                   if the vocabulary needs them (``width``)
    index          minimal perfect hash, see ``MphIndex``

The index maps a key (id and its number among equal ids of the shard) to a slot
without storing keys: keys are dealt into small buckets; each bucket has a
displacement that sends its keys to free slots, found for the largest buckets
first; buckets of one key name their slot. As many slots as keys. A slot stores
a 32-bit fingerprint of its key, the offset and the number of ids, so a look-up
costs the same at any size, and a foreign key is refused.

Defined results: null and empty texts are one end id. Null document ids come
first. Rows that repeat an id are documents of their own, numbered within the
shard. An empty table writes no shard and reads back empty. Other columns are
not looked at.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farespark.llm.bpe import CACHE, SliceCache
from farespark.llm.common import table, text_of
from farespark.llm.pretokens import split_batch
from farespark.session import scratch_path

SHARD_TOKENS = 1 << 20
END_ID = 0

_U = np.uint64


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of numbers."""
    x = x.astype(_U) + _U(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def key_hashes(ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """Hash of each (id, number among equal ids before it)."""
    base = np.where(nulls, _U(0x5851F42D4C957F2D), _mix(ids.astype("i8").view(_U), 1))
    order = np.argsort(base, kind="stable")
    new = np.concatenate([[True], base[order][1:] != base[order][:-1]]) if len(base) else np.zeros(0, bool)
    number = np.empty(len(base), np.int64)
    number[order] = np.arange(len(base)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(base) else 0
    return key_hash(base, number)


def key_hash(base: np.ndarray, number: np.ndarray) -> np.ndarray:
    return _mix(base ^ _mix(number.astype(_U), 2), 3)


class MphIndex:
    """Header (n, buckets, seed as unsigned 32-bit), displacements (signed 32-bit), fingerprints (unsigned 32-bit), offsets and counts (unsigned 64-bit)."""

    def __init__(self, n: int, seed: int, moves: np.ndarray, prints: np.ndarray, offsets: np.ndarray, counts: np.ndarray):
        self.n, self.seed, self.moves, self.prints, self.offsets, self.counts = n, seed, moves, prints, offsets, counts

    @classmethod
    def build(cls, keys: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> MphIndex:
        n, seed = len(keys), 0
        while True:
            seed += 1
            moves = _displacements(keys, seed)
            if moves is not None:
                break
        index = cls(n, seed, moves, *(np.zeros(n, t) for t in ("<u4", "<u8", "<u8")))
        slot = index.slots(keys)
        index.prints[slot], index.offsets[slot], index.counts[slot] = _print(keys, seed), offsets, counts
        return index

    def slots(self, keys: np.ndarray) -> np.ndarray:
        d = self.moves[(_mix(keys, self.seed) % _U(max(len(self.moves), 1))).astype(np.int64)].astype(np.int64)
        return np.where(d < 0, -d - 1, _slot(keys, self.seed, np.maximum(d, 0), self.n))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, offset, number of ids) of each key."""
        if not self.n:
            return np.zeros(len(keys), bool), np.zeros(len(keys), "u8"), np.zeros(len(keys), "u8")
        s = self.slots(keys)
        return self.prints[s] == _print(keys, self.seed), self.offsets[s], self.counts[s]

    def to_bytes(self) -> bytes:
        head = np.array([self.n, len(self.moves), self.seed], "<u4")
        return b"".join(x.tobytes() for x in (head, self.moves.astype("<i4"), self.prints, self.offsets, self.counts))

    @classmethod
    def from_bytes(cls, data: bytes) -> MphIndex:
        n, b, seed = np.frombuffer(data, "<u4", 3).tolist()
        at = itertools.accumulate([12, 4 * b, 4 * n, 8 * n])
        return cls(n, seed, *(np.frombuffer(data, t, c, o) for t, c, o in zip(("<i4", "<u4", "<u8", "<u8"), (b, n, n, n), at)))


def _print(keys: np.ndarray, seed: int) -> np.ndarray:
    return (_mix(keys, seed + 1000) >> _U(32)).astype("<u4")


def _slot(keys: np.ndarray, seed: int, d: np.ndarray, n: int) -> np.ndarray:
    return (_mix(keys ^ (d.astype(_U) * _U(0xD6E8FEB86659FD93)), seed + 2000) % _U(max(n, 1))).astype(np.int64)


def _displacements(keys: np.ndarray, seed: int, tries: int = 64, most: int = 1 << 16) -> np.ndarray | None:
    """A displacement for each bucket, or None if a bucket finds no place."""
    n = len(keys)
    buckets = max(1, n // 3)
    bucket = (_mix(keys, seed) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=buckets)
    start = np.cumsum(size) - size
    moves, taken = np.zeros(buckets, "<i4"), np.zeros(n, bool)
    single = []
    for b in np.argsort(-size, kind="stable").tolist():
        if size[b] == 0:
            break
        if size[b] == 1:
            single.append(b)
            continue
        k = keys[order[start[b] : start[b] + size[b]]]
        for first in range(0, most, tries):
            slots = _slot(k[None, :], seed, np.arange(first, first + tries)[:, None], n)
            apart = np.sort(slots, axis=1)
            good = ~taken[slots].any(axis=1) & (apart[:, 1:] != apart[:, :-1]).all(axis=1)
            if good.any():
                at = int(good.argmax())
                moves[b] = first + at
                taken[slots[at]] = True
                break
        else:
            return None
    moves[single] = -np.flatnonzero(~taken)[: len(single)] - 1
    return moves


# Fixed values of byte-level vocabularies: the printable bytes stand for themselves, the others for code points from 256 on, in turn.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHOWN = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(256, 512)))


class LibraryEncoder:
    """Ids of the tokenizers library. Its model sees each distinct pre-token once in a while; the ids of a text are those of its pre-tokens in turn.
    Texts that hold an added token of the vocabulary, which has an id of its own, go through the library whole."""

    def __init__(self, path: str):
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.model = self.whole.model
        self.wide = self.whole.get_vocab_size() > 1 << 16
        self.cache = SliceCache(self.learn, most=2 * CACHE)

    def learn(self, piece: str) -> bytes:
        shown = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(_SHOWN)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        held = [any(a in t for a in self.added) for t in texts]
        plain = iter(split_batch([t for t, h in zip(texts, held) if not h]))
        return [np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if h else self.cache.ids(next(plain)) for t, h in zip(texts, held)]


@functools.lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return LibraryEncoder(path)


_SHARD = "part int, seq int, n_docs long, n_tokens long, first_id long, last_id long, width int, keys binary, nulls binary, payload binary, index binary"


def _packed(part: int, seq: int, ids: list, texts: list[bytes], wide: bool) -> tuple:
    counts = np.array([len(t) // 4 for t in texts], np.int64)
    nulls = np.array([i is None for i in ids])
    keys = np.array([0 if i is None else i for i in ids], "<i8")
    index = MphIndex.build(key_hashes(keys, nulls), np.cumsum(counts) - counts, counts)
    payload = np.frombuffer(b"".join(texts), "<u4")
    live = keys[~nulls]
    lo, hi = (int(live[0]), int(live[-1])) if len(live) else (None, None)
    return part, seq, len(ids), int(counts.sum()), lo, hi, 4 if wide else 2, keys.tobytes(), nulls.astype("u1").tobytes(), payload.astype("<u4" if wide else "<u2").tobytes(), index.to_bytes()


def _packing(tokenizer: str, shard_tokens: int):
    end = np.array([END_ID], "<u4").tobytes()

    def run(frames):
        encoder, part, seq, ids, texts, size = None, 0, 0, [], [], 0
        for f in frames:
            encoder = encoder or library_encoder(tokenizer)
            part = int(f["part"].iloc[0]) if len(f) else part
            for rows in itertools.batched(f[["doc_id", "text"]].itertuples(index=False, name=None), 500):
                for (i, _), got in zip(rows, encoder.encode([t for _, t in rows])):
                    ids.append(None if pd.isna(i) else int(i))
                    texts.append(got + end)
                    size += len(got) // 4 + 1
                    if size >= shard_tokens:
                        yield pd.DataFrame([_packed(part, seq, ids, texts, encoder.wide)], columns=_NAMES)
                        seq, ids, texts, size = seq + 1, [], [], 0
        if ids:
            yield pd.DataFrame([_packed(part, seq, ids, texts, encoder.wide)], columns=_NAMES)

    return run


_NAMES = [c.split()[0] for c in _SHARD.split(", ")]


def write_ids(docs: DataFrame, path: str, tokenizer: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes the shards of ``docs`` (doc_id, text) to the folder ``path``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    ordered = (
        rows.withColumn("h", F.xxhash64("text"))
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select(F.col("doc_id").cast("decimal(20,0)").cast("string").alias("doc_id"), "text", F.spark_partition_id().alias("part"))
    )
    # Ids travel as text, so that pandas does not turn a column with nulls into floating point.
    ordered.mapInPandas(_packing(tokenizer, shard_tokens), _SHARD).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SHARD).parquet(path)


def _unpacked(frames):
    """The documents of each shard, found through its index."""
    for f in frames:
        for s in f.itertuples(index=False):
            ids, nulls = np.frombuffer(s.keys, "<i8"), np.frombuffer(s.nulls, "u1") > 0
            known, offset, count = MphIndex.from_bytes(s.index).find(key_hashes(ids, nulls))
            if not known.all():
                raise ValueError("a shard's index does not know one of its keys")
            payload = np.frombuffer(s.payload, f"<u{s.width}").astype("<u4")
            crc = [zlib.crc32(payload[a : a + n]) for a, n in zip(offset.astype("i8").tolist(), count.astype("i8").tolist())]
            yield pd.DataFrame(
                {"part": s.part, "seq": s.seq, "doc_id": pd.array(ids, "Int64"), "at": offset.astype("i8"), "n_tokens": count.astype("i8"), "ids_crc32": crc}
            ).assign(doc_id=lambda d: d["doc_id"].mask(nulls))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of each document, from the files."""
    shards = read_shards(spark, path)
    sizes = shards.select("part", "seq", "n_tokens")
    # One row a writing task, then the shards of each task.
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    starts = sizes.withColumn("within", within).join(parts, "part").select("part", "seq", (F.col("before") + F.col("within")).alias("base"))
    found = shards.select("part", "seq", "width", "keys", "nulls", "payload", "index").mapInPandas(
        _unpacked, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this id (usually one): of the shards that can hold it only the index is fetched, its slot is computed, and the slot's bytes are cut out of the payload."""
    out = []
    shards = read_shards(spark, path).where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    base = _mix(np.array([doc_id], "i8").view(_U), 1)
    for s in shards.select("part", "seq", "width", "index").orderBy("part", "seq").toLocalIterator():
        index, slots = MphIndex.from_bytes(bytes(s["index"])), []
        for number in itertools.count():
            known, at, n = index.find(key_hash(base, np.array([number])))
            if not known[0]:
                break
            slots.append((int(at[0]) * s["width"], int(n[0]) * s["width"]))
        if slots:
            cuts = [F.substring("payload", a + 1, n) for a, n in slots]
            out += [np.frombuffer(c, f"<u{s['width']}").tolist() for c in shards.where((F.col("part") == s["part"]) & (F.col("seq") == s["seq"])).select(*cuts).first()]
    return out


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    write_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer_path())
    return read_documents(spark, path)
