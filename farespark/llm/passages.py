"""Suffix-array dedup: removes every byte covered by a long string that occurs more than once.

A window is a string of ``length`` bytes of one document. Windows that start
anywhere else too are repeated; the bytes they cover go. To bring equal windows
together without sending whole texts around, a window is owned by an anchor:
the k-gram in it with the smallest hash (the leftmost of equals). Equal windows
have equal anchors, and consecutive windows mostly share theirs.

1. Each document gives its anchors: hash of the k-gram, first and last window
   owned, and a hash of the snippet that these windows cover. Anchors whose
   k-gram is found once own no repeated window and go.
2. A snippet that occurs twice (copies of a document, say) repeats as a whole;
   one of its places stands for all. Only different snippets of one k-gram
   have to be compared byte by byte, and of these only such as share a side: a
   window holds its k-gram and at least half of its other bytes before or after
   it, so equal windows have equal bytes on that side.
3. These are dealt out to shards by the k-gram. Each shard builds a suffix array
   (Larsson-Sadakane) and common prefixes (Kasai); windows whose neighbour in it
   shares ``length`` bytes are repeated. A k-gram with more than ``PIECE``
   different snippets is spread over several shards.
4. Shards of one k-gram are merged: each sends its sorted windows by ranges, and
   in each range every shard's windows are searched in the others' by
   binary search.

``cut_repeats`` (the pipeline's stage) also cuts passages by words: a window of
``words`` words (split at ASCII white space, whatever its kind) that another row
holds too goes, however few bytes it has. Anchors and snippets are found as
above, with words for bytes; the windows of different snippets of one k-gram are
then grouped by a 128-bit hash, which knows the rows of all its places.

Defined results: null and empty texts, and those shorter than a window, lose
nothing. Rows that repeat an id and text are places of their own, so windows
of both repeat. Null ids are a value like others here. An empty table gives an
empty result; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.llm.common import fresh, giving_back, land, table, text_of
from farespark.llm.suffix_arrays import repeated_windows

LENGTH = 400
GRAM = 32
#: Words of a passage that goes if another row holds it, and of the k-gram in it that owns its windows.
WORDS = 50
WORD_GRAM = 16
#: Different snippets of one k-gram that a shard takes.
PIECE = 4096
#: Bytes that a task sorts at once, unless one group of a shard is larger.
_AT_ONCE = 1 << 20
_STRETCH = 1 << 20
_STRETCH_WORDS = 1 << 17
_BYTE = np.random.default_rng(42).integers(1 << 62, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _gram_hashes(h: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of ``gram`` hashes (a power of two) from each place, by doubling."""
    size, power = 1, _BASE
    while size < gram:
        h = h[:-size] * np.uint64(power) + h[size:]
        size, power = size * 2, power * power % (1 << 64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` keys from each place."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def _owners(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the k-gram that owns each window (the leftmost of smallest hash); first and last window of each run of one owner."""
    keys = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    owner = (_least(keys, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    return owner, first, np.concatenate([first[1:] - 1, [len(owner) - 1]])


def _hash(data: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(data, seed) - (1 << 63)


def anchors(data: bytes, length: int = LENGTH) -> Iterator[tuple]:
    """(k-gram hash, snippet hash, first window, last window, sides, last window of all, copies) of each anchor of a document, in turn.

    sides: hashes of the k-gram with the ``side`` bytes before, and after it,
    each if a window of the anchor holds them. Neighbouring anchors with the
    same snippet, as in a run of one character or of a short period, are one
    row with the number of copies.
    """
    side, held = (length - GRAM) // 2, None
    for at in range(0, max(0, len(data) - length + 1), _STRETCH):
        part = np.frombuffer(data, np.uint8)[at : at + _STRETCH + length - 1]
        h = _gram_hashes(_BYTE[part])
        owner, first, last = _owners(h, length - GRAM + 1)
        for some in range(0, len(first), _ROWS):
            cut = slice(some, some + _ROWS)
            grams, places = h[owner[first[cut]]].view(np.int64).tolist(), (owner[first[cut]] + at).tolist()
            for g, place, lo, hi in zip(grams, places, (first[cut] + at).tolist(), (last[cut] + at).tolist()):
                snippet = _hash(data[lo : hi + length], 0)
                if held and held[:2] == (g, snippet):
                    held = (*held[:5], hi, held[6] + 1)
                    continue
                if held:
                    yield held
                sides = [_hash(data[place - side : place + GRAM], 1)] if place - lo >= side else []
                if place - hi <= length - GRAM - side:
                    sides.append(_hash(data[place : place + GRAM + side], 2))
                held = (g, snippet, lo, hi, sides, hi, 1)
    if held:
        yield held


def _is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))  # what bytes.split() splits at


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after its last."""
    inside = ~_is_space(np.frombuffer(data, np.uint8))
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each word of ``data``, which begins with one."""
    place = np.arange(len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    power = np.cumprod(np.full(int(place.max()) + 1, _BASE, np.uint64))
    h = np.add.reduceat(np.where(_is_space(data), np.uint64(0), _BYTE[data] * power[place]), starts)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


def word_anchors(data: bytes, words: int = WORDS) -> Iterator[tuple]:
    """(k-gram hash, snippet hash, first window, last window, last window of all, first byte, byte after the last) of each anchor, by words.

    As in ``anchors``, neighbours with the same snippet are one row.
    """
    starts, ends = word_places(data)
    held = None
    for at in range(0, max(0, len(starts) - words + 1), _STRETCH_WORDS):
        begin, end = (x[at : at + _STRETCH_WORDS + words - 1] for x in (starts, ends))
        part = data[begin[0] : end[-1]]
        split = part.split()
        h = _gram_hashes(_word_hashes(np.frombuffer(part, np.uint8), begin - begin[0]), WORD_GRAM)
        owner, first, last = _owners(h, words - WORD_GRAM + 1)
        for g, lo, hi in zip(h[owner[first]].view(np.int64).tolist(), first.tolist(), last.tolist()):
            snippet = _hash(b" ".join(split[lo : hi + words]), 0)
            if held and held[:2] == (g, snippet):
                held = (*held[:4], hi + at, *held[5:])
                continue
            if held:
                yield held
            held = (g, snippet, lo + at, hi + at, hi + at, int(begin[lo]), int(end[hi + words - 1]))
    if held:
        yield held


_ANCHOR = "doc_id long, text_hash long, gram long, snippet long, lo int, hi int, sides array<long>, stop int, copies int"
#: Rows of anchors that a task holds.
_ROWS = 20_000


_WORD_ANCHOR = "doc_id long, text_hash long, row long, gram long, snippet long, lo int, hi int, stop int, first_byte int, end_byte int"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}


def _anchor_rows(size: int, of=anchors, schema: str = _ANCHOR, numbered: bool = False):
    """Rows of anchors of ``of``; ``numbered``: with a number of their own for each row of the table."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")))

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[t]) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number = [], (TaskContext.get().partitionId() << 36) - 1
        for b in batches:
            for i, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                number += 1
                key = (i, h, number) if numbered else (i, h)
                for row in of(text.as_py().encode("utf-8", "surrogatepass"), size):
                    out.append((*key, *row))
                    if len(out) >= _ROWS:
                        yield batch(out)
                        out = []
        if out:
            yield batch(out)

    return run


def _ranges(starts: np.ndarray) -> list[list[int]]:
    """Runs [first, last] of sorted numbers."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [[int(a), int(b)] for a, b in zip(starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])])]


_FOUND = "gram long, snippet long, runs array<array<int>>, shard long, span long, windows binary, places binary"
_COLS = ["gram", "snippet", "runs", "shard", "span", "windows", "places"]


def _shard(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Repeated windows of the snippets of whole groups; and the sorted windows of groups in several shards."""
    rows = rows.drop_duplicates(["gram", "snippet"])
    text = np.frombuffer(b"".join(rows["data"]), np.uint8)
    size = rows["data"].map(len).to_numpy()
    start = np.cumsum(size) - size
    valid = np.zeros(len(text) + 1, np.int64)
    np.add.at(valid, start, 1)
    np.add.at(valid, start + size - length + 1, -1)
    repeated, names = repeated_windows(text, np.cumsum(valid)[:-1] > 0, length)
    out = []
    for g, s, a, n, shards, shard, data in zip(rows["gram"], rows["snippet"], start, size, rows["shards"], rows["shard"], rows["data"]):
        here = repeated[a : a + n - length + 1]
        out.append((g, s, _ranges(np.flatnonzero(here)), -1, -1, None, None))
        if shards > 1:
            w = np.array([xxhash.xxh3_128_digest(data[i : i + length]) for i in range(n - length + 1)], "V16")
            w = w.view(">u8").reshape(-1, 2)
            # One of the windows of a class stands for it; those that repeat here already need no answer.
            single = np.unique(names[a : a + n - length + 1], return_index=True)[1]
            place = np.where(here, -1, np.arange(len(here)))[single]
            w = w[single]
            span = (w[:, 0] >> np.uint64(32)).astype(np.int64) * int(shards) >> 32
            for r in np.unique(span):
                m = span == r
                out.append((g, s, [], int(shard), int(r), w[m].tobytes(), place[m].astype("<i4").tobytes()))
    return pd.DataFrame(out, columns=_COLS)


def _shards(length: int):
    def run(frames):
        held, size = [], 0
        for f in frames:
            group = f["gram"].to_numpy() * 31 + f["shard"].to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist() if len(f) else []
            for a, b in zip(cut, [*cut[1:], len(f)]):
                part = f.iloc[a:b]
                if size >= _AT_ONCE and (part["gram"].iloc[0], part["shard"].iloc[0]) != last:
                    yield _shard(pd.concat(held), length)
                    held, size = [], 0
                held.append(part)
                size += int(part["data"].map(len).sum())
                last = (part["gram"].iloc[0], part["shard"].iloc[0])
        if held:
            yield _shard(pd.concat(held), length)

    return run


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Windows of one k-gram and range: those that other shards hold too, by binary search."""
    kind = np.dtype([("a", ">u8"), ("b", ">u8")])
    lists = {}
    for shard, part in pdf.groupby("shard"):
        w = np.concatenate([np.frombuffer(x, kind) for x in part["windows"]])
        lists[shard] = np.unique(w.astype([("a", "u8"), ("b", "u8")]))
    every = np.sort(np.concatenate(list(lists.values())))  # once for each shard that holds it
    out = []
    for g, s, windows, places in zip(pdf["gram"], pdf["snippet"], pdf["windows"], pdf["places"]):
        w = np.frombuffer(windows, kind).astype([("a", "u8"), ("b", "u8")])
        twice = np.searchsorted(every, w, "right") - np.searchsorted(every, w, "left") > 1
        p = np.frombuffer(places, "<i4")
        out.append((g, s, _ranges(np.sort(p[twice & (p >= 0)]))))
    return pd.DataFrame(out, columns=["gram", "snippet", "runs"])


_WINDOW = "gram long, snippet long, at int, a long, b long, first long, last long"


def _word_windows(words: int):
    """Hash of each window of a snippet's words, and the rows of the snippet."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for some in range(0, len(frame), 1000):
                f, out = frame.iloc[some : some + 1000], []
                for g, s, first, last, data in zip(f["gram"], f["snippet"], f["first"], f["last"], f["data"]):
                    split = data.split()
                    for at in range(len(split) - words + 1):
                        h = xxhash.xxh3_128_digest(b" ".join(split[at : at + words]))
                        out.append((g, s, at, int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), first, last))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in _WINDOW.split(", ")])

    return run


def _word_snippets(keyed: DataFrame, words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Places of the k-grams of words that several rows hold, their snippets with the first and last row, and those whose windows have to be compared."""
    every = land(keyed.mapInArrow(giving_back(_anchor_rows(words, word_anchors, _WORD_ANCHOR, numbered=True)), _WORD_ANCHOR), "passages-word-anchors")
    twice = every.groupBy("gram").agg(F.min("row").alias("first"), F.max("row").alias("last")).where("first < last").select("gram")
    places = land(every.join(twice, "gram"), "passages-word-places")
    at = F.min(F.struct("doc_id", "text_hash", F.col("first_byte").alias("lo"), (F.col("end_byte") - F.col("first_byte")).alias("size"))).alias("at")
    snippets = land(places.groupBy("gram", "snippet").agg(F.min("row").alias("first"), F.max("row").alias("last"), at), "passages-word-snippets")
    several = snippets.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("gram")
    return places, snippets, snippets.join(several, "gram").select("gram", "snippet", "first", "last", "at.*")


def _word_spans(places: DataFrame, snippets: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, span): words that windows found in several rows cover."""
    windows = land(texts.mapInPandas(giving_back(_word_windows(words)), _WINDOW), "passages-word-windows")
    shared = windows.groupBy("a", "b").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first < last").select("a", "b")
    found = windows.join(shared, ["a", "b"]).groupBy("gram", "snippet").agg(F.collect_set("at").alias("windows"))
    whole = F.col("first") < F.col("last")
    known = snippets.select("gram", "snippet", whole.alias("whole")).join(found, ["gram", "snippet"], "left").where("whole or windows is not null")
    # Neighbours that are one row start less than a window apart, so their windows at one place cover all between.
    return places.join(known, ["gram", "snippet"]).select(
        "doc_id",
        "text_hash",
        F.explode(
            F.expr(
                f"if(whole, array(struct(lo as s, stop + {words} as e, true as words)),"
                f" transform(windows, w -> struct(lo + w as s, stop - (hi - lo) + w + {words} as e, true as words)))"
            )
        ).alias("span"),
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH, piece: int = PIECE, words: int | None = None) -> DataFrame:
    """(doc_id, text_hash, spans): ranges [s, e) of a text that repeated windows cover, in bytes or in words. ``docs``: doc_id, text."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of(docs)).alias("text_hash"), text_of(docs).alias("text"))
    every = land(keyed.mapInArrow(giving_back(_anchor_rows(length)), _ANCHOR), "passages-anchors")
    twice = every.groupBy("gram").agg(F.sum("copies").alias("n")).where("n > 1").select("gram")
    places = land(every.join(twice, "gram"), "passages-places")

    snippets = places.groupBy("gram", "snippet").agg(F.sum("copies").alias("n"), F.min(F.struct("doc_id", "text_hash", "lo", "hi", "sides")).alias("at"))
    snippets = land(snippets, "passages-snippets")
    several = snippets.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("gram")
    sides = snippets.join(several, "gram").select("gram", "snippet", F.explode("at.sides").alias("side"))
    shared = sides.groupBy("side").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("side")
    alike = land(sides.join(shared, "side").select("gram", "snippet").distinct(), "passages-alike")
    kinds = alike.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"))
    wanted = snippets.join(alike, ["gram", "snippet"]).join(kinds, "gram").select(
        "gram", "snippet", F.ceil(F.col("kinds") / piece).cast("long").alias("shards"), "at.doc_id", "at.text_hash", "at.lo", (F.col("at.hi") - F.col("at.lo") + length).alias("size")
    )
    rows = []
    if words:
        word_places, word_snippets, word_wanted = _word_snippets(keyed, words)
        wanted, rows = wanted.unionByName(word_wanted, allowMissingColumns=True), ["first", "last"]
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    data = (
        keyed.alias("d")
        .join(wanted.alias("w").hint("merge"), same)  # grows with the documents: never a broadcast
        .select("gram", "snippet", "shards", *rows, F.pmod("snippet", "shards").alias("shard"), F.expr("substring(cast(d.text as binary), lo + 1, size)").alias("data"))
    )
    if words:
        data = land(data, "passages-data")  # texts are shuffled once for both
        word_data, data = data.where("shards is null"), data.where("shards is not null").drop(*rows)
    found = land(
        data.repartition("gram", "shard").sortWithinPartitions("gram", "shard", "snippet").mapInPandas(giving_back(_shards(length)), _FOUND),
        "passages-found",
    )
    merged = found.where("shard >= 0").groupBy("gram", "span").applyInPandas(_merge, "gram long, snippet long, runs array<array<int>>")
    runs = (
        found.where("shard < 0").select("gram", "snippet", "runs").unionByName(merged)
        .select("gram", "snippet", F.explode("runs").alias("run"))
        .groupBy("gram", "snippet").agg(F.collect_set("run").alias("runs"))
    )
    known = snippets.select("gram", "snippet", "n").join(runs, ["gram", "snippet"], "left").where("n > 1 or runs is not null")
    spans = places.join(known, ["gram", "snippet"]).select(
        "doc_id",
        "text_hash",
        F.explode(
            F.expr(
                f"if(n > 1, array(struct(lo as s, stop + {length} as e, false as words)),"
                f" transform(runs, r -> struct(lo + r[0] as s, lo + r[1] + {length} as e, false as words)))"
            )
        ).alias("span"),
    )
    if words:
        spans = spans.unionByName(_word_spans(word_places, word_snippets, word_data, words))
    return spans.groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("spans"))


def union_of(spans) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans cover."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _bytes_of(spans, data: bytes) -> list[tuple[int, int]]:
    """Maximal runs of bytes of spans in bytes and in words."""
    by_words = union_of((x["s"], x["e"]) for x in spans if x["words"])
    found = [(x["s"], x["e"]) for x in spans if not x["words"]]
    if by_words:
        starts, ends = word_places(data)
        found += [(int(starts[s]), int(ends[e - 1])) for s, e in by_words]
    return union_of(found)


def cut(text: Column, spans: Column, whole_chars: bool = False) -> Column:
    """Struct of what is left of a text (bytes), and the number of bytes and runs removed.

    With ``whole_chars`` the left-over bytes of a character that was cut go too.
    """

    def of(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        kept, removed, n = [], [], []
        for t, s in zip(texts, spans):
            if t is None:
                kept.append(None)
                removed.append(0)
                n.append(0)
                continue
            data = t.encode("utf-8", "surrogatepass")
            runs = _bytes_of(s, data) if s is not None and len(s) else []
            gone = sum(e - a for a, e in runs)
            if runs:
                edges = [0, *(x for r in runs for x in r), len(data)]
                data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                if whole_chars:
                    data = data.decode("utf-8", "ignore").encode()
            kept.append(data)
            removed.append(gone)
            n.append(len(runs))
        return pd.DataFrame({"kept": kept, "n_removed": removed, "n_spans": n})

    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def some(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from giving_back(lambda pairs: (of(t, s) for t, s in pairs))(batches)

    return some(text, spans)


def without_repeats(docs: DataFrame, length: int = LENGTH, piece: int = PIECE, name: str = "_cut", whole_chars: bool = False, words: int | None = None) -> DataFrame:
    """``docs`` with a struct column ``name``: kept (bytes), n_removed, n_spans. ``words``: passages of so many words that another row holds go too."""
    spans, doc_id, text_hash = (fresh(docs, x) for x in ("_spans", "_span_id", "_span_hash"))
    found = repeated_spans(docs.select("doc_id", "text"), length, piece, words).select(
        F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash), F.col("spans").alias(spans)
    )
    same = docs["doc_id"].eqNullSafe(F.col(doc_id)) & (F.xxhash64(text_of(docs)) == F.col(text_hash))
    joined = docs.join(found, same, "left")
    # Only texts with something to cut go to Python.
    whole = F.coalesce(docs["text"], F.lit(""))
    done = cut(F.when(F.col(spans).isNotNull(), whole), F.col(spans), whole_chars)
    made = joined.withColumn(name, done)
    told = F.struct(F.coalesce(F.col(f"{name}.kept"), whole.cast("binary")).alias("kept"), F.col(f"{name}.n_removed").alias("n_removed"), F.col(f"{name}.n_spans").alias("n_spans"))
    return made.select(*[docs[c] for c in docs.columns], told.alias(name))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("_cut.n_removed").alias("n_removed"),
        F.col("_cut.n_spans").alias("n_spans"),
        F.sha2(F.col("_cut.kept"), 256).alias("kept_sha256"),
    )


def cut_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Documents with the repeated passages cut out of their texts; columns unchanged.

    A passage goes if it has ``LENGTH`` bytes and starts anywhere else too, or
    if it has ``words`` words and another row holds it.
    A cut may fall inside a character; its left-over bytes go with it.
    """
    name = fresh(docs, "_cut")
    cut_ = without_repeats(docs, name=name, whole_chars=True, words=words)
    changed = F.col(f"{name}.n_removed") > 0
    text = F.when(changed, F.col(f"{name}.kept").cast("string")).otherwise(F.col("text"))
    out = cut_.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
