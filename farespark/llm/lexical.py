"""Ranked lexical search over a K2-treap of the term-document grid.

The documents of a task are cut into shards of a bounded number of cells. A
shard is a grid: its terms, sorted, are the rows and its documents, by
ascending id, the columns; a cell holds the impact of the term in the
document, ``(1000000000*tf) div (1000*tf+20*m)``. The grid is stored as a
quadtree in level order: four bits a node tell which quadrants hold a cell,
and every node has the largest impact below it, kept as the difference to its
parent's. The child of node x in quadrant q is number 1 + rank(4x + q).

An item's rows descend together: a state is a range of documents with one node
for each row, bounded by the sum of weight times largest impact. States of
the highest bound are opened first, some at a time, into the two halves of
their documents; at a single document the bound is the score. A state whose
bound is below the score of the item's last hit so far, or equal to it with no
smaller id, is dropped, so the answer is exact, ties by id included. Hits of
earlier shards of a task bound the later ones.

Texts are not shuffled: each task indexes what it reads, the shards are
landed, and items are answered block by block against all shards. A shard is
a file of its own, of ``PIECES`` rows that hold a slice of each of its columns:
the JVM has no array of megabytes, which its collector frees late. A block
holds about ``BLOCK_TERMS`` terms of items, whatever the number of items.
What leaves a task are at most ``top`` rows an item.

Defined results: null and empty texts have no term and count nowhere. A
document whose id is null is ranked after others of the same score. Repeated
rows are documents of their own. Items with the same id (null is one id) are
one item with the terms of all; an item without known terms has no row. Empty
tables give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farespark.llm.common import batches_of, giving_back, table
from farespark.session import scratch_path

#: Cells of a shard (a document's cells stay together, so the last one may go beyond), and terms of a block of items.
SHARD_CELLS, BLOCK_TERMS = 1 << 18, 200_000
#: Texts handed to Python at a time; rows of a shard, and how many of them are read at a time.
BATCH_TEXTS, PIECES, BATCH_PIECES = 1000, 32, 4
#: States opened at a time, or an eighth of them if that is more.
OPENED = 64
# Letters of a term: ASCII letters (lower-cased) and digits, and every byte of other code points.
_LETTERS = bytes(c if chr(c).isdigit() or chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in range(256)).lower()
_ONES = np.array([bin(i).count("1") for i in range(16)], np.uint8)
_INDEX = "ids binary, nulls binary, terms binary, dfs binary, height int, bits binary, top int, drops binary"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in turn, repeats included."""
    return text.encode().translate(_LETTERS).split() if text else []


# -- the tree ------------------------------------------------------------------------------------------------------


def spread(x: np.ndarray) -> np.ndarray:
    """Bits of x (under 2^31) moved to the even places."""
    x = x.astype(np.uint64)
    for s, m in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(s))) & np.uint64(m)
    return x


def _narrow(x: np.ndarray) -> bytes:
    """Width in one byte, then the values in as few bytes as the largest needs."""
    kind = next(k for k in ("<u1", "<u2", "<u4") if not len(x) or int(x.max()) <= np.iinfo(k).max)
    return kind[2:].encode() + np.array([len(x)], "<i8").tobytes() + x.astype(kind).tobytes()


def build(row: np.ndarray, col: np.ndarray, impact: np.ndarray) -> tuple[int, bytes, int, bytes]:
    """(height, bits, largest impact, drops) of the grid with the given cells; each cell once."""
    height = max(1, int(row.max()).bit_length(), int(col.max()).bit_length())
    code = (spread(row) << np.uint64(1)) | spread(col)
    by = np.argsort(code)
    code, value = code[by], impact[by]
    bits, drops = [], []
    for _ in range(height):
        parent = code >> np.uint64(2)
        first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        above = np.maximum.reduceat(value, first)
        sizes = np.diff(np.append(first, len(parent)))
        drops.append(_narrow(np.repeat(above, sizes) - value))
        bits.append(np.bitwise_or.reduceat(np.left_shift(1, (code & np.uint64(3)).astype(np.int64)), first).astype(np.uint8))
        code, value = parent[first], above
    return height, np.concatenate(bits[::-1]).tobytes(), int(value[0]), b"".join(drops[::-1])


class Tree:
    """A built grid, ready for descents. Node ``none`` stands for an empty quadrant."""

    def __init__(self, height: int, bits: bytes, top: int, drops: bytes):
        self.height = height
        inner = np.frombuffer(bits, np.uint8)
        ones = _ONES[inner]
        self.none = 1 + int(ones.sum(dtype=np.int64))
        self.bits = np.zeros(self.none + 1, np.uint8)
        self.bits[: len(inner)] = inner
        self.before = np.ones(self.none + 1, np.int32)  # the first child's number
        self.before[1 : len(inner)] += np.cumsum(ones, dtype=np.int32)[:-1]
        self.value = np.zeros(self.none + 1, np.int32)
        self.value[0] = top
        node, place, nodes = 0, 0, 1
        for _ in range(height):
            width, n = int(drops[place : place + 1]), int(np.frombuffer(drops, "<i8", 1, place + 1)[0])
            got = np.frombuffer(drops, f"<u{width}", n, place + 9).astype(np.int32)
            place += 9 + n * width
            at = node + nodes
            self.value[at : at + n] = np.repeat(self.value[node : node + nodes], ones[node : node + nodes]) - got
            node, nodes = at, n

    def child(self, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        have = self.bits[node]
        at = self.before[node] + _ONES[have & ((1 << quadrant) - 1)]
        return np.where((have >> quadrant) & 1, at, self.none)

    def rows_at(self, rows: np.ndarray, level: int) -> np.ndarray:
        """Nodes of the rows at a level, in the column of document 0."""
        node = np.zeros(len(rows), np.int64)
        for lv in range(level):
            node = self.child(node, 2 * ((rows >> (self.height - 1 - lv)) & 1))
        return node


def best(tree: Tree, level: int, rows: np.ndarray, nodes: np.ndarray, weights: np.ndarray, ids: np.ndarray, top: int, floor: tuple[int, int] | None) -> list[tuple[int, int]]:
    """The documents (score, column) that can be among the ``top`` of an item; ``floor`` is (score, id) of its last hit so far.

    ``rows`` are the item's rows with their ``nodes`` at ``level``, the lowest that spans all documents.
    """
    height, n = tree.height, len(ids)
    hits_s, hits_c = np.zeros(0, np.int64), np.zeros(0, np.int64)
    state, lv, col = nodes[None, :], np.array([level]), np.array([0])
    bound = tree.value[state].astype(np.int64) @ weights
    if level == height:
        hits_s, hits_c, bound = bound, col, bound[:0]
    while len(bound):
        k = max(OPENED, len(bound) // 8)
        if len(bound) > k:
            pick = np.argpartition(-bound, k)
            now, later = pick[:k], pick[k:]
        else:
            now, later = np.arange(len(bound)), np.zeros(0, np.int64)
        down = height - 1 - lv[now]
        quadrant = 2 * ((rows[None, :] >> down[:, None]) & 1)
        below = np.concatenate([tree.child(state[now], quadrant), tree.child(state[now], quadrant + 1)])
        lv2 = np.tile(lv[now] + 1, 2)
        col2 = np.concatenate([2 * col[now], 2 * col[now] + 1])
        b2 = tree.value[below].astype(np.int64) @ weights
        leaf = (lv2 == height) & (b2 > 0)
        if leaf.any():
            hits_s, hits_c = np.concatenate([hits_s, b2[leaf]]), np.concatenate([hits_c, col2[leaf]])
            if len(hits_s) > top:
                keep = np.lexsort((hits_c, -hits_s))[:top]
                hits_s, hits_c = hits_s[keep], hits_c[keep]
            if len(hits_s) == top:
                last = np.lexsort((hits_c, -hits_s))[-1]
                mine = (int(hits_s[last]), int(ids[hits_c[last]]))
                floor = mine if floor is None or (mine[0], -mine[1]) > (floor[0], -floor[1]) else floor
        inner = (lv2 < height) & (b2 > 0)
        state = np.concatenate([state[later], below[inner]])
        lv, col, bound = np.concatenate([lv[later], lv2[inner]]), np.concatenate([col[later], col2[inner]]), np.concatenate([bound[later], b2[inner]])
        if floor is not None:
            first = ids[np.minimum(col << (height - lv), n - 1)]
            stay = (bound > floor[0]) | ((bound == floor[0]) & (first < floor[1]))
            if not stay.all():
                state, lv, col, bound = state[stay], lv[stay], col[stay], bound[stay]
    return list(zip(hits_s.tolist(), hits_c.tolist()))


# -- indexing ------------------------------------------------------------------------------------------------------


def _shard(docs: list[tuple], known: dict[bytes, int], n_all: int, l_all: int) -> dict:
    """A shard of the index from (id, is null, terms' numbers, counts, n) of each document and the numbers of the terms."""
    docs.sort(key=lambda d: (d[1], d[0]))
    names = sorted(known)
    rank = np.empty(len(names), np.int64)
    rank[[known[t] for t in names]] = np.arange(len(names))
    sizes = [len(d[2]) for d in docs]
    row = rank[np.concatenate([d[2] for d in docs])]
    tf = np.concatenate([d[3] for d in docs])
    m = np.repeat(np.array([100 - 50 + (50 * d[4] * n_all) // l_all for d in docs], np.int64), sizes)
    col = np.repeat(np.arange(len(docs)), sizes)
    height, bits, top, drops = build(row, col, (1_000_000_000 * tf) // (1000 * tf + 20 * m))
    return {
        "ids": np.array([d[0] for d in docs], "<i8").tobytes(), "nulls": np.array([d[1] for d in docs], "u1").tobytes(),
        "terms": b"\n".join(names), "dfs": np.bincount(row, minlength=len(names)).astype("<i4").tobytes(),
        "height": height, "bits": bits, "top": top, "drops": drops,
    }


_INDEX_ARROW = pa.schema([(n, pa.int32() if kind == "int" else pa.binary()) for n, kind in (c.split() for c in _INDEX.split(", "))])


def _slice(value, k: int):
    """The k-th of the ``PIECES`` slices of a shard's bytes; its numbers are in each row."""
    return value[len(value) * k // PIECES : len(value) * (k + 1) // PIECES] if isinstance(value, bytes) else value


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The shards of a task's rows, one after another; the columns that were read."""
    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            held.append(row)
            if len(held) == PIECES:
                shard = {n: b"".join(r[n] for r in held) if isinstance(v, bytes) else v for n, v in row.items()}
                held = []
                yield shard


def _indexing(n_all: int, l_all: int, cells: int):
    def rows(docs, known):
        shard = _shard(docs, known, n_all, l_all)
        for k in range(PIECES):
            yield pa.RecordBatch.from_pylist([{n: _slice(v, k) for n, v in shard.items()}], schema=_INDEX_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, known, size = [], defaultdict(itertools.count().__next__), 0
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                counts = Counter(words)
                number = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
                docs.append(((1 << 63) - 1 if i is None else i, i is None, number, np.fromiter(counts.values(), np.int64, len(counts)), len(words)))
                size += len(counts)
                if size >= cells:
                    yield from rows(docs, known)
                    docs, known, size = [], defaultdict(itertools.count().__next__), 0
        if docs:
            yield from rows(docs, known)

    return giving_back(run)


@giving_back
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = total = 0
    for b in batches:
        for text in b.column(0):
            size = len(terms_of(text.as_py()))
            n += size > 0
            total += size
    yield pa.RecordBatch.from_pydict({"n": [n], "total": [total]}, schema=pa.schema([("n", pa.int64()), ("total", pa.int64())]))


class Index:
    """An index of documents (doc_id, text) in the folder ``path``; ``n`` documents with terms."""

    def __init__(self, spark: SparkSession, path: str, n: int):
        self.spark, self.path, self.n = spark, path, n

    @classmethod
    def write(cls, docs: DataFrame, path: str, cells: int = SHARD_CELLS) -> Index:
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        counted = rows.select("text").mapInArrow(_counted, "n long, total long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0)))
        with batches_of(docs.sparkSession, BATCH_TEXTS):
            n, total = counted.first()
        # A shard is a file and, as the size of a row group is not reached, a row group of its own: one task reads it whole.
        shards = rows.mapInArrow(_indexing(n, total, cells), _INDEX)
        sizes = {"maxRecordsPerFile": PIECES, "parquet.block.size": 1 << 30, "parquet.enable.dictionary": "false", "parquet.page.size": 1 << 18, "parquet.page.size.row.check.min": 1}
        with batches_of(docs.sparkSession, BATCH_TEXTS):
            shards.write.options(**sizes).parquet(path)
        return cls(docs.sparkSession, path, n)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(_INDEX).parquet(self.path)

    def weights(self, names: list[str]) -> dict[str, int]:
        """w of each of the sorted terms that a document holds; ``names`` are those of one block of items.

        The terms are looked up where the shards are, so the terms of all documents are neither shuffled nor unpacked by Spark.
        """
        df = self.rows().select("terms", "dfs").mapInArrow(_frequencies(names), "number int, df long").groupBy("number").agg(F.sum("df").alias("df"))
        w = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * self.n + 2)) / (2 * F.col("df") + 1).cast("double")))
        with batches_of(self.spark, BATCH_PIECES, BATCH_PIECES):
            return {names[r["number"]]: r["w"] for r in df.select("number", w.cast("long").alias("w")).collect()}

    def search(self, items: DataFrame, top: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
        """item_id, rank, doc_id, score of each item's ``top`` documents."""
        kind = items.schema["item_id"].dataType.simpleString()
        found, known = scratch_path(self.spark, "lexical-hits"), scratch_path(self.spark, "lexical-items")
        of_items = items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(_item_terms(kind), f"item_id {kind}, term string")
        of_items.groupBy("item_id").agg(F.collect_set("term").alias("terms")).write.parquet(known)
        known = self.spark.read.parquet(known)
        blocks = max(1, -(-(known.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
        known = known.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
        for b in range(blocks):
            # One block of the stated query set, not rows of the corpus.
            stated = [(r["item_id"], r["terms"]) for r in known.where(F.col("block") == b).collect()]
            w = self.weights(sorted({t for _, terms in stated for t in terms}))
            block = [(i, held, [w[t] for t in held]) for i, held in ((i, [t for t in terms if t in w]) for i, terms in stated)]
            hits = self.rows().drop("dfs").mapInArrow(_searching(block, top), "number int, doc_id long, score long")
            named = self.spark.createDataFrame([(i, r[0]) for i, r in enumerate(block)], f"number int, item_id {kind}")
            ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= top)
            with batches_of(self.spark, BATCH_PIECES, BATCH_PIECES):
                ranked.join(named, "number").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(found)
        return self.spark.read.schema(f"item_id {kind}, rank int, doc_id long, score long").parquet(found)


def _item_terms(kind: str):
    def run(batches):
        for b in batches:
            terms = [[t.decode() for t in dict.fromkeys(terms_of(x.as_py()))] for x in b.column(1)]
            at = np.repeat(np.arange(b.num_rows), [len(t) for t in terms])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array([t for ts in terms for t in ts], pa.string())], names=["item_id", "term"])

    return run


def _frequencies(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), np.int64)
        for shard in _shards(batches):
            found = _places(shard["terms"], names)
            total[found >= 0] += np.frombuffer(shard["dfs"], "<i4")[found[found >= 0]]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["number", "df"])

    return giving_back(run)


def _places(terms: bytes, names: list[str]) -> np.ndarray:
    """The row of each name among a shard's ``terms``, -1 if it is none of them."""
    place = dict(zip(terms.decode().split("\n"), itertools.count()))
    return np.array([place.get(t, -1) for t in names], np.int64)


def _searching(block: list[tuple], top: int):
    names = sorted({t for _, terms, _ in block for t in terms})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(names)}
        items = [(np.array([number[t] for t in terms], np.int64), np.array(w, np.int64)) for _, terms, w in block]
        hits: list[list[tuple[int, int, bool]]] = [[] for _ in block]  # (-score, id, is null), sorted
        for row in _shards(batches):
            found = _places(row["terms"], names)
            tree = Tree(row["height"], row["bits"], row["top"], row["drops"])
            ids, nulls = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["nulls"], "u1")
            level = tree.height - (len(ids) - 1).bit_length()
            nodes = np.where(found >= 0, tree.rows_at(np.maximum(found, 0), level), tree.none)
            for k, (mine, w) in enumerate(items):
                mine, w = mine[found[mine] >= 0], w[found[mine] >= 0]
                if not len(mine):
                    continue
                floor = (-hits[k][-1][0], hits[k][-1][1]) if len(hits[k]) == top else None
                got = best(tree, level, found[mine], nodes[mine], w, ids, top, floor)
                if got:
                    hits[k] = sorted([*hits[k], *((-s, int(ids[c]), bool(nulls[c])) for s, c in got if s > 0)])[:top]
        out = [(k, None if null else i, -s) for k, rows in enumerate(hits) for s, i, null in rows]
        cols = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64()))], names=["number", "doc_id", "score"])

    return giving_back(run)


def op12_k2_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = Index.write(table(spark, sf_dir, "documents"), scratch_path(spark, "lexical-index"))
    return index.search(table(spark, sf_dir, "benchmark").select("item_id", "text"), top=50)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
with d as (
  select row_number() over () as r, doc_id, {_TERMS} as t from documents
), nn as (
  select r, doc_id, len(t) as n from d where len(t) > 0
), g as (
  select count(*)::bigint as docs, sum(n)::bigint as total from nn
), p as (
  select r, u.term, count(*)::bigint as tf from (select r, unnest(t) as term from d) u group by all
), w as (
  select term, floor(1000 * ln((2 * (select docs from g) + 2)::double / (2 * count(*) + 1)))::bigint as w from p group by term
), i as (
  select distinct item_id, term from (select item_id, unnest({_TERMS}) as term from benchmark) q
), s as (
  select i.item_id, nn.r, nn.doc_id,
    sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (100 - 50 + (50 * nn.n * g.docs) // g.total))))::bigint as score
  from i join w using (term) join p using (term) join nn using (r) cross join g
  group by all
)
select item_id, rank, doc_id, score from (
  select item_id, doc_id, score,
    row_number() over (partition by item_id order by score desc, doc_id asc nulls last)::int as rank
  from s where score > 0
) where rank <= 50
"""
