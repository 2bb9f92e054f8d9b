"""Small tables for the operators: sf0.001, hand-made edge cases, and empty tables, read back as plain rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

WORDS = "the quick brown fox jumps over a lazy dog while seven grey wolves sleep under old oak trees near rivers of cold clear water".split()
PASSAGE = " ".join(WORDS[(i * i + 3 * i) % len(WORDS)] + str(i % 7) for i in range(90))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, text_hash string, fp string, key int, score string, component string, label string, size string, shard string, part string"


def edge_rows() -> list[tuple]:
    texts = [
        None,
        "",
        "   \n\t ",
        "short",
        "Don't stop: it's 3 o'clock's ‘quoted’ — naïve café  \n\n  done's",
        "ÀÉ \U0001f600 中文字 ١٢٣ \x85 x",
        " ".join(WORDS),
        " ".join(WORDS),
        " ".join(WORDS[:-1] + ["wine"]),
        "intro one " + PASSAGE + " end one",
        "another start of it " + PASSAGE + " and another end",
        "z" * 3000,
        "word " * 1200,
        " ".join(f"w{i % 977}x{i * 31 % 389}" for i in range(30_000)),
        "'''s 'll'll ''ve",
    ]
    rows = [(i, t, ["en", "de", None][i % 3], ["src0", "src1", None, "x"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, "no id here at all", "en", "src0", 17), (None, None, None, None, None), (-5, "negative id, few words", "fr", "src2", 22)]
    return [(*r, 7, "h", "f", 1, "s", "c", "l", "z", "s", "p") for r in rows]


@pytest.fixture(scope="session")
def small() -> str:
    return SF_SMALL


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory) -> str:
    """documents with nulls, empty, long and repeated rows and clashing extra columns."""
    d = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame(edge_rows(), DOCS).repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(1, 1, 0), (4, 1, None), (None, 1, 1), (6, 0, 1), (6, 0, 0), (99, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    v = [1.0, 0.5, 0.25, 0.0]
    vectors = [
        (0, v, "a"), (1, v, "a"), (1, v, "a"), (2, [1.0, 0.5, 0.26, 0.0], "a"), (3, v, "b"), (4, v, None), (5, None, "a"), (6, [0.0] * 4, "a"),
        (7, [1.0, None, 0.0, 0.0], "a"), (8, [float("nan"), 1.0, 0.0, 0.0], "a"), (9, [float("inf"), 1.0, 0.0, 0.0], "a"), (10, [], "a"), (11, [1.0, 0.5], "a"), (None, v, "a"),
    ]
    rows = [(*r, 1, 2, "x") for r in vectors]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, id long, w long, body string").write.parquet(f"{d}/embeddings.parquet")
    html = "<p>one page of some length</p>" * 40
    pages = [
        (0, "http://a.example/", html), (5, "http://b.example/x y\tz", html), (5, "http://b.example/", html), (5, "http://b.example/", html),
        (None, "http://c.example/", html), (None, None, "lonely"), (7, None, None), (8, "http://d.example/é", ""), (9, "u", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response"),
        (10, "v", "x" * 3_000_000), (11, "w\r\nWARC-Type: evil", "<p>"), (11, "w", "<q>"), (-3, "n", "<p>"),
    ]
    spark.createDataFrame([(*r, "k", "p", "resp", 1) for r in pages], "page_id long, url string, html string, key string, payload string, record_type string, n int").repartition(3).write.parquet(f"{d}/pages.parquet")
    items = [(0, "Short naïve CAFÉ word"), (1, " ".join(WORDS)), (1, "w5x5 word"), (1, "w5x5 word"), (2, None), (3, " \n"), (None, "id few"), (4, "unknownterm")]
    spark.createDataFrame([(*r, "t", 3, 2.0) for r in items], "item_id long, text string, term string, doc_id int, score double").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory, edge) -> str:
    d = str(tmp_path_factory.mktemp("none"))
    for t in ("documents", "labels", "embeddings", "pages", "benchmark"):
        spark.read.parquet(f"{edge}/{t}.parquet").where(F.lit(False)).write.parquet(f"{d}/{t}.parquet")
    return d


def rows_of(spark, sf_dir: str, name: str) -> list:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()


def texts_of(spark, sf_dir: str) -> list[tuple]:
    """(doc_id, text) with null texts as empty ones."""
    return [(r["doc_id"], r["text"] or "") for r in rows_of(spark, sf_dir, "documents")]


def bag(rows) -> list:
    """Rows as a sorted list, nulls first."""
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))
