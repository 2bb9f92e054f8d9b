"""Partitioned Parquet tables that change by whole versions.

A table is a folder with

* ``_data/_commit=<number>-<id>/<column>=<value>/*.parquet``: the rows of one
  commit. Files are never changed or moved once they are written.
* ``_versions/<number>.json``: a version. It names, for every partition, the
  commits that hold its rows, and the columns of the table.

A change writes each partition it touches once, in a folder of its own, and
then publishes a version that points to it. Publishing is one rename that
fails if the number is taken: readers see the version before or the one
after, never a part, and of two writers that started from the same version
one gets :class:`Conflict`. A run that dies leaves files that no version
names; they are never read, and ``vacuum`` removes them.

A plain folder written by :mod:`farespark.operators.materialize` reads as
version 0 and is taken over by the first commit without being rewritten.

The driver holds one version: its size grows with the number of partitions
(days) and of appends to them, not with the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farespark.operators import materialize as M
from farespark.operators.ingest import delete_insert_rows, upsert_rows

# hidden from a plain read of the folder, which would mix versions
DATA = "_data"
COMMIT = "_commit"
VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another writer has published the version that this one was to become."""


@dataclass(frozen=True)
class Version:
    """``partitions``: folder name of a partition -> commits with its rows ('' for rows of a plain folder)."""

    number: int
    schema: T.StructType
    partitions: dict[str, list[str]] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; empty if there is none."""
    fs, root = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    return [int(n[:-5]) for n in _names(spark, f"{path}/{VERSIONS}") if n.endswith(".json") and n[:-5].isdigit()]


def exists(spark: SparkSession, path: str) -> bool:
    return bool(numbers(spark, path))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A published version, the newest by default; a plain folder is version 0; None without a table."""
    if number is None:
        known = numbers(spark, path)
        number = known[-1] if known else 0
    if number == 0:
        return _plain(spark, path)
    fs, file = _fs(spark, f"{path}/{VERSIONS}/{number:08d}.json")
    stream = fs.open(file)
    try:
        told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, T.StructType.fromJson(told["schema"]), told["partitions"])


def _plain_parts(spark: SparkSession, path: str) -> list[str]:
    return [n for n in _names(spark, path) if "=" in n and not n.startswith(".")]


def _plain(spark: SparkSession, path: str) -> Version | None:
    days = _plain_parts(spark, path)
    stored = M.read_table(spark, path) if days else None
    return None if stored is None else Version(0, stored.schema, {n: [""] for n in days})


def read(
    spark: SparkSession, path: str, parts: Iterable[str] | None = None, number: int | None = None, of: Version | None = None
) -> DataFrame | None:
    """A version's rows, or those of some partitions (names as ``column=value``).

    None if there is nothing to read. Only folders that the version names are listed. Columns that older
    files lack come back null. A filter on the partition column prunes folders as in any Parquet table.
    """
    v = of or version(spark, path, number)
    if v is None:
        return None
    wanted = v.partitions if parts is None else {p: v.partitions[p] for p in parts if p in v.partitions}
    found = {
        path: [f"{path}/{p}" for p, commits in wanted.items() if "" in commits],
        f"{path}/{DATA}": [f"{path}/{DATA}/{c}/{p}" for p, commits in wanted.items() for c in commits if c],
    }
    out = None
    for base, folders in found.items():
        if folders:
            some = spark.read.schema(v.schema).option("basePath", base).parquet(*folders).select(*v.schema.names)
            out = some if out is None else out.unionByName(some)
    return out


def read_synced(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A table of either form through the columns of ``schema``."""
    v = version(spark, path) if exists(spark, path) else None
    if v is None:
        return M.read_synced(spark, path, schema)
    df = read(spark, path, of=v)
    return None if df is None else df.select(*[f.name if f.name in v.schema.names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def max_value(spark: SparkSession, path: str, column: str, partition_col: str):
    """``max(column)``, None if there are no rows (D10). The last partition is found in the version, so no job looks for
    it, and it alone is scanned. Needs values of the partition column that sort as text, as dates do, and ``column`` to grow with them."""
    v = version(spark, path)
    days = [] if v is None else sorted((p for p in v.partitions if not p.endswith("=__HIVE_DEFAULT_PARTITION__")), reverse=True)
    if not days:
        return None
    return read(spark, path, [days[0]], of=v).agg(F.max(column)).first()[0]


def commit(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    partition_col: str,
    base: Version | None,
    replaced: Iterable[str] = (),
    order: tuple[str, ...] = (),
    seen: Observation | None = None,
    placed: bool = False,
) -> int:
    """Writes ``rows`` and publishes ``base`` with them; returns the version's number.

    Partitions in ``replaced`` keep nothing of what they held; to others the
    rows are added. Stored columns keep their types, new ones join the table.
    Nothing is published if nothing changes.
    """
    number = 1 if base is None else base.number + 1
    if base is not None:
        rows = M.conform(rows, spark.createDataFrame([], base.schema))
    name = f"{COMMIT}={number:08d}-{uuid.uuid4().hex[:12]}"
    M.write(rows, f"{path}/{DATA}/{name}", "errorifexists", partition_col, placed, order=order, seen=seen)
    written = [n for n in _names(spark, f"{path}/{DATA}/{name}") if n.startswith(f"{partition_col}=")]
    gone = set(replaced)
    before = {} if base is None else base.partitions
    parts = {p: list(c) for p, c in before.items() if p not in gone}
    for p in written:
        parts.setdefault(p, []).append(name)
    if parts == before:
        return number - 1
    fields = [] if base is None else list(base.schema.fields)
    fields += [f for f in rows.schema.fields if f.name not in {g.name for g in fields}]
    # NOT NULL holds for no older file of a new column
    schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields])
    _publish(spark, path, Version(number, schema, parts))
    return number


def _publish(spark: SparkSession, path: str, v: Version) -> None:
    text = json.dumps({"version": v.number, "schema": v.schema.jsonValue(), "partitions": v.partitions})
    draft, final = f"{path}/{VERSIONS}/.{uuid.uuid4().hex}.draft", f"{path}/{VERSIONS}/{v.number:08d}.json"
    fs, file = _fs(spark, draft)
    stream = fs.create(file, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        _rename_new(spark, draft, final)
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" not in str(exc.java_exception):
            raise
        fs.delete(file, False)
        raise Conflict(f"version {v.number} of {path} is published already; run the change again") from exc


def _rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file; an error if ``target`` is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, file = _fs(spark, source)
    final = fs.makeQualified(hadoop.Path(target))
    files = hadoop.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(file), final, spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))


def _to_change(spark: SparkSession, path: str, partition_col: str) -> Version | None:
    if not exists(spark, path):
        M.finish_swap(spark, path, partition_col)  # what a plain folder's interrupted change left
    return version(spark, path)


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def wider(stored: T.DataType, new: T.DataType) -> T.DataType:
    """``new`` if it holds every value of ``stored`` and files of ``stored`` can be read as it, else ``stored``."""
    if stored in _WHOLE and new in _WHOLE:
        return max(stored, new, key=_WHOLE.index)
    if isinstance(stored, T.FloatType) and isinstance(new, T.DoubleType):
        return new
    if isinstance(stored, T.DecimalType) and isinstance(new, T.DecimalType):
        fits = new.scale >= stored.scale and new.precision - new.scale >= stored.precision - stored.scale
        return new if fits else stored
    return stored


def widened(base: Version, rows: DataFrame) -> Version:
    """``base`` as it is read and written once its columns are as wide as those of ``rows``.

    No file is rewritten for it: older ones are read as the wider type, and the version that is published next has the
    new types. The versions are the log of the table's types.
    """
    types = {f.name: f.dataType for f in rows.schema.fields}
    fields = [T.StructField(f.name, wider(f.dataType, types.get(f.name, f.dataType)), True, f.metadata) for f in base.schema.fields]
    return replace(base, schema=T.StructType(fields))


def append(spark: SparkSession, rows: DataFrame, path: str, partition_col: str, order: tuple[str, ...] = (), widen: bool = False, placed: bool = False) -> int:
    """Adds rows (A9): all of them or, if the run dies, none. ``widen`` lets wider columns widen the table's; ``placed`` as in materialize.append."""
    base = _to_change(spark, path, partition_col)
    return commit(spark, rows, path, partition_col, widened(base, rows) if widen and base else base, order=order, placed=placed)


def upsert(
    spark: SparkSession, batch: DataFrame, path: str, key: str, update_cols: list[str], partition_col: str, only_newer: str | None = None, widen: bool = False
) -> int:
    """Keyed upsert (A4) with the rules of ``materialize.upsert_partitioned``. Returns the rows of the batch.

    The batch is staged once, as it is read twice (its partitions, the merge).
    Each touched partition is written once.
    """
    seen = Observation()
    base = _to_change(spark, path, partition_col)
    if base is None:
        commit(spark, batch, path, partition_col, None, seen=seen)
        return M.rows_seen(seen)
    if widen:
        base = widened(base, batch)
    batch = M.conform(batch, spark.createDataFrame([], base.schema))
    staged = M.stage_rows(spark, batch, partition_col, "upsert-batch", seen).select(*batch.columns)
    touched = [f"{partition_col}={p}" for p in M.staged_partitions(staged, partition_col)]
    if not touched:
        return 0
    current = read(spark, path, touched, of=base)
    if current is None:
        merged = staged
    else:
        current = _with_columns_of(current, batch)
        if only_newer:
            staged = M.newer_rows(current, staged, key, only_newer)
        merged = upsert_rows(current, staged, key, update_cols).select(*batch.columns)
    commit(spark, merged, path, partition_col, base, replaced=touched)
    return M.rows_seen(seen)


def delete_insert(spark: SparkSession, new: DataFrame, path: str, key: str, partition_col: str, since=None, widen: bool = False) -> int:
    """Deletes rows whose key is in ``new`` and inserts ``new`` (A10).

    ``new`` holds only partitions ``>= since``; those alone are read, and written once.
    """
    base = _to_change(spark, path, partition_col)
    if base is None:
        return commit(spark, new, path, partition_col, None)
    if widen:
        base = widened(base, new)
    touched = [p for p in base.partitions if since is None or p >= f"{partition_col}={since}"]
    current = read(spark, path, touched, of=base)
    new = M.conform(new, spark.createDataFrame([], base.schema))
    rows = new if current is None else delete_insert_rows(_with_columns_of(current, new), new, key)
    return commit(spark, rows, path, partition_col, base, replaced=touched)


def _with_columns_of(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows through the batch's columns: one that is new to the table is null in them."""
    return stored.select(*[f.name if f.name in stored.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema.fields])


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Removes all but the newest ``keep`` versions, and the rows that only they or died runs hold.

    Returns the removed folders below the table. A reader of a removed version
    fails; a writer that is at work has a higher number and keeps its files.
    Files go first, so a run that dies here is taken up by the next one.
    """
    if keep < 1:
        raise ValueError("keep the newest version at least")
    known = numbers(spark, path)
    if not known:
        return []
    held = [version(spark, path, n) for n in known[-keep:]]
    dropped = [version(spark, path, n) for n in known[:-keep]]
    # a plain folder that was taken over is version 0, kept while there are too few others
    plain = _plain_parts(spark, path) if len(known) >= keep else []
    live = {(c, p) for v in held for p, commits in v.partitions.items() for c in commits}
    live_commits = {c for c, _ in live}
    old = {(c, p) for v in dropped for p, commits in v.partitions.items() for c in commits} | {("", p) for p in plain}
    garbage = [f"{DATA}/{c}/{p}" if c else p for c, p in sorted(old - live) if c in live_commits or not c]
    # commits that no kept version names: of dropped versions, or of runs that died before they published
    for name in _names(spark, f"{path}/{DATA}"):
        if name not in live_commits and int(name[len(COMMIT) + 1 :].split("-")[0]) <= known[-1]:
            garbage.append(f"{DATA}/{name}")
    fs, _ = _fs(spark, path)
    for g in garbage:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{g}"), True)
    for n in known[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSIONS}/{n:08d}.json"), False)
    return garbage
