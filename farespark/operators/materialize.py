"""Materializations on plain Parquet folders (no table format in the image).

Tables are partitioned by a date column. A batch rewrites only the
partitions it can touch: the new content of those partitions is first
written to a staging folder below the table's root (which cuts the lineage
to the files about to be replaced), then swapped in by renaming the
partitions' folders; the next change finishes a swap that was interrupted. Everything else in the table is never read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farespark.functions.dates import wall_lit
from farespark.operators.ingest import delete_insert_rows, upsert_rows
from farespark.session import scratch_path


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Read a Parquet table, or None when it does not exist yet.

    With ``schema`` the files are read through that schema: columns a file
    lacks come back NULL, columns the schema lacks are ignored. That is the
    read side of ``sync_all_columns`` (A12) without rewriting old files.
    """
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def read_synced(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A table through the columns of ``schema`` (A12, ``sync_all_columns``).

    Columns that older files lack come back NULL, columns that the model has
    dropped are left out. A column that is stored already keeps its type.
    """
    stored = read_table(spark, path)
    if stored is None:
        return None
    types = {f.name: f.dataType for f in stored.schema.fields}
    return read_table(spark, path, T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in schema.fields]))


def read_first(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """First existing table among candidate locations."""
    for p in paths:
        df = read_table(spark, p)
        if df is not None:
            return df
    return None


CODEC = "spark.sql.parquet.compression.codec"


def write(
    df: DataFrame,
    path: str,
    mode: str,
    partition_col: str | None,
    placed: bool = False,
    order: tuple[str, ...] = (),
    seen: Observation | None = None,
    marked: bool = True,
) -> None:
    if partition_col and not placed:
        # Without it every task writes a file into every day it holds. AQE splits a large day and joins small ones.
        # Rows read from files of the same partitions are placed already: a task holds few days.
        df = df.hint("rebalance", F.col(partition_col))
    if order:
        df = df.sortWithinPartitions(*([partition_col] if partition_col else []), *order)
    if seen is not None:
        # Last before the write, behind every exchange: a task of the writing stage counts once, however often it is retried.
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode(mode)
    if CODEC not in df.sparkSession.conf.getAll:
        # The keys are digests in hex, which Spark's default, snappy, stores as they are.
        w = w.option("compression", "zstd")
    if not marked:
        w = w.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)


def append(df: DataFrame, path: str, partition_col: str | None = None, order: tuple[str, ...] = (), placed: bool = False) -> None:
    """Append files (A3, A9), clustered by the partition column and sorted
    by ``order`` (the compound lookup key, A14) within it. ``placed``: the rows
    are read, without a shuffle, from a table with the same partitions."""
    write(df, path, "append", partition_col, placed, order=order)


def create_partitioned(df: DataFrame, path: str, partition_col: str) -> None:
    """First materialization of an incremental table."""
    write(df, path, "overwrite", partition_col)


def overwrite(df: DataFrame, path: str) -> None:
    """Full refresh (A11). ``df`` must not read ``path`` itself."""
    write(df, path, "overwrite", None)


def write_counted(df: DataFrame, path: str) -> int:
    """Writes ``df`` in place of what ``path`` holds; the rows are counted by the write itself."""
    seen = Observation()
    write(df, path, "overwrite", None, seen=seen)
    return rows_seen(seen)


def rows_seen(seen: Observation) -> int:
    return seen.get.get("rows") or 0


def stage_rows(spark: SparkSession, df: DataFrame, partition_col: str, name: str, seen: Observation) -> DataFrame:
    stage = scratch_path(spark, name)
    write(df, stage, "overwrite", partition_col, seen=seen)
    # read through the known schema: an empty stage has no file to infer from
    return spark.read.schema(df.schema).parquet(stage)


def _replace_partitions(spark: SparkSession, new_content: DataFrame, path: str, partition_col: str) -> None:
    write(new_content, f"{path}/{SWAP}/rows", "overwrite", partition_col)
    finish_swap(spark, path, partition_col)


#: Hidden folder below a table's root with the staged content of the partitions that are being replaced.
SWAP = "_swap"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _folders(spark: SparkSession, path: str, partition_col: str) -> list:
    """Names of the partitions' folders below a path, by listing; no job is run."""
    fs, p = _fs(spark, path)
    found = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in found if n.startswith(f"{partition_col}="))


def finish_swap(spark: SparkSession, path: str, partition_col: str) -> None:
    """Moves staged partitions into the table and removes the staging folder.

    The folders are renamed, so no row is written again. Called before a
    table is read for a change, it also finishes what an interrupted run
    left: of a complete stage the partitions that are still there are moved,
    an incomplete one is dropped, as its batch is still to be loaded.
    """
    fs, root = _fs(spark, f"{path}/{SWAP}")
    if not fs.exists(root):
        return
    rows = f"{path}/{SWAP}/rows"
    if fs.exists(_fs(spark, f"{rows}/_SUCCESS")[1]):
        for name in _folders(spark, rows, partition_col):
            target = _fs(spark, f"{path}/{name}")[1]
            fs.delete(target, True)
            if not fs.rename(_fs(spark, f"{rows}/{name}")[1], target):
                raise OSError(f"{rows}/{name} could not be moved to {target}")
    fs.delete(root, True)


def _move_in(spark: SparkSession, staged: str, names: list[str], merged: DataFrame | None, path: str, partition_col: str) -> None:
    """Swaps in the merged partitions and, as they are, those of the ``staged`` folder.

    All are brought together in the staging folder first and marked complete
    last, so that a run that dies leaves either all of them or none.
    """
    fs, rows = _fs(spark, f"{path}/{SWAP}/rows")
    if merged is not None:
        write(merged, str(rows), "overwrite", partition_col, marked=False)
    fs.mkdirs(rows)
    for name in names:
        if not fs.rename(_fs(spark, f"{staged}/{name}")[1], _fs(spark, f"{rows}/{name}")[1]):
            raise OSError(f"{staged}/{name} could not be moved to {rows}")
    fs.create(_fs(spark, f"{rows}/_SUCCESS")[1]).close()
    finish_swap(spark, path, partition_col)


def max_value(spark: SparkSession, path: str, column: str, partition_col: str | None = None):
    """``max(column)`` of a table, None if the table is absent or empty.

    With a date partition column the maximum partition is found first (a
    partition-only aggregate) and only that partition is scanned for the
    maximum of ``column``.
    """
    df = read_table(spark, path)
    if df is None:
        return None
    if partition_col and partition_col != column:
        last = df.agg(F.max(partition_col)).first()[0]
        if last is None:
            return None
        df = df.filter(F.col(partition_col) == wall_lit(last))
    return df.agg(F.max(column)).first()[0]


def conform(batch: DataFrame, table: DataFrame) -> DataFrame:
    """Cast a batch's columns to the stored table's types (same names/order)."""
    types = {f.name: f.dataType for f in table.schema.fields}
    return batch.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in batch.columns])


def staged_partitions(staged: DataFrame, partition_col: str) -> list[str]:
    """Partition values of a staged, partitioned folder from its file
    listing (``col=value`` directory names): no job is run."""
    key = f"/{partition_col}="
    vals = set()
    for f in staged.inputFiles():
        i = f.find(key)
        if i >= 0:
            vals.add(f[i + len(key):].split("/", 1)[0])
    return sorted(vals)


def newer_rows(stored: DataFrame, batch: DataFrame, key: str, column: str) -> DataFrame:
    """Rows of ``batch`` that are new, or at least as new as the stored row of their key."""
    old = stored.select(key, F.col(column).alias("_stored_version"))
    is_new = F.col("_stored_version").isNull() | (F.col(column) >= F.col("_stored_version"))
    return batch.join(old, key, "left").filter(is_new).select(*batch.columns)


def upsert_partitioned(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    key: str,
    update_cols: list[str],
    partition_col: str,
    only_newer: str | None = None,
) -> int:
    """Keyed upsert into a partitioned table (A4). Returns the rows of the batch, counted as they are written.

    The key must determine the partition (record_hash includes captured_at,
    the partition is its date), so a key can only live in the batch's own
    partitions: only those are read, merged and rewritten. With
    ``only_newer`` (a version column such as ``ingested_at``) a stored row
    is replaced only by a batch row at least as new, which makes the result
    independent of batch order and of replays.
    """
    finish_swap(spark, path, partition_col)
    seen = Observation()
    current = read_synced(spark, path, batch.schema)
    if current is None:
        # first load: written directly (an empty batch leaves an empty
        # folder, which reads as "no table yet")
        write(batch, path, "overwrite", partition_col, seen=seen)
        return rows_seen(seen)
    # The stored schema wins: a batch of wider types must not rewrite some
    # partitions with a different Parquet type (ANSI casts fail on overflow).
    batch = conform(batch, current)
    # Stage the batch once: it is used twice (touched partitions, merge) and
    # is usually the product of normalize + de-dup, not worth recomputing.
    cols = batch.columns
    # It lies below the table's root, so that whole partitions can be moved in.
    stage = f"{path}/{SWAP}/batch"
    write(batch, stage, "overwrite", partition_col, seen=seen)
    parts = _folders(spark, stage, partition_col)
    if not parts:  # empty batch (D13): the table is not touched
        finish_swap(spark, path, partition_col)
        return 0
    # A partition that the table lacks has nothing to merge with: it is moved, not joined and written again.
    stored = set(_folders(spark, path, partition_col))
    shared = [n for n in parts if n in stored]
    merged = None
    if shared:
        staged = spark.read.schema(batch.schema).parquet(stage).select(*cols)
        ptype = current.schema[partition_col].dataType
        days = F.col(partition_col).isin([F.lit(n.split("=", 1)[1]).cast(ptype) for n in shared])
        target = current.filter(days).select(*cols)
        staged = staged.filter(days)
        if only_newer:
            staged = newer_rows(target, staged, key, only_newer)
        merged = upsert_rows(target, staged, key, update_cols).select(*cols)
    _move_in(spark, stage, [n for n in parts if n not in stored], merged, path, partition_col)
    return rows_seen(seen)


def delete_insert_partitioned(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    key: str,
    partition_col: str,
    since,
) -> None:
    """Delete rows whose key is in ``new``, insert ``new`` (A10).

    ``new`` only holds partitions ``>= since`` (the re-opened days), so only
    those partitions are read and rewritten; older ones stay untouched.
    """
    finish_swap(spark, path, partition_col)
    current = read_synced(spark, path, new.schema)
    if current is None:
        write(new, path, "overwrite", partition_col)
        return
    new = conform(new, current)
    if since is not None:
        current = current.filter(F.col(partition_col) >= wall_lit(since))
    merged = delete_insert_rows(current.select(*new.columns), new, key)
    _replace_partitions(spark, merged, path, partition_col)


def create_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    partition_cols: list[str] | None = None,
) -> None:
    """Create-if-missing catalog table over a path.

    Column types and descriptions come from the StructType; NOT NULL and
    the primary key are not enforced by Parquet tables, they are the K1/K2
    checks. Existing partitions under ``path`` are registered.
    """
    cols = []
    for f in schema.fields:
        comment = (f.metadata or {}).get("comment")
        c = f"`{f.name}` {f.dataType.simpleString()}"
        if comment:
            c += " COMMENT '" + comment.replace("'", "") + "'"
        cols.append(c)
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(cols)}) USING parquet{part} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
