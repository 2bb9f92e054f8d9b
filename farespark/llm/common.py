"""Reading, landing and small column helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage, so a lost executor costs a re-read and not a
    recomputation, and a table that is used twice is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int, read: int | None = None) -> Iterator[None]:
    """Jobs run inside hand Python ``rows`` rows at a time, and read Parquet files ``read`` rows at a time: for tables whose rows are large."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows} | ({"spark.sql.parquet.columnarReaderBatchSize": read} if read else {})
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function over a task's batches; at its end the free memory goes back to the system.

    Spark keeps Python workers for later stages, and their allocators keep
    what earlier ones took.
    """

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return whole


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores where a column of ``df`` is called so (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(df: DataFrame, text_col: str = "text") -> Column:
    """The text, null as the empty string."""
    return F.coalesce(F.col(f"`{text_col}`"), F.lit(""))


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as decimal text, modulo ``n`` (null ids: -1)."""
    c = F.col(f"`{id_col}`").cast("string")
    return F.coalesce(F.pmod(F.crc32(c.cast("binary")), F.lit(n)), F.lit(-1)).cast("int")
