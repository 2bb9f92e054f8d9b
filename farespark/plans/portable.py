"""Output convention of registered queries (shared with the SQL oracle).

Money leaves as DOUBLE and calendar dates as TIMESTAMP_NTZ, so that a
result converts to the same pandas/Arrow types from Spark and from DuckDB.
Inside the library the natural types (decimal(12,2), date) are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)
