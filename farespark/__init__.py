"""farespark: a PySpark-native fare-price analytics pipeline.

Layers (each a pure ``DataFrame -> DataFrame`` builder, composed with
``DataFrame.transform``):

    raw quotes -> loader (normalize, hash, de-dup, upsert) -> STG -> ODS
        -> DWH daily features (percentiles, lag, 7-row mean)
        -> DM one-row-per-route purchase recommendation

plus data-quality operators that return plain tables and a Structured
Streaming ingest path. Everything is built-in Spark expressions; there is
no Python UDF anywhere in the library.
"""

from farespark.params import Params

__all__ = ["Params"]
