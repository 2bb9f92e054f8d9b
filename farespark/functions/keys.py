"""Surrogate keys as Column expressions (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text layout of timestamps inside record_hash: microseconds always
# present, no zone offset (stable across engines; DuckDB equivalent
# strftime('%Y-%m-%dT%H:%M:%S.%f'); Spark pattern yyyy-MM-dd'T'HH:mm:ss.SSSSSS).
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def route_key(origin: str | Column, destination: str | Column) -> Column:
    """md5(upper(o) || '-' || upper(d)); NULL in gives NULL out like ``||``."""
    return F.md5(F.concat(F.upper(_c(origin)), F.lit("-"), F.upper(_c(destination))))


def ts_text(ts: str | Column) -> Column:
    """'yyyy-MM-ddTHH:mm:ss.ffffff' of a TIMESTAMP_NTZ, built without any
    time zone: the NTZ-to-string cast gives the wall clock, the fraction is
    taken from the seconds field and padded to six digits."""
    t = _c(ts).cast("timestamp_ntz")
    whole = F.substring(t.cast("string"), 1, 19)  # 'yyyy-MM-dd HH:mm:ss'
    micros = (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long") % 1_000_000
    return F.concat(F.translate(whole, " ", "T"), F.lit("."), F.lpad(micros.cast("string"), 6, "0"))


def record_hash(
    origin: str | Column,
    destination: str | Column,
    departure_at: str | Column,
    captured_at: str | Column,
) -> Column:
    """sha256 hex of 'ORIGIN|DESTINATION|departure|captured'.

    Excludes class, currency, provider and price on purpose: a business and
    an economy quote of the same instant share one key.
    """
    return F.sha2(
        F.concat(
            _c(origin),
            F.lit("|"),
            _c(destination),
            F.lit("|"),
            ts_text(departure_at),
            F.lit("|"),
            ts_text(captured_at),
        ),
        256,
    )


def feature_key(route_key_col: str | Column, departure_date: str | Column, captured_date: str | Column) -> Column:
    """md5(route_key || '-' || departure_date || '-' || captured_date)."""
    return F.md5(
        F.concat(
            _c(route_key_col),
            F.lit("-"),
            _c(departure_date).cast("string"),
            F.lit("-"),
            _c(captured_date).cast("string"),
        )
    )
