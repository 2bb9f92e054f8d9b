"""Numeric helpers that keep Spark and SQL engines bit-comparable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_avg(price: str | Column) -> Column:
    """Mean of a decimal column as double: exact decimal sum / count.

    ``avg(decimal(12,2))`` is decimal(16,6) in Spark and double elsewhere;
    the exact sum divided once in double arithmetic is engine-independent.
    """
    p = _c(price)
    return F.sum(p).cast("double") / F.count(p)


def round_num(x: str | Column, scale: int) -> Column:
    """round(x::numeric, scale): through a decimal, half away from zero."""
    return F.round(_c(x).cast("decimal(38,10)"), scale)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den = 0 (ANSI mode would raise)."""
    d = _c(den)
    return F.when(d != 0, _c(num) / d)
