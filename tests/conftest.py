from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farespark.schemas import RAW  # noqa: E402
from farespark.session import get_spark  # noqa: E402

SF_SMALL = os.environ.get("FARESPARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=4)
    yield s


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def raw_df(spark, rows: list[dict]):
    """RAW-schema DataFrame from partial dicts (missing keys are NULL)."""
    names = RAW.fieldNames()
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, RAW)


def quote(o="SVO", d="LED", dep="2024-03-10 10:00:00", cap="2024-03-01 09:00:00", price=100.0, **kw) -> dict:
    r = {
        "provider": "aviasales",
        "route_origin": o,
        "route_destination": d,
        "departure_at": T(dep) if isinstance(dep, str) else dep,
        "captured_at": T(cap) if isinstance(cap, str) else cap,
        "ticket_class": "economy",
        "currency": "RUB",
        "price": price,
        "ingested_at": T("2024-03-01 10:00:00"),
    }
    r.update(kw)
    return r
