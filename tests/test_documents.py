"""JSON documents, the raw layer, and counters that the writes observe."""

from __future__ import annotations

import datetime as dt
import json

from farespark.operators import materialize as M
from farespark.operators.ingest import normalize, read_documents, rejected
from farespark.plans import pipeline as PL
from farespark.schemas import RAW

RUN = dt.datetime(2024, 3, 5)


def test_one_bad_line_costs_only_itself(spark, tmp_path):
    good = {"route_origin": "led", "route_destination": "aer", "departure_at": "2024-03-10T08:00:00", "captured_at": "2024-03-01T06:00:00.250", "price": 100.5}
    lines = [
        json.dumps(good),
        json.dumps(good)[:60],
        "no json",
        "",
        "[]",
        "7",
        json.dumps(good | {"price": "99.90", "captured_at": "2024-03-01T09:00:00+03:00", "more": {"of": [1]}}),
        json.dumps(good | {"price": "much"}),
        json.dumps(good | {"departure_at": "soon"}),
        "{}",
    ]
    (tmp_path / "day.json").write_text("\n".join(lines) + "\n")
    rows = read_documents(spark, str(tmp_path))
    assert rows.count() == 9  # the empty line is nothing
    kept = sorted((float(r["price"]), r["captured_at"]) for r in normalize(rows, RUN).collect())
    assert kept == [(99.9, dt.datetime(2024, 3, 1, 6)), (100.5, dt.datetime(2024, 3, 1, 6, 0, 0, 250_000))]
    why = sorted(r["reject_reason"] for r in rejected(rows).collect())
    assert why == ["missing departure_at"] * 2 + ["not a document"] * 4 + ["null price"]


def _quotes(spark, prices, day):
    at = dt.datetime(2024, 3, day)
    return spark.createDataFrame([("p", "LED", "AER", dt.datetime(2024, 3, 20 + i), at, None, "RUB", float(x), None) for i, x in enumerate(prices)], RAW)


def test_repeated_run_inserts_nothing_twice(spark, tmp_path):
    layout = PL.Layout(str(tmp_path / "fares"))
    runs = [PL.run_batch(spark, _quotes(spark, [10, 20, 30], 1), layout, RUN, batch="a") for _ in range(2)]
    assert [(r["inserted"], r["transferred"]) for r in runs] == [(3, 3), (3, 0)]  # the second is at the watermark
    again = PL.run_batch(spark, _quotes(spark, [40, 50], 2), layout, RUN, batch="b")
    none = PL.run_batch(spark, _quotes(spark, [40, 50], 2).limit(0), layout, RUN, batch="c")
    assert [(r["inserted"], r["transferred"]) for r in (again, none)] == [(2, 2), (0, 0)]
    stored = PL.read_raw(spark, layout).collect()
    assert sorted((r["batch"], r["price"], r["ingested_at"]) for r in stored) == [("a", x, RUN) for x in (10.0, 20.0, 30.0)] + [("b", x, RUN) for x in (40.0, 50.0)]


def test_count_is_of_the_rows_written(spark, tmp_path):
    path = str(tmp_path / "t")
    assert M.write_counted(spark.range(1000).repartition(7).where("id % 3 = 0"), path) == 334
    assert spark.read.parquet(path).count() == 334
