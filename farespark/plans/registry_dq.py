"""Registered data-quality queries (2.K) and their SQL oracles."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespark.functions.dates import wall_lit
from farespark.operators import materialize as M
from farespark.operators import metric_store
from farespark.operators import quality as Qy
from farespark.params import DEFAULT, Params
from farespark.plans import duckdb_sql as D
from farespark.plans import flows, models
from farespark.schemas import DWH_COLUMNS, RAW
from farespark.session import scratch_path
from farespark.sources import variants as V

Q = {}
P = DEFAULT
RAW_COLS = RAW.fieldNames()
ACCEPTED_CLASS = ["economy", "business"]
ACCEPTED_CCY = ["RUB", "USD", "EUR"]
ACCEPTED_WEEKDAY = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
ZCOLS = ["hist_n", "hist_mean", "hist_stddev", "z_score", "is_anomaly"]


def register(name: str, sql: str | None, columns: list[str] | None = None):
    def deco(fn):
        Q[name] = (fn, D.portable(sql, columns) if (sql and columns) else sql)
        return fn

    return deco


# ------------------------------------------------------------ SQL twins


def z_sql(src: str, by: list[str], p: Params = P) -> str:
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    w = f"({part}ORDER BY bucket_date ROWS BETWEEN {p.anomaly_window} PRECEDING AND 1 PRECEDING)"
    z = f"CASE WHEN _n >= {p.anomaly_min_history} AND _sd > 0 THEN (metric_value - _mean) / _sd END"
    return f"""SELECT s.* EXCLUDE (_n, _mean, _sd),
       CAST(_n AS BIGINT) AS hist_n,
       CAST(round(CAST(_mean AS DECIMAL(38,10)), 6) AS DOUBLE) AS hist_mean,
       CAST(round(CAST(_sd AS DECIMAL(38,10)), 6) AS DOUBLE) AS hist_stddev,
       CAST(round(CAST({z} AS DECIMAL(38,10)), 6) AS DOUBLE) AS z_score,
       coalesce(abs({z}) > {p.anomaly_z}, false) AS is_anomaly
FROM (SELECT *, count(metric_value) OVER {w} AS _n, avg(metric_value) OVER {w} AS _mean,
             stddev_samp(metric_value) OVER {w} AS _sd FROM {src}) AS s"""


def spine_sql(daily: str, by: list[str]) -> str:
    cols = ", ".join(by) + ", " if by else ""
    grp = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""SELECT {cols}CAST(unnest(generate_series(CAST(_first AS TIMESTAMP), CAST(_end AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS bucket_date
FROM (SELECT {cols}min(bucket_date) AS _first, max(max(bucket_date)) OVER () AS _end FROM {daily} {grp}) AS f"""


def volume_ctes(src: str, ts: str, pre: str) -> D.Ctes:
    return [
        (f"{pre}_daily", f"SELECT CAST({ts} AS DATE) AS bucket_date, COUNT(*) AS metric_value FROM {src} GROUP BY 1"),
        (f"{pre}_spine", spine_sql(f"{pre}_daily", [])),
        (
            f"{pre}_series",
            f"SELECT s.bucket_date, CAST(coalesce(d.metric_value, 0) AS DOUBLE) AS metric_value "
            f"FROM {pre}_spine s LEFT JOIN {pre}_daily d ON s.bucket_date = d.bucket_date",
        ),
        (pre, z_sql(f"{pre}_series", [])),
    ]


def freshness_event_ctes(src: str, event: str, update: str, pre: str) -> D.Ctes:
    lag = f"((epoch_us({update}) - epoch_us({event})) / 1000000.0)"
    return [
        (
            f"{pre}_daily",
            f"SELECT CAST({update} AS DATE) AS bucket_date, max({lag}) AS max_lag_seconds, avg({lag}) AS avg_lag_seconds "
            f"FROM {src} GROUP BY 1",
        ),
        (
            f"{pre}_long",
            f"""SELECT bucket_date, metric, CAST(round(CAST(metric_value AS DECIMAL(38,10)), 3) AS DOUBLE) AS metric_value FROM (
  SELECT bucket_date, 'max_lag_seconds' AS metric, CAST(max_lag_seconds AS DOUBLE) AS metric_value FROM {pre}_daily
  UNION ALL SELECT bucket_date, 'avg_lag_seconds', CAST(avg_lag_seconds AS DOUBLE) FROM {pre}_daily) AS u""",
        ),
        (pre, z_sql(f"{pre}_long", ["metric"])),
    ]


def _metric_sql(col: str, kind: str) -> list[tuple[str, str]]:
    out = [
        ("null_count", f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS DOUBLE)"),
        ("null_percent", f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL) * 100.0 / COUNT(*) AS DOUBLE)"),
    ]
    if kind in ("decimal", "double", "int"):
        d = f"CAST({col} AS DOUBLE)"
        avg = f"CAST(SUM({col}) AS DOUBLE) / COUNT({col})" if kind == "decimal" else f"avg({d})"
        out += [
            ("min", f"min({d})"),
            ("max", f"max({d})"),
            ("average", avg),
            ("standard_deviation", f"stddev_samp({d})"),
            ("zero_count", f"CAST(COUNT(*) FILTER (WHERE {d} = 0) AS DOUBLE)"),
        ]
    elif kind == "string":
        out += [
            ("min_length", f"CAST(min(length({col})) AS DOUBLE)"),
            ("max_length", f"CAST(max(length({col})) AS DOUBLE)"),
            ("average_length", f"CAST(avg(length({col})) AS DOUBLE)"),
            ("missing_count", f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL OR {col} = '') AS DOUBLE)"),
        ]
    return out


def column_metrics_ctes(src: str, day: str, cols: dict[str, str], pre: str) -> D.Ctes:
    aggs, unions = [], []
    for c, kind in cols.items():
        for m, e in _metric_sql(c, kind):
            a = f"{c}__{m}"
            aggs.append(f"{e} AS {a}")
            unions.append(f"SELECT bucket_date, '{c}' AS column_name, '{m}' AS metric, CAST({a} AS DOUBLE) AS metric_value FROM {pre}_daily")
    return [
        (f"{pre}_daily", f"SELECT CAST({day} AS DATE) AS bucket_date, {', '.join(aggs)} FROM {src} GROUP BY 1"),
        (
            f"{pre}_long",
            "SELECT bucket_date, column_name, metric, CAST(round(CAST(metric_value AS DECIMAL(38,10)), 6) AS DOUBLE) AS metric_value FROM (\n"
            + "\nUNION ALL ".join(unions)
            + ") AS u",
        ),
        (pre, z_sql(f"{pre}_long", ["column_name", "metric"])),
    ]


def dimension_ctes(src: str, day: str, dims: list[str], pre: str) -> D.Ctes:
    ds = ", ".join(dims)
    on = " AND ".join(f"s.{d} = x.{d}" for d in [*dims, "bucket_date"])
    return [
        (f"{pre}_daily", f"SELECT {ds}, CAST({day} AS DATE) AS bucket_date, COUNT(*) AS metric_value FROM {src} GROUP BY ALL"),
        (f"{pre}_spine", spine_sql(f"{pre}_daily", dims)),
        (
            f"{pre}_series",
            f"SELECT {', '.join('s.' + d for d in dims)}, s.bucket_date, CAST(coalesce(x.metric_value, 0) AS DOUBLE) AS metric_value "
            f"FROM {pre}_spine s LEFT JOIN {pre}_daily x ON {on}",
        ),
        (pre, z_sql(f"{pre}_series", dims)),
    ]


def freshness_ctes(src: str, day: str, pre: str) -> D.Ctes:
    return [
        (f"{pre}_days", f"SELECT DISTINCT CAST({day} AS DATE) AS bucket_date FROM {src}"),
        (
            f"{pre}_gaps",
            f"SELECT bucket_date, CAST(date_diff('day', lag(bucket_date) OVER (ORDER BY bucket_date), bucket_date) AS DOUBLE) AS metric_value FROM {pre}_days",
        ),
        (pre, z_sql(f"{pre}_gaps", [])),
    ]


DWH_KINDS = {
    "feature_key": "string", "route_key": "string", "route_origin": "string", "route_destination": "string",
    "departure_date": "date", "captured_date": "date", "avg_price": "double", "min_price": "decimal",
    "max_price": "decimal", "p25_price": "decimal", "p50_price": "decimal", "prev_avg_price": "double",
    "avg_price_7d": "double",
}

# ------------------------------------------------------------ fixtures

DIRTY = D.raw_fx1() + [("dirty_all", V.sql_dirty("raw_all")), ("dirty", "SELECT * EXCLUDE (event_id) FROM dirty_all")]
DIRTY_MODELS = (
    DIRTY
    + D.stg_base("dirty", P, name="stg_base")
    + D.stg("stg_base")
    + D.ods("stg", P)
    + D.dwh("ods", P)
    + D.dm("ods", P)
)
GAP = D.raw_fx1() + [("gap_all", V.sql_gap("raw_all")), ("gap", "SELECT * EXCLUDE (event_id) FROM gap_all")]
GAP_MODELS = GAP + D.stg_base("gap", P, name="stg_base") + D.stg("stg_base") + D.ods("stg", P) + D.dwh("ods", P)
FX1 = D.fx1_ods(P)


_STATE: dict = {}
_LOCK = threading.Lock()


def _dirty_models(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four models over FX1-dirty, materialized once per application:
    data tests run on stored tables (as they do after a model run), not on
    a re-computation of every model under every test."""
    k = (spark.sparkContext.applicationId, sf, "dirty_models")
    with _LOCK:
        if k not in _STATE:
            root = scratch_path(spark, "dq-models")
            base = flows.stg_base_of(V.dirty(spark, sf).select(*RAW_COLS), P)
            M.overwrite(base, f"{root}/stg_base")
            stg = models.stg(spark.read.parquet(f"{root}/stg_base"))
            M.overwrite(models.ods(stg, P), f"{root}/ods")
            ods = spark.read.parquet(f"{root}/ods")
            M.overwrite(models.dwh(ods, P), f"{root}/dwh")
            M.overwrite(models.dm(ods, P), f"{root}/dm")
            _STATE[k] = root
        root = _STATE[k]
    stg = models.stg(spark.read.parquet(f"{root}/stg_base"))
    return {name: spark.read.parquet(f"{root}/{name}") for name in ("ods", "dwh", "dm")} | {"stg": stg}


def _gap_ods(spark, sf):
    return flows.ods_of(V.gap(spark, sf).select(*RAW_COLS), P)


# ------------------------------------------------------------ K1-K4


@register(
    "dq_unique",
    D.query(DIRTY + D.normalized("dirty", P), "SELECT record_hash, COUNT(*) AS n FROM normalized GROUP BY 1 HAVING COUNT(*) > 1"),
    ["record_hash", "n"],
)
def dq_unique(spark, sf):
    from farespark.operators.ingest import normalize

    return Qy.dq_unique(normalize(V.dirty(spark, sf).select(*RAW_COLS), flows.RUN_TS, P), "record_hash")


@register(
    "dq_not_null",
    D.query(
        DIRTY,
        "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM dirty" for c in RAW_COLS),
    ),
    ["column_name", "failures"],
)
def dq_not_null(spark, sf):
    return Qy.dq_not_null(V.dirty(spark, sf), RAW_COLS)


def _accepted_sql(src: str, col: str, values: list[str]) -> str:
    vals = ", ".join(f"'{v}'" for v in values)
    return f"SELECT '{col}' AS column_name, {col} AS bad_value, COUNT(*) AS n FROM {src} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}) GROUP BY {col}"


@register(
    "dq_accepted_values",
    D.query(
        DIRTY_MODELS,
        _accepted_sql("stg", "ticket_class", ACCEPTED_CLASS) + "\nUNION ALL " + _accepted_sql("stg", "currency", ACCEPTED_CCY)
        + "\nUNION ALL " + _accepted_sql("dm", "best_search_weekday", ACCEPTED_WEEKDAY),
    ),
    ["column_name", "bad_value", "n"],
)
def dq_accepted_values(spark, sf):
    m = _dirty_models(spark, sf)
    return Qy.union_all(
        [
            Qy.dq_accepted_values(m["stg"], "ticket_class", ACCEPTED_CLASS),
            Qy.dq_accepted_values(m["stg"], "currency", ACCEPTED_CCY),
            Qy.dq_accepted_values(m["dm"], "best_search_weekday", ACCEPTED_WEEKDAY),
        ]
    )


@register(
    "dq_relationships",
    D.query(
        FX1 + [("b1", f"SELECT * EXCLUDE (event_id) FROM ({V.sql_batch1('raw_all')}) AS x")] + D.stg_base("b1", P, name="parent"),
        "SELECT record_hash FROM ods WHERE record_hash IS NOT NULL AND record_hash NOT IN (SELECT record_hash FROM parent)",
    ),
    ["record_hash"],
)
def dq_relationships(spark, sf):
    """K4: ODS keys (all of FX1) checked against an STG holding batch 1 only."""
    parent = flows.stg_base_of(V.batch1(spark, sf).select(*RAW_COLS), P)
    return Qy.dq_relationships(flows.fx1_ods(spark, sf), parent, "record_hash")


# ------------------------------------------------------------ K5-K10


@register(
    "dq_volume",
    D.query(GAP_MODELS + volume_ctes("ods", "captured_at", "vol"), "SELECT * FROM vol"),
    ["bucket_date", "metric_value", *ZCOLS],
)
def dq_volume(spark, sf):
    return Qy.dq_volume(_gap_ods(spark, sf), "captured_at", P)


@register(
    "dq_event_freshness",
    D.query(FX1 + freshness_event_ctes("ods", "departure_at", "captured_at", "efr"), "SELECT * FROM efr"),
    ["bucket_date", "metric", "metric_value", *ZCOLS],
)
def dq_event_freshness(spark, sf):
    return Qy.dq_event_freshness(flows.fx1_ods(spark, sf), "departure_at", "captured_at", P)


@register(
    "dq_column_anomaly",
    D.query(GAP_MODELS + column_metrics_ctes("ods", "captured_at", {"price": "decimal"}, "colm"), "SELECT * FROM colm"),
    ["bucket_date", "column_name", "metric", "metric_value", *ZCOLS],
)
def dq_column_anomaly(spark, sf):
    return Qy.dq_column_metrics(_gap_ods(spark, sf), "captured_at", ["price"], P)


@register(
    "dq_all_columns",
    D.query(FX1 + D.dwh("ods", P) + column_metrics_ctes("dwh", "captured_date", DWH_KINDS, "allc"), "SELECT * FROM allc"),
    ["bucket_date", "column_name", "metric", "metric_value", *ZCOLS],
)
def dq_all_columns(spark, sf):
    return Qy.dq_column_metrics(models.dwh(flows.fx1_ods(spark, sf), P), "captured_date", DWH_COLUMNS, P)


@register(
    "dq_dimension",
    D.query(GAP_MODELS + dimension_ctes("dwh", "captured_date", ["route_origin", "route_destination"], "dim"), "SELECT * FROM dim"),
    ["route_origin", "route_destination", "bucket_date", "metric_value", *ZCOLS],
)
def dq_dimension(spark, sf):
    return Qy.dq_dimension(models.dwh(_gap_ods(spark, sf), P), "captured_date", ["route_origin", "route_destination"], P)


@register(
    "dq_freshness",
    D.query(GAP_MODELS + freshness_ctes("dwh", "captured_date", "fr"), "SELECT * FROM fr"),
    ["bucket_date", "metric_value", *ZCOLS],
)
def dq_freshness(spark, sf):
    return Qy.dq_freshness(models.dwh(_gap_ods(spark, sf), P), "captured_date", P)


# ------------------------------------------------------------ K5-K9 from stored moments


def _folded(spark, sf, what: str) -> str:
    """A store that two runs have filled: the second one folds the days from the batch cut on."""
    k = (spark.sparkContext.applicationId, sf, "moments", what)
    with _LOCK:
        if k not in _STATE:
            path = scratch_path(spark, f"moments-{what}")
            ods = _gap_ods(spark, sf) if what != "ods" else flows.fx1_ods(spark, sf)
            first = ods.filter(F.col("captured_at") < wall_lit(V.CUT))
            if what == "dwh":  # the day of the cut is opened again
                for df, day in ((models.dwh(first, P), None), (models.dwh(ods, P), V.CUT.date())):
                    metric_store.fold(spark, path, df, "captured_date", DWH_COLUMNS, ["route_origin", "route_destination"], reopened=day)
            else:
                for df in (first, ods):
                    metric_store.fold(spark, path, df, "captured_at", ["price"], event_col="departure_at")
            _STATE[k] = path
        return _STATE[k]


@register(
    "dq_volume_stored",
    D.query(GAP_MODELS + volume_ctes("ods", "captured_at", "vol"), "SELECT * FROM vol"),
    ["bucket_date", "metric_value", *ZCOLS],
)
def dq_volume_stored(spark, sf):
    return metric_store.volume(spark, _folded(spark, sf, "gap"), P)


@register(
    "dq_event_freshness_stored",
    D.query(FX1 + freshness_event_ctes("ods", "departure_at", "captured_at", "efr"), "SELECT * FROM efr"),
    ["bucket_date", "metric", "metric_value", *ZCOLS],
)
def dq_event_freshness_stored(spark, sf):
    return metric_store.event_freshness(spark, _folded(spark, sf, "ods"), P)


@register(
    "dq_column_anomaly_stored",
    D.query(GAP_MODELS + column_metrics_ctes("ods", "captured_at", {"price": "decimal"}, "colm"), "SELECT * FROM colm"),
    ["bucket_date", "column_name", "metric", "metric_value", *ZCOLS],
)
def dq_column_anomaly_stored(spark, sf):
    return metric_store.column_metrics(spark, _folded(spark, sf, "gap"), P)


@register(
    "dq_dimension_stored",
    D.query(GAP_MODELS + dimension_ctes("dwh", "captured_date", ["route_origin", "route_destination"], "dim"), "SELECT * FROM dim"),
    ["route_origin", "route_destination", "bucket_date", "metric_value", *ZCOLS],
)
def dq_dimension_stored(spark, sf):
    return metric_store.dimension(spark, _folded(spark, sf, "dwh"), ["route_origin", "route_destination"], P)


# ------------------------------------------------------------ K11, K12

# The declared tests (check, model, column), in a fixed order.
GENERIC_TESTS = [
    ("unique", "stg", "record_hash"), ("not_null", "stg", "record_hash"), ("not_null", "stg", "route_origin"),
    ("not_null", "stg", "route_destination"), ("accepted_values", "stg", "ticket_class"), ("accepted_values", "stg", "currency"),
    ("unique", "ods", "record_hash"), ("not_null", "ods", "record_hash"), ("relationships", "ods", "record_hash"),
    ("not_null", "ods", "route_key"), ("not_null", "ods", "days_before_departure"), ("not_null", "ods", "price"),
    ("not_null", "ods", "captured_at"),
    ("unique", "dwh", "feature_key"), ("not_null", "dwh", "feature_key"), ("not_null", "dwh", "route_key"),
    ("not_null", "dwh", "avg_price"), ("not_null", "dwh", "captured_date"),
    ("unique", "dm", "route_key"), ("not_null", "dm", "route_key"), ("not_null", "dm", "route_origin"),
    ("not_null", "dm", "route_destination"), ("not_null", "dm", "best_days_before_departure"),
    ("accepted_values", "dm", "best_search_weekday"), ("not_null", "dm", "best_search_hour"),
    ("not_null", "dm", "route_avg_price"), ("not_null", "dm", "route_price_stddev"), ("not_null", "dm", "route_price_cv"),
]
ACCEPTED = {"ticket_class": ACCEPTED_CLASS, "currency": ACCEPTED_CCY, "best_search_weekday": ACCEPTED_WEEKDAY}
ANOMALY_TESTS = [
    ("volume_anomalies", "ods", None, "warn"),
    ("event_freshness_anomalies", "ods", None, "error"),
    ("column_anomalies", "ods", "price", "error"),
    ("all_columns_anomalies", "dwh", None, "error"),
    ("dimension_anomalies", "dwh", None, "error"),
    ("freshness_anomalies", "dwh", None, "error"),
]
REPORT_COLS = ["check_name", "model", "column_name", "failures", "severity", "status"]


# Date column of each model for a report restricted to recent data.
MODEL_DAY = {"stg": "captured_at", "ods": "captured_at", "dwh": "captured_date"}


def recent_models(m: dict[str, DataFrame], since) -> dict[str, DataFrame]:
    """Models cut to rows of capture days >= ``since`` (the mart is small
    and kept whole). Exact for the generic tests: record_hash contains
    captured_at and feature_key contains captured_date, so a duplicate key
    can only sit within one capture day, and a child ODS row's parent STG
    key has the same capture day."""
    out = dict(m)
    for name, col in MODEL_DAY.items():
        out[name] = m[name].filter(F.to_date(F.col(col)) >= wall_lit(since).cast("date"))
    return out


def build_report(m: dict[str, DataFrame], params: Params = P, since=None) -> DataFrame:
    """One row per declared test. Column tests of a model share one
    scan; unique and relationship tests are one aggregate / anti-join each.
    With ``since`` every test reads only capture days >= since (anomaly
    checks plus their history window), so a scheduled run costs in
    proportion to the new data."""
    full = m
    if since is not None:
        m = recent_models(m, since)
    parts = []
    for model in ("stg", "ods", "dwh", "dm"):
        tests = [(c, col) for c, mdl, col in GENERIC_TESTS if mdl == model]
        nn = [col for c, col in tests if c == "not_null"]
        acc = {col: ACCEPTED[col] for c, col in tests if c == "accepted_values"}
        parts.append(Qy.model_column_checks(m[model], model, nn, acc))
        for c, col in tests:
            if c == "unique":
                parts.append(Qy.summary(c, model, col, Qy.dq_unique(m[model], col)))
            elif c == "relationships":
                parts.append(Qy.summary(c, model, col, Qy.dq_relationships(m[model], m["stg"], col)))
    m = full
    anomalies = {
        "volume_anomalies": Qy.dq_volume(m["ods"], "captured_at", params, since),
        "event_freshness_anomalies": Qy.dq_event_freshness(m["ods"], "departure_at", "captured_at", params, since),
        "column_anomalies": Qy.dq_column_metrics(m["ods"], "captured_at", ["price"], params, since),
        "all_columns_anomalies": Qy.dq_column_metrics(m["dwh"], "captured_date", DWH_COLUMNS, params, since),
        "dimension_anomalies": Qy.dq_dimension(m["dwh"], "captured_date", ["route_origin", "route_destination"], params, since),
        "freshness_anomalies": Qy.dq_freshness(m["dwh"], "captured_date", params, since),
    }
    for check, model, col, sev in ANOMALY_TESTS:
        parts.append(Qy.summary(check, model, col, anomalies[check].filter("is_anomaly"), severity=sev))
    return Qy.union_all(parts)


def report_sql() -> str:
    ctes = (
        DIRTY_MODELS
        + volume_ctes("ods", "captured_at", "a_vol")
        + freshness_event_ctes("ods", "departure_at", "captured_at", "a_efr")
        + column_metrics_ctes("ods", "captured_at", {"price": "decimal"}, "a_col")
        + column_metrics_ctes("dwh", "captured_date", DWH_KINDS, "a_all")
        + dimension_ctes("dwh", "captured_date", ["route_origin", "route_destination"], "a_dim")
        + freshness_ctes("dwh", "captured_date", "a_fr")
    )
    rows = []

    def row(check, model, col, failing_count_sql, sev="error"):
        colv = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
        rows.append(
            f"SELECT '{check}' AS check_name, '{model}' AS model, {colv} AS column_name, CAST(f AS BIGINT) AS failures, '{sev}' AS severity, "
            f"CASE WHEN f = 0 THEN 'pass' WHEN '{sev}' = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ({failing_count_sql}) AS c(f)"
        )

    for check, model, col in GENERIC_TESTS:
        if check == "unique":
            row(check, model, col, f"SELECT COUNT(*) FROM (SELECT {col} FROM {model} GROUP BY {col} HAVING COUNT(*) > 1) AS u")
        elif check == "not_null":
            row(check, model, col, f"SELECT COUNT(*) FROM {model} WHERE {col} IS NULL")
        elif check == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in ACCEPTED[col])
            row(check, model, col, f"SELECT COUNT(*) FROM {model} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})")
        elif check == "relationships":
            row(check, model, col, f"SELECT COUNT(*) FROM {model} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {col} FROM stg)")
    src = {"volume_anomalies": "a_vol", "event_freshness_anomalies": "a_efr", "column_anomalies": "a_col",
           "all_columns_anomalies": "a_all", "dimension_anomalies": "a_dim", "freshness_anomalies": "a_fr"}
    for check, model, col, sev in ANOMALY_TESTS:
        row(check, model, col, f"SELECT COUNT(*) FROM {src[check]} WHERE is_anomaly", sev)
    return D.query(ctes, "\nUNION ALL ".join(rows))


@register("dq_report", report_sql(), REPORT_COLS)
def dq_report(spark, sf):
    """One observability table over all declared tests (FX1-dirty)."""
    return build_report(_dirty_models(spark, sf), P)


@register("dq_severity", f"SELECT * FROM (\n{report_sql()}\n) AS r WHERE status <> 'pass'", REPORT_COLS)
def dq_severity(spark, sf):
    """Checks that did not pass, with severity and status (warn does
    not abort a run; fail does)."""
    return build_report(_dirty_models(spark, sf), P).filter(F.col("status") != "pass")
