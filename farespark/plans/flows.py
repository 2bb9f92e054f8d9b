"""Layer chains over the fixtures: raw -> STG base -> STG -> ODS -> DWH / DM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from farespark.operators.ingest import to_stg_base
from farespark.params import DEFAULT, Params
from farespark.plans import models
from farespark.sources.fixtures import fx1_raw, fx2_raw

# Fixed run timestamp for defaults (reruns must agree; equals RUN_TS of the SQL twin).
RUN_TS = dt.datetime(2024, 2, 1)


def stg_base_of(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    return to_stg_base(raw, RUN_TS, params)


def ods_of(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    return models.ods(models.stg(stg_base_of(raw, params)), params)


def fx1_stg_base(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> DataFrame:
    return stg_base_of(fx1_raw(spark, sf_dir), params)


def fx1_stg(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> DataFrame:
    return models.stg(fx1_stg_base(spark, sf_dir, params))


def fx1_ods(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> DataFrame:
    return models.ods(fx1_stg(spark, sf_dir, params), params)


def fx2_ods(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> DataFrame:
    return ods_of(fx2_raw(spark, sf_dir), params)
