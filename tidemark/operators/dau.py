"""Daily actives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import day_of_millis, hour_of_millis
from .relational import keep_first


def with_day_hour(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """dt and hr from epoch milliseconds."""
    return df.withColumns({"dt": day_of_millis(F.col(ts_col)), "hr": hour_of_millis(F.col(ts_col))})


def daily_first(logs: DataFrame, device: str = "mid", ts_col: str = "ts") -> DataFrame:
    """The first record of each device on each day."""
    return keep_first(logs, ["dt", device], [ts_col])


def dau_total(dau: DataFrame, dt: str) -> DataFrame:
    return dau.where(F.col("dt") == dt).agg(F.count(F.lit(1)).alias("dau"))


def dau_hourly(dau: DataFrame, dt: str) -> DataFrame:
    """Devices first seen per hour of a day."""
    return dau.where(F.col("dt") == dt).groupBy("hr").agg(F.count(F.lit(1)).alias("dau"))


def new_devices(logs: DataFrame, dt: str, device: str = "mid") -> DataFrame:
    """Number of devices whose first day ever is dt."""
    first_day = logs.groupBy(device).agg(F.min("dt").alias("_first"))
    return first_day.where(F.col("_first") == dt).agg(F.count(F.lit(1)).alias("new_mid"))
