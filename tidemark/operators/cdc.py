"""Routing of change records and application logs to topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Topic names and the tables each capture format forwards.
START_TOPIC = "start_log"
EVENT_TOPIC = "event_log"
ODS_PREFIX = "ods_"
CANAL_TYPES = ["INSERT", "UPDATE"]
INSERT_ONLY_TABLES = ["order_info", "order_detail"]
ANY_TYPE_TABLES = [
    "base_province",
    "user_info",
    "sku_info",
    "base_trademark",
    "base_category3",
    "spu_info",
]


def route_logs(df: DataFrame, value: str = "value") -> DataFrame:
    """(topic, value): records with a ``start`` object go to the start topic, others to events."""
    has_start = F.get_json_object(value, "$.start").isNotNull()
    return df.select(F.when(has_start, START_TOPIC).otherwise(EVENT_TOPIC).alias("topic"), value)


def _envelope(df: DataFrame, value: str) -> DataFrame:
    """type, table and data of each record; a generator, so every record is parsed once."""
    return df.select(F.json_tuple(value, "type", "table", "data").alias("type", "table", "data"))


def route_cdc_canal(df: DataFrame, value: str = "value") -> DataFrame:
    """(topic, value) per element of the ``data`` array of INSERT and UPDATE records."""
    kept = _envelope(df, value).where(F.col("type").isin(CANAL_TYPES) & F.col("table").isNotNull())
    rows = F.explode(F.from_json("data", "array<string>"))
    return kept.select(F.concat(F.lit(ODS_PREFIX), "table").alias("topic"), rows.alias("value"))


def route_cdc_maxwell(
    df: DataFrame,
    value: str = "value",
    insert_only: list[str] = INSERT_ONLY_TABLES,
    any_type: list[str] = ANY_TYPE_TABLES,
    drop_deletes: bool = False,
    versioned: bool = False,
) -> DataFrame:
    """(topic, value) for records with a non-empty ``data`` object.

    Fact tables pass on insert only, dimension tables on every type; other tables are dropped.
    ``versioned`` puts the change's time, position and kind in front of the row's fields, as _ts,
    _pos and _type (the envelope's ts, xoffset and type; 0 where it has none).
    """
    fields = ["type", "table", "data", "ts", "xoffset"]
    records = df.select(F.json_tuple(value, *fields).alias(*fields))
    filled = F.col("data").isNotNull() & (F.col("data") != "{}")  # re-written without spaces
    fact = F.col("table").isin(insert_only) & F.col("type").eqNullSafe("insert")
    dim = F.col("table").isin(any_type)
    if drop_deletes:
        dim = dim & ~F.col("type").eqNullSafe("delete")
    out = F.col("data")
    if versioned:
        out = F.concat(
            F.lit('{"_ts":'), F.coalesce("ts", F.lit("0")), F.lit(',"_pos":'), F.coalesce("xoffset", F.lit("0")),
            F.lit(',"_type":"'), F.coalesce("type", F.lit("")), F.lit('",'), F.substring("data", 2, 2**31 - 1),
        )
    return records.where(filled & (fact | dim)).select(
        F.concat(F.lit(ODS_PREFIX), "table").alias("topic"), out.alias("value")
    )
