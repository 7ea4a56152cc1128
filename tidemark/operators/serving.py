"""Dashboard and search queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import highlight, previous_day, two_digit_hour, word_tokens
from .dau import dau_hourly, dau_total, new_devices
from .relational import page

# Labels of the day totals.
TOTAL_LABELS = {"dau": "新增日活", "new_mid": "新增设备", "order_amount": "新增交易额"}


def order_amount_total(wide: DataFrame, dt: str) -> DataFrame:
    """Allocated amount of a day; 0 for a day without orders."""
    day = wide.where(F.col("dt") == dt)
    return day.agg(F.coalesce(F.sum("share_cents"), F.lit(0)).cast("bigint").alias("amount_cents"))


def order_amount_hourly(wide: DataFrame, dt: str) -> DataFrame:
    day = wide.where(F.col("dt") == dt)
    return day.groupBy(two_digit_hour(F.col("create_hour")).alias("hr")).agg(
        F.sum("share_cents").alias("amount_cents")
    )


def trademark_top_n(stat: DataFrame, start: str, end: str, n: int) -> DataFrame:
    """Brands by amount inside the open interval (start, end), as chart points (x, y, s)."""
    inside = (F.col("stat_time") > start) & (F.col("stat_time") < end)
    return (
        stat.where(inside)
        .groupBy("trademark_id", "trademark_name")
        .agg(F.sum("amount_cents").alias("y"))
        .orderBy(F.desc("y"), F.asc("trademark_id"))
        .limit(n)
        .select(F.col("trademark_name").alias("x"), "y", F.lit(1).alias("s"))
    )


def realtime_total(logs: DataFrame, dau: DataFrame, wide: DataFrame, dt: str) -> DataFrame:
    """Day totals as (id, name, value) rows."""
    parts = {
        "dau": dau_total(dau, dt),
        "new_mid": new_devices(logs, dt),
        "order_amount": order_amount_total(wide, dt),
    }
    rows = [
        df.select(
            F.lit(name).alias("id"),
            F.lit(TOTAL_LABELS[name]).alias("name"),
            F.col(df.columns[0]).cast("bigint").alias("value"),
        )
        for name, df in parts.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def realtime_hour(df: DataFrame, metric: str, dt: str) -> DataFrame | None:
    """(hr, today, yesterday) over all 24 hours for ``dau`` or ``order_amount``; else None."""
    makers = {"dau": dau_hourly, "order_amount": order_amount_hourly}
    if metric not in makers:
        return None
    spark = df.sparkSession
    hours = spark.range(24).select(two_digit_hour(F.col("id")).alias("hr"))
    days = df.where(
        (F.col("dt") == dt) | (F.col("dt") == previous_day(F.lit(dt)))
    )
    hour = F.col("hr") if metric == "dau" else two_digit_hour(F.col("create_hour"))
    measure = F.lit(1) if metric == "dau" else F.col("share_cents")

    def on_day(test: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(test, measure)), F.lit(0)).cast("bigint").alias(name)

    per_hour = days.groupBy(hour.alias("hr")).agg(
        on_day(F.col("dt") == dt, "today"), on_day(F.col("dt") != dt, "yesterday")
    )
    return hours.join(per_hour, "hr", "left").fillna(0, ["today", "yesterday"])


def sale_detail(
    wide: DataFrame, dt: str, keyword: str, start: int, size: int, text_col: str = "sku_name"
) -> DataFrame:
    """One page of a day's order lines whose product name has a word of the keyword."""
    rows = wide.where(F.col("dt") == dt)
    if keyword:
        words = keyword.lower().split()
        rows = rows.where(F.arrays_overlap(word_tokens(F.col(text_col)), F.array(*map(F.lit, words))))
    return page(rows, [F.asc("order_id"), F.asc("order_detail_id")], start, size)


def buyer_shares(wide: DataFrame, dt: str) -> DataFrame:
    """(kind, label, buyers, share): distinct buyers of a day by age band and by gender."""
    buyers = wide.where(F.col("dt") == dt).select("user_id", "user_age_group", "user_gender").distinct()
    labels = F.array(
        F.struct(F.lit("age").alias("kind"), F.col("user_age_group").alias("label")),
        F.struct(F.lit("gender").alias("kind"), F.col("user_gender").alias("label")),
    )
    counts = (
        buyers.select(F.explode(labels).alias("b"))
        .groupBy("b.kind", "b.label")
        .agg(F.count(F.lit(1)).alias("buyers"))
    )
    totals = counts.groupBy("kind").agg(F.sum("buyers").alias("_all"))
    return (
        counts.join(totals, "kind")
        .withColumn("share", F.round(F.col("buyers") / F.col("_all"), 6))
        .drop("_all")
    )


def province_sales(wide: DataFrame, dt: str | None = None) -> DataFrame:
    """Allocated amount per province, for a day or over everything."""
    rows = wide if dt is None else wide.where(F.col("dt") == dt)
    return rows.groupBy("province_name").agg(F.sum("share_cents").alias("amount_cents"))


def search(
    docs: DataFrame,
    match: str,
    nested_term: str | None,
    order: list[Column],
    offset: int = 0,
    limit: int = 20,
    text_col: str = "name",
) -> DataFrame:
    """Documents with any word of ``match`` and, if given, an actor of exactly that name.

    Adds ``highlighted``; the page is cut before the highlighting.
    """
    words = [w for w in match.lower().split() if w]
    hit = F.arrays_overlap(word_tokens(F.col(text_col)), F.array(*map(F.lit, words)))
    if nested_term is not None:
        hit = hit & F.exists("actorList", lambda a: a["name"] == nested_term)
    found = page(docs.where(hit), order, offset, limit)
    return found.withColumn("highlighted", highlight(F.col(text_col), words))


def get_by_id(df: DataFrame, value: object, id_col: str = "id") -> DataFrame:
    return df.where(F.col(id_col) == F.lit(value))
