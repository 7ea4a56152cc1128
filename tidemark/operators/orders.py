"""Order flow: first-order flag, order/line join, paid-amount allocation, brand statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import MAX_PART_ROWS, assign_parts, fan_out, hot_keys, running_sums, whole_sums


def with_create_date_hour(orders: DataFrame) -> DataFrame:
    """create_date and create_hour cut from ``create_time`` (yyyy-MM-dd HH:mm:ss)."""
    parts = F.split("create_time", " ")
    return orders.withColumns(
        {
            "create_date": F.get(parts, F.lit(0)),
            "create_hour": F.substring_index(F.get(parts, F.lit(1)), ":", 1),
        }
    )


def first_orders(orders: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """(user_id, id): the earliest order of every user who has none on record in ``status``.

    Ties on create_time go to the smaller order id.
    """
    firsts = orders.groupBy("user_id").agg(F.min(F.struct("create_time", "id")).alias("_first"))
    if status is not None:
        consumed = status.where(F.col("if_consumed") == "1").select(
            F.col("user_id").cast("bigint").alias("user_id")
        )
        firsts = firsts.join(consumed, "user_id", "left_anti")
    return firsts.select("user_id", F.col("_first.id").alias("id"))


def first_order_flag(orders: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """if_first_order: "1" on the first order of a new user, "0" on every other order.

    The user key is only used in an aggregate; the flag comes back through the order id, which
    is unique, so a user with very many orders does not unbalance the join.
    """
    firsts = first_orders(orders, status).select("id", F.lit("1").alias("_hit"))
    return (
        orders.join(firsts, "id", "left")
        .withColumn("if_first_order", F.coalesce("_hit", F.lit("0")))
        .drop("_hit")
    )


def consumed_users(orders: DataFrame) -> DataFrame:
    """Status rows to record after a batch of orders."""
    return orders.select(
        F.col("user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed")
    ).distinct()


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    line_id: str = "order_detail_id",
    max_part_rows: int = MAX_PART_ROWS,
    hot: DataFrame | None = None,
    split: bool = True,
) -> DataFrame:
    """Inner join of orders (key order_id) with their lines.

    Lines meet their order on (order_id, part), so an order with very many lines is spread over
    several tasks; ``part`` and ``n_parts`` stay in the result for the allocation.  ``line_id``
    is the numeric line order.  Both sides take the parts of an order from one table of hot orders:
    ``hot``, from ``skew.hot_keys``, by default of the lines.  ``split=False`` says that there is none.
    """
    if not split:
        whole = details.withColumns({"part": F.lit(0), "n_parts": F.lit(None).cast("int")})
        return whole.join(orders, "order_id")
    if hot is None:
        hot = hot_keys(details, "order_id", line_id, max_part_rows)
    lines = assign_parts(details, hot, "order_id", line_id)
    return lines.join(fan_out(orders, hot, "order_id"), ["order_id", "part"])


def proportional_share(final: Column, detail: Column, original: Column) -> Column:
    """final * detail / original in cents, half up; 0 for a zero total.

    64-bit arithmetic where it fits, decimals where the product would overflow.
    """
    doubled = F.try_multiply(F.try_multiply(final, F.lit(2)), detail)
    below = F.nullif(original, F.lit(0).cast("bigint")) * 2
    narrow = F.call_function("div", F.try_add(doubled, original), below)
    exact = final.cast("decimal(19,0)") * detail.cast("decimal(17,0)") * F.lit(2)
    wide = F.call_function("div", exact + original, below)
    return F.coalesce(narrow, wide, F.lit(0).cast("bigint"))


def with_totals(wide: DataFrame, line_order: list[str], split: bool = True) -> DataFrame:
    """``original_cents`` as the sum of the order's lines, without another shuffle of the lines."""
    return whole_sums(wide, "order_id", line_order, {"original_cents": F.col("detail_cents")}, split)


CARRY = ["carry_detail", "carry_given", "carry_lines"]


def allocate_paid_amount(wide: DataFrame, line_order: list[str], split: bool = True) -> DataFrame:
    """Spread each order's paid amount over its lines: adds ``share_cents``.

    Every line gets its proportional share, except that the first line at which the running line
    total reaches the order total takes what is left of the paid amount.  ``wide`` comes from
    ``order_wide`` and has detail_cents >= 0, original_cents and final_cents; ``line_order`` is
    the order of the lines inside their order.  Columns named in CARRY, if present, hold what
    earlier batches already summed, gave out and counted for the order.  ``split=False`` says that
    no order of ``wide`` is in parts.
    """
    detail, original, final = F.col("detail_cents"), F.col("original_cents"), F.col("final_cents")
    summed = running_sums(
        wide.withColumn("_prop", proportional_share(final, detail, original)),
        "order_id",
        line_order,
        {"_before": detail, "_given": F.col("_prop"), "_lines": F.lit(1)},
        split,
    )
    if set(CARRY) <= set(wide.columns):
        summed = summed.withColumns(
            {
                name: F.col(name) + F.coalesce(F.col(carried), F.lit(0))
                for name, carried in zip(["_before", "_given", "_lines"], CARRY)
            }
        )
    reaches = F.col("_before") + detail == original
    # Amounts are never negative, so only a line with a price can be the first to reach a
    # positive total; a zero total is reached by the first line at once.
    takes_rest = reaches & ((detail > 0) | (F.col("_lines") == 0))
    share = F.when(takes_rest, final - F.col("_given")).otherwise(F.col("_prop"))
    return summed.withColumn("share_cents", share).drop(
        "_prop", "_before", "_given", "_lines", "part", "n_parts"
    )


def to_order_wide(joined: DataFrame) -> DataFrame:
    """Shape an allocated order/line join as the wide record (amounts in currency units)."""

    def money(cents: str, name: str) -> Column:
        return (F.col(cents) / 100).alias(name)

    return joined.select(
        "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
        money("price_cents", "sku_price"), "sku_num", "sku_name",
        money("benefit_cents", "benefit_reduce_amount"), money("freight_cents", "feight_fee"),
        money("original_cents", "original_total_amount"),
        money("final_cents", "final_total_amount"),
        money("share_cents", "final_detail_amount"),
        "if_first_order", "province_name", "province_area_code", "user_age_group", "user_gender",
        F.col("create_date").alias("dt"),
        "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
    )


def trademark_stat(wide: DataFrame, by: list[str]) -> DataFrame:
    """Sum of allocated cents per brand; partial sums before the shuffle."""
    return wide.groupBy(*by).agg(F.sum("share_cents").alias("amount_cents"))
