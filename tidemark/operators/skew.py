"""Spreading one oversized key over tasks.

A key with more than ``max_rows`` rows is *hot*.  A heavy-hitter sketch of the key column, which map
tasks build and send as a whole, names the candidates without a shuffle by key; only their rows are
counted, and cut into slices by a quantile sketch of the order column, so slices follow the count of
rows and rows of equal order stay together.  The sketch may miss a key with less than 3.5 / 100 000 of
all rows, which is no more than an ordinary task has on a table where that is a million.

All of this is part of one plan.  On data without hot keys the table of hot keys turns out empty when it
is built, and the adaptive planner drops the branches that read it.  It has at most ``MAX_KEYS`` rows of
a key and slice bounds, fewer than rows / max_rows bounds in all (8 bytes each, 10^12 rows: 8 MB), which
is why it may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_PART_ROWS = 1_000_000
MAX_KEYS, TRACKED = 10_000, 100_000
#: Slices of one key at most: a key with more than a thousand times max_rows has larger ones.  Bounds are
#: off by 1 / ACCURACY of the key's rows, less than a slice.
MAX_SLICES, ACCURACY = 1_000, 20_000


def heavy_keys(df: DataFrame, key: str, min_rows: int, max_keys: int = MAX_KEYS, tracked: int = TRACKED) -> DataFrame:
    """(key): candidates for keys with more than min_rows rows, from a sketch of the key column."""
    top = f"approx_top_k(`{key}`, {max_keys}, {tracked})"
    found = df.where(F.col(key).isNotNull()).agg(F.expr(top).alias("top")).select(F.inline("top"))
    return found.where(F.col("count") > min_rows).select(F.col("item").alias(key))


def hot_keys(
    df: DataFrame, key: str, order_col: str, max_rows: int = MAX_PART_ROWS, also: DataFrame | None = None
) -> DataFrame:
    """(key, n_parts, bounds): keys with more than max_rows rows and the last order value of every slice
    but the last; a null order is in the first.  The keys of ``also`` are counted like those that the sketch names."""
    candidates = heavy_keys(df, key, max_rows)
    if also is not None:
        candidates = candidates.union(also).distinct()
    mine = df.select(key, order_col).join(F.broadcast(candidates), key)
    slices = F.least(F.ceil(F.count(F.lit(1)) / F.lit(max_rows)).cast("int"), F.lit(MAX_SLICES))
    # one text literal plans faster than a thousand numbers
    grid = F.split(F.lit(",".join(str(i / MAX_SLICES) for i in range(1, MAX_SLICES))), ",").cast("array<double>")
    stats = mine.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        slices.alias("_slices"),
        F.percentile_approx(F.col(order_col).cast("double"), grid, ACCURACY).alias("_grid"),
    )
    # every slice ends at the grid point nearest to its share; equal bounds are one
    bounds = F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.col("_slices") - 1),
            lambda i: F.get("_grid", F.round(i * MAX_SLICES / F.col("_slices")).cast("int") - 1),
        )
    )
    hot = stats.where(F.col("n_rows") > max_rows).select(key, bounds.alias("bounds"))
    return hot.select(key, (F.size("bounds") + 1).alias("n_parts"), "bounds")


def assign_parts(df: DataFrame, hot: DataFrame, key: str, order_col: str) -> DataFrame:
    """Add ``part``: 0, or for hot keys the number of slices that end below the row's order.

    ``part`` never decreases along the order column.  ``n_parts`` stays null for other keys.
    """
    x = F.col(order_col).cast("double")
    part = F.when(F.col("n_parts").isNotNull(), F.size(F.filter("bounds", lambda b: b < x)))
    return (
        df.join(F.broadcast(hot), key, "left")
        .withColumn("part", F.greatest(F.coalesce(part, F.lit(0)), F.lit(0)))
        .drop("bounds")
    )


def fan_out(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat the row of each hot key once per part, so that it meets every slice of that key."""
    marked = df.join(F.broadcast(hot.select(key, "n_parts")), key, "left")
    return _repeat(marked, F.coalesce(F.col("n_parts"), F.lit(1))).drop("n_parts")


def _repeat(df: DataFrame, n_parts: Column) -> DataFrame:
    return df.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))


def _part_totals(df: DataFrame, key: str, sums: dict[str, Column]) -> DataFrame:
    """Sums per slice of the hot keys, named with an underscore in front."""
    return (
        df.where(F.col("n_parts") > 1)
        .groupBy(key, "part")
        .agg(*[F.sum(col).alias(f"_{name}") for name, col in sums.items()])
    )


def whole_sums(
    df: DataFrame, key: str, order_by: list[str | Column], sums: dict[str, Column], split: bool = True
) -> DataFrame:
    """Sums over all rows of a key, on every row.

    The window has the order of ``running_sums``, so that one sort serves both.  ``split=False`` says that
    no key is hot.
    """
    everything = Window.partitionBy(key, "part").orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    local = df.withColumns({name: F.sum(col).over(everything) for name, col in sums.items()})
    if not split:
        return local
    totals = _part_totals(df, key, sums).groupBy(key).agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    return (
        local.join(F.broadcast(totals), key, "left")
        .withColumns({name: F.coalesce(F.col(f"_{name}"), F.col(name)) for name in sums})
        .drop(*[f"_{name}" for name in sums])
    )


def running_sums(
    df: DataFrame, key: str, order_by: list[str | Column], sums: dict[str, Column], split: bool = True
) -> DataFrame:
    """Exclusive running sums per key over rows that carry ``part`` and ``n_parts``.

    Each (key, part) is summed on its own; the totals of earlier parts are added for hot keys
    only.  There are at most 2 R / max_rows such totals, so they are broadcast.  ``split=False``
    says that no key is hot.
    """
    before = Window.partitionBy(key, "part").orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = df.withColumns(
        {name: F.coalesce(F.sum(col).over(before), F.lit(0)) for name, col in sums.items()}
    )
    if not split:
        return local
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _part_totals(df, key, sums).select(
        key, "part", *[F.sum(f"_{name}").over(earlier).alias(f"_{name}") for name in sums]
    )
    return (
        local.join(F.broadcast(offsets), [key, "part"], "left")
        .withColumns(
            {name: F.col(name) + F.coalesce(F.col(f"_{name}"), F.lit(0)) for name in sums}
        )
        .drop(*[f"_{name}" for name in sums])
    )
