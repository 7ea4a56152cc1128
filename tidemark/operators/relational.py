"""Lookup joins, top-N per group and list assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def enrich(
    facts: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    cols: dict[str, str],
    fill: dict[str, object] | None = None,
) -> DataFrame:
    """Left lookup: keep every fact, add the renamed columns of its dimension row.

    ``on`` maps fact columns to dimension columns, ``cols`` maps dimension columns to output
    names.  Keys are compared as bigint when the two types differ (string ids against long ids).
    The side to broadcast is left to the planner, which checks sizes; a hot fact key in a
    shuffled join is split by the adaptive skew join.
    ``fill`` gives values for unmatched output columns, such as 0 for ids.
    """
    ftypes, dtypes = dict(facts.dtypes), dict(dim.dtypes)
    keys, cond = [], F.lit(True)
    for i, (fcol, dcol) in enumerate(on.items()):
        name = f"_k{i}"
        same = ftypes[fcol] == dtypes[dcol]
        keys.append((F.col(dcol) if same else F.col(dcol).try_cast("bigint")).alias(name))
        left = facts[fcol] if same else facts[fcol].try_cast("bigint")
        cond = cond & (left == F.col(name))
    side = dim.select(*keys, *[F.col(c).alias(out) for c, out in cols.items()])
    joined = facts.join(side, cond, "left").drop(*[f"_k{i}" for i in range(len(keys))])
    return joined.fillna(fill) if fill else joined


def top_n_per_group(
    df: DataFrame, key: str | list[str], order: list[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First n rows of each group with their rank.

    The planner cuts every map task's share of a group to n rows before the shuffle, so a hot
    group sends n rows per task, not its whole content.
    """
    keys = [key] if isinstance(key, str) else key
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def collect_recs(df: DataFrame, key: str, n: int, item: str = "mid", score: str = "score") -> DataFrame:
    """Nest the n best rows of each key into ``recs``: array<struct<mid, score>>, best first.

    n is required: a list without a limit belongs in a long table, not in one row.
    """
    best = top_n_per_group(df, key, [F.desc(score), F.asc(item)], n, "_rank")
    ordered = F.sort_array(F.collect_list(F.struct("_rank", F.col(item), F.col(score))))
    recs = F.transform(ordered, lambda r: F.struct(r[item].alias(item), r[score].alias(score)))
    return best.groupBy(key).agg(recs.alias("recs"))


def explode_recs(df: DataFrame, key: str) -> DataFrame:
    """Back from nested lists to (key, rank, mid, score) rows."""
    return df.select(key, F.posexplode("recs").alias("pos", "rec")).select(
        key, (F.col("pos") + 1).alias("rank"), "rec.*"
    )


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest by the order columns, then by the other columns.

    An aggregate, not a window: each map task reduces its rows before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the largest by the order columns, then by the other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def page(df: DataFrame, order: list[Column], offset: int, size: int) -> DataFrame:
    """Rows offset .. offset+size of the ordered result."""
    return df.orderBy(*order).offset(offset).limit(size)


def word_count(df: DataFrame, col: str) -> DataFrame:
    """(word, n) over the lower-case words of a text column; counted per task before the shuffle."""
    words = df.select(F.explode(F.split(F.lower(col), r"[^\p{L}\p{N}]+")).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def rename_to(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename columns by position to a target table's columns."""
    return df.withColumnsRenamed(dict(zip(df.columns, names, strict=True)))
