"""Mixing sources to target weights along a curriculum, with DataFrame functions only.

Every source is a stream of tokens: its documents in the order of the md5 of their id, again and
again.  A source's demand over training time t in [0, 1] is target * f(t), where the schedule f is a
ramp from ``ramps[i][0]`` to ``ramps[i][1]`` with mean 1.  Its integral e0 * t + (e1 - e0) / 2 * t * t
is inverted in closed form: the copy of a document that starts at token c of the stream is needed at
the time when the integral reaches c / target.  Sorting by that position mixes the sources as the
schedules say at every moment.

The start of a document in its source's stream is a running sum.  A source may hold most rows, so
no window sees a whole source: each source is cut by hash into about sqrt(rows) cells, cell totals
are summed first, and rows are summed within their cell.  Only the table of sources (one row each)
is ordered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import word_count, words
from tidemark.session import stored

WEIGHTS = (1, 2, 3)
#: Schedules by weight: sources of weight 1 fade out, those of weight 3 fade in.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def _cycle(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), ((rank - 1) % len(values) + 1).cast("int"))


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = 3,
    ramps: tuple[tuple[float, float], ...] = RAMPS,
) -> DataFrame:
    """Targets per source from rows (source, source_size, source_rows).

    Sources by code point, null last, take the weights in turn and share the total size by weight;
    a target stops at cap times the source's size and the excess goes to the others by weight.  With
    sources in order of cap * size / weight, the common level is the largest of the levels that
    result if all sources before one are full, so no loop is needed.  All targets are 0 if all sizes are.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(order))
    ranked = ranked.withColumn("weight", _cycle(weights, F.col("rank")))
    ranked = ranked.withColumn("full", cap * F.col("source_size"))
    fill = Window.orderBy((F.col("full") / F.col("weight")).asc(), F.col("rank").asc())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levels = ranked.withColumn("level", level).withColumn("top", F.max("level").over(every))
    return levels.select(
        "source",
        "source_size",
        "source_rows",
        F.least(F.col("full").cast("double"), F.col("top") * F.col("weight")).alias("target"),
        _cycle(tuple(r[0] for r in ramps), F.col("rank")).alias("e0"),
        _cycle(tuple(r[1] for r in ramps), F.col("rank")).alias("e1"),
    )


def assign(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = 3,
    ramps: tuple[tuple[float, float], ...] = RAMPS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Per row of docs (doc_id, text, source, ...): its size, its source's figures and its passes.

    Result: ``doc`` (struct of the input columns, or of ``columns``), ``size``, ``source_size``,
    ``target``, ``taken`` and ``passes``, an array of (pass, take, position) with take > 0.  The last
    document of a source may be taken in part.  Nulls: a null text has size 0, null is a source of its
    own, a null doc_id counts as an empty id.  The order inside a source is a hash of id and text, so rows
    without an id or with the same one agree between runs; rows equal in both are rows of their own and
    may change places.  An empty table
    gives an empty result.  Extra columns stay inside ``doc`` and cannot clash.
    """
    keep = columns or docs.columns
    rows = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"),
            F.col("source").alias("source"),
            word_count(F.col("text")).alias("size"),
            F.md5(
                F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit(""))).cast("binary")
            ).alias("key"),
        ),
        "mix-rows",
    )
    totals = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    targets = stored(source_targets(totals, weights, cap, ramps), "mix-targets")
    digits = F.round(F.log2(F.col("source_rows")) / 8).cast("int")
    joined = rows.withColumnRenamed("source", "of").join(targets, F.col("of").eqNullSafe(F.col("source")))
    celled = joined.drop("of").withColumn("cell", F.substr("key", F.lit(1), digits))
    sums = celled.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    earlier = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = sums.select(
        F.col("source").alias("of"),
        F.col("cell").alias("in_cell"),
        F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("base"),
    )
    placed = celled.join(
        cells, F.col("of").eqNullSafe(F.col("source")) & (F.col("in_cell") == F.col("cell"))
    )
    inside = Window.partitionBy("source", "cell").orderBy("key", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    demand = F.round("target").cast("long")
    placed = placed.withColumn("start", start).withColumn("demand", demand)

    def one_pass(p: int) -> Column:
        at = F.col("start") + p * F.col("source_size")
        share = at / F.greatest(F.col("demand"), F.lit(1))
        e0, e1 = F.col("e0"), F.col("e1")
        return F.struct(
            F.lit(p).alias("pass"),
            F.greatest(F.lit(0), F.least(F.col("size"), F.col("demand") - at)).alias("take"),
            (2 * share / (e0 + F.sqrt(F.greatest(F.lit(0.0), e0 * e0 + 2 * (e1 - e0) * share)))).alias("position"),
        )

    passes = F.filter(F.array(*[one_pass(p) for p in range(math.ceil(cap))]), lambda x: x["take"] > 0)
    return placed.select("doc", "size", "source_size", "target", passes.alias("passes")).withColumn(
        "taken", F.aggregate("passes", F.lit(0).cast("long"), lambda a, x: a + x["take"])
    )


def training_order(assigned: DataFrame) -> DataFrame:
    """One row per document and pass, range-sorted by training position."""
    return (
        assigned.select("doc", "size", F.explode("passes").alias("p"))
        .select("doc", "size", "p.pass", "p.take", "p.position")
        .orderBy("position", "pass", "doc.doc_id")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix in training order, with the columns of docs.

    A document comes once per pass; where a pass takes only part of it, its text is cut to the first
    ``take`` words, joined by spaces.
    """
    rows = training_order(assign(docs, **options))
    text = F.when(F.col("take") >= F.col("size"), F.col("doc.text")).otherwise(
        F.array_join(F.slice(words(F.col("doc.text")), F.lit(1), F.col("take").cast("int")), " ")
    )
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
