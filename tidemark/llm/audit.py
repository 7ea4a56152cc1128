"""Filter interaction audit: what every filter removes in every order of applying them.

A chain of n filters walks the lattice of subsets: a state is the set of filters applied so far, an
edge adds one filter.  ``forward`` counts the orders that reach a state from the empty one,
``backward`` those that lead from it to the full one, so an edge lies on forward * backward orders.
The corpus is read once, into one number of documents per set of failed filters; what an edge removes
is the number of documents that fail its filter and none applied before.  The sum over all orders
(Shapley) weighs the edges of a filter with their orders, and the steps of one order are read from the
edges on its path, so no order is ever run over documents.

The lattice has 2 ** n states and the report n! orders; both depend on the number of filters only.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import UPPER, let, words

#: Map key under which all documents of a part are counted.
EVERY = -1


def lattice(n: int) -> tuple[list[int], list[int]]:
    """(forward, backward): orders that reach and that leave every state of n filters."""
    size = 1 << n
    forward, backward = [1] + [0] * (size - 1), [0] * (size - 1) + [1]
    for state in range(1, size):
        forward[state] = sum(forward[state ^ (1 << f)] for f in range(n) if state >> f & 1)
    for state in range(size - 2, -1, -1):
        backward[state] = sum(backward[state | (1 << f)] for f in range(n) if not state >> f & 1)
    return forward, backward


def edge(state: int, f: int, n: int) -> int:
    """Number of the edge that applies filter f after those in state."""
    return state * n + f


def removals(spark: SparkSession, n: int) -> DataFrame:
    """(mask, edge): the edges on which a document that fails the filters of mask is removed."""
    rows = [
        (mask, edge(state, f, n))
        for mask in range(1 << n)
        for state in range(1 << n)
        if not mask & state
        for f in range(n)
        if mask >> f & 1
    ]
    rows += [(mask, EVERY) for mask in range(1 << n)]
    return spark.createDataFrame(rows, "mask int, edge int")


def steps(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """One row per order and step: its edge, the edges up to it and the weighted edges of its filter."""
    n = len(names)
    forward, backward = lattice(n)
    full = (1 << n) - 1
    weighted = {
        f: [(edge(s, f, n), forward[s] * backward[s | 1 << f]) for s in range(1 << n) if not s >> f & 1]
        for f in range(n)
    }
    rows = []
    for order in permutations(range(n)):
        state, path = 0, []
        for step, f in enumerate(order, 1):
            path.append(edge(state, f, n))
            rows.append((
                len(rows), "".join(names[i] for i in order), step, list(path),
                edge(0, f, n), edge(full ^ 1 << f, f, n), weighted[f],
            ))
            state |= 1 << f
    return spark.createDataFrame(
        rows,
        "k int, filter_order string, step int, path array<int>, alone int, last int, "
        "weighted array<struct<edge:int,orders:long>>",
    )


def report(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per part, order and step what the step keeps and removes.

    counts: part, mask (int, bit i set: filter i of names fails), n, good, toxic (sums, any number of
    rows per part and mask).  Parts come from counts; a part has a row for every step, zeros included.
    """
    spark, n = counts.sparkSession, len(names)
    # n * 3 ** (n - 1) + 2 ** n and n * n! rows, whatever the data
    hits, grid = F.broadcast(removals(spark, n)), F.broadcast(steps(spark, names))
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    edges = counts.groupBy("part", "mask").agg(*sums).join(hits, "mask").groupBy("part", "edge").agg(*sums)
    # at most one entry per edge of the lattice
    parts = edges.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("edge", F.struct("n", "good", "toxic")))).alias("at")
    )
    n_rows = n * len(list(permutations(names)))
    rows = parts.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))).join(grid, "k")

    def on(e: Column, what: str = "n") -> Column:
        return F.coalesce(F.try_element_at("at", e)[what], F.lit(0).cast("long"))

    here = F.element_at("path", -1)
    gone = F.aggregate("path", F.lit(0).cast("long"), lambda total, e: total + on(e))
    shapley = F.aggregate(
        "weighted", F.lit(0).cast("long"), lambda total, e: total + e["orders"] * on(e["edge"])
    )
    return rows.select(
        "part", "filter_order", "step",
        (on(F.lit(EVERY)) - gone).alias("kept"),
        on(here).alias("removed"),
        (on(F.col("alone")) - on(here)).alias("redundant"),
        on(F.col("last")).alias("unique_fails"),
        on(here, "good").alias("good_lost"),
        on(here, "toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: few words, few distinct words, many capitals, special characters."""

    def bits(w: Column) -> Column:
        short = F.size(w) < 200
        repeated = 100 * F.size(F.array_distinct(w)).cast("long") < 50 * F.size(w).cast("long")
        return short.cast("int") + repeated.cast("int") * 2

    # removing ASCII letters changes the number of bytes by one each
    capitals = (F.octet_length(text) - F.octet_length(F.translate(text, UPPER, ""))).cast("long")
    loud = 100 * capitals > 3 * F.length(text).cast("long")
    return let(words(text), bits) + loud.cast("int") * 4 + text.rlike(r"[#$%&*|]").cast("int") * 8


NAMES = "ABCDE"


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``report`` of five filters over documents, per language.

    A: under 200 words.  B: less than half of the words distinct.  C: over 3 % capitals.  D: holds one
    of ``#$%&*|``.  E: identical to the text of a smaller doc_id anywhere in the table.

    docs: doc_id, text, lang; labels: doc_id, quality, toxic; other columns are not read.  A null text
    is an empty one, a null lang an empty string.  A null doc_id counts as larger than all others and
    has no label; rows that share a doc_id are no copies of each other and all carry its labels, and a
    document is good or toxic if any label of its id says so.  Empty documents give an empty report.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(text.cast("binary"), 256)).alias("key")
    rows = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), key, text_failures(text).alias("bits")
    )
    # a row per text that occurs more than once; map tasks send one row per text each
    firsts = (
        docs.select("doc_id", key)
        .groupBy("key")
        .agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("times"))
        .where("times > 1 and first is not null")
        .select("key", "first")
    )
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"),
        F.max((F.col("toxic") == 1).cast("long")).alias("toxic"),
    )
    marks = marks.where("doc_id is not null and (good = 1 or toxic = 1)")
    copy = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("first") < F.col("doc_id")))
    judged = rows.join(firsts, "key", "left").join(marks, "doc_id", "left")
    counts = judged.groupBy("part", (F.col("bits") + copy.cast("int") * 16).alias("mask")).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )
    return report(counts, NAMES)
