"""Toxicity by the nearest labelled examples, found exactly in a block-max inverted index.

Terms of a text are its words (runs of letters, lower case), the first four to six letters of longer
words, and for those a term each if they begin at least two, four or eight words.  The space holds the terms that a likelihood-ratio test on the
examples ties to the label; a vector has weight (1 + log tf) * idf per such term and unit length.  Most
clean texts have no such term, hence no neighbour, and get the rate of examples like that.

The examples lie in an inverted index.  They are numbered so that similar ones are close and cut into
blocks of ``BLOCK``; every term knows its largest weight per block.  For a text, the sum of those weights
bounds the cosine of all examples of a block.  Blocks are scored exactly from the highest bound down, until
the bound of the next one is below the k-th best cosine found, so the k nearest are exact.

Neighbours vote with weight 1 / (NEAR + 1 - cosine) times the weight of their class (examples are drawn
per class); the share of toxic votes goes through a logistic curve fitted on leave-one-out shares of the
examples.  The neighbours are returned as evidence.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, with_doc
from tidemark.session import stored

ship(__name__)

LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES, OFTEN, BLOCK, K, NEAR, SLACK = (4, 5, 6), (2, 4, 8), 32, 16, 0.05, 1e-9
EVIDENCE = "array<struct<doc_id:long,cosine:double,toxic:int>>"


def terms(text: str | None) -> Counter:
    """Term counts of a text; a prefix has "^" in front, "*n" says that it begins n words or more."""
    words = Counter(LETTERS.findall((text or "").lower()))
    starts: Counter = Counter()
    for w, n in words.items():
        for size in PREFIXES:
            if len(w) > size:
                starts["^" + w[:size]] += n
    often = {f"{t}*{least}": 1 for t, n in starts.items() for least in OFTEN if n >= least}
    return Counter({**words, **starts, **often})


def ratio(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Log-likelihood ratio of term and label from the examples of either class that have the term."""
    n, have = n_toxic + n_clean, toxic + clean

    def part(seen, row, column):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) * n / np.maximum(row * column, 1e-12)), 0.0)

    return 2 * (
        part(toxic, have, n_toxic) + part(clean, have, n_clean)
        + part(n_toxic - toxic, n - have, n_toxic) + part(n_clean - clean, n - have, n_clean)
    )


@dataclass
class Index:
    """Postings by (term, block): entries of cell c are at[c]:at[c + 1]; cells of term t are of[t]:of[t + 1]."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    of: np.ndarray
    block: np.ndarray
    top: np.ndarray
    at: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    class_weight: np.ndarray
    #: rate of toxic examples among those without a term of the space
    rest: float
    slope: float
    shift: float

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)


def vector(index: Index, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers in order and weights of unit length."""
    known = index.vocabulary
    words = Counter(LETTERS.findall((text or "").lower()))
    found: dict[int, int] = {}
    starts: Counter = Counter()
    for w, n in words.items():
        if w in known:
            found[known[w]] = n
        for size in PREFIXES:
            if len(w) > size and (start := "^" + w[:size]) in known:
                starts[start] += n
    for start, n in starts.items():
        found[known[start]] = n
        for least in OFTEN:
            if n >= least and (t := known.get(f"{start}*{least}")) is not None:
                found[t] = 1
    t = np.array(sorted(found), np.int64)
    w = (1 + np.log(np.array([found[i] for i in t], np.float64))) * index.idf[t]
    return t, w / max(1e-300, math.sqrt(float((w * w).sum())))


def spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """start, start + 1 ... end - 1 of every span, joined."""
    sizes = ends - starts
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return np.arange(int(sizes.sum())) + shift


def nearest(index: Index, t: np.ndarray, w: np.ndarray, k: int = K, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """The k examples with the highest positive cosine, best first, ties by number; ``without`` is left out."""
    cells = spans(index.of[t], index.of[t + 1])
    if not len(cells):
        return np.zeros(0, np.int64), np.zeros(0)
    q = np.repeat(w, index.of[t + 1] - index.of[t])
    bounds = np.bincount(index.block[cells], q * index.top[cells], index.blocks)
    order = np.argsort(-bounds, kind="stable")
    order = order[bounds[order] > 0]
    ids, scores, done, step = np.zeros(0, np.int64), np.zeros(0), 0, 2
    rank = np.full(index.blocks, -1, np.int64)
    while done < len(order):
        if len(ids) == k and bounds[order[done]] < scores[-1] - SLACK:
            break
        now = order[done : done + step]
        rank[now] = np.arange(len(now))
        mine = rank[index.block[cells]] >= 0
        posts = spans(index.at[cells[mine]], index.at[cells[mine] + 1])
        own = np.repeat(q[mine], index.at[cells[mine] + 1] - index.at[cells[mine]])
        e = index.example[posts]
        local = rank[e // BLOCK] * BLOCK + e % BLOCK
        found = np.bincount(local, own * index.weight[posts], len(now) * BLOCK)
        hit = np.flatnonzero(found)
        number = now[hit // BLOCK] * BLOCK + hit % BLOCK
        keep = number != without
        ids, scores = np.concatenate([ids, number[keep]]), np.concatenate([scores, found[hit][keep]])
        best = np.lexsort((ids, -scores))[:k]
        ids, scores = ids[best], scores[best]
        rank[now] = -1
        done, step = done + len(now), step * 4
    return ids, scores


def share(index: Index, ids: np.ndarray, scores: np.ndarray) -> float:
    """Share of toxic votes; one vote of the texts without neighbours evens out faint ones."""
    vote = index.class_weight[ids] / (NEAR + 1 - np.minimum(scores, 1.0))
    return float(((vote * index.toxic[ids]).sum() + index.rest) / (vote.sum() + 1))


def curve(index: Index, x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, index.slope * x + index.shift))))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with targets inside (0, 1) and a small ridge."""
    n = [(weight * (y == c)).sum() for c in (0, 1)]
    target = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    design, theta = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (weight * (p - target)) + 1e-2 * theta
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(theta[0], 0.0)), float(theta[1])


def build(
    vocabulary: list[str], df: np.ndarray, n: int, ids: list, toxic: list, rows: list[Counter], class_weight: list
) -> Index:
    """Index of examples given by the counts of their terms in the vocabulary."""
    index = Index(
        {t: i for i, t in enumerate(vocabulary)}, np.log((n + 1) / (df + 0.5)), *[np.zeros(0)] * 6,
        np.array(ids, np.int64), np.array(toxic, np.int64), np.array(class_weight, np.float64), 0.0, 1.0, 0.0,
    )
    vectors = []
    for row in rows:
        t = np.array(sorted(index.vocabulary[x] for x in row), np.int64)
        w = np.array([1 + math.log(row[vocabulary[i]]) for i in t]) * index.idf[t] if len(t) else np.zeros(0)
        vectors.append((t, w / max(1e-300, math.sqrt(float((w * w).sum())))))
    # examples of the same strongest terms come together; those without terms come last
    lead = [tuple(t[np.argsort(-w, kind="stable")][:2]) or (len(vocabulary),) for t, w in vectors]
    order = sorted(range(len(rows)), key=lambda i: (lead[i], index.ids[i], index.toxic[i]))
    for name in ("ids", "toxic", "class_weight"):
        setattr(index, name, getattr(index, name)[order])
    t = np.concatenate([np.zeros(0, np.int64), *[vectors[i][0] for i in order]])
    w = np.concatenate([np.zeros(0), *[vectors[i][1] for i in order]])
    e = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
    sort = np.lexsort((e, t))
    t, w, e = t[sort], w[sort], e[sort]
    cell = t * max(1, index.blocks) + e // BLOCK
    cells, at = np.unique(cell, return_index=True)
    empty = np.array([not len(vectors[i][0]) for i in order], bool)
    cw, y = index.class_weight, index.toxic
    return replace(
        index,
        of=np.searchsorted(cells // max(1, index.blocks), np.arange(len(vocabulary) + 1)),
        block=cells % max(1, index.blocks),
        top=np.maximum.reduceat(w, at) if len(w) else w,
        at=np.append(at, len(w)),
        example=e,
        weight=w,
        rest=float(((cw * y)[empty].sum() + 0.5 * cw.sum() / max(1, len(cw)) * 0.1) / (cw[empty].sum() + 1)) if len(cw) else 0.5,
    )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per term and task, the examples of either class that have it; the sample bounds the tables."""
    toxic, clean = Counter(), Counter()
    for b in batches:
        for y, text in zip(b["y"].to_pylist(), b["text"].to_pylist()):
            (toxic if y else clean).update(set(terms(text)))
    names = list(set(toxic) | set(clean))
    for at in range(0, len(names), 1 << 16):
        part = names[at : at + (1 << 16)]
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(part, pa.string()),
            "toxic": pa.array([toxic[t] for t in part], pa.int64()),
            "clean": pa.array([clean[t] for t in part], pa.int64()),
        })


def _project(vocabulary: list[str]):
    known = set(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{t: n for t, n in terms(x).items() if t in known} for x in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["y"], pa.array([list(r) for r in rows], pa.list_(pa.string())),
                 pa.array([list(r.values()) for r in rows], pa.list_(pa.int32()))],
                ["doc_id", "y", "terms", "counts"],
            )

    return run


def fit(
    docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, max_terms: int = 2_048, alpha: float = 1e-2
) -> Index:
    """The index of at most ``max_rows`` labelled texts, half of them per class, the first by hash of their id.

    docs: doc_id, text; labels: doc_id, toxic (null: not labelled).  A repeated doc_id counts once, with
    its first text in order and as toxic if any label says so; equal texts of a class count once.  Terms
    need a likelihood ratio whose probability by chance is below ``alpha`` over all terms; the strongest
    ``max_terms`` stay, so the index has at most max_rows * max_terms postings, 16 bytes each, usually a
    few per row.  Without labels every text scores 0.5.
    """
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    known = known.where("y is not null").withColumn("y", (F.col("y") == 1).cast("int"))
    half = max(1, max_rows // 2)
    drawn = [known.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half) for c in (0, 1)]
    chosen = stored(drawn[0].unionByName(drawn[1]), "toxic-labels")
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # at most max_rows rows of twelve bytes
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    sample = stored(sample.groupBy("text", "y").agg(F.min("doc_id").alias("doc_id")), "toxic-sample")
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    counts = sample.select("y", "text").mapInArrow(_counts, "term string, toxic long, clean long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # a term of fewer examples cannot pass the test: its ratio is below 2 * n * log(all / smaller class)
    rare = min(n_toxic, n_clean) or 1
    vocabulary_size = counts.count()
    # two-sided normal tail, one degree of freedom
    level = 2 * math.log(max(1, vocabulary_size) / alpha)
    least = level / (2 * math.log(max(2.0, (n_toxic + n_clean) / rare)))
    found = counts.where(F.col("toxic") + F.col("clean") >= F.lit(least)).toPandas()
    g = ratio(found["toxic"].to_numpy(float), found["clean"].to_numpy(float), n_toxic, n_clean) if len(found) else np.zeros(0)
    found = found[g >= level].assign(g=g[g >= level]).sort_values(["g", "term"], ascending=[False, True])[:max_terms]
    vocabulary = found["term"].tolist()
    rows = sample.mapInArrow(_project(vocabulary), "doc_id long, y int, terms array<string>, counts array<int>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["y"]))
    weight = {c: totals.get(c, 0) / max(1, sizes.get(c, 0)) for c in (0, 1)}
    index = build(
        vocabulary, (found["toxic"] + found["clean"]).to_numpy(float), n_toxic + n_clean,
        [r["doc_id"] for r in rows], [r["y"] for r in rows], [Counter(dict(zip(r["terms"], r["counts"]))) for r in rows],
        [weight[r["y"]] for r in rows],
    )
    if not rows:
        return replace(index, slope=0.0)
    return fit_curve(docs.sparkSession, index)


def fit_curve(spark, index: Index) -> Index:
    """The index with a curve fitted on the shares its examples get from all others."""
    sent = spark.sparkContext.broadcast(pickle.dumps(index))
    n = len(index.ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pickle.loads(sent.value)
        by_example = np.argsort(held.example, kind="stable")
        at = np.searchsorted(held.example[by_example], np.arange(len(held.ids) + 1))
        term = np.searchsorted(held.at, np.arange(len(held.example)), side="right") - 1  # cell of every posting
        of_cell = np.searchsorted(held.of, np.arange(len(held.block)), side="right") - 1
        for b in batches:
            out = []
            for i in b["id"].to_pylist():
                mine = by_example[at[i] : at[i + 1]]
                ids, scores = nearest(held, of_cell[term[mine]], held.weight[mine], without=i)
                out.append(share(held, ids, scores))
            yield pa.RecordBatch.from_pydict({"id": b["id"], "x": pa.array(out, pa.float64())})

    got = spark.range(n).mapInArrow(run, "id long, x double").toPandas().sort_values("id")
    slope, shift = calibrate(got["x"].to_numpy(), index.toxic, index.class_weight)
    return replace(index, slope=slope, shift=shift)


def score(docs: DataFrame, index: Index, k: int = K) -> DataFrame:
    """docs with ``score`` (0 to 1), ``predicted`` and ``evidence`` appended, in one pass without a shuffle.

    The columns of docs come back unchanged as the struct ``doc``, so no name can clash.  ``evidence``
    lists the k nearest examples, best first; it is empty for a text without a term of the space, such as
    a null or empty one.  Texts are read whole; repeated rows stay; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pickle.loads(sent.value)
        for b in batches:
            found, proof = [], []
            for text in b["text"]:
                ids, scores = nearest(held, *vector(held, text.as_py()), k)
                found.append(curve(held, share(held, ids, scores)))
                proof.append([
                    {"doc_id": int(i), "cosine": float(s), "toxic": int(y)}
                    for i, s, y in zip(held.ids[ids], scores, held.toxic[ids])
                ])
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [b["doc"], pa.array(found, pa.float64()), pa.array(proof, kind)], ["doc", "score", "evidence"]
            )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")
    scored = rows.mapInArrow(run, with_doc(rows, f"score double, evidence {EVIDENCE}"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
