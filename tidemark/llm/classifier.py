"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector x: its words in lower case, hashed into ``WORD_SLOTS`` places with
weight log(1 + count) and unit length together, one place per interval of each structure figure and
of the metadata column n_chars.  The model is

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

whose pair term costs one pass over the entries of x (sum-of-squares identity).  It is trained on a
bounded sample of labelled rows by parameter mixing: the sample lies in PARTS parts, every round each
part runs one AdaGrad epoch from the common parameters in its own task, and the means go on.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, with_doc
from tidemark.session import stored

ship(__name__)

WORD_SLOTS, BINS, RANK, PARTS = 1 << 15, 16, 6, 6
LETTERS = bytes(range(65, 91)), bytes(range(97, 123))
N_FIGURES = 11
SIZE = WORD_SLOTS + BINS * N_FIGURES


def _bin(x: float) -> int:
    return min(BINS - 1, int(math.log2(1000 * x + 1) + 0.5))


def features(text: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values; a null text is an empty one, a null n_chars has an interval of its own."""
    text = text or b""
    tokens = text.lower().split()
    counts = Counter(tokens)
    slots = np.fromiter((zlib.crc32(w) % WORD_SLOTS for w in counts), dtype=np.int32, count=len(counts))
    values = np.log1p(np.fromiter(counts.values(), dtype=np.float32, count=len(counts)))
    values /= max(1e-9, float(np.sqrt((values**2).sum())))
    n, size = max(1, len(tokens)), max(1, len(text))

    def share(chars: bytes) -> float:
        return (len(text) - len(text.translate(None, chars))) / size

    lines = [x for x in text.split(b"\n") if x.strip()]
    figures = [
        share(b"#*$%&<>"),
        share(b"|"),
        share(b"!"),
        share(b"0123456789"),
        share(LETTERS[0]) / max(1e-9, share(LETTERS[0]) + share(LETTERS[1])),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        1 - len(set(lines)) / max(1, len(lines)),
    ]
    bins = [_bin(x) for x in figures]
    bins += [
        min(BINS - 1, len(tokens).bit_length()),
        min(BINS - 1, size // n),
        BINS - 1 if n_chars is None else min(BINS - 2, max(0, int(n_chars)).bit_length()),
    ]
    places = WORD_SLOTS + BINS * np.arange(N_FIGURES, dtype=np.int32) + np.array(bins, dtype=np.int32)
    return np.concatenate([slots, places]), np.concatenate([values, np.ones(N_FIGURES, np.float32)])


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def pack(self) -> bytes:
        return np.concatenate([[self.bias], self.linear, self.factors.ravel()]).astype(np.float32).tobytes()


def unpack(blob: bytes | np.ndarray) -> Model:
    x = np.frombuffer(blob, dtype=np.float32) if isinstance(blob, bytes) else blob
    return Model(float(x[0]), x[1 : SIZE + 1].copy(), x[SIZE + 1 :].reshape(SIZE, RANK).copy())


def fresh() -> Model:
    rng = np.random.default_rng(7)
    return Model(0.0, np.zeros(SIZE, np.float32), rng.normal(0, 0.05, (SIZE, RANK)).astype(np.float32))


def raw_scores(model: Model, rows: list[tuple[np.ndarray, np.ndarray]]):
    """Linear scores of sparse rows and what the gradient needs of them."""
    slots = np.concatenate([r[0] for r in rows])
    values = np.concatenate([r[1] for r in rows])[:, None]
    lengths = np.array([len(r[0]) for r in rows])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    scaled = model.factors[slots] * values
    sums = np.add.reduceat(scaled, starts)
    squares = np.add.reduceat(scaled * scaled, starts)
    linear = np.add.reduceat(model.linear[slots] * values[:, 0], starts)
    return model.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), slots, values, lengths, scaled, sums


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def epoch(model: Model, rows: list, labels: np.ndarray, rate: float = 0.3, decay: float = 1e-4, batch: int = 32) -> Model:
    """One AdaGrad pass in a fixed random order."""
    g_lin, g_fac, g_bias = np.full(SIZE, 1e-2), np.full((SIZE, RANK), 1e-2), 1e-2
    order = np.random.default_rng(11).permutation(len(rows))
    for at in range(0, len(rows), batch):
        pick = order[at : at + batch]
        raw, slots, values, lengths, scaled, sums = raw_scores(model, [rows[i] for i in pick])
        error = (sigmoid(raw) - labels[pick]) / len(pick)
        each = np.repeat(error, lengths)[:, None]
        grad = each * values * (np.repeat(sums, lengths, axis=0) - scaled)
        used, inverse = np.unique(slots, return_inverse=True)
        lin = np.bincount(inverse, (each * values)[:, 0], len(used)) + decay * model.linear[used]
        fac = np.stack([np.bincount(inverse, grad[:, f], len(used)) for f in range(RANK)], axis=1)
        fac += decay * model.factors[used]
        g_lin[used] += lin * lin
        g_fac[used] += fac * fac
        model.linear[used] -= (rate * lin / np.sqrt(g_lin[used])).astype(np.float32)
        model.factors[used] -= (rate / 3 * fac / np.sqrt(g_fac[used])).astype(np.float32)
        g_bias += error.sum() ** 2
        model.bias -= rate * error.sum() / math.sqrt(g_bias)
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pairs = [features(t, n) for t, n in zip(b["text"].to_pylist(), b["n_chars"].to_pylist())]
        yield pa.RecordBatch.from_pydict({
            "part": b["part"],
            "y": b["y"],
            "slots": pa.array([p[0].tobytes() for p in pairs], pa.binary()),
            "values": pa.array([p[1].tobytes() for p in pairs], pa.binary()),
        })


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, rounds: int = 8) -> Model:
    """Train on at most ``max_rows`` labelled rows, the first by hash of their id.

    docs: doc_id, text, n_chars; labels: doc_id, quality (null: not labelled).  Without labels the
    model scores every text 0.5.
    """
    spark = docs.sparkSession
    known = labels.where("quality is not null").select("doc_id", F.col("quality").cast("double").alias("y"))
    chosen = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_rows), "fm-labels")
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.col("n_chars").cast("long").alias("n_chars"))
    sample = rows.join(chosen, "doc_id").select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS)).cast("int").alias("part"), "y", "text", "n_chars"
    )
    sample = stored(
        sample.mapInArrow(_feature_rows, "part int, y double, slots binary, values binary"), "fm-sample"
    )
    model = fresh()
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model.pack())

        def train(data: pd.DataFrame) -> pd.DataFrame:
            # the order of rows must not depend on how files were written
            data = data.sort_values(["slots", "y"], kind="stable")
            rows = [
                (np.frombuffer(s, np.int32), np.frombuffer(v, np.float32)) for s, v in zip(data["slots"], data["values"])
            ]
            done = epoch(unpack(sent.value), rows, data["y"].to_numpy())
            return pd.DataFrame({"n": [len(rows)], "model": [done.pack()]})

        # PARTS rows, each one model
        found = sample.groupBy("part").applyInPandas(train, "n long, model binary").collect()
        sent.unpersist()
        if not found:
            return Model(0.0, np.zeros(SIZE, np.float32), np.zeros((SIZE, RANK), np.float32))
        found.sort(key=lambda r: (r["n"], bytes(r["model"][:64])))
        total = sum(r["n"] for r in found)
        mean = sum(np.frombuffer(r["model"], np.float32).astype(np.float64) * (r["n"] / total) for r in found)
        model = unpack(mean.astype(np.float32))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with ``score`` (0 to 1) and ``predicted`` appended, computed in one pass without a shuffle.

    The columns of docs come back unchanged as the struct ``doc``, so no name can clash.  Nulls are
    read as empty, repeated rows stay, an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.pack())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(sent.value)
        for b in batches:
            texts, chars, out = b["text"], b["n_chars"], []
            for at in range(0, b.num_rows, 256):
                rows = [
                    features(t.as_py(), n.as_py())
                    for t, n in zip(texts.slice(at, 256), chars.slice(at, 256))
                ]
                out.append(sigmoid(raw_scores(held, rows)[0].astype(np.float64)))
            yield pa.RecordBatch.from_arrays(
                [b["doc"], pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())], ["doc", "score"]
            )

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        whole.alias("doc"), F.col("text").cast("binary").alias("text"), F.col("n_chars").cast("long").alias("n_chars")
    )
    scored = rows.mapInArrow(run, with_doc(rows, "score double"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs predicted to be good, unchanged."""
    return score(docs, fit(docs, labels, **options)).where("predicted = 1").select("doc.*")
