"""Near-duplicate vectors: spherical k-means cells and blocked cosine products inside them.

Equal vectors of a label form one class first.  Centroids come from spherical k-means on a sample of
at most about ``sample_rows`` vectors; every vector has a home cell (its nearest centroid) and is a
guest in each further cell that a linked vector could call home: with d = sqrt(2 - 2 t) the largest
distance of a linked pair, y must visit cell c only if y.home - y.c <= d |home - c|, so no pair at or
above the threshold is lost.  Cells are cut into blocks of about ``BLOCK`` vectors by hash and home
blocks meet member blocks, so a cell with a third of all vectors is many tasks.  Blocks return counts
and a spanning forest of their links, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.graph import components
from tidemark.session import stored

ship(__name__)

BLOCK = 2048


def _matrix(column) -> np.ndarray:
    out = np.array([np.asarray(x, dtype=np.float64) for x in column])
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def k_means(vectors: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Unit centroids by cosine; starts from evenly spaced rows of the given order."""
    centroids = vectors[np.linspace(0, len(vectors) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, vectors)
        norms = np.linalg.norm(sums, axis=1)
        live = norms > 1e-12
        centroids[live] = sums[live] / norms[live, None]
    return centroids


def _centroids(data: pd.DataFrame) -> pd.DataFrame:
    data = data.sort_values(["h", "id"], kind="stable")
    parts = []
    for size, rows in data.groupby(data["v"].map(len)):  # vectors of other lengths never link
        k = max(1, min(len(rows), round(math.sqrt(float(rows["n"].iloc[0])) / 4)))
        found = k_means(_matrix(rows["v"]), k)
        parts.append(pd.DataFrame({"label": rows["label"].iloc[0], "size": size, "c": list(found)}))
    return pd.concat(parts)


def _forest(hits: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges (id, root) that connect what the hit matrix between two id lists connects."""
    a, b = left.copy(), right.copy()
    big = np.iinfo(np.int64).max
    while True:
        na = np.minimum(a, np.where(hits, b[None, :], big).min(axis=1, initial=big))
        nb = np.minimum(b, np.where(hits, na[:, None], big).min(axis=0, initial=big))
        if (na == a).all() and (nb == b).all():
            break
        a, b = na, nb
    pairs = {(int(i), int(r)) for i, r in zip(left, a) if i != r}
    return sorted(pairs | {(int(i), int(r)) for i, r in zip(right, b) if i != r})


def _block(threshold: float):
    def run(data: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, same in data.groupby(data["v"].map(len)):
            home, other = same[same["is_home"]], same[~same["is_home"]]
            if home.empty or other.empty:
                continue
            ids, members = home["id"].to_numpy(np.int64), other["id"].to_numpy(np.int64)
            weight, right = other["copies"].to_numpy(np.int64), _matrix(other["v"])
            for at in range(0, len(ids), 512):
                part = ids[at : at + 512]
                hits = (_matrix(home["v"].iloc[at : at + 512]) @ right.T >= threshold) & (part[:, None] != members[None, :])
                rows += [(int(i), int(n), None) for i, n in zip(part, hits @ weight) if n]
                live, seen = hits.any(axis=1), hits.any(axis=0)
                if live.any():
                    rows += [(i, 0, r) for i, r in _forest(hits[live][:, seen], part[live], members[seen])]
        return pd.DataFrame(rows, columns=["id", "links", "root"]).astype({"root": "Int64"})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, sample_rows: int = 16_384) -> DataFrame:
    """Per row of (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Null labels, null or zero vectors and vectors with null or non-finite components link with nothing;
    so do vectors of different lengths.  Rows that share a vec_id, or have none, are vectors of their own;
    a component is named by its smallest vec_id, null if it has none, and a null vec_id is never kept.  An
    empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    base = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    base = base.withColumn("usable", F.coalesce(usable, F.lit(False)))
    keyed = stored(
        base.select("vec_id", "usable", "label", "embedding", F.when(
            F.col("usable"), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.transform("embedding", lambda x: (x + 0.0).cast("string"))), 256)
        ).alias("key")),
        "vec-rows",
    )
    # a class has a number of its own, fixed once it is written: ids may be null or repeated
    classes = stored(
        keyed.where("usable").groupBy("key").agg(
            F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"), F.first("embedding").alias("v"),
        ).withColumn("id", F.monotonically_increasing_id()),
        "vec-classes",
    )
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = classes.count()
    share = min(1.0, sample_rows / max(1, total))
    h = F.xxhash64("key")
    sample = classes.where(F.pmod(h, F.lit(1_000_000)) < math.ceil(1_000_000 * share)).join(sizes, "label")
    found = sample.select("label", "id", "v", "n", h.alias("h")).groupBy("label").applyInPandas(
        _centroids, "label int, size int, c array<double>"
    ).collect()  # about sqrt(rows) / 4 centroids
    cells: dict[tuple, np.ndarray] = {}
    for r in sorted(found, key=lambda r: (r["label"], r["size"], r["c"])):
        cells.setdefault((r["label"], r["size"]), []).append(r["c"])
    sent = spark.sparkContext.broadcast({k: np.array(c) for k, c in cells.items()})
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps: dict = {}
        for b in batches:
            ids, labels, copies, vs = (b[c].to_pylist() for c in ("id", "label", "copies", "v"))
            groups: dict[tuple, list[int]] = {}
            for i, (label, x) in enumerate(zip(labels, vs)):
                groups.setdefault((label, len(x)), []).append(i)
            out = []
            for key, pick in groups.items():
                centroids = sent.value.get(key)
                if centroids is None:  # no sampled vector of this kind: one common cell
                    out += [(i, 0, True) for i in pick]
                    continue
                if key not in gaps:
                    gaps[key] = np.sqrt(np.maximum(0.0, 2 - 2 * centroids @ centroids.T))
                dots = _matrix([vs[i] for i in pick]) @ centroids.T
                home = dots.argmax(axis=1)
                own = dots[np.arange(len(pick)), home]
                visits = own[:, None] - dots <= reach * gaps[key][home] + 1e-7
                for j, i in enumerate(pick):
                    out += [(i, int(c), bool(c == home[j])) for c in np.flatnonzero(visits[j])]
            yield pa.RecordBatch.from_pydict({
                "label": pa.array([labels[i] for i, _, _ in out], pa.int32()),
                "cell": pa.array([c for _, c, _ in out], pa.int32()),
                "is_home": pa.array([x for _, _, x in out], pa.bool_()),
                "id": pa.array([ids[i] for i, _, _ in out], pa.int64()),
                "copies": pa.array([copies[i] for i, _, _ in out], pa.int64()),
                "v": pa.array([vs[i] for i, _, _ in out], pa.list_(pa.float64())),
            })

    placed = stored(
        classes.select("id", F.col("label").cast("int").alias("label"), "copies", "v").mapInArrow(
            assign, "label int, cell int, is_home boolean, id long, copies long, v array<double>"
        ),
        "vec-cells",
    )
    blocks = placed.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cut = placed.join(blocks, ["label", "cell"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    fields = ["label", "cell", "id", "copies", "v"]
    homes = cut.where("is_home").select(*fields, F.lit(True).alias("is_home"), F.col("own").alias("row"), every.alias("col"))
    others = cut.select(*fields, F.lit(False).alias("is_home"), F.col("own").alias("col"), every.alias("row"))
    found = stored(
        homes.unionByName(others).groupBy("label", "cell", "row", "col").applyInPandas(
            _block(threshold), "id long, links long, root long"
        ),
        "vec-links",
    )
    links = found.where("root is null").groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.where("root is not null").select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.select("key", "id", "least", "copies")
        .join(links, "id", "left")
        .join(roots, "id", "left")
        .select(
            "key", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "id").alias("root"),
        )
    )
    names = per_class.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = per_class.join(names, "root").select("key", "n_links", "component_id")
    joined = keyed.select("vec_id", "key").join(per_class, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
