"""Grouped prefix join on n-gram sets: documents that share most of their word shingles.

A document is its set of ``SHINGLE``-word shingles as 64-bit hashes.  Texts that are equal but for
ASCII case are one class first, which is dealt, linked and kept by 64 bits of a hash of the text;
doc_ids only choose the first row of a component.  Of each set, shingles that no other class has can be in no
intersection; ``suffix.hash_request`` and ``shared_hashes`` find them exactly as anchors are found
there (4 bytes per distinct shingle and packet), and tell how widely the others are spread.  In the
order "unshared first, then by the logarithm of the spread, then by hash", a pair at or above the
threshold has a common shingle among the first n - ceil(t n) + 1 of either set, so a
document whose prefix is all unshared is linked with nothing; few others remain.

Those with a common prefix shingle form clusters (components of the shingle-to-document graph, by
stars, not pairs).  Clusters are dealt to bins; one above ``BLOCK_BYTES`` is cut into blocks by hash and
every pair of blocks is a bin, so no cluster has to fit in a task.  A bin runs the grouped join:
documents with equal prefixes and sizes are one group, groups meet through an inverted list of prefix
shingles, pass the size filter, are expanded, and members are verified on their whole sets.  A bin
returns one edge per document to the root of its component there; the components of all edges are the
result, so pairs are never written down.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, lower_az, packets, ship
from tidemark.llm.graph import components
from tidemark.llm.suffix import NOTE, hash_request, mix, note_table, shared_hashes
from tidemark.session import stored

ship(__name__)

SHINGLE, PERCENT = 4, 85
PACKET_BYTES, BLOCK_BYTES = 2 << 20, 4 << 20


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, shingle hash) pairs of all texts, by owner and hash.

    Words are runs without ASCII white space, ASCII letters in lower case.  With fewer than ``width``
    words the whole sequence is the one shingle; without words there is none.
    """
    known: dict[bytes, int] = {}
    owners, hashes = [], []
    for k, text in enumerate(texts):
        tokens = text.lower().split()
        if not tokens:
            continue
        w = np.fromiter((known.setdefault(t, len(known)) for t in tokens), np.int64, len(tokens))
        owners.append(k)
        hashes.append(w)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    names = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in known), np.uint64, len(known))
    sizes = np.array([len(w) for w in hashes])
    owner = np.repeat(np.array(owners), sizes)
    word = names[np.concatenate(hashes)]
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(word))  # words from here to the end
    short = np.repeat(sizes, sizes) < width
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    h = np.full(len(word), np.uint64(width))
    n = len(word)
    for j in range(width):
        # a short text ends early: its hash stops at its last word and keeps its length
        here = np.minimum(np.arange(n) + j, n - 1)
        step = mix(h ^ word[here]) + np.uint64(j + 1)
        h = np.where(left > j, step, h)
    ok = (left >= width) | (short & first)
    owner, h = owner[ok], h[ok]
    order = np.lexsort([h, owner])
    owner, h = owner[order], h[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])])
    return owner[new], h[new]


def _first_of_class(batches):
    """Rows whose class was not met before in the task."""
    met: set[int] = set()
    for b in batches:
        fresh = []
        for k, node in enumerate(b["id"].to_pylist()):
            if node not in met:
                met.add(node)
                fresh.append(k)
        yield b.take(pa.array(fresh, pa.int64()))


def _texts(docs: pa.Table) -> dict[int, bytes]:
    """One text of every class of the packet, by class."""
    return dict(sorted(zip(docs["id"].to_pylist(), docs["bytes"].to_pylist())))


def _ask(bits: int, width: int):
    def run(docs: pa.Table) -> pa.Table:
        owner, h = shingle_sets(list(_texts(docs).values()), width)
        if not len(h):
            return note_table([])
        return note_table(hash_request(docs["g"][0].as_py(), h, owner, bits))

    return run


def _profiles(bits: int, width: int, percent: int):
    """Packet: per class its size and, if it can be linked at all, its prefix and its shared shingles."""

    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        heads = _texts(docs)
        owner, h = shingle_sets(list(heads.values()), width)
        known, sizes_of = [], []
        for b, d in zip(notes["bucket"].to_pylist(), notes["data"].to_pylist()):
            n = len(d) // 5
            known.append((np.uint64(b) << np.uint64(32)) | np.frombuffer(d, np.uint32, n).astype(np.uint64))
            sizes_of.append(np.frombuffer(d, np.uint8, n, 4 * n))
        shared, spread = np.zeros(len(h), bool), np.zeros(len(h), np.uint8)
        if known and len(h):
            known, sizes_of = np.concatenate(known), np.concatenate(sizes_of)
            order = np.argsort(known)
            known, sizes_of = known[order], sizes_of[order]
            key = h >> np.uint64(32 - bits)
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            shared, spread = known[at] == key, sizes_of[at]
        cuts = np.searchsorted(owner, np.arange(len(heads) + 1))
        sizes, prefixes, sets = [], [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            n = int(b - a)
            mine = h[a:b][shared[a:b]]
            rarest = mine[np.argsort(spread[a:b][shared[a:b]], kind="stable")]
            prefix = n - -(-percent * n // 100) + 1 - (n - len(mine))
            fit = n > 0 and prefix > 0
            sizes.append(n)
            prefixes.append(rarest[:prefix].tobytes() if fit else None)
            sets.append(mine.tobytes() if fit else None)
        return pa.table({
            "id": pa.array(list(heads), pa.int64()),
            "size": pa.array(sizes, pa.int64()),
            "prefix": pa.array(prefixes, pa.binary()),
            "shared": pa.array(sets, pa.binary()),
        })

    return run


def _tokens(batches):
    """(token, id) of every prefix shingle."""
    for b in batches:
        prefixes = [np.frombuffer(x, np.int64) for x in b["prefix"].to_pylist()]
        ids = np.repeat(b["id"].to_numpy(), [len(p) for p in prefixes])
        tokens = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_pydict({"token": pa.array(tokens, pa.int64()), "id": pa.array(ids, pa.int64())})


def _grouped_join(percent: int):
    """Bin: edges (a, b) from documents to the smallest id they reach inside the bin."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("id", "ascending")])
        ids, sizes, cluster = (table[c].to_numpy() for c in ("id", "size", "cluster"))
        side = table["side"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["shared"].to_pylist()]
        names = table["prefix"].to_pylist()
        lengths = np.array([len(s) for s in sets])
        vocabulary, tokens = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(lengths) - lengths
        root = np.arange(len(ids))
        mark = np.zeros(len(vocabulary), bool)
        groups: dict[tuple, int] = {}
        members: list[list[int]] = []
        for k, key in enumerate(zip(cluster.tolist(), names, sizes.tolist())):
            g = groups.setdefault(key, len(members))
            if g == len(members):
                members.append([])
            members[g].append(k)
        lists: dict[tuple, list[int]] = {}
        for g, rows in enumerate(members):
            x = rows[0]
            met = {g}
            for token in np.frombuffer(names[x], np.uint64).tolist():
                entry = lists.setdefault((int(cluster[x]), token), [])
                met.update(entry)
                entry.append(g)
            other = np.array(sorted(met))
            heads = np.array([members[o][0] for o in other])
            small, large = np.minimum(sizes[heads], sizes[x]), np.maximum(sizes[heads], sizes[x])
            near = [k for o in other[100 * small >= percent * large].tolist() for k in members[o]]
            near = np.array(near)
            for k in rows:
                # in a bin of two blocks, pairs inside one block belong to that block's own bin
                pick = near[(near < k) | (near > k)] if len(near) else near
                pick = pick[(root[pick] != root[k]) & ((side[pick] != side[k]) | (side[k] < 0))]
                if not len(pick):
                    continue
                mark[tokens[starts[k] : starts[k] + lengths[k]]] = True
                spans = np.concatenate([tokens[starts[p] : starts[p] + lengths[p]] for p in pick])
                offsets = np.cumsum(lengths[pick]) - lengths[pick]
                common = np.add.reduceat(mark[spans].astype(np.int64), offsets)
                mark[tokens[starts[k] : starts[k] + lengths[k]]] = False
                linked = pick[100 * common >= percent * (sizes[pick] + sizes[k] - common)]
                for r in np.unique(root[linked]).tolist():
                    low, high = min(r, root[k]), max(r, root[k])
                    root[root == high] = low
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, root, ids)
        to = least[root]
        moved = to != ids
        return pa.table({"a": pa.array(ids[moved], pa.int64()), "b": pa.array(to[moved], pa.int64())})

    return run


def clusters(
    docs: DataFrame,
    width: int = SHINGLE,
    percent: int = PERCENT,
    packet_bytes: int = PACKET_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles, component_id.

    Documents link when 100 * |intersection| >= percent * |union|; component_id is the smallest doc_id
    reachable, itself included.  Null texts and texts without words have no shingles and link with
    nothing.  A null doc_id counts as larger than all others, and rows are linked by their texts, so null or
    repeated doc_ids link nothing by themselves.  Repeated rows are copies; an empty table gives an empty
    result; other columns are not read.
    """
    clean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _node(F.col("text")).alias("id"))
    found = _classes(docs, width, percent, packet_bytes, block_bytes)
    return clean.join(found, "id").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _node(text: Column) -> Column:
    """The class of a text as a number: eight bytes of a hash of it in lower case."""
    key = F.sha2(lower_az(F.coalesce(text, F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(key, 1, 16), 16, -10).cast("long")


def _classes(docs: DataFrame, width: int, percent: int, packet_bytes: int, block_bytes: int) -> DataFrame:
    """Per class of equal texts: id (its number), n_shingles, component_id, and whether it is the ``first`` of its component."""
    n = packets(docs, packet_bytes)
    bits = max(1, min(20, (n // 4).bit_length()))
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(_node(F.col("text")).alias("id"), text.cast("binary").alias("bytes"))
    base = base.mapInArrow(_first_of_class, "id long, bytes binary")
    dealt = base.select(F.pmod("id", F.lit(n)).cast("int").alias("g"), "id", "bytes").groupBy("g")
    shared = dealt.applyInArrow(_ask(bits, width), NOTE).groupBy("bucket").applyInArrow(
        lambda t: shared_hashes(t, classes=True), NOTE
    )
    profiles = stored(
        dealt.cogroup(shared.groupBy("g")).applyInArrow(
            _profiles(bits, width, percent), "id long, size long, prefix binary, shared binary"
        ),
        "shingle-profiles",
    )
    open_ = profiles.where("prefix is not null")
    tokens = stored(open_.select("id", "prefix").mapInArrow(_tokens, "token long, id long"), "prefix-tokens")
    pivots = tokens.groupBy("token").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = tokens.join(pivots, "token").select(F.col("id").alias("a"), "b")
    nearby = components(stars)
    # a document alone in its cluster has no candidate; roots are told by their members
    named = stored(nearby.unionByName(nearby.select(F.col("root").alias("id"), "root").distinct()), "clusters")
    placed = open_.join(named.withColumnRenamed("root", "cluster"), "id")
    weights = placed.groupBy("cluster").agg(
        F.ceil(F.sum(F.length("shared")) / block_bytes).cast("int").alias("blocks"), F.sum(F.length("shared")).alias("w")
    )
    bins = max(1, n)
    cut = placed.join(weights, "cluster").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # blocks i <= j make a bin; a document of block k goes to every bin with k in it
    with_block = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j")),
    )
    spread = cut.withColumn("pair", F.explode(with_block)).select(
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(F.col("cluster") + bins).alias("bin"),
        "pair.i", "pair.j",
        F.when(F.col("pair.i") == F.col("pair.j"), F.lit(-1)).otherwise(F.col("own")).alias("side"),
        "cluster", "id", "size", "prefix", "shared",
    )
    edges = spread.groupBy("bin", "i", "j").applyInArrow(_grouped_join(percent), "a long, b long")
    roots = components(edges)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "id"))
    classes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _node(F.col("text")).alias("id"))
    classes = classes.groupBy("id").agg(first.alias("f"))
    per_class = profiles.select("id", F.col("size").alias("n_shingles")).join(roots, "id", "left").join(classes, "id")
    per_class = stored(per_class.select("id", "n_shingles", "f", F.coalesce("root", "id").alias("root")), "text-classes")
    firsts = per_class.groupBy("root").agg(F.min("f").alias("of"))
    return per_class.join(firsts, "root").select(
        "id", "n_shingles", F.col("of.doc_id").alias("component_id"), (F.col("id") == F.col("of.id")).alias("first")
    )


def keep_one(
    docs: DataFrame,
    width: int = SHINGLE,
    percent: int = PERCENT,
    packet_bytes: int = PACKET_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row of docs per component, the first by doc_id, nulls last; rows without words are all kept."""
    found = _classes(docs.select("doc_id", "text"), width, percent, packet_bytes, block_bytes)
    heads = found.where("first and n_shingles > 0").select(F.col("id").alias("__class"))
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.col("text"), F.xxhash64(*plain))
    rows = docs.where(has_words).groupBy(_node(F.col("text")).alias("__class")).agg(
        F.min_by(F.struct(*columns), order).alias("__row")
    )
    one = rows.join(heads, "__class", "left_semi").select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
    return one.unionByName(docs.where(~has_words))
