"""Katz backoff language model: Good-Turing discounted counts, exactly normalised backoff.

Words are runs without ASCII white space, ASCII letters in lower case, then one end per text.

    p1(w)     = d(c) c / N, the rest of the mass goes to all unseen words together
    p2(x | h) = d(c) c(h x) / c(h) if h x was seen, else alpha(h) P1(x)

Every word is a history and a successor of its own; words that no training text has are one class, with
no counts as a history and p1 of all unseen words as a successor.  alpha(h) makes the probabilities of
all classes after h sum to one exactly.  The figures of the most frequent words (from the lowest count on
that keeps them within ``max_vocabulary``) are arrays that are broadcast; those of all other words stay in
partitioned tables and meet their grams there, so ``max_vocabulary`` changes no score.

Counting and scoring run once over the text: packs of texts send (gram, text, count) to buckets of
grams; a bucket adds up the training counts and keeps who asked.  Rows come in kinds: PAIRS are grams of
two frequent words; AFTER lists every rare successor with its history, by successor, so that p1 is known
in the bucket; FROM lists every gram of a rare history, by history, so that c(h) and alpha(h) are.  A gram
of two rare words is in both: AFTER counts its successor, FROM scores it, with the successor's count
joined from the table of unigrams.  This table is the model: one pass over its counts gives the discounts
and alpha of frequent histories, a second evaluates p2 -> alpha * p1 for every gram and sends each pack the
sums of its texts.  Frequent histories with more than their share of all tokens are spread over buckets by
gram instead of by history.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packets, ship
from tidemark.session import stored, workspace

ship(__name__)

GT = 5  # counts up to this are discounted
MAX_VOCABULARY = 1 << 17  # words whose figures are broadcast
COUNT_BYTES, PACK_BYTES, BUCKET_BYTES = 8 << 20, 2 << 20, 8 << 20
DOCS, AFTER, PAIRS, FROM = 0, 1, 2, 3
KEYS = {PAIRS: [], AFTER: [np.uint64], FROM: [np.uint64]}  # the second part of a gram's key
ROW = "kind int, bucket int, batch long, grams binary, data binary"


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers, byte planes apart so that small values cost little."""
    head = np.array([len(arrays), *[x for a in arrays for x in (a.dtype.itemsize, len(a))]], np.int64).tobytes()
    planes = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + planes)


def unpack(data: bytes, kinds: list) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8).reshape(n, 2)
    out, at = [], 8 + 16 * n
    for (size, count), kind in zip(head.tolist(), kinds):
        plane = np.frombuffer(raw, np.uint8, size * count, at).reshape(size, count)
        out.append(np.ascontiguousarray(plane.T).reshape(-1).view(kind))
        at += size * count
    return out


def _steps(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def discounts(n_r: np.ndarray) -> np.ndarray:
    """Good-Turing factors d(0..GT) from n_r[r], r up to GT + 1; 1 where the counts give none in (0, 1)."""
    d = np.ones(GT + 1)
    tail = (GT + 1) * n_r[GT + 1] / n_r[1] if n_r[1] else 1.0
    for r in range(1, GT + 1):
        if n_r[r] and tail < 1:
            value = ((r + 1) * n_r[r + 1] / n_r[r] / r - tail) / (1 - tail)
            d[r] = value if 0 < value < 1 else 1.0
    return d


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(counts <= GT, d[np.minimum(counts, GT)], 1.0) * counts


@dataclass
class Model:
    words: np.ndarray  # hashes of the frequent words, ascending
    counts: np.ndarray
    tokens: int  # N
    types: int  # V
    texts: int  # training texts
    buckets: int
    d1: np.ndarray
    scale: float  # of p1, so that something is left for unseen words
    p0: float  # p1 of all unseen words together
    p1: np.ndarray = field(default=None)  # of the classes
    d2: np.ndarray = field(default=None)
    alpha: np.ndarray = field(default=None)
    total: np.ndarray = field(default=None)  # divisor of p2 by history

    @property
    def rare(self) -> int:
        return len(self.words)

    @property
    def end(self) -> int:
        return len(self.words) + 1

    @property
    def start(self) -> int:
        return len(self.words) + 2

    @property
    def classes(self) -> int:
        return len(self.words) + 3

    def history_counts(self) -> np.ndarray:
        rare = self.tokens - self.texts - int(self.counts.sum())
        return np.concatenate([self.counts, [rare, 0, self.texts]])

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-0.1 unigram probability."""
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def word_p1(self, counts: np.ndarray) -> np.ndarray:
        seen = _discounted(counts, self.d1) / max(1, self.tokens) * self.scale
        return np.where(counts > 0, seen, self.p0)


def _tokenise(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number of every token, words per text, hashes of the words by number."""
    known: dict[bytes, int] = {}
    parts, sizes = [], []
    for text in texts:
        tokens = (text or b"").lower().split()
        parts.append(np.fromiter((known.setdefault(t, len(known)) for t in tokens), np.int64, len(tokens)))
        sizes.append(len(tokens))
    # the highest bit tells a hash from the number of a class
    names = np.fromiter((xxhash.xxh3_64_intdigest(t) | 1 << 63 for t in known), np.uint64, len(known))
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), np.array(sizes, np.int64), names


def _packs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of about ``limit`` bytes of text; a longer text is one slice."""
    for b in batches:
        sizes = pc.binary_length(b["bytes"]).to_pylist()
        at, size = 0, 0
        for k, n in enumerate(sizes):
            if k > at and (size + n > limit or k - at == 65_000):
                yield (part := b.slice(at, k - at)), part["bytes"].to_pylist()
                at, size = k, 0
            size += n
        if at < len(sizes):
            yield (part := b.slice(at)), part["bytes"].to_pylist()


def _unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b, texts in _packs(batches, COUNT_BYTES):
        train = b["train"].to_pylist()
        ids, _, names = _tokenise([t for t, ok in zip(texts, train) if ok])
        counts = np.bincount(ids, minlength=len(names))
        yield pa.RecordBatch.from_pydict({"word": pa.array(names.view(np.int64)), "n": pa.array(counts, pa.int64())})


def _vocabulary(rows: DataFrame, buckets: int, max_vocabulary: int) -> tuple[Model, DataFrame]:
    """Unigram part of the model, and the counts of all words; what comes to the driver is bounded by max_vocabulary."""
    unigrams = stored(
        rows.select("bytes", "train").mapInArrow(_unigrams, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "unigrams",
    )
    texts = rows.where("train").count()
    first = unigrams.agg(
        F.count(F.lit(1)), F.sum("n"), *[F.sum((F.col("n") == r).cast("long")) for r in range(1, GT + 2)]
    ).first()
    types, tokens, *n_r = [int(x or 0) for x in first]
    # size classes of counts: exact up to 63, then sixteen to a doubling
    size_class = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(16 * F.log2("n")).cast("long"))
    sizes = unigrams.groupBy(size_class.alias("s")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least"))
    held, least = 0, None
    for row in sorted(sizes.collect(), key=lambda r: -r["least"]):
        held += row["k"]
        if held > max_vocabulary:
            break
        least = row["least"]
    chosen = unigrams.where(F.col("n") >= least).toArrow() if least is not None else None
    words = chosen["word"].to_numpy().view(np.uint64) if chosen else np.zeros(0, np.uint64)
    counts = chosen["n"].to_numpy() if chosen else np.zeros(0, np.int64)
    order = np.argsort(words)
    words, counts = words[order], counts[order].astype(np.int64)
    n_all = tokens + texts
    d1 = discounts(np.array([0, *n_r], float))
    lost = sum((1 - d1[r]) * r * n_r[r - 1] for r in range(1, GT + 1)) / max(1, n_all)
    scale = 1.0 if lost > 0 else n_all / (n_all + 1)
    model = Model(words, counts, n_all, types + (texts > 0), texts, buckets, d1, scale, 1 - (1 - lost) * scale)
    top = model.word_p1(counts)
    end = texts / max(1, n_all) * scale
    model.p1 = np.concatenate([top, [max(1e-12, 1 - top.sum() - end), end, 0.0]])
    return model, unigrams


def _buckets_of(model: Model, key: np.ndarray) -> np.ndarray:
    """By history; by gram where the history has more than its share of all tokens."""
    history = key // model.classes
    hot = model.history_counts()[history] > model.tokens / model.buckets
    mixed = np.where(hot, key, history).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(model.buckets)).astype(np.int64)


def _cut(kind: int, batch: int, bucket: np.ndarray, key: np.ndarray, doc: np.ndarray, count: np.ndarray, train: np.ndarray):
    """Rows of one pack, one per bucket; key ascends inside a bucket."""
    order = np.lexsort([doc, key, bucket])
    bucket, key, doc, count = bucket[order], key[order], doc[order], count[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
    for a, b in zip(edges[:-1], edges[1:]):
        data = pack([_steps(key[a:b].astype(np.uint64)), doc[a:b].astype(np.uint16), count[a:b].astype(np.uint32), train])
        yield kind, int(bucket[a]), batch, None, data


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    """Different rows of the columns, in order, and how often each is there."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return [*[c[first] for c in columns], np.diff(np.append(first, len(order)))]


def _cut_rare(kind: int, batch: int, buckets: int, word, other, doc, count, train: np.ndarray):
    """Rows of one pack, one per bucket of the rare word; word and other ascend inside a bucket."""
    bucket = ((word >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort([doc, other, word, bucket])
    bucket, word, other, doc, count = (x[order] for x in (bucket, word, other, doc, count))
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
    for a, b in zip(edges[:-1], edges[1:]):
        data = pack([_steps(word[a:b]), other[a:b], doc[a:b].astype(np.uint16), count[a:b].astype(np.uint32), train])
        yield kind, int(bucket[a]), batch, None, data


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "bucket", "batch", "grams", "data"]
    )


def _grams(sent):
    """Texts to rows of grams by bucket, and one row per pack with its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        log_base = model.base(np.concatenate([model.counts, [0, model.texts]]))
        log_base[model.rare] = 0.0  # added by the buckets
        number = TaskContext.get().partitionId() << 24
        for b, texts in _packs(batches, PACK_BYTES):
            number += 1
            ids, sizes, names = _tokenise(texts)
            at = np.minimum(np.searchsorted(model.words, names), max(0, len(model.words) - 1))
            known = model.words[at] == names if len(model.words) else np.zeros(len(names), bool)
            word_class = np.where(known, at, model.rare)
            n = len(sizes)
            doc = np.repeat(np.arange(n), sizes)
            train = np.array(b["train"].to_pylist(), bool)
            # successors: all words and the end; histories: the start and all words
            ends = np.cumsum(sizes) + np.arange(n)
            successor = np.full(len(ids) + n, model.end)
            history = np.full(len(ids) + n, model.start)
            before, after = np.zeros((2, len(ids) + n), np.int64)
            place = np.arange(len(ids)) + doc
            successor[place], after[place] = word_class[ids], ids
            history[place + 1], before[place + 1] = word_class[ids], ids
            owner = np.repeat(np.arange(n), sizes + 1)
            rare_x, rare_h = successor == model.rare, history == model.rare
            pick = ~(rare_x | rare_h)
            both, count = np.unique(
                ((history[pick] * model.classes + successor[pick]).astype(np.uint64) << np.uint64(16))
                | owner[pick].astype(np.uint64),
                return_counts=True,
            )
            key = (both >> np.uint64(16)).astype(np.int64)
            rows = list(_cut(PAIRS, number, _buckets_of(model, key), key, both & np.uint64(0xFFFF), count, train))
            word, other, text, count = _distinct(after[rare_x], history[rare_x], owner[rare_x])
            rows += _cut_rare(AFTER, number, model.buckets, names[word], other.astype(np.uint64), text, count, train)
            code = np.where(rare_x, after + model.classes, successor)
            word, other, text, count = _distinct(before[rare_h], code[rare_h], owner[rare_h])
            code = other.astype(np.uint64)
            code[other >= model.classes] = names[other[other >= model.classes] - model.classes]
            rows += _cut_rare(FROM, number, model.buckets, names[word], code, text, count, train)
            base = np.bincount(owner, log_base[successor], n)
            sure = np.bincount(owner, successor != model.rare, n).astype(np.int64)
            if not model.texts:
                sure -= 1  # the end was never seen
            ids_out = b["id"].to_pylist()
            data = pack([
                np.array([0 if i is None else i for i in ids_out], np.int64),
                np.array([i is not None for i in ids_out], np.uint8),
                sizes + 1, sure, base, train,
            ])
            rows.append((DOCS, number % model.buckets, number, None, data))
            yield _rows(rows)

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Bucket: distinct grams with training counts, and who has them; rows about texts pass through."""
    if table["kind"][0].as_py() == DOCS:
        return table
    kind = table["kind"][0].as_py()
    parts = []
    batches = table["batch"].to_pylist()
    for k, data in enumerate(table["data"].to_pylist()):
        *other, doc, count, train = unpack(data, [np.uint64, *KEYS[kind], np.uint16, np.uint32, np.bool_])
        key, *other = other
        parts.append([np.cumsum(key), *other, doc, count, np.full(len(key), k, np.uint32), count * train[doc]])
    *keys, doc, count, of, seen = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.lexsort(keys[::-1])
    keys = [x[order] for x in keys]
    doc, count, of, seen = doc[order], count[order], of[order], seen[order]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in keys])
    first = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([first, [len(doc)]]))
    grams = pack([_steps(keys[0][first]), *[x[first] for x in keys[1:]], np.add.reduceat(seen.astype(np.int64), first)])
    data = pack([sizes.astype(np.uint32), of, doc, count, np.array(batches, np.int64)])
    return pa.Table.from_batches([_rows([(kind, table["bucket"][0].as_py(), None, grams, data)])])


def _rare_grams(grams: bytes) -> tuple[np.ndarray, ...]:
    """Of a bucket of AFTER or FROM: word, other end and training count of the grams; first gram and grams of a word."""
    word, other, c = unpack(grams, [np.uint64, np.uint64, np.int64])
    word = np.cumsum(word)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return word, other, c, first, np.diff(np.append(first, len(word)))


def _after(grams: bytes) -> tuple[np.ndarray, ...]:
    """Bucket of AFTER: history class, training count of the gram and of its successor."""
    _, history, c, first, sizes = _rare_grams(grams)
    return history.astype(np.int64), c, np.repeat(np.add.reduceat(c, first), sizes)


def _history_sums(sent):
    names = ["history", *[f"n{r}" for r in range(1, GT + 2)], "large", "mass"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for b in batches:
            for kind, data in zip(b["kind"].to_pylist(), b["grams"].to_pylist()):
                if kind == PAIRS:
                    key, c = unpack(data, [np.uint64, np.int64])
                    key = np.cumsum(key).astype(np.int64)
                    of, p1 = key // model.classes, model.p1[key % model.classes]
                elif kind == AFTER:
                    of, c, n = _after(data)
                    p1 = model.word_p1(n)
                    of, c, p1 = (x[of != model.rare] for x in (of, c, p1))
                else:  # for the discounts only
                    c = _rare_grams(data)[2]
                    of, p1 = np.full(len(c), model.rare), np.zeros(len(c))
                of, c, p1 = of[c > 0], c[c > 0], p1[c > 0]
                history, h = np.unique(of, return_inverse=True)
                sums = [np.bincount(h, c == r, len(history)) for r in range(1, GT + 2)]
                sums.append(np.bincount(h, np.where(c > GT, c, 0), len(history)))
                sums.append(np.bincount(h, p1, len(history)))
                yield pa.RecordBatch.from_arrays([pa.array(history), *[pa.array(x.astype(float)) for x in sums]], names)

    return run, "history long, " + ", ".join(f"{x} double" for x in names[1:])


def _normalise(model: Model, sums: pa.Table) -> Model:
    """Discounts, divisors and alpha from the sums per history (at most one row per class)."""
    history = sums["history"].to_numpy()
    n = np.stack([sums[f"n{r}"].to_numpy() for r in range(1, GT + 2)]) if len(history) else np.zeros((GT + 1, 0))
    d = discounts(np.concatenate([[0.0], n.sum(axis=1)]))
    model.d2 = d
    model.total = np.maximum(1, model.history_counts()).astype(float)
    model.alpha = np.ones(model.classes)
    if not len(history):
        return model
    kept = sums["large"].to_numpy() + sum(d[r] * r * n[r - 1] for r in range(1, GT + 1))
    model.total[history], model.alpha[history] = _backoff(model.total[history], kept, sums["mass"].to_numpy())
    return model


def _backoff(total: np.ndarray, kept: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Divisor and alpha of histories from their counts, discounted counts, and p1 of all that was seen after them."""
    # nothing was discounted after this history: one more count in the divisor is left for the rest
    total = np.where(kept / total >= 1 - 1e-12, total + 1, total)
    full = mass >= 1 - 1e-12  # every class was seen: they share everything
    total = np.where(full, kept, total)
    return total, np.where(full, 0.0, (1 - kept / total) / np.where(full, 1.0, 1 - mass))


def gram_log10(model: Model, key: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 p2 of class pairs, backing off where the training count is 0."""
    history, successor = key // model.classes, key % model.classes
    seen = _discounted(counts, model.d2) / model.total[history]
    return np.log10(np.maximum(np.where(counts > 0, seen, model.alpha[history] * model.p1[successor]), 1e-300))


def _log10(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


def _text_sums(kind: int, bucket: int, data: bytes, value, base, known) -> list[tuple]:
    """Rows for the packs: the sums of a bucket's grams per text."""
    sizes, of, doc, count, packs = unpack(data, [np.uint32, np.uint32, np.uint16, np.uint32, np.int64])
    gram = np.repeat(np.arange(len(value)), sizes)
    place, text = np.unique((of.astype(np.int64) << 16) | doc, return_inverse=True)
    sums = [np.bincount(text, x[gram] * count, len(place)) for x in (value, base, known)]
    edges = np.searchsorted(place >> 16, np.arange(len(packs) + 1))
    return [
        (kind, bucket, int(packs[k]), None, pack([(place[a:e] & 0xFFFF).astype(np.uint16), *[s[a:e] for s in sums]]))
        for k, (a, e) in enumerate(zip(edges[:-1], edges[1:])) if e > a
    ]


def _evaluate(sent):
    """Buckets of PAIRS and AFTER to sums per text: log10 p, base, known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for b in batches:
            for kind, bucket, grams, data in zip(*(b[c].to_pylist() for c in ("kind", "bucket", "grams", "data"))):
                if kind == PAIRS:
                    key, c = unpack(grams, [np.uint64, np.int64])
                    value = gram_log10(model, np.cumsum(key).astype(np.int64), c)
                    base, known = np.zeros(len(c)), np.zeros(len(c))
                else:
                    history, c, n = _after(grams)
                    seen = _discounted(c, model.d2) / model.total[history]
                    value = _log10(np.where(c > 0, seen, model.alpha[history] * model.word_p1(n)))
                    value[history == model.rare] = 0.0  # added by FROM
                    base, known = model.base(n), (n > 0).astype(float)
                yield _rows(_text_sums(kind, bucket, data, value, base, known))

    return run


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of FROM: the rare successors whose counts they need."""
    for b in batches:
        for bucket, grams in zip(b["bucket"].to_pylist(), b["grams"].to_pylist()):
            other = np.unique(_rare_grams(grams)[1])
            other = other[other >> np.uint64(63) == 1].view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(np.full(len(other), bucket), pa.int32()), "word": pa.array(other, pa.int64())
            })


def _evaluate_from(sent):
    """Bucket of FROM and the counts of its rare successors (none for unseen words) to sums per text."""

    def run(table: pa.Table, counts: pa.Table) -> pa.Table:
        model: Model = sent.value
        words, n = counts["word"].to_numpy().view(np.uint64), counts["n"].to_numpy()
        order = np.argsort(words)
        words, n = np.append(words[order], np.uint64(0)), np.append(n[order], 0)
        out = []
        for bucket, grams, data in zip(*(table[c].to_pylist() for c in ("bucket", "grams", "data"))):
            _, other, c, first, sizes = _rare_grams(grams)
            at = np.searchsorted(words[:-1], other)
            is_class = other < model.classes
            p1 = np.where(
                is_class,
                model.p1[np.where(is_class, other, 0).astype(np.int64)],
                model.word_p1(np.where(words[at] == other, n[at], 0)),
            )
            kept = np.where(c > 0, _discounted(c, model.d2), 0.0)
            total, alpha = (np.repeat(x, sizes) for x in _backoff(
                np.maximum(1, np.add.reduceat(c, first)).astype(float),
                np.add.reduceat(kept, first),
                np.add.reduceat(np.where(c > 0, p1, 0.0), first),
            ))
            value = _log10(np.where(c > 0, kept / total, alpha * p1))
            out += _text_sums(FROM, bucket, data, value, np.zeros(len(c)), np.zeros(len(c)))
        return pa.Table.from_batches([_rows(out)])

    return run


def _collect(table: pa.Table) -> pa.Table:
    """Pack: its texts with all their sums."""
    parts = sorted(zip(*(table[c].to_pylist() for c in ("kind", "bucket", "data"))), key=lambda r: r[:2])
    ids, valid, tokens, known, base, train = unpack(
        parts[0][2], [np.int64, np.uint8, np.int64, np.int64, np.float64, np.bool_]
    )
    score, base, known = np.zeros(len(ids)), base.copy(), known.copy()
    for _, _, data in parts[1:]:
        doc, s, b, k = unpack(data, [np.uint16, np.float64, np.float64, np.float64])
        score[doc] += s
        base[doc] += b
        known[doc] += np.rint(k).astype(np.int64)
    return pa.table({
        "doc_id": pa.array(ids, mask=valid == 0),
        "held_out": pa.array(~train),
        "n_tokens": pa.array(tokens),
        "n_known": pa.array(known),
        "base_score": pa.array(base),
        "score": pa.array(score),
    })


def score(docs: DataFrame, train: Column, max_vocabulary: int = MAX_VOCABULARY) -> DataFrame:
    """Learn from the rows where ``train`` holds and score every row of (doc_id, text).

    doc_id, held_out, n_tokens (words and the end), n_known, train_tokens, base_score, score.  A null
    text is empty and consists of its end; a null doc_id stays null; repeated rows are texts of their
    own.  The score does not depend on ``max_vocabulary``.  Without training rows every word is unseen.  An empty table gives an empty result; other
    columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("bytes"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    n = packets(docs, BUCKET_BYTES)
    model, unigrams = _vocabulary(rows, max(4, n), max_vocabulary)
    sent = spark.sparkContext.broadcast(model)
    path = workspace(spark, "ngram-model")
    rows.mapInArrow(_grams(sent), ROW).groupBy("kind", "bucket").applyInArrow(_merge, ROW).write.partitionBy(
        "kind"
    ).parquet(path)
    table = spark.read.schema(ROW.replace("kind int, ", "") + ", kind int").parquet(path)
    run, kind = _history_sums(sent)
    sums = table.where(F.col("kind") != DOCS).select("kind", "grams").mapInArrow(run, kind)
    sums = sums.groupBy("history").agg(*[F.sum(c).alias(c) for c in sums.columns[1:]])
    full = spark.sparkContext.broadcast(_normalise(model, sums.toArrow()))
    parts = table.where(F.col("kind").isin(PAIRS, AFTER)).select("kind", "bucket", "grams", "data")
    rare = table.where(F.col("kind") == FROM).select("bucket", "grams", "data")
    wanted = rare.select("bucket", "grams").mapInArrow(_wanted, "bucket int, word long")
    counts = wanted.join(unigrams, "word").select("bucket", "word", "n")
    from_rare = rare.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInArrow(_evaluate_from(full), ROW)
    texts = table.where(F.col("kind") == DOCS).select("kind", "bucket", "batch", "grams", "data")
    done = texts.unionByName(parts.mapInArrow(_evaluate(full), ROW)).unionByName(from_rare).groupBy("batch").applyInArrow(
        _collect, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return done.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
