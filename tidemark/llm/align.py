"""Alignment of two tokenizers over the same bytes, on Arrow arrays.

Both token sequences of a text (A: byte-level pairs, B: pieces) spell the same bytes, so a token is an
interval between byte offsets.  Per slice of texts the id lists are flattened with their parent
indices, token lengths are taken from a table and summed up, which gives every token its end offset,
and an Acero full outer join of both tables on the end offset gives one row per place where a token of
either side ends.  Such a row is exactly one pair of overlapping tokens (a link); where both sides
end, a group ends too.  ``Table.group_by`` turns links into counted pairs per text.

How many documents hold a pair is counted by ``Table.group_by`` inside tasks and summed by Spark.  The
counts come back to the texts in two ways with the same result: those of the ``HOT`` most frequent
pairs are broadcast (17 bytes each), all others meet their texts in a join on the pair.

A text longer than ``SEGMENT`` characters is encoded segment by segment, cut before a space between two
characters that are no white space: there both tokenizers start a new token.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ship, with_doc
from tidemark.session import workspace

ship(__name__)

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: How byte-level files of this kind cut texts before they merge bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEGMENT, SLICE_BYTES, HOT = 1 << 17, 1 << 18, 1 << 20
#: Rows of one Arrow batch that are worked on at a time.
ROWS = 128
PARTIAL_ROWS = 1 << 20


def byte_of_char() -> dict[str, int]:
    """The byte behind every character of a byte-level vocabulary.

    Printable characters stand for themselves, the other bytes in order for those from U+0100 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def spellings(byte_level: str) -> dict[bytes, int]:
    """Bytes and id of every token of a byte-level file, special tokens left out.

    Ids have to follow the order of the merges, so that a smaller id merges first.
    """
    file = json.loads(byte_level)
    model, chars = file["model"], byte_of_char()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
    in_order = [model["vocab"][x + y] for x, y in merges]
    cut = file["pre_tokenizer"]
    if in_order != sorted(in_order) or file.get("normalizer") or cut["type"] != "ByteLevel" or not cut["use_regex"]:
        raise ValueError("not a plain byte-level file whose ids follow its merges")
    special = {t["content"] for t in file["added_tokens"]}
    return {bytes(chars[c] for c in t): i for t, i in model["vocab"].items() if t not in special}


class Pair:
    """Both tokenizers and, by id, the bytes and the decimal name of their tokens."""

    def __init__(self, byte_level: str, pieces: bytes):
        spelling = spellings(byte_level)
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=spelling, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        by_id = {i: x for x, i in spelling.items()}
        self.bytes_a = pa.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], pa.binary())
        self.bytes_b = pa.array([self._piece(i) for i in range(self.b.get_piece_size())], pa.binary())
        self.len_a, self.len_b = (pc.binary_length(x).cast(pa.int64()) for x in (self.bytes_a, self.bytes_b))
        self.name_a, self.name_b = (pa.array(range(len(x)), pa.int32()).cast(pa.string()) for x in (self.bytes_a, self.bytes_b))
        #: pair code = a * width + b
        self.width = len(self.bytes_b)

    def _piece(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def encode_a(self, segments: list[str]) -> list[list[int]]:
        """The space in front of a text belongs to its first segment."""
        return [self.a.encode_ordinary(s) for s in segments]

    def encode_b(self, segments: list[str], first: list[bool]) -> list[list[int]]:
        """The model puts a space before what it encodes: a first segment comes without its own, any
        other behind a line feed, whose two pieces are cut off."""
        ids = self.b.encode([s[1:] if f else "\n" + s for s, f in zip(segments, first)], num_threads=1)
        return [x if f else x[2:] for x, f in zip(ids, first)]


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """Parts of a text of about ``size`` characters, cut where both tokenizers start anew."""
    out, begin = [], 0
    while len(text) - begin > size:
        at = text.find(" ", begin + size)
        while at >= 0 and (at + 1 >= len(text) or text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[begin:at])
        begin = at
    return [*out, text[begin:]]


def lists(ids: list[list[int]]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.concatenate([np.array(x, np.int32) for x in ids]) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def spelled(ids: pa.ListArray, names: pa.BinaryArray, want: list[bytes]) -> np.ndarray:
    """For every list, whether its tokens joined are the wanted bytes."""
    joined = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, names.take(ids.flatten())), b"")
    return pc.equal(joined, pa.array(want, pa.binary())).to_numpy(zero_copy_only=False)


def ones(mask: pa.Array) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False).astype(np.int64)


def overlaps(pair: Pair, a: pa.ListArray, b: pa.ListArray) -> tuple[pa.Table, pa.Array, np.ndarray]:
    """(links, group texts, groups per list) of lists that spell the same bytes, in order.

    links: list, code.  Ends are offsets in all lists joined, so they name the list as well.
    """
    flat_a, flat_b = a.flatten(), b.flatten()
    ends_a = pa.table({"end": pc.cumulative_sum(pair.len_a.take(flat_a)), "in_a": pa.nulls(len(flat_a), pa.bool_()).fill_null(True)})
    ends_b = pa.table({"end": pc.cumulative_sum(pair.len_b.take(flat_b)), "in_b": pa.nulls(len(flat_b), pa.bool_()).fill_null(True)})
    both = ends_a.join(ends_b, "end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
    in_a, in_b = (ones(both[c].combine_chunks().is_valid()) for c in ("in_a", "in_b"))
    upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
    # the tokens that cover the bytes before an end are those after the ends before it
    at_a, at_b = pa.array(upto_a - in_a), pa.array(upto_b - in_b)
    code = flat_a.take(at_a).to_numpy().astype(np.int64) * pair.width + flat_b.take(at_b).to_numpy()
    of = pc.list_parent_indices(a).take(at_a)
    links = pa.table({"list": of, "code": pa.array(code)})
    common = (in_a & in_b).astype(bool)
    cut_a, cut_b = (np.concatenate([[0], x[common]]).astype(np.int32) for x in (upto_a, upto_b))
    text_a = pc.binary_join(pa.ListArray.from_arrays(pa.array(cut_a), pair.name_a.take(flat_a)), ",")
    text_b = pc.binary_join(pa.ListArray.from_arrays(pa.array(cut_b), pair.name_b.take(flat_b)), ",")
    groups = pc.binary_join_element_wise(text_a, text_b, "|")
    return links, groups, np.bincount(of.to_numpy()[common], minlength=len(a))


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs (or the sum of its weights)."""
    table = pa.table({"key": keys, "w": np.ones(len(keys), np.int64) if weights is None else weights})
    found = table.group_by("key", use_threads=False).aggregate([("w", "sum")]).sort_by("key")
    return found["key"].to_numpy(), found["w_sum"].to_numpy()


class Aligned:
    """What the segments of one text add up to."""

    def __init__(self, as_text: bool):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.texts: list[str] | None = [] if as_text else None
        self.hash = hashlib.sha256()
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, n_a: int, n_b: int, n_groups: int, n_links: int, text: str, codes, times) -> None:
        if self.texts is not None:
            self.texts.append(text)
        else:
            self.hash.update(((";" if self.n_groups else "") + text).encode())
        self.n_a, self.n_b = self.n_a + n_a, self.n_b + n_b
        self.n_groups, self.n_links = self.n_groups + n_groups, self.n_links + n_links
        self.codes.append(codes)
        self.times.append(times)

    def row(self) -> tuple:
        if not self.n_a:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, times = self.codes[0], self.times[0]
        if len(self.codes) > 1:
            codes, times = counted(np.concatenate(self.codes), np.concatenate(self.times))
        groups = self.hash.hexdigest() if self.texts is None else ";".join(self.texts)
        return self.n_a, self.n_b, self.n_groups, self.n_links, groups, codes, times


def align_texts(pair: Pair, texts: list[str | None], as_text: bool, segment: int = SEGMENT) -> list[tuple]:
    """n_a, n_b, n_groups, n_links, groups, pair codes and how often they are linked, per text."""
    out = [Aligned(as_text) for _ in texts]
    bad: set[int] = set()

    def flush(held: list[tuple[int, bool, str]]) -> None:
        held = [h for h in held if h[0] not in bad]
        if not held:
            return
        whole = [s.encode() for _, _, s in held]
        a = lists(pair.encode_a([s for _, _, s in held]))
        b = lists(pair.encode_b([s for _, _, s in held], [f for _, f, _ in held]))
        good = spelled(a, pair.bytes_a, whole) & spelled(b, pair.bytes_b, whole)
        bad.update(h[0] for h, g in zip(held, good) if not g)
        right = np.array([h[0] not in bad for h in held])
        if not right.any():
            return
        if not right.all():
            held = [h for h, r in zip(held, right) if r]
            a, b = (x.filter(pa.array(right)) for x in (a, b))
        links, groups, per_list = overlaps(pair, a, b)
        of = links["list"].to_numpy()
        span = len(pair.bytes_a) * pair.width
        keys, times = counted(of * np.int64(span) + links["code"].to_numpy())
        cuts = np.searchsorted(keys, np.arange(len(held) + 1, dtype=np.int64) * span)
        n_links = np.bincount(of, minlength=len(held))
        ends = np.concatenate([[0], np.cumsum(per_list)]).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), groups), ";").to_pylist()
        sizes_a, sizes_b = (x.value_lengths().to_numpy() for x in (a, b))
        for k, (i, _, _) in enumerate(held):
            mine = slice(cuts[k], cuts[k + 1])
            out[i].add(int(sizes_a[k]), int(sizes_b[k]), int(per_list[k]), int(n_links[k]), joined[k], keys[mine] - k * span, times[mine])

    waiting, size = [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        for k, part in enumerate(segments(" " + text, segment)):
            waiting.append((i, k == 0, part))
            size += len(part)
            if size >= SLICE_BYTES:
                flush(waiting)
                waiting, size = [], 0
    flush(waiting)
    return [Aligned(as_text).row() if i in bad else x.row() for i, x in enumerate(out)]


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string"


def _align(sent: Broadcast, as_text: bool, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n_a, n_b, n_groups, n_links, groups, codes, times = zip(
                    *align_texts(pair, part["text"].to_pylist(), as_text, segment)
                )
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in codes])]).astype(np.int32))
                codes, times = np.concatenate(codes), np.concatenate(times)
                sides = [codes // pair.width, codes % pair.width, times]
                columns = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)]
                columns += [pa.array(groups, pa.string())]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in sides]
                yield pa.RecordBatch.from_arrays(
                    [part["doc"], part["row"], *columns],
                    ["doc", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "a", "b", "times"],
                )

    return run


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n): in how many of the texts of the task a pair occurs; rows of a pair may repeat."""
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        found = pa.concat_tables(held).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
        return found.rename_columns(["a", "b", "n"])

    for batch in batches:
        a, b = batch["a"].flatten(), batch["b"].flatten()
        held.append(pa.table({"a": a, "b": b, "n": np.ones(len(a), np.int64)}))
        if sum(t.num_rows for t in held) > PARTIAL_ROWS:
            held = [merged()]
            if held[0].num_rows > PARTIAL_ROWS // 2:
                yield from held[0].to_batches()
                held = []
    if held:
        yield from merged().to_batches()


def _look_up(sent: Broadcast, names: list[str]):
    """Sums over the broadcast pairs per text; pairs that are not among them go on as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best, width = sent.value
        for batch in batches:
            a, b, times = (batch[c].flatten().to_numpy() for c in ("a", "b", "times"))
            of = pc.list_parent_indices(batch["a"]).to_numpy()
            code = a.astype(np.int64) * width + b
            at = np.minimum(np.searchsorted(codes, code), max(0, len(codes) - 1))
            known = codes[at] == code if len(codes) else np.zeros(len(code), bool)
            n, top = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
            n[known], top[known] = counts[at[known]], best[at[known]]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], of, n * times)
            np.add.at(sums[1], of, top * times)
            rest = np.bincount(of[~known], minlength=batch.num_rows)
            offsets = pa.array(np.concatenate([[0], np.cumsum(rest)]).astype(np.int32))
            left = [pa.ListArray.from_arrays(offsets, pa.array(x[~known])) for x in (a, b, times)]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in names] + [pa.array(s) for s in sums] + left,
                [*names, "count_sum", "n_best", "a", "b", "times"],
            )

    return run


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = workspace(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def send_tokenizers(spark: SparkSession, byte_level: str, pieces: str) -> Broadcast:
    """Both files, read by the driver; they have a fixed size."""
    with open(byte_level, encoding="utf-8") as x, open(pieces, "rb") as y:
        return spark.sparkContext.broadcast((x.read(), y.read()))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): documents that hold a pair, and whether no pair of a has more."""
    counts = (
        aligned.select("a", "b")
        .mapInArrow(_partial_counts, "a int, b int, n long")
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"))
    )
    counts = _kept(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    # one row per id of the first vocabulary
    return counts.join(F.broadcast(most), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of counts with the largest n: whole size classes, as many as fit in ``most`` rows."""
    kind = F.floor(F.log2("n") * 8)
    # at most eight classes per power of two
    sizes = counts.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("rows")).collect()
    least, total = None, 0
    for r in sorted(sizes, key=lambda r: -r["kind"]):
        total += r["rows"]
        if total > most:
            break
        least = r["kind"]
    return counts.where(F.lit(False) if least is None else kind >= least)


def align(
    docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, as_text: bool = True,
    columns: list[str] | None = None, segment: int = SEGMENT, hot: int = HOT,
) -> DataFrame:
    """Alignment of both tokenizers per row of docs, in any order.

    Returns ``doc`` (struct of ``columns``, by default all), n_a, n_b (tokens), n_groups, n_links
    (overlapping pairs), groups (``a1,a2|b1;a3|b2,b3``, or the SHA-256 of that if not ``as_text``),
    n_best (links whose pair is held by the most documents among those of its A id, ties included) and
    count_sum (documents that hold the pair, summed over links).

    A text that is null or empty, or that either tokenizer does not spell back, has no tokens: zeros and
    an empty string.  Repeated rows count as documents of their own.  An empty table gives an empty
    result; extra columns stay inside ``doc``.
    """
    spark = docs.sparkSession
    sent = send_tokenizers(spark, byte_level, pieces)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("doc"),
        F.monotonically_increasing_id().alias("row"),  # fixed once written
        "text",
    )
    found = rows.mapInArrow(
        _align(sent, as_text, segment),
        with_doc(rows, f"row long, {ALIGNED}, a array<int>, b array<int>, times array<int>"),
    )
    aligned = _kept(found, "aligned")
    counts = pair_counts(aligned)
    top = most_frequent(counts, hot).toArrow()
    width = Pair(*sent.value).width
    code = top["a"].to_numpy().astype(np.int64) * width + top["b"].to_numpy()
    order = np.argsort(code)
    table = (
        code[order], top["n"].to_numpy()[order],
        top["best"].to_numpy(zero_copy_only=False).astype(np.int64)[order], width,
    )
    names = ["doc", "row", "n_a", "n_b", "n_groups", "n_links", "groups"]
    looked = aligned.mapInArrow(
        _look_up(spark.sparkContext.broadcast(table), names),
        with_doc(
            aligned, f"row long, {ALIGNED}, count_sum long, n_best long, a array<int>, b array<int>, times array<int>"
        ),
    )
    looked = _kept(looked, "looked-up")
    rest = looked.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("x")).select("row", "x.*")
    more = rest.join(counts, ["a", "b"]).groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
        F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("more_best"),
    )
    return looked.join(more, "row", "left").select(
        "doc", "n_a", "n_b", "n_groups", "n_links", "groups",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )
