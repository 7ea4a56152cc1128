"""SentencePiece encoding and decoding, with a parallel scan inside giant documents.

The model at hand is a byte-pair one.  Its encoding of a text is the only sequence of pieces whose
neighbours are all compatible (the model encodes their concatenation as just these two), so it is
the best path in the max-plus semiring with weight 0 for compatible neighbours and -inf otherwise,
and it can be cut anywhere.  At a cut the state is the piece that covers or ends at the cut, as its
(start, end); there are at most as many as pieces can lie across one place.

A text longer than ``GIANT`` characters becomes chunks, each with as much text on either side as a
piece is long.  A chunk's transfer matrix tells which entry states lead to which exit states: an
entry that starts at a and an exit that ends at d agree if the encoding of text[a:d] begins and ends
with them.  No piece spans the place before a space that follows something else, so the matrix is
worked out from the stretches before the first and after the last such place; only a chunk without one
is encoded as a whole per pair of states.  Matrices are multiplied in order (max-plus, associative),
which fixes the state at every cut, and each chunk is encoded by itself between its two states.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import from_zero, ship, with_doc
from tidemark.session import stored

ship(__name__)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT = 32_768
NONE = float("-inf")
#: Bytes of text, and ids, that a task holds as Python objects at once; one row may have more.
MOST_BYTES, MOST_IDS = 2**20, 2**18
_loaded: dict[int, sentencepiece.SentencePieceProcessor] = {}
_spelt: dict[int, tuple[pa.Array, np.ndarray, np.ndarray] | None] = {}


def send_model(spark: SparkSession, path: str) -> Broadcast:
    """The model file, read by the driver; it has a fixed size."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def processor(data: bytes) -> sentencepiece.SentencePieceProcessor:
    key = hash(data)
    if key not in _loaded:
        _loaded[key] = sentencepiece.SentencePieceProcessor(model_proto=data)
    return _loaded[key]


def reach(sp: sentencepiece.SentencePieceProcessor) -> int:
    """Characters of the longest piece."""
    return max(len(sp.id_to_piece(i)) for i in range(sp.get_piece_size()))


def inner(sp: sentencepiece.SentencePieceProcessor, text: str) -> list[tuple[int, int]]:
    """(id, characters) of the pieces of a text that does not stand at the start of a document.

    A line feed in front keeps the space that is put before a text from joining it.
    """
    ids = sp.encode("\n" + text)[2:]
    out, rest = [], 0
    for i in ids:
        if sp.is_byte(i):  # the bytes of one character count once, at their first
            lead = int(sp.id_to_piece(i)[3:5], 16)
            out.append((i, 0 if 0x80 <= lead < 0xC0 else 1))
        else:
            out.append((i, len(sp.id_to_piece(i))))
    return out


def ends(sp, text: str) -> tuple[int, int]:
    """Characters of the first and of the last piece of a text; bytes of one character go together."""
    sizes: list[int] = []
    for _, n in inner(sp, text):
        if n:
            sizes.append(n)
    return (sizes[0], sizes[-1]) if sizes else (0, 0)


def slices(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``most`` of ``sizes`` (one figure per row, null: 0), or of one row."""
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def compose(a: dict, b: dict) -> dict:
    """Max-plus product of two transfer matrices {entry: {exit: weight}}."""
    out: dict = {}
    for entry, row in a.items():
        best: dict = {}
        for middle, w in row.items():
            for exit_, v in b.get(middle, {}).items():
                best[exit_] = max(best.get(exit_, NONE), w + v)
        if best:
            out[entry] = best
    return out


def transfer(sp, piece: str, at: int, to: int, shift: int, first: bool, last: bool, width: int) -> dict:
    """Transfer matrix of the chunk piece[at:to]; states are absolute, ``shift`` is where piece starts."""
    piece = piece.replace("\u2581", " ")  # the model reads both alike
    breaks = [m for m in range(max(at, 1), to + 1) if piece[m : m + 1] == " " and piece[m - 1] != " "]
    starts = [at] if first else list(range(max(0, at - width), at))
    stops = [to] if last else list(range(to, min(len(piece), to + width) + 1))
    name_first, name_last = (-1, -1), (-2, -2)

    def entry(a: int, n: int):
        return name_first if first else ((a + shift, a + n + shift) if a + n >= at else None)

    def exit_(d: int, n: int):
        return name_last if last else ((d - n + shift, d + shift) if d - n < to else None)

    if not breaks:
        out: dict = {}
        for a in starts:
            for d in stops:
                head, tail = ends(sp, (" " if first else "") + piece[a:d])
                i, o = entry(a, head), exit_(d, tail)
                if i and o and (head or first):
                    out.setdefault(i, {})[o] = 0.0
        return out
    into = {entry(a, ends(sp, piece[a : breaks[0]])[0]) for a in starts} - {None}
    onto = {exit_(d, ends(sp, piece[breaks[-1] : d])[1]) for d in stops if d > breaks[-1] or last} - {None}
    if breaks[-1] == to and not last:
        # the cut lies on such a place: the last piece ends there, or the next one begins beyond it
        back = breaks[-2] if len(breaks) > 1 else None
        if back is not None:
            onto = {exit_(to, ends(sp, piece[back:to])[1])} - {None}
        else:
            tails = {a: ends(sp, (" " if first else "") + piece[a:to]) for a in starts}
            return {
                i: {o: 0.0}
                for a, (h, t) in tails.items()
                if (i := entry(a, h)) and (o := exit_(to, t))
            }
    return {i: dict.fromkeys(onto, 0.0) for i in into}


def _by_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from slices(b, pc.binary_length(b["piece"]), MOST_BYTES)


def _packed(matrix: dict) -> str:
    return json.dumps([[list(i), [[list(o), w] for o, w in row.items()]] for i, row in matrix.items()])


def _unpacked(text: str) -> dict:
    return {tuple(i): {tuple(o): w for o, w in row} for i, row in json.loads(text)}


def _transfers(sent: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(sent.value)
        width = reach(sp)
        for b in _by_piece(batches):
            found = [
                _packed(transfer(sp, r["piece"], r["at"] - r["shift"], r["to"] - r["shift"], r["shift"], r["c"] == 0, r["last"], width))
                for r in b.to_pylist()
            ]
            yield pa.RecordBatch.from_pydict({"key": b["key"], "c": b["c"], "matrix": pa.array(found, pa.string())})

    return run


def states(matrices: list[dict]) -> list[tuple]:
    """Entry state of every chunk on the best path, and the exit of the last."""
    prefix = [matrices[0]]
    for m in matrices[1:]:
        prefix.append(compose(prefix[-1], m))
    at = (-2, -2)
    path = [at]
    for k in range(len(matrices) - 1, -1, -1):
        reached = {(-1, -1): 0.0} if k == 0 else prefix[k - 1].get((-1, -1), {})
        options = [(reached[i] + row[at], i) for i, row in matrices[k].items() if i in reached and at in row]
        at = max(options)[1]
        path.append(at)
    return path[::-1]


def _scan(table: pa.Table) -> pa.Table:
    table = table.sort_by("c")
    path = states([_unpacked(m) for m in table["matrix"].to_pylist()])
    return pa.table({
        "key": table["key"],
        "c": table["c"],
        "start": pa.array([s[0] for s in path[:-1]], pa.int64()),
        "skip": pa.array([s[1] for s in path[:-1]], pa.int64()),
        "stop": pa.array([s[1] for s in path[1:]], pa.int64()),
    })


def _encode_chunks(sent: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(sent.value)
        for b in _by_piece(batches):
            out = []
            for r in b.to_pylist():
                stop = r["to"] if r["last"] else r["stop"]
                if r["c"] == 0:
                    out.append(sp.encode(r["piece"][: stop - r["shift"]]))
                    continue
                pieces, gone = inner(sp, r["piece"][r["start"] - r["shift"] : stop - r["shift"]]), r["start"]
                k = 0
                while k < len(pieces) and (gone < r["skip"] or pieces[k][1] == 0):
                    gone += pieces[k][1]
                    k += 1
                out.append([i for i, _ in pieces[k:]])
            yield pa.RecordBatch.from_pydict({
                "key": b["key"], "c": b["c"], "ids": pa.array(out, pa.list_(pa.int32()))
            })

    return run


def _encode_rows(sent: Broadcast, text: str):
    """``text`` names the field of ``doc`` that is encoded, so that a batch holds it once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(sent.value)
        for b in batches:
            for part in slices(b, pc.binary_length(pc.struct_field(b["doc"], text)), MOST_BYTES):
                texts = pc.struct_field(part["doc"], text).to_pylist()
                ids = sp.encode([t or "" for t in texts], num_threads=1)
                arrays = [None if t is None else np.array(i, np.int32) for t, i in zip(texts, ids)]
                yield pa.RecordBatch.from_arrays([part["doc"], pa.array(arrays, pa.list_(pa.int32()))], ["doc", "ids"])

    return run


def encode(docs: DataFrame, model: str = MODEL, giant: int = GIANT) -> DataFrame:
    """``doc`` (struct of the columns of docs) and ``ids`` per row of docs.

    ``giant`` is the length of chunks and must be well above the longest piece.
    A null text has null ids, an empty one none.  Repeated rows stay; a giant text that occurs several
    times is encoded once.  An empty table gives an empty result; extra columns stay inside ``doc``.
    """
    sent = send_model(docs.sparkSession, model)
    width = reach(processor(sent.value))
    if giant < 2 * width:
        raise ValueError("chunks must be longer than two pieces")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").alias("whole"))
    is_giant = F.coalesce(F.length("whole") > giant, F.lit(False))
    name = next(c for c in docs.columns if c.lower() == "text")
    small = whole.where(~is_giant).select("doc").mapInArrow(_encode_rows(sent, name), with_doc(whole, "ids array<int>"))
    key = F.sha2(F.col("whole").cast("binary"), 256).alias("key")
    large = whole.where(is_giant)
    texts = large.select(key, "whole").dropDuplicates(["key"])
    size = F.length("whole")

    def chunk(i: Column) -> Column:
        at, to = i, F.least(i + giant, size)
        shift = F.greatest(F.lit(0), at - width)
        return F.struct(
            (i / giant).cast("int").alias("c"), at.cast("long").alias("at"), to.cast("long").alias("to"),
            shift.cast("long").alias("shift"), (to == size).alias("last"),
            F.substr(F.col("whole"), shift + 1, to + width - shift).alias("piece"),
        )

    chunks = stored(
        texts.select("key", F.explode(F.transform(from_zero(size, giant), chunk)).alias("x")).select("key", "x.*"),
        "giant-chunks",
    )
    matrices = chunks.mapInArrow(_transfers(sent), "key string, c int, matrix string")
    found = matrices.groupBy("key").applyInArrow(_scan, "key string, c int, start long, skip long, stop long")
    coded = chunks.join(found, ["key", "c"]).mapInArrow(_encode_chunks(sent), "key string, c int, ids array<int>")
    ordered = F.array_sort(F.collect_list(F.struct("c", "ids")))
    # the parts of one text, which its row has to hold anyway
    joined = coded.groupBy("key").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
    return small.unionByName(large.select("doc", key).join(joined, "key").select("doc", "ids"))


def spelling(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray] | None:
    """(bytes of every piece, whether it starts with a space, whether only the library knows what it decodes to);
    None if the model does not drop just the space that is put before a text."""
    key = hash(data)
    if key not in _spelt:
        sp = processor(data)
        n, space = sp.get_piece_size(), sp.piece_to_id("\u2581")
        names = [sp.id_to_piece(i) for i in range(n)]
        shown = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(names)]
        opens = np.array([p.startswith("\u2581") for p in names])
        odd = np.array([sp.is_control(i) or sp.is_unknown(i) for i in range(n)])
        one = not sp.is_unknown(space) and sp.decode([space, space]) == " "
        _spelt[key] = (pa.array(shown, pa.binary()), opens, odd) if one else None
    return _spelt[key]


def texts_of(data: bytes, ids: pa.Array) -> pa.Array:
    """What lists of ids decode to.  The bytes of the pieces are joined as Arrow arrays; lists with control or unknown
    pieces, or whose bytes are no UTF-8, are left to the library, with those beside them."""
    known, flat = spelling(data), ids.flatten()
    if known and not flat.null_count:
        shown, opens, odd = known
        numbers = flat.to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(numbers) or (0 <= numbers.min() and numbers.max() < len(odd) and not odd[numbers].any()):
            sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            first = np.zeros(len(sizes), bool)
            first[sizes > 0] = opens[numbers[offsets[:-1][sizes > 0]]]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), shown.take(flat), mask=ids.is_null())
            joined = pc.binary_join(lists, b"")
            try:
                return pc.if_else(pa.array(first), pc.binary_slice(joined, 1, None), joined).cast(pa.string())
            except pa.ArrowInvalid:
                pass
    rows = ids.to_pylist()
    found = processor(data).decode([i or [] for i in rows], num_threads=1) if rows else []
    return pa.array([None if i is None else t for i, t in zip(rows, found)], pa.string())


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """encoded (``doc``, ``ids``) with ``decoded`` appended; null ids decode to null."""
    sent = send_model(encoded.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, pc.list_value_length(b["ids"]), MOST_IDS):
                yield pa.RecordBatch.from_arrays(
                    [part["doc"], part["ids"], texts_of(sent.value, part["ids"])], ["doc", "ids", "decoded"]
                )

    return encoded.select("doc", "ids").mapInArrow(run, with_doc(encoded, "ids array<int>, decoded string"))
