"""Removal of repeated passages by longest-previous-factor arrays.

Every byte covered by a ``length``-byte string that also starts in a document with a smaller id goes.
Sorting all suffixes of a corpus would move each byte ``length`` times, so only suffixes that can
matter are sorted, which loses none:

1. Every window of ``length`` bytes has an anchor, the smallest hash of its ``SEED``-byte substrings,
   so equal windows have equal anchors.  Packets of documents send their distinct anchor hashes to
   buckets (4 bytes each); a bucket tells each packet which of its hashes more than one document has.
2. Packets send the stretches of text around shared anchors (windows that share an anchor and follow
   each other are one stretch) to the bucket of the anchor.  Of equal stretches in a packet only the
   first is sent; those of later documents are repeats already, and a document's own share its fate.
   Anchors that may have more than ``HOT_WINDOWS`` windows are not dealt as stretches: each of their windows
   goes to the bucket of a hash of the whole window, once per packet, so equal windows still meet.
3. A bucket sorts the suffixes that start at its windows, up to the ends of their stretches, ties by
   document, and takes the LCPs of neighbours.  The nearest suffixes of a smaller document before (PSV)
   and after (NSV) have the longest earlier matches, LPF = max(LCP(PSV), LCP(NSV)).  Windows with
   LPF >= length go.  A value below length changes nothing, so suffixes whose first ``length`` bytes are
   their own get no neighbours (LPF 0), and values end where the stretch does.
4. Spans go back to the packets, which cut them out.

Documents with equal texts are one class first: all but the smallest id are repeats as a whole.  All
steps are one plan; the exchange that deals documents to packets is reused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packets, ship, with_doc

ship(__name__)

LENGTH, SEED = 50, 24
PACKET_BYTES, PIECE_BYTES = 2 << 20, 256 << 10
STRETCH = 64  # windows; runs longer than two anchors are periodic text, whose stretches repeat
HOT_WINDOWS, FEW = 1 << 17, 64  # an anchor's windows in a packet are counted above FEW only
NOTE = "g int, bucket int, id long, data binary"


def mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def _runs(piece: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of up to STRETCH windows with one anchor: start, number of windows, anchor hash.

    Windows stay inside ``ends``, the end of the text that each byte belongs to.
    """
    n = len(piece)
    a = np.frombuffer(piece + bytes(length), np.uint8)
    word = np.lib.stride_tricks.as_strided(a, (n + SEED - 8, 8), (1, 1)).copy().view(np.uint64).ravel()
    h = mix(word[:n])
    for at in range(8, SEED, 8):
        h = mix(h ^ word[at : at + n])
    wide, step = length - SEED + 1, 1
    m = np.concatenate([h, np.full(wide, np.uint64(0xFFFFFFFFFFFFFFFF))])
    while step * 2 <= wide:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    if wide > step:
        m = np.minimum(m[: step - wide], m[wide - step :])
    m = m[:n]
    ok = np.arange(n) + length <= ends
    new = ok.copy()
    new[1:] &= (m[1:] != m[:-1]) | ~ok[:-1]
    starts = np.flatnonzero(new)
    counts = np.bincount(np.cumsum(new)[ok] - 1, minlength=len(starts)) if len(starts) else np.zeros(0, np.int64)
    parts = -(-counts // STRETCH)
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    starts, counts = np.repeat(starts, parts) + STRETCH * step, np.repeat(counts, parts) - STRETCH * step
    return starts, np.minimum(counts, STRETCH), m[starts]


def anchor_runs(texts: list[bytes], length: int):
    """(document index, start, windows, hash) arrays over all texts, in pieces of bounded size."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > PIECE_BYTES:  # a long text goes in overlapping slices
            text = texts[at]
            for lo in range(0, len(text) - length + 1, PIECE_BYTES):
                cut = text[lo : lo + PIECE_BYTES + length - 1]
                s, c, h = _runs(cut, np.full(len(cut), len(cut)), length)
                yield np.full(len(s), at), s + lo, c, h
            at += 1
            continue
        to, size = at, 0
        while to < len(texts) and size + len(texts[to]) <= PIECE_BYTES:
            size += len(texts[to])
            to += 1
        sizes = np.array([len(t) for t in texts[at:to]])
        stops = np.cumsum(sizes)
        if size:
            s, c, h = _runs(b"".join(texts[at:to]), np.repeat(stops, sizes), length)
            owner = np.searchsorted(stops, s, side="right")
            yield owner + at, s - (stops - sizes)[owner], c, h
        at = to


def joined(parts, width: int = 4):
    parts = list(parts)
    if not parts:
        return [np.zeros(0, np.int64)] * (width - 1) + [np.zeros(0, np.uint64)]
    return [np.concatenate(x) for x in zip(*parts)]


def note_table(rows: list[tuple]) -> pa.Table:
    pa.default_memory_pool().release_unused()  # what earlier groups of the task have freed
    g, b, i, d = zip(*rows) if rows else ((), (), (), ())
    return pa.table({
        "g": pa.array(g, pa.int32()), "bucket": pa.array(b, pa.int32()),
        "id": pa.array(i, pa.int64()), "data": pa.array(d, pa.binary()),
    })


def class_heads(docs: pa.Table, notes: pa.Table) -> list[tuple[int, bytes]]:
    """Different (id, text) of the packet's rows whose id is the first of a text, in order."""
    heads = set(notes["id"].drop_null().to_pylist())
    texts = docs["bytes"]
    return sorted({(i, texts[k].as_py()) for k, i in enumerate(docs["id"].to_pylist()) if i in heads})


SHIFT = 40


def offsets_of(heads: list[tuple[int, bytes]]) -> list[int]:
    """What is added to places in a text, so that different texts of one id stay apart."""
    out: list[int] = []
    for k, (i, _) in enumerate(heads):
        out.append(out[-1] + (1 << SHIFT) if k and heads[k - 1][0] == i else 0)
    return out


def hash_request(g: int, h: np.ndarray, owner: np.ndarray, bits: int, windows: np.ndarray | None = None) -> list[tuple]:
    """Rows (g, bucket, null, data) with the distinct hashes; flags tell which of them have several owners.

    Equal hashes must come with ascending owners.  With ``windows``, the hashes with more than FEW tell their sum.
    """
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    last = np.concatenate([first[1:], [len(h)]]) - 1
    several = owner[first] != owner[last]
    h = h[first]
    sums = np.add.reduceat(windows[order], first) if windows is not None else np.zeros(len(h), np.int64)
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    low = (h >> np.uint64(32 - bits)).astype(np.uint32)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        # the count goes first; flags behind the hashes
        data = np.array([b - a], np.uint32).tobytes() + low[a:b].tobytes() + np.packbits(several[a:b]).tobytes()
        many = np.flatnonzero(sums[a:b] > FEW)
        data += np.stack([many, np.minimum(sums[a:b][many], 0xFFFFFFFF)]).astype(np.uint32).tobytes()
        rows.append((g, int(bucket[a]), None, data))
    return rows


def _ask(bits: int, length: int):
    """Packet: its distinct anchor hashes, by bucket."""

    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return note_table([])
        heads = class_heads(docs, notes)
        g, ids = docs["g"][0].as_py(), np.array([i for i, _ in heads])
        owner, _, count, h = joined(anchor_runs([t for _, t in heads], length))
        if not len(h):
            return note_table([])
        return note_table(hash_request(g, h, ids[owner], bits, count))

    return run


def shared_hashes(table: pa.Table, classes: bool = False, hot: int | None = None) -> pa.Table:
    """Bucket: per packet, the hashes that more than one document has.

    With ``classes``, a byte per hash follows: the binary logarithm of how many packets have it.
    With ``hot``, rows of bucket -2 - bucket repeat those that may have more windows than that.
    """
    lows, flags, sizes, weights = [], [], [], []
    for data in table["data"].to_pylist():
        n = int(np.frombuffer(data, np.uint32, 1)[0])
        lows.append(np.frombuffer(data, np.uint32, n, 4))
        flags.append(np.unpackbits(np.frombuffer(data, np.uint8, -1, 4 + 4 * n), count=n).astype(bool))
        sizes.append(n)
        weights.append(np.full(n, FEW, np.int64))
        many = np.frombuffer(data[4 + 4 * n + -(-n // 8) :] or bytes(0), np.uint32).reshape(2, -1)
        weights[-1][many[0]] = many[1]
    weight = np.concatenate(weights)
    low, several = np.concatenate(lows), np.concatenate(flags)
    packet = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(low, kind="stable")
    low, several, packet, weight = low[order], several[order], packet[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    counts = np.diff(np.concatenate([first, [len(low)]]))
    inside = np.logical_or.reduceat(several, first)
    shared = np.repeat((counts > 1) | inside, counts)
    size = np.repeat(np.log2(counts + inside).astype(np.uint8), counts)
    above = np.repeat(np.add.reduceat(weight, first) > (np.inf if hot is None else hot), counts)
    low, packet, size, above = low[shared], packet[shared], size[shared], above[shared]
    order = np.argsort(packet, kind="stable")
    low, packet, size, above = low[order], packet[order], size[order], above[order]
    cuts = np.searchsorted(packet, np.arange(len(sizes) + 1))
    gs, bucket = table["g"].to_pylist(), table["bucket"][0].as_py()
    return note_table([
        (gs[k], bucket, None, low[a:b].tobytes() + (size[a:b].tobytes() if classes else b""))
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
        if b > a
    ] + [
        (gs[k], -2 - bucket, None, low[a:b][above[a:b]].tobytes())
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
        if above[a:b].any()
    ])


def _spans_row(g: int, bucket: int, ids, begins, ends) -> tuple:
    """A row of spans for packet g; id -1 marks it."""
    data = np.stack([np.asarray(x, np.int64) for x in (ids, begins, ends)]).tobytes()
    return g, bucket, -1, data


def _send(bits: int, wide: int, length: int):
    """Packet: stretches around shared anchors to their buckets, and the spans it can tell by itself."""

    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return note_table([])
        g = docs["g"][0].as_py()
        heads = class_heads(docs, notes)
        known, hot = [], [np.zeros(0, np.uint64)]
        for b, d in zip(notes["bucket"].to_pylist(), notes["data"].to_pylist()):
            if d is not None:
                low = np.frombuffer(d, np.uint32).astype(np.uint64)
                (known if b >= 0 else hot).append((np.uint64(b if b >= 0 else -2 - b) << np.uint64(32)) | low)
        if not known:
            return note_table([])
        known, hot = np.sort(np.concatenate(known)), np.concatenate(hot)
        texts = [t for _, t in heads]
        offset = offsets_of(heads)
        by_bucket: dict[int, tuple[list, list]] = {}
        seen: dict[bytes, tuple[int, int]] = {}
        whole: dict[bytes, int] = {}
        local: list[tuple] = []

        def repeated(doc: int, begin: int, end: int) -> None:
            if local and local[-1][0] == doc and local[-1][1] <= begin <= local[-1][2]:
                begin, end = local[-1][1], max(end, local.pop()[2])
            local.append((doc, begin, end))

        def place_window(o: int, s: int, n: int, b: int) -> None:
            context, doc, s = texts[o][s : s + n + length - 1], heads[o][0], s + offset[o]
            if b < 0:  # dealt by the whole window
                b = xxhash.xxh3_64_intdigest(context) >> (64 - wide)
            found, again = by_bucket.setdefault(b, ([], []))
            first, place = seen.setdefault(context, (doc, len(found)))
            if first < doc:
                repeated(doc, s, s + n + length - 1)
            elif place < len(found):  # the document repeats itself: what holds there holds here
                again.append((place, s))
            else:
                found.append((doc, s, n, context))

        for owner, start, count, h in anchor_runs(texts, length):
            key = h >> np.uint64(32 - bits)
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            pick = np.flatnonzero(known[at] == key)
            bucket = (h[pick] >> np.uint64(64 - wide)).astype(np.int64)
            bucket[np.isin(key[pick], hot)] = -1
            for o, s, n, b in zip(owner[pick].tolist(), start[pick].tolist(), count[pick].tolist(), bucket.tolist()):
                if b >= 0:
                    place_window(o, s, n, b)
                    continue
                doc, end = heads[o][0], s + n + length - 1
                if whole.setdefault(texts[o][s:end], doc) < doc:
                    repeated(doc, s + offset[o], end + offset[o])
                    continue
                for k in range(s, s + n):
                    place_window(o, k, 1, -1)
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = []
        for b, (found, again) in by_bucket.items():
            if not found:
                continue
            sizes = np.array([len(found), len(again)], np.int64)
            figures = np.array([f[:3] for f in found], np.int64)
            repeats = np.array(again, np.int64)
            raw = sizes.tobytes() + figures.tobytes() + repeats.tobytes() + b"".join(f[3] for f in found)
            rows.append((g, b, None, pack(raw)))
        if local:
            rows.append(_spans_row(g, g % (1 << wide), *zip(*local)))
        return note_table(rows)

    return run


TIED = 1 << 30  # LCP of suffixes that are equal to their ends


def smaller_before(docs: np.ndarray, lcp: np.ndarray, levels: int) -> np.ndarray:
    """For every place the LCP with the nearest place before it of a smaller document (PSV).

    ``lcp`` is that of a place with the one before.  Places of document -1 end the search with what their
    ``lcp`` is; the first place is one.  Level k holds the minima over 2 ** k places, and a search takes the
    longest steps first that pass no smaller document, less than 2 ** levels places in all.
    """
    low, least = [docs], [lcp]
    for k in range(levels - 1):
        step = 1 << k
        shorter, narrower = low[-1].copy(), least[-1].copy()
        shorter[step:] = np.minimum(low[-1][step:], low[-1][:-step])
        narrower[step:] = np.minimum(least[-1][step:], least[-1][:-step])
        shorter[: 2 * step - 1] = -1
        low.append(shorter)
        least.append(narrower)
    at, found = np.maximum(np.arange(len(docs)) - 1, 0), lcp.copy()
    for k in reversed(range(levels)):
        jump = np.flatnonzero(low[k][at] >= docs)
        found[jump] = np.minimum(found[jump], least[k][at[jump]])
        at[jump] = np.maximum(at[jump] - (1 << k), 0)
    return found


def tied_factors(tails: list[np.ndarray], sizes: np.ndarray, run: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """LPF of suffixes that share their first ``length`` bytes with their run (``run`` ascends).

    Suffixes are ordered by run, then the eight-byte words of ``tails`` that follow, then document; LCPs of
    neighbours come from the first word in which they differ.
    """
    inner = np.lexsort([docs, *reversed(tails), run])
    lcp = np.full(len(inner), TIED)
    for k in reversed(range(len(tails))):
        word = tails[k][inner]
        differ = word[1:] ^ word[:-1]
        equal = sum((differ >> np.uint64(64 - 8 * j) == 0).astype(np.int64) for j in range(1, 8))
        lcp[1:] = np.where(differ != 0, length + 8 * k + equal, lcp[1:])
    # a place of document -1 before every run and after the last
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    lcp[starts] = 0
    levels = int(np.diff(np.concatenate([starts, [len(run)]])).max()).bit_length()
    ends = np.concatenate([starts, [len(run)]])
    order, edge = np.insert(docs[inner], ends, -1), np.insert(lcp, ends, 0)
    after = np.concatenate([[0], edge[:0:-1]])  # seen from behind, a place's neighbour is the next one
    found = np.maximum(smaller_before(order, edge, levels), smaller_before(order[::-1], after, levels)[::-1])
    out = np.empty(len(inner), np.int64)
    out[inner] = np.minimum(np.delete(found, ends + np.arange(len(ends))), sizes[inner])
    return out


def longest_previous(
    text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, docs: np.ndarray, length: int, block: int = 200_000
) -> np.ndarray:
    """LPF of suffixes of ``text``, ``sizes`` (>= length) bytes from ``starts``, against smaller ``docs``.

    0 stands for all values below ``length``: such suffixes leave as soon as their first ``length`` bytes are
    their own.  Suffixes are ordered by their first eight bytes, then blocks of whole ties by the rest, so
    the keys of one block are held at a time.  Behind its end a suffix counts as zero bytes, which changes no
    value where texts have none and never whether it reaches ``length``.
    """
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(text) + 1, 8), (1, 1))

    def key(at: np.ndarray, offset: int) -> np.ndarray:
        return words[at + offset].view(">u8").ravel().astype(np.uint64)

    def tail(at: np.ndarray, size: np.ndarray, offset: int) -> np.ndarray:
        left = np.clip(size - offset, 0, 8)
        word = key(np.minimum(at, len(text) - offset), offset)
        cut = (np.uint64(8) * (8 - np.maximum(left, 1)).astype(np.uint64)).astype(np.uint64)
        return np.where(left > 0, word >> cut << cut, np.uint64(0))

    offsets = [*range(8, length - 7, 8)] + ([length - 8] if length % 8 else [])
    head = key(starts, 0)
    order = np.argsort(head, kind="stable")
    head = head[order]
    ties = np.flatnonzero(np.concatenate([head[1:] != head[:-1], [True]])) + 1
    out, at = np.zeros(len(order), np.int64), 0
    while at < len(order):
        to = int(ties[np.searchsorted(ties, min(at + block, len(order)))])
        part = order[at:to]
        keys = [head[at:to], *[key(starts[part], o) for o in offsets]]
        inner = np.lexsort([*reversed(keys)])
        same = np.ones(len(inner) + 1, bool)
        same[[0, -1]] = False
        for k in keys:
            k = k[inner]
            same[1:-1] &= k[1:] == k[:-1]
        tied = np.flatnonzero(same[:-1] | same[1:])
        at = to
        if not len(tied):
            continue
        run, part = np.cumsum(~same[:-1])[tied], part[inner[tied]]
        begin, size = starts[part], sizes[part]
        tails = [tail(begin, size, o) for o in range(length, int(size.max()), 8)]
        out[part] = tied_factors(tails, size, run, docs[part], length)
    return out


def _sort(length: int):
    """Bucket: spans of the windows that an earlier document has, per packet."""

    def run(table: pa.Table) -> pa.Table:
        gs, marks, datas = table["g"].to_pylist(), table["id"].to_pylist(), table["data"].to_pylist()
        rows, parts, texts, whose, repeats, total = [], [], [], [], [], 0
        bucket = table["bucket"][0].as_py()
        unpack = zstandard.ZstdDecompressor().decompress
        del table
        for g, mark, data in zip(gs, marks, datas):
            if mark is not None:
                rows.append((g, bucket, mark, data))
                continue
            raw = unpack(data)
            n, m = np.frombuffer(raw, np.int64, 2).tolist()
            parts.append(np.frombuffer(raw, np.int64, 3 * n, 16).reshape(n, 3))
            repeats.append(np.frombuffer(raw, np.int64, 2 * m, 16 + 24 * n).reshape(m, 2) + [total, 0])
            texts.append(np.frombuffer(raw, np.uint8, -1, 16 + 24 * n + 16 * m))
            whose.append(np.full(n, g))
            total += n
        if not parts:
            return note_table(rows)
        doc, start, count = np.concatenate(parts).T
        whose, text = np.concatenate(whose), np.concatenate(texts)
        del parts, texts, datas
        sizes = count + length - 1
        base = np.cumsum(sizes) - sizes
        shift = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        left = np.repeat(sizes, count) - shift
        hit = longest_previous(text, np.repeat(base, count) + shift, left, np.repeat(doc, count), length) >= length
        del text, left
        # neighbouring windows that go become one span
        record = np.repeat(np.arange(len(doc)), count)
        begin = hit.copy()
        begin[1:] &= ~hit[:-1] | (record[1:] != record[:-1])
        end = hit.copy()
        end[:-1] &= ~hit[1:] | (record[1:] != record[:-1])
        at, to = np.flatnonzero(begin), np.flatnonzero(end)
        r = record[at]
        spans = np.stack([doc[r], start[r] + shift[at], start[r] + shift[to] + length], axis=1)
        # the same spans where a document repeats one of its stretches; r ascends
        again, place = np.concatenate(repeats).T
        low = np.searchsorted(r, again)
        copies = np.searchsorted(r, again, side="right") - low
        inner = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        source = np.repeat(low, copies) + inner
        moved = np.repeat(place - start[again], copies)
        spans = np.concatenate([spans, spans[source] + np.stack([0 * moved, moved, moved], axis=1)])
        r = np.concatenate([r, r[source]])
        order = np.argsort(whose[r], kind="stable")
        spans, owner = spans[order], whose[r][order]
        cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows.append(_spans_row(int(owner[a]), bucket, *spans[a:b].T))
        return note_table(rows)

    return run


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of text, and the number of maximal removed runs."""
    kept, at, runs = [], 0, 0
    end = -1
    for a, b in sorted(spans):
        if a > end:
            runs += 1
            kept.append(text[max(at, 0) : a])
        end = max(end, b)
        at = end
    kept.append(text[max(at, 0) :])
    return b"".join(kept), runs


def _finish(length: int):
    """Packet: cut the spans out of its documents."""

    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        heads, spans = set(), {}
        for i, data in zip(notes["id"].to_pylist(), notes["data"].to_pylist()):
            if data is None:
                heads.add(i)
                continue
            for doc, a, b in np.frombuffer(data, np.int64).reshape(3, -1).T.tolist():
                spans.setdefault(doc, []).append((a, b))
        # places of the texts of one id differ by multiples of 1 << SHIFT
        mine: dict[int, dict[bytes, int]] = {}
        pairs = {(i, t) for i, t in zip(docs["id"].to_pylist(), docs["bytes"].to_pylist()) if i in heads}
        for i, text in sorted(pairs):
            mine.setdefault(i, {})[text] = len(mine.get(i, ())) << SHIFT
        del pairs
        kept, runs, sizes = [], [], []
        for i, text in zip(docs["id"].to_pylist(), docs["bytes"].to_pylist()):
            if i in heads:
                at = mine[i][text]
                own = [(a - at, b - at) for a, b in spans.get(i, []) if a >> SHIFT == at >> SHIFT]
                left, n = cut_spans(text, own)
            else:
                left, n = (b"", 1) if len(text) >= length else (text, 0)
            kept.append(left)
            runs.append(n)
            sizes.append(len(text))
        whole = [x.decode("utf-8", "ignore") for x in kept]
        return pa.table({
            "doc": docs["doc"],
            "kept_text": pa.array(whole, pa.string()),
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_spans": pa.array(runs, pa.int64()),
            "kept": pa.array(kept, pa.binary()),
        })

    return run


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, packet_bytes: int = PACKET_BYTES, hot_windows: int = HOT_WINDOWS
) -> DataFrame:
    """Per row of docs: ``doc`` (struct of its columns but the text), n_bytes, n_removed, n_spans, kept (bytes), kept_text.

    ``kept_text`` leaves out bytes of characters that were cut in two.
    A null text is empty; a null doc_id counts as larger than all others.  Rows of one doc_id never
    count as earlier than each other, be their texts equal or not.  Texts under ``length`` bytes lose nothing.  An empty table gives
    an empty result; extra columns stay inside ``doc``.
    """
    n = packets(docs, packet_bytes)
    bits = max(1, min(20, (n // 4).bit_length()))
    wide = max(1, min(22, n.bit_length() + 1))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    packet = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    last = (1 << 63) - 1
    base = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("id"),
        F.struct(*kept).alias("doc"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"),
    ).select(packet.alias("g"), "id", "doc", "bytes")
    heads = (
        docs.select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("id"),
            F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("key"),
        )
        .groupBy("key")
        .agg(F.min("id").alias("id"))
        .select(packet.alias("g"), F.lit(-1).alias("bucket"), "id", F.lit(None).cast("binary").alias("data"))
    )
    dealt = base.groupBy("g")
    asked = dealt.cogroup(heads.groupBy("g")).applyInArrow(_ask(bits, length), NOTE)
    shared = asked.groupBy("bucket").applyInArrow(lambda t: shared_hashes(t, hot=hot_windows), NOTE)
    sent = dealt.cogroup(heads.unionByName(shared).groupBy("g")).applyInArrow(_send(bits, wide, length), NOTE)
    spans = sent.groupBy("bucket").applyInArrow(_sort(length), NOTE)
    done = dealt.cogroup(heads.unionByName(spans).groupBy("g")).applyInArrow(
        _finish(length), with_doc(base, "kept_text string, n_bytes long, n_spans long, kept binary")
    )
    return done.select("doc", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), "n_spans", "kept", "kept_text")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """docs with repeated passages cut out of the texts, all rows and columns kept.

    Null texts stay null.
    """
    mark = "__had_text"
    while mark in docs.columns:
        mark += "_"
    rows = remove_repeats(docs.withColumn(mark, F.col("text").isNotNull()), **options)
    text = F.when(F.col(f"doc.{mark}"), F.col("kept_text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
