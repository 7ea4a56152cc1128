"""Small fixtures for the corpus operators: brute force, edge cases, exact round trips."""

import math
import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import classifier, embed, jaccard, katz, licenses, mixing, pieces, queries, rules, suffix, urls
from tidemark.llm.common import table
from tidemark.llm.graph import components
SF = "/root/testdata/sf0.001"
SF_RULES = "/root/testdata/sf0.01"

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside; they must pass through unharmed.
EXTRA = ["doc", "size", "key", "g", "w", "score", "cell", "target", "bytes"]


def frame(spark, texts, **more):
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, None if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, DOC)
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(EXTRA)])


def word_soup(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 90))) for _ in range(n)]
    texts += [texts[0], texts[1] + " tail", texts[2].upper(), texts[3][:150] + " new words here " + texts[4][:200]]
    texts += ["", None, "one", "One", "a b c", "é" * 40 + texts[5], texts[5] + "\n" + texts[6], texts[7] * 30]
    return list(enumerate(texts)) + [(0, texts[0])]


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*[w[k:] for k in range(width)])) if len(w) >= width else frozenset([tuple(w)] if w else [])


# -- suffix-array dedup


def removed_by_force(rows, length):
    first, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, kept)
    return out


@pytest.mark.parametrize("packet", [300, 1 << 20])
def test_suffix_brute_force(spark, packet):
    rows = word_soup() + [(800, "spam " * 90), (801, "x" + "spam " * 70), (802, "spam " * 60 + "y " * 200), (799, "y " * 40)]
    got = suffix.remove_repeats(frame(spark, rows), packet_bytes=packet).collect()
    want = removed_by_force(rows, 50)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want[r["doc"]["doc_id"]]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("block", [7, 1 << 20])
def test_longest_previous_brute_force(seed, block):
    """LPF of every suffix against all suffixes of smaller documents, over texts with few letters."""
    rng = np.random.default_rng(seed)
    length, pieces_, starts, sizes, docs, at = 12, [], [], [], [], 0
    seedtext = rng.integers(97, 99, 60, dtype=np.uint8)
    for _ in range(40):
        piece = rng.integers(97, 99, int(rng.integers(length, 45)), dtype=np.uint8)
        if rng.random() < 0.6:
            a = int(rng.integers(0, 30))
            piece = seedtext[a : a + len(piece)][: len(piece)]
            piece = piece if len(piece) >= length else np.full(length + 3, 97, np.uint8)
        doc = int(rng.integers(0, 9))
        for k in range(len(piece) - length + 1):
            starts.append(at + k)
            sizes.append(len(piece) - k)
            docs.append(doc)
        pieces_.append(piece)
        at += len(piece)
    text = np.concatenate(pieces_)
    own = [bytes(text[a : a + n]) for a, n in zip(starts, sizes)]

    def common(x, y):
        return next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))

    want = [max((common(x, y) for y, e in zip(own, docs) if e < d), default=0) for x, d in zip(own, docs)]
    got = suffix.longest_previous(text, *(np.array(v) for v in (starts, sizes, docs)), length, block)
    assert got.tolist() == [w if w >= length else 0 for w in want]
    assert max(want) > length and 0 in got.tolist()


def test_suffix_keeps_a_column_called_like_its_mark(spark):
    df = frame(spark, [(1, "a" * 60), (2, None)]).withColumn("__had_text", F.lit("mine"))
    assert sorted((r["doc_id"], r["text"], r["__had_text"]) for r in suffix.without_repeats(df).collect()) == [
        (1, "a" * 60, "mine"), (2, None, "mine")
    ]


def test_suffix_zero_bytes(spark):
    rows = [(1, "a" * 49 + "\0" * 70), (2, "b" + "\0" * 70), (3, "a" * 49 + "\0"), (4, "\0" * 49), (5, "\0" * 51 + "c")]
    want = removed_by_force(rows, 50)
    for r in suffix.remove_repeats(frame(spark, rows)).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want[r["doc"]["doc_id"]]


def test_suffix_hot_anchors_brute_force(spark):
    """The windows of every shared anchor dealt one by one."""
    footer = "written with the kind help of all of us on "
    rows = word_soup() + [(900 + k, f"{k * 7919 % 1000} {footer} {k % 17} {k}") for k in range(60)]
    rows += [(800, "spam " * 90), (801, "x" + "spam " * 70), (799, "y " * 40)]
    want = removed_by_force(rows, 50)
    for r in suffix.remove_repeats(frame(spark, rows), packet_bytes=2000, hot_windows=1).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want[r["doc"]["doc_id"]]


def test_suffix_hot_anchor_is_spread():
    """A passage of 40 bytes with other surroundings in every document does not go to one bucket."""
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401
    import zstandard

    rng = np.random.default_rng(5)
    bits, wide, packets = 1, 6, []
    passage = bytes(rng.integers(97, 123, 40, dtype=np.uint8))
    for g in range(2):
        texts = [bytes(rng.integers(97, 123, 60, dtype=np.uint8)) + passage + bytes(rng.integers(97, 123, 60, dtype=np.uint8)) for _ in range(300)]
        ids = [g * 1000 + k for k in range(300)]
        packets.append((
            pa.table({"g": pa.array([g] * 300, pa.int32()), "id": pa.array(ids, pa.int64()), "bytes": texts}),
            suffix.note_table([(g, -1, i, None) for i in ids]),
        ))
    asked = pa.concat_tables(suffix._ask(bits, 50)(*p) for p in packets)
    told = pa.concat_tables(
        suffix.shared_hashes(asked.filter(pa.compute.equal(asked["bucket"], b)), hot=500) for b in set(asked["bucket"].to_pylist())
    )
    windows = Counter()
    for g, (docs, heads) in enumerate(packets):
        notes = pa.concat_tables([heads, told.filter(pa.compute.equal(told["g"], g))])
        for r in suffix._send(bits, wide, 50)(docs, notes).to_pylist():
            if r["id"] is None:
                raw = zstandard.ZstdDecompressor().decompress(r["data"])
                n = int(np.frombuffer(raw, np.int64, 1)[0])
                windows[r["bucket"]] += int(np.frombuffer(raw, np.int64, 3 * n, 16).reshape(n, 3)[:, 2].sum())
    assert sum(windows.values()) > 5000
    assert max(windows.values()) < sum(windows.values()) / 10


def test_suffix_texts_of_one_id(spark):
    a, b = "abcdefghij" * 8 + "1", "klmnopqrst" * 8 + "2"
    df = frame(spark, [(1, a), (2, "left " + a + b), (2, b + " right"), (3, b)])
    got = sorted((r["doc"]["doc_id"], bytes(r["kept"]).decode()) for r in suffix.remove_repeats(df).collect())
    assert got == [(1, a), (2, b + " right"), (2, "left " + b), (3, "")]


def test_suffix_long_text_in_slices(spark, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE_BYTES", 200)
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 123, 1500, dtype=np.uint8))
    parts = [np.stack(x[1:3]) for x in suffix.anchor_runs([text], 50)]
    starts, counts = np.concatenate(parts, axis=1)
    covered = np.concatenate([np.arange(s, s + c) for s, c in zip(starts, counts)])
    assert sorted(covered.tolist()) == list(range(1500 - 49))


def test_suffix_text_keeps_columns_and_characters(spark):
    shared = "ö" * 60
    df = frame(spark, [(1, shared), (2, "x" + shared + "zé"), (3, None)])
    out = suffix.without_repeats(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: shared, 2: "xzé", 3: None}


# -- n-gram Jaccard join


def components_by_force(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("packet,block", [(400, 300), (1 << 20, 1 << 20)])
def test_jaccard_brute_force(spark, packet, block):
    rng = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    rows = word_soup()
    for k in range(40):  # a group of near copies at changing distances
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(60)] = f"c{rng.randrange(1000)}"
        rows.append((1000 + k, " ".join(w)))
    got = jaccard.clusters(frame(spark, rows), packet_bytes=packet, block_bytes=block).collect()
    want = components_by_force(rows, 4, 85)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]


def test_jaccard_keeps_rows_and_columns(spark):
    rows = word_soup()
    out = jaccard.keep_one(frame(spark, rows))
    heads = {i for i, (_, c) in components_by_force(rows, 4, 85).items() if i == c}
    assert out.columns == frame(spark, []).columns
    assert {r["doc_id"] for r in out.collect()} == heads


def test_jaccard_null_and_repeated_ids(spark):
    """Rows are linked and kept by their texts, whatever their ids."""
    def text(k, tail=""):
        return " ".join(f"t{k}w{j}" for j in range(60)) + tail

    rows = [(5, text(0)), (None, text(0, " x")), (None, text(1)), (None, text(1)), (None, text(1, " y")), (None, text(2))]
    rows += [(7, text(3)), (7, text(0, " z")), (7, text(4)), (8, text(5)), (8, text(5)), (8, text(5).upper())]
    rows += [(9, text(4, " q")), (None, None), (None, ""), (9, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_one(df).collect()]
    assert {c for c in kept if c[0] is None and c[1]} <= {(None, text(1)), (None, text(1, " y")), (None, text(2))}
    both = [c for c in kept if c in ((None, text(1)), (None, text(1, " y")))]
    assert len(both) == 1
    want = [(5, text(0)), (None, text(2)), (7, text(3)), (7, text(4)), (8, text(5).upper()), (None, None), (None, ""), (9, " \n")]
    assert Counter(kept) == Counter(want + both)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.clusters(df).collect())
    assert got == Counter([
        (5, 57, 5), (None, 58, 5), (None, 57, None), (None, 57, None), (None, 58, None), (None, 57, None),
        (7, 57, 7), (7, 58, 5), (7, 57, 7), (8, 57, 8), (8, 57, 8), (8, 57, 8), (9, 58, 7),
        (None, 0, None), (None, 0, None), (9, 0, 9),
    ])


# -- Katz backoff


def test_katz_is_normalised():
    words = np.sort(np.random.default_rng(0).integers(0, 2**62, 30).astype(np.uint64))
    counts = np.arange(30, 60)
    model = katz.Model(words, counts, int(counts.sum()) + 50 + 20, 81, 20, 4, np.array([1, 0.5, 0.8, 0.9, 0.95, 1.0]), 1.0, 0.02)
    top = model.word_p1(counts)
    end = 20 / model.tokens
    model.p1 = np.concatenate([top, [1 - top.sum() - end, end, 0.0]])
    rng = np.random.default_rng(1)
    seen = {}
    for h, c in enumerate(model.history_counts()):
        if h != model.end:
            for x in rng.integers(0, model.end + 1, c):
                key = h * model.classes + int(x)
                seen[key] = seen.get(key, 0) + 1
    keys = np.array(sorted(seen))
    c = np.array([seen[k] for k in keys.tolist()])
    import pyarrow as pa

    rows = []
    for h in np.unique(keys // model.classes):
        mine = c[keys // model.classes == h]
        x = keys[keys // model.classes == h] % model.classes
        rows.append((int(h), *[float((mine == r).sum()) for r in range(1, 7)], float(mine[mine > 5].sum()), model.p1[x].sum()))
    names = ["history", *[f"n{r}" for r in range(1, 7)], "large", "mass"]
    katz._normalise(model, pa.table(dict(zip(names, map(list, zip(*rows))))))
    for h in np.unique(keys // model.classes):
        every = h * model.classes + np.arange(model.classes - 1)  # the start never follows
        p = 10 ** katz.gram_log10(model, every, np.array([seen.get(k, 0) for k in every.tolist()]))
        assert abs(p.sum() - 1) < 1e-9


def test_katz_base_and_edges(spark):
    rows = word_soup()
    train = F.col("doc_id") % 4 != 0
    got = katz.score(frame(spark, rows), train, max_vocabulary=50).collect()
    counts = Counter()
    for i, t in rows:
        if i % 4:
            counts.update((t or "").encode().lower().split() + ["end"])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        tokens = (text[r["doc_id"]] or "").encode().lower().split() + ["end"]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r["score"] < 0 and math.isfinite(r["score"])
    seen = [r for r in got if not r["held_out"] and r["n_tokens"] > 5]
    assert sum(r["score"] for r in seen) > sum(r["base_score"] for r in seen)


def katz_by_force(texts, train):
    """Scores of all texts by plain Katz backoff, every word for itself."""
    tokens = [[*(t or "").encode().lower().split(), "end"] for t in texts]
    learned = [t for t, ok in zip(tokens, train) if ok]
    uni = Counter(w for t in learned for w in t[:-1])
    pairs = Counter(g for t in learned for g in zip(["start", *t], t))

    def discounts(counts):
        n_r = Counter(counts.values())
        return katz.discounts(np.array([0, *[n_r[r] for r in range(1, katz.GT + 2)]], float))

    def cut(c, d):
        return c * d[c] if c <= katz.GT else c

    n, d1, d2 = sum(uni.values()) + len(learned), discounts(uni), discounts(pairs)
    lost = sum(c - cut(c, d1) for c in uni.values()) / n
    scale = 1.0 if lost > 0 else n / (n + 1)
    p1 = {w: cut(c, d1) / n * scale for w, c in uni.items()} | {"end": len(learned) / n * scale}
    unseen = 1 - (1 - lost) * scale
    after = defaultdict(dict)
    for (h, x), c in pairs.items():
        after[h][x] = c

    def p2(h, x):
        seen = after.get(h, {})
        if not seen:
            return p1.get(x, unseen)
        kept, total = sum(cut(c, d2) for c in seen.values()), sum(seen.values())
        total += kept / total >= 1 - 1e-12
        if x in seen:
            return cut(seen[x], d2) / total
        return (1 - kept / total) / (1 - sum(p1[y] for y in seen)) * p1.get(x, unseen)

    return [sum(math.log10(p2(h, x)) for h, x in zip(["start", *t], t)) for t in tokens]


@pytest.mark.parametrize("max_vocabulary", [0, 50, 1 << 17])
def test_katz_brute_force(spark, monkeypatch, max_vocabulary):
    """Every word is a history and a successor of its own, broadcast or not."""
    monkeypatch.setattr(katz, "PACK_BYTES", 900)
    monkeypatch.setattr(katz, "BUCKET_BYTES", 3000)
    texts = [t for _, t in word_soup()] + ["never seen w1 seen w2 never seen", "w1 w2 w1 w2 w1 odd odd odd w3"]
    train = [i % 4 != 0 for i in range(len(texts))]
    got = katz.score(frame(spark, list(enumerate(texts))), F.col("doc_id") % 4 != 0, max_vocabulary=max_vocabulary)
    want = katz_by_force(texts, train)
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert math.isclose(r["score"], want[r["doc_id"]], rel_tol=1e-9)


def test_katz_pack_round_trip():
    arrays = [np.array([3, 1, 2**40], np.uint64), np.zeros(0, np.uint16), np.array([True, False])]
    for a, b in zip(arrays, katz.unpack(katz.pack(arrays), [np.uint64, np.uint16, np.bool_])):
        assert (a == b).all() and a.dtype == b.dtype


# -- pieces


def test_pieces_giant_equals_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(4)
    bits = ["the", "ing", " ", "  ", "\n", "é", "日", "\U0001f389", "ation", "0", " International", "====", "e"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 120))) for _ in range(40)]
    texts += ["", None, "x" * 300, " " * 200, "no" * 200, texts[0], "a▁b"]
    rows = list(enumerate(texts))
    got = pieces.decode(pieces.encode(frame(spark, rows), giant=40)).collect()
    assert len(got) == len(rows)
    for r in got:
        t = texts[r["doc"]["doc_id"]]
        assert r["ids"] == (None if t is None else sp.encode(t))
        if t is None or "▁" not in t:
            assert r["decoded"] == t


def test_pieces_take_long_rows_few_at_a_time():
    """A batch of 512 long texts was held as Python objects at once."""
    sent, held = SimpleNamespace(value=open(pieces.MODEL, "rb").read()), []

    def watched(batches):
        for part in batches:
            held.append(part.num_rows)
            yield part

    texts = ["some words " * 20_000] * 12 + [None, "short", ""]
    batch = pa.RecordBatch.from_pydict({"doc": pa.array([{"doc_id": i, "text": t} for i, t in enumerate(texts)])})
    ids = [i for part in watched(pieces._encode_rows(sent, "text")(iter([batch]))) for i in part["ids"].to_pylist()]
    sp = pieces.processor(sent.value)
    assert ids == [None if t is None else sp.encode(t) for t in texts]
    assert held == [4, 4, 7]  # the last three are short


def test_pieces_decode_as_the_library():
    data = open(pieces.MODEL, "rb").read()
    sp = pieces.processor(data)
    rng = random.Random(6)
    texts = ["", " ", "  a", "\n\nb", "日本 🎉€", "a  b ", "\x00", " \n"]
    good = [sp.encode(t) for t in texts] + [None, [], [13], [35, 300], [sp.piece_to_id("▁")] * 3]
    byte = [0xE6 + 3, 0x97 + 3, 0xED + 3, 0xA0 + 3, 0x80 + 3, 0xFF + 3]
    mixed = [[rng.choice([0, 1, 2, *byte, 300, 400, 5_000, 13]) for _ in range(rng.randint(0, 8))] for _ in range(300)]
    for lists in (good, mixed, [r for r in mixed if not {0, 1, 2} & set(r)], *([r] for r in mixed), []):
        want = [None if r is None else sp.decode(r) for r in lists]
        array = pa.array([[7], *lists, [9]], pa.list_(pa.int32())).slice(1, len(lists))
        assert pieces.texts_of(data, array).to_pylist() == want


# -- vectors


def test_vectors_brute_force(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 8))
    v = [(centre[k % 6] + 0.09 * rng.normal(size=8)).tolist() for k in range(120)]
    rows = [(i, x, i % 2) for i, x in enumerate(v)]
    rows += [(200, v[0], 0), (201, v[0], None), (202, None, 0), (203, [0.0] * 8, 0), (204, [float("nan")] * 8, 0)]
    rows += [(205, [None, *v[0][1:]], 0), (206, v[0][:7], 0), (207, [float("inf"), *v[0][1:]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embed.near_duplicates(df).collect()}
    good = {i: np.array(x) / np.linalg.norm(x) for i, x, _ in rows if i <= 200}
    label = {i: l for i, _, l in rows}
    links = {a: {b for b in good if b != a and label[a] == label[b] and good[a] @ good[b] >= 0.98} for a in good}
    assert sum(map(len, links.values())) > 100
    for i, r in got.items():
        reach, todo = {i}, [i]
        while todo:
            for b in links.get(todo.pop(), set()) - reach:
                reach.add(b)
                todo.append(b)
        assert (r["n_links"], r["component_id"], r["kept"]) == (len(links.get(i, ())), min(reach), min(reach) == i)
    assert len(got) == len(rows)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (90, 95)], "a long, b long")
    got = {r["id"]: r["root"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 95: 90, 100: 90}


# -- mixing, rules, licenses, urls, classifier: SQL checks them on the tables; edges here


def test_mixing_edges(spark):
    df = frame(spark, word_soup())
    rows = mixing.assign(df).collect()
    assert len(rows) == df.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r["doc"]["source"]].append(r)
    for mine in by.values():
        assert sum(r["taken"] for r in mine) == round(mine[0]["target"])
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    assert sum(len((r["text"] or "").split()) for r in out.collect()) == sum(r["taken"] for r in rows)
    assert mixing.assign(df.limit(0)).count() == 0


def test_rules_edges(spark):
    df = frame(spark, [*word_soup(), (900, "### $$$ " * 60), (901, "stop stop stop " * 40)])
    got = {r["doc"]["doc_id"]: r for r in rules.judge(df).collect()}
    assert got[65]["n_words"] == 0 and not got[65]["kept"]
    assert got[901]["n_repeat_words"] == 120 and got[901]["base_failed"]
    assert not got[900]["kept"] and got[900]["n_symbols"] == 360
    assert rules.filter_documents(df).columns == df.columns
    assert rules.judge(df.limit(0)).count() == 0


def test_rules_outvote_a_single_bad_vote(spark):
    docs = table(spark, SF_RULES, "documents")
    rows = rules.judge(docs).select(F.col("doc.doc_id").alias("doc_id"), "posterior", "votes")
    both = rows.join(table(spark, SF_RULES, "labels").where("quality is not null"), "doc_id").collect()
    all_pass = [min(r["votes"]) > -1 for r in both]
    kept = [r["posterior"] >= 0.5 for r in both]
    good = [r["quality"] == 1 for r in both]
    assert any(k and not a for k, a in zip(kept, all_pass))
    right, plain = (sum(x == g for x, g in zip(xs, good)) / len(both) for xs in (kept, all_pass))
    assert right > plain and right > 0.97


def test_rules_em_recovers_planted_accuracies(spark):
    """Votes drawn from known rates; EM is compared with a plain run and with the planted classes."""
    rng = random.Random(5)
    rates = [(0.9, 0.2), (0.85, 0.3), (0.8, 0.1), (0.7, 0.4)]
    rows = []
    for _ in range(3000):
        good = rng.random() < 0.8
        rows.append((good, *(rng.choice([0, 1, 1, 1]) and (1 if rng.random() < r[not good] else -1) for r in rates)))
    df = spark.createDataFrame([(list(r[1:]),) for r in rows], "votes array<int>")
    patterns = df.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).cache()
    q = rules.fit(patterns, tolerance=0.0, rounds=12)
    got = {tuple(r["votes"]): r["q"] for r in patterns.withColumn("q", q).collect()}

    counts = Counter(r[1:] for r in rows)
    want = {v: 0.5 + 0.45 * sum(v) / 4 for v in counts}
    for _ in range(12):
        side = {s: sum(n * (want[v] if s else 1 - want[v]) for v, n in counts.items()) for s in (0, 1)}
        share = {
            (j, x, s): (sum(n * (want[v] if s else 1 - want[v]) for v, n in counts.items() if v[j] == x) + 1) / (side[s] + 3)
            for j in range(4) for x in (-1, 1) for s in (0, 1)
        }
        new = {}
        for v in counts:
            odds = (side[1] + 1) / (side[0] + 1)
            for j, x in enumerate(v):
                if x:
                    ratio = share[j, x, 1] / share[j, x, 0]
                    odds *= max(1, ratio) if x == 1 else min(1, ratio)
            new[v] = odds / (1 + odds)
        want = new
    assert all(abs(got[v] - want[v]) < 1e-9 for v in counts)
    assert sum((got[r[1:]] >= 0.5) == r[0] for r in rows) / len(rows) > 0.85
    assert rules.fit(patterns.limit(0)) is None


def test_rules_keep_columns_of_any_name(spark):
    text = " ".join(f"word{k}." for k in range(60))
    df = spark.createDataFrame([(1, text, "mine", 7)], "doc_id long, text string, __whole_text string, n_words int")
    assert [tuple(r) for r in rules.filter_documents(df, threshold=0.0).collect()] == [(1, text, "mine", 7)]
    assert rules.filter_documents(df).columns == df.columns


def test_licenses_edges(spark):
    long = "word " * 5000
    df = frame(spark, [(1, long + licenses.TEMPLATES["MIT"] + long), (2, None), (3, ""), (4, "under the MIT")])
    got = licenses.scan(df).collect()
    assert [(r["doc_id"], r["license"], r["containment"]) for r in got] == [(1, "MIT", 1.0)]
    assert licenses.scan(df.limit(0)).count() == 0


def test_license_bands_collide(spark):
    """Measured on the real templates: whole ones, and ones with a fifth of the shingles gone."""
    rows = spark.range(400).crossJoin(licenses.template_table(spark, licenses.TEMPLATES))
    rng = [F.xxhash64(F.lit("other"), "id", F.lit(j)) for j in range(70)]
    n = F.size("hashes")
    for share, most in ((1.0, 0.002), (0.8, 0.006)):
        part = F.filter("hashes", lambda h, i: F.pmod(i + F.col("id"), n) < F.ceil(n * share))
        window = F.slice(F.concat(part, F.array(*rng)), F.lit(1), 2 * F.col("size_class"))
        met = rows.select(
            F.arrays_overlap(licenses.min_hashes(F.col("hashes")), licenses.min_hashes(window)).alias("met")
        )
        assert met.where("not met").count() <= most * met.count()


def test_licenses_of_texts_under_one_id(spark):
    texts = ["Released under the MIT x License.", licenses.TEMPLATES["MIT"]]
    for ids in ((1, 1), (None, None), (1, None)):
        for order in (texts, texts[::-1]):
            df = spark.createDataFrame(list(zip(ids, order)), "doc_id long, text string")
            found = licenses.scan(df).where("license = 'MIT'").collect()
            assert [r.doc_id for r in found] == [ids[order.index(texts[1])]] and found[0].containment == 1.0


def test_mix_without_ids_agrees_between_runs(spark):
    rows = [(None, f"text {i} " + "w " * (i % 17), "a" if i % 3 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [
        {r.doc.text: r.taken for r in mixing.assign(df.repartition(n)).collect()} for n in (1, 3, 7)
    ]
    assert len(runs[0]) == 200 and runs[0] == runs[1] == runs[2]


def test_vectors_without_or_with_repeated_ids(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    near = lambda v: [x + 0.01 for x in v]
    rows = [(5, a), (None, near(a)), (1, b), (1, c), (2, near(b)), (3, near(c)), (None, [1.0, 1.0, 1.0]), (None, [2.0, 2.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embed.near_duplicates(df.repartition(3)).collect()]
    want = [(5, 1, 5, True), (None, 1, 5, False), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]
    want += [(None, 1, None, False)] * 2
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_urls_spread(spark):
    pages = [
        (1, "http://good.com/x", '<a href="http://friend.org/">'),
        (2, "http://friend.org/a?b", None),
        (3, "http://farm.org/a#b", '<a href="http://bad.net/fr/1"> <img src=//bad.net/x>'),
        (4, "HTTP://BAD.net/fr/1", ""),
        (5, None, "x"),
        (6, "no scheme", None),
        (7, "http://www.example.com/en/1", None),
        (8, "http://a.example.com/en/1", None),
        (9, "http://example.com", None),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit(1))
    got = {r["page_id"]: r for r in urls.judge(df).collect()}
    assert [got[k]["verdict"] for k in range(1, 10)] == [
        "allow", "allow", "block", "block", "allow", "allow", "allow", "block", "allow"
    ]
    assert (got[4]["host"], got[4]["path"], got[4]["rule"]) == ("bad.net", "/fr/1", "net/fr/")
    assert got[7]["rule"] == "www.example.com/en/" and got[9]["rule"] is None and got[2]["trust"] > 0
    assert urls.judge(df.limit(0)).count() == 0


def spread_by_force(edges, seeds, damping=0.85):
    """Limit of the propagation as the solution of its linear equations."""
    hosts = sorted({h for e in edges for h in e[:2]} | {h for h, _, _ in seeds})
    at = {h: k for k, h in enumerate(hosts)}
    out = {}
    for kind in (0, 1):
        m = np.eye(len(hosts))
        for src, dst, n in edges:
            a, b = (src, dst) if kind == 0 else (dst, src)
            total = sum(w for x, y, w in edges if (x if kind == 0 else y) == a)
            m[at[b], at[a]] -= damping * n / total
        seed = np.zeros(len(hosts))
        for h, k, x in seeds:
            seed[at[h]] += x if k == kind else 0
        out.update({(h, kind): v for h, v in zip(hosts, np.linalg.solve(m, seed))})
    return out


def test_urls_reach_the_limit(spark):
    """A chain longer than any fixed number of rounds would cover, a cycle, a hub and hosts without links."""
    edges = [(f"c{k:02}", f"c{k + 1:02}", 1) for k in range(25)]
    edges += [("r0", "r1", 2), ("r1", "r2", 1), ("r2", "r0", 3), ("r2", "out", 1)]
    edges += [(f"leaf{k}", "hub", 1) for k in range(9)] + [("hub", "c00", 2), ("hub", "r0", 5)]
    seeds = [("c00", 0, 1.0), ("c25", 1, 1.0), ("r1", 0, 0.5), ("out", 1, 0.75), ("alone", 0, 1.0)]
    seeds += [(f"leaf{k}", 0, 0.25) for k in range(9)]
    got = urls.propagate(
        spark.createDataFrame(edges, "src string, dst string, n long"),
        spark.createDataFrame(seeds, "host string, kind int, seed double"),
        tolerance=1e-4,
    ).collect()
    want = spread_by_force(edges, seeds)
    found = {(r["host"], r["kind"]): r["score"] for r in got}
    assert all(-1e-9 <= v - found.get(k, 0.0) <= 1e-4 for k, v in want.items())
    assert found["c25", 0] > 0.85**25 and found["c00", 1] > 0.85**26


def test_urls_repeated_pages_and_far_blocks(spark):
    """Distrust that arrives over several links blocks; a page that occurs twice gets the same verdict twice."""
    pages = [(k, f"http://h{k}.org/", f'<a href="http://h{k + 1}.org/">') for k in range(3)]
    pages += [(3, "http://h3.org/", '<a href="http://bad.net/es/">'), (4, "http://bad.net/es/1", None)]
    df = spark.createDataFrame(pages + [pages[3]], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["verdict"], round(r["distrust"], 5)) for r in urls.judge(df).collect())
    want = [(k, "block", round(0.85 ** (4 - k), 5)) for k in range(5)]
    assert got == sorted(want + [want[3]])


def test_classifier_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = queries.QUERIES["op1_factorisation_machine"](spark, f"{SF}/../sf0.01")
    held = got.where("held_out").join(labels, "doc_id").where("quality is not null")
    right, n = held.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right / n >= 0.95
    assert got.count() == docs.count()


def test_classifier_edges(spark):
    df = frame(spark, word_soup())
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = classifier.score(df, classifier.fit(df, none)).collect()
    assert len(got) == df.count() and all(r["score"] == 0.5 for r in got)
    assert classifier.keep_good(df, none).columns == df.columns


def test_sum_of_squares_identity():
    model = classifier.fresh()
    slots, values = classifier.features(b"a few words, a few", 18)
    got = classifier.raw_scores(model, [(slots, values)])[0][0]
    v, x = model.factors[slots], values
    pairs = sum(v[i] @ v[j] * x[i] * x[j] for i in range(len(x)) for j in range(i))
    assert math.isclose(got, pairs, rel_tol=1e-3, abs_tol=1e-4)


# -- pipeline


def test_pipeline_stages(spark):
    """Each stage against its operator's own check, on the smallest tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    good = by_name["quality classifier"](spark, docs, SF)
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    one = by_name["n-gram Jaccard join"](spark, good, SF)
    heads = {i for i, (_, c) in components_by_force(rows, 5, 80).items() if i == c}
    kept = [(r["doc_id"], r["text"]) for r in one.collect()]
    assert {i for i, _ in kept} == heads
    clean = by_name["suffix-array dedup"](spark, one, SF)
    want = {i: x[3].decode("utf-8", "ignore") for i, x in removed_by_force(kept, 50).items()}
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == want
    assert good.columns == one.columns == clean.columns == docs.columns
    mixed = by_name["mixing sources to target weights"](spark, clean, SF)
    assert mixed.columns == docs.columns
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = Counter((r["doc_id"], tuple(sp.encode(r["text"]))) for r in mixed.collect())
    coded = by_name["SentencePiece encoding and decoding"](spark, mixed, SF)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in coded.collect()) == texts


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_empty_tables(spark):
    empty = frame(spark, []).limit(0)
    assert suffix.remove_repeats(empty).count() == 0
    assert jaccard.clusters(empty).count() == 0
    assert katz.score(empty, F.lit(True)).count() == 0
    assert pieces.encode(empty).count() == 0
    assert embed.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
