"""Filter audit, tokenizer alignment and nearest toxic examples against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import align, audit, toxicity

EXTRA = ["doc", "key", "bits", "part", "mask", "n", "row", "a", "b", "times", "score", "text_"]
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Rows (doc_id, text, lang) with columns that the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(EXTRA)])


# -- filter audit


def failures(rows):
    out = []
    for i, text, _ in rows:
        t = text or ""
        w = WORDS.findall(t.encode())
        smaller = [
            j for j, u, _ in rows if (u or "") == t and j is not None and (i is None or j < i)
        ]
        out.append([
            len(w) < 200, 100 * len(set(w)) < 50 * len(w),
            100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)), bool(smaller),
        ])
    return out


def audit_by_force(rows, labels):
    fails, out = failures(rows), {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for part in {lang or "" for _, _, lang in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, name in enumerate(order, 1):
                f = "ABCDE".index(name)
                gone = [(i, x) for i, x in left if x[f]]
                left = [(i, x) for i, x in left if not x[f]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(x[f] for _, x in mine) - len(gone),
                    sum(x[f] and sum(x) == 1 for _, x in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for key in [k for k in out if k[0] == part]:
            out[key].append(shapley[key[1][key[2] - 1]])
    return out


def audit_rows(df):
    found = df.collect()
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in found}
    assert len(got) == len(found)
    return got


def test_audit_equals_every_order_run_over_documents(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        n = rng.choice([3, 150, 260])
        text = " ".join(rng.choice(["ab", "CD", "é", "x#y", f"w{rng.randint(0, 900)}"]) for _ in range(n))
        rows.append((i, text, rng.choice(["en", "de", None, ""])))
    rows += [(100 + i, rows[i % 4][1], "en") for i in range(12)]  # copies
    rows += [(200, None, "en"), (201, "", None), (202, "A" * 5000, "fr"), (202, "A" * 5000, "fr"), (None, rows[0][1], "en"),
             (None, "alone", "en"), (None, "alone", "en"), (203, "#\n\t\x0b" * 9, "it")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 110, 2)] + [(2, 1, False), (202, 1, True), (999, 1, True), (None, 1, True), (4, None, None)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(1))
    got = audit_rows(audit.audit(frame(spark, rows), marks))
    assert got == audit_by_force(rows, labels)
    shuffled = audit_rows(audit.audit(frame(spark, rows).repartition(7), marks))
    assert shuffled == got


def test_audit_of_nothing(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(frame(spark, []), marks).count() == 0
    got = audit_rows(audit.audit(frame(spark, [(1, "a b", "en")]), marks))
    assert len(got) == 600 and all(v[0] == 0 or v[1] == 0 for v in got.values())


def test_lattice_counts_orders():
    for n in (1, 3, 5):
        forward, backward = audit.lattice(n)
        assert forward[-1] == backward[0] == math.factorial(n)
        for s in range(1 << n):
            k = bin(s).count("1")
            assert (forward[s], backward[s]) == (math.factorial(k), math.factorial(n - k))


# -- tokenizer alignment


@pytest.fixture(scope="module")
def pair():
    with open(align.BYTE_LEVEL, encoding="utf-8") as x, open(align.PIECES, "rb") as y:
        return align.Pair(x.read(), y.read())


def spans(names, ids):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(names[i].as_py())))
        at = out[-1][2]
    return out


def align_by_force(pair, texts):
    """Per text: tokens, groups and links by comparing all intervals; then the counts of pairs."""
    library = Tokenizer.from_file(align.BYTE_LEVEL)
    library.encode_special_tokens = True
    rows = []
    for t in texts:
        whole = (" " + (t or "")).encode()
        a = spans(pair.bytes_a, library.encode(" " + (t or ""), add_special_tokens=False).ids)
        b = spans(pair.bytes_b, pair.b.encode(t or ""))
        joined = [b"".join(n[i].as_py() for i, _, _ in x) for n, x in ((pair.bytes_a, a), (pair.bytes_b, b))]
        if not t or joined != [whole, whole]:
            rows.append((0, 0, [], []))
            continue
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = []
        for lo, hi in zip([0, *ends], ends):
            groups.append("|".join(",".join(str(i) for i, s, e in x if lo <= s < hi) for x in (a, b)))
        links = [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]
        rows.append((len(a), len(b), groups, links))
    held = Counter(p for r in rows for p in set(r[3]))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    return [
        (n_a, n_b, len(groups), len(links), ";".join(groups), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links))
        for n_a, n_b, groups, links in rows
    ]


def texts():
    rng = random.Random(8)
    made = ["".join(rng.choice("ab cdé  \n\tÄß'sll🙂x") for _ in range(rng.randint(1, 80))) for _ in range(40)]
    made += ["The quick brown fox's tail, don't stop  at 12345!", " leading and trailing ", "▁ odd", "naïve space", "<|endoftext|> <s> </s> <0x0A>", "　全角 spaces and 漢字かな", "é", "\r\n\r\n", "a" * 300, None, "", " ", "\x00 zero"]
    return made + made[:5] + [made[0]]


def test_alignment_equals_all_pairs_of_intervals(spark, pair):
    rows = [(i if i % 7 else None, t, "en") for i, t in enumerate(texts())]
    df = frame(spark, [(k, t, "en") for k, (_, t, _) in enumerate(rows)])
    want = align_by_force(pair, texts())
    for hot, segment in ((1 << 20, 1 << 17), (0, 16), (12, 40)):
        found = align.align(df, hot=hot, segment=segment).collect()
        got = {r.doc.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in found}
        assert len(found) == len(want) and [got[i] for i in range(len(want))] == want
    hashed = align.align(df, as_text=False, columns=["doc_id", "row"], segment=16).collect()
    for r in hashed:
        assert r.groups == (hashlib.sha256(want[r.doc.doc_id][4].encode()).hexdigest() if want[r.doc.doc_id][0] else "")
        assert set(r.doc.asDict()) == {"doc_id", "row"}


def test_alignment_of_nulls_and_nothing(spark):
    assert align.align(frame(spark, [])).count() == 0
    found = align.align(frame(spark, [(None, None, None), (None, "", None), (None, "a b", None), (1, "a b", None), (1, "a b", None)])).collect()
    assert sorted((r.n_a, r.count_sum) for r in found) == [(0, 0), (0, 0), (2, 6), (2, 6), (2, 6)]


def test_segments_encode_like_the_whole(pair):
    text = " ".join(random.Random(1).choice(["Wort", "ll'ama", "x  y", "über\n", "12", "…", "a b"]) for _ in range(900))
    whole = align.align_texts(pair, [text, text[:50]], True)
    for size in (1, 7, 333):
        parts = align.segments(" " + text, size)
        assert "".join(parts) == " " + text and (size > 7 or len(parts) > 300)
        got = align.align_texts(pair, [text, text[:50]], True, size)
        for x, y in zip(got, whole):
            assert x[:5] == y[:5] and all((p == q).all() for p, q in zip(x[5:], y[5:]))


# -- nearest toxic examples


def toxic_rows(n=300):
    rng = random.Random(2)
    bad = ["grumbal", "fotzlich", "grumbaler", "snarkel"]
    rows, labels = [], []
    for i in range(n):
        w = [f"w{chr(97 + rng.randint(0, 25))}{chr(97 + rng.randint(0, 25))}" for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            w += rng.sample(bad, rng.randint(1, 3))
            rng.shuffle(w)
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(toxic)))
    return rows, labels


def dense(index, text):
    v = np.zeros(len(index.vocabulary))
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    seen = Counter(words) + Counter("^" + w[:k] for w in words for k in (4, 5, 6) if len(w) > k)
    seen += Counter(f"{t}*{m}" for t, n in seen.items() if t[0] == "^" for m in (2, 4, 8) if n >= m)
    for t, n in seen.items():
        if t in index.vocabulary:
            v[index.vocabulary[t]] = (1 + math.log(n)) * index.idf[index.vocabulary[t]]
    return v / max(1e-300, np.linalg.norm(v))


def nearest_by_force(index, matrix, text, k):
    cosines = matrix @ dense(index, text)
    order = sorted((i for i in range(len(cosines)) if cosines[i] > 0), key=lambda i: (-round(cosines[i], 12), i))
    return order[:k], cosines


def test_neighbours_equal_dense_cosines(spark):
    rows, labels = toxic_rows()
    docs = frame(spark, rows)
    marks = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, toxic int")
    index = toxicity.fit(docs, marks, alpha=1e3)  # many chance terms, so that texts have many neighbours
    assert len(index.vocabulary) > 40
    by_id = {i: t for i, t, _ in rows}
    matrix = np.array([dense(index, by_id[i]) for i in index.ids])
    for k in (1, 4, 16):
        for r in toxicity.score(docs, index, k).collect():
            ids, scores = nearest_by_force(index, matrix, by_id[r.doc.doc_id], k)
            assert len(r.evidence) == len(ids)
            assert np.allclose([e.cosine for e in r.evidence], scores[ids], atol=1e-9)
            for e in r.evidence:  # whichever of equal ones
                assert abs(scores[list(index.ids).index(e.doc_id)] - e.cosine) < 1e-9
            votes = [(index.class_weight[list(index.ids).index(e.doc_id)] / (1.05 - min(1.0, e.cosine)), e.toxic) for e in r.evidence]
            x = (sum(w * y for w, y in votes) + index.rest) / (sum(w for w, _ in votes) + 1)
            assert abs(r.score - 1 / (1 + math.exp(-max(-30, min(30, index.slope * x + index.shift))))) < 1e-6


def test_toxic_words_decide_held_out_texts(spark):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, toxic int")
    docs = frame(spark, rows + [(900, None, None), (901, "", None), (None, "you grumbal, fotzlich!", None), (902, "wab " * 30000 + "Grumbaler", None)])
    index = toxicity.fit(docs, marks)
    assert {"grumbal", "^grum"} <= set(index.vocabulary)
    got = {}
    for r in toxicity.score(docs, index).collect():
        got[r.doc.doc_id] = r.predicted
        assert 0 <= r.score <= 1 and r.doc.text_ == EXTRA.index("text_")
    assert all(got[i] == y for i, y in labels)
    assert (got[900], got[901], got[None], got[902]) == (0, 0, 1, 1)


def test_toxicity_without_labels_or_documents(spark):
    rows, labels = toxic_rows(30)
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    index = toxicity.fit(frame(spark, rows), nothing)
    assert {r.score for r in toxicity.score(frame(spark, rows), index).collect()} == {0.5}
    marks = spark.createDataFrame([*labels, (1, None), (None, 1), (0, 0)], "doc_id long, toxic int")
    index = toxicity.fit(frame(spark, rows + [(0, "another text", "en"), (7, rows[1][1], "en")]), marks)
    assert toxicity.score(frame(spark, []), index).count() == 0
    only = toxicity.fit(frame(spark, rows), spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int"))
    assert all(r.predicted == 0 for r in toxicity.score(frame(spark, rows), only).collect())
