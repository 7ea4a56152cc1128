import math
import random
import threading
import time
import tracemalloc
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import factorization, online, ratings, similarity
from tidemark.session import stored, tune

WORDS = ["action", "drama", "comedy", "war", "music", "crime", "western"]


def test_statistics(spark):
    rows = [(1, 10, 4.0, 0), (2, 10, 2.0, 86400 * 40), (1, 20, 5.0, 86400 * 40)]
    df = spark.createDataFrame(rows, "uid int, mid int, score double, timestamp int")
    assert {tuple(r) for r in ratings.rating_counts(df).collect()} == {(10, 2), (20, 1)}
    assert [tuple(r) for r in ratings.rating_counts_by_month(df).collect()] == [
        (20, 1, 197002), (10, 1, 197002), (10, 1, 197001),
    ]
    assert {tuple(r) for r in ratings.average_scores(df).collect()} == {(10, 3.0), (20, 5.0)}


def test_tags_and_genres(spark):
    movies = spark.createDataFrame(
        [(1, "Drama|War"), (2, "drama"), (3, None), (4, "Docudrama")], "mid int, genres string"
    )
    tags = spark.createDataFrame([(1, 1, "b"), (2, 1, "a"), (3, 1, "b")], "uid int, mid int, tag string")
    assert {r.mid: r.tags for r in ratings.movies_with_tags(movies, tags).collect()} == {
        1: "a|b", 2: None, 3: None, 4: None,
    }
    scores = spark.createDataFrame(
        [(1, 1, 3.0), (1, 2, 3.0), (1, 3, 5.0), (1, 4, 4.0)], "uid int, mid int, score double"
    )
    top = ratings.genre_top_n(movies, scores, ["War", "Drama", "Western"], 2).collect()
    assert sorted((r.genre, r["rank"], r.mid) for r in top) == [("Drama", 1, 4), ("Drama", 2, 1), ("War", 1, 1)]


def test_recent_ratings(spark):
    rows = [(1, m, 1.0, m // 2) for m in range(6)]
    got = ratings.recent_ratings(spark.createDataFrame(rows, "uid int, mid int, score double, timestamp int"), 3)
    assert [r.mid for r in got.orderBy("rank").collect()] == [5, 4, 3]


@pytest.fixture(scope="module")
def catalogue(spark):
    rng = random.Random(5)
    items = {i: rng.sample(WORDS, rng.randrange(1, 4)) for i in range(1, 61)}
    items[61] = items[62] = []  # movies without genres are nobody's neighbours
    rows = [(i, "|".join(w)) for i, w in items.items()]
    df = spark.createDataFrame(rows, "mid int, genres string")
    return items, similarity.word_members(df, similarity.genre_words(F.col("genres")))


def brute_pairs(vectors, min_sim):
    out = {}
    for a, b in product(vectors, repeat=2):
        if a == b:
            continue
        x, y = vectors[a], vectors[b]
        nx, ny = math.sqrt(sum(v * v for v in x.values())), math.sqrt(sum(v * v for v in y.values()))
        if nx and ny:
            score = round(sum(v * y.get(k, 0.0) for k, v in x.items()) / (nx * ny), 6)
            if score > min_sim:
                out[a, b] = score
    return out


def tfidf(items):
    freq = {w: sum(w in ws for ws in items.values()) for w in WORDS}
    return {
        i: {w: math.log((len(items) + 1) / (freq[w] + 1)) for w in ws} for i, ws in items.items()
    }


@pytest.mark.parametrize("min_sim", [0.3, 0.6, 0.9])
def test_sparse_pairs_equal_brute_force(spark, catalogue, min_sim):
    items, members = catalogue
    sims = similarity.sparse_pairs(similarity.tfidf_vectors(members), min_sim)
    got = {
        (r.mid, r.other_mid): round(r.score, 6) for r in similarity.expand_pairs(sims, members).collect()
    }
    assert got == pytest.approx(brute_pairs(tfidf(items), min_sim), abs=2e-6)


def test_top_k_equals_cut_of_full_list(spark, catalogue):
    _, members = catalogue
    sims = similarity.sparse_pairs(similarity.tfidf_vectors(members), 0.3)
    full = {}
    for r in similarity.expand_pairs(sims, members).collect():
        full.setdefault(r.mid, []).append((-r.score, r.other_mid))
    for k in (1, 4, 100):
        got = {(r.mid, r["rank"]): r.other_mid for r in similarity.similar_top_k(sims, members, k).collect()}
        want = {
            (m, i + 1): other for m, rs in full.items() for i, (_, other) in enumerate(sorted(rs)[:k])
        }
        assert got == want


@pytest.mark.parametrize("block_rows", [4096, 7])
def test_dense_pairs_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(1)
    vectors = {i: rng.normal(size=8) for i in range(60)}
    vectors[60] = np.zeros(8)
    vectors[61] = vectors[3] * 2
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "profile long, vec array<double>")
    got = {
        (r.profile, r.other_profile): round(r.score, 6)
        for r in similarity.dense_pairs(df, 0.4, block_rows, tile=5).collect()
    }
    assert (3, 61) in got and not any(60 in pair for pair in got)
    want = brute_pairs({i: dict(enumerate(v)) for i, v in vectors.items()}, 0.4)
    assert got == pytest.approx(want, abs=2e-6)


def test_hashed_vectors(spark, catalogue):
    items, members = catalogue
    hashed = factorization.hashed_tfidf(members, 50)
    vectors, hashed_members = factorization.hashed_profiles(hashed)
    sims = similarity.dense_pairs(vectors, 0.6, shared=True)
    by_item = {r.mid: dict(enumerate(r.vec)) for r in hashed.collect()}
    got = {(r.mid, r.other_mid): round(r.score, 6) for r in similarity.expand_pairs(sims, hashed_members).collect()}
    want = brute_pairs(by_item, 0.6)
    assert got == pytest.approx(want, abs=2e-6)


def brute_unseen(events, seen, pairs, n):
    out = {}
    for uid, mid in events:
        near = sorted((-s, b) for (a, b), s in pairs.items() if a == mid and b not in seen.get(uid, set()))
        out[uid, mid] = [b for _, b in near[:n]]
    return {k: v for k, v in out.items() if v}


def test_unseen_candidates_equal_brute_force(spark, catalogue):
    items, members = catalogue
    rng = random.Random(9)
    seen = {u: set(rng.sample(range(1, 61), rng.randrange(0, 40))) for u in range(8)}
    events = [(u, rng.randrange(1, 61)) for u in range(9)] + [(0, 9999), (3, 61)]
    sims = similarity.sparse_pairs(similarity.tfidf_vectors(members), 0.3)
    pairs = {(r.mid, r.other_mid): r.score for r in similarity.expand_pairs(sims, members).collect()}
    rated = [(u, m, 3.0) for u, ms in seen.items() for m in ms]
    got = {}
    found = online.top_unseen_similar(
        spark.createDataFrame(events, "uid int, mid int"),
        spark.createDataFrame(rated, "uid int, mid int, score double"), sims, members, 5,
    )
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault((r.uid, r.mid), []).append(r.candidate)
    assert got == brute_unseen(events, seen, pairs, 5)


def test_rescore(spark):
    members = spark.createDataFrame([(m, str(m)) for m in (1, 2, 3, 4)], "mid int, profile string")
    rows = [("1", "2", 0.8), ("1", "3", 0.9), ("1", "4", 0.7), ("2", "3", 0.75)]
    sims = spark.createDataFrame(rows + [(b, a, s) for a, b, s in rows], "profile string, other_profile string, score double")
    cands = spark.createDataFrame([(7, 1, "1"), (7, 2, "2")], "uid int, candidate int, profile string")
    recent = spark.createDataFrame([(7, 2, 5.0), (7, 3, 2.0), (7, 4, 5.0)], "uid int, mid int, score double")
    got = {r.mid: r.score for r in online.rescore(cands, recent, sims, members).collect()}
    # 4 is at 0.7, which does not count; item 2 has one low-rated neighbour only: finite score
    assert got == pytest.approx({1: (0.8 * 5 + 0.9 * 2) / 2, 2: 0.75 * 2})


def test_parse_rating_events(spark):
    df = spark.createDataFrame([("1|2|3.5|100",), ("1| 2 |x|",), ("bad",)], "value string")
    got = [tuple(r) for r in online.parse_rating_events(df).collect()]
    assert got == [(1, 2, 3.5, 100), (1, 2, None, None), (None, None, None, None)]


def test_factorization(spark):
    rng = random.Random(2)
    rows = [(u, m, float(1 + (u * m) % 5)) for u in range(20) for m in range(15) if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "uid int, mid int, score double")
    model = factorization.train_als(df, rank=4, iters=5)
    recs = factorization.user_recs(model, 5).collect()
    assert max(r["rank"] for r in recs) <= 5 and all(r.score > 0 for r in recs)
    by_user = {}
    for r in recs:
        by_user.setdefault(r.uid, []).append((r["rank"], r.score))
    assert all([s for _, s in sorted(v)] == sorted((s for _, s in v), reverse=True) for v in by_user.values())
    train, test = factorization.hash_split(df)
    assert train.count() + test.count() == len(rows)
    assert train.join(test, ["uid", "mid"]).count() == 0
    a, b = factorization.random_split(df)
    assert a.count() + b.count() == len(rows)
    grid = factorization.grid_search_als(df, (2, 4), (0.01, 0.1), 3)
    cells = grid.collect()
    assert len(cells) == 4
    assert factorization.best_params(grid).first().rmse == min(r.rmse for r in cells)


def test_blocks_of_the_training_follow_what_a_task_takes_in(spark, monkeypatch):
    """There were 6 blocks whatever the tables, so a task took in all vectors of the other side."""
    per_item = 4 * 50 + factorization._OVERHEAD
    assert factorization.als_blocks(36_000_000, 900_000, 1_200_000, 50) == factorization.ALS_BLOCKS
    for ratings, own, other in ((216_000_000, 5_400_000, 7_200_000), (216_000_000, 7_200_000, 5_400_000)):
        blocks = factorization.als_blocks(ratings, own, other, 50)
        taken = other * (1 - np.exp(-ratings / blocks / other)) * per_item
        assert 0.95 * factorization.ALS_BYTES < taken <= factorization.ALS_BYTES
    rng = np.random.default_rng(3)
    rows = {(int(u), int(m)): float(s) for u, m, s in zip(rng.integers(0, 300, 2000), rng.integers(0, 400, 2000), rng.integers(1, 6, 2000))}
    df = spark.createDataFrame([(*k, s) for k, s in rows.items()], "uid int, mid int, score double")
    few = factorization.train_als(df, rank=4, iters=15, reg=0.1)
    monkeypatch.setattr(factorization, "ALS_BYTES", 100 * (4 * 4 + factorization._OVERHEAD))
    many = factorization.train_als(df, rank=4, iters=15, reg=0.1)
    # 2000 ratings, of which 115 name 100 different ones of 400 items
    assert few.userFactors.rdd.getNumPartitions() == 6 and 14 <= many.userFactors.rdd.getNumPartitions() <= 22
    assert many.userFactors.count() == few.userFactors.count()
    error = [factorization.rmse(m, df).first()["rmse"] for m in (few, many)]
    assert abs(error[0] - error[1]) < 0.1


def test_a_block_grows_where_it_lies():
    rng = np.random.default_rng(2)
    pieces = [(rng.normal(size=(n, 3)).astype(np.float32), np.arange(n) + 10 * n) for n in (1, 0, 5, 2000, 7)]
    block = similarity._Block()
    block.STEP = 60  # room for 5 more vectors
    for vecs, ids in pieces:
        block.add(vecs, ids)
    vecs, ids = block.whole()
    assert (vecs == np.concatenate([v for v, _ in pieces])).all() and (ids == np.concatenate([i for _, i in pieces])).all()
    assert len(block.vecs) <= len(ids) + 5


def test_lengths_of_a_block_need_no_copy_of_it():
    """A copy in double precision and its squares took four times the space of the block."""
    vecs = np.random.default_rng(1).normal(size=(200_000, 50)).astype(np.float32)
    tracemalloc.start()
    found = similarity._lengths(vecs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(found, np.linalg.norm(vecs.astype(np.float64), axis=1), rtol=1e-12)
    assert peak < vecs.nbytes / 2


def test_grid_trains_two_settings_at_once(spark, monkeypatch):
    """One training has six tasks at once at most, however many cores there are."""
    rows = [(u, m, float((u * 7 + m * 3) % 9) / 2) for u in range(30) for m in range(12) if (u + m) % 3]
    df = spark.createDataFrame(rows, "uid int, mid int, score double")
    alone = {tuple(r) for r in factorization.grid_search_als(df, (2,), (0.01, 0.1), 2, parallel=1).collect()}
    together, plain = threading.Barrier(2, timeout=60), factorization.train_als

    def met(*args, **more):
        together.wait()
        return plain(*args, **more)

    monkeypatch.setattr(factorization, "train_als", met)
    assert {tuple(r) for r in factorization.grid_search_als(df, (2,), (0.01, 0.1), 2).collect()} == alone



@pytest.mark.parametrize("block_bytes", [200, 10**8])
def test_best_products_equal_brute_force(spark, block_bytes):
    """Ties, zero vectors, and vectors without a product above 0, in one block or many."""
    rng = np.random.default_rng(5)
    x, y = rng.integers(-2, 3, (60, 3)).astype(np.float32), rng.integers(-2, 3, (150, 3)).astype(np.float32)
    x[7] = 0
    x[8:11, 1:] = 0
    asking, offered = (
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, vec array<float>") for m in (x, y)
    )
    got = similarity.best_products(asking, offered, 5, block_bytes, wide=4, tile=7).collect()
    want = set()
    for i, row in enumerate(x @ y.T):
        best = sorted((-s, j) for j, s in enumerate(row) if s > 0)[:5]
        want |= {(i, k + 1, j, -float(s)) for k, (s, j) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_vectors_are_shuffled_once_per_large_block(spark):
    """Copies of a vector do not grow with every 4096 rows (49 and 293 copies before)."""
    vectors = spark.range(200_000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("vec"))
    assert similarity.n_blocks(vectors, "vec", 8) == similarity.WIDE == 12
    wide = spark.range(1_200_000).select("id", F.array_repeat(F.lit(1.0), 50).alias("vec"))
    assert similarity.n_blocks(wide, "vec", 8) == 12
    assert similarity.n_blocks(wide, "vec", 8, block_bytes=2**20) == 458  # 480 million bytes


def test_dense_vectors_are_shuffled_once_for_all_blocks(spark):
    """Blocks of 7 of 300 vectors: every vector was repeated for each of the 43 blocks before."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 6)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "profile int, vec array<float>")
    pairs = similarity.dense_pairs(df, 0.5, block_rows=7, tile=4)
    assert "Exchange" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    sims = np.round(unit @ unit.T, 9)
    want = {(i, j) for i, j in zip(*np.nonzero(sims > 0.5)) if i != j}
    got = pairs.collect()
    assert {(r.profile, r.other_profile) for r in got} == want and len(got) == len(want)
    assert all(abs(r.score - sims[r.profile, r.other_profile]) <= 2e-9 for r in got)


def test_scores_at_the_threshold_are_decided_in_double_precision(spark):
    """0.6 exactly is not above 0.6; the next double that is left after rounding to nine digits is."""
    at = [0.6, 0.8]
    above = [0.6 + 2e-9, (1 - (0.6 + 2e-9) ** 2) ** 0.5]
    rows = [(0, [1.0, 0.0]), (1, at), (2, above)]
    df = spark.createDataFrame(rows, "profile int, vec array<double>")
    got = {(r.profile, r.other_profile) for r in similarity.dense_pairs(df, 0.6).collect()}
    assert got == {(0, 2), (2, 0), (1, 2), (2, 1)}


def test_stored_tables_leave_no_shuffle_files(spark):
    def shuffle_files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {n for n in (str(f) for f in disk.getAllFiles().mkString("\n").split("\n")) if "/shuffle_" in n}

    before = shuffle_files()
    sums = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").agg(F.sum("id").alias("s"))
    rows = stored(sums, "sums")
    for _ in range(50):
        kept = [n for n in shuffle_files() - before if n.endswith(".data")]
        if not kept:
            break
        time.sleep(0.2)
    assert not kept and rows.count() == 7


def test_what_a_task_sorts_does_not_grow_with_the_input(spark):
    """Shuffles had as many partitions as the session has cores, however large."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    tune(spark)
    before = spark.conf.get(key)
    assert int(before.removesuffix("b")) <= 16 * 2**20
    try:
        spark.conf.set(key, "1m")
        parts = [
            spark.range(n).select(F.xxhash64("id").alias("k")).groupBy("k").count().rdd.getNumPartitions()
            for n in (1_000_000, 4_000_000)
        ]
    finally:
        spark.conf.set(key, before)
    assert parts[0] > 4 and parts[1] > 2 * parts[0]
