"""Batch = stream, replays and late data, over file streams fed in small batches."""

import datetime as dt
import itertools
import json
import time
from pathlib import Path

import pytest
from compare import connect, differences
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.operators import orders, similarity
from tidemark.operators.relational import explode_recs
from tidemark.plans import stream_queries
from tidemark.sources import readers, writers
from tidemark.streaming import jobs


class Feed:
    """A parquet folder that is extended between runs of a job."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.path)


def at(minute, second=0, day=1):
    return dt.datetime(2021, 1, day, 0, 0) + dt.timedelta(minutes=minute, seconds=second)


def test_daily_actives_over_batches(spark, path):
    feed = Feed(spark, f"{path}/in", "mid string, ts timestamp")

    def run():
        jobs.drain(jobs.dau_stream(feed.stream(), "1 day", salts=4), jobs.table_sink(f"{path}/out"), f"{path}/cp")
        rows = spark.read.parquet(f"{path}/out").collect()
        return sorted((r.mid, r.day.day) for r in rows)

    feed.add([("a", at(i)) for i in range(50)] + [("b", at(2))])
    assert run() == [("a", 1), ("b", 1)]
    feed.add([("a", at(100)), ("c", at(5)), ("a", at(0, day=2))])
    assert run() == [("a", 1), ("a", 2), ("b", 1), ("c", 1)]
    feed.add([("z", at(0, day=9))])
    run()
    feed.add([("late", at(0, day=1)), ("y", at(0, day=9))])
    got = run()
    assert ("late", 1) not in got and ("y", 9) in got
    assert len(got) == len(set(got))


HEAD = "order_id long, final_cents long, original_cents long, order_time timestamp"
LINE = "order_id long, order_detail_id long, detail_cents long, detail_time timestamp"


def test_join_and_allocation_over_batches(spark, path):
    heads, lines = Feed(spark, f"{path}/heads", HEAD), Feed(spark, f"{path}/lines", LINE)

    def run():
        hot = spark.createDataFrame([(2, 3)], "hot_id long, n_salts int")
        joined = jobs.join_order_streams(heads.stream(), lines.stream(), "50 seconds", "5 minutes", hot)
        sink = jobs.allocate_sink(f"{path}/state", jobs.table_sink(f"{path}/out"), ["order_detail_id"], max_part_rows=2)
        jobs.drain(joined, sink, f"{path}/cp")
        rows = spark.read.parquet(f"{path}/out").collect()
        assert len({(r.order_id, r.order_detail_id) for r in rows}) == len(rows)
        return {(r.order_id, r.order_detail_id): r.share_cents for r in rows}

    heads.add([(1, 500, 600, at(0)), (2, 999, 1000, at(0))])
    lines.add([(1, 1, 100, at(0, 10)), (1, 2, 200, at(0, 10)), (2, 1, 333, at(0))])
    assert run() == {(1, 1): 83, (1, 2): 167, (2, 1): 333}
    # the rest of both orders, one replayed line and one line that is too far from its order
    lines.add([(1, 3, 300, at(0, 40)), (1, 1, 100, at(0, 10)), (2, 2, 333, at(0, 20)), (2, 3, 334, at(0, 30)), (2, 4, 1, at(2))])
    got = run()
    assert got == {(1, 1): 83, (1, 2): 167, (1, 3): 250, (2, 1): 333, (2, 2): 333, (2, 3): 333}
    assert sum(v for (o, _), v in got.items() if o == 2) == 999


def test_only_hot_orders_wait_under_salts(spark, path):
    heads, lines = Feed(spark, f"{path}/heads", HEAD), Feed(spark, f"{path}/lines", LINE)
    heads.add([(o, 500, 600, at(0)) for o in range(1, 21)])
    first = [(7, i, 10, at(0, i % 40)) for i in range(1, 26)] + [(o, 1, 10, at(0)) for o in range(1, 21) if o != 7]
    lines.add(first)

    def run():
        hot = jobs.hot_orders(spark.read.schema(LINE).parquet(f"{path}/lines"), f"{path}/hot", max_rows=10)
        assert [tuple(r) for r in hot.collect()] == [(7, 3)]
        joined = jobs.join_order_streams(heads.stream(), lines.stream(), "50 seconds", "5 minutes", hot)
        job = jobs.start(joined, jobs.table_sink(f"{path}/out"), f"{path}/cp")
        job.awaitTermination()
        rows = spark.read.parquet(f"{path}/out").select("order_id", "order_detail_id").collect()
        assert len(set(rows)) == len(rows)
        return {tuple(r) for r in rows}, job.recentProgress

    got, progress = run()
    assert got == {(o, i) for o, i, *_ in first}
    # the join keeps 20 orders, one of them under three salts, and 44 lines
    waiting = [op.numRowsTotal for p in progress for op in p.stateOperators if op.operatorName == "symmetricHashJoin"]
    assert max(waiting) == 20 + 2 + 44
    # another order has become as large: the table is the one of the first start, and the rows are right
    more = [(3, i, 10, at(0, i % 40)) for i in range(2, 60)] + [(7, 26, 10, at(0))]
    lines.add(more)
    assert run()[0] == {(o, i) for o, i, *_ in first + more}


@pytest.mark.parametrize("sink", [lambda s: s, jobs.replayed])
def test_waiting_rows_meet_those_of_later_batches(spark, path, sink):
    """Lines before their order, replayed lines, a hot order in parts; rows wait no longer than they may be needed."""
    heads, lines = Feed(spark, f"{path}/heads", HEAD), Feed(spark, f"{path}/lines", LINE)

    def run():
        table = jobs.table_sink(f"{path}/out")
        both, join = jobs.join_waiting(
            heads.stream(), lines.stream(), f"{path}/waiting", table, "50 seconds", "5 minutes", max_part_rows=2
        )
        job = jobs.start(both, sink(join), f"{path}/cp")
        job.awaitTermination()
        # nothing is held in a state store, however large the batch
        assert not any(p.stateOperators for p in job.recentProgress)
        rows = spark.read.parquet(f"{path}/out").collect()
        assert len({(r.order_id, r.order_detail_id) for r in rows}) == len(rows)
        return {(r.order_id, r.order_detail_id): r.final_cents for r in rows}

    def waiting():
        batch = max(jobs._snapshots(spark, f"{path}/waiting/waiting"))
        assert len(jobs._snapshots(spark, f"{path}/waiting/clock")) <= 2
        rows = spark.read.parquet(f"{path}/waiting/waiting/batch_id={batch}")
        return sorted((r.order_id, r.order_detail_id or 0) for r in rows.collect())

    heads.add([(1, 500, 600, at(0)), (2, 999, 1000, at(0))])
    lines.add([(1, 1, 100, at(0, 10)), (1, 1, 100, at(0, 10)), (3, 1, 10, at(0, 40)), (3, 1, 10, at(0, 40)), (None, 5, 1, at(0))])
    want = {(1, 1): 500}
    assert run() == want
    # an order after its line, lines after their order, one of them too far, one again, and one of no order
    heads.add([(3, 70, 70, at(0, 50)), (4, 80, 80, at(4))])
    lines.add([(2, i, 10, at(0, i)) for i in range(1, 8)] + [(2, 9, 1, at(2)), (1, 1, 100, at(0, 10)), (5, 1, 1, at(4, 30))])
    want |= {(3, 1): 70} | {(2, i): 999 for i in range(1, 8)}
    assert run() == want
    # both sides are far ahead: what waited is of no more use
    heads.add([(6, 10, 10, at(30))])
    lines.add([(6, 1, 10, at(30, 5)), (4, 1, 80, at(4, 10))])
    want |= {(6, 1): 10, (4, 1): 80}
    assert run() == want
    assert waiting() == [(6, 0), (6, 1)]
    # later than the watermark
    lines.add([(4, 2, 80, at(4, 10)), (6, 2, 10, at(30, 6))])
    assert run() == want | {(6, 2): 10}


@pytest.mark.parametrize("most", [2, 100])
@pytest.mark.parametrize("sink", [lambda s: s, jobs.replayed])
def test_joined_lines_are_allocated_where_they_lie(spark, path, monkeypatch, most, sink):
    """The joined batch was kept in memory and shuffled again, its hot orders were looked for four times."""
    heads, lines, plans = Feed(spark, f"{path}/heads", HEAD), Feed(spark, f"{path}/lines", LINE), []
    plain = orders.allocate_paid_amount

    def seen(*args):
        plans.append((done := plain(*args))._jdf.queryExecution().executedPlan().toString())
        return done

    monkeypatch.setattr(orders, "allocate_paid_amount", seen)

    def run():
        out = jobs.allocate_sink(f"{path}/state", jobs.table_sink(f"{path}/out"), ["order_detail_id"], max_part_rows=most)
        both, join = jobs.join_waiting(
            heads.stream(), lines.stream(), f"{path}/waiting", out, late="5 minutes", max_part_rows=most, parts=True
        )
        jobs.drain(both, sink(join), f"{path}/cp")
        rows = spark.read.parquet(f"{path}/out").collect()
        assert len({(r.order_id, r.order_detail_id) for r in rows}) == len(rows)
        assert "n_parts" not in rows[0] and "part" not in rows[0]
        return {(r.order_id, r.order_detail_id): r.share_cents for r in rows}

    heads.add([(1, 500, 600, at(0)), (2, 999, 1000, at(0)), (3, 70, 90, at(0))])
    lines.add([(1, i, 100, at(0, 10)) for i in range(1, 6)] + [(2, 1, 333, at(0)), (2, 1, 333, at(0)), (3, 1, 45, at(0)), (3, 2, 45, at(0, 9))])
    want = {(1, i): 83 for i in range(1, 6)} | {(2, 1): 333, (3, 1): 35, (3, 2): 35}
    assert run() == want
    if most == 100:
        assert "InMemoryTableScan" not in plans[0] and plans[0].count("Exchange hashpartitioning") <= 2
        assert "percentile" not in plans[0]
    # the rests of orders 1 and 2 after the state
    lines.add([(1, 6, 100, at(0, 40)), *[(2, i, 1, at(0, 20)) for i in range(2, 7)], (2, 7, 662, at(0, 20))])
    want |= {(1, 6): 85, (2, 7): 999 - 333 - 5} | {(2, i): 1 for i in range(2, 7)}
    assert run() == want


def test_registered_joins_use_no_state_store(spark, path, monkeypatch):
    """order_join_stream and ads_once held their whole backlog in the memory of the state store."""
    jobs_run, start = [], jobs.start
    monkeypatch.setattr(jobs, "start", lambda *args, **more: jobs_run.append(start(*args, **more)) or jobs_run[-1])
    for name in ("order_join_stream", "ads_once"):
        rows = getattr(stream_queries, name)(spark, "/root/testdata/sf0.001").count()
        assert rows > 0
    assert len(jobs_run) == 8
    assert not any(p.stateOperators for job in jobs_run for p in job.recentProgress)


def test_allocation_of_four_publications_uses_no_state_store(spark, monkeypatch):
    """alloc_stream held every order and line in three state stores."""
    jobs_run, start = [], jobs.start
    monkeypatch.setattr(jobs, "start", lambda *args, **more: jobs_run.append(start(*args, **more)) or jobs_run[-1])
    got = stream_queries.alloc_stream(spark, SF)
    assert not differences(got, connect(SF), contract.oracle_sql()["alloc_stream"])
    assert not any(p.stateOperators for job in jobs_run for p in job.recentProgress)
    batches = [len([p for p in job.recentProgress if p.numInputRows]) for job in jobs_run]
    # two runs of two batches, each followed by the records of both topics that cannot be read
    assert batches == [2, 1, 2, 2, 0, 2]


@pytest.mark.parametrize("sink", [lambda s: s, jobs.replayed])
def test_waiting_rows_are_written_with_their_batch(spark, path, sink):
    """All that waited was written again with every batch."""
    heads, lines = Feed(spark, f"{path}/heads", HEAD), Feed(spark, f"{path}/lines", LINE)
    written = {}
    for batch in range(7):
        # orders of every batch are years apart; its lines are of its own and of earlier orders, one comes again
        heads.add([(batch, 100, 700, at(0) + dt.timedelta(days=400 * batch))])
        rows = [(o, batch, 100, at(0) + dt.timedelta(days=400 * o)) for o in range(batch + 2)]
        lines.add(rows + ([(0, batch - 1, 100, at(0))] if batch else []))
        out = jobs.table_sink(f"{path}/out")
        both, join = jobs.join_waiting(
            heads.stream(), lines.stream(), f"{path}/waiting", out, late="4000 days", fan_in=3
        )
        jobs.drain(both, sink(join), f"{path}/cp")
        own = spark.read.parquet(f"{path}/waiting/waiting/batch_id={batch}")
        written[batch] = (own.where("_side = 'head'").count(), own.where("_side = 'line'").count())
        got = sorted((r.order_id, r.order_detail_id) for r in spark.read.parquet(f"{path}/out").collect())
        assert got == sorted((o, b) for b in range(batch + 1) for o in range(min(b + 2, batch + 1)))
        live = jobs._clock(spark, f"{path}/waiting", batch)[1]
        assert len(live) <= 4
    assert written == {b: (1, b + 2) for b in range(7)}
    names = {p.name for p in Path(f"{path}/waiting/waiting").iterdir() if not p.name.startswith("_")}
    assert {name for _, name in live} <= names and len(names) <= 7


def test_states_that_later_lines_may_need_outlive_merges(spark, path):
    """States of orders that are years older than others were dropped when the table was merged."""
    schema = LINE + ", final_cents long, original_cents long"
    sink = jobs.allocate_sink(f"{path}/state", jobs.table_sink(f"{path}/out"), ["order_detail_id"], late="4000 days")
    for batch in range(10):
        years = at(0) + dt.timedelta(days=365 * batch)
        sink(spark.createDataFrame([(batch + 1, 1, 100, years, 90, 200)], schema), batch)
    sink(spark.createDataFrame([(1, 2, 100, at(1), 95, 200)], schema), 10)
    rows = spark.read.parquet(f"{path}/out").where("order_id = 1").collect()
    assert {r.order_detail_id: r.share_cents for r in rows} == {1: 45, 2: 50}  # the rest, not the 48 of a new start


def _shuffle_files(spark):
    """Those with rows; a question whether there are any leaves a few bytes."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = [str(f) for f in disk.getAllFiles().mkString("\n").split("\n")]
    return {n for n in names if "/shuffle_" in n and n.endswith(".data") and Path(n).exists() and Path(n).stat().st_size > 1000}


def test_batches_leave_no_shuffle_files_and_are_packed(spark, path):
    """Shuffle files of all layers stayed on the local disks until the driver collected garbage."""
    rows = spark.range(3000).repartition(3, "id")
    messages = rows.select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.md5(F.col("id").cast("string")).alias("value"))
    before = _shuffle_files(spark)
    writers.write_topic_once(messages, 0, f"{path}/topics")
    writers.write_batch_once(rows, 0, f"{path}/batches")
    writers.upsert(rows, f"{path}/keyed", ["id"])
    with jobs.stored_batch(messages, f"{path}/staging") as kept:
        assert kept is not None
        files = list(Path(path).rglob("*.parquet"))
        assert len({p.relative_to(path).parts[0] for p in files}) == 4
        assert all(p.name.endswith(".zstd.parquet") for p in files)
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left


def test_parsed_records_are_not_kept_beside_their_texts(spark, path):
    """set_aside persisted every parsed batch, which fills the local disks where it is larger than the memory."""
    schema = "id long, _corrupt string"
    rows = spark.createDataFrame([(1, None), (None, "{"), (2, None)], schema)
    seen = []

    def sink(df, batch_id):
        seen.append((sorted(r.id for r in df.collect()), spark.sparkContext._jsc.getPersistentRDDs().size()))

    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    set_aside = jobs.set_aside(sink, path, "job")
    set_aside(rows, 0)
    set_aside(rows.where("false"), 1)
    assert seen == [([1, 2], kept)]
    assert [r.value for r in spark.read.parquet(path).collect()] == ["{"]


def test_topic_so_far(spark, path):
    rows = spark.createDataFrame([("a", "1", "t"), ("b", "2", "u")], "key string, value string, topic string")
    assert readers.topic_so_far(spark, "t", path).count() == 0
    writers.write_topic(rows.where("topic = 't'").drop("topic"), "t", "parquet", path=path)
    writers.write_topic_once(rows, 0, path)
    assert [tuple(r) for r in readers.topic_so_far(spark, "t", path).collect()] == [("a", "1")] * 2


def test_allocation_batches_equal_batch_function(spark, path):
    lines = [(o, i, (o * 37 + i * 91) % 500, at(0)) for o in range(1, 12) for i in range(o)]
    totals = {o: sum(r[2] for r in lines if r[0] == o) for o in range(1, 12)}
    rows = [(o, i, c, t, o * 1000 + 7, totals[o]) for o, i, c, t in lines]
    schema = LINE + ", final_cents long, original_cents long"
    df = spark.createDataFrame(rows, schema)
    heads = df.select("order_id", "final_cents", "original_cents").distinct()
    wide = orders.order_wide(heads, df.drop("final_cents", "original_cents"), max_part_rows=4)
    want = {(r.order_id, r.order_detail_id): r.share_cents
            for r in orders.allocate_paid_amount(wide, ["order_detail_id"]).collect()}
    sink = jobs.allocate_sink(f"{path}/state", jobs.table_sink(f"{path}/out"), ["order_detail_id"], max_part_rows=4)
    for batch_id, part in itertools.chain(enumerate([(0, 3), (3, 7), (7, 99)]), [(2, (7, 99))]):
        # the last batch is run twice, as after a crash before its checkpoint
        sink(df.where((F.col("order_detail_id") >= part[0]) & (F.col("order_detail_id") < part[1])), batch_id)
    got = {(r.order_id, r.order_detail_id): r.share_cents for r in spark.read.parquet(f"{path}/out").collect()}
    assert got == want


def test_expired_allocation_state_counts_as_absent(spark, path):
    sink = jobs.allocate_sink(f"{path}/state", jobs.table_sink(f"{path}/out"), ["order_detail_id"], ttl="600 seconds")
    schema = LINE + ", final_cents long, original_cents long"
    sink(spark.createDataFrame([(1, 1, 100, at(0), 90, 200)], schema), 0)
    sink(spark.createDataFrame([(1, 2, 100, at(11), 90, 200)], schema), 1)
    shares = [r.share_cents for r in spark.read.parquet(f"{path}/out").collect()]
    assert shares == [45, 45]  # proportional, not the remainder


def test_first_order_over_batches_and_replay(spark, path):
    schema = "id long, user_id long, create_time string"
    sink = jobs.first_order_sink(f"{path}/status", jobs.table_sink(f"{path}/out"))
    batches = [
        [(2, 1, "2021-01-01 10:00:00"), (1, 1, "2021-01-01 11:00:00"), (3, 2, "2021-01-01 09:00:00")],
        [(4, 1, "2021-01-02 10:00:00"), (5, 3, "2021-01-02 10:00:00")],
    ]
    for batch_id in (0, 1, 1):
        sink(spark.createDataFrame(batches[batch_id], schema), batch_id)
    got = {r.id: r.if_first_order for r in spark.read.parquet(f"{path}/out").collect()}
    assert got == {1: "0", 2: "1", 3: "1", 4: "0", 5: "1"}


class Crash(RuntimeError):
    pass


def test_statistics_count_once_after_a_crash(spark, path):
    feed = Feed(spark, f"{path}/in", "tm_id long, tm_name string, share_cents long")
    feed.add([(1, "a", 100), (1, "a", 50), (2, "b", 7)])
    sink = jobs.stat_sink(f"{path}/out", ["tm_id", "tm_name"])

    def failing(df, batch_id):
        sink(df, batch_id)
        raise Crash("after the output, before the commit")

    with pytest.raises(Exception, match="before the commit"):
        jobs.drain(feed.stream(), failing, f"{path}/cp")
    jobs.drain(feed.stream(), sink, f"{path}/cp")
    feed.add([(1, "a", 1)])
    jobs.drain(feed.stream(), sink, f"{path}/cp")
    sums = spark.read.parquet(f"{path}/out").groupBy("tm_id").agg(F.sum("amount_cents").alias("n"))
    assert {r.tm_id: r.n for r in sums.collect()} == {1: 151, 2: 7}


def test_topic_routing_replaces_replayed_batch(spark, path):
    sink = jobs.topic_sink(path)
    df = spark.createDataFrame([("t1", "x"), ("t2", "y")], "topic string, value string")
    for batch_id in (0, 0, 1):
        sink(df, batch_id)
    assert spark.read.parquet(path).where("topic = 't1'").count() == 2
    feed = readers.read_topic(spark, "t2", "parquet", path=path)
    jobs.drain(feed, jobs.table_sink(f"{path}_out"), f"{path}_cp")
    assert [r.value for r in spark.read.parquet(f"{path}_out").collect()] == ["y", "y"]


def test_replayed_layer_adds_nothing_downstream(spark, path):
    """A replay upstream, after the next layer has read the batch, is not new input for it."""
    sink = jobs.topic_sink(f"{path}/topics", "first")
    df = spark.createDataFrame([("t", "x"), ("t", "y")], "topic string, value string")
    sink(df, 0)

    def downstream():
        feed = readers.read_topic(spark, "t", "parquet", path=f"{path}/topics")
        jobs.drain(feed, jobs.table_sink(f"{path}/out"), f"{path}/cp")
        return sorted(r.value for r in spark.read.parquet(f"{path}/out").collect())

    assert downstream() == ["x", "y"]
    sink(df, 0)
    assert downstream() == ["x", "y"]
    # another job may use the same batch number on the same path
    jobs.topic_sink(f"{path}/topics", "second")(df.limit(0).unionByName(df.where("value = 'x'")).withColumn("topic", F.lit("u")), 0)
    assert spark.read.parquet(f"{path}/topics").where("topic = 'u'").count() == 1


def test_newest_change_of_a_key_wins(spark, path):
    """Changes of one key in any order inside a batch and late ones after it."""
    schema = "id string, name string, _ts long, _pos long, _type string"
    sink = jobs.dimension_sink(f"{path}/dim", ["id"], ["_ts", "_pos"])

    def put(batch_id, *rows):
        sink(spark.createDataFrame(rows, schema), batch_id)
        return {r.id: (r.name, r._type) for r in writers.read_keyed(spark, f"{path}/dim").collect()}

    got = put(0, ("a", "zeta", 2, 0, "update"), ("a", "alpha", 2, 1, "update"), ("a", "new", 1, 0, "insert"))
    assert got == {"a": ("alpha", "update")}
    assert put(1, ("a", "late", 1, 5, "update")) == {"a": ("alpha", "update")}
    assert put(2, ("a", "alpha", 3, 0, "delete")) == {"a": ("alpha", "delete")}
    assert put(3, ("a", "late", 2, 9, "update")) == {"a": ("alpha", "delete")}


def test_online_lists_are_replaced(spark, path):
    movies = spark.createDataFrame([(i, g) for i, g in enumerate(["war", "war", "war drama", "drama", "drama"])], "mid int, genres string")
    members = similarity.word_members(movies, similarity.genre_words(F.col("genres")))
    sims = similarity.sparse_pairs(similarity.word_set_vectors(members), 0.6)
    rated = spark.createDataFrame([(1, 0, 5.0, 1), (2, 4, 1.0, 1)], "uid int, mid int, score double, timestamp int")
    sink = jobs.online_recs_sink(path, lambda session: (rated, sims, members))
    schema = "uid int, mid int, score double, timestamp int"

    def lists():
        table = writers.read_keyed(spark, path)
        flat = [(r.uid, r.mid, round(r.score, 3)) for r in explode_recs(table, "uid").collect()]
        return {r.uid for r in table.collect()}, sorted(flat)

    sink(spark.createDataFrame([(1, 0, 5.0, 5), (2, 4, 1.0, 5), (3, 99, 1.0, 5)], schema), 0)
    # similar items above 0.7 of the one rated item: user 3 rated an unknown item
    want = [(1, 1, 5.0), (1, 2, round(5 / 2**0.5, 3)), (2, 2, round(1 / 2**0.5, 3)), (2, 3, 1.0)]
    assert lists() == ({1, 2, 3}, want)
    sink(spark.createDataFrame([(1, 99, 5.0, 6)], schema), 1)
    assert lists() == ({1, 2, 3}, want[2:])


def test_console_and_processing_time_trigger(spark, path):
    feed = Feed(spark, f"{path}/in", "id long")
    feed.add([(1,), (2,)])
    jobs.console(feed.stream(), 5).awaitTermination()
    query = jobs.start(feed.stream(), jobs.table_sink(f"{path}/out"), f"{path}/cp", every="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{path}/out").count() == 2


def _topic(spark, path, topic, values):
    rows = spark.createDataFrame([(str(k), v) for k, v in enumerate(values)], "key string, value string")
    stream_queries.publish(rows, topic, path)


def _aside(spark, path):
    return sorted(r["value"] for r in spark.read.parquet(f"{path}/aside").where("topic = 'unread'").collect())


def test_daily_actives_set_unread_records_aside(spark, tmp_path):
    good = [json.dumps({"common": {"mid": m}, "ts": 1_700_000_000_000 + k}) for k, m in enumerate("aab")]
    _topic(spark, f"{tmp_path}/topics", "start", [*good, '{"common": {"mid": "c"', "no record"])
    got = stream_queries.run_dau(spark, str(tmp_path), f"{tmp_path}/topics")
    assert sorted(r["mid"] for r in got.collect()) == ["a", "b"]
    assert _aside(spark, tmp_path) == ["no record", '{"common": {"mid": "c"']


def test_join_sets_unread_records_of_both_topics_aside(spark, tmp_path):
    time, topics = "2024-01-01 00:00:00", f"{tmp_path}/topics"
    order = {"id": 1, "user_id": 2, "province_id": 3, "order_status": "1", "create_time": time}
    order |= {"final_total_amount": 2.0, "original_total_amount": 2.0}
    line = {"id": 10, "order_id": 1, "sku_id": 5, "order_price": 1.0, "sku_num": 2, "create_time": time}
    _topic(spark, topics, stream_queries.ORDERS, [json.dumps(order), '{"id": 7, "user_id"'])
    _topic(spark, topics, stream_queries.DETAILS, [json.dumps(line), "{"])
    got = stream_queries.run_join(spark, str(tmp_path), topics).collect()
    assert [(r["order_id"], r["order_detail_id"]) for r in got] == [(1, 10)]
    assert _aside(spark, tmp_path) == ["{", '{"id": 7, "user_id"']
