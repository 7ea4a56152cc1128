"""State per key in the state store, and layers whose batches crash at every point."""

import random

import numpy as np
import pytest
from compare import connect, differences
from conftest import SF
from pyspark.sql import functions as F
from test_streaming import LINE, Feed, at

import __spark_entry__ as contract
from tidemark.operators import orders
from tidemark.plans import stream_queries
from tidemark.sources import keyed
from tidemark.streaming import jobs, state

ORDER = "id long, user_id long, create_time string, note string"


class Crash(RuntimeError):
    pass


def crash_once(sink):
    """A sink that fails after its output, before the checkpoint, the first time only."""
    done = []

    def run(df, batch_id):
        sink(df, batch_id)
        if not done:
            done.append(batch_id)
            raise Crash("after the output")

    return run


def order_rows(n=200, seed=4):
    rng = random.Random(seed)
    users = [1, 1, 1, 2, 3, None]  # one user has a third of all orders
    return [
        (i, rng.choice([*users, 40 + i % 9]), f"2021-01-{1 + i // 40:02d} {rng.randint(0, 23):02d}:00:00", None)
        for i in range(n)
    ]


def test_first_orders_over_batches_with_a_crash_and_a_resume(spark, path):
    feed, rows = Feed(spark, f"{path}/in", ORDER), order_rows()

    def run(sink):
        jobs.drain(state.flag_first_orders(feed.stream(), lanes=3), sink, f"{path}/cp")

    sink = jobs.table_sink(f"{path}/out")
    for k in range(5):
        feed.add(rows[k * 40 : (k + 1) * 40])
        if k in (0, 3):
            with pytest.raises(Exception, match="after the output"):
                run(crash_once(sink))
        run(sink)
    found = spark.read.parquet(f"{path}/out").collect()
    want = orders.first_order_flag(spark.createDataFrame(rows, ORDER)).collect()
    assert len(found) == len(rows)
    assert {r.id: r.if_first_order for r in found} == {r.id: r.if_first_order for r in want}


def test_hot_users_do_not_meet_one_state(spark, path):
    """Of a user's orders in an Arrow batch one goes to the state, the others are dealt over the lanes."""
    df = spark.createDataFrame([(i, 7, "2021-01-01 00:00:00", None) for i in range(1000)], ORDER).coalesce(1)
    dealt = df.mapInArrow(state._deal(16), ORDER + ", _lane int").groupBy("_lane").count().collect()
    sizes = {r["_lane"]: r["count"] for r in dealt}
    assert sizes.pop(0) == 1 and len(sizes) == 16 and max(sizes.values()) <= 63


def test_users_of_one_group_keep_their_own_first_order(spark, path):
    """Users that share a state table, some without an id or with ids next to each other beyond 2^53."""
    feed, groups, big = Feed(spark, f"{path}/in", ORDER), 3, 2**60
    rows = [(i, big + i % 50, f"2021-01-{1 + i // 60:02d} 10:00:00", None) for i in range(240)]
    rows += [(1000 + i, None, f"2021-01-{1 + i:02d} 09:00:00", None) for i in range(4)]
    for k in range(4):
        feed.add([r for r in rows if r[2] < f"2021-01-{k + 2:02d}" and r[2] >= f"2021-01-{k + 1:02d}"])
        flagged = state.flag_first_orders(feed.stream(), lanes=3, groups=groups)
        jobs.drain(flagged, jobs.replayed(jobs.table_sink(f"{path}/out")), f"{path}/cp")
    found = spark.read.parquet(f"{path}/out")
    want = orders.first_order_flag(spark.createDataFrame(rows, ORDER).where("user_id is not null"))
    firsts = {r.id for r in want.where("if_first_order = '1'").collect()} | {1000}
    assert {r.id for r in found.where("if_first_order = '1'").collect()} == firsts
    assert {(r.id, r.user_id) for r in found.collect()} == {(r[0], r[1]) for r in rows}
    assert found.count() == len(rows)
    # was one state, and one call of Python, per user
    store = spark.read.format("statestore").load(f"{path}/cp")
    assert store.where("value.groupState is not null").count() <= groups + 1


def test_allocation_state_expires_with_the_watermark(spark, path):
    feed = Feed(spark, f"{path}/in", LINE + ", final_cents long, original_cents long")

    def run(sink=jobs.table_sink(f"{path}/out")):  # noqa: B008
        lines = feed.stream().withWatermark("detail_time", "10 seconds")
        jobs.drain(state.allocate(lines, ["order_detail_id"], 600), sink, f"{path}/cp")
        return {(r.order_id, r.order_detail_id): r.share_cents for r in spark.read.parquet(f"{path}/out").collect()}

    feed.add([(1, 1, 100, at(0), 90, 200), (2, 1, 333, at(0), 999, 1000), (9, 1, 7, at(0), 5, 7)])
    run()
    feed.add([(2, 2, 333, at(1), 999, 1000), (1, 2, 100, at(9), 90, 200), (9, 2, 0, at(2), 5, 7)])
    with pytest.raises(Exception, match="after the output"):
        run(crash_once(jobs.table_sink(f"{path}/out")))
    got = run()
    # the rest for the second line of order 1; nothing for the free line after the total of order 9
    assert got[1, 2] == 45 and got[2, 2] == 333 and (got[9, 1], got[9, 2]) == (5, 0)
    feed.add([(3, 1, 5, at(30), 5, 5)])
    run()
    feed.add([(4, 1, 5, at(30), 5, 5)])
    run()  # the watermark has passed, so the states of orders 1, 2 and 9 are gone
    store = spark.read.format("statestore").load(f"{path}/cp")
    alive = {r.key.order_id for r in store.where("value.groupState is not null").select("key").collect()}
    assert alive == {3, 4}
    feed.add([(2, 3, 334, at(31), 999, 1000)])
    assert run()[2, 3] == 334  # proportional, not the rest of 333


def test_allocation_over_four_batches_equals_the_batch_function(spark, path):
    lines = [(o, i, (o * 37 + i * 91) % 500, at(0)) for o in range(1, 30) for i in range(o % 9)]
    totals = {o: sum(r[2] for r in lines if r[0] == o) for o in range(1, 30)}
    schema = LINE + ", final_cents long, original_cents long"
    rows = [(o, i, c, t, o * 1000 + 7, totals[o]) for o, i, c, t in lines]
    rows += [(50, 0, None, at(0), 10, 10), (51, 0, 10, at(0), None, 10), (52, 0, 0, at(0), 5, 0), (53, 0, 10**12, at(0), 10**12 + 1, 3 * 10**12)]
    feed = Feed(spark, f"{path}/in", schema)
    for part in ((0, 2), (2, 3), (3, 6), (6, 99)):
        feed.add([r for r in rows if part[0] <= r[1] < part[1]])
        shares = state.allocate(feed.stream().withWatermark("detail_time", "1 minute"), ["order_detail_id"])
        jobs.drain(shares, jobs.table_sink(f"{path}/out"), f"{path}/cp")
    df = spark.createDataFrame(rows, schema)
    wide = df.withColumns({"part": F.lit(0), "n_parts": F.lit(None).cast("int")})
    want = orders.allocate_paid_amount(wide, ["order_detail_id"], split=False).collect()
    got = spark.read.parquet(f"{path}/out").collect()
    key = lambda r: (r.order_id, r.order_detail_id)
    assert len(got) == len(rows)
    assert {key(r): r.share_cents for r in got} == {key(r): r.share_cents for r in want}
    assert spark.read.parquet(f"{path}/out").select("batch_id").distinct().count() == 4


def test_orders_of_one_group_keep_their_own_sums_and_expire_one_by_one(spark, path):
    """Orders that share a state table: one call of the group for all of them, and each has its own time."""
    schema = LINE + ", final_cents long, original_cents long"
    feed, calls = Feed(spark, f"{path}/in", schema), spark.sparkContext.accumulator(0)
    plain = state.share_out

    def counted(*args):
        calls.add(1)
        return plain(*args)

    def run(sink=jobs.table_sink(f"{path}/out")):  # noqa: B008
        lines = feed.stream().withWatermark("detail_time", "10 seconds")
        with pytest.MonkeyPatch.context() as m:
            m.setattr(state, "share_out", counted)
            jobs.drain(state.allocate(lines, ["order_detail_id"], 600, groups=2), sink, f"{path}/cp")
        return {(r.order_id, r.order_detail_id): r.share_cents for r in spark.read.parquet(f"{path}/out").collect()}

    feed.add([(o, 1, 100, at(0), 90 + o, 300) for o in range(40)])
    run()
    assert calls.value == 2  # was one call of Python per order
    feed.add([(o, 2, 100, at(9 if o < 20 else 1), 90 + o, 300) for o in range(40)])
    run()
    feed.add([(100, 1, 5, at(15), 5, 5), (101, 1, 5, at(15), 5, 5), (103, None, None, at(15), 5, 5), (103, 2**60 + 1, 5, at(15), 5, 5)])
    run()  # 14:50 is past 1:00 + 10 minutes, not past 9:00 + 10 minutes
    feed.add([(o, 3, 100, at(18), 90 + o, 300) for o in range(40)])
    got = run()
    # ids beyond 2^53 beside a line without an id
    assert got[103, 2**60 + 1] == 5 and got[103, None] == 0
    third = lambda o: (2 * (90 + o) * 100 + 300) // 600
    for o in range(40):
        rest = 90 + o - 2 * third(o)
        assert (got[o, 1], got[o, 2], got[o, 3]) == (third(o), third(o), rest if o < 20 else third(o))


def test_shares_of_amounts_beyond_64_bits():
    big = 4 * 10**12
    parts = state._parts(np.array([big, 3, -7]), np.array([3 * big, 0, 2]), np.array([big + 1, 5, 1]))
    assert parts.tolist() == [(2 * (big + 1) * big + 3 * big) // (6 * big), 0, (-14 + 2) // 4]


@pytest.mark.parametrize("point", ["before the rename", "after the rename"])
def test_every_layer_survives_a_crash(spark, monkeypatch, point):
    """Each layer crashes once between its data and their record, or between that and its checkpoint."""
    publish, crashed = keyed.publish, []

    def drain(df, sink, checkpoint):
        armed = [True]

        def failing(*args):
            if armed.pop() if armed else False:
                crashed.append(checkpoint)
                raise Crash(point)
            publish(*args)

        with monkeypatch.context() as m:
            if point == "before the rename":
                m.setattr(keyed, "publish", failing)
            with pytest.raises(Exception, match=point if point.startswith("before") else "after the output"):
                jobs.drain(df, sink if point.startswith("before") else crash_once(sink), checkpoint)
        jobs.drain(df, sink, checkpoint)

    got = stream_queries.layers(spark, SF, drain)
    assert not differences(got, connect(SF), contract.oracle_sql()["ads_once"])
    assert point.startswith("after") or len(set(crashed)) == 5
