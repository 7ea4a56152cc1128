import random
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark.operators import dims, orders, relational, skew
from tidemark.plans import queries, views

WIDE = "order_id long, order_detail_id long, detail_cents long"
HEAD = "order_id long, original_cents long, final_cents long"


def shares_line_by_line(lines, original, final):
    """Line by line: the first line to reach the total takes the rest."""
    before = given = 0
    done, out = False, []
    for detail in lines:
        if not done and before + detail == original:
            share, done = final - given, True
        else:
            share = (2 * final * detail + original) // (2 * original) if original else 0
        out.append(share)
        before, given = before + detail, given + share
    return out


CASES = {
    1: ([1000, 2000, 3000], 6000, 5500),
    2: ([333, 333, 334], 1000, 999),
    3: ([100, 200], 400, 350),  # lines do not reach the total
    4: ([100, 300, 50], 400, 377),  # the total is reached before the last line
    5: ([100, 300, 0, 0], 400, 377),  # free lines after the remainder line
    6: ([0, 0], 0, 500),  # zero total: the first line gets everything
    7: ([7], 7, 3),
    8: ([0, 100, 300], 400, 123),  # a free line first
}


@pytest.fixture(params=[1_000_000, 3, 1], ids=["whole", "parts", "single-row parts"])
def part_rows(request):
    return request.param


def test_allocation_cases(spark, part_rows):
    rng = random.Random(3)
    cases = dict(CASES)
    for key in range(10, 25):
        lines = [rng.randrange(0, 5000) for _ in range(rng.randrange(1, 60))]
        cases[key] = (lines, sum(lines), rng.randrange(0, 100_000))
    details = [(k, i * 7, d) for k, (ls, _, _) in cases.items() for i, d in enumerate(ls)]
    rng.shuffle(details)
    heads = spark.createDataFrame([(k, o, f) for k, (_, o, f) in cases.items()], HEAD)
    wide = orders.order_wide(
        heads, spark.createDataFrame(details, WIDE), max_part_rows=part_rows
    )
    got = orders.allocate_paid_amount(wide, ["order_detail_id"]).collect()
    for key, (lines, original, final) in cases.items():
        rows = sorted((r.order_detail_id, r.share_cents) for r in got if r.order_id == key)
        assert [s for _, s in rows] == shares_line_by_line(lines, original, final), key
        if sum(lines) == original:
            assert sum(s for _, s in rows) == final


def test_allocation_with_known_hot_orders(spark):
    """Both sides take the parts from one table, whatever else an order's lines were counted as."""
    heads = spark.createDataFrame([(1, 600, 500)], HEAD)
    lines = spark.createDataFrame([(1, 1, 100), (1, 2, 200), (1, 3, 300)], WIDE)
    hot = skew.hot_keys(lines, "order_id", "order_detail_id", 2)
    for split in (True, False):
        wide = orders.order_wide(heads, lines, hot=hot if split else None, split=split)
        done = orders.allocate_paid_amount(wide, ["order_detail_id"], split=split)
        rows = done.orderBy("order_detail_id").collect()
        assert [r.share_cents for r in rows] == [83, 167, 250]


def final_plan(df):
    """The plan that ran, after adaptive planning."""
    df.write.format("noop").mode("overwrite").save()
    query = df._jdf.queryExecution()
    df.collect()
    return query.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("one_day", [False, True])
def test_lines_are_shuffled_once(spark, one_day):
    """One scan of the lines for the result and one of their order ids for the sketch; one shuffle."""
    info = views.order_info(spark, SF)
    some = views.on_days(info, info.agg(F.min("create_date")).first()[0]) if one_day else None
    plan = final_plan(views.allocated(spark, SF, some))
    scans = re.findall(r"FileScan parquet \[([^\]]*l_orderkey[^\]]*)\]", plan)
    assert sum("l_extendedprice" in s for s in scans) == 1
    # what is left reads order ids only
    assert all("l_extendedprice" in s or s.count(",") == 0 for s in scans)
    shuffles = [line for line in plan.splitlines() if re.search(r"\bExchange hashpartitioning\(l_orderkey|\bExchange hashpartitioning\(order_id", line)]
    assert len(shuffles) <= 2  # the lines and the orders


def test_slices_follow_the_count_of_rows(spark):
    """Ids that crowd in a small part of their range, ties, and a key that is not hot."""
    rng = random.Random(9)
    ids = [int(10 ** rng.uniform(0, 9)) for _ in range(3000)] + [5] * 180 + list(range(10**12, 10**12 + 1000))
    rows = [(1, i, 1) for i in ids] + [(2, i, 1) for i in range(90)] + [(None, 1, 1)] * 400
    df = spark.createDataFrame(rows, "k long, i long, v long")
    hot = skew.hot_keys(df, "k", "i", 200)
    assert {r.k for r in hot.collect()} == {1}
    parts = skew.assign_parts(df, hot, "k", "i")
    sizes = {r.part: r["count"] for r in parts.where("k = 1").groupBy("part").count().collect()}
    assert sum(sizes.values()) == len(ids) and len(sizes) >= 18 and max(sizes.values()) <= 400
    ranges = parts.where("k = 1").groupBy("part").agg(F.min("i").alias("lo"), F.max("i").alias("hi")).orderBy("part").collect()
    assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))  # ties stay together, slices in order
    assert parts.where("k is null or k = 2").agg(F.max("part")).first()[0] == 0
    whole = skew.whole_sums(parts, "k", ["i"], {"n": F.col("v")})
    assert {(r.k, r.n) for r in whole.collect()} == {(1, len(ids)), (2, 90), (None, 400)}


def test_share_of_huge_amounts(spark):
    big = 9_000_000_000_000
    row = spark.range(1).select(
        orders.proportional_share(*[F.lit(v).cast("long") for v in (big, big - 1, big)]).alias("s")
    )
    assert row.first().s == big - 1


def test_running_sums_equal_window(spark):
    rows = [(k, i, i % 5) for k, n in ((1, 200), (2, 3), (3, 41)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, i long, v long")
    hot = skew.hot_keys(df, "k", "i", 10)
    assert {r.k for r in hot.collect()} == {1, 3}
    parts = skew.assign_parts(df, hot, "k", "i")
    assert parts.groupBy("k", "part").count().agg(F.max("count")).first()[0] <= 11
    got = skew.running_sums(parts, "k", ["i"], {"s": F.col("v")}).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.s == sum(v for k, i, v in rows if k == r.k and i < r.i)


ORDER = "id long, user_id long, create_time string"


def test_first_order_flag_ties_and_status(spark):
    rows = [
        (5, 1, "2021-07-27 10:00:00"),
        (4, 1, "2021-07-27 10:00:00"),  # same time: smaller id is first
        (6, 1, "2021-07-27 11:00:00"),
        (7, 2, "2021-07-27 09:00:00"),
        (8, 3, "2021-07-27 09:00:00"),
    ]
    status = spark.createDataFrame([("2", "1"), ("3", "0")], "user_id string, if_consumed string")
    flags = orders.first_order_flag(spark.createDataFrame(rows, ORDER), status)
    got = {r.id: r.if_first_order for r in flags.collect()}
    assert got == {4: "1", 5: "0", 6: "0", 7: "0", 8: "1"}


def test_create_date_hour(spark):
    df = spark.createDataFrame([("2021-07-27 14:20:30",), ("2021-07-27",)], "create_time string")
    rows = orders.with_create_date_hour(df).collect()
    assert (rows[0].create_date, rows[0].create_hour) == ("2021-07-27", "14")
    assert (rows[1].create_date, rows[1].create_hour) == ("2021-07-27", None)


def test_brand_names_with_underscore_stay_apart(spark):
    rows = [(1, "a_b", 100), (1, "a_b", 50), (1, "a_c", 1), (None, None, 7)]
    stat = orders.trademark_stat(
        spark.createDataFrame(rows, "tm_id long, tm_name string, share_cents long"), ["tm_id", "tm_name"]
    )
    got = {(r.tm_id, r.tm_name): r.amount_cents for r in stat.collect()}
    assert got == {(1, "a_b"): 150, (1, "a_c"): 1, (None, None): 7}


def test_user_bands_boundaries(spark):
    # as of 2024-01-01: 365-day years
    days = {"19": 20 * 365 - 1, "20": 20 * 365, "30": 31 * 365 - 1, "31": 31 * 365}
    df = spark.createDataFrame([(k, v) for k, v in days.items()], "id string, d int").select(
        "id", F.date_sub(F.lit("2024-01-01").cast("date"), F.col("d")).cast("string").alias("birthday"),
        F.when(F.col("id") == "19", "M").alias("gender"),
    )
    got = {r.id: (r.age_group, r.gender_name) for r in dims.user_bands(df, "2024-01-01").collect()}
    assert got == {
        "19": (dims.AGE_UNDER_20, dims.GENDER_MALE),
        "20": (dims.AGE_20_TO_30, dims.GENDER_FEMALE),
        "30": (dims.AGE_20_TO_30, dims.GENDER_FEMALE),
        "31": (dims.AGE_OVER_30, dims.GENDER_FEMALE),
    }


def test_unknown_sku_keeps_line(spark):
    lines = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id long, sku_id long")
    sku = spark.createDataFrame(
        [("10", 1, 2, 3, "s", "t", "c")],
        "id string, spu_id long, tm_id long, category3_id long, spu_name string, tm_name string, category3_name string",
    )
    nulls = {r.id: (r.tm_id, r.tm_name) for r in dims.with_sku(lines, sku).collect()}
    assert nulls == {1: (2, "t"), 2: (None, None), 3: (None, None)}
    zeros = {r.id: (r.tm_id, r.tm_name) for r in dims.with_sku(lines, sku, 0).collect()}
    assert zeros == {1: (2, "t"), 2: (0, None), 3: (0, None)}


def test_wide_record(spark):
    from tidemark import schemas

    cols = {
        "order_detail_id": 1, "order_id": 2, "order_status": "P", "create_time": "2021-01-01 00:00:00",
        "user_id": 3, "sku_id": 4, "price_cents": 150, "sku_num": 2, "sku_name": "n", "benefit_cents": 0,
        "freight_cents": 500, "original_cents": 300, "final_cents": 299, "share_cents": 299,
        "if_first_order": "1", "province_name": "p", "province_area_code": "a", "user_age_group": "g",
        "user_gender": "f", "create_date": "2021-01-01", "spu_id": 5, "tm_id": 6, "category3_id": 7,
        "spu_name": "s", "tm_name": "t", "category3_name": "c",
    }
    out = orders.to_order_wide(spark.createDataFrame([tuple(cols.values())], list(cols)))
    assert out.columns == schemas.ORDER_WIDE.names
    row = out.first()
    assert (row.sku_price, row.feight_fee, row.final_detail_amount) == (1.5, 5.0, 2.99)


def test_top_n_keep_first_and_lists(spark):
    rows = [("a", i, float(i % 3)) for i in range(9)] + [("b", 1, 1.0)]
    df = spark.createDataFrame(rows, "g string, mid int, score double")
    lists = relational.collect_recs(df, "g", 4)
    flat = [(r.g, r["rank"], r.mid) for r in relational.explode_recs(lists, "g").collect()]
    assert sorted(flat) == [("a", 1, 2), ("a", 2, 5), ("a", 3, 8), ("a", 4, 1), ("b", 1, 1)]
    assert {(r.g, r.mid) for r in relational.keep_first(df, ["g"], ["score", "mid"]).collect()} == {("a", 0), ("b", 1)}
    assert {(r.g, r.mid) for r in relational.keep_last(df, ["g"], ["score", "mid"]).collect()} == {("a", 8), ("b", 1)}
    paged = relational.page(df.where("g = 'a'"), [F.asc("mid")], 3, 2)
    assert [r.mid for r in paged.collect()] == [3, 4]


def test_word_count(spark):
    df = spark.createDataFrame([("One two, TWO",), ("",), (None,), ("--three two-",)], "text string")
    assert {r.word: r.n for r in relational.word_count(df, "text").collect()} == {"one": 1, "two": 3, "three": 1}


def test_rename_to(spark):
    df = spark.createDataFrame([(1, "a")], "tm_id long, tm_name string")
    assert relational.rename_to(df, ["ID", "TM_NAME"]).columns == ["ID", "TM_NAME"]
    with pytest.raises(ValueError):
        relational.rename_to(df, ["ID"])


def test_hot_lookup_key_is_split(spark):
    """A third of the facts on one key: the shuffled lookup join splits that key's partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("long")
        facts = spark.range(0, 300_000, 1, 8).select(key.alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        dim = spark.range(1000).select("id", F.col("id").cast("string").alias("name"))
        out = relational.enrich(facts, dim, {"user_id": "id"}, {"name": "user_name"})
        counts = out.groupBy("user_name").count()
        assert counts.agg(F.sum("count")).first()[0] == 300_000
        out.write.format("noop").mode("overwrite").save()
        cached = out.persist()
        cached.count()
        plan = cached._jdf.queryExecution().executedPlan().toString()
        cached.unpersist()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_wide_record_shuffles_lines_to_their_order_once(spark):
    """All orders are wanted, so the lines are not narrowed by them first."""
    plan = queries.QUERIES["order_wide_record"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan
