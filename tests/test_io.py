import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark import schemas
from tidemark.operators import paging
from tidemark.session import workspace
from tidemark.sources import keyed, readers, writers


def lines(path, *rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/data.txt", "w") as f:
        f.write("\n".join(rows) + "\n")
    return path


def test_delimited_with_empty_tail(spark, path):
    lines(path, " 1 ^ Toy ^d^81 min^1999^1995^en^A|B^x|y^", "2^B^^^^^^^^", "oops^C")
    rows = readers.read_delimited(spark, path, schemas.MOVIE, "^").orderBy("name").collect()
    assert [(r.mid, r.name, r.genres, r.directors) for r in rows] == [
        (2, "B", None, None), (None, "C", None, None), (1, "Toy", "A|B", None),
    ]


def test_csv_and_lines(spark, path):
    lines(path, "15,1955,dentist,1193435061")
    assert tuple(readers.read_csv(spark, path, schemas.TAG).first()) == (15, 1955, "dentist", 1193435061)
    assert readers.read_lines(spark, path).first().value == "15,1955,dentist,1193435061"


def test_nested_text(spark, path):
    lines(
        path,
        "songsong,bingbing_lili,xiao song:18_xiaoxiao song:19,hui long guan_beijing",
        "yangyang,caicai_susu,xiao yang:18_xiaoxiao yang:19,chao yang_beijing",
    )
    row = readers.read_nested_text(spark, path).orderBy("name").first()
    assert row.friends == ["bingbing", "lili"]
    assert row.children == {"xiao song": 18, "xiaoxiao song": 19}
    assert (row.address.street, row.address.city) == ("hui long guan", "beijing")


def test_json_with_corrupt_rows(spark):
    df = spark.createDataFrame([('{"user_id":"1","if_consumed":"1","x":2}',), ("{oops",), (None,)], "value string")
    rows = readers.parse_json(df, schemas.USER_STATUS).collect()
    assert [tuple(r) for r in rows] == [("1", "1", None), (None, None, "{oops"), (None, None, None)]


def test_literal_rows(spark):
    assert [r.g for r in readers.literal_rows(spark, ["a", "b"], "g").collect()] == ["a", "b"]


def test_overwrite_and_text(spark, path):
    for n in (3, 2):
        writers.write_overwrite(spark.range(n), path=f"{path}/t")
    assert readers.read_table(spark, "", f"{path}/t").count() == 2
    writers.write_overwrite(spark.range(4), "plain_table")
    assert readers.read_table(spark, "plain_table").count() == 4
    df = spark.createDataFrame([(1, None, "b")], "x int, y string, z string")
    writers.write_text(df, f"{path}/text", sep="|")
    assert readers.read_lines(spark, f"{path}/text").first().value == "1||b"


def test_upsert_in_buckets(spark, path):
    def put(rows, **kw):
        df = spark.createDataFrame(rows, "id string, v int, s string")
        writers.upsert(df, path, ["id"], fan_in=2, **kw)
        return {r.id: (r.v, r.s) for r in writers.read_keyed(spark, path).collect()}

    assert put([("a", 1, "x"), ("b", 1, "x")]) == {"a": (1, "x"), "b": (1, "x")}
    assert put([("a", 0, "y"), ("c", 1, "z")]) == {"a": (0, "y"), "b": (1, "x"), "c": (1, "z")}
    assert put([("a", 0, "y"), ("c", 1, "z")]) == {"a": (0, "y"), "b": (1, "x"), "c": (1, "z")}
    # a version column keeps the newer stored row
    assert put([("b", 0, "old"), ("c", 5, "new")], version=["v"]) == {
        "a": (0, "y"), "b": (1, "x"), "c": (5, "new"),
    }


def test_upsert_in_dated_partitions(spark, path):
    def put(rows):
        df = spark.createDataFrame(rows, "mid string, hr string, dt string")
        writers.upsert(df, path, ["mid"], partition="dt")
        rows = writers.read_keyed(spark, path).collect()
        return sorted((r.dt, r.mid, r.hr) for r in rows)

    put([("a", "01", "2021-01-01"), ("b", "02", "2021-01-01"), ("a", "03", "2021-01-02")])
    got = put([("a", "09", "2021-01-02"), ("c", "04", "2021-01-02")])
    assert got == [
        ("2021-01-01", "a", "01"), ("2021-01-01", "b", "02"),
        ("2021-01-02", "a", "09"), ("2021-01-02", "c", "04"),
    ]


def test_upsert_drops_expired_rows(spark, path):
    for rows in ([("a", 1), ("b", 5)], [("c", 6)]):
        df = spark.createDataFrame(rows, "id string, seen int")
        writers.upsert(df, path, ["id"], fan_in=1, keep=F.col("seen") > 2)
    assert {r.id for r in writers.read_keyed(spark, path).collect()} == {"b", "c"}


def test_replace_by_key(spark, path):
    def put(rows):
        writers.replace_by_key(spark.createDataFrame(rows, "uid int, mid int"), path, "uid", fan_in=2)
        return sorted((r.uid, r.mid) for r in writers.read_keyed(spark, path).collect())

    put([(1, 10), (1, 11), (2, 20)])
    assert put([(1, 12), (3, 30)]) == [(1, 12), (2, 20), (3, 30)]


def test_batch_once(spark, path):
    writers.write_batch_once(spark.range(3), 0, path)
    writers.write_batch_once(spark.range(2), 1, path)
    writers.write_batch_once(spark.range(3), 0, path)
    assert spark.read.parquet(path).count() == 5


def test_topics(spark, path):
    df = spark.createDataFrame([(1, None, "é")], "id long, a string, b string")
    writers.write_topic(writers.as_messages(df, "id"), "t", "parquet", path=path)
    row = spark.read.parquet(f"{path}/topic=t").first()
    assert (row.key, row.value) == ("1", '{"id":1,"b":"é"}')
    stream = readers.read_topic(spark, "t", "parquet", path=path)
    assert stream.isStreaming and stream.columns == ["key", "value"]


def test_raw_landing(spark, path):
    df = spark.createDataFrame([("x", "2021-01-01"), ("y", "2021-01-02")], "value string, dt string")
    writers.land_raw(df, path)
    writers.land_raw(df.limit(1), path)
    assert sorted(os.path.basename(p) for p in os.listdir(path) if p.startswith("dt")) == ["dt=2021-01-01", "dt=2021-01-02"]
    assert spark.read.parquet(path).count() == 3


def test_table_layout_joins_without_shuffle(spark, path):
    for name in ("left_b", "right_b"):
        writers.create_table(
            spark.range(100).withColumn("p", F.col("id") % 2), f"shop.{name}", f"{path}/{name}",
            partition_by=["p"], bucket_by=["id"], n_buckets=4, sort_by=["id"], comment="it's a test", column_comments={"id": "the key"},
        )
    described = {r.col_name: r.comment for r in spark.sql("describe shop.left_b").collect()}
    assert described["id"] == "the key"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("shop.left_b").drop("p").join(spark.table("shop.right_b").drop("p"), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_compaction(spark, path):
    spark.range(1000).repartition(20).write.parquet(f"{path}/small")
    writers.compact(spark, f"{path}/small", f"{path}/large", 1024 * 1024)
    files = [f for f in os.listdir(f"{path}/large") if f.endswith(".parquet")]
    assert len(files) == 1
    assert spark.read.parquet(f"{path}/large").agg(F.sum("id")).first()[0] == 499500
    assert readers.read_small_files(spark, f"{path}/small", 2048).rdd.getNumPartitions() > 1


def test_jdbc_and_kafka_need_their_connectors(spark):
    # No store or broker is available here; the options reach Spark, which has no driver for them.
    with pytest.raises(Exception, match="(?i)driver|suitable"):
        readers.read_query(spark, "jdbc:nosuch://host/db", "select 1", {"driver": "no.such.Driver"})
    with pytest.raises(Exception, match="(?i)driver|suitable"):
        writers.append_jdbc(spark.range(1), "jdbc:nosuch://host/db", "t", options={"driver": "no.such.Driver"})
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.read_topic(spark, "t", "kafka", "host:9092")


def test_workspace_is_below_the_shared_folder(spark):
    a, b = workspace(spark, "x"), workspace(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_schemas_cover_records():
    assert len(schemas.ORDER_WIDE.names) == 26
    assert schemas.extend(StructType([]), "a:int") == StructType([StructField("a", IntegerType())])


# -- keyed tables by versions


class Crash(RuntimeError):
    pass


def test_a_crash_before_the_switch_leaves_the_old_version(spark, path, monkeypatch):
    put = lambda *rows, **kw: writers.upsert(spark.createDataFrame(rows, "id long, v long"), path, ["id"], **kw)
    read = lambda: {r.id: r.v for r in writers.read_keyed(spark, path).collect()}
    put((1, 10), (2, 20), batch=("job", 0))
    publish = keyed.publish

    def crash(*_):
        raise Crash

    monkeypatch.setattr(keyed, "publish", crash)
    with pytest.raises(Crash):
        put((2, 21), (3, 30), batch=("job", 1))
    assert read() == {1: 10, 2: 20}
    monkeypatch.setattr(keyed, "publish", publish)
    for _ in range(2):  # again after the crash, and a replay of what was published
        put((2, 21), (3, 30), batch=("job", 1))
    assert read() == {1: 10, 2: 21, 3: 30}
    assert keyed.manifest(spark, path).batches == {"job": 1} and len(keyed.versions(spark, path)) == 2
    # another writer had the same version
    at = keyed.manifest(spark, path)
    with pytest.raises(FileExistsError):
        keyed._commit(spark, path, at)


def test_written_bytes_follow_the_batch(spark, path):
    big = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"))
    writers.upsert(big, path, ["id"])
    stored = keyed.bytes_below(spark, f"{path}/segments")
    sizes = []
    for k in range(20):
        before = keyed.bytes_below(spark, f"{path}/segments")
        writers.upsert(big.where(F.col("id") % 20_000 == k).withColumn("s", F.lit(f"new {k}")), path, ["id"])
        sizes.append(keyed.bytes_below(spark, f"{path}/segments") - before)
    # merges of small segments included, the large one is not rewritten by the first seven
    assert max(sizes[:6]) < stored / 100
    names = {s.name: s.level for s in keyed.manifest(spark, path).segments}
    assert len(names) <= 9 and max(names.values()) == 1
    got = writers.read_keyed(spark, path)
    assert got.count() == 200_000 and got.where("s like 'new%'").count() == 200
    assert got.where("id = 20003").first().s == "new 3"
    assert len(keyed.versions(spark, path)) <= 3 + keyed.FAN_IN


def test_versions_decide_across_merges(spark, path):
    """Late changes lose however segments were merged; nulls in keys and columns that clash stay apart."""
    for k, rows in enumerate([[(1, 5, "a"), (None, 1, "n")], [(1, 3, "late"), (2, 1, "b")], [(1, 5, "same, later")], [(2, 0, "late"), (None, 2, "m")]]):
        df = spark.createDataFrame(rows, "id long, ver long, _row string")
        writers.upsert(df, path, ["id"], ["ver"], batch=("j", k), fan_in=2)
    got = {(r.id, r.ver): r["_row"] for r in writers.read_keyed(spark, path).collect()}
    assert got == {(1, 5): "same, later", (2, 1): "b", (None, 2): "m"}


# -- deep pages


def test_pages_read_the_ranges_that_hold_them(spark, path):
    rows = spark.range(1_200_000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("_range_"), "id"
    )
    order = [F.desc("a"), F.asc_nulls_last("_range_"), F.asc("id")]
    pages = paging.prepare(rows, order, ranges=24)
    assert pages.rows == 1_200_000 and len(pages.ends) > 12
    for offset, size in ((0, 5), (1_000_000, 20), (1_199_995, 50), (pages.ends[3][1] - 7, 20), (2_000_000, 5), (10, 0)):
        got = pages.page(offset, size)
        assert got.collect() == rows.orderBy(*order).offset(offset).limit(size).collect()
    deep = pages.page(1_000_000, 20)
    deep.collect()
    plan = deep._jdf.queryExecution().executedPlan()
    scans = re.search(r"PartitionFilters: \[.*_range#\d+ (IN \(([^)]*)\)|= )", plan.toString())
    assert scans and (scans.group(2) or "").count(",") <= 1  # at most two ranges
    empty = paging.prepare(rows.limit(0), order, ranges=3)
    assert empty.rows == 0 and empty.page(0, 5).count() == 0
