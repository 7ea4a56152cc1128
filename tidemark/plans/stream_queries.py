"""The registered streaming queries.

Each publishes the test tables as topic folders, runs the jobs over them until the input is used
up and returns what the jobs left behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import to_cents
from ..operators import cdc, dims, online, orders, ratings
from ..operators.relational import explode_recs
from ..session import workspace
from ..sources import readers, writers
from ..streaming import jobs, state
from . import views
from .queries import _word_set_sims, query

ORDERS, DETAILS = "dwd_order_info", "dwd_order_detail"


#: Files of one publication where a stream takes one publication per batch.
FILES = 2


def publish(rows: DataFrame, topic: str, path: str, files: int | None = None) -> None:
    writers.write_topic(rows.repartition(files) if files else rows, topic, "parquet", path=path)


def order_stream(
    spark: SparkSession, path: str, topic: str = ORDERS, max_files: int | None = None, unread: bool = False
) -> DataFrame:
    """Order heads from a topic.  Records that cannot be read are left out, or with ``unread`` stay, with
    their text in ``_corrupt``, for ``jobs.set_aside``."""
    parsed = readers.parse_json(
        readers.read_topic(spark, topic, "parquet", path=path, max_files=max_files).select("value"),
        schemas.ORDER_INFO,
    )
    dated = orders.with_create_date_hour(parsed)
    return dated if unread else dated.where(F.col("_corrupt").isNull()).drop("_corrupt")


def _heads(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(
        F.col("id").alias("order_id"), "user_id", "province_id", "order_status",
        F.col("create_date").alias("dt"),
        to_cents(F.col("final_total_amount")).alias("final_cents"),
        to_cents(F.col("original_total_amount")).alias("original_cents"),
        F.to_timestamp("create_time").alias("order_time"), *extra,
    )


def detail_stream(
    spark: SparkSession, path: str, topic: str = DETAILS, max_files: int | None = None, unread: bool = False
) -> DataFrame:
    """Order lines from a topic; ``unread`` as for orders."""
    parsed = readers.parse_json(
        readers.read_topic(spark, topic, "parquet", path=path, max_files=max_files).select("value"),
        schemas.ORDER_DETAIL,
    )
    return parsed if unread else parsed.where(F.col("_corrupt").isNull()).drop("_corrupt")


def _lines(rows: DataFrame, *extra: str) -> DataFrame:
    cents: Column = to_cents(F.col("order_price")) * F.col("sku_num")
    return rows.select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_num",
        cents.alias("detail_cents"), F.to_timestamp("create_time").alias("detail_time"), *extra,
    )


def _publish_orders(spark: SparkSession, sf_dir: str, path: str) -> None:
    publish(writers.as_messages(views.order_records(spark, sf_dir), "id"), ORDERS, path)
    publish(writers.as_messages(views.detail_records(spark, sf_dir), "order_id"), DETAILS, path)


def _hot_orders(spark: SparkSession, path: str, topics: str) -> DataFrame:
    """The orders with very many lines among those that wait in the topic."""
    waiting = readers.topic_so_far(spark, DETAILS, topics).select("value")
    return jobs.hot_orders(readers.parse_json(waiting, schemas.ORDER_DETAIL).select("order_id"), f"{path}/hot_orders")


def _keep_unread(spark: SparkSession, path: str, topics: str, max_files: int | None = None) -> None:
    """Sets the records of both order topics aside that cannot be read."""
    heads = order_stream(spark, topics, max_files=max_files, unread=True)
    lines = detail_stream(spark, topics, max_files=max_files, unread=True)
    for name, parsed in ((ORDERS, heads), (DETAILS, lines)):
        jobs.keep_unread(parsed, f"{path}/aside", name, f"{path}/checkpoint-{name}")


def run_dau(spark: SparkSession, path: str, topics: str) -> DataFrame:
    """First record per device and day of the topic ``start``, kept below path; unread records go aside."""
    records = readers.parse_json(
        readers.read_topic(spark, "start", "parquet", path=topics).select("value"), schemas.APP_LOG
    )
    read = records.where(F.col("_corrupt").isNull())
    firsts = jobs.dau_stream(
        read.select(F.col("common.mid").alias("mid"), F.timestamp_millis("ts").alias("ts"))
    )
    jobs.drain(firsts, jobs.table_sink(f"{path}/dau"), f"{path}/checkpoint")
    jobs.keep_unread(records, f"{path}/aside", "start", f"{path}/checkpoint-start")
    return spark.read.parquet(f"{path}/dau")


@query
def dau_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices per day, deduplicated as a stream."""
    path = workspace(spark, "dau_stream")
    publish(views.log_json(spark, sf_dir), "start", f"{path}/topics")
    firsts = run_dau(spark, path, f"{path}/topics")
    return firsts.select("mid", F.date_format("day", "yyyy-MM-dd").alias("dt"))


def run_join(spark: SparkSession, path: str, topics: str) -> DataFrame:
    """Orders and lines of the topics joined, kept below path; unread records go aside."""
    heads, lines = _heads(order_stream(spark, topics)), _lines(detail_stream(spark, topics))
    both, sink = jobs.join_waiting(heads, lines, f"{path}/waiting", jobs.table_sink(f"{path}/wide"))
    jobs.drain(both, sink, f"{path}/checkpoint")
    _keep_unread(spark, path, topics)
    return spark.read.parquet(f"{path}/wide")


@query
def route_cdc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records routed to topic folders as a stream, counted per topic."""
    path = workspace(spark, "route_cdc")
    publish(views.cdc_maxwell(spark, sf_dir), "changes", f"{path}/topics")
    changes = readers.read_topic(spark, "changes", "parquet", path=f"{path}/topics")
    routed = cdc.route_cdc_maxwell(changes)
    jobs.drain(routed, jobs.topic_sink(f"{path}/ods"), f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/ods").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def _publish_dimensions(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Change records of all dimension tables, routed to one topic per table."""
    price = (F.col("price_cents") / 100).cast("string")
    tables = {
        "base_trademark": views.trademark(spark, sf_dir),
        "base_category3": views.category3(spark, sf_dir),
        "spu_info": views.spu(spark, sf_dir),
        "sku_info": views.sku(spark, sf_dir).withColumn("price", price).drop("price_cents"),
        "user_info": views.users(spark, sf_dir),
    }
    for name, rows in tables.items():
        publish(views.change_messages(rows, name), "changes", f"{path}/topics")
    return _route_dimensions(spark, path)


def _route_dimensions(spark: SparkSession, path: str) -> str:
    changes = readers.read_topic(spark, "changes", "parquet", path=f"{path}/topics", max_files=1)
    routed = cdc.route_cdc_maxwell(changes, versioned=True)
    jobs.drain(routed, jobs.topic_sink(f"{path}/ods"), f"{path}/checkpoints/ods")
    return f"{path}/ods"


VERSION = ["_ts", "_pos"]


def _read_dimension(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A stored dimension as it stands; deleted rows stay stored, so that late changes lose to them."""
    rows = writers.read_keyed(spark, f"{path}/dim/{name}")
    return rows.where(F.col("_type") != "delete").drop(*VERSION, "_type")


def _dimension(spark: SparkSession, path: str, name: str, schema, key: str, prepare=None) -> DataFrame:
    """Run one dimension job over its topic and return the stored table."""
    topic = readers.read_topic(spark, f"ods_{name}", "parquet", path=f"{path}/ods", max_files=1).select("value")
    full = schemas.extend(schema, "_ts:long _pos:long _type:string")
    rows = readers.parse_json(topic, full).where(F.col("_corrupt").isNull()).drop("_corrupt")
    sink = jobs.dimension_sink(f"{path}/dim/{name}", [key], VERSION, prepare)
    jobs.drain(rows, sink, f"{path}/checkpoints/{name}")
    return _read_dimension(spark, path, name)


@query
def dimension_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert, updates, late changes and deletes of the same keys in one batch and over several.

    The topic has two publications.  The first inserts every part, then renames it twice; the second
    renames even keys, repeats an old name for every fifth and deletes every third.
    """
    path = workspace(spark, "dimension_changes")
    key = F.col("p_partkey")
    parts = views.table(spark, sf_dir, "part").select("p_partkey")

    def change(kind: str, ts: int, position: int, name: str, rows: DataFrame = parts) -> DataFrame:
        data = F.struct(key.cast("string").alias("tm_id"), F.lit(name).alias("tm_name"))
        return rows.select(F.to_json(F.struct(
            F.lit(kind).alias("type"), F.lit("base_trademark").alias("table"), data.alias("data"),
            F.lit(ts).alias("ts"), F.lit(position).alias("xoffset"),
        )).alias("value"))

    first = change("insert", 1, 0, "new").unionByName(change("update", 2, 0, "zeta"))
    publish(first.unionByName(change("update", 2, 1, "alpha")), "changes", f"{path}/topics")
    second = change("update", 3, 0, "omega", parts.where(key % 2 == 0)).unionByName(
        change("update", 1, 1, "late", parts.where(key % 5 == 0))
    )
    publish(second.unionByName(change("delete", 4, 0, "omega", parts.where(key % 3 == 0))), "changes", f"{path}/topics")
    _route_dimensions(spark, path)
    return _dimension(spark, path, "base_trademark", schemas.TRADEMARK, "tm_id")


@query
def sku_dimension_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension jobs in their order: plain tables first, then SKUs with the names from them."""
    path = workspace(spark, "sku_dimension")
    _publish_dimensions(spark, sf_dir, path)
    _dimension(spark, path, "base_trademark", schemas.TRADEMARK, "tm_id")
    _dimension(spark, path, "base_category3", schemas.CATEGORY3, "id")
    _dimension(spark, path, "spu_info", schemas.SPU, "id")

    def names(batch: DataFrame) -> DataFrame:
        stored = [
            _read_dimension(batch.sparkSession, path, name)
            for name in ("base_category3", "base_trademark", "spu_info")
        ]
        return dims.denormalize_sku(batch.drop("category3_name", "tm_name", "spu_name"), *stored)

    table = _dimension(spark, path, "sku_info", schemas.SKU, "id", names)
    return table.drop("price", "create_time")


@query
def user_dimension_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User change records stored with their age band and gender name."""
    path = workspace(spark, "user_dimension")
    _publish_dimensions(spark, sf_dir, path)
    table = _dimension(
        spark, path, "user_info", schemas.USER, "id", lambda rows: dims.user_bands(rows, views.AS_OF)
    )
    return table.drop("user_level")


@query
def order_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and line streams joined within 50 seconds."""
    path = workspace(spark, "order_join")
    _publish_orders(spark, sf_dir, f"{path}/topics")
    return run_join(spark, path, f"{path}/topics").select(
        "order_id", "order_detail_id", "user_id", "sku_id", "detail_cents", "final_cents", "dt"
    )


#: Rows of a file of a publication at least, where there is more than one pair of files, and files at most.
FILE_ROWS, MOST_FILES = 250_000, 32


def _files(rows: DataFrame) -> int:
    """Files of one publication of a table that comes in four, from the table's count."""
    return max(FILES, min(MOST_FILES, rows.count() // (4 * FILE_ROWS)))


@query
def alloc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined streams with the paid amount allocated; lines count in id order.

    The lines come in four publications by id, so those of most orders are spread over several batches.
    The job stops after two and resumes from its checkpoint.  Orders are years apart and the later lines are
    as old as the first, hence the long delay of the watermark.
    """
    path, late = workspace(spark, "alloc"), "4000 days"
    topics, files = f"{path}/topics", _files(views.table(spark, sf_dir, "lineitem"))
    publish(writers.as_messages(views.order_records(spark, sf_dir).repartition(files), "id"), ORDERS, topics)
    part = F.shiftright("id", 58)  # ids have 60 bits

    def shares(done: DataFrame, batch_id: int) -> None:
        jobs.table_sink(f"{path}/wide")(done.select("order_id", "order_detail_id", "share_cents"), batch_id)

    def allocated(wide: DataFrame, batch_id: int) -> None:
        state.allocate(wide, ["order_detail_id"], table=f"{path}/state", emit=shares, batch_id=batch_id, late=late)

    def run() -> None:
        both, sink = jobs.join_order_streams(
            _heads(order_stream(spark, topics, max_files=files)),
            _lines(detail_stream(spark, topics, max_files=files)),
            late=late,
            hot=_hot_orders(spark, path, topics),
            waiting=f"{path}/waiting",
            emit=allocated,
        )
        jobs.drain(both, sink, f"{path}/checkpoint")
        _keep_unread(spark, path, topics, files)

    # derived once, not once per publication
    with jobs.stored_batch(views.detail_records(spark, sf_dir).withColumn("part", part), f"{path}/records", "part") as lines:
        for parts in ((0, 1), (2, 3)):
            for p in parts if lines is not None else ():
                mine = lines.where(F.col("part") == p).drop("part").repartition(files)
                publish(writers.as_messages(mine, "order_id"), DETAILS, topics)
            run()
    return spark.read.parquet(f"{path}/wide").select("order_id", "order_detail_id", "share_cents")


#: The orders of each publication end before the next one's day.
ORDER_DAYS = ("1993-09-01", "1995-05-01", "1997-01-01")


@query
def first_order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First orders flagged by one state per user, over four publications in time order.

    The job stops after two publications and resumes; every batch reaches the sink twice.
    """
    path = workspace(spark, "first_order")
    records = views.order_records(spark, sf_dir)
    time = F.col("create_time")
    bounds = [None, *ORDER_DAYS, None]
    for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = records.where((time >= low if low else F.lit(True)) & (time < high if high else F.lit(True)))
        publish(writers.as_messages(part, "id"), ORDERS, f"{path}/topics", FILES)
        if k % 2:
            flagged = state.flag_first_orders(order_stream(spark, f"{path}/topics", max_files=FILES))
            jobs.drain(flagged, jobs.replayed(jobs.table_sink(f"{path}/orders")), f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/orders").select("id", "user_id", "if_first_order")


@query
def quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which every seventh record is cut short: read ones in a table, the rest set aside."""
    path = workspace(spark, "quarantine")
    messages = writers.as_messages(views.order_records(spark, sf_dir), "id")
    cut = F.concat(F.lit('{"id":'), F.col("key"))
    value = F.when(F.col("key").cast("bigint") % 7 == 0, cut).otherwise(F.col("value"))
    publish(messages.withColumn("value", value), ORDERS, f"{path}/topics")
    sink = jobs.set_aside(jobs.table_sink(f"{path}/orders"), f"{path}/aside", "orders")
    jobs.drain(order_stream(spark, f"{path}/topics", unread=True), jobs.replayed(sink), f"{path}/checkpoint")
    read = spark.read.parquet(f"{path}/orders").select(F.lit("order").alias("kind"), F.col("id").cast("string").alias("record"))
    aside = spark.read.parquet(f"{path}/aside").where(F.col("topic") == jobs.UNREAD)
    return read.unionByName(aside.select(F.lit("unread").alias("kind"), F.col("value").alias("record")))


@query
def online_recs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's latest rating as an event; the stored lists after all events."""
    path = workspace(spark, "online_recs")
    rated = views.ratings(spark, sf_dir)
    sims, members = _word_set_sims(spark, sf_dir)
    tables = {"ratings": rated, "sims": sims, "members": members}
    for name, df in tables.items():
        writers.write_overwrite(df, path=f"{path}/{name}")

    def lookups(session: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        rows = [readers.read_table(session, "", f"{path}/{name}") for name in tables]
        return rows[0], rows[1], rows[2]

    latest = ratings.recent_ratings(lookups(spark)[0], 1)
    publish(views.rating_messages(latest), "ratings", f"{path}/topics")
    events = online.parse_rating_events(
        readers.read_topic(spark, "ratings", "parquet", path=f"{path}/topics")
    )
    jobs.drain(events, jobs.online_recs_sink(f"{path}/recs", lookups), f"{path}/checkpoint")
    lists = explode_recs(writers.read_keyed(spark, f"{path}/recs"), "uid")
    return lists.select("uid", "mid", F.round("score", 6).alias("score"))


@query
def ads_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow in layers: change records, typed facts, wide lines, brand sums."""
    return layers(spark, sf_dir, jobs.drain)


def layers(spark: SparkSession, sf_dir: str, drain: Callable[[DataFrame, jobs.BatchSink, str], None]) -> DataFrame:
    """Brand sums of the flow; ``drain`` runs the job of every layer, and may crash and repeat it."""
    path = workspace(spark, "layers")
    topics = f"{path}/topics"
    changes = views.change_messages(views.order_records(spark, sf_dir), "order_info").unionByName(
        views.change_messages(views.detail_records(spark, sf_dir), "order_detail")
    )
    publish(changes, "db_changes", topics)

    # ODS: route change records by table
    routed = cdc.route_cdc_maxwell(readers.read_topic(spark, "db_changes", "parquet", path=topics))
    drain(routed, jobs.topic_sink(topics, "ods"), f"{path}/checkpoints/ods")

    # DWD: orders with flag, province and user; lines with their product
    def emit_orders(flagged: DataFrame, batch_id: int) -> None:
        session = flagged.sparkSession  # dimensions are read afresh for every batch
        people = dims.user_bands(views.users(session, sf_dir), views.AS_OF)
        rows = dims.with_user(dims.with_province(flagged, views.province(session, sf_dir)), people)
        messages = writers.as_messages(rows, "id").withColumn("topic", F.lit(ORDERS))
        writers.write_topic_once(messages, batch_id, topics, "dwd_orders")

    drain(
        order_stream(spark, topics, "ods_order_info", unread=True),
        jobs.set_aside(jobs.first_order_sink(f"{path}/status", emit_orders), topics, "dwd_orders"),
        f"{path}/checkpoints/dwd_orders",
    )

    def emit_details(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        product = dims.denormalize_sku(
            views.sku(session, sf_dir), views.category3(session, sf_dir),
            views.trademark(session, sf_dir), views.spu(session, sf_dir),
        ).select("id", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")
        messages = writers.as_messages(dims.with_sku(batch, product), "order_id")
        writers.write_topic_once(messages.withColumn("topic", F.lit(DETAILS)), batch_id, topics, "dwd_details")

    details = detail_stream(spark, topics, "ods_order_detail", unread=True)
    drain(details, jobs.set_aside(emit_details, topics, "dwd_details"), f"{path}/checkpoints/dwd_details")

    # DWS: join the two streams and allocate the paid amount
    enriched = schemas.extend(schemas.ORDER_DETAIL, "tm_id:string tm_name:string")
    lines = readers.parse_json(
        readers.read_topic(spark, DETAILS, "parquet", path=topics).select("value"), enriched
    )
    sink = jobs.allocate_sink(f"{path}/state", jobs.table_sink(f"{path}/wide"), ["order_detail_id"])
    both, sink = jobs.join_waiting(
        _heads(order_stream(spark, topics, ORDERS)), _lines(lines, "tm_id", "tm_name"), f"{path}/waiting", sink,
        parts=True,
    )
    drain(both, sink, f"{path}/checkpoints/dws")

    # ADS: brand sums per batch, written once
    stored = spark.read.parquet(f"{path}/wide")
    flow = spark.readStream.schema(stored.schema).parquet(f"{path}/wide").select("tm_id", "tm_name", "share_cents")
    stat = jobs.stat_sink(f"{path}/stat", ["tm_id", "tm_name"])
    drain(flow, stat, f"{path}/checkpoints/ads")
    sums = spark.read.parquet(f"{path}/stat").groupBy("tm_id", "tm_name")
    return sums.agg(F.sum("amount_cents").alias("amount_cents"))
