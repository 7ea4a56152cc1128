"""The warehouse and recommender records, derived from the test tables.

Amounts are integer cents.  The allocation needs a numeric line order, so ``order_detail_id`` is
built from the line number and the part; lines that still tie are ordered by LINE_ORDER.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import to_cents
from ..operators import dims, orders, similarity, skew
from ..operators.relational import keep_last

AS_OF = "2024-01-01"
LINE_ORDER = [
    "order_detail_id", "l_suppkey", "sku_num", "detail_cents", "l_discount", "l_tax", "l_shipdate",
    "l_returnflag", "l_linestatus",
]


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is inferred once per path, not once per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def between(df: DataFrame, ts_col: str, start: str | None, end: str | None) -> DataFrame:
    """Rows with start <= ts < end; compared on the stored column, so that the scan can skip."""
    if start:
        df = df.where(F.col(ts_col) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        df = df.where(F.col(ts_col) < F.lit(end).cast("timestamp_ntz"))
    return df


def order_info(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """One row per order with its customer's province; create_time has a derived hour."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("province_id")
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    hour = F.lpad(((F.col("o_orderkey") * 7919) % 24).cast("string"), 2, "0")
    base = between(table(spark, sf_dir, "orders"), "o_orderdate", start, end).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        to_cents(F.col("o_totalprice")).alias("final_cents"),
        F.concat(day, F.lit(" "), hour, F.lit(":00:00")).alias("create_time"),
    )
    return orders.with_create_date_hour(base.join(customer, "user_id"))


def sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU rows; ids are strings as in the dimension store."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.md5("p_name").alias("spu_id"),
        to_cents(F.col("p_retailprice")).alias("price_cents"),
        F.concat_ws(" ", "p_type", "p_name").alias("sku_name"),
        F.substring_index("p_brand", "#", -1).alias("tm_id"),
        F.md5("p_type").alias("category3_id"),
    )


def trademark(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("tm_name")).distinct()
    return brands.select(F.substring_index("tm_name", "#", -1).alias("tm_id"), "tm_name")


def category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_type").alias("name")).distinct()
    return names.select(F.md5("name").alias("id"), "name")


def spu(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("spu_name")).distinct()
    return names.select(F.md5("spu_name").alias("id"), "spu_name")


def province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("A"), F.col("n_regionkey")).alias("area_code"),
        F.concat(F.lit("ISO-"), F.col("n_nationkey")).alias("iso_code"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.date_format(born, "yyyy-MM-dd").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
    )


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber").cast("bigint") * 1_000_000_000_000 + F.col("l_partkey")).alias(
            "order_detail_id"
        ),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        to_cents(F.col("l_extendedprice")).alias("detail_cents"),
        "l_suppkey", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus",
    )


def order_totals(details: DataFrame) -> DataFrame:
    """Sum of each order's lines."""
    return details.groupBy("order_id").agg(F.sum("detail_cents").alias("original_cents"))


def allocated(
    spark: SparkSession, sf_dir: str, order_rows: DataFrame | None = None, names: bool = False, narrow: bool = True
) -> DataFrame:
    """Order lines with their order and the allocated amount.

    ``order_rows`` narrows the orders first (a day, say), and with them the lines; ``narrow=False`` says that it holds
    all orders, so that narrowing the lines by them would only shuffle both once more.  The lines are shuffled
    once, to their order; totals and running sums are windows over that.  Orders that a sketch of the
    order ids finds hot take more than one task.  ``names`` adds the product columns, after the allocation.
    """
    info = order_info(spark, sf_dir) if order_rows is None else order_rows
    info = info.withColumnRenamed("id", "order_id")
    lines = order_detail(spark, sf_dir)
    if order_rows is not None and narrow:
        lines = lines.join(info.select("order_id"), "order_id", "left_semi")
    wide = orders.with_totals(orders.order_wide(info, lines), LINE_ORDER)
    done = orders.allocate_paid_amount(wide, LINE_ORDER).withColumn("dt", F.col("create_date"))
    if names:
        product = dims.denormalize_sku(
            sku(spark, sf_dir), category3(spark, sf_dir), trademark(spark, sf_dir), spu(spark, sf_dir)
        )
        done = dims.with_sku(done, product.select(
            "id", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"
        ))
    return done


def on_days(info: DataFrame, *days: str) -> DataFrame:
    return info.where(F.col("create_date").isin(*days))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, mid, score, timestamp): a user's latest line of each part is its rating."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    rows = lines.select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
    last = keep_last(rows, ["uid", "mid"], order)
    return last.select(
        "uid",
        "mid",
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("score"),
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, name, genres): a part's type and name words are its genres."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws("|", "p_type", F.replace("p_name", F.lit(" "), F.lit("|"))).alias("genres"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
    heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        F.concat_ws("-", "l_returnflag", "o_orderpriority").alias("tag"),
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("int").alias("timestamp"),
    )


def genre_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, profile) by genre words."""
    items = movies(spark, sf_dir)
    return similarity.word_members(items, similarity.genre_words(F.col("genres")))


def word_set_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, profile) by distinct genre words."""
    items = movies(spark, sf_dir)
    return similarity.word_members(items, F.array_distinct(similarity.genre_words(F.col("genres"))))


def logs(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """(mid, ts epoch ms, ch) application log records."""
    return between(table(spark, sf_dir, "events"), "ts", start, end).select(
        F.col("user_id").cast("string").alias("mid"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.col("event_type").alias("ch"),
    )


def log_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records as JSON text; ``start`` is present on view events only."""
    rows = logs(spark, sf_dir)
    start = F.when(F.col("ch") == "view", F.struct(F.lit("icon").alias("entry")))
    common = F.struct("mid", F.col("mid").alias("uid"), F.lit("A1").alias("ar"), "ch", F.lit("v1").alias("vc"))
    return rows.select(
        F.to_json(F.struct(common.alias("common"), start.alias("start"), "ts")).alias("value")
    )


def _envelopes(rows: DataFrame, key: str, name: str, types: list[str], data) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, types)), (F.col(key) % 3 + 1).cast("int"))
    return rows.select(
        F.to_json(F.struct(kind.alias("type"), F.lit(name).alias("table"), data.alias("data"))).alias("value")
    )


def cdc_maxwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records with one row object each; kind cycles insert, update, delete by key."""
    types = ["insert", "update", "delete"]
    spec = {
        "order_info": ("orders", "o_orderkey", {"id": "o_orderkey", "user_id": "o_custkey", "order_status": "o_orderstatus"}),
        "order_detail": ("lineitem", "l_orderkey", {"order_id": "l_orderkey", "sku_id": "l_partkey", "line": "l_linenumber"}),
        "base_province": ("nation", "n_nationkey", {"id": "n_nationkey", "name": "n_name"}),
        "sku_info": ("part", "p_partkey", {"id": "p_partkey", "sku_name": "p_name"}),
        "favor_info": ("supplier", "s_suppkey", {"id": "s_suppkey", "name": "s_name"}),
    }
    out = None
    for name, (source, key, fields) in spec.items():
        data = F.struct(*[F.col(c).alias(n) for n, c in fields.items()])
        rows = _envelopes(table(spark, sf_dir, source), key, name, types, data)
        out = rows if out is None else out.unionByName(rows)
    return out


def cdc_canal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records with an array of row objects: an order before and after it is closed."""
    types = ["INSERT", "UPDATE", "DELETE"]

    def row(status):
        return F.struct(F.col("o_orderkey").alias("id"), status.alias("order_status"))

    data = F.array(row(F.col("o_orderstatus")), row(F.lit("CLOSED")))
    heads = _envelopes(table(spark, sf_dir, "orders"), "o_orderkey", "order_info", types, data)
    one = F.array(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))
    others = _envelopes(table(spark, sf_dir, "supplier"), "s_suppkey", "favor_info", types, one)
    return heads.unionByName(others)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search documents: the text is the name, its words are the actors."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    actors = F.transform(
        words, lambda w, i: F.struct((i + 1).cast("bigint").alias("id"), w.alias("name"))
    )
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("name"),
        F.col("n_chars").cast("double").alias("doubanScore"),
        actors.alias("actorList"),
    )


# ---- messages of the order flow -------------------------------------------------------------------


def _line_hash() -> Column:
    """A line id that is unique also where (order, line number) repeats: 60 bits of a digest."""
    text = F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("bigint"), to_cents(F.col("l_extendedprice")),
        to_cents(F.col("l_discount")), to_cents(F.col("l_tax")),
        F.date_format("l_shipdate", "yyyy-MM-dd"), "l_returnflag", "l_linestatus",
    )
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as order_info records; an order without lines has the total 0."""
    totals = order_totals(order_detail(spark, sf_dir)).select(F.col("order_id").alias("id"), "original_cents")
    rows = order_info(spark, sf_dir).join(totals, "id", "left").fillna(0, ["original_cents"])
    return rows.select(
        "id", "province_id", "order_status", "user_id",
        (F.col("final_cents") / 100).alias("final_total_amount"),
        F.lit(0.0).alias("benefit_reduce_amount"),
        (F.col("original_cents") / 100).alias("original_total_amount"),
        F.lit(0.0).alias("feight_fee"),
        "create_time",
    )


def detail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as order_detail records; the line amount is the price of one unit."""
    times = order_info(spark, sf_dir).select(F.col("id").alias("order_id"), "create_time")
    lines = table(spark, sf_dir, "lineitem").select(
        _line_hash().alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.lit(1).cast("bigint").alias("sku_num"),
    )
    return lines.join(times, "order_id")


def change_messages(rows: DataFrame, name: str) -> DataFrame:
    """Insert records of one table as object-payload change messages."""
    return rows.select(
        F.to_json(F.struct(F.lit("insert").alias("type"), F.lit(name).alias("table"),
                           F.struct("*").alias("data"))).alias("value")
    )


def rating_messages(rated: DataFrame) -> DataFrame:
    return rated.select(F.concat_ws("|", "uid", "mid", "score", "timestamp").alias("value"))
