"""The registered batch queries: each takes (spark, sf_dir) and runs over the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import round_half_up_2
from ..operators import cdc, dau, dims, factorization, online, orders, paging, ratings, serving, similarity
from ..operators.relational import collect_recs, explode_recs
from ..operators.relational import word_count as count_words
from ..session import stored, tune, workspace
from ..sources import readers, writers
from . import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Each day with the day before and after it.
ORDER_DAY, ORDER_DAY_BEFORE, ORDER_DAY_AFTER = "1998-03-02", "1998-03-01", "1998-03-03"
LOG_DAY, LOG_DAY_BEFORE, LOG_DAY_AFTER = "2024-01-15", "2024-01-14", "2024-01-16"
STAT_FROM, STAT_TO = "1996-01-01", "1998-01-01"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


# ---- orders -----------------------------------------------------------------------------------


@query
def trademark_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best-selling brands of an interval, from raw orders to chart points."""
    info = views.order_info(spark, sf_dir, STAT_FROM, STAT_TO).where(F.col("create_date") > STAT_FROM)
    lines = views.allocated(spark, sf_dir, info, names=True)
    stat = orders.trademark_stat(lines, ["dt", "tm_id", "tm_name"]).select(
        F.col("dt").alias("stat_time"),
        F.col("tm_id").cast("bigint").alias("trademark_id"),
        F.col("tm_name").alias("trademark_name"),
        "amount_cents",
    )
    top = serving.trademark_top_n(stat, STAT_FROM, STAT_TO, 5)
    return top.select("x", round_half_up_2(F.col("y") / 100).alias("y"), "s")


@query
def order_wide_alloc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.allocated(spark, sf_dir).select(
        "order_id", "order_detail_id", "user_id", "sku_num", "detail_cents", "original_cents",
        "final_cents", "share_cents",
    )


@query
def order_wide_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full wide record: order, line, province, user, product, flag and allocated amount."""
    info = orders.first_order_flag(views.order_info(spark, sf_dir))
    heads = _with_users(spark, sf_dir, dims.with_province(info, views.province(spark, sf_dir)))
    lines = views.allocated(spark, sf_dir, heads, names=True, narrow=False)
    zero = F.lit(0).cast("bigint")
    return orders.to_order_wide(
        lines.withColumns(
            {
                # of one unit, half a cent up
                "price_cents": F.expr("(2 * detail_cents + sku_num) div (2 * nullif(sku_num, 0))"),
                "sku_name": F.concat_ws(" ", "category3_name", "spu_name"),
                "benefit_cents": zero,
                "freight_cents": zero,
            }
        )
    )


@query
def order_amount_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = views.order_info(spark, sf_dir, ORDER_DAY, ORDER_DAY_AFTER)
    return serving.order_amount_total(views.allocated(spark, sf_dir, info), ORDER_DAY)


@query
def order_amount_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = views.order_info(spark, sf_dir, ORDER_DAY, ORDER_DAY_AFTER)
    return serving.order_amount_hourly(views.allocated(spark, sf_dir, info), ORDER_DAY)


@query
def realtime_hour_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = views.order_info(spark, sf_dir, ORDER_DAY_BEFORE, ORDER_DAY_AFTER)
    return serving.realtime_hour(views.allocated(spark, sf_dir, info), "order_amount", ORDER_DAY)


@query
def province_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.allocated(spark, sf_dir)
    return serving.province_sales(dims.with_province(lines, views.province(spark, sf_dir)))


def _with_users(spark: SparkSession, sf_dir: str, info: DataFrame) -> DataFrame:
    return dims.with_user(info, dims.user_bands(views.users(spark, sf_dir), views.AS_OF))


@query
def buyer_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = views.order_info(spark, sf_dir, ORDER_DAY, ORDER_DAY_AFTER)
    rows = _with_users(spark, sf_dir, info)
    return serving.buyer_shares(rows.withColumn("dt", F.col("create_date")), ORDER_DAY)


@query
def sale_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of a day's lines whose product is a ring or a bolt."""
    info = views.order_info(spark, sf_dir, ORDER_DAY, ORDER_DAY_AFTER)
    lines = views.allocated(spark, sf_dir, info, names=True)
    rows = serving.sale_detail(lines, ORDER_DAY, "ring bolt", 3, 10, text_col="spu_name")
    return rows.select("order_id", "order_detail_id", "user_id", "spu_name", "tm_name", "share_cents")


@query
def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page far down the lines by price, read from the ranges that hold it."""
    lines = views.order_detail(spark, sf_dir).select("order_id", "sku_id", "detail_cents")
    pages = paging.prepare(lines, [F.desc("detail_cents"), F.asc("order_id"), F.asc("sku_id")])
    return pages.page(5_000, 25)


@query
def first_order_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with a fulfilled order before 1996 count as known."""
    known = views.order_info(spark, sf_dir, end="1996-01-01").where(F.col("order_status") == "F")
    later = views.order_info(spark, sf_dir, start="1996-01-01")
    flagged = orders.first_order_flag(later, orders.consumed_users(known))
    return flagged.select("id", "user_id", "create_date", "create_hour", "if_first_order")


@query
def order_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_users(spark, sf_dir, views.order_info(spark, sf_dir))
    rows = dims.with_province(rows, views.province(spark, sf_dir))
    return rows.select(
        "id", "user_id", "province_name", "province_area_code", "province_iso_code",
        "user_age_group", "user_gender",
    )


@query
def sku_denormalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.denormalize_sku(
        views.sku(spark, sf_dir),
        views.category3(spark, sf_dir),
        views.trademark(spark, sf_dir),
        views.spu(spark, sf_dir),
    )


@query
def order_detail_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the names of their SKU."""
    product = sku_denormalized(spark, sf_dir)
    rows = dims.with_sku(views.order_detail(spark, sf_dir), product, fill_unmatched_ids=0)
    return rows.select("order_id", "order_detail_id", "sku_id", "tm_name", "category3_name", "spu_name")


@query
def user_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.user_bands(views.users(spark, sf_dir), views.AS_OF)


# ---- traffic ----------------------------------------------------------------------------------


def _logs(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    return dau.with_day_hour(views.logs(spark, sf_dir, start, end))


@query
def dau_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dau.daily_first(_logs(spark, sf_dir)).select("mid", "dt", "hr", "ts")


@query
def dau_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = _logs(spark, sf_dir, LOG_DAY, LOG_DAY_AFTER)
    return dau.dau_total(dau.daily_first(day), LOG_DAY)


@query
def dau_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = _logs(spark, sf_dir, LOG_DAY, LOG_DAY_AFTER)
    return dau.dau_hourly(dau.daily_first(day), LOG_DAY)


@query
def dau_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily firsts kept in a dated index by two upserts, the second repeating the first's days."""
    path = workspace(spark, "dau_index")
    first = dau.daily_first(_logs(spark, sf_dir)).select("mid", "dt", "hr", "ts")
    early = first.where(F.col("dt") <= LOG_DAY)
    for part in (early, first):
        writers.upsert(part, path, ["mid"], partition="dt")
    return writers.read_keyed(spark, path)


@query
def realtime_hour_dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _logs(spark, sf_dir, LOG_DAY_BEFORE, LOG_DAY_AFTER)
    return serving.realtime_hour(dau.daily_first(days), "dau", LOG_DAY)


@query
def realtime_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a log day and of an order day; the scans stop at the day."""
    per_day = []
    for dt, after in ((LOG_DAY, LOG_DAY_AFTER), (ORDER_DAY, ORDER_DAY_AFTER)):
        known, day = _logs(spark, sf_dir, end=after), _logs(spark, sf_dir, dt, after)
        lines = views.allocated(spark, sf_dir, views.order_info(spark, sf_dir, dt, after))
        total = serving.realtime_total(known, dau.daily_first(day), lines, dt)
        per_day.append(total.withColumn("dt", F.lit(dt)))
    return reduce(DataFrame.unionByName, per_day)


@query
def route_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = cdc.route_logs(views.log_json(spark, sf_dir))
    record = readers.parse_json(routed, schemas.APP_LOG)
    return record.select(
        "topic", F.col("common.mid").alias("mid"), F.col("common.ch").alias("ch"), "ts",
        F.col("start").isNotNull().alias("is_start"),
    )


@query
def cdc_canal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.route_cdc_canal(views.cdc_canal(spark, sf_dir))


@query
def cdc_maxwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.route_cdc_maxwell(views.cdc_maxwell(spark, sf_dir))


# ---- ratings ----------------------------------------------------------------------------------


@query
def rating_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.rating_counts(views.ratings(spark, sf_dir))


@query
def rating_counts_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.rating_counts_by_month(views.ratings(spark, sf_dir))


@query
def average_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = ratings.average_scores(views.ratings(spark, sf_dir))
    return means.select("mid", F.round("avg", 6).alias("avg"))


@query
def tags_per_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.tags_per_item(views.tags(spark, sf_dir))


@query
def movies_with_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.movies_with_tags(views.movies(spark, sf_dir), views.tags(spark, sf_dir))


# The genre names of the test movies: their part types.
TEST_GENRES = ["Economy", "Small", "Standard", "Medium", "Large", "Promo"]


@query
def genre_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best per genre, nested into lists and back."""
    top = ratings.genre_top_n(
        views.movies(spark, sf_dir), views.ratings(spark, sf_dir), TEST_GENRES
    )
    nested = collect_recs(top, "genre", 10, score="avg")
    return explode_recs(nested, "genre").withColumn("avg", F.round("avg", 6))


@query
def recent_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.recent_ratings(views.ratings(spark, sf_dir))


def _word_set_sims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    members = views.word_set_members(spark, sf_dir)
    return similarity.sparse_pairs(similarity.word_set_vectors(members), 0.6), members


def _candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Candidates with the tables they come from; ratings and pairs are read several times, so
    they are computed once and stored."""
    rated = stored(views.ratings(spark, sf_dir), "ratings")
    sims, members = _word_set_sims(spark, sf_dir)
    sims = stored(sims, "sims")
    events = ratings.recent_ratings(rated, 1).select("uid", "mid")
    return online.top_unseen_similar(events, rated, sims, members), rated, sims, members


@query
def top_unseen_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _candidates(spark, sf_dir)[0]
    return found.select("uid", "mid", "rank", "candidate", F.round("score", 6).alias("score"))


@query
def rescore(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, rated, sims, members = _candidates(spark, sf_dir)
    scored = online.rescore(found, ratings.recent_ratings(rated), sims, members)
    return scored.withColumn("score", F.round("score", 6))


# ---- similarity and factorisation ---------------------------------------------------------------


@query
def content_similar_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF cosine above 0.6 between all distinct genre profiles."""
    vectors = similarity.tfidf_vectors(views.genre_members(spark, sf_dir))
    return similarity.sparse_pairs(vectors, 0.6).withColumn("score", F.round("score", 6))


@query
def content_similar_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most similar items of every item."""
    members = views.genre_members(spark, sf_dir)
    sims = similarity.sparse_pairs(similarity.tfidf_vectors(members), 0.6)
    top = similarity.similar_top_k(sims, members, 20)
    return top.withColumn("score", F.round("score", 6))


@query
def content_similar_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As content_similar_top with words hashed into 50 buckets."""
    hashed = factorization.hashed_tfidf(views.genre_members(spark, sf_dir))
    vectors, members = factorization.hashed_profiles(hashed)
    sims = similarity.dense_pairs(vectors, 0.6, shared=True)
    return similarity.similar_top_k(sims, members, 20)


@query
def similar_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = views.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("profile"), F.col("embedding").cast("array<double>").alias("vec")
    )
    found = similarity.dense_pairs(vectors, 0.3)
    return found.select(
        F.col("profile").alias("vec_id"), F.col("other_profile").alias("other_id"),
        F.round("score", 6).alias("score"),
    )


def _ratings_to_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(views.ratings(spark, sf_dir).select("uid", "mid", "score"), "als-ratings")


@query
def als_user_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = factorization.train_als(_ratings_to_train(spark, sf_dir))
    return factorization.user_recs(model, 20)


@query
def als_item_sims(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = factorization.train_als(_ratings_to_train(spark, sf_dir))
    return similarity.dense_pairs(factorization.item_vectors(model), 0.6).select(
        F.col("profile").alias("mid"), F.col("other_profile").alias("other_mid"), "score"
    )


@query
def als_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of the nine settings."""
    grid = factorization.grid_search_als(views.ratings(spark, sf_dir))
    return factorization.best_params(grid)


# ---- documents, text and tables -----------------------------------------------------------------


@query
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_words(views.table(spark, sf_dir, "documents"), "text")


@query
def doc_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page two of the documents with "the" or "and", longest first."""
    found = serving.search(
        views.docs(spark, sf_dir), "the and", None, [F.desc("doubanScore"), F.asc("id")], 10, 10
    )
    return found.select("id", "doubanScore", "highlighted")


@query
def doc_search_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with "the" and the actor "The", shortest first."""
    found = serving.search(
        views.docs(spark, sf_dir), "the", "The", [F.asc("doubanScore"), F.asc("id")], 0, 20
    )
    return found.select("id", "doubanScore")


@query
def get_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.get_by_id(views.docs(spark, sf_dir), 7).select("id", "name", "doubanScore")


@query
def nested_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as nested text and read back."""
    path = workspace(spark, "nested_text")
    part = views.table(spark, sf_dir, "part")
    line = F.concat_ws(
        ",",
        F.col("p_partkey").cast("string"),
        F.replace("p_name", F.lit(" "), F.lit("_")),
        F.concat(F.lit("size:"), F.col("p_size"), F.lit("_key:"), F.col("p_partkey")),
        F.concat_ws("_", "p_type", "p_brand"),
    )
    writers.write_text(part.select(line.alias("line")), path)
    rows = readers.read_nested_text(spark, path)
    return rows.select(
        "name",
        F.array_join("friends", "|").alias("friends"),
        F.element_at("children", "size").alias("size"),
        F.element_at("children", "key").alias("key"),
        "address.street",
        "address.city",
    )


@query
def table_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines bucketed by order id and joined without a shuffle."""
    path, tag = workspace(spark, "table_layout"), uuid.uuid4().hex[:8]
    heads, lines = f"heads_{tag}", f"lines_{tag}"
    writers.create_table(
        views.table(spark, sf_dir, "orders"), heads, f"{path}/heads",
        bucket_by=["o_orderkey"], sort_by=["o_orderkey"], comment="orders by key",
    )
    writers.create_table(
        views.table(spark, sf_dir, "lineitem"), lines, f"{path}/lines",
        partition_by=["l_returnflag"], bucket_by=["l_orderkey"], sort_by=["l_orderkey"],
    )
    joined = readers.read_table(spark, lines).join(
        readers.read_table(spark, heads), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.groupBy("l_returnflag", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders spread over many small files, compacted and read back."""
    path = workspace(spark, "compact_files")
    views.table(spark, sf_dir, "orders").repartition(40).write.parquet(f"{path}/small")
    writers.compact(spark, f"{path}/small", f"{path}/large")
    return spark.read.parquet(f"{path}/large").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders")
    )


@query
def load_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies as ``^`` text with padded and empty fields, read back."""
    path = workspace(spark, "load_movies")
    empty = {f.name: F.lit("") for f in schemas.MOVIE.fields if f.name not in ("mid", "name", "genres")}
    rows = views.movies(spark, sf_dir).withColumns(empty).withColumn("name", F.concat(F.lit(" "), "name", F.lit("  ")))
    writers.write_text(rows, path, schemas.MOVIE.names, "^")
    return readers.read_delimited(spark, path, schemas.MOVIE, "^").select(
        "mid", "name", "genres", F.col("directors").isNull().alias("no_directors")
    )


@query
def load_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "load_ratings")
    writers.write_text(views.ratings(spark, sf_dir), path, schemas.RATING.names)
    return readers.read_csv(spark, path, schemas.RATING)


@query
def load_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "load_tags")
    writers.write_text(views.tags(spark, sf_dir), path, schemas.TAG.names)
    return readers.read_csv(spark, path, schemas.TAG)


@query
def load_rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "load_rating_events")
    writers.write_text(views.ratings(spark, sf_dir), path, schemas.RATING.names, "|")
    return online.parse_rating_events(readers.read_lines(spark, path))


@query
def order_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published as JSON messages to a topic folder, read back and parsed."""
    path = workspace(spark, "order_json")
    rows = views.order_info(spark, sf_dir).select(
        "id", "province_id", "order_status", "user_id",
        (F.col("final_cents") / 100).alias("final_total_amount"), "create_time",
    )
    writers.write_topic(writers.as_messages(rows, "id"), "dwd_order_info", "parquet", path=path)
    stored = readers.read_table(spark, "", f"{path}/topic=dwd_order_info")
    parsed = readers.parse_json(stored, schemas.ORDER_INFO)
    return orders.with_create_date_hour(parsed).select(
        "id", "user_id", "final_total_amount", "create_date", "create_hour",
        F.col("_corrupt").isNull().alias("well_formed"),
    )


@query
def land_raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log lines landed per day and counted per day folder."""
    path = workspace(spark, "land_raw")
    lines = views.log_json(spark, sf_dir)
    day = dau.with_day_hour(lines.select("value", F.get_json_object("value", "$.ts").cast("bigint").alias("ts")))
    writers.land_raw(day, path)
    landed = spark.read.parquet(path)
    return landed.groupBy(F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n"))


@query
def user_status_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order per user, kept up to date by two overlapping upserts."""
    path = workspace(spark, "user_status")
    info = views.order_info(spark, sf_dir).select("user_id", "create_time", "id", "order_status")
    writers.upsert(info.where(F.col("create_time") < "1998-01-01"), path, ["user_id"], ["create_time", "id"])
    writers.upsert(info.where(F.col("create_time") > "1997-01-01"), path, ["user_id"], ["create_time", "id"])
    return writers.read_keyed(spark, path)


@query
def genre_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many movies carry each constant genre name."""
    names = readers.literal_rows(spark, TEST_GENRES, "genre")
    tokens = F.array_distinct(F.split(F.lower("genres"), r"\|"))
    types = views.movies(spark, sf_dir).select(F.explode(tokens).alias("t")).groupBy("t").count()
    return names.join(types, F.lower("genre") == F.col("t"), "left").select(
        "genre", F.coalesce("count", F.lit(0)).alias("n")
    )
