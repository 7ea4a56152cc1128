"""Sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import PACKED, shuffles_dropped
from . import keyed
from .readers import read_small_files


def write_overwrite(df: DataFrame, name: str | None = None, path: str | None = None) -> None:
    """Replace a result table or folder."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    with shuffles_dropped(df.sparkSession):
        if path:
            writer.parquet(path)
        else:
            writer.saveAsTable(name)


def write_text(df: DataFrame, path: str, cols: list[str] | None = None, sep: str = ",") -> None:
    """Rows as text lines, columns joined by the separator; nulls become empty fields."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols or df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.mode("overwrite").text(path)


def land_raw(df: DataFrame, path: str, dt_col: str = "dt", value: str = "value") -> None:
    """Append raw records under one folder per day."""
    df.select(value, dt_col).write.mode("append").partitionBy(dt_col).parquet(path)


# ---- keyed tables -----------------------------------------------------------------------------


def read_keyed(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table that ``upsert`` or ``replace_by_key`` wrote; with a schema, empty before its first write."""
    return keyed.read(spark, path, schema)


def upsert(
    df: DataFrame,
    path: str,
    keys: list[str],
    version: list[str] | None = None,
    partition: str | None = None,
    keep: Column | None = None,
    batch: tuple[str, int] | None = None,
    fan_in: int = keyed.FAN_IN,
) -> None:
    """Insert or replace rows by key; repeating a write changes nothing.

    With ``partition`` (such as dt) a key is unique per partition, like in a dated index.  ``version``
    columns decide between rows of the same key; without them the later write wins.  Stored rows that
    fail ``keep`` (expired state) are dropped when segments are merged.  A ``batch`` (job, number) is
    written once.
    """
    all_keys = [*keys, partition] if partition else keys
    keyed.write(df, path, all_keys, version, False, partition, batch, keep, fan_in)


def replace_by_key(
    df: DataFrame, path: str, key: str, batch: tuple[str, int] | None = None, fan_in: int = keyed.FAN_IN
) -> None:
    """Replace all stored rows of the batch's keys by the batch's rows."""
    keyed.write(df, path, [key], None, True, None, batch, None, fan_in)


# ---- batches, topics, stores ------------------------------------------------------------------


def _once(spark: SparkSession, path: str, name: str, write: Callable[[str], None]) -> bool:
    """Publish a batch as the folder ``path``/``name``, unless it is there; says whether it wrote.

    ``write`` fills a staged folder, which readers and file streams do not see; the rename that
    publishes it is the record of the batch as well.  So no crash can leave data without its record: before
    the rename there is neither, after it a replay writes nothing and the next layer sees no new files.
    """
    if keyed.exists(spark, f"{path}/{name}"):
        return False
    staged = f"{path}/_staging/{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        write(staged)
    keyed.publish(spark, staged, f"{path}/{name}")
    return True


def write_topic_once(messages: DataFrame, batch_id: int, path: str, job: str = "batch") -> bool:
    """Folder form of ``write_topic`` for a micro-batch with a ``topic`` column, written once per batch.

    Jobs that share a path need names of their own.
    """
    rows = messages if "key" in messages.columns else messages.withColumn("key", F.lit(None).cast("string"))
    out = rows.select("key", "value", "topic")
    return _once(
        messages.sparkSession, path, f"batch={job}-{batch_id}",
        lambda staged: out.write.options(**PACKED).partitionBy("topic").parquet(staged),
    )


def write_once(df: DataFrame, path: str, name: str) -> bool:
    """Write rows as the folder ``path``/``name``, unless it is there."""
    return _once(df.sparkSession, path, name, lambda staged: df.write.options(**PACKED).parquet(staged))


def write_batch_once(df: DataFrame, batch_id: int, path: str) -> bool:
    """Write a micro-batch's result under its own batch folder, once per batch."""
    return write_once(df, path, f"batch_id={batch_id}")


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    batchsize: int = 100,
    num_partitions: int = 4,
    options: dict[str, str] | None = None,
) -> None:
    """Append over JDBC without transaction isolation; at most num_partitions connections."""
    writer = (
        df.write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batchsize)
        .option("isolationLevel", "NONE")
        .option("numPartitions", num_partitions)
    )
    for name, value in (options or {}).items():
        writer = writer.option(name, value)
    writer.save()


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """(key, value): each row as JSON text, null fields left out."""
    key_col = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    return df.select(key_col.alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_topic(
    messages: DataFrame,
    topic: str | None = None,
    fmt: str = "kafka",
    servers: str | None = None,
    path: str | None = None,
    mode: str = "append",
) -> None:
    """Publish (key, value) rows, to one topic or to the topic named in a ``topic`` column.

    The folder form writes one sub-folder per topic without a shuffle.
    """
    rows = messages if topic is None else messages.withColumn("topic", F.lit(topic))
    if "key" not in rows.columns:
        rows = rows.withColumn("key", F.lit(None).cast("string"))
    rows = rows.select("topic", "key", "value")
    if fmt == "kafka":
        (
            rows.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("kafka.enable.idempotence", "true")
            .save()
        )
    else:
        with shuffles_dropped(rows.sparkSession):
            rows.write.options(**PACKED).mode(mode).partitionBy("topic").parquet(path)


def create_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    partition_by: list[str] | None = None,
    bucket_by: list[str] | None = None,
    n_buckets: int = 8,
    sort_by: list[str] | None = None,
    comment: str | None = None,
    column_comments: dict[str, str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Create a table from a query: partitioned, bucketed and sorted; external with a path."""
    for col, text in (column_comments or {}).items():
        df = df.withColumn(col, F.col(col).alias(col, metadata={"comment": text}))
    database = name.split(".")[0] if "." in name else None
    if database:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    writer = df.write.mode("overwrite").format(fmt)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(n_buckets, *bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(name)
    if comment:
        text = comment.replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{text}'")


def compact(
    spark: SparkSession, source: str, target: str, target_bytes: int = 128 * 1024 * 1024,
    fmt: str = "parquet",
) -> None:
    """Rewrite many small files as files of about target_bytes, without a shuffle."""
    read_small_files(spark, source, target_bytes, fmt).write.mode("overwrite").format(fmt).save(target)
