"""Batch and stream sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import trimmed
from .keyed import file_system

# What a topic looks like to a reader, whether it comes from a broker or from a folder.
TOPIC_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, trim: bool = True
) -> DataFrame:
    """Delimited text to typed rows.  Empty and missing fields are null, also at the line end."""
    quoted = "".join(c if c.isalnum() else "\\" + c for c in sep)
    parts = F.split("value", quoted, -1)

    def field(i: int, f: T.StructField) -> Column:
        raw = F.get(parts, F.lit(i))
        text = trimmed(raw) if trim else raw
        return text.try_cast(f.dataType).alias(f.name)

    return spark.read.text(path).select(*[field(i, f) for i, f in enumerate(schema.fields)])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Comma-separated rows without a header."""
    return spark.read.csv(path, schema=schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain lines in ``value`` with the file they come from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))


def read_nested_text(
    spark: SparkSession, path: str, field_sep: str = ",", item_sep: str = "_", kv_sep: str = ":"
) -> DataFrame:
    """name, friends: array, children: map<string,int>, address: struct<street,city>."""
    f, i = ("".join(c if c.isalnum() else "\\" + c for c in s) for s in (field_sep, item_sep))
    parts = F.split("value", f, -1)
    children = F.str_to_map(F.get(parts, F.lit(2)), F.lit(i), F.lit(kv_sep))
    address = F.split(F.get(parts, F.lit(3)), i, -1)
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("name"),
        F.split(F.get(parts, F.lit(1)), i, -1).alias("friends"),
        F.transform_values(children, lambda _, v: v.try_cast("int")).alias("children"),
        F.struct(
            F.get(address, F.lit(0)).alias("street"), F.get(address, F.lit(1)).alias("city")
        ).alias("address"),
    )


def read_table(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A stored table by name, or a parquet folder by path."""
    return spark.read.parquet(path) if path else spark.read.table(name)


def parse_json(
    df: DataFrame, schema: T.StructType, col: str = "value", corrupt: str = "_corrupt"
) -> DataFrame:
    """JSON text to the schema's columns; the text of an unreadable record goes to ``_corrupt``.

    Unpacked by a generator: a filter on the parsed columns is not pushed below it, where it would
    parse every record a second time.
    """
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(col, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.inline(F.array(parsed)))


def read_topic(
    spark: SparkSession,
    topic: str,
    fmt: str = "kafka",
    servers: str | None = None,
    starting: str = "latest",
    path: str | None = None,
    max_files: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stream of (key, value) text from a topic.

    ``kafka`` reads a broker; ``starting`` is latest, earliest or a JSON of offsets, and only
    counts until the query's checkpoint exists.  ``parquet`` reads the topic's folders below ``path``, as
    ``write_topic`` and ``write_topic_once`` leave them, at most ``max_files`` files per batch, oldest first.
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
        )
        for name, value in (options or {}).items():
            reader = reader.option(name, value)
        return reader.load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
        )
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(_topic_folders(topic, path))


def _topic_folders(topic: str, path: str) -> str:
    return f"{path}/{{topic={topic},batch=*/topic={topic}}}"


def topic_so_far(spark: SparkSession, topic: str, path: str) -> DataFrame:
    """The records that the folder form of a topic holds now, as a table; none if there is no such topic."""
    folders = _topic_folders(topic, path)
    fs, where = file_system(spark, folders)
    if not fs.globStatus(where):
        return spark.createDataFrame([], TOPIC_SCHEMA)
    return spark.read.schema(TOPIC_SCHEMA).parquet(folders)


def read_query(
    spark: SparkSession, url: str, query: str, options: dict[str, str] | None = None
) -> DataFrame:
    """Result of a query that a JDBC store runs; column names resolve in any case."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return reader.load()


def small_file_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A sibling session whose scans pack whole small files into splits of target_bytes."""
    sibling = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        sibling.conf.set(key, spark.conf.get(key))
    sibling.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    sibling.conf.set("spark.sql.files.openCostInBytes", "0")
    # without this the scan would aim at one split per core instead
    sibling.conf.set("spark.sql.files.minPartitionNum", "1")
    return sibling


def read_small_files(
    spark: SparkSession, path: str, target_bytes: int = 4 * 1024 * 1024, fmt: str = "parquet"
) -> DataFrame:
    """Read many small files with one task per target_bytes of input."""
    return small_file_session(spark, target_bytes).read.format(fmt).load(path)


def literal_rows(spark: SparkSession, values: list[str], name: str) -> DataFrame:
    """A constant list as a one-column relation."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(name))
