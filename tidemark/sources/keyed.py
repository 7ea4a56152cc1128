"""Keyed tables, merged when they are read.

A write stores its own rows as a new segment and then publishes a manifest that lists the live segments
and, per job, the last batch that was written.  The manifest is one small file that appears by a rename,
so a reader sees the table before or after a write and a crash in between leaves the old version; the
segment that it left behind is in no manifest.  What a write costs follows its batch: eight segments of a
level are merged to one of the next level, so a row is rewritten once per level.

Readers keep the newest row of a key: by the version columns of the table, then by the number of the
write.  One writer at a time; a second one fails when it publishes the same version.  The file system
has to rename atomically, as HDFS does.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import PACKED, shuffles_dropped

_SEQ = "_seq"
FAN_IN = 8


# ---- files ------------------------------------------------------------------------------------


def file_system(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them; the driver touches names and manifests only."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Make what lies staged appear as target, at once; target must not exist."""
    fs, source = file_system(spark, staged)
    _, to = file_system(spark, target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(source, to):
        raise FileExistsError(f"{target} was published by another writer")


def bytes_below(spark: SparkSession, path: str) -> int:
    fs, where = file_system(spark, path)
    return fs.getContentSummary(where).getLength()


# ---- manifests ----------------------------------------------------------------------------------


@dataclass
class Segment:
    name: str
    level: int


@dataclass
class Manifest:
    """One version of a table."""

    version: int
    schema: str
    keys: list[str]
    order: list[str]
    #: every write replaces all rows of its keys, instead of one row per key
    replaces: bool
    segments: list[Segment] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, where = file_system(spark, f"{path}/_versions")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """A version of the table, by default the newest; None if there is none."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    fs, where = file_system(spark, f"{path}/_versions/{version:012d}.json")
    stream = fs.open(where)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(**{**found, "segments": [Segment(**s) for s in found["segments"]]})


def _commit(spark: SparkSession, path: str, new: Manifest) -> None:
    staged = f"{path}/_versions/_{uuid.uuid4().hex}"
    fs, where = file_system(spark, staged)
    out = fs.create(where, True)
    try:
        out.write(bytearray(json.dumps(asdict(new)), "utf-8"))
    finally:
        out.close()
    publish(spark, staged, f"{path}/_versions/{new.version:012d}.json")


# ---- reading and merging ------------------------------------------------------------------------


def _rows(spark: SparkSession, path: str, of: Manifest, segments: list[Segment]) -> DataFrame:
    schema = T.StructType([*of.columns.fields, T.StructField(_SEQ, T.LongType())])
    found = spark.read.option("basePath", f"{path}/segments").schema(schema)
    return found.parquet(*[f"{path}/segments/{s.name}" for s in segments]).select(*schema.names)


def _merged(rows: DataFrame, of: Manifest) -> DataFrame:
    """The rows that win among those of the same key, with the number of their write."""
    if of.replaces:
        last = rows.groupBy(*of.keys).agg(F.max(_SEQ).alias("_last"))
        same = F.col(_SEQ) == F.col("_last")
        for k in of.keys:
            same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}"))
        return rows.alias("r").join(last.alias("l"), same).select("r.*")
    rest = [c for c in of.columns.names if c not in of.keys and c not in of.order]
    best = rows.groupBy(*of.keys).agg(F.max(F.struct(*of.order, _SEQ, *rest)).alias("_row"))
    return best.select(*of.keys, "_row.*").select(*of.columns.names, _SEQ)


def read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The table as it stands; before its first write an empty one if a schema is given."""
    at = manifest(spark, path)
    if at is None:
        return spark.read.parquet(f"{path}/segments") if schema is None else spark.createDataFrame([], schema)
    rows = _rows(spark, path, at, at.segments)
    return (rows if len(at.segments) == 1 else _merged(rows, at)).drop(_SEQ)


# ---- writing --------------------------------------------------------------------------------------


def _write_segment(rows: DataFrame, path: str, partition: str | None) -> str:
    name = f"segment={uuid.uuid4().hex}"
    writer = (rows.hint("rebalance", partition) if partition else rows).write.options(**PACKED)
    with shuffles_dropped(rows.sparkSession):
        (writer.partitionBy(partition) if partition else writer).parquet(f"{path}/segments/{name}")
    return name


def write(
    df: DataFrame,
    path: str,
    keys: list[str],
    order: list[str] | None = None,
    replaces: bool = False,
    partition: str | None = None,
    batch: tuple[str, int] | None = None,
    keep: Column | None = None,
    fan_in: int = FAN_IN,
) -> None:
    """Store the rows of df and publish them.

    ``batch`` (job, number) is kept in the manifest; a batch that is not newer than the last one of its
    job writes nothing.  Without ``order`` the table keeps its own.  ``keep`` is applied when all
    segments are merged: rows that fail it go.
    """
    spark = df.sparkSession
    at = manifest(spark, path)
    if at is None:
        at = Manifest(0, df.schema.json(), keys, order or [], replaces)
    if batch and at.batches.get(batch[0], -1) >= batch[1]:
        return
    if order is not None and order != at.order:
        # what is stored was decided by the former order
        merge_level(spark, path, partition, fan_in=1)
        at = manifest(spark, path)
        at.order = order
    number = at.version + 1
    stamped = df.select(*at.columns.names).withColumn(_SEQ, F.lit(number).cast("long"))
    name = _write_segment(stamped if replaces else _merged(stamped, at), path, partition)
    batches = {**at.batches, **({batch[0]: batch[1]} if batch else {})}
    new = Manifest(number, at.schema, at.keys, at.order, at.replaces, [*at.segments, Segment(name, 0)], batches)
    _commit(spark, path, new)
    merge_level(spark, path, partition, keep, fan_in)


def merge_level(
    spark: SparkSession, path: str, partition: str | None = None, keep: Column | None = None, fan_in: int = FAN_IN
) -> bool:
    """Merge the segments of the lowest level that has ``fan_in`` of them; says whether there was one.

    Safe to run beside readers: the segments it replaces stay until the version after the next.
    """
    at = manifest(spark, path)
    for level in sorted({s.level for s in at.segments}):
        old = [s for s in at.segments if s.level == level]
        if len(old) < max(2, fan_in) and not (fan_in == 1 and len(at.segments) > 1):
            continue
        if fan_in == 1:
            old = at.segments
        rows = _merged(_rows(spark, path, at, old), at)
        if keep is not None and len(old) == len(at.segments):
            rows = rows.where(keep)
        name = _write_segment(rows, path, partition)
        live = [s for s in at.segments if s not in old]
        _commit(
            spark, path,
            Manifest(at.version + 1, at.schema, at.keys, at.order, at.replaces, [Segment(name, level + 1), *live], at.batches),
        )
        _drop_unused(spark, path)
        return True
    return False


def _drop_unused(spark: SparkSession, path: str, keep_versions: int = 3) -> None:
    """Delete manifests but the last ones, and the segments that only those named."""
    known = versions(spark, path)
    old, live = known[:-keep_versions], known[-keep_versions:]
    if not old:
        return
    used = {s.name for v in live for s in manifest(spark, path, v).segments}
    gone = {s.name for v in old for s in manifest(spark, path, v).segments} - used
    for name in [f"segments/{s}" for s in sorted(gone)] + [f"_versions/{v:012d}.json" for v in old]:
        fs, where = file_system(spark, f"{path}/{name}")
        fs.delete(where, True)
