"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on.  Shuffle width is left to the cluster: the adaptive
# planner merges small partitions and splits skewed ones, also where the split costs one more
# shuffle further up the plan.  It starts from many partitions, as it never splits others: what a task
# sorts is bound by the size of a partition and not by the input over the cores.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Bytes of a shuffled partition and of a piece of a file, where the session allows more.
AT_MOST = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 * 2**20,
    "spark.sql.files.maxPartitionBytes": 16 * 2**20,
}

# On a cluster only: streaming state off the heap and wide shuffles to merge from.
CLUSTER_CONF = {
    # adaptive merging lowers the shuffle width but never raises it
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else made."""
    local = spark.sparkContext.master.startswith("local")
    for key, value in (RUNTIME_CONF if local else {**RUNTIME_CONF, **CLUSTER_CONF}).items():
        spark.conf.set(key, value)
    for key, most in AT_MOST.items():
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    if local and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        # the default width is far too wide for one machine, above all for streaming state
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and intermediate tables.

    The parent is the folder the cluster names in ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """For a write: its shuffle files are deleted with its end, not when the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


#: Compression of topics, staged batches and stored tables: their texts and ids take a good deal less space than with
#: the default, for somewhat more work.
PACKED = {"compression": "zstd"}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result that is read several times to the workspace and read it back."""
    spark, path = df.sparkSession, workspace(df.sparkSession, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
