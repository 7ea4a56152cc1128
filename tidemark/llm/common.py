"""Column helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(module: str) -> None:
    """Send the functions of a module to executors by value, so they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """ASCII letters in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once per row however often body uses it."""
    return F.transform(F.array(value), body)[0]


def from_zero(count: Column, step: int = 1) -> Column:
    """0, step, 2 * step ... below count; empty if count is not positive."""
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"), F.lit(step))).otherwise(
        F.array().cast("array<int>")
    )


def shingle_hashes(tokens: Column, k: int) -> Column:
    """64-bit hashes of the k-word shingles of an array column, in order, repeats kept."""
    return F.transform(
        from_zero(F.size(tokens) - (k - 1)),
        lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(k)]),
    )


def packets(docs: DataFrame, target_bytes: int, text: str = "text") -> int:
    """How many packets of about target_bytes of text the documents make; reads one column once."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    return max(1, -(-int(total) // target_bytes))


def with_doc(df: DataFrame, rest: str) -> StructType:
    """Schema of ``doc`` as df has it, null or not, and of the fields in ``rest``."""
    return StructType([StructField("doc", df.schema["doc"].dataType), *StructType.fromDDL(rest).fields])
