"""Deep pages of an ordered result.

The result is written once, range-partitioned by its order, with the number of rows of every range.  A page
then knows from the sums of those numbers which ranges hold it and reads nothing else, however large its
offset is; only the rows of these ranges are sorted.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import workspace

_RANGE = "_range"


@dataclass
class Pages:
    spark: SparkSession
    path: str
    schema: T.StructType
    order: list[Column]
    #: (range, rows before its end), for the ranges that have rows
    ends: list[tuple[int, int]]

    @property
    def rows(self) -> int:
        return self.ends[-1][1] if self.ends else 0

    def page(self, offset: int, size: int) -> DataFrame:
        """Rows offset .. offset + size of the ordered result; fewer at its end, none beyond it."""
        sums = [end for _, end in self.ends]
        first, last = bisect_right(sums, offset), bisect_right(sums, offset + size - 1)
        chosen = [r for r, _ in self.ends[first : last + 1]] if size > 0 else []
        table = T.StructType([*self.schema.fields, T.StructField(_RANGE, T.IntegerType())])
        stored = self.spark.read.schema(table).parquet(self.path)
        rows = stored.where(F.col(_RANGE).isin(chosen) if chosen else F.lit(False)).drop(_RANGE)
        before = sums[first - 1] if first else 0
        # the offset that is left is smaller than a range
        return rows.orderBy(*self.order).offset(offset - before).limit(size)


def prepare(df: DataFrame, order: list[Column], ranges: int | None = None) -> Pages:
    """Lay df out for ``Pages.page``; one shuffle.  ``order`` should tell all rows apart that a user can
    tell apart; rows that are equal in it stay in one range.  ``ranges`` is the number of partitions, by
    default that of a shuffle; only one number per range comes to the driver."""
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = workspace(spark, "pages")
    dealt = df.repartitionByRange(n, *order).withColumn(_RANGE, F.spark_partition_id())
    dealt.write.partitionBy(_RANGE).parquet(path)
    table = T.StructType([*df.schema.fields, T.StructField(_RANGE, T.IntegerType())])
    counts = spark.read.schema(table).parquet(path).groupBy(_RANGE).count().orderBy(_RANGE).collect()
    sums = accumulate(r["count"] for r in counts)
    return Pages(spark, path, df.schema, order, [(r[_RANGE], s) for r, s in zip(counts, sums)])
