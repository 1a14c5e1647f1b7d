"""Joins that Spark has no operator for, as plans of its own operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """Each left row with the values of the last right row of its key at or before its time: one sort by key and time, no pairs.

    Of right rows with equal key and time, the largest values count. Right rows whose key or time is null match nothing.
    """
    r = right.where(F.col(by).isNotNull() & F.col(right_time).isNotNull()).groupBy(by, right_time).agg(F.max(F.struct(*values)).alias("_v"))
    rows = r.select(by, F.col(right_time).alias("_t"), "_v", F.lit(None).alias("_row")).unionByName(
        left.select(by, F.col(left_time).alias("_t"), F.lit(None).cast(r.schema["_v"].dataType).alias("_v"), F.struct(*left.columns).alias("_row")), allowMissingColumns=True
    )
    order = Window.partitionBy(by).orderBy(F.col("_t").asc_nulls_first(), F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    last = F.when(F.col("_t").isNotNull() & F.col(by).isNotNull(), F.last("_v", ignorenulls=True).over(order))
    return rows.withColumn("_m", last).where("_row is not null").select("_row.*", *[F.col("_m")[v].alias(v) for v in values])


def range_join(left: DataFrame, right: DataFrame, point: str, start: str, end: str) -> DataFrame:
    """Pairs with start <= point < end.

    An interval is dealt to buckets as wide as the power of two below its length, of which it meets three at most; a point
    is dealt to its bucket of each width that occurs. So wide intervals make no more rows than narrow ones, and only
    neighbours meet. Rows with a null or an empty interval match nothing.
    """
    wide, at = f"_{uuid.uuid4().hex}", f"_{uuid.uuid4().hex}"
    some = right.where(F.col(start) < F.col(end)).withColumn(wide, F.floor(F.log2((F.col(end) - F.col(start)).cast("double"))).cast("int"))
    widths = sorted(r[0] for r in some.select(wide).distinct().collect())  # one for each power of two at most
    bucket = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col(wide))).cast("long")
    spread = some.withColumn(at, F.explode(F.sequence(bucket(start), bucket(end))))
    points = left.withColumn(wide, F.explode(F.array(*map(F.lit, widths)).cast("array<int>"))).withColumn(at, bucket(point))
    return points.join(spread, [wide, at]).where((F.col(start) <= F.col(point)) & (F.col(point) < F.col(end))).drop(wide, at)
