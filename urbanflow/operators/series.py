"""Gaps in time series filled: the last value carried on, and the straight line to the next one.

Rows are range-partitioned by (group, time) and written once with their slice, so that a group that holds most
of the rows lies in many slices. Within a slice a window finds the nearest values; the first and last value of
each slice, one row a (group, slice), tell what lies beyond its borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparts import ntz_epoch_micros, truncate_hour
from ..session import scratch_path
from ..sources.spine import _hours
from .reports import exact_mean


def filled_series(df: DataFrame, group_by: Sequence[str], ts: str, value: str, slices: int | None = None) -> DataFrame:
    """df with carried (the value, or the last one before) and interpolated (the value, or on the line between
    the last before and the next after; null where one of them lacks), per group in order of time.

    Null groups are a group like any other. Rows without a time stay and keep their own value. Of rows of one
    time the order is by value, nulls first, so a carried null takes the value before. NaN is a value.
    """
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = [f"_g{i}" for i in range(len(group_by))]
    rows = df.select(F.struct("*").alias("_row"), *[F.col(c).alias(g) for c, g in zip(group_by, own)],
                     ntz_epoch_micros(ts).alias("_t"), F.col(value).cast("double").alias("_v"))
    at = scratch_path(spark, "series")
    keys = [*own, "_t", "_v"]
    (rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .withColumns({"_slice": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()}).write.parquet(at))
    rows = spark.read.parquet(at)
    seen = F.when(F.col("_v").isNotNull() & F.col("_t").isNotNull(), F.struct(F.col("_t").alias("t"), F.col("_v").alias("v")))
    rows = rows.withColumn("_p", seen)
    # what lies before and behind a slice: a row per (group, slice)
    ends = rows.groupBy(*own, "_slice").agg(F.min_by("_p", F.when(F.col("_p").isNotNull(), F.col("_pos"))).alias("first"),
                                            F.max_by("_p", F.when(F.col("_p").isNotNull(), F.col("_pos"))).alias("last"))
    order = Window.partitionBy(*own).orderBy("_slice")
    ends = ends.select(*[F.col(g).alias(f"_e{g}") for g in own], F.col("_slice").alias("_es"),
                       F.last("last", True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                       F.first("first", True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    inside = Window.partitionBy(*own, "_slice").orderBy("_pos")
    near = rows.withColumns({
        "_l": F.last("_p", True).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "_n": F.first("_p", True).over(inside.rowsBetween(0, Window.unboundedFollowing))})
    same = [F.col(g).eqNullSafe(F.col(f"_e{g}")) for g in own]
    both = near.join(ends, [*same, F.col("_slice") == F.col("_es")], "left").withColumns({
        "_l": F.coalesce("_l", "_before"), "_n": F.coalesce("_n", "_after")})
    share = (F.col("_t") - F.col("_l.t")).cast("double") / (F.col("_n.t") - F.col("_l.t")).cast("double")
    line = F.when(F.col("_n.t") > F.col("_l.t"), F.col("_l.v") + (F.col("_n.v") - F.col("_l.v")) * share).when(F.col("_n.t") == F.col("_l.t"), F.col("_l.v"))
    timed = F.col("_t").isNotNull()
    return both.select("_row.*", F.coalesce("_v", F.when(timed, F.col("_l.v"))).alias("carried"),
                       F.coalesce("_v", F.when(timed, line)).alias("interpolated"))


def hourly_series(df: DataFrame, group_by: Sequence[str], ts: str, value: str) -> DataFrame:
    """group_by, hour_start, n, value: a row for every hour from a group's first to its last, the mean of its
    values or null. Hours are as many as a group's span has; its rows are added up before the shuffle."""
    hours = (df.where(F.col(ts).isNotNull()).groupBy(*group_by, truncate_hour(ts).alias("_from"))
             .agg(F.count(F.lit(1)).alias("n"), exact_mean(value).alias("value")))
    next_ = F.lead("_from").over(Window.partitionBy(*group_by).orderBy("_from")) - F.expr("INTERVAL 1 HOUR")
    each = _hours(hours.withColumn("_to", F.coalesce(next_, F.col("_from"))), "_from", "_to", "hour_start")
    real = F.col("hour_start") == F.col("_from")
    return each.select(*group_by, "hour_start", F.when(real, F.col("n")).otherwise(F.lit(0)).cast("long").alias("n"),
                       F.when(real, F.col("value")).alias("value"))
