"""Time spines derived from the data's own range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparts import truncate_hour


def _hours(df: DataFrame, lo: str, hi: str, name: str) -> DataFrame:
    """Every hour of each row's [lo, hi], days first: no row ever holds more than its days or 24 hours."""
    day = F.col(lo).cast("date").cast("timestamp_ntz")  # date_trunc would go through the session's zone
    days = F.explode(F.sequence(day, F.col(hi), F.expr("INTERVAL 1 DAY")))
    hours = df.withColumn("_day", days).withColumn("_h", F.explode(F.sequence(F.lit(0), F.lit(23))))
    hours = hours.withColumn(name, F.col("_day") + F.make_dt_interval(F.lit(0), F.col("_h")))
    return hours.where(F.col(name).between(F.col(lo), F.col(hi))).drop("_day", "_h")


def hourly_spine(df: DataFrame, ts: str, name: str = "hour_start") -> DataFrame:
    """Every hour from the first to the last event's hour (inclusive).

    One global min/max aggregate (partial per task, one row to merge), then
    the days of the range, then the hours of each day: the spine's size is the
    time span in hours, independent of the number of events.
    """
    bounds = df.agg(truncate_hour(F.min(ts)).alias("lo"), truncate_hour(F.max(ts)).alias("hi"))
    return _hours(bounds, "lo", "hi", name).select(name)


def gap_filled_hourly_counts(df: DataFrame, ts: str, name: str = "hour_start",
                             count_name: str = "n_events") -> DataFrame:
    """Hourly event counts with explicit zero rows for silent hours.

    The events are scanned once: each counted hour (one row an hour that has
    events) also fills the silent hours up to the next one.
    """
    counts = (df.where(F.col(ts).isNotNull()).groupBy(truncate_hour(ts).alias("_from"))
              .agg(F.count(F.lit(1)).alias(count_name)))
    last = F.lead("_from").over(Window.orderBy("_from")) - F.expr("INTERVAL 1 HOUR")
    filled = _hours(counts.withColumn("_to", F.coalesce(last, F.col("_from"))), "_from", "_to", name)
    n = F.when(F.col(name) == F.col("_from"), F.col(count_name)).otherwise(F.lit(0))
    return filled.select(name, n.cast("long").alias(count_name))
