"""Hourly summaries kept up to date load by load.

Every load leaves its partial aggregates (count, exact and plain sum, minimum, maximum per hour and group) in a
directory of its own day and number. The summary of a day is put together from the partials of that day alone,
so a load reads no earlier row, and late rows touch their own days only. A load that is repeated replaces its
partials and gives the same summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import truncate_hour
from ..sinks.parquet import read_partitioned, write_partitioned
from .reports import EXACT_TYPE

DAY, LOAD = "day", "load"


def partial_hours(rows: DataFrame, ts: str, group_by: Sequence[str], value: str) -> DataFrame:
    """hour_start, group_by, and what can be added up of each hour's rows; rows without a time take no part."""
    v = F.col(value).cast("double")
    exact = v.try_cast(EXACT_TYPE)
    fits = exact.cast("double") == v
    return (rows.where(F.col(ts).isNotNull()).groupBy(truncate_hour(ts).alias("hour_start"), *group_by)
            .agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("values"), F.count(F.when(fits, F.lit(1))).alias("exact_values"),
                 F.try_sum(F.when(fits, exact)).cast(EXACT_TYPE).alias("exact_sum"), F.sum(v).alias("plain_sum"),
                 F.min(v).alias("min_value"), F.max(v).alias("max_value")))


def merged_hours(partials: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """The summary of partials: window_start, window_end, group_by, n, min_value, max_value, mean_value (as
    ``windowed_summary`` gives it) and loads, the number of loads that an hour's rows came in."""
    total = F.try_sum("exact_sum").cast("double")
    whole = (F.sum("values") == F.sum("exact_values")) & total.isNotNull()
    return partials.groupBy("hour_start", *group_by).agg(
        F.sum("n").alias("n"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.when(F.sum("values") > 0, F.when(whole, total).otherwise(F.sum("plain_sum")) / F.sum("values")).alias("mean_value"),
        F.count_distinct(LOAD).cast("long").alias("loads")).select(
        F.col("hour_start").alias("window_start"), (F.col("hour_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
        *group_by, "n", "min_value", "max_value", "mean_value", "loads")


def add_load(rows: DataFrame, load: int, state: str, summary: str, ts: str, group_by: Sequence[str], value: str) -> list:
    """Adds a load to the state and brings the summary's days up to date; returns the days that were touched."""
    spark = rows.sparkSession
    day = F.to_date("hour_start").alias(DAY)
    mine = partial_hours(rows, ts, group_by, value).select("*", day, F.lit(load).alias(LOAD))
    write_partitioned(mine, state, [LOAD, DAY])
    days = [r[DAY] for r in read_partitioned(spark, state).where(F.col(LOAD) == load).select(DAY).distinct().collect()]
    if days:  # partition filter: the partials of these days, of all loads
        touched = read_partitioned(spark, state).where(F.col(DAY).isin(days))
        new = merged_hours(touched, group_by).withColumn(DAY, F.to_date("window_start"))
        write_partitioned(new, summary, [DAY])
    return sorted(days)


def read_summary(spark: SparkSession, summary: str) -> DataFrame:
    return read_partitioned(spark, summary).drop(DAY)
