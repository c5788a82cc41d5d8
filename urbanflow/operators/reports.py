"""Counts, ingestion reports, per-column statistics, windowed summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sums of doubles depend on the order of addition. Values of up to six decimals are summed as whole millionths, in
# two halves of a long each, values of up to twelve as decimals of this type; so the result is the same on every run.
# If a group has any other value (NaN, infinite, finer or larger), that group's sum and mean are the plain double
# ones. NaN counts as a value: its group's sum and mean are NaN. Nulls do not count.
EXACT_TYPE = "decimal(38,12)"
_SCALE, _LIMIT, _LOW = 1e6, float(1 << 53), 26


def _exact(col: Column | str) -> tuple[Column, Column, Column]:
    """(value, exact sum as double or null, whether the sum stands for all values)."""
    v = (F.col(col) if isinstance(col, str) else col).cast("double")
    scaled = F.rint(v * F.lit(_SCALE))
    small = (F.abs(scaled) < F.lit(_LIMIT)) & (scaled / F.lit(_SCALE) == v)  # false for NaN
    whole = F.when(small, scaled.try_cast("long"))
    high = F.sum(F.shiftright(whole, _LOW)).cast("decimal(20,0)") * F.lit(1 << _LOW).cast("decimal(8,0)")
    low = F.sum(whole.bitwiseAND(F.lit((1 << _LOW) - 1))).cast("decimal(20,0)")
    millionths = ((high + low) * F.lit("0.000001").cast("decimal(6,6)")).cast("double")
    fine = F.when(~small, v.try_cast(EXACT_TYPE))  # few values: decimals are costly
    fine = F.when(fine.cast("double") == v, fine)
    rest = F.try_sum(fine).cast("double")
    every = (F.count(v) == F.count(whole) + F.count(fine)) & ((F.count(fine) == 0) | rest.isNotNull())
    return v, F.coalesce(millionths + rest, millionths, rest), every


def exact_sum(col: Column | str) -> Column:
    """Sum as double; null if there is no value."""
    v, total, whole = _exact(col)
    return F.coalesce(F.when(whole, total), F.sum(v))


def exact_mean(col: Column | str) -> Column:
    """Mean of the non-null values; null if there is none."""
    v, total, whole = _exact(col)
    return F.coalesce(F.when(whole, total / F.count(v)), F.avg(v))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Global count: partial count per task, one tiny final merge."""
    return df.agg(F.count(F.lit(1)).alias(name))


def ingest_report(df: DataFrame, dataset: str, event_ts: str, valid: str,
                  corrupt: str | None = None) -> DataFrame:
    aggs = [
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col(valid)).alias("n_valid"),
        F.count_if(~F.col(valid)).alias("n_quarantined"),
        F.min(event_ts).alias("first_event_ts"),
        F.max(event_ts).alias("last_event_ts"),
    ]
    if corrupt:
        aggs.append(F.count(F.col(corrupt)).alias("n_corrupt"))
    return df.groupBy(dataset).agg(*aggs)


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count / nulls / min / max / mean of each column in ONE scan and one
    aggregate, reshaped to one row per column."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__nn"), F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max"), exact_mean(c).alias(f"{c}__mean")]
    wide = df.agg(*aggs)
    stack_args = ", ".join(f"'{c}', `{c}__nn`, `{c}__min`, `{c}__max`, `{c}__mean`" for c in columns)
    long = wide.selectExpr("_n", f"stack({len(columns)}, {stack_args}) AS (column_name, nn, min_value, max_value, mean_value)")
    return long.select(
        "column_name",
        F.col("_n").alias("n_rows"),
        (F.col("_n") - F.col("nn")).alias("n_null"),
        "min_value", "max_value", "mean_value",
    )


def windowed_summary(df: DataFrame, ts: str, group_by: Sequence[str], value: str,
                     window: str = "1 hour") -> DataFrame:
    """Tumbling event-time windows per group: count of rows, and min, max, mean of the non-null values."""
    return (df.groupBy(F.window(ts, window).alias("w"), *group_by)
            .agg(F.count(F.lit(1)).alias("n"), exact_mean(value).alias("mean_value"),
                 F.min(value).alias("min_value"), F.max(value).alias("max_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *group_by,
                    "n", "min_value", "max_value", "mean_value"))
