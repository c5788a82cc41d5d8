"""Means and rounding: nulls, NaN, tiny and large values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from urbanflow.functions.weather import round_half_up
from urbanflow.operators.reports import column_stats, exact_mean, exact_sum, windowed_summary


def one(spark, values, column):
    return spark.createDataFrame([(v,) for v in values], "v double").agg(column("v").alias("x")).collect()[0]["x"]


def test_mean_counts_no_nulls(spark):
    assert one(spark, [10.0, None, 20.0], exact_mean) == 15.0
    assert one(spark, [None, None], exact_mean) is None and one(spark, [], exact_sum) is None
    at = dt.datetime(2025, 7, 2, 9, 0)
    rows = spark.createDataFrame([(at, "a", v) for v in (10.0, None, 20.0)], "ts timestamp_ntz, g string, v double")
    got = windowed_summary(rows, "ts", ["g"], "v").collect()[0]
    assert (got["n"], got["mean_value"], got["min_value"], got["max_value"]) == (3, 15.0, 10.0, 20.0)


def test_mean_keeps_small_and_large_values(spark):
    assert one(spark, [4e-7, 4e-7], exact_mean) == 4e-7
    assert one(spark, [4e-20, 8e-20], exact_mean) == pytest.approx(6e-20)  # finer than the decimal: the double mean
    assert one(spark, [1e14, 1e14], exact_mean) == 1e14 and one(spark, [1e300, 1e300], exact_mean) == 1e300
    assert one(spark, [0.1] * 10, exact_sum) == 1.0


def test_sums_do_not_depend_on_the_order(spark):
    import random
    from decimal import Decimal
    rng = random.Random(1)
    values = [round(rng.uniform(-1e9, 1e9), rng.choice([0, 2, 6])) for _ in range(5000)] + [9e9 + 0.000001, -1e-6, 0.0, -0.0]
    want = float(sum(Decimal(repr(v)) for v in values))
    finer = [*values, 1.23456789, -7e-9, 1e15]
    seen = set()
    for _ in range(3):
        rng.shuffle(values)
        rng.shuffle(finer)
        assert one(spark, values, exact_sum) == want
        seen.add(one(spark, finer, exact_sum))
    assert len(seen) == 1 and abs(seen.pop() - float(sum(Decimal(repr(v)) for v in finer))) <= 1
    assert one(spark, [9e9] * 2000 + [-9e9] * 2000 + [0.25], exact_sum) == 0.25
    assert math.isinf(one(spark, [float("inf"), 1.0], exact_sum)) and one(spark, [3e24] * 40, exact_sum) == pytest.approx(1.2e26)


def test_nan_is_a_value(spark):
    assert math.isnan(one(spark, [float("nan"), 1.0], exact_mean))
    got = column_stats(spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double"), ["v"]).collect()[0]
    assert math.isnan(got["mean_value"]) and (got["n_rows"], got["n_null"], got["min_value"]) == (3, 1, 1.0)


def test_rounding_leaves_nan_and_large_values(spark):
    rows = spark.createDataFrame([(float("nan"),), (1e14,), (-2.25,), (None,), (float("inf"),)], "v double")
    got = [r["x"] for r in rows.select(round_half_up("v", 6).alias("x")).collect()]
    assert math.isnan(got[0]) and got[1:] == [1e14, -2.25, None, float("inf")]
    assert rows.where("v = -2.25").select(round_half_up("v", 1)).collect()[0][0] == -2.2


def test_epochs_agree_with_the_checked_path(spark):
    """100 000 epochs with microseconds: the PM job's parser and the rounding one give the same time."""
    from urbanflow.schemas import PM
    from urbanflow.streaming.ingest import parse_records
    base = spark.range(100_000).select((F.col("id") * 7919 * 1_000_003 % 10**15 + 10**15).alias("us"))
    msg = F.to_json(F.struct(F.lit("s").alias("station"), (F.col("us") / F.lit(1e6)).alias("timestamp"),
                             F.col("us").alias("counter")))
    recs = base.select(F.lit(None).cast("binary").alias("key"), msg.cast("binary").alias("value"), F.lit("t").alias("topic"),
                       F.lit(0).alias("partition"), F.col("us").alias("offset"), F.current_timestamp().alias("timestamp"))
    parsed = parse_records(recs, PM, ts_field="timestamp", required=("station", "event_ts"))
    exact = F.timestamp_add("MICROSECOND", F.col("counter"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    assert parsed.where("_valid").where(F.col("event_ts") != exact).count() == 0
    assert parsed.where("_valid").count() == 100_000
