"""Skew-safe per-group sequence numbers equal row_number() - 1."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanflow.operators.sequence import sequence_number
from urbanflow.plans.catalog import table
from conftest import SF_SMALL


def _reference(df, by, order):
    return df.withColumn("want", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)


def test_matches_window_on_events(spark):
    e = table(spark, SF_SMALL, "events")
    got = sequence_number(e, ["user_id"], ["ts", "event_id"], "seq")
    joined = got.join(_reference(e, ["user_id"], ["ts", "event_id"]).select("event_id", "want"), "event_id")
    assert joined.filter(F.col("seq") != F.col("want")).count() == 0
    assert joined.count() == e.count()


def test_hot_group_is_split_across_tasks(spark):
    # one key holds a third of all rows
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("g"),
                               F.col("id").alias("o"))
    got = sequence_number(df, ["g"], ["o"], "seq", num_partitions=8)
    want = _reference(df, ["g"], ["o"])
    assert got.join(want, ["g", "o"]).filter(F.col("seq") != F.col("want")).count() == 0
    # the hot group's rows land in several range partitions, not one task
    ranged = df.repartitionByRange(8, "g", "o").withColumn("p", F.spark_partition_id())
    assert ranged.filter(F.col("g") == 0).select("p").distinct().count() > 1
    hot = got.filter(F.col("g") == 0).agg(F.min("seq"), F.max("seq"), F.countDistinct("seq")).collect()[0]
    assert tuple(hot) == (0, n // 3 - 1, n // 3)


def test_plain_window_variant_agrees(spark):
    e = table(spark, SF_SMALL, "events")
    safe = sequence_number(e, ["user_id"], ["ts", "event_id"], "seq")
    plain = sequence_number(e, ["user_id"], ["ts", "event_id"], "seq", skew_safe=False)
    assert safe.select("event_id", "seq").exceptAll(plain.select("event_id", "seq")).count() == 0


def test_wide_input_without_exchange_reuse(spark):
    """Extra columns, more rows than the range bounds sample, a key with a third of them, no reuse."""
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        n = 200_000
        df = spark.range(n, numPartitions=16).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 997).alias("g"),
            F.xxhash64("id").alias("o"), F.col("id").cast("string").alias("payload"), F.col("id").alias("_pos"))
        got = sequence_number(df, ["g"], ["o"], "seq", num_partitions=16)
        assert got.columns == ["g", "o", "payload", "_pos", "seq"] and got.count() == n
        want = _reference(df, ["g"], ["o"]).select("payload", "want")
        assert got.join(want, "payload").where("seq = want").count() == n
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
