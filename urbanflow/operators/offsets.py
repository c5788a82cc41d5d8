"""Is every offset of a topic there, once? Runs of offsets, with what is missing between them.

Offsets less their rank are constant along a run without gaps. The rank is the skew-safe sequence number, so a
topic that holds most of the rows is spread over many tasks, and runs are put together by a partial aggregate
wherever the range borders cut them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .sequence import sequence_number

SOURCE = ("topic", "partition")


def offset_islands(records: DataFrame, topic: str = "topic", partition: str = "partition",
                   offset: str = "offset") -> DataFrame:
    """One row per run of consecutive offsets of a topic's partition: topic, partition, first, last, rows,
    missing (offsets between the run before and this one; 0 for the first) and repeated (rows beyond one an
    offset).

    A null topic or partition is one like any other; rows without an offset take no part. Offsets of any sign;
    an empty table gives no rows.
    """
    spark = records.sparkSession
    distinct = (records.where(F.col(offset).isNotNull())
                .groupBy(F.col(topic).alias("topic"), F.col(partition).alias("partition"), F.col(offset).cast("long").alias("offset"))
                .agg(F.count(F.lit(1)).alias("n")))
    ranked = sequence_number(distinct, SOURCE, ["offset"], "rank")
    runs = (ranked.groupBy(*SOURCE, (F.col("offset") - F.col("rank")).alias("run"))
            .agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum("n").alias("rows"),
                 F.count(F.lit(1)).alias("offsets"), F.min("rank").alias("rank")))
    path = scratch_path(spark, "offsets")
    runs.write.parquet(path)  # both sides of the join read it
    runs = spark.read.parquet(path)
    # the run before ends one rank before this one begins
    before = runs.select(*[F.col(c).alias(f"_{c}") for c in SOURCE], F.col("last").alias("_last"),
                         (F.col("rank") + F.col("offsets")).alias("_rank"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SOURCE]
    return runs.join(before, [*same, F.col("rank") == F.col("_rank")], "left").select(
        *SOURCE, "first", "last", "rows", F.coalesce(F.col("first") - F.col("_last") - 1, F.lit(0)).alias("missing"),
        (F.col("rows") - F.col("offsets")).alias("repeated"))


def offset_completeness(islands: DataFrame) -> DataFrame:
    """Per topic and partition: first, last, rows, missing, repeated and the number of runs."""
    return islands.groupBy(*SOURCE).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"), F.sum("repeated").alias("repeated"), F.count(F.lit(1)).alias("runs"))
