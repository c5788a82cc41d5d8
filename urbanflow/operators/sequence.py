"""Per-group sequence numbers that stay balanced when one group is huge.

``row_number() OVER (PARTITION BY g ORDER BY o) - 1`` puts every row of a
group into one task. Here the rows are range-partitioned on (g, o), so a hot
group is spread over many tasks. The bounds of a range exchange are sampled, so
two evaluations of it may cut differently: the partitioned rows are written
once, with their slice and position as columns, and both the slice sizes and
the numbering read that table. Equals the window function, whatever other
columns the input has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def sequence_number(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                    name: str = "seq", num_partitions: int | None = None,
                    skew_safe: bool = True) -> DataFrame:
    """0-based position of each row within its ``partition_by`` group.

    ``order_by`` should end with a unique column for a deterministic result.
    ``skew_safe=False`` is the plain window (one shuffle, but a whole group in
    one task): only for groups known to be bounded.
    """
    if not skew_safe:
        w = Window.partitionBy(*partition_by).orderBy(*order_by)
        return df.withColumn(name, F.row_number().over(w) - F.lit(1))
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*partition_by, *order_by]
    slice_, pos, row = (_unused(df, c) for c in ("_slice", "_pos", "_row"))
    # range exchange: sampled bounds split a hot group across partitions
    path = scratch_path(spark, "sequence")
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
       .withColumns({slice_: F.spark_partition_id(), pos: F.monotonically_increasing_id()})
       .select(F.struct("*").alias(row)).write.parquet(path))
    ranged = spark.read.parquet(path).select(f"{row}.*")
    # one row per (group, slice): at most #groups + #partitions rows
    slices = ranged.groupBy(*partition_by, slice_).agg(F.min(pos).alias("first"), F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy(*partition_by).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")
    slices = slices.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(partition_by)],
                           F.col(slice_).alias("_ks"), shift.alias("_shift"))
    # null-safe on the group keys: a null key is a group like any other
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(partition_by)]
    numbered = ranged.join(slices, [*cond, F.col(slice_) == F.col("_ks")], "left")
    return numbered.select(*[F.col(c) for c in df.columns if c != name], (F.col(pos) + F.col("_shift")).alias(name))


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = "_" + name
    return name
