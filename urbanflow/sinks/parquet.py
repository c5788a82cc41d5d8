"""Partitioned Parquet landing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], *,
                      mode: str = "overwrite", overwrite: str = "dynamic", fmt: str = "parquet",
                      rebalance: bool = True, max_records_per_file: int | None = None,
                      observation: Observation | None = None) -> None:
    """Write ``df`` as Hive-partitioned files.

    ``overwrite="dynamic"`` replaces only the partitions present in ``df``
    (a daily re-run does not wipe earlier days); ``"static"`` replaces the
    whole table. ``rebalance`` asks AQE for a REBALANCE on the partition
    columns: one shuffle that gives each output partition few, evenly sized
    files and splits a hot partition over several tasks instead of one.
    """
    out = df.hint("rebalance", *partition_cols) if rebalance and partition_cols else df
    if observation is not None:
        # observed in the writing (result) stage, above any exchange: each
        # partition's metrics count once even if map stages are re-run
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    writer = (out.write.mode(mode).format(fmt)
              .option("partitionOverwriteMode", overwrite))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(path)


def write_counted(df: DataFrame, path: str, partition_cols: Sequence[str] = (), *,
                  name: str = "landing", **kwargs) -> int:
    """Write and return the row count measured by the write itself
    (an ``Observation``), instead of a second full scan."""
    obs = Observation(name)
    write_partitioned(df, path, partition_cols, observation=obs, **kwargs)
    return int(obs.get["rows"])


def read_partitioned(spark, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a partitioned table back. With an explicit schema, partition
    values keep their declared types (``"02"`` stays a string)."""
    reader = spark.read.format(fmt).option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
