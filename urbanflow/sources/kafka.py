"""Kafka source options and a Kafka-layout adapter for any DataFrame.

The adapter lets every downstream operator be written once against the
Kafka column layout (key, value, topic, partition, offset, timestamp) and be
exercised with file or memory streams where no broker is reachable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FeedConfig


def kafka_source_options(cfg: FeedConfig, topics: Sequence[str] | None = None) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": cfg.bootstrap_servers,
        "subscribe": ",".join(topics or cfg.topics),
        "startingOffsets": cfg.starting_offsets,
        # a lost topic partition must not silently skip data in production
        "failOnDataLoss": "true",
    }
    if cfg.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    if cfg.min_partitions:
        opts["minPartitions"] = str(cfg.min_partitions)
    return opts


def read_kafka_stream(spark: SparkSession, cfg: FeedConfig, topics: Sequence[str] | None = None) -> DataFrame:
    """``readStream.format("kafka")``; needs the Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**kafka_source_options(cfg, topics)).load()


def read_kafka_batch(spark: SparkSession, cfg: FeedConfig, topics: Sequence[str] | None = None,
                     starting: str = "earliest", ending: str = "latest") -> DataFrame:
    opts = kafka_source_options(cfg, topics)
    opts.update({"startingOffsets": starting, "endingOffsets": ending})
    return spark.read.format("kafka").options(**opts).load()


def as_kafka_records(df: DataFrame, *, value: Column, topic: Column, offset: Column,
                     timestamp: Column, key: Column | None = None,
                     partition: Column | None = None) -> DataFrame:
    """Project any (batch or streaming) DataFrame onto the Kafka source layout."""
    return df.select(
        (key.cast("string").cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        value.cast("binary").alias("value"),
        topic.cast("string").alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
