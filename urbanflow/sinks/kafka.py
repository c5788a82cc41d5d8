"""Kafka sink encoding: key = a record attribute, value = JSON of the whole record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import FeedConfig
from ..functions.messages import to_json_value


def encode_for_kafka(df: DataFrame, key: Column | str, topic: str | None = None) -> DataFrame:
    k = F.col(key) if isinstance(key, str) else key
    cols = [k.cast("string").alias("key"), to_json_value(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if topic:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols)


def kafka_sink_options(cfg: FeedConfig, topic: str | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": cfg.bootstrap_servers, **cfg.producer_options}
    if topic:
        opts["topic"] = topic
    return opts


def start_kafka_publish(df: DataFrame, key: Column | str, cfg: FeedConfig, topic: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """Publish a stream: every record as (key, JSON of the record), with the feed's delivery settings
    (needs the Kafka connector on the classpath)."""
    return (encode_for_kafka(df, key).writeStream.format("kafka").options(**kafka_sink_options(cfg, topic))
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"processingTime": cfg.trigger_interval})).start())


def write_kafka(df: DataFrame, cfg: FeedConfig, topic: str) -> None:
    """Batch publish (needs the Kafka connector on the classpath)."""
    df.write.format("kafka").options(**kafka_sink_options(cfg, topic)).save()
