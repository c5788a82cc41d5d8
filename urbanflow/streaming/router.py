"""Multi-topic router: every record lands in the weather or the generic layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.messages import drop_empty
from ..operators.routing import WEATHER_LAYOUT, route_messages
from ..sinks.parquet import write_partitioned
from .ingest import query_directory

# Layout: <root>/query_id=<id>/batch_id=<n>/layout=/place=/unit=/date=/part-*.json, where place and unit are
# zone and department of the weather layout, and topic and "all" of the generic one. ``hour`` is a sorted
# column inside the date directories rather than a directory level: it avoids 24x more (mostly tiny)
# directories.
PARTS = ["layout", "place", "unit", "date"]
WHOLE = "all"

_ROUTED = StructType(
    [StructField(c, StringType()) for c in ("topic", "hour", "message_id")]
    + [StructField("partition", IntegerType()), StructField("offset", LongType()),
       StructField("object_path", StringType()), StructField("payload", StringType()),
       StructField("query_id", StringType()), StructField("batch_id", LongType())]
    + [StructField(c, StringType()) for c in PARTS])


def write_routed_batch(records: DataFrame, batch_id: int, out_root: str, weather_topic: str,
                       query_dir: str | None = None) -> None:
    """Write one micro-batch, both layouts in one pass, as JSON Lines.

    Each batch owns the directory ``query_id=<id>/batch_id=<n>`` and writes it
    with a static overwrite: re-running the same batch after a failure
    replaces exactly that batch's files, so the sink is idempotent although
    ``foreachBatch`` is at-least-once; a query with a new checkpoint, whose
    batches count from 0 again, has an id and so a directory of its own.

    The write goes through a REBALANCE on the directory columns: AQE sizes
    the output to about one file per directory and batch, and splits a hot
    zone or date over several writers. The shuffle is bounded by the
    micro-batch size (``maxOffsetsPerTrigger``).
    """
    routed = (route_messages(drop_empty(records), weather_topic)
              .withColumn("payload", F.col("value").cast("string")))
    weather = F.col("layout") == WEATHER_LAYOUT
    routed = routed.select("topic", F.when(weather, F.col("hour")).alias("hour"), "message_id", "partition", "offset",
                           "object_path", "payload", "layout", F.when(weather, F.col("zone")).otherwise(F.col("topic")).alias("place"),
                           F.when(weather, F.col("dept")).otherwise(F.lit(WHOLE)).alias("unit"), "date")
    where = query_dir or query_directory(records)
    write_partitioned(routed, f"{out_root}/{where}/batch_id={batch_id}", PARTS, fmt="json", overwrite="static")


def start_router(records: DataFrame, out_root: str, checkpoint: str, weather_topic: str = "weather",
                 trigger: dict | None = None) -> StreamingQuery:
    trig = trigger or {"processingTime": "1 minute"}
    return (records.writeStream
            .foreachBatch(lambda df, bid: write_routed_batch(df, bid, out_root, weather_topic))
            .option("checkpointLocation", checkpoint).trigger(**trig).start())


def read_routed(spark, out_root: str) -> DataFrame:
    """Both layouts read back as one frame (nothing written yet: no rows)."""
    try:
        df = spark.read.schema(_ROUTED).option("basePath", out_root).json(out_root)
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        df = spark.createDataFrame([], _ROUTED)
    weather = F.col("layout") == WEATHER_LAYOUT
    return df.select("layout", "topic", "hour", "message_id", "partition", "offset", "object_path", "payload",
                     F.when(weather, F.col("place")).alias("zone"), F.when(weather, F.col("unit")).alias("dept"), "date",
                     "query_id", "batch_id")
