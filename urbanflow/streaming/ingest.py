"""Kafka-layout records -> parsed, event-time partitioned Parquet (exactly-once file sink)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import NumericType, StructType

from ..functions.messages import CORRUPT, decode_json, drop_empty, required_present
from ..functions.timeparts import epoch_seconds_to_time, format_date, parse_event_time, time_parts, utc_wall_clock
from ..schemas import WEATHER_CORE
from ..sinks.parquet import write_partitioned

KAFKA_COLS = {"topic": "kafka_topic", "partition": "kafka_partition", "offset": "kafka_offset",
              "timestamp": "kafka_timestamp"}
PARTS = ("year", "month", "day", "hour")

# Sound and bad rows land in one table, the flag as its first partition level. Bad rows keep the source
# coordinates and the raw text: replayable.
VALID = "valid"
QUARANTINE_COLUMNS = (*KAFKA_COLS.values(), "raw_value", CORRUPT, "arrival_date")


def parse_records(records: DataFrame, schema: StructType = WEATHER_CORE, ts_field: str = "timestamp",
                  required: Sequence[str] = ("reading_id", "event_ts"), valid: str = "_valid") -> DataFrame:
    """drop empties -> from_json (PERMISSIVE) -> flatten -> event_ts + parts -> validity flag.

    Stateless and map-only: works identically on a batch or a stream.
    """
    msgs = drop_empty(records)
    decoded = decode_json(msgs, schema)
    flat = decoded.select(*[F.col(k).alias(v) for k, v in KAFKA_COLS.items()],
                          F.col("value").cast("string").alias("raw_value"), "data.*")
    if "station" in schema.fieldNames() and isinstance(schema["station"].dataType, StructType):
        names = set(schema["station"].dataType.fieldNames())
        if "altitude_m" in names:  # the producer writes altitude_m; readers expect altitude
            alt = F.col("station.altitude_m")
            if "altitude" in names:
                alt = F.coalesce(F.col("station.altitude"), alt)
            flat = flat.withColumn("station", F.col("station").withField("altitude", alt).dropFields("altitude_m"))
    numeric = isinstance(schema[ts_field].dataType, NumericType)  # epoch seconds, else ISO text
    event_ts = epoch_seconds_to_time(ts_field) if numeric else parse_event_time(ts_field)
    flat = flat.withColumn("event_ts", event_ts).withColumns(time_parts("event_ts"))
    return flat.withColumn(valid, required_present(required))


def landing_frame(parsed: DataFrame, valid: str = "_valid") -> DataFrame:
    """What lands: every row with its flag; the raw text only where it is needed. No filter, so the payload is
    parsed once."""
    bad = ~F.col(valid)
    return (parsed.withColumns({
        "raw_value": F.when(bad, F.col("raw_value")), CORRUPT: F.when(bad, F.col(CORRUPT)),
        "arrival_date": F.when(bad, format_date(utc_wall_clock("kafka_timestamp")))})
        .withColumnRenamed(valid, VALID))


def is_valid() -> Column:
    """The flag as read back (a directory name)."""
    return F.col(VALID).cast("boolean")


def sound_rows(landed: DataFrame) -> DataFrame:
    """The landed records themselves (a partition filter)."""
    own = [c for c in landed.columns if c not in {VALID, "raw_value", CORRUPT, "arrival_date"}]
    return landed.where(is_valid()).select(*own)


def quarantined_rows(landed: DataFrame) -> DataFrame:
    """The rows that did not parse, or lack a required field (a partition filter)."""
    return landed.where(~is_valid()).select(*QUARANTINE_COLUMNS)


def query_directory(batch: DataFrame) -> str:
    """``query_id=<id>`` of the streaming query that calls ``foreachBatch``: constant over restarts, new with
    a new checkpoint, whose batch numbers begin at 0 again."""
    id_ = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not id_:
        raise ValueError("not called from a streaming query")
    return f"query_id={id_}"


def write_landing_batch(batch: DataFrame, batch_id: int, path: str, partition_cols: Sequence[str],
                        query_dir: str | None = None) -> None:
    """One micro-batch of the rebalanced landing: ``path/query_id=<id>/batch_id=<n>/<parts>``
    written with a static overwrite of that batch's directory (a replayed
    batch replaces its own files, and no other query's: idempotent), through
    an AQE REBALANCE on the partition columns (about one file per partition
    and batch, hot partitions split)."""
    where = query_dir or query_directory(batch)
    write_partitioned(batch, f"{path}/{where}/batch_id={batch_id}", list(partition_cols), overwrite="static")


def start_landing(parsed: DataFrame, path: str, checkpoint: str, *,
                  partition_cols: Sequence[str] = PARTS, trigger: dict | None = None,
                  query_name: str | None = None, valid: str = "_valid",
                  mode: str = "file_sink") -> list[StreamingQuery]:
    """Start the landing query: one read of the source, one parse, sound and
    bad rows in one commit (partition ``valid=true`` / ``valid=false``), so no
    row can fall between two queries that start at different offsets.

    ``mode="file_sink"`` (default): map-only, exactly-once file sink that
    commits through ``_spark_metadata`` + the checkpoint, so a restarted or
    retried micro-batch never duplicates files; one file per task and
    partition per batch.

    ``mode="rebalanced"``: for high fan-out streams and backfills, each
    micro-batch is written by ``write_landing_batch`` (one bounded shuffle,
    far fewer files, no growing sink log); exactly-once by idempotent
    per-batch overwrite.
    """
    frame, parts = landing_frame(parsed, valid), [VALID, *partition_cols]
    if mode == "rebalanced":
        writer = frame.writeStream.foreachBatch(lambda df, bid: write_landing_batch(df, bid, path, parts))
    elif mode == "file_sink":
        writer = frame.writeStream.format("parquet").option("path", path).partitionBy(*parts).outputMode("append")
    else:
        raise ValueError(f"unknown landing mode {mode!r}")
    if query_name:
        writer = writer.queryName(query_name)
    return [writer.option("checkpointLocation", f"{checkpoint}/landing")
            .trigger(**(trigger or {"processingTime": "1 minute"})).start()]
