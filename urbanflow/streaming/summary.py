"""Event-time windowed summaries on a stream, with a watermark for late data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from ..functions.timeparts import ntz_to_instant, utc_wall_clock
from ..operators.reports import windowed_summary

# Late arrivals of up to 72 h are expected from the feed, so the default
# watermark keeps windows open that long before finalising them.
DEFAULT_WATERMARK = "72 hours"


def streaming_summary(events: DataFrame, ts: str, group_by: Sequence[str], value: str,
                      window: str = "1 hour", watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Watermarks need an instant: a UTC wall-clock TIMESTAMP_NTZ column is
    converted for the watermark and the window, and the window bounds are
    converted back, so the output matches the batch ``windowed_summary``."""
    if not isinstance(events.schema[ts].dataType, TimestampNTZType):
        return windowed_summary(events.withWatermark(ts, watermark), ts, group_by, value, window)
    inst = f"_{ts}_instant"
    out = windowed_summary(events.withColumn(inst, ntz_to_instant(ts)).withWatermark(inst, watermark),
                           inst, group_by, value, window)
    return out.withColumns({"window_start": utc_wall_clock("window_start"),
                            "window_end": utc_wall_clock("window_end")})


def start_summary(summary: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append mode: a window is emitted once, after the watermark passes its end."""
    return (summary.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 minutes"})).start())
