"""The time by which a stream's watermark moves, and what a stateful query reports of its state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from ..functions.timeparts import ntz_to_instant

# A device clock may run ahead of the broker's by so much; beyond it the arrival counts. Otherwise one message
# from the year 9000 would move the watermark there, and every later one would be late.
AHEAD = "1 hour"


def instant(df: DataFrame, name: str) -> Column:
    """The column as an instant: a TIMESTAMP_NTZ is read as a UTC wall clock."""
    return ntz_to_instant(name) if isinstance(df.schema[name].dataType, TimestampNTZType) else F.col(name)


def watermark_time(df: DataFrame, event_ts: str, arrival: str | None, ahead: str = AHEAD) -> Column:
    """Event time, at most ``ahead`` after the arrival; the arrival where there is no event time."""
    event = instant(df, event_ts)
    if arrival is None:
        return event
    came = instant(df, arrival)
    return F.least(F.coalesce(event, came), came + F.expr(f"INTERVAL {ahead}"))


def state_report(query: StreamingQuery) -> list[dict]:
    """Per micro-batch that the query still remembers and stateful operator: batch_id, operator, rows and bytes
    in the state, rows dropped as late, copies dropped."""
    out = []
    for p in query.recentProgress:
        for s in p["stateOperators"]:
            out.append({"batch_id": p["batchId"], "operator": s["operatorName"], "state_rows": s["numRowsTotal"],
                        "state_bytes": s["memoryUsedBytes"], "late_rows": s["numRowsDroppedByWatermark"],
                        "dropped_copies": (s.get("customMetrics") or {}).get("numDroppedDuplicateRows", 0)})
    return out
