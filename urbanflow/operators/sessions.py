"""Spells of activity: rows of a key no further apart than a gap belong together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..functions.timeparts import utc_wall_clock
from ..streaming.summary import DEFAULT_WATERMARK
from ..streaming.watermark import instant


def sessions(df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int, value: str,
             watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """keys, session_start, last_seen, session_end (a gap after the last row; a row at that very time still belongs to it), n, min_value, max_value.

    A row more than a gap after the one before begins a new session. Works on a batch frame and as a stateful
    stream (append mode: a session goes out when the watermark passes its end).

    On a batch frame rows of one key within the same gap-long stretch of time are first added up, in the tasks
    that read them: they cannot but belong together. So a key that holds most of the rows brings at most one
    row per stretch and task to the shuffle, however many it has. Null keys are a key like any other; rows
    without a time take no part; nulls count in no minimum or maximum.
    """
    ntz = isinstance(df.schema[ts].dataType, TimestampNTZType)
    rows = df.select(*keys, instant(df, ts).alias("_at"), F.col(value).alias("_v")).where(F.col("_at").isNotNull())
    if df.isStreaming:
        window = F.session_window("_at", f"{gap_seconds} seconds")
        spells = rows.withWatermark("_at", watermark).groupBy(*keys, window.alias("_w")).agg(
            F.max("_at").alias("_last"), F.count(F.lit(1)).alias("n"), F.min("_v").alias("min_value"), F.max("_v").alias("max_value"))
    else:
        stretch = F.floor(F.unix_micros("_at") / F.lit(gap_seconds * 1_000_000))
        parts = rows.groupBy(*keys, stretch.alias("_s")).agg(
            F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.count(F.lit(1)).alias("_n"),
            F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        seconds = (F.unix_micros("_to") - F.unix_micros("_from")).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")
        length = F.make_interval(secs=(seconds + F.lit(gap_seconds)).cast("decimal(18,6)"))
        spells = parts.withColumn("_gap", length).groupBy(*keys, F.session_window("_from", F.col("_gap")).alias("_w")).agg(
            F.max("_to").alias("_last"), F.sum("_n").alias("n"), F.min("_min").alias("min_value"), F.max("_max").alias("max_value"))

    def back(c):
        return utc_wall_clock(c) if ntz else F.col(c)

    return spells.select(*keys, back("_w.start").alias("session_start"), back("_last").alias("last_seen"),
                         back("_w.end").alias("session_end"), "n", "min_value", "max_value")
