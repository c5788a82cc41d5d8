"""Each message once, though the producer sends it again: keyed state that expires with the watermark.

A resend repeats the message, its event time included. As long as the watermark has not passed that time the
key is in the state and the copy goes; afterwards the copy is late and goes without any state. So every
message is passed on once, and the state holds the keys of one watermark delay, not of all time. The condition
is the watermark's own: a message's first arrival is less than the delay behind the newest event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .summary import DEFAULT_WATERMARK
from .watermark import watermark_time


def deduplicated(records: DataFrame, ids: Sequence[str], event_ts: str = "event_ts",
                 arrival: str | None = "kafka_timestamp", delay: str = DEFAULT_WATERMARK,
                 position: Sequence[str] = ("kafka_topic", "kafka_partition", "kafka_offset")) -> DataFrame:
    """The stream without resends of a message, known by its ``ids``.

    A record that lacks an id (it did not parse) is no copy of another such one: its position in the source
    is its key, so quarantined rows all pass. Without an event time a record takes its arrival's. Of several
    copies in one micro-batch any one stays. A key that holds most records costs one state entry: copies are
    dropped where they are read from the shuffle, by key, and a task's share is bounded by the batch size.
    """
    mark, where = "_mark", "_where"
    lacking = F.lit(False)
    for i in ids:
        lacking = lacking | F.col(i).isNull()
    keyed = records.withColumns({
        mark: watermark_time(records, event_ts, arrival),
        where: F.when(lacking, F.concat_ws("-", *position)) if position else F.lit(None).cast("string")})
    return keyed.withWatermark(mark, delay).dropDuplicatesWithinWatermark([*ids, where]).drop(mark, where)
