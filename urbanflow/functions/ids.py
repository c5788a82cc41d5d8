"""Replay-safe identifiers derived from the record's source coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_id(topic: Column | str, partition: Column | str, offset: Column | str,
             prefix: str | None = None, length: int = 8) -> Column:
    """First ``length`` hex digits of sha256(topic-partition-offset).

    Deterministic, so a retried task produces the same id (a random uuid
    would not). Eight hex digits collide around 65k ids: display only.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in (topic, partition, offset)]
    digest = F.substring(F.sha2(F.concat_ws("-", *[c.cast("string") for c in cols]), 256), 1, length)
    return F.concat(F.lit(prefix), digest) if prefix else digest
