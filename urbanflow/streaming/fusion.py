"""Two feeds fused by key and time: each left record with the right records near it, or alone.

As a stream both sides keep state until the other side's watermark shows that no partner can come any more;
then a left record without a partner goes out alone. On batch frames the same function is a plain join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .summary import DEFAULT_WATERMARK
from .watermark import instant, watermark_time


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str,
                  before: str, after: str, how: str = "left", delay: str = DEFAULT_WATERMARK,
                  arrival: str | None = None, salts: int = 1) -> DataFrame:
    """Rows of left with the rows of right that have the same ``on`` and a time from ``before`` earlier to
    ``after`` later; all columns of left, then those of right but ``on``. how: inner or left.

    Columns of the two sides must differ in name but for ``on``. Several partners: a row each. Null keys match
    nothing. Rows without a time take their arrival's if it is given, else they take no part. ``salts`` spreads
    the left rows of a hot key over so many tasks and state partitions, at the price of as many copies of right
    (each left row still meets every partner once, so unmatched rows stay right).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join {how!r}")
    clash = ({c.lower() for c in left.columns} & {c.lower() for c in right.columns}) - {c.lower() for c in on}
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    streaming = left.isStreaming or right.isStreaming
    keys = [f"_on{i}" for i in range(len(on))]
    sides = []
    for df, ts, mark in ((left, left_ts, "_lt"), (right, right_ts, "_rt")):
        came = arrival if arrival and arrival in df.columns else None
        marked = df.withColumn(mark, watermark_time(df, ts, came) if came else instant(df, ts)).where(F.col(mark).isNotNull())
        sides.append(marked.withWatermark(mark, delay) if streaming else marked)
    own = [c for c in right.columns if c not in on]
    l = sides[0].withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    r = sides[1].select(*[F.col(c).alias(k) for c, k in zip(on, keys)], *own, "_rt",
                        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_rsalt"))
    near = ((F.col("_salt") == F.col("_rsalt"))
            & (F.col("_rt") >= F.col("_lt") - F.expr(f"INTERVAL {before}"))
            & (F.col("_rt") <= F.col("_lt") + F.expr(f"INTERVAL {after}")))
    for c, k in zip(on, keys):
        near = near & (F.col(c) == F.col(k))
    return l.join(r, near, "inner" if how == "inner" else "leftOuter").select(*left.columns, *own)


def start_fusion(fused: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append mode: a pair goes out when its later half comes, a left record alone when its state expires."""
    return (fused.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"})).start())
