"""The given tables as frames and as streams."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table replayed as a file stream (stand-in for the broker).

    The table may be one Parquet file or a directory of part files; given as a
    pattern, the source takes either. A micro-batch is at most 64 files.
    """
    schema = table(spark, sf_dir, "events").schema
    path = f"{sf_dir.rstrip('/')}/event[s].parquet"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(path)


def run_available_now(queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception():
            raise q.exception()


def arriving(records: DataFrame, path: str, chunks: int, arrival: str = "timestamp") -> Iterator[DataFrame]:
    """The records appended to a folder in order of arrival, in so many equal spans of time; after each span the
    folder as a stream. So a query is restarted from its checkpoint between spans, and sees later ones later."""
    spark = records.sparkSession
    low, high = records.agg(F.min(F.unix_micros(arrival)), F.max(F.unix_micros(arrival))).first()
    width = 1 if low is None else (high - low) // chunks + 1
    place = F.coalesce(F.floor((F.unix_micros(arrival) - F.lit(low or 0)) / F.lit(width)), F.lit(0))
    for i in range(chunks):
        records.where(place == i).write.mode("append").parquet(path)
        yield spark.readStream.schema(records.schema).parquet(path)
