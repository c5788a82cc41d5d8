"""Sequence numbers per source on a stream: a ledger of how many messages each source has had.

A micro-batch reads the counts that earlier batches left, numbers its own rows on top of them, and writes rows
and new counts into directories of its own number. A replayed batch reads the same earlier counts and replaces
its own directories, so numbers are given once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.sequence import sequence_number

# every so many batches the ledger holds all sources, so that no more than that many directories are read
SNAPSHOT = 16


def _existing(spark: SparkSession, path: str, first: int, last: int) -> list[str]:
    """The batch directories from first to last that a finished write has left."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for i in range(first, last + 1):
        done = jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={i}/_SUCCESS")
        if done.getFileSystem(conf).exists(done):
            found.append(f"{path}/batch_id={i}")
    return found


def counts_before(spark: SparkSession, ledger: str, batch_id: int, keys: Sequence[StructField]) -> DataFrame:
    """keys, total: messages of each source in the batches before this one."""
    schema = StructType([*[StructField(f"k{i}", k.dataType) for i, k in enumerate(keys)], StructField("total", LongType())])
    snapshot = (batch_id - 1) // SNAPSHOT * SNAPSHOT
    paths = _existing(spark, ledger, max(snapshot, 0), batch_id - 1)
    if not paths:
        return spark.createDataFrame([], schema)
    # totals only grow, so the largest is the latest
    return spark.read.schema(schema).parquet(*paths).groupBy(*schema.names[:-1]).agg(F.max("total").alias("total"))


def number_batch(batch: DataFrame, batch_id: int, out: str, ledger: str, keys: Sequence[str], order_by: Sequence[str],
                 name: str = "message_number") -> None:
    """Rows of one micro-batch with their numbers to ``out/batch_id=<n>``, the new counts to the ledger."""
    spark = batch.sparkSession
    fields = [batch.schema[k] for k in keys]
    before = counts_before(spark, ledger, batch_id, fields)
    same = [F.col(k).eqNullSafe(F.col(f"k{i}")) for i, k in enumerate(keys)]
    numbered = sequence_number(batch, keys, order_by, name)
    (numbered.join(before, same, "left").select(*[F.col(c) for c in batch.columns if c != name],
                                                (F.col(name) + F.coalesce("total", F.lit(0))).alias(name))
     .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"))
    written = spark.read.schema(numbered.schema).parquet(f"{out}/batch_id={batch_id}")
    now = written.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg((F.max(name) + 1).alias("total"))
    if batch_id % SNAPSHOT == 0:
        now = now.union(before).groupBy(*before.columns[:-1]).agg(F.max("total").alias("total"))
    now.write.mode("overwrite").parquet(f"{ledger}/batch_id={batch_id}")


def start_numbering(records: DataFrame, out: str, ledger: str, checkpoint: str, keys: Sequence[str],
                    order_by: Sequence[str], trigger: dict | None = None) -> StreamingQuery:
    """0-based numbers per source in order of arrival by batch, within a batch by ``order_by``; null keys are a
    source like any other. out, ledger and checkpoint belong together: a new checkpoint needs new ones, as its
    batch numbers begin at 0."""
    def each(batch: DataFrame, batch_id: int) -> None:
        number_batch(batch, batch_id, out, ledger, keys, order_by)

    return (records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"})).start())


def read_numbered(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.option("basePath", out).parquet(f"{out}/batch_id=*").drop("batch_id")
