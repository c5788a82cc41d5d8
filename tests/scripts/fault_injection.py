"""Run landing jobs while the first attempt of a source task fails midway.

Executed in its own JVM (task retries need ``local[n,maxFailures]``).
Prints one JSON line with the counts the test checks.
"""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from urbanflow.operators.sequence import sequence_number  # noqa: E402
from urbanflow.plans import feeds  # noqa: E402
from urbanflow.session import build_session  # noqa: E402
from urbanflow.sinks.parquet import write_partitioned  # noqa: E402
from urbanflow.streaming.ingest import parse_records, start_landing  # noqa: E402

SF = "/root/testdata/sf0.001"


MARKERS = tempfile.mkdtemp(prefix="fault-markers-")


def flaky(batches):
    """Test-only hook: the first attempt of task 0 dies after emitting rows
    (and leaves a marker file, so the test can prove the failure happened)."""
    ctx = TaskContext.get()
    for i, pdf in enumerate(batches):
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0 and i >= 1:
            open(os.path.join(MARKERS, f"stage{ctx.stageId()}-task{ctx.taskAttemptId()}"), "w").close()
            raise RuntimeError("injected executor loss")
        yield pdf


def main():
    spark = build_session("fault-injection", "local[2,4]", {"spark.sql.shuffle.partitions": "4",
                                                             "spark.ui.enabled": "false",
                                                             "spark.sql.execution.arrow.maxRecordsPerBatch": "100"})
    spark.sparkContext.setLogLevel("OFF")
    out = tempfile.mkdtemp(prefix="fault-")
    events = spark.read.parquet(f"{SF}/events.parquet")
    n = events.count()

    # streaming landing through the exactly-once file sink
    src = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    stream = src.repartition(2, "event_id").mapInPandas(flaky, events.schema)
    parsed = parse_records(feeds.event_records(stream), feeds.EVENT_MESSAGE, required=("event_id", "event_ts"))
    for q in start_landing(parsed, f"{out}/landing", f"{out}/ckpt", trigger={"availableNow": True}):
        q.awaitTermination()
    landed = spark.read.parquet(f"{out}/landing").where("valid = 'true'")

    # multi-topic router (foreachBatch, persisted micro-batch, two layouts)
    from urbanflow.streaming.router import read_routed, start_router
    src2 = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    recs = feeds.event_records(src2.repartition(2, "event_id").mapInPandas(flaky, events.schema))
    start_router(recs, f"{out}/routed", f"{out}/ckpt_router", "click", {"availableNow": True}).awaitTermination()
    routed = read_routed(spark, f"{out}/routed")

    # batch landing with AQE rebalance
    batch = events.repartition(2, "event_id").mapInPandas(flaky, events.schema).withColumn("day", F.dayofmonth("ts"))
    write_partitioned(batch, f"{out}/batch", ["day"])
    batched = spark.read.parquet(f"{out}/batch")

    # sequence numbers with the failure upstream of the range exchange
    seq = sequence_number(events.repartition(2, "event_id").mapInPandas(flaky, events.schema),
                          ["user_id"], ["ts", "event_id"], "seq")
    seq_rows = seq.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id", "seq").alias("d")).collect()[0]

    print(json.dumps({
        "input": n,
        "landed": landed.count(), "landed_distinct": landed.select("event_id").distinct().count(),
        "batch": batched.count(), "batch_distinct": batched.select("event_id").distinct().count(),
        "routed": routed.count(), "routed_distinct": routed.select("offset").distinct().count(),
        "seq_rows": seq_rows["n"], "seq_distinct": seq_rows["d"],
        "injected_failures": len(os.listdir(MARKERS)),
    }))


if __name__ == "__main__":
    main()
