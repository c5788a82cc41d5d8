"""Run operators while the first attempt of a task of their input dies midway, in its own JVM
(task retries need ``local[n,maxFailures]``). Prints one JSON line with what the test checks."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from urbanflow.llm import bpe, conversations, linededup, mixing, packing, sharding, simhash, whitening  # noqa: E402
from urbanflow.llm.queries import tokenizer_path  # noqa: E402
from urbanflow.session import build_session, clean_scratch  # noqa: E402

MARKERS = tempfile.mkdtemp(prefix="lost-tasks-")


def flaky(batches):
    """Test-only hook: the first attempt of task 1 dies after a batch (and leaves a marker file)."""
    ctx = TaskContext.get()
    for i, frame in enumerate(batches):
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0 and i >= 1:
            open(os.path.join(MARKERS, f"stage{ctx.stageId()}-task{ctx.taskAttemptId()}"), "w").close()
            raise RuntimeError("injected loss")
        yield frame


def main():
    spark = build_session("lost-tasks", "local[2,4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "20"})
    spark.sparkContext.setLogLevel("OFF")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3, "doc_id")
    bad = docs.mapInPandas(flaky, docs.schema)
    runs = {
        "simhash": lambda d: simhash.near_duplicates(d, carry=["doc_id"]).select("doc_id", "fingerprint", "component_id"),
        "lines": lambda d: linededup.drop_common_lines(d).select("doc_id", "text", "n_dropped"),
        "bpe": lambda d: bpe.encode(d, tokenizer_path(), carry=["doc_id"], decoded=True).select("doc_id", F.hex("ids"), "decoded"),
        "mixing": lambda d: mixing.mix(d, carry=["doc_id"]).select("doc_id", "taken"),
    }
    out = {name: sorted(map(tuple, f(bad).collect())) == sorted(map(tuple, f(docs).collect())) for name, f in runs.items()}
    for name, table, f in (("conversations", "conversations", conversations.repair),
                           ("whitening", "embeddings", lambda d: whitening.whiten(d, carry=["vec_id"]).select("vec_id", "n", "deviation"))):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").repartition(3)
        out[name] = sorted(map(tuple, f(rows.mapInPandas(flaky, rows.schema)).collect())) == sorted(map(tuple, f(rows).collect()))
    placed = sharding.shuffle_into_shards(bad, 8).select("doc_id", "shard", "slot").collect()
    out["sharding"] = len({r["doc_id"] for r in placed}) == len({(r["shard"], r["slot"]) for r in placed}) == len(placed) == 200
    pieces = packing.pack(bad, tokenizer_path())
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    out["packing"] = whole.where("n = t").count() == 200
    out["injected"] = len(os.listdir(MARKERS))
    print(json.dumps(out))
    clean_scratch(spark)


if __name__ == "__main__":
    main()
