"""Stream == batch on the same input; restarting from the checkpoint adds nothing."""

import datetime as dt
import os

from pyspark.sql import functions as F

from urbanflow.plans import feeds
from urbanflow.plans.catalog import events_stream, table
from urbanflow.operators.reports import windowed_summary
from urbanflow.sinks.parquet import read_partitioned
from urbanflow.streaming.ingest import parse_records, quarantined_rows, sound_rows, start_landing
from urbanflow.streaming.summary import start_summary, streaming_summary
from conftest import SF_SMALL

COLS = ["event_id", "user_id", "event_type", "value", "props", "event_ts", "year", "month", "day", "hour"]


def _land(spark, out, ckpt):
    parsed = parse_records(feeds.event_records(events_stream(spark, SF_SMALL)), feeds.EVENT_MESSAGE,
                           required=("event_id", "event_ts"))
    for q in start_landing(parsed, out, ckpt, trigger={"availableNow": True}):
        q.awaitTermination()
        assert q.exception() is None


def test_stream_equals_batch_and_restart_is_exactly_once(spark, tmp_dir):
    out, ckpt = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ckpt")
    _land(spark, out, ckpt)
    streamed = sound_rows(read_partitioned(spark, out)).select(*COLS)
    batch = parse_records(feeds.event_records(table(spark, SF_SMALL, "events")), feeds.EVENT_MESSAGE,
                          required=("event_id", "event_ts")).where("_valid").select(*COLS)
    assert streamed.count() == batch.count() == table(spark, SF_SMALL, "events").count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    n_files = sum(len(f) for _, _, f in os.walk(out))
    _land(spark, out, ckpt)  # restart: the checkpoint says everything is committed
    assert read_partitioned(spark, out).count() == batch.count()
    assert sum(len(f) for _, _, f in os.walk(out)) == n_files


def test_landing_layout_is_hive_partitioned_by_event_hour(spark, tmp_dir):
    out, ckpt = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ckpt")
    _land(spark, out, ckpt)
    assert [d for d in os.listdir(out) if not d.startswith(("_", "."))] == ["valid=true"]
    years = [d for d in os.listdir(os.path.join(out, "valid=true")) if d.startswith("year=")]
    assert years == ["year=2024"]
    day1 = os.path.join(out, "valid=true", "year=2024", "month=1", "day=1")
    assert sorted(os.listdir(day1))[0] == "hour=0"


def test_streaming_summary_with_watermark_matches_batch(spark, tmp_dir):
    schema = "ts timestamp_ntz, g string, v double"
    src = os.path.join(tmp_dir, "src")
    rows = [(dt.datetime(2025, 7, 2, h, m), g, float(h * 10 + m)) for h in range(3) for m in (0, 30) for g in "ab"]
    spark.createDataFrame(rows, schema).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    # the watermark closes a window only after later data arrives: append a far-future row
    late = os.path.join(tmp_dir, "src2")
    spark.createDataFrame([(dt.datetime(2025, 7, 9, 0, 0), "a", 0.0)], schema).write.parquet(late)
    both = stream.unionByName(spark.readStream.schema(schema).parquet(late))
    out = os.path.join(tmp_dir, "summary")
    q = start_summary(streaming_summary(both, "ts", ["g"], "v", "1 hour", "1 hour"), out,
                      os.path.join(tmp_dir, "ck"), {"availableNow": True})
    q.awaitTermination()
    got = spark.read.parquet(out).filter(F.col("window_start") < "2025-07-03")
    want = windowed_summary(spark.createDataFrame(rows, schema), "ts", ["g"], "v", "1 hour")
    assert got.count() == 6
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_rebalanced_landing_equals_file_sink(spark, tmp_dir):
    from urbanflow.streaming.ingest import write_landing_batch
    out_a, out_b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    _land(spark, out_a, os.path.join(tmp_dir, "ck_a"))
    parsed = parse_records(feeds.event_records(events_stream(spark, SF_SMALL)), feeds.EVENT_MESSAGE,
                           required=("event_id", "event_ts"))
    for q in start_landing(parsed, out_b, os.path.join(tmp_dir, "ck_b"), trigger={"availableNow": True},
                           mode="rebalanced"):
        q.awaitTermination()
        assert q.exception() is None
    a = sound_rows(read_partitioned(spark, out_a)).select(*COLS)
    b = sound_rows(read_partitioned(spark, out_b)).select(*COLS)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # a replayed batch overwrites its own directory: still no duplicates
    query = [d for d in os.listdir(out_b) if d.startswith("query_id=")][0]
    batch0 = read_partitioned(spark, os.path.join(out_b, query, "batch_id=0"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    kept = batch0.persist()
    n = kept.count()
    write_landing_batch(kept, 0, out_b, ["valid", "year", "month", "day", "hour"], query)
    assert n and read_partitioned(spark, out_b).count() == a.count()
    # a second query on the same output, with a new checkpoint, adds to it and overwrites nothing
    for q in start_landing(parsed, out_b, os.path.join(tmp_dir, "ck_c"), trigger={"availableNow": True},
                           mode="rebalanced"):
        q.awaitTermination()
        assert q.exception() is None
    assert read_partitioned(spark, out_b).count() == 2 * a.count()


def test_bad_rows_land_with_the_good_ones(spark, tmp_dir):
    """One query, one commit: every record that is not empty is in one side or the other."""
    events = events_stream(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "messy")
    parsed = parse_records(feeds.messy_records(events), feeds.EVENT_MESSAGE, required=("event_id", "event_ts"))
    queries = start_landing(parsed, out, os.path.join(tmp_dir, "ck"), trigger={"availableNow": True})
    assert len(queries) == 1
    queries[0].awaitTermination()
    landed = read_partitioned(spark, out)
    batch = parse_records(feeds.messy_records(table(spark, SF_SMALL, "events")), feeds.EVENT_MESSAGE,
                          required=("event_id", "event_ts"))
    good, bad = batch.where("_valid").count(), batch.where("not _valid").count()
    assert bad and (sound_rows(landed).count(), quarantined_rows(landed).count()) == (good, bad)
    assert quarantined_rows(landed).where("raw_value is null").count() == 0
    assert landed.where("valid = 'true' and raw_value is not null").count() == 0
