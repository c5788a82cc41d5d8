"""Resends, interval joins of two feeds, payloads without a schema, runs of offsets, epochs that are no time."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from urbanflow.functions.timeparts import epoch_seconds_to_time
from urbanflow.operators.discovery import payload_paths, topic_schemas, typed_columns, typed_fields
from urbanflow.operators.offsets import offset_completeness, offset_islands
from urbanflow.plans import feeds
from urbanflow.plans.inputs import arriving, table
from urbanflow.schemas import PM
from urbanflow.sinks.parquet import read_partitioned
from urbanflow.streaming.dedup import deduplicated
from urbanflow.streaming.fusion import interval_join, start_fusion
from urbanflow.streaming.ingest import parse_records, quarantined_rows, sound_rows, start_landing
from urbanflow.streaming.watermark import state_report, watermark_time
from conftest import SF_SMALL, rows

ONCE = {"availableNow": True}
T0 = dt.datetime(2025, 7, 2)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def hours(n):
    return T0 + dt.timedelta(hours=n)


def batches(spark, tmp_dir, name, schema, *parts):
    """The parts as a stream's successive spans."""
    path = os.path.join(tmp_dir, name)
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        yield spark.readStream.schema(schema).parquet(path)


# ---------------------------------------------------------------- epochs

def test_epochs_that_are_no_time_are_null(spark):
    bad = [float("nan"), float("inf"), -float("inf"), 1e14, 1.7e12, 1.7e18, 1e300, -1e300, 253402300800.0, -62135596801.0, None]
    df = spark.createDataFrame([(b,) for b in bad], "s double")
    assert rows(df.select(epoch_seconds_to_time("s"))) == [(None,)] * len(bad)
    edge = spark.createDataFrame([(-62135596800.0,), (0.0,), (1.5,), (253402300799.0,)], "s double")
    assert rows(edge.select(epoch_seconds_to_time("s"))) == [
        (dt.datetime(1, 1, 1),), (dt.datetime(1970, 1, 1),), (dt.datetime(1970, 1, 1, 0, 0, 1, 500000),), (dt.datetime(9999, 12, 31, 23, 59, 59),)]
    assert rows(spark.createDataFrame([(7,)], "s long").select(epoch_seconds_to_time("s"))) == [(dt.datetime(1970, 1, 1, 0, 0, 7),)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_pm_stream_survives_bad_epochs_and_a_restart(spark, tmp_dir, ansi):
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"

    def record(i, stamp):
        return (None, f'{{"station":"a","timestamp":{stamp},"pm10":1,"pm25":2,"counter":{i}}}'.encode(), "pm", 0, i, hours(i), 0)

    first = [record(0, 1751414400), record(1, "NaN"), record(2, "1e14"), record(3, "1.7e18")]
    second = [record(4, 1751414401.5), record(5, "1e300"), record(6, '"soon"'), record(7, "-Infinity")]
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for stream in batches(spark, tmp_dir, "in", schema, first, second):
            for q in start_landing(parse_records(stream, PM, required=("station", "event_ts")), out, ckpt, trigger=ONCE):
                finish(q)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    landed = read_partitioned(spark, out)
    assert sorted(rows(sound_rows(landed).select("counter", "event_ts"))) == [
        (0, dt.datetime(2025, 7, 2)), (4, dt.datetime(2025, 7, 2, 0, 0, 1, 500000))]
    assert sorted(r[0] for r in rows(quarantined_rows(landed).select("kafka_offset"))) == [1, 2, 3, 5, 6, 7]


# ---------------------------------------------------------------- resends

def test_resends_go_by_state_or_as_late_and_state_stays_bounded(spark, tmp_dir):
    events = table(spark, SF_SMALL, "events")
    sent = feeds.resent_records(events)
    out, reports = os.path.join(tmp_dir, "out"), []
    for stream in arriving(sent, os.path.join(tmp_dir, "in"), 3):
        parsed = parse_records(stream, feeds.EVENT_MESSAGE, required=("event_id", "event_ts"))
        (q,) = start_landing(deduplicated(parsed, ["event_id"]), out, os.path.join(tmp_dir, "ckpt"), partition_cols=(), trigger=ONCE)
        reports.append(state_report(finish(q)))
    landed = sound_rows(read_partitioned(spark, out))
    assert landed.count() == landed.select("event_id").distinct().count() == events.count() < sent.count()
    every = [r for report in reports for r in report]
    copies, late = sum(r["dropped_copies"] for r in every), sum(r["late_rows"] for r in every)
    assert copies > 0 and late > 0 and copies + late == sent.count() - events.count()
    last = reports[-1][-1]["state_rows"]
    # the keys of one delay behind the watermark, which is one delay behind the newest event
    recent = events.where(F.col("ts") >= events.agg(F.max("ts")).first()[0] - F.expr("INTERVAL 144 HOURS")).count()
    assert 0 < last <= recent < events.count() / 2


def test_hot_message_null_ids_and_clocks_that_run_ahead(spark, tmp_dir):
    schema = "id string, event_ts timestamp_ntz, kafka_timestamp timestamp, kafka_topic string, kafka_partition int, kafka_offset long"

    def row(id_, offset, event, arrival):
        return id_, event, arrival, "t", 0, offset

    hot = [row("hot", i, hours(0), hours(1)) for i in range(40)]
    bad = [row(None, 100 + i, None, hours(1)) for i in range(5)]
    future = [row("future", 200, dt.datetime(9000, 1, 1), hours(1)), row("a", 201, hours(0), hours(1)), row("a", 202, hours(0), hours(1))]
    second = [row("b", 300, hours(2), hours(3)), row("hot", 301, hours(0), hours(3)), row("future", 302, dt.datetime(9000, 1, 1), hours(3)),
              row(None, 303, None, None)]
    got = []
    for stream in batches(spark, tmp_dir, "in", schema, hot + bad + future, second):
        once = deduplicated(stream, ["id"])
        assert once.columns == [f.split()[0] for f in schema.split(", ")]
        q = once.writeStream.format("parquet").option("path", os.path.join(tmp_dir, "out")).option(
            "checkpointLocation", os.path.join(tmp_dir, "ckpt")).trigger(**ONCE).start()
        finish(q)
        got = rows(spark.read.parquet(os.path.join(tmp_dir, "out")).select("id", "kafka_offset"))
    ids = [i for i, _ in got]
    # the far future did not move the watermark: b is not late, though it comes later with an ordinary time
    assert sorted(i for i in ids if i) == ["a", "b", "future", "hot"]
    assert {o for i, o in got if i is None} >= {100, 101, 102, 103, 104}


def test_watermark_time(spark):
    df = spark.createDataFrame([(hours(0), hours(1)), (hours(9), hours(1)), (None, hours(1)), (hours(0), None), (None, None)],
                               "e timestamp_ntz, a timestamp")
    assert rows(df.select(watermark_time(df, "e", "a").cast("timestamp_ntz"))) == [(hours(0),), (hours(2),), (hours(1),), (hours(0),), (None,)]


def test_dedup_with_an_empty_source(spark, tmp_dir):
    stream = next(batches(spark, tmp_dir, "in", "id long, event_ts timestamp_ntz", []))
    out = deduplicated(stream, ["id"], arrival=None, position=())
    finish(out.writeStream.format("parquet").option("path", os.path.join(tmp_dir, "out")).option(
        "checkpointLocation", os.path.join(tmp_dir, "ckpt")).trigger(**ONCE).start())
    assert not [f for f in os.listdir(os.path.join(tmp_dir, "out")) if f.endswith(".parquet")] or spark.read.parquet(os.path.join(tmp_dir, "out")).count() == 0


# ---------------------------------------------------------------- fusion

LEFT, RIGHT = "k string, l int, lt timestamp_ntz", "k string, r int, rt timestamp_ntz"


def pairs(left, right, before, after, how="left"):
    out = []
    for k, l, lt in left:
        if lt is None:
            continue
        near = [(r, rt) for rk, r, rt in right if rk == k is not None and rt is not None
                and lt - dt.timedelta(hours=before) <= rt <= lt + dt.timedelta(hours=after)]
        out += [(k, l, lt, r, rt) for r, rt in near] or ([(k, l, lt, None, None)] if how == "left" else [])
    return sorted(out, key=repr)


def sides(n, hot=1 / 3, seed=1):
    rng = random.Random(seed)

    def side():
        return [("hot" if rng.random() < hot else rng.choice(["a", "b", "c", None]), i, hours(rng.randrange(0, 400) / 4) if rng.random() < 0.95 else None)
                for i in range(n)]
    return side(), side()


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("salts", [1, 3])
def test_batch_interval_join_with_a_hot_key(spark, how, salts):
    left, right = sides(150)
    got = interval_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "lt", "rt", "2 hours", "5 hours", how, salts=salts)
    assert got.columns == ["k", "l", "lt", "r", "rt"]
    assert sorted(rows(got), key=repr) == pairs(left, right, 2, 5, how)
    assert "CartesianProduct" not in plan(got) and "BroadcastNestedLoopJoin" not in plan(got)


@pytest.mark.parametrize("salts", [1, 2])
def test_stream_join_equals_batch_over_restarts(spark, tmp_dir, salts):
    left, right = sides(90, seed=2)
    spans = [(lambda t, i=i: t is not None and i * 40 <= (t - T0).total_seconds() / 3600 < i * 40 + 40) for i in range(3)]
    end = [("end", -1, hours(1000))]
    ls = batches(spark, tmp_dir, "l", LEFT, *[[r for r in left if s(r[2])] for s in spans], end)
    rs = batches(spark, tmp_dir, "r", RIGHT, *[[r for r in right if s(r[2])] for s in spans], end)
    sizes = []
    for l, r in zip(ls, rs):
        fused = interval_join(l, r, ["k"], "lt", "rt", "2 hours", "5 hours", delay="1 hour", salts=salts)
        q = finish(start_fusion(fused, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"), ONCE))
        sizes.append(state_report(q)[-1]["state_rows"])
    got = [r for r in rows(spark.read.parquet(os.path.join(tmp_dir, "out"))) if r[1] >= 0]
    assert sorted(got, key=repr) == pairs(left, right, 2, 5)
    assert 0 < max(sizes) < (1 + salts) * 90 and sizes[-1] <= 1 + salts  # only the closing rows are left


def test_fusion_refuses_clashing_names_and_other_joins(spark):
    left, right = spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)
    with pytest.raises(ValueError):
        interval_join(left, right.withColumnRenamed("r", "l"), ["k"], "lt", "rt", "1 hour", "1 hour")
    with pytest.raises(ValueError):
        interval_join(left, right, ["k"], "lt", "rt", "1 hour", "1 hour", "full")
    assert interval_join(left, right, ["k"], "lt", "rt", "1 hour", "1 hour").count() == 0


# ---------------------------------------------------------------- discovery

def walk(v, path="$"):
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}[type(v)]
    yield path, kind
    for k, x in (v.items() if isinstance(v, dict) else ()):
        yield from walk(x, f"{path}.{k}")
    for x in (v if isinstance(v, list) else ()):
        yield from walk(x, f"{path}[*]")


def random_json(rng, depth):
    if depth == 0 or rng.random() < 0.4:
        return rng.choice([None, True, 7, 2.5, "x", "", -1])
    if rng.random() < 0.5:
        return {k: random_json(rng, depth - 1) for k in rng.sample(["a", "b", "c d", "é"], rng.randrange(4))}
    return [random_json(rng, depth - 1) for _ in range(rng.randrange(3))]


@pytest.mark.parametrize("levels", [1, 6])
def test_paths_of_any_document_at_any_depth(spark, levels):
    rng = random.Random(levels)
    docs = [(rng.choice(["hot", "hot", "a", None]), json.dumps(random_json(rng, 9))) for _ in range(120)]
    docs += [("a", None), ("a", "nope"), ("a", "{"), (None, ""), ("deep", "[" * 20 + "1" + "]" * 20)]
    want = {}
    for topic, text in docs:
        try:
            found = [("$", "missing")] if text is None else list(walk(json.loads(text)))
        except ValueError:
            found = [("$", "invalid")]
        for path, kind in found:
            want[topic, path, kind] = want.get((topic, path, kind), 0) + 1
    got = payload_paths(spark.createDataFrame(docs, "topic string, value string"), levels=levels)
    assert {tuple(r)[:3]: r["n"] for r in got.collect()} == want
    assert payload_paths(spark.createDataFrame([], "topic string, value binary")).count() == 0


def test_typed_landing_loses_nothing(spark):
    docs = ['{"i":1,"n":2.5,"s":"x","b":true,"o":{"q":[1]},"mix":1}', '{"i":null,"n":1e300,"mix":"one","big":123456789012345678901234567890}',
            '{"s":"","mix":{"z":0},"q\'s":1}', "[1]", "null"]
    df = spark.createDataFrame([("t", d, i) for i, d in enumerate(docs)], "topic string, value string, i2 int")
    fields = typed_fields(payload_paths(df).collect(), "t")
    assert fields == {"i": "bigint", "n": "double", "s": "string", "b": "boolean", "o": "json", "mix": "json", "big": "json", "q's": "bigint"}
    del fields["q's"]
    got = {r["i2"]: r.asDict() for r in typed_columns(df, fields, keep=["i2"]).collect()}
    assert got[0] == {"i2": 0, "i": 1, "n": 2.5, "s": "x", "b": True, "o": '{"q":[1]}', "mix": "1", "big": None}
    assert got[1]["big"] == "123456789012345678901234567890" and got[1]["mix"] == '"one"' and got[1]["n"] == 1e300
    assert got[2]["mix"] == '{"z":0}' and all(v is None for k, v in got[3].items() if k != "i2")
    schema = topic_schemas(df).first()["schema"]
    assert "mix: VARIANT" in schema or schema == "VARIANT"


def test_discovery_reads_once_and_adds_up_before_the_shuffle(spark):
    from urbanflow.operators.discovery import _nodes
    txt = plan(_nodes(feeds.untyped_records(table(spark, SF_SMALL, "events")), "topic", "value", 4))
    assert txt.count("FileScan") == 1 and txt.count("Exchange hashpartitioning") == 1 and "partial_count" in txt
    assert txt.count("parseJson") == 1


# ---------------------------------------------------------------- offsets

def islands(found):
    out, by = [], {}
    for t, p, o in found:
        if o is not None:
            by.setdefault((t, p), []).append(o)
    for (t, p), offsets in by.items():
        offsets.sort()
        runs = [[offsets[0]]]
        for o in offsets[1:]:
            runs[-1].append(o) if o <= runs[-1][-1] + 1 else runs.append([o])
        for i, r in enumerate(runs):
            out.append((t, p, r[0], r[-1], len(r), r[0] - runs[i - 1][-1] - 1 if i else 0, len(r) - len(set(r))))
    return sorted(out, key=repr)


def test_offset_runs_with_a_hot_topic_nulls_and_repeats(spark):
    rng = random.Random(3)
    found = [("hot", 0, rng.randrange(-50, 900)) for _ in range(1000)] + [(rng.choice(["a", None]), rng.choice([0, 1, None]), rng.randrange(60)) for _ in range(300)]
    found += [("hot", 0, 5)] * 300 + [("a", 0, None), ("one", 3, 7)]
    rng.shuffle(found)
    got = offset_islands(spark.createDataFrame(found, "topic string, partition int, offset long"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == islands(found)
    whole = {(r["topic"], r["partition"]): r for r in offset_completeness(got).collect()}
    hot = [o for t, p, o in found if t == "hot"]
    r = whole["hot", 0]
    assert (r["first"], r["last"], r["rows"]) == (min(hot), max(hot), len(hot))
    assert r["missing"] == max(hot) - min(hot) + 1 - len(set(hot)) and r["repeated"] == len(hot) - len(set(hot))
    assert offset_islands(spark.createDataFrame([], "topic string, partition int, offset long")).count() == 0


def test_no_window_over_the_rows_of_a_topic(spark):
    """Runs are found without a window that holds a topic: the only one runs over (topic, range) rows, inside the ranks."""
    got = offset_islands(feeds.offset_records(table(spark, SF_SMALL, "events")))
    assert "Window" not in plan(got)  # the ranks are written; what is left is a join by rank
    assert "SortMergeJoin" in plan(got) or "BroadcastHashJoin" in plan(got)
