"""Sketches, sessions, numbers on a stream, folder drops, type counts, kept summaries, ridge folds, filled series."""

import datetime as dt
import math
import os
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflow.operators.increment import add_load, merged_hours, partial_hours, read_summary
from urbanflow.operators.lattice import column_types, kind_counts, merged_counts
from urbanflow.operators.model import fold_sums, ridge, ridge_cv
from urbanflow.operators.reports import windowed_summary
from urbanflow.operators.series import filled_series, hourly_series
from urbanflow.operators.sessions import sessions
from urbanflow.operators.sketches import HLL_ERROR, KLL_ERROR, column_sketches, merged_sketches, sketch_estimates
from urbanflow.plans.inputs import arriving, run_available_now, table
from urbanflow.sinks.parquet import read_partitioned
from urbanflow.streaming import numbering
from urbanflow.streaming.drops import dataset_of, header_of, load_files, load_new_files, read_loaded
from urbanflow.streaming.numbering import number_batch, read_numbered, start_numbering
from conftest import SF_SMALL, rows

T0 = dt.datetime(2025, 7, 2)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


# ---------------------------------------------------------------- sketches

def test_merged_sketches_are_within_their_bounds_with_a_hot_partition(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 else f"p{i % 50}", rng.gauss(0, 100), rng.randrange(5000) if i % 11 else None, f"s{i % 3000}") for i in range(20_000)]
    df = spark.createDataFrame(data, "part string, x double, k long, s string").repartition(7)
    stored = column_sketches(df, ["x", "k", "s"], ["part"])
    got = {r["column_name"]: r for r in sketch_estimates(merged_sketches(stored), [0.1, 0.5, 0.9]).collect()}
    for c, at in (("x", 1), ("k", 2), ("s", 3)):
        values = [d[at] for d in data if d[at] is not None]
        assert got[c]["n_rows"] == len(data) and got[c]["n_null"] == len(data) - len(values)
        assert abs(got[c]["n_distinct"] - len(set(values))) <= HLL_ERROR * len(set(values))
        if c == "s":
            assert got[c]["quantiles"] is None
            continue
        for p, v in zip((0.1, 0.5, 0.9), got[c]["quantiles"]):
            below, upto = (sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values))
            assert below <= p + KLL_ERROR and upto >= p - KLL_ERROR
    one = sketch_estimates(stored.where("part = 'hot' and column_name = 'k'")).first()
    assert abs(one["n_distinct"] - len({d[2] for d in data if d[0] == "hot" and d[2] is not None})) <= HLL_ERROR * 5000


def test_sketches_of_odd_values(spark):
    df = spark.createDataFrame([(0.0, None), (-0.0, None), (float("nan"), None), (None, None), (math.inf, None)], "x double, e long")
    got = {r["column_name"]: r for r in sketch_estimates(merged_sketches(column_sketches(df, ["x", "e"])), [0.5]).collect()}
    assert (got["x"]["n_null"], got["x"]["n_distinct"], got["x"]["quantiles"]) == (1, 3, [0.0])
    assert (got["e"]["n_null"], got["e"]["n_distinct"], got["e"]["quantiles"]) == (5, 0, None)
    assert column_sketches(df.limit(0), ["x"], ["e"]).count() == 0


def test_sketches_take_one_scan_and_merge_from_storage_alone(spark, tmp_dir):
    li = table(spark, SF_SMALL, "lineitem")
    built = column_sketches(li, ["l_quantity", "l_partkey"], ["l_returnflag"])
    assert plan(built).count("FileScan") == 1 and "partial_hll_sketch_agg" in plan(built)
    built.write.parquet(tmp_dir + "/s")
    merged = plan(merged_sketches(spark.read.parquet(tmp_dir + "/s")))
    assert "lineitem" not in merged and "partial_hll_union_agg" in merged and "partial_kll_merge_agg_double" in merged


# ---------------------------------------------------------------- sessions

def spells(found, gap):
    out, by = [], {}
    for k, t, v in found:
        if t is not None:
            by.setdefault(k, []).append((t, v))
    for k, seen in by.items():
        seen.sort(key=lambda r: r[0])
        runs = [[seen[0]]]
        for r in seen[1:]:
            runs[-1].append(r) if (r[0] - runs[-1][-1][0]).total_seconds() <= gap else runs.append([r])
        for r in runs:
            values = [v for _, v in r if v is not None]
            out.append((k, r[0][0], r[-1][0], r[-1][0] + dt.timedelta(seconds=gap), len(r), min(values, default=None), max(values, default=None)))
    return sorted(out, key=repr)


def test_sessions_with_a_hot_key_nulls_and_rows_exactly_a_gap_apart(spark):
    rng = random.Random(2)
    found = [(rng.choice(["hot", "hot", "a", "b", None]), minutes(rng.randrange(4000)), rng.choice([1.5, -2.0, None])) for _ in range(600)]
    found += [("edge", minutes(0), 1.0), ("edge", minutes(30), 2.0), ("edge", minutes(59), 3.0), ("a", None, 1.0)]
    got = sessions(spark.createDataFrame(found, "k string, ts timestamp_ntz, v double").repartition(5), ["k"], "ts", 1800, "v")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == spells(found, 1800)
    empty = spark.createDataFrame([], "k string, ts timestamp_ntz, v double")
    assert sessions(empty, ["k"], "ts", 1800, "v").count() == 0


def test_a_hot_key_is_added_up_before_the_shuffle(spark):
    hot = spark.createDataFrame([("hot", minutes(i % 100), 1.0) for i in range(5000)], "k string, ts timestamp_ntz, v double").repartition(4)
    txt = plan(sessions(hot, ["k"], "ts", 3600, "v"))
    assert txt.index("partial_max(_at") > txt.index("Exchange") and "SortMergeJoin" not in txt


def test_session_stream_equals_batch_where_closed(spark, tmp_dir):
    rng = random.Random(3)
    found = [(rng.choice("ab"), minutes(rng.randrange(3000)), float(i)) for i in range(200)] + [("end", minutes(100_000), 0.0)]
    df = spark.createDataFrame(found, "k string, ts timestamp_ntz, v double").withColumn("timestamp", F.col("ts").cast("timestamp"))
    for stream in arriving(df, tmp_dir + "/in", 3):
        q = sessions(stream, ["k"], "ts", 1800, "v", "1 hour").writeStream.format("parquet").option("path", tmp_dir + "/out").option(
            "checkpointLocation", tmp_dir + "/ckpt").trigger(availableNow=True).start()
        run_available_now([q])
    got = sorted((tuple(r) for r in spark.read.parquet(tmp_dir + "/out").collect()), key=repr)
    assert got == [s for s in spells(found, 1800) if s[0] != "end"]


# ---------------------------------------------------------------- numbers on a stream

def test_numbers_survive_replays_and_snapshots(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(numbering, "SNAPSHOT", 3)
    rng = random.Random(4)
    data = [(rng.choice(["hot", "hot", "a", "b", None]), i) for i in range(300)]
    parts = [data[i * 30:i * 30 + 30] for i in range(10)]
    parts[4], parts[5] = [(k, i) for k, i in parts[4] if k == "hot"], parts[5] + [(k, i) for k, i in parts[4] if k != "hot"]
    out, ledger = tmp_dir + "/out", tmp_dir + "/ledger"
    for b, part in enumerate(parts):
        frame = spark.createDataFrame(part, "k string, i long").repartition(3)
        number_batch(frame, b, out, ledger, ["k"], ["i"])
        if b % 4 == 2:  # the commit was lost: the same batch again
            number_batch(frame, b, out, ledger, ["k"], ["i"])
    want, counts = {}, {}
    for part in parts:
        for k, i in sorted(part, key=lambda r: r[1]):
            want[i] = counts.get(k, 0)
            counts[k] = want[i] + 1
    assert {r["i"]: r["message_number"] for r in read_numbered(spark, out).collect()} == want
    assert read_numbered(spark, out).count() == len(want)
    paths = numbering._existing(spark, ledger, 6, 9)
    assert len(paths) == 4 and len(numbering.counts_before(spark, ledger, 10, [spark.createDataFrame([], "k string").schema[0]]).collect()) == 4


def test_numbering_stream_without_rows(spark, tmp_dir):
    stream = next(arriving(spark.createDataFrame([], "k string, timestamp timestamp"), tmp_dir + "/in", 1))
    run_available_now([start_numbering(stream, tmp_dir + "/out", tmp_dir + "/ledger", tmp_dir + "/ckpt", ["k"], ["timestamp"], {"availableNow": True})])
    assert not os.path.exists(tmp_dir + "/out") or read_numbered(spark, tmp_dir + "/out").count() == 0


# ---------------------------------------------------------------- folder drops

def test_each_file_is_loaded_once_whatever_its_columns(spark, tmp_dir):
    folder, out, ckpt = tmp_dir + "/in", tmp_dir + "/out", tmp_dir + "/ckpt"
    os.makedirs(folder)

    def put(name, text):
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write(text)

    def run():
        run_available_now([load_new_files(spark, folder, out, ckpt, {"a": spark.createDataFrame([], "id int, v double").schema}, max_files=2)])
        return sorted(rows(read_loaded(spark, out, "a").select("id", "source_file")))

    put("a.csv", "﻿id,v\n1,1.5\n2,x\n")
    put("empty.csv", "")
    put("b.csv", "k\n02\n")
    put("note.txt", "id\n9\n")
    assert run() == [(1, "a.csv"), (2, "a.csv")]
    put("a.2.csv", "id,v,more\n3,2.5,yes\n")
    put("a.3.csv", "more,id\nno,4\n")
    put("a.4.csv", "id,v\n")
    assert run() == run() == [(1, "a.csv"), (2, "a.csv"), (3, "a.2.csv"), (4, "a.3.csv")]
    got = {r["id"]: r for r in read_loaded(spark, out, "a").collect()}
    assert (got[3]["v"], got[3]["more"], got[4]["more"], got[4]["v"], got[1]["more"]) == (2.5, "yes", "no", None, None)
    assert got[2]["_corrupt_row"] == "2,x" and got[1]["_corrupt_row"] is None
    assert rows(read_loaded(spark, out, "b").select("k")) == [("02",)]


def test_a_replayed_load_replaces_its_own_files(spark, tmp_dir):
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write("id\n1\n")
    for _ in range(2):
        load_files(spark, [f"{tmp_dir}/x.csv"], tmp_dir + "/out", "query_id=q/batch_id=0", {}, ",")
    assert read_loaded(spark, tmp_dir + "/out", "x").count() == 1
    assert header_of(spark, f"{tmp_dir}/x.csv", ",") == ("id",)
    assert [dataset_of(p) for p in ("/d/x.csv", "/d/x.2024.csv", "/d/x.csv/part-0.csv")] == ["x"] * 3


# ---------------------------------------------------------------- types of text

@pytest.mark.parametrize("values, kind, against", [
    (["1", "-2", "+3", "0"], "bigint", 0), (["1", "2.5", ".5", "1e-3", "4."], "double", 1), (["1", "02"], "string", 1),
    (["true", "False"], "boolean", 0), (["2024-01-31", "2024-02-01 10:00:00"], "timestamp_ntz", 1), (["2024-01-31"], "date", 0),
    (["2024-13-01"], "string", 0), (["1", "2", "3bis"], "string", 1), ([None, ""], "string", 0), (["1", "true"], "string", 1),
    (["12345678901234567890"], "double", 0), (["NaN"], "string", 0), ([" 1"], "string", 0)])
def test_least_type_above_all_values(spark, values, kind, against):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    r = column_types(kind_counts(df)).first()
    assert (r["type"], r["n_against"], r["n_null"]) == (kind, against, sum(not v for v in values))


def test_counts_of_loads_add_up_in_one_scan(spark, tmp_dir):
    rng = random.Random(5)
    data = [("hot" if i % 3 else "x", rng.choice(["1", "2.5", "a", None]), rng.choice(["2024-01-01", ""])) for i in range(500)]
    df = spark.createDataFrame(data, "f string, `a b` string, c string")
    by_file = kind_counts(df, by=["f"])
    assert sorted(map(tuple, column_types(merged_counts(by_file)).collect())) == sorted(map(tuple, column_types(kind_counts(df.drop("f"))).collect()))
    df.write.parquet(tmp_dir + "/t")
    txt = plan(kind_counts(spark.read.parquet(tmp_dir + "/t")))
    assert txt.count("FileScan") == 1 and "partial_count" in txt
    assert column_types(kind_counts(df.limit(0))).where("type = 'string' and n_rows = 0").count() == 3


# ---------------------------------------------------------------- kept summaries

def test_loads_with_late_rows_give_the_full_summary_and_touch_their_days(spark, tmp_dir):
    rng = random.Random(6)
    data = [(minutes(rng.randrange(5 * 1440)), "hot" if i % 3 else rng.choice(["a", None]),
             rng.choice([1.25, 2.5, None, 1e30, float("nan")] if i % 50 == 0 else [1.25, -2.5, None])) for i in range(900)] + [(None, "a", 1.0)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, g string, v double")
    state, summary = tmp_dir + "/state", tmp_dir + "/summary"
    early, late = df.where("ts < '2025-07-05' or ts is null"), df.where("ts >= '2025-07-05'")
    assert add_load(early, 0, state, summary, "ts", ["g"], "v") == [dt.date(2025, 7, d) for d in (2, 3, 4)]
    before = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(summary) for f in fs if "day=2025-07-03" in d}
    more = spark.createDataFrame([(minutes(5), "hot", 7.0)], df.schema)
    for _ in range(2):  # the second time is a repeated load
        assert add_load(late.union(more), 1, state, summary, "ts", ["g"], "v") == [dt.date(2025, 7, d) for d in (2, 5, 6)]
    want = windowed_summary(df.union(more).where("ts is not null"), "ts", ["g"], "v").collect()
    got = read_summary(spark, summary)
    got_rows = got.select("window_start", "window_end", "g", "n", "min_value", "max_value", "mean_value").collect()
    assert sorted(repr(tuple(r)) for r in got_rows) == sorted(repr(tuple(r)) for r in want)  # NaN equals NaN here
    assert got.where("loads = 2").count() == 1
    assert before == {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(summary) for f in fs if "day=2025-07-03" in d}
    assert add_load(df.limit(0), 2, state, summary, "ts", ["g"], "v") == []


def test_partials_add_up_before_the_shuffle(spark):
    e = table(spark, SF_SMALL, "events")
    assert "partial_count" in plan(partial_hours(e, "ts", ["event_type"], "value"))
    part = partial_hours(e, "ts", ["event_type"], "value").withColumn("load", F.lit(0))
    full = windowed_summary(e, "ts", ["event_type"], "value")
    assert merged_hours(part, ["event_type"]).drop("loads").exceptAll(full.select("window_start", "window_end", "event_type", "n", "min_value", "max_value", "mean_value")).count() == 0


# ---------------------------------------------------------------- ridge

def test_errors_equal_a_fit_on_the_other_folds(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 3)) * [1, 50, 0.01] + [1000, -3, 7]
    y = x @ [2.0, -0.5, 90.0] + rng.normal(size=300) + 1e6
    fold = np.where(rng.random(300) < 1 / 3, 0, rng.integers(1, 4, 300))
    data = [(int(f), *map(float, a), float(b)) for f, a, b in zip(fold, x, y)]
    data += [(None, 1.0, 1.0, 1.0, 1.0), (1, None, 1.0, 1.0, 1.0), (2, float("nan"), 1.0, 1.0, 1.0), (2, 1.0, float("inf"), 1.0, 1.0)]
    df = spark.createDataFrame(data, "fold int, a double, b double, c double, y double").repartition(4)
    for r in ridge_cv(df, ["a", "b", "c"], "y", "fold", [0.0, 0.5]).collect():
        out = fold == r["fold"]
        m, ym = x[~out].mean(axis=0), y[~out].mean()
        a = (x[~out] - m).T @ (x[~out] - m) / (~out).sum() + r["penalty"] * np.eye(3)
        w = np.linalg.solve(a, (x[~out] - m).T @ (y[~out] - ym) / (~out).sum())
        assert r["n"] == out.sum()
        assert abs(r["rmse"] - np.sqrt(np.mean((y[out] - ym - (x[out] - m) @ w) ** 2))) < 1e-6 * r["rmse"]
    txt = plan(df.groupBy("fold").agg(F.sum("a")))
    assert "partial_sum" in txt


def test_ridge_edges(spark):
    empty = spark.createDataFrame([], "fold int, a double, y double")
    assert ridge_cv(empty, ["a"], "y", "fold", [1.0]).count() == 0
    one = spark.createDataFrame([(0, 1.0, 2.0), (0, 2.0, 3.0)], "fold int, a double, y double")
    assert ridge_cv(one, ["a"], "y", "fold", [1.0]).count() == 0
    flat = spark.createDataFrame([(i % 2, 5.0, float(i)) for i in range(6)], "fold int, a double, y double")
    assert all(math.isfinite(r["rmse"]) for r in ridge_cv(flat, ["a"], "y", "fold", [0.0]).collect())
    _, sums = fold_sums(flat, ["a"], "y", "fold")
    assert ridge(sum(sums.values()), 1.0)[1] == 0.0


# ---------------------------------------------------------------- filled series

def fill(found):
    out = []
    by = {}
    for r in found:
        by.setdefault(r[0], []).append(r)
    for g, seen in by.items():
        timed = sorted((r for r in seen if r[1] is not None), key=lambda r: (r[1], r[2] is not None, r[2] or 0))
        for i, (_, t, v) in enumerate(timed):
            last = next((r for r in reversed(timed[:i + 1]) if r[2] is not None), None)
            nxt = next((r for r in timed[i:] if r[2] is not None), None)
            line = v
            if v is None and last and nxt:
                span = (nxt[1] - last[1]).total_seconds()
                line = last[2] + (nxt[2] - last[2]) * ((t - last[1]).total_seconds() / span) if span else last[2]
            out.append((g, t, v, last[2] if last else None, line))
        out += [(*r, r[2], r[2]) for r in seen if r[1] is None]
    return out


@pytest.mark.parametrize("slices", [1, 7])
def test_gaps_are_filled_over_slice_borders(spark, slices):
    rng = random.Random(8)
    found = [(("hot", "hot", "a", None)[i % 4], minutes(rng.randrange(3000)), rng.choice([None, None, None, float(i)])) for i in range(500)]
    found += [("none", minutes(i), None) for i in range(40)] + [("hot", None, None), ("hot", None, 5.0), ("one", minutes(1), 2.0)]
    df = spark.createDataFrame(found, "g string, ts timestamp_ntz, v double").withColumn("_p", F.lit("own"))
    got = filled_series(df, ["g"], "ts", "v", slices).drop("_p").collect()

    def key(r):
        return repr([None if x is None else x if not isinstance(x, float) else round(x, 9) for x in r])
    assert sorted(map(key, got)) == sorted(map(key, fill(found)))
    assert filled_series(df.limit(0), ["g"], "ts", "v").count() == 0


def test_hot_group_lies_in_many_slices(spark):
    df = spark.createDataFrame([("hot", minutes(i), None if i % 5 else float(i)) for i in range(4000)], "g string, ts timestamp_ntz, v double")
    got = filled_series(df, ["g"], "ts", "v", 8)
    txt = plan(got)
    assert txt.count("Window [") == 2 and "_slice" in txt  # rows by (group, slice), ends by group
    back = [r for r in got.collect() if r["v"] is None and r["ts"] < minutes(3995)]
    assert all(abs(r["interpolated"] - (r["ts"] - T0).total_seconds() / 60) < 1e-9 for r in back) and len(back) == 3196


def test_hourly_series_has_every_hour_once(spark):
    df = spark.createDataFrame([("a", minutes(0), 1.0), ("a", minutes(10), 2.0), ("a", minutes(60 * 30), None), ("b", minutes(61), 4.0), ("b", None, 1.0)],
                               "g string, ts timestamp_ntz, v double")
    got = hourly_series(df, ["g"], "ts", "v").collect()
    a = sorted((r for r in got if r["g"] == "a"), key=lambda r: r["hour_start"])
    assert len(a) == 31 and [r["n"] for r in a] == [2] + [0] * 29 + [1] and a[0]["value"] == statistics.mean([1.0, 2.0]) and a[-1]["value"] is None
    assert [(r["hour_start"], r["n"], r["value"]) for r in got if r["g"] == "b"] == [(minutes(60), 1, 4.0)]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "Europe/Paris"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    from urbanflow.sources.spine import gap_filled_hourly_counts, hourly_spine
    at = [dt.datetime(2025, 3, 8, 23, 10), dt.datetime(2025, 3, 10, 4, 0), dt.datetime(2025, 3, 30, 1, 59), dt.datetime(2025, 3, 31, 3, 0)]  # DST
    df = spark.createDataFrame([("a", t, 1.0) for t in at], "g string, ts timestamp_ntz, v double")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = [filled_series(hourly_series(df, ["g"], "ts", "v"), ["g"], "hour_start", "value"), hourly_spine(df, "ts"), gap_filled_hourly_counts(df, "ts")]
        assert all(dict(g.dtypes)["hour_start"] == "timestamp_ntz" for g in got)
        hours = [sorted(r["hour_start"] for r in g.collect()) for g in got]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    first = at[0].replace(minute=0)
    assert hours[0] == hours[1] == hours[2] == [first + dt.timedelta(hours=i) for i in range(22 * 24 + 5)]


def test_state_folder_is_what_the_summary_reads(spark, tmp_dir):
    df = spark.createDataFrame([(minutes(1), "a", 1.0)], "ts timestamp_ntz, g string, v double")
    add_load(df, 0, tmp_dir + "/s", tmp_dir + "/m", "ts", ["g"], "v")
    assert read_partitioned(spark, tmp_dir + "/s").columns[-2:] == ["load", "day"]
