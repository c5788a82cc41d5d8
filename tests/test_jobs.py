"""End-to-end jobs on weather messages in the producer's full wire shape."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from urbanflow.config import FeedConfig, LakePaths
from urbanflow.plans import jobs
from urbanflow.schemas import KAFKA_RECORD, TRAFIC
from urbanflow.sources.dims import STATIONS
from urbanflow.streaming.ingest import quarantined_rows, sound_rows
from test_csv import write_fixture


def message(i, station, when):
    name, lat, lon, dept, zone, alt = station
    t = 10.0 + (i % 7)
    return {
        "reading_id": f"PAR-{i:08x}", "timestamp": when.isoformat() + "Z",
        "station": {"name": name, "coordinates": {"latitude": lat, "longitude": lon},
                    "department": dept, "zone": zone, "altitude_m": alt},
        "temperature": {"actual_c": t, "feels_like_c": t, "dew_point_c": t - 5, "urban_heat_island_effect": 0},
        "atmospheric": {"humidity_percent": 60 + i % 5, "pressure_hpa": 1000.0 + i % 9, "visibility_km": 20.0},
        "wind": {"speed_kmh": 5.0 + i % 11, "direction": "SW", "gust_kmh": 6.0},
        "precipitation": {"amount_mm": 0.0, "type": "none", "intensity": "light"},
        "conditions": {"weather": "cloudy", "description": "Cloudy", "uv_index": 1, "season": "summer"},
        "air_quality": {"overall_index": 2, "overall_description": "Moyen",
                        "pollutants": {"PM10": 20 + (i * 7) % 40, "PM2.5": 10, "NO2": 30, "O3": 50, "SO2": 3, "CO": 300}},
        "metadata": {"data_source": "network", "region": "IdF", "measurement_height_m": 2,
                     "quality_control": {"temperature_valid": True, "pressure_valid": True, "humidity_valid": True,
                                         "wind_valid": True, "precipitation_valid": True}},
        "thread_id": 0, "message_number": i, "processing_timestamp": "2025-07-02 12:00:00",
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    base = dt.datetime(2025, 7, 2, 8, 0)
    rows = []
    for i in range(120):
        st = STATIONS[i % len(STATIONS)]
        when = base + dt.timedelta(minutes=7 * i)
        rows.append((st[0].encode(), json.dumps(message(i, st, when)).encode(), "weather", 0, i,
                     dt.datetime(2025, 7, 2, 12, 0), 0))
    rows.append((b"x", b"not json", "weather", 0, 999, dt.datetime(2025, 7, 2, 12, 0), 0))
    sparse = {"reading_id": "PAR-sparse", "timestamp": "2025-07-02T09:00:00Z", "station": {"name": "Versailles"},
              "temperature": {"actual_c": 12.0}}
    rows.append((b"Versailles", json.dumps(sparse).encode(), "weather", 0, 1000, dt.datetime(2025, 7, 2, 12, 0), 0))
    src = os.path.join(root, "_src")
    spark.createDataFrame(rows, KAFKA_RECORD).write.parquet(src)
    paths = LakePaths(root)
    stream = spark.readStream.schema(KAFKA_RECORD).parquet(src)
    for q in jobs.weather_ingest(spark, FeedConfig(), paths, full_schema=True, trigger={"availableNow": True},
                                 source=stream):
        q.awaitTermination()
    traffic_dir = os.path.join(root, "_csv")
    jobs.batch_load(spark, [jobs.BatchDataset("trafic", write_fixture(traffic_dir), TRAFIC),
                            jobs.BatchDataset("air_quality", os.path.join(traffic_dir, "missing.csv"))],
                    paths, "20250702-1200").collect()
    return paths


def test_ingest_lands_valid_and_quarantines_bad(spark, lake):
    whole = spark.read.parquet(f"{lake.raw}/streaming/weather")
    landed = sound_rows(whole)
    assert landed.count() == 121 and quarantined_rows(whole).count() == 1
    assert landed.filter(F.col("station.altitude").isNull()).count() == 0
    sparse = landed.filter(F.col("reading_id") == "PAR-sparse").collect()[0]["station"]
    assert (sparse["zone"], sparse["department"], sparse["altitude"]) == ("Yvelines", "78", 132)
    assert sparse["coordinates"]["latitude"] == 48.8014
    report = {r["kafka_topic"]: r for r in jobs.weather_ingest_report(spark, lake).collect()}
    assert report["weather"]["n_valid"] == 121 and report["weather"]["n_quarantined"] == 1


def test_compaction_finds_changes_without_opening_files(spark, lake, tmp_path):
    seen = []
    table, out = f"{lake.raw}/streaming/weather", str(tmp_path / "compacted")
    reader = jobs.read_partitioned

    def watched(*a, **k):
        seen.append(a[1])
        return reader(*a, **k)
    jobs.read_partitioned = watched
    try:
        assert jobs.compact(spark, table, out) > 0 and seen == [table]
        assert jobs.compact(spark, table, out) == 0 and seen == [table]  # nothing changed: the rows are not looked at
    finally:
        jobs.read_partitioned = reader
    assert spark.read.parquet(out).count() == 121


def test_offset_report_and_dedup_job(spark, lake, tmp_path):
    (r,) = jobs.offset_report(spark, lake).collect()
    assert (r["topic"], r["partition"], r["first"], r["last"], r["rows"], r["missing"], r["runs"]) == ("weather", 0, 0, 1000, 122, 879, 2)
    now, src = dt.datetime(2025, 7, 2, 12, 0), str(tmp_path / "_src")
    value = json.dumps(message(1, STATIONS[0], now)).encode()
    sent = [(b"k", value, "weather", 0, i, now, 0) for i in range(3)] + [(b"k", b"junk", "weather", 0, 3 + i, now, 0) for i in range(2)]
    spark.createDataFrame(sent, KAFKA_RECORD).write.parquet(src)
    paths = LakePaths(str(tmp_path / "lake"))
    for q in jobs.weather_ingest(spark, FeedConfig(), paths, trigger={"availableNow": True}, dedup=True,
                                 source=spark.readStream.schema(KAFKA_RECORD).parquet(src)):
        q.awaitTermination()
        assert q.exception() is None
    landed = spark.read.parquet(f"{paths.raw}/streaming/weather")
    assert sound_rows(landed).count() == 1 and quarantined_rows(landed).count() == 2


def test_batch_load_reports_missing_dataset(spark, lake, tmp_path):
    status = jobs.batch_load(spark, [jobs.BatchDataset("nope", str(tmp_path / "absent.csv"), TRAFIC)], lake,
                             "2025-07-02").collect()[0]
    assert status["n_rows"] == 0 and status["status"].startswith("error")
    with pytest.raises(SystemExit):
        jobs._report(jobs.batch_load(spark, [jobs.BatchDataset("nope", str(tmp_path / "absent.csv"), TRAFIC)], lake,
                                     "2025-07-02"))
    t = spark.read.parquet(f"{lake.raw}/batch/trafic")
    assert t.count() == 5 and t.select("year", "month", "day").distinct().collect()[0] == (2025, 7, 2)


def test_summary_gold_and_model(spark, lake):
    s = jobs.weather_summary(spark, lake)
    assert s.agg(F.sum("n")).collect()[0][0] == 121
    gold = jobs.gold_weather_traffic(spark, lake)
    g = {(r["arrondissement"]): r for r in gold.collect()}
    assert set(g) <= set(range(1, 21)) and g[1]["yearly_traffic"] == 900 and g[20]["yearly_traffic"] == 800
    coefs = {r["term"] for r in jobs.train_pm(spark, lake).collect()}
    assert {"intercept", "temperature_c", "r2"} <= coefs
    assert os.path.isdir(f"{lake.gold}/models/pm10")


def test_compact_rewrites_partitions(spark, lake):
    out = f"{lake.curated}/weather"
    table = f"{lake.raw}/streaming/weather"
    good = sound_rows(spark.read.parquet(table))
    assert jobs.compact(spark, table, out, where="hour < 12") > 0
    assert spark.read.parquet(out).count() == good.filter("hour < 12").count()
    written = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(out) for f in fs}
    assert jobs.compact(spark, table, out, where="hour < 12") == 0  # nothing new: no file is rewritten
    assert {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(out) for f in fs} == written
    # late rows of one hour: that hour alone is rewritten, and has them
    copy = f"{lake.root}/late"
    spark.read.parquet(table).write.partitionBy("valid", "year", "month", "day", "hour").parquet(copy)
    late_out = f"{lake.curated}/late"
    jobs.compact(spark, copy, late_out)
    one = spark.read.parquet(copy).where("valid = 'true' and day = 2 and hour = 9")
    n = one.count()
    one.write.parquet(f"{lake.root}/one")
    again = spark.read.schema(one.schema).parquet(f"{lake.root}/one")
    again.write.mode("append").partitionBy("valid", "year", "month", "day", "hour").parquet(copy)
    assert jobs.compact(spark, copy, late_out) == 1
    assert spark.read.parquet(late_out).where("day = 2 and hour = 9").count() == 2 * n
    assert spark.read.parquet(late_out).count() == good.count() + n


def test_gold_mean_skips_missing_temperatures(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    rows = [("Paris-1er", t, dt.datetime(2025, 7, 2, 9, m)) for m, t in enumerate((10.0, None, 20.0))]
    frame = spark.createDataFrame(rows, "name string, t double, event_ts timestamp_ntz").select(
        F.struct("name").alias("station"), F.struct(F.col("t").alias("actual_c")).alias("temperature"),
        F.struct(F.lit(60).alias("humidity_percent")).alias("atmospheric"), "event_ts", F.lit("true").alias("valid"))
    frame.write.partitionBy("valid").parquet(f"{paths.raw}/streaming/weather")
    spark.createDataFrame([(1, 5)], "`Arrondissement pour Paris` int, Trafic long").write.parquet(f"{paths.raw}/batch/trafic")
    got = jobs.gold_weather_traffic(spark, paths).collect()
    assert len(got) == 1 and got[0]["avg_temperature_c"] == 15.0 and got[0]["n_readings"] == 3


def test_publish_encodes_and_needs_the_connector(spark, lake):
    from urbanflow.sinks.kafka import encode_for_kafka, kafka_sink_options
    opts = kafka_sink_options(FeedConfig(), "out")
    assert opts["topic"] == "out" and opts["kafka.acks"] == "all"
    stream = spark.readStream.schema(spark.read.parquet(f"{lake.raw}/streaming/weather").schema) \
        .parquet(f"{lake.raw}/streaming/weather")
    frame = encode_for_kafka(sound_rows(stream), F.col("station.name"))
    assert frame.columns == ["key", "value"] and frame.isStreaming
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.publish(spark, FeedConfig(), lake, "out", trigger={"availableNow": True}).awaitTermination()


def test_pm_ingest_parses_epoch_seconds(spark, tmp_path):
    root = str(tmp_path)
    t0 = dt.datetime(2025, 7, 2, 10, 0, 0)
    rows = []
    for c in range(40):
        when = t0 + dt.timedelta(seconds=30 * c, microseconds=123456)
        epoch = (when - dt.datetime(1970, 1, 1)).total_seconds()
        msg = {"station": "auber", "timestamp": epoch, "pm10": 50 + c % 20, "pm25": 25 + c % 15, "counter": c}
        rows.append((None, json.dumps(msg).encode(), "pm10-data", 0, c, when, 0))
    src = os.path.join(root, "_pm")
    spark.createDataFrame(rows, KAFKA_RECORD).write.parquet(src)
    paths = LakePaths(root)
    for q in jobs.pm_ingest(spark, FeedConfig(), paths, trigger={"availableNow": True},
                            source=spark.readStream.schema(KAFKA_RECORD).parquet(src)):
        q.awaitTermination()
    pm = sound_rows(spark.read.parquet(f"{paths.raw}/streaming/pm")).orderBy("counter").collect()
    assert len(pm) == 40 and pm[3]["pm10"] == 53 and pm[17]["pm25"] == 27
    assert pm[1]["event_ts"] == dt.datetime(2025, 7, 2, 10, 0, 30, 123456)
    assert (pm[0]["year"], pm[0]["month"], pm[0]["day"], pm[0]["hour"]) == (2025, 7, 2, 10)


def test_router_job_multi_topic(spark, lake, tmp_path):
    from urbanflow.streaming.router import read_routed
    src = os.path.join(str(tmp_path), "_multi")
    now = dt.datetime(2025, 7, 2, 12, 0)
    rows = [(b"s", json.dumps(message(i, STATIONS[i], now)).encode(), "weather", 0, i, now, 0) for i in range(10)]
    rows += [(None, b'{"line": "RER A", "delay_min": 3}', "traffic", 1, 100 + i, now, 0) for i in range(5)]
    rows += [(None, b"{}", "air_quality", 2, 200, now, 0)]
    spark.createDataFrame(rows, KAFKA_RECORD).write.parquet(src)
    paths = LakePaths(str(tmp_path))
    q = jobs.router(spark, FeedConfig(), paths, trigger={"availableNow": True},
                    source=spark.readStream.schema(KAFKA_RECORD).parquet(src))
    q.awaitTermination()
    back = read_routed(spark, f"{paths.raw}/kafka")
    counts = {r["layout"]: r["count"] for r in back.groupBy("layout").count().collect()}
    assert counts == {"weather": 10, "kafka": 5}  # the empty air_quality message is dropped
    assert {r["zone"] for r in back.filter("layout = 'weather'").collect()} == {"Paris"}


def test_live_summary_runs_with_watermark(spark, lake):
    q = jobs.live_summary(spark, lake, trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    # all readings are within hours of each other: the 72 h watermark has not
    # closed any window yet, so append mode has emitted nothing
    assert spark.read.parquet(f"{lake.gold}/weather_summaries_live").count() == 0


def test_live_fusion_of_the_landed_feeds(spark, lake, tmp_path):
    paths, base = LakePaths(str(tmp_path / "lake")), dt.datetime(2025, 7, 2, 8, 0)
    far = base + dt.timedelta(days=30)

    def run(weather, pm):
        for name, sent, job in (("w", weather, jobs.weather_ingest), ("p", pm, jobs.pm_ingest)):
            src = str(tmp_path / f"_{name}")
            spark.createDataFrame(sent, KAFKA_RECORD).write.mode("append").parquet(src)
            for q in job(spark, FeedConfig(), paths, trigger={"availableNow": True}, source=spark.readStream.schema(KAFKA_RECORD).parquet(src)):
                q.awaitTermination()
        q = jobs.live_fusion(spark, paths, trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
        return {(r["counter"], r["reading_id"] is not None) for r in spark.read.parquet(f"{paths.gold}/pm_weather_live").collect()}

    def reading(i, when):
        return (b"k", json.dumps(message(i, STATIONS[0], when)).encode(), "weather", 0, i, when, 0)

    def measured(c, when):
        value = {"station": STATIONS[0][0], "timestamp": (when - dt.datetime(1970, 1, 1)).total_seconds(), "pm10": 50, "pm25": 25, "counter": c}
        return (None, json.dumps(value).encode(), "pm10-data", 0, c, when, 0)

    hour = dt.timedelta(hours=1)
    assert run([reading(0, base)], [measured(0, base + hour / 4), measured(1, base + 5 * hour)]) == {(0, True)}
    assert run([reading(1, base + 5.4 * hour), reading(2, far)], [measured(2, base + 9 * hour), measured(3, far)]) == {(0, True), (1, True), (2, False), (3, True)}


def test_discover_job(spark):
    sent = [(None, v, "traffic", 0, i, dt.datetime(2025, 7, 2), 0) for i, v in enumerate([b'{"line": "A", "delay": 3}', b'{"line": 7}', b"x"])]
    got = {(r["path"], r["kind"]): r["n"] for r in jobs.discover(spark, FeedConfig(), source=spark.createDataFrame(sent, KAFKA_RECORD)).collect()}
    assert got == {("$", "object"): 2, ("$", "invalid"): 1, ("$.line", "string"): 1, ("$.line", "integer"): 1, ("$.delay", "integer"): 1}


def test_report_with_empty_quarantine(spark, tmp_path):
    good = json.dumps(message(1, STATIONS[0], dt.datetime(2025, 7, 2, 9, 0))).encode()
    src = os.path.join(str(tmp_path), "_clean")
    spark.createDataFrame([(b"k", good, "weather", 0, 1, dt.datetime(2025, 7, 2, 9, 1), 0)], KAFKA_RECORD).write.parquet(src)
    paths = LakePaths(str(tmp_path))
    for q in jobs.weather_ingest(spark, FeedConfig(), paths, trigger={"availableNow": True},
                                 source=spark.readStream.schema(KAFKA_RECORD).parquet(src)):
        q.awaitTermination()
    r = jobs.weather_ingest_report(spark, paths).collect()[0]
    assert (r["n_records"], r["n_valid"], r["n_quarantined"]) == (1, 1, 0)


def test_closed_hours_filter_prunes_partitions(spark, lake):
    landed = sound_rows(spark.read.parquet(f"{lake.raw}/streaming/weather"))
    closed = landed.filter(jobs.closed_hours(72))
    assert closed.count() == landed.count()  # 2025 data: every hour is long closed
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        txt = closed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "make_timestamp_ntz" in txt.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert landed.filter(jobs.closed_hours(24 * 365 * 100)).count() == 0
