"""Edge-case messages: empties dropped, malformed quarantined, drift counted."""

import datetime as dt

from pyspark.sql import functions as F

from urbanflow.functions.messages import decode_json, drop_empty, is_empty_payload, split_valid
from urbanflow.sources.kafka import as_kafka_records
from urbanflow.streaming.ingest import landing_frame, parse_records, quarantined_rows, sound_rows

GOOD = ('{"reading_id":"PAR-0a1b2c3d","timestamp":"2025-07-02T23:30:00.123456Z",'
        '"station":{"name":"Paris-13e-Gobelins","coordinates":{"latitude":48.8322,"longitude":2.3561},'
        '"department":"75","zone":"Paris","altitude_m":42},'
        '"temperature":{"actual_c":24.5,"feels_like_c":22.7},'
        '"atmospheric":{"humidity_percent":60,"pressure_hpa":1008.2,"visibility_km":12.4},'
        '"wind":{"speed_kmh":12.0,"direction":"SW"},'
        '"conditions":{"weather":"light_rain","description":"Light Rain"}}')


def kafka_df(spark, payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i long, p string")
    return as_kafka_records(df, value=F.col("p"), topic=F.lit("weather"), offset=F.col("i"),
                            timestamp=F.lit("2025-07-02 23:31:00").cast("timestamp"), key=F.lit("k"))


def test_empty_payloads(spark):
    payloads = [None, "", "   ", "null", "{}", "[]", '""', "0", "0.0", "-0", "false", " { } ", "[\n]",
                '" "', "1", "true", "{\"a\":1}", "[0]", "not json"]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    got = [r[0] for r in df.select(is_empty_payload("p")).collect()]
    assert got == [True] * 13 + [False] * 6


def test_drop_empty_keeps_non_empty(spark):
    recs = kafka_df(spark, [None, "{}", GOOD, "null"])
    assert drop_empty(recs).count() == 1


def test_parse_good_message_and_altitude_alias(spark):
    parsed = parse_records(kafka_df(spark, [GOOD]))
    r = sound_rows(landing_frame(parsed)).collect()[0]
    assert r["station"]["altitude"] == 42  # producer writes altitude_m
    assert r["event_ts"] == dt.datetime(2025, 7, 2, 23, 30, 0, 123456)
    assert (r["year"], r["month"], r["day"], r["hour"]) == (2025, 7, 2, 23)
    assert r["kafka_offset"] == 0 and r["temperature"]["actual_c"] == 24.5


def test_malformed_messages_are_quarantined(spark):
    bad_ts = GOOD.replace("2025-07-02T23:30:00.123456Z", "garbage")
    drift = GOOD.replace('"humidity_percent":60', '"humidity_percent":65.5')
    payloads = [GOOD, "not json", '[{"a":1},{"b":2}]', bad_ts, drift, "{}", None]
    parsed = parse_records(kafka_df(spark, payloads)).cache()
    good = {r["kafka_offset"]: r for r in sound_rows(landing_frame(parsed)).collect()}
    bad = {r["kafka_offset"]: r for r in quarantined_rows(landing_frame(parsed)).collect()}
    assert set(good) == {0, 4} and set(bad) == {1, 2, 3}
    assert good[4]["atmospheric"]["humidity_percent"] is None  # drifted field nulled, row kept
    assert bad[1]["_corrupt_record"] == "not json"
    assert bad[3]["_corrupt_record"] is None  # valid JSON, bad timestamp
    report = parsed.agg(F.count(F.col("_corrupt_record")).alias("c")).collect()[0]["c"]
    assert report == 3  # not json, array, drifted field


def test_split_valid(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    ok, bad = split_valid(df, ["x", "y"])
    assert ok.count() == 1 and bad.count() == 2


def test_decode_json_never_fails_under_ansi(spark):
    df = spark.createDataFrame([("{\"k\": \"x\"}",), ("{",)], "value string")
    out = decode_json(df, spark.createDataFrame([], "k int").schema).select("data.k", "data._corrupt_record")
    assert [tuple(r) for r in out.collect()] == [(None, '{"k": "x"}'), (None, "{")]
