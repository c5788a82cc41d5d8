"""Topic routing decisions and object paths (incl. defaults for missing fields)."""

import datetime as dt

from pyspark.sql import functions as F

from urbanflow.operators.routing import route_messages
from urbanflow.sources.kafka import as_kafka_records
from urbanflow.streaming.router import read_routed, write_routed_batch


def recs(spark, items):
    df = spark.createDataFrame(items, "topic string, off long, p string")
    ts = F.lit(dt.datetime(2025, 7, 2, 23, 31, 5)).cast("timestamp")
    return as_kafka_records(df, value=F.col("p"), topic=F.col("topic"), offset=F.col("off"), timestamp=ts)


ITEMS = [
    ("weather", 0, '{"station":{"zone":"Val de Marne","department":"94"}}'),
    ("weather", 1, '{"station":{"name":"x"}}'),
    ("weather", 2, '{"station":{"zone":null,"department":"02"}}'),
    ("weather", 3, '{"reading_id":"a"}'),
    ("weather", 4, '{"station":null}'),
    ("traffic", 5, '{"station":{"zone":"Paris"}}'),
    ("weather", 6, '{"station":{"zone":"Val-d\'Oise","department":"95"}}'),
]


def test_route_decisions_and_paths(spark):
    out = {r["offset"]: r for r in route_messages(recs(spark, ITEMS), "weather").collect()}
    assert [out[i]["layout"] for i in range(7)] == ["weather", "weather", "weather", "kafka", "kafka", "kafka", "weather"]
    mid = out[0]["message_id"]
    assert len(mid) == 8 and out[0]["object_path"] == f"weather/Val_de_Marne/dept_94/2025-07-02/hour_23/{mid}.json"
    assert out[1]["object_path"].startswith("weather/unknown_zone/dept_unknown_dept/")
    assert out[2]["object_path"].startswith("weather/unknown_zone/dept_02/")
    assert out[5]["object_path"] == f"kafka/traffic/2025-07-02/23-31-05_{out[5]['message_id']}.json"


def test_message_id_is_replay_stable(spark):
    a = [r["message_id"] for r in route_messages(recs(spark, ITEMS), "weather").orderBy("offset").collect()]
    b = [r["message_id"] for r in route_messages(recs(spark, ITEMS), "weather").orderBy("offset").collect()]
    assert a == b and len(set(a)) == len(a)


def test_routed_batch_is_idempotent_and_keeps_string_partitions(spark, tmp_dir):
    r = recs(spark, ITEMS)
    write_routed_batch(r, 0, tmp_dir, "weather", "query_id=a")
    write_routed_batch(r, 0, tmp_dir, "weather", "query_id=a")  # replay of the same batch
    back = read_routed(spark, tmp_dir)
    assert back.count() == len(ITEMS)
    write_routed_batch(r, 0, tmp_dir, "weather", "query_id=b")  # batch 0 of a query with a new checkpoint
    assert read_routed(spark, tmp_dir).count() == 2 * len(ITEMS)
    depts = {r["dept"] for r in back.filter("layout = 'weather'").collect()}
    assert "02" in depts  # not turned into the integer 2
    zones = {r["zone"] for r in back.filter("layout = 'weather'").collect()}
    assert "Val-d'Oise" in zones
