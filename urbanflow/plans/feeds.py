"""Feeds derived from the driver tables, in the shapes the jobs consume.

The lake jobs read Kafka records and delimited files; here every one of
those inputs is *derived by Spark from the given tables* so the work grows
with them:

* ``event_records``   events rendered as JSON messages in the Kafka layout
* ``messy_records``   the same, with the payload defects a real feed carries
* ``routed_records``  multi-topic messages, weather ones carrying a station
* ``pm_records``      the PM sensor feed (epoch-seconds timestamps)
* ``lineitem_readings`` numeric columns bound to weather quantities
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions.messages import to_json_value
from ..functions.timeparts import epoch_seconds, iso_z, ntz_to_instant
from ..functions.weather import WEATHER_CONDITIONS
from ..sources.kafka import as_kafka_records

EVENT_MESSAGE = StructType([
    StructField("event_id", LongType()),
    StructField("timestamp", StringType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])

# Fixed parameters of the stand-in feeds.
KAFKA_PARTITIONS = 4           # partition = user_id mod 4 (keyed by user)
WEATHER_ROLE_TOPIC = "click"   # the topic playing the weather feed
CORE_ZONE_TOPIC = "click"      # the zone playing the urban core
CLEAR_SKY_TYPES = ("view", "click")
CORE_ZONE_FLAG = "R"           # lineitem return flag playing the urban core


def _event_json(e: DataFrame, value: Column | None = None, ts: Column | None = None) -> Column:
    return to_json_value(F.struct(
        F.col("event_id"),
        (ts if ts is not None else iso_z("ts")).alias("timestamp"),
        F.col("user_id"), F.col("event_type"),
        (value if value is not None else F.col("value")).alias("value"),
        F.col("props")))


def _kafka(e: DataFrame, value: Column) -> DataFrame:
    return as_kafka_records(
        e, value=value, key=F.col("user_id"), topic=F.col("event_type"),
        partition=F.pmod(F.col("user_id"), F.lit(KAFKA_PARTITIONS)),
        offset=F.col("event_id"), timestamp=ntz_to_instant("ts"))


def event_records(events: DataFrame) -> DataFrame:
    return _kafka(events, _event_json(events))


def props_k(props: Column | str = "props") -> Column:
    """The integer ``k`` of ``props`` (always ``{"k": n}``). A digit-run
    extraction: the feed expression is inlined into every predicate that
    reads the payload, and a regex is several times cheaper than a JSON parse."""
    p = F.col(props) if isinstance(props, str) else props
    return F.regexp_extract(p, r"-?[0-9]+", 0).cast("int")


# Fixed payloads of the messy feed, indexed by k (0..12); any other k -> clean message.
MESSY_LITERALS = {0: None, 1: "null", 2: "{}", 3: "[]", 4: '""', 5: "0", 6: " { } ",
                  7: "not json", 8: '[{"a":1},{"b":2}]', 11: "0.0", 12: "false"}


def messy_payload(events: DataFrame, k: Column) -> Column:
    """Payload by the event's ``k``: 0-6, 11, 12 empty documents; 7 not JSON;
    8 a two-object array; 9 an unparseable timestamp; 10 a text value in a
    numeric field; otherwise a clean message.

    The fixed payloads are one array lookup; each of the three documents is
    rendered only for the rows that carry it."""
    fixed = F.array(*[F.lit(MESSY_LITERALS.get(i)).cast("string") for i in range(13)])
    return (F.when(k == 9, _event_json(events, ts=F.lit("garbage"))).when(k == 10, _event_json(events, value=F.lit("abc")))
            .when(k.between(0, 12), F.get(fixed, k)).otherwise(_event_json(events)))


def messy_records(events: DataFrame) -> DataFrame:
    e = events.withColumn("_k", props_k())
    return _kafka(e, messy_payload(e, F.col("_k")))


def routed_records(events: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Events on topics = event_type; a message carries a ``station`` object
    when its user is a customer in credit (zone = region, department = nation)."""
    from ..operators.enrich import enrich

    geo = enrich(nation.select("n_nationkey", "n_regionkey"),
                 region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey")
    users = enrich(customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_acctbal",
                                   F.col("c_nationkey").alias("n_nationkey")), geo, "n_nationkey")
    e = events.join(users, "user_id", "left")
    station = F.when(F.col("c_acctbal") >= F.lit(0.0), F.struct(
        F.col("c_name").alias("name"), F.col("r_name").alias("zone"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("department")))
    value = F.to_json(F.struct(F.col("event_id"), iso_z("ts").alias("timestamp"), F.col("value"),
                               station.alias("station")))
    return _kafka(e, value)


def pm_records(events: DataFrame) -> DataFrame:
    value = to_json_value(F.struct(
        F.col("event_type").alias("station"),
        epoch_seconds("ts").alias("timestamp"),
        F.floor("value").cast("int").alias("pm10"),
        F.floor(F.col("value") / F.lit(2.0)).cast("int").alias("pm25"),
        F.col("event_id").alias("counter")))
    return _kafka(events, value)


def lineitem_readings(lineitem: DataFrame) -> DataFrame:
    """lineitem numbers bound to weather quantities (ranges cross every rule
    boundary: wind 10, precipitation 2.5 / 7.5 / 100, temperature -20 / 45...)."""
    conditions = F.array(*[F.lit(c) for c in WEATHER_CONDITIONS])
    q = F.col("l_quantity")
    return lineitem.select(
        "l_orderkey", "l_linenumber",
        ((q - F.lit(25.0)) * F.lit(2.0)).alias("temperature"),
        F.round(F.col("l_discount") * F.lit(1100.0)).cast("int").alias("humidity"),
        ((q - F.lit(1.0)) * F.lit(5.0)).alias("wind"),
        F.when(F.col("l_linenumber") % 2 == 0, (q - F.lit(1.0)) * F.lit(7.0)).alias("gust"),
        (F.lit(940.0) + F.col("l_extendedprice") / F.lit(1000.0)).alias("pressure"),
        (q * F.lit(2.5)).alias("precipitation"),
        (F.col("l_linenumber") - F.lit(1)).alias("aqi"),
        F.element_at(conditions, (F.pmod(F.col("l_partkey"), F.lit(len(WEATHER_CONDITIONS))) + F.lit(1)).cast("int")).alias("condition"),
        (F.col("l_tax") * F.lit(400.0)).alias("visibility"),
        (q * F.lit(2.0)).alias("humidity_raw"),
        F.month("l_shipdate").alias("month"),
        F.hour("l_shipdate").alias("hour"),
        F.col("l_returnflag").alias("zone"),
        (F.col("l_linenumber") * F.lit(20)).alias("altitude"),
        q.alias("l_quantity"), "l_extendedprice",
    )


# Fixed parameters of the feeds with resends, untyped payloads and bad epochs.
LATEST_HOURS = 70              # a message arrives 0 to 69 hours after its event
KEEP_HOURS = 72                # the delay of the watermark
OFFSET_SPAN = 20               # consecutive events that share an offset


def resent_records(events: DataFrame) -> DataFrame:
    """Every event as a message that arrives up to ``LATEST_HOURS`` late; of some a copy comes again within
    ``KEEP_HOURS`` of the event, of others one far beyond, of some both."""
    id_ = F.col("event_id")
    late = F.pmod(id_ * F.lit(37), F.lit(LATEST_HOURS))

    def sent_at(copy: int, hours: Column) -> Column:
        return F.struct(F.lit(copy).alias("copy"), hours.cast("int").alias("hours"))

    copies = F.array_compact(F.array(
        sent_at(0, late),
        F.when(F.pmod(id_, F.lit(5)) == 1, sent_at(1, F.least(late + 1 + F.pmod(id_, F.lit(30)), F.lit(KEEP_HOURS - 1)))),
        F.when(F.pmod(id_, F.lit(7)) == 2, sent_at(2, F.lit(KEEP_HOURS + 1) + F.pmod(id_, F.lit(200))))))
    e = events.withColumn("_sent", F.explode(copies))
    sent = ntz_to_instant("ts") + F.make_dt_interval(F.lit(0), F.col("_sent.hours"))
    return as_kafka_records(
        e, value=_event_json(e), key=F.col("user_id"), topic=F.col("event_type"),
        partition=F.pmod(F.col("user_id"), F.lit(KAFKA_PARTITIONS)),
        offset=id_ * F.lit(3) + F.col("_sent.copy"), timestamp=sent)


def untyped_records(events: DataFrame) -> DataFrame:
    """Topics without a schema: by the event's ``k`` the payload is missing (0), ``null`` (1), an empty object
    (2), no JSON (7), an array of unlike objects (8), has text for a number (10) or text for an object (11)."""
    def payload(value: Column, place: Column) -> Column:
        return to_json_value(F.struct(
            F.col("event_id"), value.alias("value"), (F.col("event_id") % 2 == 0).alias("ok"), place.alias("place")))

    place = F.struct(F.concat(F.lit("z"), F.pmod(F.col("user_id"), F.lit(5))).alias("zone"),
                     F.array(F.struct(F.col("user_id").alias("id"))).alias("seen"))
    k = props_k()
    value = (F.when(k == 0, F.lit(None).cast("string")).when(k == 1, "null").when(k == 2, "{}").when(k == 7, "not json")
             .when(k == 8, '[{"a":1},{"b":"x"}]').when(k == 10, payload(F.lit("abc"), place))
             .when(k == 11, payload(F.col("value"), F.lit("nowhere"))).otherwise(payload(F.col("value"), place)))
    return _kafka(events, value)


def offset_records(events: DataFrame) -> DataFrame:
    """Messages with dense offsets: a topic's partition has gaps and repeated offsets."""
    return as_kafka_records(
        events, value=_event_json(events), key=F.col("user_id"), topic=F.col("event_type"),
        partition=F.pmod(F.col("event_id"), F.lit(KAFKA_PARTITIONS)),
        offset=F.floor(F.col("event_id") / F.lit(OFFSET_SPAN)), timestamp=ntz_to_instant("ts"))


def poisoned_pm_records(events: DataFrame) -> DataFrame:
    """The PM feed, with epochs that are no time, or in another unit, in six of eleven messages."""
    seconds = epoch_seconds("ts")
    bad = F.element_at(F.array(*[F.lit(v) for v in ("NaN", "1e14", "1e300", "-Infinity")], (seconds * 1e3).cast("string"),
                               (seconds * 1e9).cast("string")), (F.pmod(F.col("event_id"), F.lit(11)) + 1).cast("int"))
    stamp = F.when(F.pmod(F.col("event_id"), F.lit(11)) < 6, bad).otherwise(seconds.cast("decimal(20,6)").cast("string"))
    value = F.concat(F.lit('{"station":"'), F.col("event_type"), F.lit('","timestamp":'), stamp, F.lit(',"pm10":1,"pm25":2,"counter":'),
                     F.col("event_id"), F.lit("}"))
    return _kafka(events, value)
