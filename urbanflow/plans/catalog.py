"""Query catalog: every operator of the lake jobs, run over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` over whole tables. Queries
that land data write under the session's shared checkpoint folder and return
the read-back table, so the sink is part of what is checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..functions import weather as W
from ..functions.messages import decode_json, drop_empty, flatten
from ..functions.timeparts import (format_date, format_datetime, format_hour,
                                   format_time, iso_z, parse_event_time, time_parts,
                                   with_batch_partition_cols)
from ..functions.ids import short_id
from ..functions.paths import UNKNOWN_STATION, UNKNOWN_ZONE
from ..operators import model as M
from ..operators.enrich import enrich, with_defaults
from ..operators.gold import fuse
from ..operators.quality import WEATHER_RULES, qc_flags, qc_split
from ..operators.reports import column_stats, exact_mean, exact_sum, ingest_report, row_count, windowed_summary
from ..operators.routing import route_messages
from ..operators.sequence import sequence_number
from ..schemas import PM
from ..session import scratch_path
from ..sinks.kafka import encode_for_kafka
from ..sinks.parquet import read_partitioned, write_partitioned
from ..sources.files import read_delimited, read_delimited_inferred
from ..sources.spine import gap_filled_hourly_counts
from ..streaming.ingest import parse_records, sound_rows, start_landing
from ..streaming.router import read_routed, start_router
from ..streaming.summary import DEFAULT_WATERMARK, start_summary, streaming_summary
from . import feeds, jobs
from .feed_queries import QUERIES as FEED_QUERIES
from .inputs import events_stream, run_available_now, table

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- sources / sinks

def q_stream_ingest(spark, sf):
    """Kafka records -> from_json -> flatten -> event time parts -> Parquet
    partitioned year/month/day/hour. What there is is a backlog, so each
    micro-batch is rebalanced on the partition columns and lands, exactly once,
    in a directory of its own: files by hours, not by tasks times hours."""
    out, ckpt = (scratch_path(spark, "stream_ingest", p) for p in ("landing", "checkpoint"))
    parsed = parse_records(feeds.event_records(events_stream(spark, sf)), feeds.EVENT_MESSAGE,
                           required=("event_id", "event_ts"))
    run_available_now(start_landing(parsed, out, ckpt, trigger={"availableNow": True}, mode="rebalanced"))
    back = sound_rows(read_partitioned(spark, out))
    return back.select("event_id", "user_id", "event_type", "value", "props", "event_ts",
                       "year", "month", "day", "hour")


def q_partitioned_write(spark, sf):
    out = scratch_path(spark, "partitioned_write")
    e = table(spark, sf, "events")
    write_partitioned(e.withColumns({k: v for k, v in time_parts("ts").items() if k != "hour"}),
                      out, ["year", "month", "day"])
    return read_partitioned(spark, out)


def q_batch_partition_cols(spark, sf):
    return with_batch_partition_cols(table(spark, sf, "orders"), "20250702-1200")


def _csv_landing(spark, sf) -> str:
    path = scratch_path(spark, "csv_scan") + "/customer.csv"
    (table(spark, sf, "customer").write.mode("overwrite")
     .option("header", True).option("sep", ";").csv(path))
    return path


def q_csv_scan(spark, sf):
    path = _csv_landing(spark, sf)
    return read_delimited(spark, path, table(spark, sf, "customer").schema, sep=";")


def q_csv_scan_inferred(spark, sf):
    return read_delimited_inferred(spark, _csv_landing(spark, sf), sep=";")


CSV_FOLDER_TABLES = ("region", "nation", "supplier", "customer")


def q_csv_folder_ingest(spark, sf):
    """Every ``*.csv`` dataset of a folder -> its own Parquet directory; the
    row count comes from the write itself (Observation), not a re-scan.
    Returned: every landed row with its dataset, and the datasets that failed."""
    folder = scratch_path(spark, "csv_folder", "in")
    for name in CSV_FOLDER_TABLES:
        table(spark, sf, name).write.option("header", True).csv(f"{folder}/{name}.csv")
    _touch(spark, f"{folder}/nothing.csv")  # an empty file is reported, not passed over
    out = scratch_path(spark, "csv_folder", "out")
    report = jobs.folder_ingest(spark, folder, out).collect()  # a row a dataset
    landed = None
    for r in report:
        frame = spark.range(1).select(F.lit(r["n_rows"]).alias("n_rows"))
        if r["status"] == "ok":
            kinds = table(spark, sf, r["dataset"]).dtypes
            frame = read_partitioned(spark, f"{out}/{r['dataset']}").select(
                *[F.col(c).cast(t) for c, t in kinds], F.lit(r["n_rows"]).alias("n_rows"))
        frame = frame.select(F.lit(r["dataset"]).alias("dataset"), F.lit(r["status"] == "ok").alias("ok"), "*")
        landed = frame if landed is None else landed.unionByName(frame, allowMissingColumns=True)
    return landed


def _touch(spark, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at).close()


def q_csv_folder_uniform(spark, sf):
    """Same-schema datasets (lineitem split by return flag into CSV drops, one
    of them of rows without a flag) ingested by one scan, named from the file
    path. Returned: every landed row with its dataset."""
    folder, out = scratch_path(spark, "csv_uniform", "in"), scratch_path(spark, "csv_uniform", "out")
    li = table(spark, sf, "lineitem").withColumn("l_returnflag", F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")))
    drop = F.concat(F.lit("lineitem_"), F.coalesce("l_returnflag", F.lit("none")), F.lit(".csv"))
    li.withColumn("drop", drop).write.partitionBy("drop").option("header", True).csv(folder)
    jobs.folder_ingest_uniform(spark, folder, out, li.schema)
    return read_partitioned(spark, out).drop("processed_at")


def q_pm_parse(spark, sf):
    recs = feeds.pm_records(table(spark, sf, "events"))
    parsed = parse_records(recs, PM, ts_field="timestamp", required=("station", "event_ts"))
    return parsed.where("_valid").select("station", "event_ts", "pm10", "pm25", "counter")


def q_hourly_spine(spark, sf):
    return gap_filled_hourly_counts(table(spark, sf, "events"), "ts")


def q_kafka_encode(spark, sf):
    c = table(spark, sf, "customer")
    enc = encode_for_kafka(c, "c_name")
    back = enc.withColumn("data", F.from_json("value", c.schema))
    return back.select("key", "data.*")


# ---------------------------------------------------------------- projections / filters

def q_json_flatten(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    parsed = decode_json(e, StructType([StructField("k", IntegerType())]), value="value")
    return flatten(parsed, "data", keep=["event_id"]).drop("_corrupt_record")


def q_drop_empty(spark, sf):
    recs = feeds.messy_records(table(spark, sf, "events"))
    return drop_empty(recs).select(F.col("offset"), F.col("topic"))


def _customer_docs(spark, sf, sparse: bool) -> DataFrame:
    c = table(spark, sf, "customer")
    if sparse:
        station = F.struct(F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
                           F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("c_mktsegment")).alias("zone"))
        temp = F.when(F.col("c_acctbal") >= 1000, F.struct(F.col("c_acctbal").alias("actual_c")))
    else:
        station = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("zone"),
                           F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("department"))
        temp = F.struct(F.col("c_acctbal").alias("actual_c"))
    doc = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("reading_id"),
                             station.alias("station"), temp.alias("temperature")))
    schema = StructType([
        StructField("reading_id", StringType()),
        StructField("station", StructType([StructField("name", StringType()), StructField("zone", StringType()),
                                           StructField("department", StringType())])),
        StructField("temperature", StructType([StructField("actual_c", DoubleType())])),
    ])
    return c.select(F.from_json(doc, schema).alias("data")).select("data.*")


def q_nested_project(spark, sf):
    d = _customer_docs(spark, sf, sparse=False)
    return d.select("reading_id", F.col("station.name").alias("station_name"),
                    F.col("station.zone").alias("zone"), F.col("station.department").alias("department"),
                    F.col("temperature.actual_c").alias("temp_c"))


def q_nested_default(spark, sf):
    d = _customer_docs(spark, sf, sparse=True)
    return with_defaults(d, {"station.name AS station_name": UNKNOWN_STATION,
                             "station.zone AS zone": UNKNOWN_ZONE}).select(
        "reading_id", "station_name", "zone", F.col("temperature.actual_c").alias("temp_c"))


def q_route_path(spark, sf):
    recs = feeds.routed_records(*(table(spark, sf, t) for t in ("events", "customer", "nation", "region")))
    return route_messages(recs, feeds.WEATHER_ROLE_TOPIC).select(
        "topic", "partition", "offset", "layout", "object_path")


def q_topic_routing(spark, sf):
    """Multi-topic stream -> foreachBatch router -> two JSON layouts -> read back.
    The messages arrive through two queries, each with a new checkpoint, one after the other."""
    out = scratch_path(spark, "routing", "out")
    e = events_stream(spark, sf)
    static = {t: table(spark, sf, t) for t in ("customer", "nation", "region")}
    recs = feeds.routed_records(e, static["customer"], static["nation"], static["region"])
    for part in (0, 1):
        run_available_now([start_router(recs.where(F.col("offset") % 2 == part), out,
                                         scratch_path(spark, "routing", "checkpoint"), feeds.WEATHER_ROLE_TOPIC,
                                         {"availableNow": True})])
    return read_routed(spark, out).select("layout", "topic", "partition", "offset", "message_id",
                                          "zone", "dept", "date")


# ---------------------------------------------------------------- scalar functions

def _readings(spark, sf) -> DataFrame:
    return feeds.lineitem_readings(table(spark, sf, "lineitem"))


def q_event_time_parts(spark, sf):
    e = table(spark, sf, "events").select("event_id", iso_z("ts").alias("timestamp"))
    return e.select("event_id", parse_event_time("timestamp").alias("event_ts")).withColumns(time_parts("event_ts"))


def q_format_ts(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", format_date("ts").alias("date_str"), format_time("ts").alias("time_str"),
                    format_hour("ts").alias("hour_str"), format_datetime("ts").alias("datetime_str"),
                    iso_z("ts").alias("iso_str"))


def q_season(spark, sf):
    o = table(spark, sf, "orders")
    s = W.season(F.month("o_orderdate"))
    return o.select("o_orderkey", s.alias("season"), W.humidity_base(s).alias("humidity_base"))


def q_daylight(spark, sf):
    e = table(spark, sf, "events")
    h = F.hour("ts")
    return e.select("event_id", W.is_daylight(h).alias("daylight"),
                    W.is_clear_sky("event_type", feeds.CLEAR_SKY_TYPES).alias("clear_sky"),
                    (W.is_daylight(h) & W.is_clear_sky("event_type", feeds.CLEAR_SKY_TYPES)).alias("uv_possible"))


def q_expected_temp(spark, sf):
    e = table(spark, sf, "events")
    exp = W.expected_temperature(F.month("ts"), F.hour("ts"), "event_type", core_zone=feeds.CORE_ZONE_TOPIC)
    return e.select("event_id", exp.alias("expected_temp_c"),
                    W.temperature_anomaly("value", exp).alias("anomaly_c"))


def q_expected_pressure(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", W.expected_pressure(F.col("p_size") * 3).alias("expected_pressure_hpa"))


def q_clamp(spark, sf):
    r = _readings(spark, sf)
    return r.select("l_orderkey", "l_linenumber", W.clamp("humidity_raw", 30, 95).alias("humidity_clamped"))


def q_dew_point(spark, sf):
    r = _readings(spark, sf)
    return r.select("l_orderkey", "l_linenumber", W.dew_point("temperature", "humidity").alias("dew_point_c"))


def q_feels_like(spark, sf):
    r = _readings(spark, sf)
    return r.select("l_orderkey", "l_linenumber", W.feels_like("temperature", "wind").alias("feels_like_c"))


def q_precip_type(spark, sf):
    r = _readings(spark, sf)
    return r.select("l_orderkey", "l_linenumber", "condition", W.precipitation_type("condition").alias("precipitation_type"))


def q_precip_intensity(spark, sf):
    r = _readings(spark, sf)
    return r.select("l_orderkey", "l_linenumber", W.precipitation_intensity("precipitation").alias("precipitation_intensity"))


def q_aqi_label(spark, sf):
    r = _readings(spark, sf)
    return r.select("l_orderkey", "l_linenumber", "aqi", W.air_quality_label("aqi").alias("air_quality_label"))


def q_visibility_plausible(spark, sf):
    r = _readings(spark, sf)
    return r.select("l_orderkey", "l_linenumber", W.visibility_plausible("visibility", "condition").alias("visibility_plausible"))


def q_condition_title(spark, sf):
    r = _readings(spark, sf)
    return r.select("l_orderkey", "l_linenumber", W.condition_description("condition").alias("condition_description"))


def q_pollutant_unpivot(spark, sf):
    r = _readings(spark, sf)
    pm = W.pollutant_map({
        "PM10": F.floor("l_quantity").cast("int"),
        "PM2.5": F.floor(F.col("l_quantity") / F.lit(2.0)).cast("int"),
        "NO2": F.floor(F.col("l_extendedprice") / F.lit(1000.0)).cast("int"),
        "O3": F.floor(F.col("l_extendedprice") / F.lit(600.0)).cast("int"),
        "SO2": (F.col("l_linenumber") * F.lit(3)).cast("int"),
        "CO": F.floor(F.col("l_extendedprice") / F.lit(50.0)).cast("int"),
    })
    return W.pollutants_long(r.withColumn("pollutants", pm), "pollutants", ["l_orderkey", "l_linenumber"])


INDICATOR_COLUMNS = ["dew_point_c", "feels_like_c", "condition_description", "precipitation_type",
                     "precipitation_intensity", "season", "expected_temp_c", "daylight", "uv_possible",
                     "expected_pressure_hpa", "air_quality_label", "visibility_plausible", "gust_kmh"]


def q_weather_indicators(spark, sf):
    """All indicators in one projection over the readings (one pass, one stage)."""
    r = _readings(spark, sf)
    out = W.weather_indicators(r, temp="temperature", humidity="humidity", wind="wind", condition="condition",
                               precipitation="precipitation", month="month", hour="hour", zone="zone",
                               altitude="altitude", aqi="aqi", visibility="visibility", gust="gust",
                               core_zone=feeds.CORE_ZONE_FLAG)
    return out.select("l_orderkey", "l_linenumber", *INDICATOR_COLUMNS)


def q_short_id(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", short_id(F.col("event_type"), F.pmod("user_id", F.lit(feeds.KAFKA_PARTITIONS)),
                                         F.col("event_id"), prefix="PAR-").alias("reading_id"))


def q_qc_flags(spark, sf):
    r = _readings(spark, sf)
    names = [rule.name for rule in WEATHER_RULES]
    return qc_flags(r, WEATHER_RULES).select("l_orderkey", "l_linenumber", *names, "all_valid")


def q_qc_split(spark, sf):
    valid, rejected = qc_split(_readings(spark, sf), WEATHER_RULES)
    key = ["l_orderkey", "l_linenumber"]
    return (valid.select(*key, F.lit("valid").alias("side"), F.lit("").alias("failed_rules"))
            .unionAll(rejected.select(*key, F.lit("rejected").alias("side"), "failed_rules")))


# ---------------------------------------------------------------- joins / aggregates / windows

def _with_gaps(df: DataFrame, value: str, key: str, every: int) -> DataFrame:
    """The value is missing in every so-manyth row: nulls must not count in means."""
    return df.withColumn(value, F.when(F.col(key) % every != 0, F.col(value)))


def q_dim_enrich(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return enrich(enrich(c, n, "c_nationkey"), r, "n_regionkey").select("c_custkey", "c_name", "n_name", "r_name")


def q_gold_fusion(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    o = _with_gaps(table(spark, sf, "orders"), "o_totalprice", "o_orderkey", 5)
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    g = fuse(c, o, "c_custkey", "o_custkey",
             {"order_count": F.count(F.lit(1)), "total_price": exact_sum("o_totalprice"),
              "mean_price": exact_mean("o_totalprice"),
              "last_order_date": F.max("o_orderdate")},
             fill={"order_count": 0}, dims=[(n, "c_nationkey")])
    return g.select("c_custkey", "c_name", "n_name", "order_count", "total_price", "mean_price", "last_order_date")


def q_row_count(spark, sf):
    return row_count(table(spark, sf, "lineitem"))


STATS_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def q_column_stats(spark, sf):
    return column_stats(_with_gaps(table(spark, sf, "lineitem"), "l_discount", "l_linenumber", 3), STATS_COLUMNS)


def q_ingest_report(spark, sf):
    recs = feeds.messy_records(table(spark, sf, "events"))
    parsed = parse_records(recs, feeds.EVENT_MESSAGE, required=("event_id", "event_ts"))
    return ingest_report(parsed.withColumnRenamed("kafka_topic", "dataset"), "dataset", "event_ts", "_valid",
                         "_corrupt_record")


def q_hourly_summary(spark, sf):
    return windowed_summary(_with_gaps(table(spark, sf, "events"), "value", "event_id", 7), "ts", ["event_type"],
                            "value", "1 hour")


def q_hourly_summary_stream(spark, sf):
    """The same summary as a stateful stream: 1 h windows, 72 h watermark,
    append mode. Only windows the watermark has closed are emitted."""
    out, ckpt = scratch_path(spark, "summary_stream", "out"), scratch_path(spark, "summary_stream", "checkpoint")
    summary = streaming_summary(_with_gaps(events_stream(spark, sf), "value", "event_id", 7), "ts", ["event_type"], "value", "1 hour", DEFAULT_WATERMARK)
    run_available_now([start_summary(summary, out, ckpt, {"availableNow": True})])
    return spark.read.parquet(out)


def q_message_number(spark, sf):
    numbered = sequence_number(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "message_number")
    return numbered.select("event_id", "user_id", "event_type", "value", "message_number")


REGRESSION_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def q_pm_regression(spark, sf):
    """OLS fit (distributed normal equations) reported as (term, estimate):
    coefficients and rmse to 3 decimals, r2 to 9, so any exact solver agrees."""
    li = table(spark, sf, "lineitem")
    model = M.fit_linear(li, REGRESSION_FEATURES, "l_extendedprice")
    est = M.coefficients(model, REGRESSION_FEATURES, li, "l_extendedprice")
    return est.withColumn("estimate", F.when(F.col("term") == "r2", W.round_half_up("estimate", 9))
                          .otherwise(W.round_half_up("estimate", 3)))


QUERIES: dict[str, Query] = {
    "stream_ingest": q_stream_ingest,
    "partitioned_write": q_partitioned_write,
    "batch_partition_cols": q_batch_partition_cols,
    "csv_scan": q_csv_scan,
    "csv_scan_inferred": q_csv_scan_inferred,
    "csv_folder_ingest": q_csv_folder_ingest,
    "csv_folder_uniform": q_csv_folder_uniform,
    "pm_parse": q_pm_parse,
    "hourly_spine": q_hourly_spine,
    "kafka_encode": q_kafka_encode,
    "json_flatten": q_json_flatten,
    "drop_empty": q_drop_empty,
    "nested_project": q_nested_project,
    "nested_default": q_nested_default,
    "route_path": q_route_path,
    "topic_routing": q_topic_routing,
    "event_time_parts": q_event_time_parts,
    "format_ts": q_format_ts,
    "season": q_season,
    "daylight": q_daylight,
    "expected_temp": q_expected_temp,
    "expected_pressure": q_expected_pressure,
    "clamp": q_clamp,
    "dew_point": q_dew_point,
    "feels_like": q_feels_like,
    "precip_type": q_precip_type,
    "precip_intensity": q_precip_intensity,
    "aqi_label": q_aqi_label,
    "visibility_plausible": q_visibility_plausible,
    "condition_title": q_condition_title,
    "pollutant_unpivot": q_pollutant_unpivot,
    "weather_indicators": q_weather_indicators,
    "short_id": q_short_id,
    "qc_flags": q_qc_flags,
    "qc_split": q_qc_split,
    "dim_enrich": q_dim_enrich,
    "gold_fusion": q_gold_fusion,
    "row_count": q_row_count,
    "column_stats": q_column_stats,
    "ingest_report": q_ingest_report,
    "hourly_summary": q_hourly_summary,
    "hourly_summary_stream": q_hourly_summary_stream,
    "message_number": q_message_number,
    "pm_regression": q_pm_regression,
    **FEED_QUERIES,
}
