"""Runnable lake jobs.

    python -m urbanflow.plans.jobs weather-ingest   # Kafka -> raw/streaming/weather (y/m/d/h)
    python -m urbanflow.plans.jobs pm-ingest        # Kafka PM feed -> raw/streaming/pm
    python -m urbanflow.plans.jobs router           # multi-topic -> raw/kafka JSON layouts
    python -m urbanflow.plans.jobs batch-load --date 20250702-1200 trafic=path.csv ...
    python -m urbanflow.plans.jobs folder-ingest --folder data/
    python -m urbanflow.plans.jobs summary | gold | train-pm | compact --table raw/streaming/weather

Configuration comes from the environment (``urbanflow.config``); every
streaming job keeps its checkpoint under ``<lake>/_checkpoints/<job>``.
"""

from __future__ import annotations

import argparse
import re
import sys
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import FeedConfig, LakePaths, feed_config_from_env, lake_paths_from_env
from ..functions.timeparts import parse_process_date, truncate_hour, utc_wall_clock, with_batch_partition_cols
from ..operators import model as M
from ..operators.discovery import payload_paths
from ..operators.enrich import fill_station_attributes
from ..sources.dims import stations
from ..operators.offsets import offset_completeness, offset_islands
from ..operators.reports import exact_mean, ingest_report, windowed_summary
from ..schemas import KNOWN_DATASETS, PM, WEATHER_CORE, WEATHER_FULL
from ..session import build_session, clean_scratch, scratch_path
from ..sinks.kafka import start_kafka_publish
from ..sinks.parquet import read_partitioned, write_counted, write_partitioned
from ..sources.files import CORRUPT_ROW, discover_datasets, read_delimited, read_delimited_inferred
from ..sources.kafka import read_kafka_batch, read_kafka_stream
from ..streaming.dedup import deduplicated
from ..streaming.drops import load_new_files
from ..streaming.fusion import interval_join, start_fusion
from ..streaming.ingest import PARTS, VALID, is_valid, parse_records, sound_rows, start_landing
from ..streaming.router import start_router
from ..streaming.summary import start_summary, streaming_summary


def checkpoint(paths: LakePaths, job: str) -> str:
    return f"{paths.root}/_checkpoints/{job}"


# ---------------------------------------------------------------- streaming

def weather_ingest(spark: SparkSession, cfg: FeedConfig, paths: LakePaths, *, full_schema: bool = False,
                   trigger: dict | None = None, source: DataFrame | None = None,
                   fill_stations: bool = True, dedup: bool = False) -> list[StreamingQuery]:
    """The main streaming job: weather JSON -> Parquet partitioned by validity and event
    year/month/day/hour (``valid=false`` is the quarantine). Stateless, but for ``dedup``
    (each reading once, by its id, over 72 h of state); the only join is against the
    broadcast 37-row station registry."""
    records = source if source is not None else read_kafka_stream(spark, cfg, [cfg.weather_topic])
    parsed = parse_records(records, WEATHER_FULL if full_schema else WEATHER_CORE)
    if fill_stations:
        parsed = fill_station_attributes(parsed, stations(spark))
    if dedup:
        parsed = deduplicated(parsed, ["reading_id"])
    return start_landing(parsed, f"{paths.raw}/streaming/weather", checkpoint(paths, "weather"),
                         trigger=trigger or {"processingTime": cfg.trigger_interval}, query_name="weather_ingest")


def pm_ingest(spark: SparkSession, cfg: FeedConfig, paths: LakePaths, *, trigger: dict | None = None,
              source: DataFrame | None = None) -> list[StreamingQuery]:
    """PM sensor feed: epoch-second timestamps; required = station + time."""
    records = source if source is not None else read_kafka_stream(spark, cfg, [cfg.pm_topic])
    parsed = parse_records(records, PM, ts_field="timestamp", required=("station", "event_ts"))
    return start_landing(parsed, f"{paths.raw}/streaming/pm", checkpoint(paths, "pm"),
                         trigger=trigger or {"processingTime": cfg.trigger_interval})


def router(spark: SparkSession, cfg: FeedConfig, paths: LakePaths, *, trigger: dict | None = None,
           source: DataFrame | None = None) -> StreamingQuery:
    """Every subscribed topic -> weather layout or generic per-topic layout."""
    records = source if source is not None else read_kafka_stream(spark, cfg)
    return start_router(records, f"{paths.raw}/kafka", checkpoint(paths, "router"), cfg.weather_topic,
                        trigger or {"processingTime": cfg.trigger_interval})


def live_summary(spark: SparkSession, paths: LakePaths, *, trigger: dict | None = None) -> StreamingQuery:
    """Hourly per-zone temperature summary over the landed weather table,
    as a stream with a 72 h watermark (late readings still count)."""
    landed = spark.readStream.schema(spark.read.parquet(f"{paths.raw}/streaming/weather").schema) \
        .parquet(f"{paths.raw}/streaming/weather")
    readings = sound_rows(landed).select("event_ts", F.col("station.zone").alias("zone"),
                             F.col("temperature.actual_c").alias("temperature_c"))
    return start_summary(streaming_summary(readings, "event_ts", ["zone"], "temperature_c"),
                         f"{paths.gold}/weather_summaries_live", checkpoint(paths, "summary"), trigger)


def live_fusion(spark: SparkSession, paths: LakePaths, *, minutes: int = 30, trigger: dict | None = None) -> StreamingQuery:
    """Each landed PM measurement with the weather readings of its station within so many minutes of it, or alone
    once the 72 h watermark shows that none can come any more. The streaming side of the gold layer."""
    def landed(table: str) -> DataFrame:
        where = f"{paths.raw}/streaming/{table}"
        return sound_rows(spark.readStream.schema(spark.read.parquet(where).schema).parquet(where))

    pm = landed("pm").select("station", F.col("event_ts").alias("pm_ts"), "pm10", "pm25", "counter")
    weather = landed("weather").select(F.col("station.name").alias("station"), F.col("event_ts").alias("weather_ts"), "reading_id",
                                       F.col("temperature.actual_c").alias("temperature_c"), F.col("wind.speed_kmh").alias("wind_kmh"))
    fused = interval_join(pm, weather, ["station"], "pm_ts", "weather_ts", f"{minutes} minutes", f"{minutes} minutes")
    return start_fusion(fused, f"{paths.gold}/pm_weather_live", checkpoint(paths, "fusion"), trigger)


# ---------------------------------------------------------------- batch

@dataclass(frozen=True)
class BatchDataset:
    name: str
    path: str
    schema: StructType | None = None
    sep: str = ";"


def _clear_day(spark: SparkSession, table: str, process_date: str) -> None:
    d = parse_process_date(process_date)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/year={d.year}/month={d.month}/day={d.day}")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def batch_load(spark: SparkSession, datasets: Iterable[BatchDataset], paths: LakePaths,
               process_date: str, max_parallel: int = 4) -> DataFrame:
    """Each delimited file -> raw/batch/<name>/year=/month=/day= (dynamic
    overwrite: a re-run replaces only its own day). Datasets load as
    concurrent jobs; one failing dataset is reported and does not stop the
    others. Rows that do not fit a dataset's explicit schema go, with their raw
    line, to quarantine/batch/<name>/ and count as rejected. They are counted
    while the sound rows are written: only a file that has some is read a second
    time, for them; a rerun without any clears its day's quarantine."""

    def load(ds: BatchDataset) -> tuple[str, int, int, str]:
        try:
            df = (read_delimited(spark, ds.path, ds.schema, sep=ds.sep, corrupt=CORRUPT_ROW) if ds.schema is not None
                  else read_delimited_inferred(spark, ds.path, sep=ds.sep).withColumn(CORRUPT_ROW, F.lit(None).cast("string")))
            days = ["year", "month", "day"]
            df = with_batch_partition_cols(df, process_date).withColumn("processed_at", F.current_timestamp())
            seen = Observation(f"rejected_{ds.name}_{uuid.uuid4().hex}")
            rejected = F.col(CORRUPT_ROW).isNotNull()
            # the distinct files of the rejected rows: at most as many names as the dataset has files
            counted = df.withColumn("_file", F.col("_metadata.file_path")).observe(
                seen, F.count_if(rejected).alias("rows"), F.collect_set(F.when(rejected, F.col("_file"))).alias("files"))
            n = write_counted(counted.where(~rejected).drop(CORRUPT_ROW, "_file"), f"{paths.raw}/batch/{ds.name}", days,
                              name=f"load_{ds.name}_{uuid.uuid4().hex}")
            bad, where = int(seen.get["rows"]), f"{paths.quarantine}/batch/{ds.name}"
            if bad:
                again = df.where(F.col("_metadata.file_path").isin(list(seen.get["files"])) & rejected)
                write_partitioned(again, where, days)
            else:
                _clear_day(spark, where, process_date)
            return (ds.name, n, bad, "ok")
        except Exception as exc:
            return (ds.name, 0, 0, f"error: {type(exc).__name__}: {str(exc)[:200]}")

    items = list(datasets)
    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(items) or 1))) as pool:
        rows = list(pool.map(load, items))
    return spark.createDataFrame(rows, "dataset string, n_rows long, n_rejected long, status string")


def folder_ingest(spark: SparkSession, folder: str, out_root: str, sep: str = ",",
                  max_parallel: int = 4) -> DataFrame:
    """Every ``*.csv`` dataset in ``folder`` -> ``out_root/<name>/`` Parquet,
    with a ``processed_at`` audit column; the row count is observed during
    the write (no second scan). Datasets are independent jobs, submitted from
    a few threads so small ones overlap on the cluster. Missing folder ->
    empty report."""

    def ingest(item: tuple[str, str]) -> tuple[str, int, int, str]:
        name, path = item
        try:
            df = read_delimited_inferred(spark, path, sep=sep)
            if not df.columns:
                raise ValueError("no header")
            df = df.withColumn("processed_at", F.current_timestamp())
            n = write_counted(df, f"{out_root}/{name}", name=f"ingest_{name}_{abs(hash(path))}")
            return (name, n, len(df.columns), "ok")
        except Exception as exc:  # one bad dataset must not stop the others
            return (name, 0, 0, f"error: {type(exc).__name__}")

    datasets = discover_datasets(spark, folder)
    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(datasets) or 1))) as pool:
        rows = list(pool.map(ingest, datasets))
    return spark.createDataFrame(rows, "dataset string, n_rows long, n_columns int, status string")


def folder_ingest_uniform(spark: SparkSession, folder: str, out: str, schema: StructType,
                          sep: str = ",", suffix: str = ".csv") -> DataFrame:
    """Every ``*.csv`` dataset of ``folder`` sharing one schema, in ONE scan.

    The dataset name comes from each row's ``_metadata.file_path``; the whole
    folder lands as one Parquet table partitioned by ``dataset`` (AQE
    rebalance: a dataset holding most rows is split over many writers). One
    job instead of one per file; the per-dataset report is read back from the
    landed table (only the partition column is needed).
    """
    base = re.escape(folder.rstrip("/").rsplit("/", 1)[-1])
    # a drop may also be a directory that a partitioned write named (column=value)
    name = F.regexp_extract(F.col("_metadata.file_path"), rf"/{base}/(?:[^/=]+=)?([^/=]+?){re.escape(suffix)}(?:/|$)", 1)
    df = (spark.read.schema(schema).option("header", True).option("sep", sep)
          .csv(f"{folder.rstrip('/')}/*{suffix}")
          .withColumn("dataset", name).withColumn("processed_at", F.current_timestamp()))
    write_partitioned(df, out, ["dataset"])
    return (read_partitioned(spark, out).groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows")))


def publish(spark: SparkSession, cfg: FeedConfig, paths: LakePaths, topic: str, *, table: str = "streaming/weather",
            trigger: dict | None = None) -> StreamingQuery:
    """Every landed record to a Kafka topic, as (station name, JSON of the record)."""
    where = f"{paths.raw}/{table}"
    landed = spark.readStream.schema(spark.read.parquet(where).schema).parquet(where)
    return start_kafka_publish(sound_rows(landed), F.col("station.name"), cfg, topic,
                               checkpoint(paths, f"publish_{topic}"), trigger)


def weather_summary(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Hourly per-zone temperature summary (batch; complete, late data included)."""
    w = sound_rows(read_partitioned(spark, f"{paths.raw}/streaming/weather"))
    readings = w.select("event_ts", F.col("station.zone").alias("zone"),
                        F.col("temperature.actual_c").alias("temperature_c"))
    return windowed_summary(readings, "event_ts", ["zone"], "temperature_c", "1 hour")


def weather_ingest_report(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Landed vs quarantined counts per topic and event-time range."""
    rows = read_partitioned(spark, f"{paths.raw}/streaming/weather")
    rows = rows.withColumn(VALID, is_valid()).withColumn("event_ts", F.when(F.col(VALID), F.col("event_ts")))
    return ingest_report(rows, "kafka_topic", "event_ts", VALID, "_corrupt_record")


def offset_report(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Per topic and partition of the landed weather feed: first and last offset, rows, offsets that are missing
    between them, rows that repeat one. Empty messages are dropped on landing and show as missing."""
    landed = read_partitioned(spark, f"{paths.raw}/streaming/weather")
    return offset_completeness(offset_islands(landed, "kafka_topic", "kafka_partition", "kafka_offset"))


def discover(spark: SparkSession, cfg: FeedConfig, *, source: DataFrame | None = None) -> DataFrame:
    """Paths, kinds and counts of the payloads that the subscribed topics hold now: what a schema has to cover."""
    return payload_paths(source if source is not None else read_kafka_batch(spark, cfg))


def gold_weather_traffic(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Own definition of the gold table: hourly weather per Paris
    arrondissement LEFT JOIN yearly station traffic per arrondissement.
    Both sides are aggregated to one row per key before the join."""
    w = sound_rows(read_partitioned(spark, f"{paths.raw}/streaming/weather"))
    arr = F.regexp_extract(F.col("station.name"), r"^Paris-(\d+)", 1)
    weather = (w.withColumn("arrondissement", F.when(arr != "", arr.cast("int")))
               .filter(F.col("arrondissement").isNotNull())
               .groupBy("arrondissement", truncate_hour("event_ts").alias("hour_start"))
               .agg(F.count(F.lit(1)).alias("n_readings"),
                    exact_mean("temperature.actual_c").alias("avg_temperature_c"),
                    F.avg("atmospheric.humidity_percent").alias("avg_humidity_pct")))
    t = read_partitioned(spark, f"{paths.raw}/batch/trafic")
    traffic = (t.filter(F.col("Arrondissement pour Paris").isNotNull())
               .groupBy(F.col("Arrondissement pour Paris").alias("arrondissement"))
               .agg(F.sum("Trafic").alias("yearly_traffic"), F.count(F.lit(1)).alias("n_stations")))
    return weather.join(traffic, "arrondissement", "left")


def train_pm(spark: SparkSession, paths: LakePaths, features: Sequence[str] = (
        "temperature_c", "humidity_pct", "wind_kmh", "pressure_hpa", "hour")) -> DataFrame:
    """Own definition of the PM10 model: OLS on the landed full-schema weather."""
    w = sound_rows(read_partitioned(spark, f"{paths.raw}/streaming/weather"))
    df = w.select(F.col("temperature.actual_c").alias("temperature_c"),
                  F.col("atmospheric.humidity_percent").alias("humidity_pct"),
                  F.col("wind.speed_kmh").alias("wind_kmh"), F.col("atmospheric.pressure_hpa").alias("pressure_hpa"),
                  F.col("hour"), F.element_at("air_quality.pollutants", F.lit("PM10")).alias("pm10"))
    model = M.fit_linear(df, list(features), "pm10")
    model.write().overwrite().save(f"{paths.gold}/models/pm10")
    return M.coefficients(model, list(features), df, "pm10")


def closed_hours(lateness_hours: int = 72):
    """Partition filter selecting event hours that can no longer receive late
    data: hour start + lateness < now (UTC). Only partition columns are
    referenced, so the scan prunes every open hour."""
    hour_start = F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0))
    now_utc = utc_wall_clock(F.current_timestamp())
    return hour_start + F.make_dt_interval(F.lit(0), F.lit(lateness_hours)) < now_utc


def compact(spark: SparkSession, table: str, out: str, partition_cols: Sequence[str] = PARTS,
            where=None) -> int:
    """Rewrite the (closed) partitions of a landed table that changed since
    their last compaction into few, evenly sized files (AQE rebalance on the
    partition columns; dynamic overwrite, so a re-run replaces the same
    partitions). Returns how many were rewritten.

    What a partition looked like when it was compacted (newest file, number of
    files) is kept beside the output in ``<out>_state``, written after the
    data: a run that dies in between is repeated, never skipped. Changes are
    found from the listing of the files, no file is opened for it, so their cost
    is that of the files, not of the rows. The listing comes before the rows are
    listed for reading: a file that arrives in between is compacted now and once
    more by the next run. Late rows are new files, so their hours come again.
    """
    def chosen(frame: DataFrame) -> DataFrame:
        if VALID in frame.columns:
            frame = frame.where(is_valid())
        return frame if where is None else frame.filter(where)

    keys = list(partition_cols)
    files = spark.read.format("binaryFile").option("basePath", table).option("pathGlobFilter", "*.parquet").load(table)
    now = chosen(files.drop("content")).groupBy(*keys).agg(
        F.max("modificationTime").alias("newest"), F.count_distinct("path").alias("files"))
    try:
        done = spark.read.parquet(f"{out}_state")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        done = spark.createDataFrame([], now.schema)
    changed = now.join(done, [*(now[k].eqNullSafe(done[k]) for k in keys), now["newest"] == done["newest"],
                              now["files"] == done["files"]], "left_anti")
    changed, path = changed.coalesce(1), scratch_path(spark, "compact")
    changed.write.parquet(path)
    changed = spark.read.schema(now.schema).parquet(path)  # a row a partition
    n = changed.count()
    if n:
        df = chosen(read_partitioned(spark, table))
        hours = changed.select(*[F.col(k).alias(f"_{k}") for k in keys])
        rows = df.join(hours, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_semi")
        write_partitioned(rows.drop(VALID, "raw_value", "_corrupt_record", "arrival_date"), out, keys)
        changed.write.mode("append").parquet(f"{out}_state")
    return n


# ---------------------------------------------------------------- CLI

def _report(status: DataFrame) -> None:
    """Show a load's report; exit status 1 if a dataset failed."""
    status.show(truncate=False)
    if status.where(F.col("status") != "ok").count():
        sys.exit(1)


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="urbanflow")
    ap.add_argument("job", choices=["weather-ingest", "pm-ingest", "router", "live-summary", "live-fusion", "publish", "batch-load",
                                    "folder-ingest", "load-new", "summary", "report", "offsets", "discover", "gold", "train-pm",
                                    "compact"])
    ap.add_argument("--date", default=None)
    ap.add_argument("--folder", default=None)
    ap.add_argument("--table", default=None)
    ap.add_argument("--topic", default=None, help="target of publish")
    ap.add_argument("--where", default=None)
    ap.add_argument("--full-schema", action="store_true")
    ap.add_argument("--dedup", action="store_true", help="weather-ingest: land each reading once (72 h of state)")
    ap.add_argument("--closed", type=int, default=None, metavar="HOURS",
                    help="compact only hours older than HOURS of lateness")
    ap.add_argument("datasets", nargs="*", help="name=path for batch-load")
    a = ap.parse_intermixed_args(argv)
    spark = build_session(f"urbanflow-{a.job}")
    cfg, paths = feed_config_from_env(), lake_paths_from_env()
    if a.job in ("weather-ingest", "pm-ingest", "router", "live-summary", "live-fusion", "publish"):
        qs = {"weather-ingest": lambda: weather_ingest(spark, cfg, paths, full_schema=a.full_schema, dedup=a.dedup),
              "pm-ingest": lambda: pm_ingest(spark, cfg, paths),
              "router": lambda: [router(spark, cfg, paths)],
              "live-summary": lambda: [live_summary(spark, paths)],
              "live-fusion": lambda: [live_fusion(spark, paths)],
              "publish": lambda: [publish(spark, cfg, paths, a.topic)]}[a.job]()
        spark.streams.awaitAnyTermination()
        return
    if a.job == "batch-load":
        ds = [BatchDataset(n, p, KNOWN_DATASETS.get(n))
              for n, p in (d.split("=", 1) for d in a.datasets)]
        _report(batch_load(spark, ds, paths, a.date))
    elif a.job == "folder-ingest":
        _report(folder_ingest(spark, a.folder, f"{paths.raw}/data"))
    elif a.job == "load-new":
        query = load_new_files(spark, a.folder, f"{paths.raw}/drops", checkpoint(paths, "drops"), KNOWN_DATASETS)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    elif a.job == "discover":
        discover(spark, cfg).write.mode("overwrite").parquet(f"{paths.reports}/payload_paths")
    elif a.job == "offsets":
        offset_report(spark, paths).write.mode("overwrite").parquet(f"{paths.reports}/offsets")
    elif a.job == "summary":
        write_partitioned(weather_summary(spark, paths), f"{paths.gold}/weather_summaries", [])
    elif a.job == "report":
        weather_ingest_report(spark, paths).write.mode("overwrite").parquet(f"{paths.reports}/ingestion")
    elif a.job == "gold":
        write_partitioned(gold_weather_traffic(spark, paths), f"{paths.gold}/weather_traffic", [])
    elif a.job == "train-pm":
        train_pm(spark, paths).show()
    elif a.job == "compact":
        where = closed_hours(a.closed) if a.closed is not None else a.where
        compact(spark, f"{paths.root}/{a.table}", f"{paths.curated}/{a.table.rsplit('/', 1)[-1]}", where=where)
    clean_scratch(spark)


if __name__ == "__main__":
    main()
