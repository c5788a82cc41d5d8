"""Queries on what feeds do over time: resends, partners in another feed, schemas nobody wrote down, gaps.

As in the catalog each entry is ``(spark, sf_dir) -> DataFrame`` over whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import ntz_to_instant
from ..operators.discovery import payload_paths, typed_columns, typed_fields
from ..functions.weather import round_half_up
from ..operators.increment import add_load, read_summary
from ..operators.lattice import column_types, kind_counts
from ..operators.model import ridge_cv
from ..operators.offsets import offset_islands
from ..operators.series import filled_series, hourly_series
from ..operators.sessions import sessions
from ..operators.sketches import HLL_ERROR, KLL_ERROR, column_sketches, merged_sketches, sketch_estimates
from ..schemas import PM
from ..session import scratch_path
from ..sinks.parquet import read_partitioned
from ..streaming.dedup import deduplicated
from ..streaming.drops import load_new_files, read_loaded
from ..streaming.fusion import interval_join, start_fusion
from ..streaming.ingest import is_valid, parse_records, sound_rows, start_landing
from ..streaming.numbering import read_numbered, start_numbering
from ..streaming.summary import start_summary
from . import feeds
from .inputs import arriving, events_stream, run_available_now, table

ONCE = {"availableNow": True}
SPANS = 3


def _parsed(records):
    return parse_records(records, feeds.EVENT_MESSAGE, required=("event_id", "event_ts"))


def q_stream_dedup(spark, sf):
    """A feed with resends inside and beyond the watermark, in spans between which the query restarts: each
    message lands once."""
    folder, out, ckpt = (scratch_path(spark, "stream_dedup", p) for p in ("in", "out", "checkpoint"))
    for stream in arriving(feeds.resent_records(table(spark, sf, "events")), folder, SPANS):
        once = deduplicated(_parsed(stream), ["event_id"])
        run_available_now(start_landing(once, out, ckpt, partition_cols=("year", "month", "day"), trigger=ONCE))
    return sound_rows(read_partitioned(spark, out)).select("event_id", "user_id", "event_type", "value", "event_ts")


def q_stream_fusion(spark, sf):
    """Clicks with the purchases of the same user within a day of them, or alone once none can come any more."""
    folder, out, ckpt = (scratch_path(spark, "stream_fusion", p) for p in ("in", "out", "checkpoint"))
    both = table(spark, sf, "events").where("event_type in ('click', 'purchase')")
    for stream in arriving(feeds.resent_records(both).where("offset % 3 = 0"), folder, SPANS):
        rows = _parsed(stream)
        clicks = rows.where("event_type = 'click'").select(
            "user_id", F.col("event_id").alias("click_id"), F.col("event_ts").alias("click_ts"))
        purchases = rows.where("event_type = 'purchase'").select(
            "user_id", F.col("event_id").alias("purchase_id"), F.col("event_ts").alias("purchase_ts"), F.col("value").alias("amount"))
        fused = interval_join(clicks, purchases, ["user_id"], "click_ts", "purchase_ts", "24 hours", "24 hours")
        run_available_now([start_fusion(fused, out, ckpt, ONCE)])
    return spark.read.parquet(out)


def q_variant_discovery(spark, sf):
    return payload_paths(feeds.untyped_records(table(spark, sf, "events")))


def q_typed_landing(spark, sf):
    """The same topics landed with the types that their payloads turned out to have, fields of several kinds as
    JSON text; read back, with the numbers among those texts."""
    records = feeds.untyped_records(table(spark, sf, "events"))
    paths = payload_paths(records).collect()  # a row a path and kind
    landed = None
    for topic in sorted({r["topic"] for r in paths}):
        at = scratch_path(spark, "typed_landing")
        typed_columns(records.where(F.col("topic") == topic), typed_fields(paths, topic), keep=["topic", "offset"]).write.parquet(at)
        back = spark.read.parquet(at)
        landed = back if landed is None else landed.unionByName(back, allowMissingColumns=True)
    number = F.col("value").try_cast("double")
    return landed.select("topic", "offset", "event_id", "ok", number.alias("value_number"),
                         F.when(number.isNull(), F.col("value")).alias("value_text"), F.get_json_object("place", "$.zone").alias("zone"),
                         F.when(~F.col("place").startswith("{"), F.col("place")).alias("place_text"))


def q_offset_gaps(spark, sf):
    return offset_islands(feeds.offset_records(table(spark, sf, "events")))


def q_pm_quarantine(spark, sf):
    """A PM stream in which many epochs are no times: all rows land, the bad ones in quarantine."""
    out, ckpt = scratch_path(spark, "pm_quarantine", "out"), scratch_path(spark, "pm_quarantine", "checkpoint")
    parsed = parse_records(feeds.poisoned_pm_records(events_stream(spark, sf)), PM, required=("station", "event_ts"))
    run_available_now(start_landing(parsed, out, ckpt, partition_cols=("year",), trigger=ONCE))
    back = read_partitioned(spark, out)
    return back.select("counter", "event_ts", is_valid().alias("valid"), F.col("raw_value").isNotNull().alias("kept_raw"))


SKETCHED = ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate", "l_linestatus")
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def q_column_sketches(spark, sf):
    """Sketches kept per flag and month, merged without the rows; beside them the exact distinct counts, and
    whether every estimate is within its stated error."""
    at = scratch_path(spark, "column_sketches")
    li = table(spark, sf, "lineitem").withColumns({
        "l_tax": F.when(F.col("l_linenumber") != 3, F.col("l_tax")), "month": F.trunc("l_shipdate", "month")})
    columns = [*SKETCHED, "l_tax"]
    column_sketches(li, columns, ["l_returnflag", "month"]).write.parquet(at)
    found = sketch_estimates(merged_sketches(spark.read.parquet(at)), QUANTILES)
    exact = li.agg(*[F.count_distinct(c).alias(c) for c in columns]).select(
        F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("column_name", "n_exact"))
    # share of the values below, and up to, each quantile that a sketch gave (a row a column)
    guesses = {r["column_name"]: r["quantiles"] for r in found.where("quantiles is not null").collect()}
    shares = []
    for c, found_at in guesses.items():
        for i, (p, v) in enumerate(zip(QUANTILES, found_at)):
            below, upto = (F.avg((F.col(c) < v).cast("int")), F.avg((F.col(c) <= v).cast("int")))
            shares.append(((below <= p + KLL_ERROR) & (upto >= p - KLL_ERROR)).alias(f"{c}__{i}"))
    good = li.agg(*shares).select(F.explode(F.create_map(*[
        x for c in guesses for x in (F.lit(c), F.forall(F.array(*[F.col(f"{c}__{i}") for i in range(len(QUANTILES))]), lambda b: b))]))
        .alias("column_name", "quantiles_within"))
    within = F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.col("n_exact") * HLL_ERROR
    return found.join(exact, "column_name").join(good, "column_name", "left").select(
        "column_name", "n_rows", "n_null", F.col("n_exact").alias("n_distinct"), within.alias("distinct_within"), "quantiles_within")


SESSION_GAP = 12 * 3600


def q_station_sessions(spark, sf):
    return sessions(table(spark, sf, "events"), ["user_id"], "ts", SESSION_GAP, "value")


def q_station_sessions_stream(spark, sf):
    """The same as a stream that is restarted between spans of time: sessions that the watermark has closed."""
    folder, out, ckpt = (scratch_path(spark, "sessions", p) for p in ("in", "out", "checkpoint"))
    sent = table(spark, sf, "events").withColumn("timestamp", ntz_to_instant("ts"))
    for stream in arriving(sent, folder, SPANS):
        spells = sessions(stream, ["user_id"], "ts", SESSION_GAP, "value")
        run_available_now([start_summary(spells, out, ckpt, ONCE)])
    return spark.read.parquet(out)


def q_message_number_stream(spark, sf):
    """Numbers given batch by batch, the ledger carrying the counts; equal to those of the whole table."""
    folder, out, ledger, ckpt = (scratch_path(spark, "numbering", p) for p in ("in", "out", "ledger", "checkpoint"))
    sent = table(spark, sf, "events").withColumn("timestamp", ntz_to_instant("ts"))
    for stream in arriving(sent, folder, SPANS):
        run_available_now([start_numbering(stream, out, ledger, ckpt, ["user_id"], ["ts", "event_id"], ONCE)])
    return read_numbered(spark, out).select("event_id", "user_id", "event_type", "value", "message_number")


def q_folder_incremental(spark, sf):
    """Customers in three drops, the later ones with a further column; between them, and after the last, the
    load runs again. Each row with the number of drops that had come when it was loaded."""
    folder, out, ckpt = (scratch_path(spark, "folder_incremental", p) for p in ("in", "out", "checkpoint"))
    c = table(spark, sf, "customer")
    for i in range(4):  # the last run finds nothing new
        if i < 3:
            drop = c.where(F.pmod("c_custkey", F.lit(3)) == i)
            (drop.drop("c_mktsegment") if i == 0 else drop).write.option("header", True).csv(f"{folder}/customer.{i}.csv")
        run_available_now([load_new_files(spark, folder, out, ckpt, {"customer": c.schema})])
    return read_loaded(spark, out, "customer").select(*c.columns, F.col("batch_id").cast("int").alias("run"))


def q_csv_type_lattice(spark, sf):
    """Types of the orders as text, with a column of codes as the traffic file has them, one of mixed dates and
    times and one without values: from one scan of the text."""
    at = scratch_path(spark, "csv_types")
    key = F.col("o_orderkey")
    table(spark, sf, "orders").withColumns({
        "line": F.when(key % 7 == 0, F.concat(key % 14, F.lit("bis"))).when(key % 7 < 3, (key % 14).cast("string")),
        "zone": F.lpad((key % 20).cast("string"), 2, "0"),
        "open": (key % 2 == 0).cast("string"),
        "day": F.when(key % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        "score": F.when(key % 5 == 0, (key % 100).cast("string")).when(key % 5 == 1, F.concat(key % 100, F.lit(".5"))),
        "nothing": F.lit(None).cast("string")}).write.option("header", True).csv(at)
    text = spark.read.option("header", True).csv(at)
    return column_types(kind_counts(text))


def q_summary_delta(spark, sf):
    """Hourly summaries after three loads, a tenth of the rows coming one load late."""
    state, summary = scratch_path(spark, "summary_delta", "state"), scratch_path(spark, "summary_delta", "summary")
    e = table(spark, sf, "events").withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    due = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    load = F.least(due + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0), F.lit(2))
    for i in range(3):
        add_load(e.where(load == i), i, state, summary, "ts", ["event_type"], "value")
    return read_summary(spark, summary)


def q_pm_ridge_cv(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("fold", F.pmod("l_orderkey", F.lit(5)).cast("int"))
    errors = ridge_cv(li, ["l_quantity", "l_discount"], "l_extendedprice", "fold", [0.0, 0.01, 1.0, 100.0])
    return errors.withColumn("rmse", round_half_up("rmse", 3))


def q_series_filled(spark, sf):
    """Hourly means of each group, one of which has a third of the rows; empty hours carried on and interpolated."""
    e = table(spark, sf, "events").withColumn("zone", F.when(F.col("user_id") % 3 == 0, "hot").otherwise(
        F.concat_ws("-", "event_type", F.col("user_id") % 20)))
    return filled_series(hourly_series(e, ["zone"], "ts", "value"), ["zone"], "hour_start", "value")


QUERIES = {
    "stream_dedup": q_stream_dedup,
    "stream_fusion": q_stream_fusion,
    "variant_discovery": q_variant_discovery,
    "typed_landing": q_typed_landing,
    "offset_gaps": q_offset_gaps,
    "pm_quarantine": q_pm_quarantine,
    "column_sketches": q_column_sketches,
    "station_sessions": q_station_sessions,
    "station_sessions_stream": q_station_sessions_stream,
    "message_number_stream": q_message_number_stream,
    "folder_incremental": q_folder_incremental,
    "csv_type_lattice": q_csv_type_lattice,
    "summary_delta": q_summary_delta,
    "pm_ridge_cv": q_pm_ridge_cv,
    "series_filled": q_series_filled,
}
