"""Benchmark: run the catalog queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (full
evaluation, nothing collected to the driver). Landing queries include their
write and read-back. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from urbanflow.plans.catalog import QUERIES  # noqa: E402
from urbanflow.plans.feed_queries import QUERIES as FEED_QUERIES  # noqa: E402
from urbanflow.session import build_session, clean_scratch  # noqa: E402


def _sf_value(sf_dir: str):
    """Scale factor from a ``.../sf0.1`` directory name (number when it parses)."""
    text = os.path.basename(sf_dir).replace("sf", "")
    try:
        return float(text)
    except ValueError:
        return text


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "1"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = build_session("urbanflow-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.read.parquet(f"{sf_dir}/region.parquet"))  # JVM / reader warm-up
    # scale factor loads classes and compiles code paths before timing
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.environ.get("BENCH_WARMUP", "1") == "1" and os.path.isdir(warm_dir):
        for name, q in QUERIES.items():
            if not only or name in only:
                try:
                    run(q(spark, warm_dir))
                except Exception:
                    pass

    timings: dict[str, float] = {}
    failures: dict[str, str] = {}
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        samples = []
        try:
            for _ in range(reps):
                t0 = time.perf_counter()
                run(q(spark, sf_dir))
                samples.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(samples), 3)
        except Exception as exc:  # report, keep benchmarking the rest
            failures[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    # streaming throughput of the landing path (rows / s)
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    stream_rate = round(n_events / timings["stream_ingest"], 1) if "stream_ingest" in timings else None

    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        # of the queries that rounds 1 and 2 had too
        "value_of_earlier_queries": round(sum(t for k, t in timings.items() if k not in FEED_QUERIES), 3),
        "queries": timings,
        "sf": _sf_value(sf_dir),
        "cpus": int(cpus),
        "reps": reps,
        "stream_ingest_rows_per_sec": stream_rate,
    }
    if failures:
        out["failures"] = failures
    print(json.dumps(out))
    clean_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
