"""The job CLI dispatches batch jobs against a lake root from the environment."""

import os

from urbanflow.plans import jobs
from test_csv import write_fixture
from test_jobs import lake  # noqa: F401  (fixture)


def test_cli_batch_jobs(spark, tmp_path, monkeypatch, lake):
    root = lake.root  # a lake already holding landed weather (see test_jobs)
    monkeypatch.setenv("URBANFLOW_LAKE_ROOT", root)
    src = write_fixture(str(tmp_path / "in"), "trafic_2022.csv")
    jobs.main(["batch-load", "--date", "2025-07-03", f"trafic={src}"])
    days = spark.read.parquet(f"{root}/raw/batch/trafic").select("day").distinct().collect()
    assert {r["day"] for r in days} >= {2, 3}  # dynamic overwrite kept the earlier day
    jobs.main(["folder-ingest", "--folder", str(tmp_path / "in")])
    assert os.path.isdir(f"{root}/raw/data/trafic_2022")
    jobs.main(["summary"])
    jobs.main(["gold"])
    assert spark.read.parquet(f"{root}/gold/weather_traffic").count() > 0
    jobs.main(["compact", "--table", "raw/streaming/weather", "--where", "day = 2"])
    assert spark.read.parquet(f"{root}/curated/weather").count() == 121
