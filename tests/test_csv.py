"""Delimited landing: ';' + BOM + CRLF with an explicit schema; folder discovery."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanflow.schemas import TRAFIC
from urbanflow.sources.files import discover_datasets, read_delimited, read_delimited_inferred
from urbanflow.sinks.parquet import write_counted
from urbanflow.functions.timeparts import with_batch_partition_cols

HEADER = ";".join(f.name for f in TRAFIC.fields)
# synthetic rows in the station-traffic shape (not real figures)
LINES = [
    "1;Métro;ALPHA;900;1;4;7;11;14;Paris;1",
    "2;Métro;BRAVO;800;3bis;;;;;Paris;20",
    "3;Métro;CHARLIE;800;7bis;;;;;Ivry-sur-Seine;",
    "1;RER;DELTA;700;A;B;;;;Paris;12",
    "2;RER;ECHO;600;B;;;;;Saint-Denis;",
]


def write_fixture(folder, name="trafic.csv"):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "wb") as fh:
        fh.write(b"\xef\xbb\xbf" + "\r\n".join([HEADER, *LINES]).encode("utf-8") + b"\r\n")
    return path


def test_explicit_schema_read_handles_bom_crlf_semicolon(spark, tmp_dir):
    df = read_delimited(spark, write_fixture(tmp_dir), TRAFIC, sep=";")
    assert df.columns[0] == "Rang" and df.count() == len(LINES)
    r = {row["Station"]: row for row in df.collect()}
    assert r["BRAVO"]["Correspondance_1"] == "3bis" and r["DELTA"]["Correspondance_2"] == "B"
    assert r["CHARLIE"]["Arrondissement pour Paris"] is None and r["ALPHA"]["Trafic"] == 900
    assert df.groupBy("Réseau").count().orderBy("Réseau").collect()[0]["count"] == 3


def test_rang_is_row_number_by_traffic_within_network(spark, tmp_dir):
    df = read_delimited(spark, write_fixture(tmp_dir), TRAFIC, sep=";")
    w = Window.partitionBy("Réseau").orderBy(F.desc("Trafic"), "Rang")
    assert df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") != F.col("Rang")).count() == 0


def test_inference_types_sparse_columns_differently(spark, tmp_dir):
    df = read_delimited_inferred(spark, write_fixture(tmp_dir), sep=";")
    types = dict(df.dtypes)
    assert types["Rang"] == "int" and types["Correspondance_1"] == "string"
    assert types["Correspondance_3"] == "int"  # why the explicit schema keeps them strings


def test_folder_discovery_and_counted_landing(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write_fixture(src, "trafic_2021.csv")
    spark.range(7).write.option("header", True).csv(os.path.join(src, "ids.csv"))
    found = dict(discover_datasets(spark, src))
    assert sorted(found) == ["ids", "trafic_2021"]
    n = write_counted(read_delimited(spark, found["trafic_2021"], TRAFIC).transform(
        lambda d: with_batch_partition_cols(d, "2025-07-02")), os.path.join(tmp_dir, "out"),
        ["year", "month", "day"], name="csv_test")
    assert n == len(LINES)
    assert discover_datasets(spark, os.path.join(tmp_dir, "missing")) == []


def test_uniform_folder_single_scan(spark, tmp_dir):
    from urbanflow.plans.jobs import folder_ingest_uniform
    src = os.path.join(tmp_dir, "drops")
    write_fixture(src, "trafic_2021.csv")
    write_fixture(src, "trafic_2022.csv")
    report = {r["dataset"]: r["n_rows"] for r in
              folder_ingest_uniform(spark, src, os.path.join(tmp_dir, "out"), TRAFIC, sep=";").collect()}
    assert report == {"trafic_2021": len(LINES), "trafic_2022": len(LINES)}
    landed = spark.read.parquet(os.path.join(tmp_dir, "out"))
    assert landed.filter(F.col("dataset") == "trafic_2022").select("Station").distinct().count() == len(LINES)


def test_rows_that_do_not_fit_are_quarantined(spark, tmp_path):
    from urbanflow.config import LakePaths
    from urbanflow.plans.jobs import BatchDataset, batch_load
    from pyspark.sql.types import IntegerType, StructField, StructType
    src = tmp_path / "two.csv"
    src.write_text("a;b\n1;2\n4;5;6\n3\nx;7\n")
    schema = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])
    paths = LakePaths(str(tmp_path / "lake"))
    got = batch_load(spark, [BatchDataset("two", str(src), schema)], paths, "2025-07-02").collect()[0]
    assert (got["n_rows"], got["n_rejected"], got["status"]) == (1, 3, "ok")
    bad = spark.read.parquet(f"{paths.quarantine}/batch/two")
    assert {r["_corrupt_row"] for r in bad.collect()} == {"4;5;6", "3", "x;7"}


def test_a_rerun_reads_sound_files_once_and_clears_its_quarantine(spark, tmp_path, monkeypatch):
    from urbanflow.config import LakePaths
    from urbanflow.plans import jobs
    from pyspark.sql.types import IntegerType, StructField, StructType
    src = tmp_path / "two.csv"
    src.mkdir()
    (src / "good.csv").write_text("a;b\n1;2\n3;4\n")
    (src / "bad.csv").write_text("a;b\n5;6\n7\n")
    schema, paths = StructType([StructField(c, IntegerType()) for c in "ab"]), LakePaths(str(tmp_path / "lake"))
    ds = [jobs.BatchDataset("two", str(src), schema)]
    written = []
    plain = jobs.write_partitioned
    monkeypatch.setattr(jobs, "write_partitioned", lambda df, *a, **k: (written.append(df), plain(df, *a, **k)))

    def load(day):
        r = jobs.batch_load(spark, ds, paths, day).collect()[0]
        assert r["status"] == "ok"
        return r["n_rows"], r["n_rejected"]

    assert load("2025-07-02") == (3, 1) and load("2025-07-03") == (3, 1)
    assert len(written) == 2 and "bad.csv" in written[0]._jdf.queryExecution().logical().toString()  # the second read is of that file
    (src / "bad.csv").write_text("a;b\n5;6\n7;8\n")
    assert load("2025-07-03") == (4, 0) and len(written) == 2  # sound files are read once
    bad = spark.read.parquet(f"{paths.quarantine}/batch/two")
    assert [(r["day"], r["_corrupt_row"]) for r in bad.collect()] == [(2, "7")]
    assert spark.read.parquet(f"{paths.raw}/batch/two").groupBy("day").count().count() == 2


def test_empty_file_and_missing_flag_are_not_lost(spark, tmp_path):
    from urbanflow.plans.jobs import folder_ingest
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    (folder / "c.csv").write_text("")
    got = {r["dataset"]: (r["n_rows"], r["status"]) for r in folder_ingest(spark, str(folder), str(tmp_path / "out")).collect()}
    assert got["a"] == (1, "ok") and got["c"][0] == 0 and got["c"][1].startswith("error")
