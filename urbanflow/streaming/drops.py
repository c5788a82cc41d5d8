"""A folder into which files are dropped: each file is loaded once, whatever columns it has.

The ledger of files is the checkpoint of a file stream that reads names only; every run takes what has come
since the last one and ends. Files with the same columns are read together; a dataset's files may have more
columns than earlier ones had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.files import CORRUPT_ROW, read_delimited
from .ingest import query_directory

SUFFIX = ".csv"
FILES_PER_BATCH = 1000
# what a file source knows of a file; the content is never read
FILE = "path string, modificationTime timestamp, length long, content binary"


def header_of(spark: SparkSession, path: str, sep: str) -> tuple[str, ...]:
    """Column names in a file's first line; none for an empty file."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(c.strip().strip('"') for c in line.lstrip("﻿").split(sep)) if line else ()


def dataset_of(path: str, suffix: str = SUFFIX) -> str:
    """``.../name.csv`` or ``.../name.csv/part-0.csv`` -> name; ``name.2024.csv`` is another drop of name."""
    parts = path.rstrip("/").split("/")
    named = next((p for p in parts if p.endswith(suffix)), parts[-1])
    return named[:-len(suffix)].split(".", 1)[0]


def load_files(spark: SparkSession, paths: list[str], out: str, batch: str, schemas: dict[str, StructType], sep: str) -> None:
    """The files to ``out/<dataset>/<batch>/columns=<n>``, replacing what an earlier try of this batch has left."""
    groups: dict[str, dict[tuple[str, ...], list[str]]] = {}
    for p in sorted(paths):
        header = header_of(spark, p, sep)
        if header:
            groups.setdefault(dataset_of(p), {}).setdefault(header, []).append(p)
    for dataset, by_header in groups.items():
        known = {f.name: f.dataType for f in schemas.get(dataset, StructType())}
        for i, (header, files) in enumerate(sorted(by_header.items())):
            schema = StructType([StructField(c, known.get(c, StringType())) for c in header])
            (read_delimited(spark, files, schema, sep, corrupt=CORRUPT_ROW)
             .withColumn("source_file", F.col("_metadata.file_name"))
             .write.mode("overwrite").parquet(f"{out}/{dataset}/{batch}/columns={i}"))


def load_new_files(spark: SparkSession, folder: str, out: str, checkpoint: str, schemas: dict[str, StructType] | None = None,
                   sep: str = ",", max_files: int = FILES_PER_BATCH) -> StreamingQuery:
    """Loads the files that no earlier run with this checkpoint has loaded, and ends.

    schemas: types of known columns by dataset; other columns are text. Rows that do not fit keep their line in
    ``CORRUPT_ROW``. An empty file gives nothing, a header alone no rows. A batch that dies is repeated with the
    same files and replaces its own output.
    """
    names = (spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", f"*{SUFFIX}").option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files).load(folder).select("path"))

    def each(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.distinct().collect()]  # at most max_files names
        load_files(batch.sparkSession, paths, out, f"{query_directory(batch)}/batch_id={batch_id}", schemas or {}, sep)

    return names.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_loaded(spark: SparkSession, out: str, dataset: str) -> DataFrame:
    """All loaded rows of a dataset; columns that a file did not have are null."""
    return (spark.read.option("mergeSchema", "true").option("basePath", f"{out}/{dataset}")
            .parquet(f"{out}/{dataset}").drop("query_id", "columns"))
