"""Delimited-file readers and dataset discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


CORRUPT_ROW = "_corrupt_row"


def read_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = ";",
                   header: bool = True, mode: str = "PERMISSIVE", corrupt: str | None = None) -> DataFrame:
    """Explicit-schema CSV read (no inference pass). A UTF-8 BOM and CRLF
    line ends are handled by the reader. ``corrupt`` names a further column
    that holds the raw line of a row with too few, too many or unreadable
    fields (null for sound rows)."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode).option("encoding", "UTF-8")
    if corrupt:
        schema = StructType([*schema.fields, StructField(corrupt, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt).option("enforceSchema", True)
    return reader.schema(schema).csv(path)


def read_delimited_inferred(spark: SparkSession, path: str, sep: str = ",", header: bool = True) -> DataFrame:
    """Header + schema inference: one extra pass over the input. Prefer an explicit schema."""
    return (spark.read.option("header", header).option("inferSchema", True)
            .option("sep", sep).csv(path))


def discover_datasets(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[tuple[str, str]]:
    """(name, path) of every ``*<suffix>`` entry directly inside ``folder``.

    A dataset may be a single file, also an empty one, or a directory of part
    files. The folder is listed through the Hadoop file system it lies in; a
    missing folder has no datasets.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*{suffix}")
    found = pattern.getFileSystem(conf).globStatus(pattern)
    paths = [f.getPath() for f in found or []]
    return sorted((p.getName()[:-len(suffix)], p.toString()) for p in paths)
