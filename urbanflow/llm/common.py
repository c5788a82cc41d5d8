"""What the operators share: scratch tables, shipping the package to Python workers, row packing.

Column names of the input never clash with an operator's own: the input row travels as one struct
(``packed``) and comes back as columns beside the results (``unpacked``). Where an input column has
the name of a result (in any case), the result stands and the input column goes.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space; words are maximal runs of anything else
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

IN = "__in"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def document_key(id_: Column, text: Column) -> list[Column]:
    """128 bits (d1, d2) that stand for a document: repeated rows (same id, same text) are one."""
    return [F.xxhash64(id_, text).alias("d1"), F.xxhash64(F.lit(1), id_, text).alias("d2")]


def packed(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The given columns (default: all) as one struct named ``__in``; with none, an empty marker."""
    names = df.columns if columns is None else columns
    return (F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.lit(0)).alias(IN)


def unpacked(df: DataFrame, results: list[str]) -> DataFrame:
    """The packed columns that no result displaces, then the results."""
    taken = {r.lower() for r in results}
    kind = df.schema[IN].dataType
    names = [c for c in getattr(kind, "names", []) if c.lower() not in taken]
    return df.select(*[F.col(f"{IN}.`{c}`").alias(c) for c in names], *results)


def landed(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet under the shared scratch folder and read back: lineage ends here, and
    every executor (also one that replaces a lost one) can read it."""
    return landed_at(df, name)[0]


def landed_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``landed``, with the path (for ``discard``)."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # what the write has shuffled is not read again: its files go with the job
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: steps of ``lot``
LOTS = 1 << 30


def lot(seed: int, *columns: str) -> Column:
    """An even number from 0 to LOTS - 1 that depends on the columns alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(LOTS))


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the executors run (once a session)."""
    sc = spark.sparkContext
    if getattr(sc, "_urbanflow_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    above = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="urbanflow-ship-"), "urbanflow.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, above))
    sc.addPyFile(target)
    sc._urbanflow_shipped = True
