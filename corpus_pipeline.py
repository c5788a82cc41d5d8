"""Corpus pipeline: language identification, line dedup, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and returns a
DataFrame that is written and reread; all but the last return the columns of documents. Null ids,
texts, languages and sources, empty and repeated rows, empty tables and further columns (whatever
their names) are treated as the operators' docstrings say.
"""

from __future__ import annotations

import os
import sys

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from urbanflow.llm import langid, linededup, mixing, packing, simhash  # noqa: E402
from urbanflow.llm.common import landed  # noqa: E402
from urbanflow.llm.queries import tokenizer_path  # noqa: E402


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language stay, also of several in turn; rejected are those without a letter (null
    texts among them). Without a labelled row nothing is learned, and every document stays."""
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    if model is None:
        return docs
    found = langid.identify(docs.select(F.struct("*").alias("doc"), "text"), model, carry=["doc"])
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select("doc.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share go from all of them; every document stays, n_chars is its new length."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")
    out = linededup.drop_common_lines(docs.select(rest, "doc_id", "text"), min_documents=10)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[new.get(c, F.col("rest")[c]).alias(c) for c in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.deduplicate(docs, words=4, max_bits=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document stands as often as it is taken (up to three times); those not taken go."""
    return mixing.mixed(docs, weights=(5.0, 2.0, 1.0), epochs=3)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: tokenisation and the learned stages are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over the documents of sf_dir, each result written to the shared scratch folder and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
