"""The pipeline: each stage's decision on its own input, columns, edges, the whole run."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from fixtures import HELLO, messy, read
from test_lines import brute as brute_lines
from test_packing import check, ids_of
from test_simhash import brute_fingerprint, brute_groups
from urbanflow.llm.common import landed
from urbanflow.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stage_list():
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "mixing", "packing"]
    assert cp.ORACLE_SQL is None and [n for n in QUERIES if n.startswith("op")] == list(QUERIES) and len(QUERIES) == 13


def test_language_stage_without_labels_and_with_several_languages(spark):
    docs = read(spark, "documents")
    stage = dict(cp.STAGES)["language_id"]
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert stage(spark, bare, SF).exceptAll(bare).count() == 0 and stage(spark, bare, SF).count() == docs.count()
    parts = [r["text"] for r in docs.where("lang is not null and n_chars between 500 and 3000").dropDuplicates(["lang"]).collect()]
    assert len(parts) >= 3
    mixed = docs.where("doc_id >= 0").unionByName(spark.createDataFrame(
        [(-1, " ".join(p[:500] for p in parts), None, "x", 1), (-2, "123 !!", None, "x", 1), (-3, None, "en", "x", None)], docs.schema))
    kept = {r["doc_id"] for r in stage(spark, mixed, SF).select("doc_id").collect()}
    assert -1 in kept and not kept & {-2, -3}


def test_run_stage_by_stage_against_brute_force(spark):
    from tokenizers import Tokenizer
    docs = read(spark, "documents")
    columns = docs.columns
    stage = dict(cp.STAGES)

    lang = landed(stage["language_id"](spark, docs, SF), "t_lang")
    assert lang.columns == columns and lang.count() >= 0.97 * docs.count()  # clean documents stay

    lines = landed(stage["line_dedup"](spark, lang, SF), "t_lines")
    assert lines.columns == columns and lines.dtypes == docs.dtypes
    want = brute_lines({r["doc_id"]: r["text"] for r in lang.collect()}, 10)
    got = {r["doc_id"]: r for r in lines.collect()}
    assert {i: r["text"] for i, r in got.items()} == {i: t for i, (_, _, t) in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())

    near = landed(stage["simhash_dedup"](spark, lines, SF), "t_near")
    ids = sorted(got)
    groups = brute_groups([brute_fingerprint(got[i]["text"]) for i in ids])
    assert near.columns == columns and sorted(r["doc_id"] for r in near.collect()) == sorted({ids[g] for g in groups})

    mix = landed(stage["mixing"](spark, near, SF), "t_mix")
    assert mix.columns == columns
    times = Counter(r["doc_id"] for r in mix.collect())
    assert max(times.values()) <= 3 and mix.select("doc_id", "text").distinct().count() == len(times)
    words = {r["doc_id"]: len(r["text"].encode().split()) for r in near.collect()}
    total = sum(words.values())
    assert total - max(words.values()) <= sum(words[i] * n for i, n in times.items()) <= total

    rows = stage["packing"](spark, mix, SF).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    size = {r["doc_id"]: len(ids_of(tokenizer, r["text"])) for r in mix.collect()}
    assert sum(r["length"] for r in rows) == sum(size[i] * n for i, n in times.items())

    whole = cp.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    assert sum(r["length"] for r in whole) == sum(r["length"] for r in rows)
    assert {r["doc_id"] for r in whole} == {r["doc_id"] for r in rows} and len(key(whole[0])) == 4


def test_edges(spark):
    docs = messy(spark)
    stages = dict(cp.STAGES)
    lang = stages["language_id"](spark, docs, SF)
    assert lang.columns == docs.columns
    kept = [r["doc_id"] for r in lang.collect()]
    assert not {2, 3, 5, 7} & set(kept) and kept.count(1) == 2
    lines = stages["line_dedup"](spark, docs, SF)
    assert lines.columns == docs.columns and lines.count() == docs.count() and lines.where("n_lines = 'own n_lines'").count() == docs.count()
    near = stages["simhash_dedup"](spark, docs, SF)
    assert [r["doc_id"] for r in near.where(F.col("text") == HELLO).collect()] == [1]
    assert stages["mixing"](spark, docs, SF).columns == docs.columns
    empty = docs.limit(0)
    for name, f in cp.STAGES:
        out = f(spark, empty, SF)
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == docs.columns, name
