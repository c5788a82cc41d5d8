"""Quality rules: counts and scores against plain loops over the same hashes."""

import math
import re
import struct
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from fixtures import messy, read, texts
from urbanflow.llm import quality
from urbanflow.llm.queries import op10_quality

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def cells(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text or "")]
    pairs = [xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42)) for a, b in zip(h, h[1:])]
    return [signed(x) % quality.BUCKETS for x in h + pairs]


def test_query_equals_brute_force(spark):
    docs = texts(spark, SF)
    got = op10_quality(spark, SF).collect()
    labels = {r["doc_id"]: r for r in read(spark, "labels", SF).collect()}
    assert len(got) == len(docs)
    for r in got:
        want = counts(docs[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r["kept"] and r["base_failed"])
    # the verdict keeps nearly all clean documents that pass the rules, and drops most of the rest
    good = [r["kept"] for r in got if r["doc_id"] in labels and labels[r["doc_id"]]["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in got if r["doc_id"] in labels and labels[r["doc_id"]]["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.5


def test_scores_and_threshold(spark):
    docs = texts(spark, SF)
    good = {r["doc_id"] for r in read(spark, "labels", SF).where("quality = 1 and toxic = 0").collect()}
    key = {r["doc_id"]: r["k"] for r in read(spark, "documents", SF).select("doc_id", F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)).alias("k")).collect()}
    n, t = Counter(), Counter()
    for i, text in docs.items():
        c = cells(text)
        n.update(c)
        if i in good and key[i] % 2 == 0:
            t.update(c)
    extra = quality.SMOOTHING * quality.BUCKETS

    def ratio(c):
        return math.log((t[c] + quality.SMOOTHING) / (sum_t + extra)) - math.log((n[c] + quality.SMOOTHING) / (sum_n + extra))

    sum_n, sum_t = sum(n.values()), sum(t.values())
    got = {r["doc_id"]: r for r in op10_quality(spark, SF).collect()}
    for i in list(docs)[:150]:
        c = cells(docs[i])
        assert abs(got[i]["score"] - sum(map(ratio, c)) / (len(c) + quality.PRIOR)) < 1e-9
    held = sorted(math.floor(got[i]["score"] / quality.GRID) for i in good if key[i] % 2 and not got[i]["base_failed"])
    least = next(x for k, x in enumerate(held) if sum(y <= x for y in held) > quality.QUANTILE * len(held))
    assert all(r["kept"] == (not r["base_failed"] and math.floor(r["score"] / quality.GRID) >= least) for r in got.values())


def test_every_trusted_document_counts(spark):
    # more of them than the 20,000 that were once drawn
    rows = spark.range(21_000).select(F.col("id").alias("doc_id"), F.concat(F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(21)), lambda j: F.pmod(F.xxhash64(F.lit(j)), F.lit(50))), " "), F.lit(" "),
        F.pmod(F.xxhash64("id"), F.lit(900)).cast("string")).alias("text"))
    rows = rows.unionAll(spark.createDataFrame([(-1, "not trusted"), (None, "no id")], "doc_id long, text string")).localCheckpoint()
    ids = rows.where("doc_id >= 0").select(F.col("doc_id").cast("string").alias("id"))  # of another type
    fitted = {r["doc_id"] for r in rows.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(2)) == 0).select("doc_id").collect()}
    seen = {r["doc_id"]: r["text"] for r in rows.collect()}
    of = {text: cells(text) for text in set(seen.values())}
    n, t = Counter(), Counter()
    for i, text in seen.items():
        n.update(of[text])
        if i is not None and i >= 0 and i in fitted:
            t.update(of[text])
    sum_n, sum_t, extra = sum(n.values()), sum(t.values()), quality.SMOOTHING * quality.BUCKETS
    score = {text: sum(math.log((t[c] + quality.SMOOTHING) / (sum_t + extra)) - math.log((n[c] + quality.SMOOTHING) / (sum_n + extra))
                       for c in of[text]) / (len(of[text]) + quality.PRIOR) for text in of}
    got = {r["doc_id"]: r for r in quality.quality(rows, ids).collect()}
    assert len(got) == len(seen) and all(abs(r["score"] - score[seen[i]]) < 1e-9 for i, r in got.items())
    held = Counter(math.floor(r["score"] / quality.GRID) for i, r in got.items()
                   if i is not None and i >= 0 and i not in fitted and not r["base_failed"])
    upto, total = 0, sum(held.values())
    for least in sorted(held):
        upto += held[least]
        if upto > quality.QUANTILE * total:
            break
    assert all(r["kept"] == (not r["base_failed"] and math.floor(r["score"] / quality.GRID) >= least) for r in got.values())
    assert 0 < sum(not r["kept"] for i, r in got.items() if i is not None and i >= 0) < 200


def test_repeated_windows(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(60):
        ws = rng.integers(0, 3 if i % 2 else 300, int(rng.integers(0, 60))).astype(str).tolist()
        rows.append((i, " ".join(ws + ws[3:20] + ["x"] + ws[:int(rng.integers(0, 30))])))
    rows.append((99, "a b c d e f g h " * 4000))
    out = quality.quality(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], "id long"))
    assert {r["doc_id"]: r["n_repeat_words"] for r in out.collect()} == {i: counts(t)[4] for i, t in rows}


def test_no_python_on_the_main_path(spark):
    for name in ("quality", "mixing"):
        import importlib
        import inspect
        source = inspect.getsource(importlib.import_module(f"urbanflow.llm.{name}"))
        assert not re.search(r"pandas_udf|mapInPandas|mapInArrow|applyIn|\.rdd\b|import pandas|import pyarrow", source)


def test_edges(spark):
    docs = messy(spark)
    trusted = spark.createDataFrame([(4,), (None,), (4,), (12345,), (8,)], "id long")
    for ids in (trusted, trusted.limit(0)):
        rows = quality.quality(docs, ids).collect()
        assert len(rows) == docs.count() and all(r["cell"] == "own cell" and r["id"] == "own id" for r in rows)
        for r in rows:
            if not (r["text"] or "").strip():
                assert (r["n_words"], r["word_chars"], r["score"], r["base_failed"], r["kept"]) == (0, 0, 0.0, True, False)
        assert quality.quality(docs.limit(0), ids).count() == 0
    assert all(r["kept"] != r["base_failed"] for r in rows)  # nobody is trusted: the rules alone decide
    assert [r["n_dup_lines"] for r in rows if r["doc_id"] == 8] == [39]
