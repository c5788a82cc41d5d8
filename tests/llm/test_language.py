"""Language identification: held-out accuracy, code-switched text, forward-backward against enumeration."""

import itertools
import zlib

import numpy as np
import pytest

from fixtures import messy, read
from urbanflow.llm import langid
from urbanflow.llm.queries import op5_language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = read(spark, "documents", SF)
    from pyspark.sql import functions as F
    return langid.train(docs.where(~langid.held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in read(spark, "documents", SF).collect()}
    rows = op5_language(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97 and len(held) > 150


def test_code_switched_text_is_labelled_word_by_word(spark, model):
    docs = {r["lang"]: langid.words(r["text"])[:40] for r in read(spark, "documents", SF).orderBy("doc_id").collect()
            if len(langid.words(r["text"])) > 60}
    text = " ".join(docs["fr"] + docs["en"])
    gamma = dict(langid.label([text], model))[0]
    got = gamma.argmax(axis=1)
    want = np.repeat([model.languages.index("fr"), model.languages.index("en")], 40)
    assert (got == want).mean() > 0.9
    assert np.allclose(gamma.sum(axis=1), 1, atol=1e-4)
    assert np.array_equal(model.trans.argmax(axis=1), np.arange(len(model.languages)))  # staying is likelier


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    lengths, k = np.array([3, 1, 4, 2]), 3
    emit, start, trans = rng.normal(size=(10, k)), rng.normal(size=k), rng.normal(size=(k, k))
    gamma, expected = langid.forward_backward(emit, lengths, start, trans, pairs=True)
    want, pairs, at = np.zeros_like(emit), np.zeros((k, k)), 0
    for n in lengths:
        paths = list(itertools.product(range(k), repeat=int(n)))
        w = np.array([np.exp(start[p[0]] + sum(emit[at + i, y] for i, y in enumerate(p))
                             + sum(trans[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        w /= w.sum()
        for p, x in zip(paths, w):
            for i, y in enumerate(p):
                want[at + i, y] += x
            for a, b in zip(p, p[1:]):
                pairs[a, b] += x
        at += n
    assert np.allclose(gamma, want) and np.allclose(expected, pairs)
    long = langid.forward_backward(rng.normal(size=(50_000, k)).astype(np.float32) * 20, np.array([50_000]), start, trans)
    assert np.isfinite(long).all()


def test_the_fit_is_bounded_and_deterministic(spark, monkeypatch):
    monkeypatch.setattr(langid, "PER_LANGUAGE", 5)
    seen = []
    monkeypatch.setattr(langid, "fit", lambda rows: seen.append(rows))
    docs = read(spark, "documents")
    langid.train(docs)
    langid.train(docs.repartition(7))
    assert seen[0] == seen[1] and len(seen[0]) == 20


def test_edges(spark, model):
    docs = messy(spark)
    rows = langid.identify(docs, model).collect()
    assert len(rows) == docs.count() and all(r["fingerprint"] == "own fingerprint" for r in rows)
    for r in rows:
        if r["doc_id"] in (2, 3, 5, 7):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model.languages and 0 < r["score"] <= 1
    assert langid.identify(docs.limit(0), model).count() == 0
    from pyspark.sql import functions as F
    assert langid.train(docs.limit(0)) is None and langid.train(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}


def test_long_documents_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(langid, "PER_LANGUAGE", 5)
    monkeypatch.setattr(langid, "FIT_CHARS", 50)
    seen = []
    monkeypatch.setattr(langid, "fit", lambda rows: seen.append(rows))
    long = "".join(chr(97 + i % 26) + (" " if i % 7 == 6 else "") for i in range(900))
    rows = [(i, "long", long) for i in range(30)]
    rows += [(1000 + i, "mixed", "short text" if i % 100 == 0 else long) for i in range(2000)]
    rows += [(5000 + i, "unread", None) for i in range(2000)] + [(8000, "unread", "one text")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    langid.train(docs)
    langid.train(docs.repartition(7))
    assert seen[0] == seen[1]
    by = {lang: [t for t, x in seen[0] if x == lang] for lang in ("long", "mixed", "unread")}
    assert len(by["long"]) == len(by["mixed"]) == 5 and by["unread"] == ["one text"]
    assert all(t in long and len(t) == 50 for t in by["long"]) and len(set(by["long"])) > 1


def test_lottery_is_filtered_before_its_exchange_and_an_id_sends_one_span(spark):
    rows = [(1, "the same words again and again", "en")] * 300 + [(i, f"other words {i} of this language", "en") for i in range(2, 400)]
    rows += [(1000 + i, f"autres mots {i}", "fr") for i in range(40)] + [(None, "no id", "en"), (5000, None, "en"), (5001, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        drawn = langid.drawn_rows(docs)
        plan = drawn._jdf.queryExecution().executedPlan().toString()
        got = drawn.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the shares come by broadcast, so the lottery's filter stands with the join, below the exchange of its rows
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    lottery = next(line for line in plan.split("\n") if "BroadcastHashJoin" in line and "share" in line)
    assert "cast(lot" in lottery or "lot#" in lottery
    assert len(got) == len({(r["lang"], r["id"]) for r in got}) == 300 + 40
    assert all(r["id"] is not None and r["text"] and r["lang"] in ("en", "fr") for r in got)
