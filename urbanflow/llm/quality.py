"""Quality rules: counted rules, then a hashed n-gram log-likelihood ratio (DataFrame functions only).

Words and word pairs of a document are hashed into ``BUCKETS`` cells. Two multinomials are estimated:
one from trusted documents, one from every document of the corpus. A document's score is the sum of
log(p_trusted / p_corpus) over its n-grams, divided by their number plus ``PRIOR`` (short documents say
little, and shrink towards 0). The threshold is a low quantile of the scores of trusted documents that
were not fitted on, so its meaning does not change with size. Every trusted document counts: half of them,
by hash of the id, in the fit, the others in the threshold.

How it scales: counts are exploded cells with map-side sums (at most BUCKETS rows a task are shuffled); the
model is one array of BUCKETS doubles, used as a scalar subquery; every figure of a document comes from its
own row by array functions, from cells that are hashed once and landed (2 bytes each). The trusted ids grow
with the corpus, so they are joined by a shuffle: to the scores of the half that sets the threshold, and, before
anything is landed, to the texts of the other half. No other text moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, discard, landed, landed_at, lot, packed, unpacked

BUCKETS = 1 << 16
#: pseudo-count of each cell
SMOOTHING = 1.0
PRIOR = 32
#: share of clean documents that the threshold may cost
QUANTILE = 0.002
#: scores are compared on a grid of this step
GRID = 1e-4
WINDOW = 8


def _let(value: Column, body) -> Column:
    """body(value) with value computed once (an expression used inside a lambda would be recomputed there)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _upto(first: int, last: Column) -> Column:
    """first .. last, empty if last is smaller."""
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))


def repeated_words(windows: Column, width: int = WINDOW) -> Column:
    """Words within windows (hash of each, in order) that occur twice or more: sort (hash, place), keep the
    places whose neighbour in that order has the same hash, add up what each adds to the covered words."""
    def covered(places: Column) -> Column:
        def add(acc, p):
            return F.struct((p + width).alias("end"), (acc["n"] + width - F.greatest(acc["end"] - p, F.lit(0))).alias("n"))
        return F.aggregate(places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), add)["n"]

    def repeats(ordered: Column) -> Column:
        def same(i):
            here = F.get(ordered, i)["h"]
            return (here == F.get(ordered, i - 1)["h"]) | (here == F.get(ordered, i + 1)["h"])
        at = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: F.coalesce(same(i), F.lit(False)))
        return covered(F.sort_array(F.transform(at, lambda i: F.get(ordered, i)["i"])))

    def body(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(pairs, repeats))

    return _let(windows, body)


def _hashed(text: Column) -> Column:
    """64-bit hash of each word, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def _cells(wh: Column) -> Column:
    """Cell of every word and word pair, from the word hashes; less BUCKETS / 2, which fits 2 bytes."""
    pairs = F.transform(_upto(0, F.size(wh) - 2), lambda i: F.xxhash64(F.get(wh, i), F.get(wh, i + 1)))
    return F.transform(F.concat(wh, pairs), lambda h: (F.pmod(h, F.lit(BUCKETS)) - BUCKETS // 2).cast("short"))


def _fitted(id_: str = "id") -> Column:
    """Whether the trusted document of this id is fitted on (else it sets the threshold)."""
    return F.pmod(lot(11, id_), F.lit(2)) == 0


def _counts(cells: DataFrame, name: str) -> DataFrame:
    """How often each cell occurs in the arrays ``cells`` (a plain explode would first filter by their size, and
    so hash words twice); a row of a null cell stands for the empty ones."""
    return cells.select(F.explode_outer("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias(name))


def log_ratios(corpus: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with ``model``: log(p_trusted / p_corpus) of every cell, as an array; from the counts n and t."""
    cells = corpus.sparkSession.range(BUCKETS).select((F.col("id") - BUCKETS // 2).cast("short").alias("cell"))
    full = cells.join(corpus, "cell", "left").join(trusted, "cell", "left").na.fill(0, ["n", "t"])
    totals = full.agg(F.collect_list(F.struct("cell", "n", "t")).alias("cells"), F.sum("n").alias("n"), F.sum("t").alias("t"))
    extra = SMOOTHING * BUCKETS

    def ratio(c):
        return (F.log((c["t"] + SMOOTHING) / (F.col("t") + extra)) - F.log((c["n"] + SMOOTHING) / (F.col("n") + extra)))
    return totals.select(F.transform(F.sort_array("cells"), ratio).alias("model"))


def quality(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            carry: list[str] | None = None) -> DataFrame:
    """Every row of docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    score and kept. ``trusted_ids``: frame of one column with ids of known good documents.

    base_failed: fewer than 20 words, or over 30 of 100 words within repeated 8-word windows. kept: not
    base_failed, and score not below the threshold. Null or empty text: all counts 0, score 0, base_failed.
    Null id: judged like any other, never trusted. Repeated rows: each is judged, and counts in the corpus.
    No trusted document in docs: nothing is dropped but what fails the rules. Empty table: no rows.
    """
    trusted = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("id")).where("id is not null")
    known = landed(docs.select(F.col(id_col).alias("id")).distinct().join(trusted, "id", "left_semi"), "quality_known")
    fit = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(_fitted())
           .join(known.where(_fitted()).hint("shuffle_hash"), "id"))
    t = landed(_counts(fit.select(_let(_hashed(F.coalesce("text", F.lit(""))), _cells).alias("cells")), "t"), "quality_trusted")
    base = docs.select(packed(docs, carry), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    step = base.select(
        "__in", "id", _hashed(F.col("text")).alias("wh"),
        F.length(F.regexp_replace("text", f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    wh = F.col("wh")
    windows = F.transform(_upto(0, F.size(wh) - WINDOW), lambda i: F.xxhash64(*[F.get(wh, i + k) for k in range(WINDOW)]))
    step, counted = landed_at(step.select(
        "__in", "id", F.size(wh).cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        repeated_words(windows).cast("long").alias("n_repeat_words"), _cells(wh).alias("cells")), "quality_counted")
    model = landed(log_ratios(_counts(step, "n"), t), "quality_model")
    # a subquery may not stand inside a higher-order function, so its value comes as a column
    score = F.aggregate("cells", F.lit(0.0), lambda s, c: s + F.get(F.col("model"), c.cast("int") + BUCKETS // 2))
    rows = step.withColumn("model", model.scalar()).withColumn("sum", score).drop("model", "cells")
    rows = rows.withColumn("score", F.col("sum") / (F.greatest(2 * F.col("n_words") - 1, F.lit(0)) + PRIOR))
    rows = rows.withColumn("cell", F.floor(F.col("score") / GRID))
    rows = landed(rows.withColumn("base_failed", (F.col("n_words") < 20)
                                  | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))), "quality_rows")
    discard(docs.sparkSession, counted)
    held_out = (rows.where("not base_failed").where(~_fitted()).select("id", "cell")
                .join(known.where(~_fitted()).hint("shuffle_hash"), "id"))
    order = Window.orderBy("cell")
    low = (held_out.groupBy("cell").count()
           .withColumn("upto", F.sum("count").over(order)).withColumn("all", F.sum("count").over(Window.partitionBy()))
           .where(F.col("upto") > QUANTILE * F.col("all")).agg(F.min("cell").alias("cell")))
    least = F.coalesce(low.scalar(), F.lit(-(1 << 62)))
    out = rows.withColumn("kept", ~F.col("base_failed") & (F.col("cell") >= least))
    return unpacked(out, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"])
