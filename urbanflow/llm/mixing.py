"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Each source's documents are shuffled by a hash. A document's virtual finish time is its source's
cumulative size up to and with it, divided by the source's target; a second and third copy finish one
and two source sizes later. All copies are range-sorted by finish time and the mix is the longest
prefix within the total budget.

How it scales
  * Running sums need no task that holds a source: hash ranges of bounded size are summed first, their
    offsets are running sums over the few range totals, and the window runs within a range.
  * Rows that repeat one document in greater number than a range takes get a hash each, by a skew-safe number.
  * The cut of the global order is found from the totals of the range partitions; the one that crosses the
    budget is cut into ranges again until one window over a bounded number of rows finds the place.
  * Per-source figures (one row a source) are the only thing that one task sees whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import sequence_number
from .common import WORD, landed, packed, unpacked

#: rows of a hash range that one window task is made for
PER_RANGE = 16384
#: rows of a range partition of the cut, and partitions of one sorting of it, at most
CUT_ROWS, CUT_PARTS = 1 << 17, 4096


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], epochs: int) -> DataFrame:
    """(none, name, source_size) with ``target``: weights dealt in order (null source last) share the sum of
    all sizes; a target stops at ``epochs`` times its source's size, the excess goes to the others by weight.

    By rising cap / weight the capped sources come first; the level of the rest is what they leave over
    the weights that remain. One row a source.
    """
    n = F.row_number().over(Window.orderBy("none", "name")) - 1
    w = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                                (n % len(weights) + 1).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * F.lit(epochs)).withColumn("ratio", F.col("cap") / F.col("weight"))
    order, whole = Window.orderBy("ratio", "none", "name"), Window.partitionBy()
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    w = (w.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
         .withColumn("weights", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))))
    w = w.withColumn("level", F.col("left") / F.col("weights"))
    first = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "none", "name", "level"))).over(whole)
    w = w.withColumn("free", first["level"])
    return w.select("none", "name", "source_size", F.when(
        F.col("free").isNull() | (F.col("ratio") <= F.col("free")), F.col("cap").cast("double"))
        .otherwise(F.col("free") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), epochs: int = 3, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", carry: list[str] | None = None,
        seed: int = 42) -> DataFrame:
    """Every row of docs with ``size`` (words), ``source_size``, ``target`` (of its source) and ``taken``
    (words the mix takes of it: its size times 0 to ``epochs``).

    Null source: a source of its own, after the others. Null or empty text: size 0, never taken. Null id:
    shuffled by its text. Repeated rows: each is a document of its own; they may be taken unlike often.
    No words at all: all targets 0. Empty table: no rows. The same rows give the same result.
    """
    text, source = F.col(text_col), F.col(source_col)
    base = landed(docs.select(
        packed(docs, carry), source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"),
        word_count(text).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("h")), "mix_rows")
    base = _spread_repeats(base)
    count, budget = base.agg(F.count("*"), F.sum("size")).first()
    budget = budget or 0
    bits = max(1, math.ceil(math.log2(max(1, count / PER_RANGE))))
    base = base.withColumn("range", F.shiftright("h", 64 - bits))

    sums = landed(base.groupBy("none", "name", "range").agg(F.sum("size").alias("size")), "mix_sums")
    before = Window.partitionBy("none", "name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("none", "name", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    totals = landed(targets(sums.groupBy("none", "name").agg(F.sum("size").alias("source_size")), weights, epochs),
                    "mix_targets")
    within = (Window.partitionBy("none", "name", "range").orderBy("h", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (base.withColumn("run", F.sum("size").over(within)).join(offsets, ["none", "name", "range"])
              .join(totals, ["none", "name"]).withColumn("cum", F.col("offset") + F.col("run")))

    def finish(e: Column) -> Column:
        return (e * F.col("source_size") + F.col("cum")) / F.col("target")

    copies = (ranked.where("size > 0").select("cum", "h", "size", "source_size", "target",
                                              F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("e"))
              .select(finish(F.col("e")).alias("v"), "h", "e", "size"))
    cut = _cut(copies, budget, count * epochs)
    if cut is None:
        taken = F.lit(0).cast("long")
    else:
        v, h, e = cut
        taken = sum((F.when(_until(finish(F.lit(k)), F.col("h"), k, v, h, e), F.col("size")).otherwise(0)
                     for k in range(epochs)), F.lit(0))
    out = ranked.withColumn("taken", F.when(F.col("size") > 0, taken).otherwise(0).cast("long"))
    return unpacked(out, ["size", "source_size", "target", "taken"])


def _until(v: Column, h: Column, e: int, cut_v: float, cut_h: int, cut_e: int) -> Column:
    """(v, h, e) is not after the cut."""
    tie = (h < F.lit(cut_h)) | ((h == F.lit(cut_h)) & F.lit(e <= cut_e))
    return (v < F.lit(cut_v)) | ((v == F.lit(cut_v)) & tie)


def _spread_repeats(base: DataFrame) -> DataFrame:
    """base with another hash for each of the rows of a hash that more than a range's worth of them share. They
    are numbered (skew-safe), so the hashes, though not who has which, are the same in every run."""
    heavy = landed(base.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > PER_RANGE).select("h"), "mix_repeats")
    if not heavy.head(1):
        return base
    again = sequence_number(base.join(heavy, "h", "left_semi"), ["h"], ["none", "name"], "copy")
    again = again.withColumn("h", F.xxhash64("h", "copy")).drop("copy")
    return landed(base.join(heavy, "h", "left_anti").select(*base.columns).union(again.select(*base.columns)), "mix_spread")


def _cut(copies: DataFrame, budget: int, rows: int):
    """Last (v, h, e) of the global order whose running size is within the budget; None if none is.

    Range-sorted, a partition that lies wholly within the budget is told by its sum. The one that the budget ends
    in is sorted into ranges anew, until it has at most ``CUT_ROWS`` rows for the one window that finds the place
    (or no more than one key, which cannot be parted)."""
    key = ["v", "h", "e"]
    run, last, frame = 0, None, copies
    while True:
        n = max(1, min(CUT_PARTS, -(-rows // CUT_ROWS)))
        ordered = landed(frame.repartitionByRange(n, *key).withColumn("part", F.spark_partition_id()), "mix_order")
        parts = sorted(ordered.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min(F.struct(*key)).alias("first"),
                                                   F.max(F.struct(*key)).alias("last")).collect(), key=lambda r: tuple(r["last"]))
        hit = None
        for r in parts:  # at most CUT_PARTS rows
            if run + r["size"] > budget:
                hit = r
                break
            run, last = run + r["size"], tuple(r["last"])
        if hit is None:
            return last
        frame, rows = ordered.where(F.col("part") == hit["part"]).drop("part"), hit["n"]
        if rows <= CUT_ROWS or hit["first"] == hit["last"]:
            break
    here = frame.withColumn("run", F.sum("size").over(Window.orderBy(*key)))
    found = here.where(F.col("run") <= budget - run).agg(F.max(F.struct(*key)).alias("last")).first()["last"]
    return tuple(found) if found is not None else last


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of docs, each row as often as ``mix`` takes it."""
    inner = docs.select(F.struct("*").alias("doc")).select(
        "doc", *[F.col("doc")[c].alias(c) for c in ("doc_id", "text", "source")])
    out = mix(inner, carry=["doc"], **options).where("taken > 0")
    times = F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))
    return out.withColumn("copy", F.explode(times)).select("doc.*")
