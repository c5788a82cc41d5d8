"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Input partition p holds n_p rows; shard s is to hold m_s. How many rows of p go to s in a uniform
random permutation follows a matrix-valued hypergeometric law with these margins. It is drawn here by
halving: the partitions are split in two, the left half's column sums are one multivariate
hypergeometric draw, and so on down to one partition. Each draw is seeded by its place in the tree, so
a task draws the path to its own row alone (log2 of the partitions draws) and no matrix is built
anywhere. A seeded local permutation picks which rows of p make up its counts; after the exchange a
second permutation orders each shard, in buckets of a bounded number of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import landed, packed, ship, unpacked

#: rows that one sorting task of a shard is made for
PER_BUCKET = 8192
_PART_SHIFT = 33  # of monotonically_increasing_id()


def shard_sizes(n: int, shards: int) -> list[int]:
    """Row counts at most one apart."""
    return [n // shards + (s < n % shards) for s in range(shards)]


def _log_factorial(x: np.ndarray) -> np.ndarray:
    """Stirling's series, for the large arguments of ``draw`` (relative error under 1e-15 beyond 16)."""
    x = np.asarray(x, float) + 1
    shift = np.where(x < 16, np.prod([x + k for k in range(16)], axis=0), 1.0)
    y = np.where(x < 16, x + 16, x)
    return (y - .5) * np.log(y) - y + .5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) - np.log(shift)


def draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """One hypergeometric draw; numpy's own covers totals under 1e9, beyond which the probabilities
    within 12 standard deviations of the mean are drawn from directly."""
    total = good + bad
    if sample == 0 or good == 0:
        return 0
    if total < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, sample))
    mean = sample * (good / total)
    sd = math.sqrt(max(1.0, mean * (bad / total) * ((total - sample) / (total - 1))))
    k = np.arange(max(0, sample - bad, int(mean - 12 * sd)), min(good, sample, int(mean + 12 * sd) + 1) + 1)
    w = -(_log_factorial(k) + _log_factorial(good - k) + _log_factorial(sample - k)
          + _log_factorial(bad - sample + k))
    w = np.cumsum(np.exp(w - w.max()))
    return int(k[np.searchsorted(w, rng.random() * w[-1], side="right")])


def matrix_row(counts: np.ndarray, sizes: list[int], at: int, seed: int) -> list[int]:
    """Row ``at`` of the communication matrix whose row sums are ``counts`` and column sums ``sizes``."""
    before = np.concatenate(([0], np.cumsum(counts)))
    lo, hi, columns = 0, len(counts), list(sizes)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        take, rest, left = int(before[mid] - before[lo]), int(before[hi] - before[lo]), []
        for c in columns:
            k = draw(rng, c, rest - c, take)
            left.append(k)
            take, rest = take - k, rest - c
        if at < mid:
            hi, columns = mid, left
        else:
            lo, columns = mid, [c - k for c, k in zip(columns, left)]
    return columns


def shuffle_into_shards(docs: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """Every row of docs with ``shard`` (int, 0 to shards - 1) and ``slot`` (long, gapless from 0 in each
    shard): a uniform random permutation cut into shards whose row counts differ by one at most.

    Nulls, texts and repeated rows play no part: each row is placed by its position alone (equal texts
    are spread like any others). Fewer rows than shards: the later shards stay empty. Empty table: no
    rows. The same input files, split alike, give the same result.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = landed(docs.select(packed(docs), F.monotonically_increasing_id().alias("pos")), "shard_rows")
    part = F.shiftrightunsigned("pos", _PART_SHIFT)
    held = rows.groupBy(part.alias("part")).count().orderBy("part").collect()  # a row a partition
    parts, counts = np.array([r["part"] for r in held], np.int64), np.array([r["count"] for r in held], np.int64)
    total = int(counts.sum())
    sizes = shard_sizes(total, shards)

    def place(frames):
        known: dict[int, np.ndarray] = {}  # of the partition at hand
        for pos in frames:
            p, i = pos.to_numpy() >> _PART_SHIFT, pos.to_numpy() & ((1 << _PART_SHIFT) - 1)
            out = np.empty(len(p), np.int32)
            for one in np.unique(p).tolist():
                if one not in known:
                    row = int(np.searchsorted(parts, one))
                    dealt = np.repeat(np.arange(shards, dtype=np.int32), matrix_row(counts, sizes, row, seed))
                    known = {one: np.random.default_rng([seed, 1, one]).permutation(dealt)}
                here = p == one
                out[here] = known[one][i[here]]
            yield pd.Series(out)

    from collections.abc import Iterator  # the UDF's kind is read from its annotations

    place.__annotations__ = {"frames": Iterator[pd.Series], "return": Iterator[pd.Series]}
    buckets = max(1, -(-total // (shards * PER_BUCKET)))
    key = F.xxhash64(F.lit(seed), "pos")
    placed = rows.select("__in", "pos", F.pandas_udf(place, "int")("pos").alias("shard"), key.alias("key"))
    placed = placed.withColumn("bucket", F.pmod("key", F.lit(buckets)))
    sums = landed(placed.groupBy("shard", "bucket").count(), "shard_buckets")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("key", "pos")) - 1
    out = (placed.withColumn("rank", rank).join(offsets, ["shard", "bucket"])
           .withColumn("slot", F.col("rank") + F.col("offset")))
    return unpacked(out, ["shard", "slot"])
