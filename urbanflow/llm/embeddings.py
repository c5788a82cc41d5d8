"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations.

A hash rotates a vector pseudo-randomly (three rounds of sign flips and a fast Walsh-Hadamard
transform) and takes the signed axis it lies nearest to. A table joins several of these; a vector
goes into the ``PROBES`` buckets of each table whose axes it is nearest to together (multiprobe), so
two vectors meet if any of their probes agree. Every pair that meets is verified by its cosine in
double precision.

How many hashes a table joins, and into how many outcomes its last one is told apart, grows with the
number of a label's vectors: there are ``PER_VECTOR`` buckets for each of them, so that a vector meets
about as many others by chance at any size. The share of pairs at the threshold that still meet is
measured beforehand, and hashes that would bring it below ``RECALL`` are not joined.

How it scales
  * Equal vectors are one class with a count; copies never meet each other.
  * A bucket of more than ``BLOCK`` classes is cut into blocks of that size, and each pair of blocks is a
    task of its own: no task grows with a bucket and no pair is dropped.
  * Verified pairs are not shuffled. A pair is counted in the first bucket its two vectors share (both
    lists of buckets are computed again, for linked pairs only), a block returns one count a vector and
    a spanning forest of its links.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import landed, packed, ship, unpacked
from .components import connected_components, forest

#: tables, as few of them as keep RECALL
TABLES, PROBES = (6, 9, 12, 18, 24, 36), 4
#: buckets a table has for each vector of a label (a power of two is taken), and the share of pairs right at the
#: threshold that must meet in a bucket
PER_VECTOR, RECALL = 4, 0.97
#: pairs on which that share is measured
TRIALS = 600
BLOCK = 2048
SEED = 42


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length is a power of two), not scaled."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2)
        h *= 2
    return x.reshape(n, d)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def buckets(x: np.ndarray, hashes: int = 2, last: int | None = None, tables: int = TABLES[0],
            probes: int = PROBES) -> np.ndarray:
    """(rows, tables * probes) bucket numbers of unit vectors; a table's numbers are its own. Of the last hash
    ``last`` outcomes are told apart (default: all)."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    last = 2 * d if last is None else last
    padded = np.zeros((n, d))
    padded[:, :dim] = x
    signs = np.random.default_rng([SEED, d]).choice([-1.0, 1.0], (tables, hashes, 3, d))
    out = np.empty((n, tables * probes), np.int64)
    alternatives = min(3, 2 * d)
    for t in range(tables):
        loss, code = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
        for s in range(hashes):
            y = padded
            for flip in signs[t, s]:
                y = hadamard(y * flip) / np.sqrt(d)
            both = np.concatenate((y, -y), axis=1)
            top = np.argpartition(-both, alternatives - 1, axis=1)[:, :alternatives]
            near = np.take_along_axis(both, top, axis=1)
            gap = near.max(axis=1, keepdims=True) - near
            loss = (loss[:, :, None] + gap[:, None, :]).reshape(n, -1)
            outcomes = last if s == hashes - 1 else 2 * d
            code = (code[:, :, None] * outcomes + top[:, None, :] % outcomes).reshape(n, -1)
            if loss.shape[1] > probes:  # what is not among the best so far cannot be among them later
                best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
                loss, code = np.take_along_axis(loss, best, axis=1), np.take_along_axis(code, best, axis=1)
        if code.shape[1] < probes:
            code = np.pad(code, ((0, 0), (0, probes - code.shape[1])), mode="edge")
        out[:, t * probes:(t + 1) * probes] = code * tables + t
    return out


def level(rows: Column) -> Column:
    """log2 of the buckets a table wants for a label of so many vectors."""
    return F.ceil(F.log2(rows * F.lit(PER_VECTOR))).cast("int")


def recall_at(threshold: float, dim: int, hashes: int, last: int, tables: int = TABLES[0]) -> float:
    """Share of random pairs of exactly this cosine that meet in a bucket (measured, the same in every run)."""
    rng = np.random.default_rng([SEED, dim, hashes, last])
    u, w = unit(rng.standard_normal((TRIALS, dim))), rng.standard_normal((TRIALS, dim))
    w -= (w * u).sum(axis=1, keepdims=True) * u
    size = np.sqrt((w * w).sum(axis=1, keepdims=True))
    c = min(1.0, max(-1.0, threshold))
    v = c * u + np.sqrt(1 - c * c) * np.divide(w, size, out=np.zeros_like(w), where=size > 1e-9)
    a, b = buckets(u, hashes, last, tables), buckets(v, hashes, last, tables)
    return float((a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean())


def plan(threshold: float, dim: int, wanted: int) -> tuple[int, int, int]:
    """(hashes, outcomes of the last, tables) of the most buckets, up to 2^wanted a table, with which RECALL is
    kept; of as few tables as that takes. So the vectors that meet by chance grow with the tables, not with the
    label, unless its links themselves are that many (low dimensions, low thresholds). One bucket holds every pair."""
    outcomes = 2 << max(1, (dim - 1).bit_length())
    for total in range(wanted, 0, -1):
        hashes = max(1, math.ceil(total / math.log2(outcomes) - 1e-9))
        last = min(outcomes, max(1, round(2 ** total / outcomes ** (hashes - 1))))
        for tables in TABLES:
            if recall_at(threshold, dim, hashes, last, tables) >= RECALL:
                return hashes, last, tables
            if tables > TABLES[0] and dim < 8:  # too few directions for more tables to help
                break
    return 1, 1, 1


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(-1, dim)


def _code(plans: dict[tuple[int, int], tuple[int, int, int]]):
    """Unit vectors and their buckets, each once."""
    def code(frames):
        for frame in frames:
            for (dim, wanted), part in frame.groupby(["dim", "level"]):
                x = unit(np.stack([np.asarray(v, float) for v in part["vector"]]))
                found = buckets(x, *plans[int(dim), int(wanted)])
                yield part.assign(vector=[v.astype("<f8").tobytes() for v in x], codes=[np.unique(c) for c in found])
    return code


def _pairs(x: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, threshold: float):
    """(a, b) of left x right (each pair once if they are the same block) with a cosine of at least threshold."""
    for at in range(0, len(left), 512):
        rows = left[at:at + 512]
        a, b = np.nonzero(x[rows] @ x[right].T >= threshold)
        a, b = rows[a], right[b]
        ok = a < b if same else a != b
        yield a[ok], b[ok]


def _linked(x: np.ndarray, block: np.ndarray, i: int, j: int, bucket: int, size: np.ndarray, threshold: float,
            how: tuple[int, int, int]):
    """Of one pair of blocks: (rows with links, their links counted here, root row of each); None if none."""
    left = np.flatnonzero(block == i)
    found = list(_pairs(x, left, left if i == j else np.flatnonzero(block == j), i == j, threshold))
    a, b = (np.concatenate([f[side] for f in found]) if found else np.zeros(0, np.int64) for side in (0, 1))
    if not len(a):
        return None
    used, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    codes = buckets(x[used], *how)
    links = np.zeros(len(x), np.int64)
    for at in range(0, len(a), 8192):  # a pair counts only in the first bucket that both have
        pa, pb = a[at:at + 8192], b[at:at + 8192]
        ca, cb = codes[where[at:at + 8192][:len(pa)]], codes[where[len(a) + at:len(a) + at + len(pa)]]
        shared = (ca[:, :, None] == cb[:, None, :]).any(axis=2)
        first = np.where(shared, ca, np.iinfo(np.int64).max).min(axis=1) == bucket
        np.add.at(links, pa[first], size[pb[first]])
        np.add.at(links, pb[first], size[pa[first]])
    root = np.arange(len(x))
    child, top = forest(a, b)
    root[child] = top
    return used, links[used], root[used]


_UNIT = ["unit", "label", "dim", "level", "bucket", "i", "j"]


def _verify(threshold: float, plans: dict[tuple[int, int], tuple[int, int, int]]):
    """Rows arrive sorted by unit (label, bucket and pair of blocks); a unit that a batch ends in is held back."""
    def units(frame: pd.DataFrame):
        keys = [frame[c].to_numpy() for c in _UNIT]
        new = np.zeros(max(len(frame) - 1, 0), bool)
        for k in keys:
            new |= k[1:] != k[:-1]
        return np.concatenate(([0], np.flatnonzero(new) + 1, [len(frame)]))

    def work(frame: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
        node, size, block = frame["node"].to_numpy(), frame["size"].to_numpy(np.int64), frame["block"].to_numpy()
        vector = frame["vector"].to_numpy()
        dim, wanted, bucket, i, j = (frame[c].to_numpy() for c in ("dim", "level", "bucket", "i", "j"))
        nodes, links, roots = [], [], []
        for at in np.flatnonzero(np.diff(cuts) > 1).tolist():
            lo, hi = int(cuts[at]), int(cuts[at + 1])
            got = _linked(_matrix(vector[lo:hi], int(dim[lo])), block[lo:hi], int(i[lo]), int(j[lo]), int(bucket[lo]),
                          size[lo:hi], threshold, plans[int(dim[lo]), int(wanted[lo])])
            if got:
                nodes.append(node[lo + got[0]])
                links.append(got[1])
                roots.append(node[lo + got[2]])
        if not nodes:
            return pd.DataFrame({"node": pd.Series([], dtype=str), "links": np.zeros(0, np.int64), "root": pd.Series([], dtype=str)})
        return pd.DataFrame({"node": np.concatenate(nodes), "links": np.concatenate(links), "root": np.concatenate(roots)})

    def verify(frames):
        held = []
        for frame in frames:
            if not len(frame):
                continue
            held.append(frame)
            if all(frame[c].iloc[0] == frame[c].iloc[-1] and held[0][c].iloc[0] == frame[c].iloc[0] for c in _UNIT):
                continue  # one unit so far
            whole = pd.concat(held, ignore_index=True)
            cuts = units(whole)
            yield work(whole, cuts[:-1])
            held = [whole.iloc[cuts[-2]:]]
        if held:
            whole = pd.concat(held, ignore_index=True)
            yield work(whole, units(whole))
    return verify


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", threshold: float = 0.93, carry: list[str] | None = None) -> DataFrame:
    """Every row of vectors with ``n_links`` (other rows linked directly), ``component_id`` (smallest id
    reachable by links, its own included) and ``kept`` (its id is that).

    Linked: equal non-null labels, equal lengths, cosine of at least ``threshold``, found in a shared bucket.
    Null, empty or zero vectors and those with null or non-finite components link with nothing, nor does
    a null label. Null id: linked like any other; component_id is the smallest known id. Repeated rows:
    each is a vector of its own, linked to its copies. Empty table: no rows.
    """
    ship(vectors.sparkSession)
    v, label = F.col(vector_col), F.col(label_col).cast("string")
    inf = F.lit(float("inf"))
    sound = (v.isNotNull() & label.isNotNull()
             & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != inf)) & F.exists(v, lambda x: x != 0))
    base = vectors.select(packed(vectors, carry), F.col(id_col).alias("id"), label.alias("label"),
                          v.alias("vector"), F.coalesce(sound, F.lit(False)).alias("sound"))
    v = F.col("vector")
    node = F.when(F.col("sound"), F.concat_ws(":", F.hex(F.xxhash64(v)), F.hex(F.xxhash64(F.lit(1), v)),
                                              F.size(v).cast("string"), "label"))
    base = landed(base.select("__in", "id", "label", "vector", node.alias("node")), "vectors")
    classes = landed(base.where("node is not null").groupBy("node").agg(
        F.count("*").alias("size"), F.min("id").alias("first"), F.any_value("label").alias("label"),
        F.any_value("vector").alias("vector")).withColumn("dim", F.size("vector")), "vector_classes")

    levels = classes.groupBy("label", "dim").agg(level(F.count("*")).alias("level"))
    sized = classes.select("label", "dim", "node", "size", "vector").join(levels, ["label", "dim"])
    # dimensions and powers of two: few
    plans = {(r["dim"], r["level"]): plan(threshold, r["dim"], r["level"]) for r in levels.select("dim", "level").distinct().collect()}
    coded = landed(sized.mapInPandas(_code(plans), "label string, dim int, node string, size long, vector binary, level int, codes array<long>"),
                   "vector_codes")
    each = ["label", "dim", "bucket"]
    crowds = (coded.select("label", "dim", F.explode("codes").alias("bucket")).groupBy(*each).count().where(F.col("count") > BLOCK)
              .select(*each, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    rows = (coded.select("label", "dim", "level", "node", "size", "vector", F.explode("codes").alias("bucket"))
            .join(crowds, each, "left").na.fill(1, ["blocks"])
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks"))
    found = landed(rows.withColumn("unit", F.xxhash64("label", "dim", "bucket", "i", "j")).repartition("unit")
                   .sortWithinPartitions(*_UNIT, "node")
                   .mapInPandas(_verify(threshold, plans), "node string, links long, root string"), "vector_links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    marked = (classes.select("node", "size", "first").join(links, "node", "left").join(roots, "node", "left")
              .select("node", "first", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("root", "node").alias("root")))
    marked = landed(marked, "vector_marks")
    least = landed(marked.groupBy("root").agg(F.min("first").alias("component_id")), "vector_components")
    per_node = marked.join(least, "root").select("node", "n_links", "component_id")
    out = base.select("__in", "id", "node").join(per_node, "node", "left").select(
        "__in", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"))
    return unpacked(out, ["n_links", "component_id", "kept"])
