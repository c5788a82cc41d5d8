"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints within ``2r`` bits share a value that is within ``r`` bits of both. So every
distinct fingerprint emits all its variants within ``r`` bits (1 + 64 + 2016 of them for r = 2), the
variants are shuffled, and fingerprints that meet at a variant are verified and linked.

How it scales
  * Only distinct fingerprints emit; copies of a text cost one row each.
  * Most variants meet no other. So a map chunk first ships a hash of each variant alone, sorted and as
    differences: 2 to 4 bytes each, as the hash has a few bits more than it takes to number all variants.
    A bucket of about ``PER_BUCKET`` hashes, at any input size, finds those that stand there twice and tells
    their chunks at which places; a few in a hundred do by chance.
  * The chunks turn these places alone into (hash, fingerprint) pairs, which meet in a second shuffle and are
    told apart by bit distance. Equal variants have equal hashes, so no link is lost.
  * All members of a true variant are within 2r bits of each other, so a group is linked through a
    spanning forest of its bucket, never by all its pairs.
  * Components: distributed stars (components.py).
"""

from __future__ import annotations

from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import document_key, landed, packed, ship, unpacked
from .components import connected_components, forest

#: fingerprints that a map chunk turns into variants at a time (12 bits number them)
CHUNK = 1 << 12
#: variants a bucket is made for
PER_BUCKET = 2_000_000
#: blocks of a chunk that leave a task at once
BLOCKS = 64
#: bits of a variant's hash beyond those that number all variants: one in 2^SPARE meets another by chance
SPARE = 6
#: a group of up to so many is verified pair by pair; a larger one from its first member, and pair by
#: pair only if that fails
SMALL = 16
SEED = 42


def fingerprint(data: bytes | None, words: int = 4) -> int:
    """Unsigned SimHash of the word shingles of a UTF-8 text (A-Z lower-cased, ASCII white space
    between words, repeats counted). Fewer words than a shingle: all of them as one; none: 0."""
    found = data.lower().split() if data else []
    if not found:
        return 0
    text = b" ".join(found)
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(text, SEED)]
    else:
        n = len(found)
        sizes = np.fromiter(map(len, found), np.int64, n)
        starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        ends = (starts + sizes)[words - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(text[i:j], SEED) for i, j in zip(starts[:n - words + 1].tolist(), ends)]
    h = np.array(hashes, np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_ = 2 * bits.sum(axis=0, dtype=np.int64) > len(h)
    return int(np.packbits(set_, bitorder="little").view(np.uint64)[0])


def masks(radius: int) -> np.ndarray:
    """All 64-bit values with at most ``radius`` bits set."""
    return np.array([sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(64), k)],
                    np.uint64)


def _mix(v: np.ndarray) -> np.ndarray:
    """Spread variants evenly (a bijection of 64-bit values, in place)."""
    v *= np.uint64(0x9E3779B97F4A7C15)
    v ^= v >> np.uint64(32)
    v *= np.uint64(0xD6E8FEB86659FD93)
    v ^= v >> np.uint64(32)
    return v


def key_bits(fingerprints: int, flips: int) -> tuple[int, int]:
    """(bits of a variant's hash, the first of which number the buckets)."""
    variants = max(1, fingerprints * flips)
    return min(52, variants.bit_length() + SPARE), (max(1, -(-variants // PER_BUCKET)) - 1).bit_length()


def variants(fps: np.ndarray, flips: np.ndarray, bits: int) -> np.ndarray:
    """(hash, number of the fingerprint) of all variants of up to CHUNK fingerprints, packed, in ascending order."""
    rows = fps[:, None] ^ flips[None, :]
    for i in range(0, len(fps), 128):  # in place, a small part at a time: a chunk is the largest thing a task holds
        part = rows[i:i + 128]
        _mix(part)
        part >>= np.uint64(64 - bits)
        part <<= np.uint64(12)
        part |= np.arange(i, i + len(part), dtype=np.uint64)[:, None]
    rows = rows.ravel()
    rows.sort()
    return rows


def blocks(rows: np.ndarray, bits: int, bucket_bits: int):
    """(bucket, place of its first hash, block) of a chunk's variants: differences of the hashes, in as few bytes
    each as the largest takes."""
    edges = np.arange(1, 1 << bucket_bits, dtype=np.uint64) << np.uint64(bits - bucket_bits + 12)
    cuts = [0, *np.searchsorted(rows, edges).tolist(), len(rows)]
    for bucket, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if i == j:
            continue
        steps = rows[i:j] >> np.uint64(12)
        steps[1:] -= steps[:-1].copy()
        steps[0] -= np.uint64(bucket << (bits - bucket_bits))
        width = max(1, -(-int(steps.max()).bit_length() // 8))
        yield bucket, i, bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unblock(bucket: int, block: bytes, bits: int, bucket_bits: int) -> np.ndarray:
    """Hashes of a block, ascending."""
    width = block[0]
    raw = np.zeros(((len(block) - 1) // width, 8), np.uint8)
    raw[:, :width] = np.frombuffer(block, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(raw.view("<u8").ravel(), dtype=np.uint64) + np.uint64(bucket << (bits - bucket_bits))


def repeated(keys: list[np.ndarray]) -> list[np.ndarray]:
    """Places, in each of several lists of hashes, of those that stand there twice or more in all."""
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    same = flat[order[1:]] == flat[order[:-1]]
    twice = np.zeros(len(flat), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return [np.flatnonzero(t) for t in np.split(twice, np.cumsum([len(k) for k in keys])[:-1])]


def meet(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among fingerprints with equal keys, as a forest (node, root)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    alone = np.ones(len(keys), bool)  # most keys: nothing to verify
    alone[1:] &= keys[1:] != keys[:-1]
    alone[:-1] &= keys[1:] != keys[:-1]
    keys, fps = keys[~alone], fps[order[~alone]]
    del order, alone
    cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else np.array([0])
    sizes = np.diff(cuts)
    found_a, found_b = [], []
    small = np.repeat((sizes <= SMALL) & (sizes > 1), sizes)
    k, f = keys[small], fps[small]
    for d in range(1, SMALL):
        at = np.flatnonzero(k[d:] == k[:-d]) if len(k) > d else np.array([], np.int64)
        if not len(at):
            break
        a, b = f[at], f[at + d]
        ok = (np.bitwise_count(a ^ b) <= max_bits) & (a != b)
        found_a.append(a[ok])
        found_b.append(b[ok])
    for g in np.flatnonzero(sizes > SMALL).tolist():
        group = np.unique(fps[cuts[g]:cuts[g + 1]])
        rest = group
        while len(rest) > 1:  # first against all; whom it doesn't reach is tried against all in turn
            near = np.bitwise_count(group ^ rest[0]) <= max_bits
            if near.all():
                found_a.append(group)
                found_b.append(np.full(len(group), rest[0]))
                break
            found_a.append(group[near])
            found_b.append(np.full(int(near.sum()), rest[0]))
            rest = rest[1:]
    if not found_a:
        return np.array([], np.uint64), np.array([], np.uint64)
    return forest(np.concatenate(found_a), np.concatenate(found_b))


def link_fingerprints(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """(node, root) of every fingerprint (distinct longs in column ``fp``) that has a neighbour within
    ``max_bits`` (even) bits; root is the same for all that chains of such neighbours join."""
    if max_bits % 2 or max_bits < 0:
        raise ValueError("max_bits must be even: variants within half of it must meet")
    spark = fps.sparkSession
    ship(spark)
    flips = masks(max_bits // 2)
    bits, bucket_bits = key_bits(fps.count(), len(flips))

    def chunk(frames):
        from pyspark import TaskContext

        held, n, number = [], 0, TaskContext.get().partitionId() << 32

        def out(part):
            nonlocal number
            number += 1
            return pd.DataFrame({"chunk": [number], "fps": [part.tobytes()]})

        for frame in frames:
            held.append(frame["fp"].to_numpy(np.int64))
            n += len(held[-1])
            while n >= CHUNK:
                all_ = np.concatenate(held)
                yield out(all_[:CHUNK])
                held, n = [all_[CHUNK:]], n - CHUNK
        if n:
            yield out(np.concatenate(held))

    def emit(frames):
        for frame in frames:
            for number, raw in zip(frame["chunk"], frame["fps"]):
                found = blocks(variants(np.frombuffer(raw, np.uint64), flips, bits), bits, bucket_bits)
                while part := list(islice(found, BLOCKS)):
                    yield pd.DataFrame(part, columns=["bucket", "first", "block"]).assign(chunk=number)

    def find(frame):
        places = repeated([unblock(int(b), raw, bits, bucket_bits) for b, raw in zip(frame["bucket"], frame["block"])])
        some = [(c, (p + f).astype("<u4").tobytes()) for c, f, p in zip(frame["chunk"], frame["first"], places) if len(p)]
        return pd.DataFrame(some, columns=["chunk", "places"])

    def pick(mine, found):
        if not len(mine) or not len(found):
            return pd.DataFrame({"part": [], "pairs": []})
        fps_ = np.frombuffer(mine["fps"].iloc[0], np.uint64)
        rows = variants(fps_, flips, bits)[np.sort(np.frombuffer(b"".join(found["places"]), "<u4"))]
        keys, values = rows >> np.uint64(12), fps_[(rows & np.uint64(CHUNK - 1)).astype(np.int64)]
        top = keys >> np.uint64(max(0, bits - 32))
        part = (top * np.uint64(parts) >> np.uint64(min(bits, 32))).astype(np.int64)  # keys ascend, and so do parts
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
        return pd.DataFrame({"part": part[cuts[:-1]], "pairs": [
            np.stack((keys[i:j], values[i:j])).tobytes() for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]})

    def verify(frame):
        pairs = np.concatenate([np.frombuffer(p, np.uint64).reshape(2, -1) for p in frame["pairs"]], axis=1)
        node, root = meet(pairs[0], pairs[1], max_bits)
        return pd.DataFrame({"a": node.view(np.int64), "b": root.view(np.int64)})

    # landed: a chunk that is made anew must have the same fingerprints in the same order
    chunks = landed(fps.mapInPandas(chunk, "chunk long, fps binary"), "simhash_chunks")
    met = landed(chunks.repartition(_tasks(chunks)).mapInPandas(emit, "bucket long, first long, block binary, chunk long")
                 .groupBy("bucket").applyInPandas(find, "chunk long, places binary"), "simhash_places")
    many = met.agg(F.sum(F.octet_length("places"))).first()[0] or 0
    parts = max(1, -(-many // (4 * PER_BUCKET)))
    links = (chunks.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInPandas(pick, "part long, pairs binary")
             .groupBy("part").applyInPandas(verify, "a long, b long"))
    return connected_components(links)


def _tasks(chunks: DataFrame) -> int:
    """Map tasks of a few chunks each, so that emission uses every core and a task stays short."""
    return max(1, -(-chunks.count() // 2))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    max_bits: int = 4, carry: list[str] | None = None) -> DataFrame:
    """Every row of docs with ``fingerprint`` (16 lowercase hex digits), ``component_id`` (smallest id
    reachable over fingerprints that differ in up to ``max_bits`` bits) and ``component_first`` (true
    for one row of each component, one with its smallest id). ``carry``: the columns to keep (all).

    Null or empty text: no words, fingerprint zero, linked like any other. Null id: grouped like any
    other; component_id is null only if no id is reachable. Repeated rows: each stays a row, one is
    first. Empty table: no rows. Texts may be of any length.
    """
    ship(docs.sparkSession)

    def hashed(texts: pd.Series) -> pd.Series:
        values = [fingerprint(t, words) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    fp = F.pandas_udf(hashed, "long")(F.col(text_col).cast("binary"))
    base = landed(docs.select(packed(docs, carry), F.col(id_col).alias("id"), fp.alias("fp"),
                              F.monotonically_increasing_id().alias("row")), "simhash_rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    nodes = landed(base.groupBy("fp").agg(first.alias("first")), "simhash_fingerprints")
    roots = link_fingerprints(nodes.select("fp"), max_bits)
    rooted = landed(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash_roots")
    whole = landed(rooted.groupBy("root").agg(F.min("first").alias("of")), "simhash_components")
    classes = rooted.join(whole, "root").select("fp", "of")
    out = base.join(classes, "fp").select(
        "__in", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("of.id").alias("component_id"), (F.col("row") == F.col("of.row")).alias("component_first"))
    return unpacked(out, ["fingerprint", "component_id", "component_first"])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                max_bits: int = 4) -> DataFrame:
    """docs with one row of each near-duplicate component (see ``near_duplicates``), its columns as given.

    Only keys of documents go through the grouping; texts move once, to meet the keys that stay. Rows that
    repeat a document (same id and text) are told apart there, within their key.
    """
    keys = document_key(F.col(id_col), F.col(text_col))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *keys)
    stay = landed(near_duplicates(slim, "id", "text", words, max_bits, carry=["d1", "d2"])
                  .where("component_first").select("d1", "d2"), "simhash_kept")
    rows = docs.select(F.struct("*").alias("doc"), *keys).join(stay, ["d1", "d2"], "left_semi")
    first = F.row_number().over(Window.partitionBy("d1", "d2").orderBy(F.lit(0)))
    return rows.withColumn("n", first).where("n = 1").select("doc.*")
