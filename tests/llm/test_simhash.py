"""SimHash groups against brute force over all pairs."""

import numpy as np
import pytest
import xxhash

from fixtures import HELLO, messy, read
from urbanflow.llm import components, simhash
from urbanflow.llm.queries import op1_simhash


def brute_fingerprint(text):
    words = []
    word = ""
    for ch in (text or "") + " ":
        if ch in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += ch.lower() if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(values, bits=4):
    """Smallest position reachable, by breadth-first search."""
    root = {}
    for i in range(len(values)):
        if i in root:
            continue
        todo = [i]
        root[i] = i
        while todo:
            a = todo.pop()
            for b in range(len(values)):
                if b not in root and bin(values[a] ^ values[b]).count("1") <= bits:
                    root[b] = i
                    todo.append(b)
    return [root[i] for i in range(len(values))]


def test_query_equals_brute_force(spark):
    docs = read(spark, "documents").orderBy("doc_id").collect()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op1_simhash(spark, "/root/testdata/sf0.001").collect()}
    fps = [brute_fingerprint(d["text"]) for d in docs]
    groups = brute_groups(fps)
    assert got == {d["doc_id"]: (f"{f:016x}", docs[g]["doc_id"]) for d, f, g in zip(docs, fps, groups)}


def test_links_of_planted_fingerprints(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 60, dtype=np.uint64).tolist()
    for base in values[:12]:  # chains: each member a few bits from the one before
        for bits in (1, 2, 3, 4, 4, 5):
            flips = rng.choice(64, bits, replace=False)
            base ^= sum(1 << int(b) for b in flips)
            values.append(base)
    values = sorted(set(values))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    links = simhash.link_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3))
    found = {r["node"]: r["root"] for r in links.collect()}
    want = {}
    for v, g in zip(signed, brute_groups(values)):
        want.setdefault(g, []).append(v)
    assert {frozenset(x) for x in want.values() if len(x) > 1} == {
        frozenset(k for k, r in found.items() if r == root) for root in set(found.values())}


def test_a_dense_cluster_is_linked_without_all_pairs():
    flips = simhash.masks(2)
    centre = np.uint64(0x0123456789ABCDEF)
    fps = np.unique(centre ^ flips)[:1500]
    rows = simhash.variants(fps, flips, 40)
    node, root = simhash.meet(rows >> np.uint64(12), fps[(rows & np.uint64(4095)).astype(int)], 4)
    assert len(node) == len(fps) - 1 and set(root.tolist()) == {int(fps.min())}


def test_blocks_round_trip():
    fps = np.unique(np.random.default_rng(2).integers(0, 2**63, 50, dtype=np.uint64))
    flips = simhash.masks(2)
    for bits, bucket_bits in ((30, 3), (52, 9), (20, 0), (12, 12)):
        rows = simhash.variants(fps, flips, bits)
        assert len(rows) == len(fps) * 2081 and (np.diff(rows.astype(np.int64)) >= 0).all()
        assert set((rows & np.uint64(4095)).tolist()) == set(range(len(fps)))
        back, at = [], 0
        for bucket, first, block in simhash.blocks(rows, bits, bucket_bits):
            assert first == at and 0 <= bucket < 1 << bucket_bits
            back.append(simhash.unblock(bucket, block, bits, bucket_bits))
            assert (back[-1] >> np.uint64(bits - bucket_bits) == bucket).all()
            at += len(back[-1])
        assert np.array_equal(np.concatenate(back), rows >> np.uint64(12))
    with pytest.raises(ValueError):
        simhash.link_fingerprints(None, 3)


def test_equal_variants_have_equal_hashes_whatever_the_chunk():
    flips = simhash.masks(2)
    a, b = np.uint64(77), np.uint64(77 ^ 0b1111)  # 4 bits apart: six values lie half way
    x, y = (simhash.variants(np.array([v], np.uint64), flips, 50) >> np.uint64(12) for v in (a, b))
    places = simhash.repeated([x, y])
    assert np.array_equal(x[places[0]], y[places[1]]) and len(places[0]) == 6
    assert [p.tolist() for p in simhash.repeated([np.array([1, 2, 2], np.uint64), np.array([3, 1], np.uint64)])] == [[0, 1, 2], [1]]


@pytest.mark.parametrize("fingerprints", [51_000, 1_000_000, 14_000_000, 100_000_000])
def test_bytes_a_variant_do_not_grow_with_the_input(fingerprints):
    flips = simhash.masks(2)
    bits, bucket_bits = simhash.key_bits(fingerprints, len(flips))
    fps = np.unique(np.random.default_rng(4).integers(0, 2**64, simhash.CHUNK, dtype=np.uint64))
    rows = simhash.variants(fps, flips, bits)
    size = sum(len(block) for _, _, block in simhash.blocks(rows, bits, bucket_bits))
    assert size / len(rows) <= 3.2
    assert fingerprints * len(flips) / 2 ** bits <= 2 ** -(simhash.SPARE - 1) and fingerprints * len(flips) >> bucket_bits <= simhash.PER_BUCKET


def test_links_over_several_chunks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    monkeypatch.setattr(simhash, "PER_BUCKET", 5000)
    rng = np.random.default_rng(5)
    values = np.unique(np.concatenate((rng.integers(0, 2**64, 90, dtype=np.uint64), np.uint64(5) ^ simhash.masks(1))))
    signed = [int(v) for v in values.view(np.int64)]
    links = simhash.link_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3))
    found = {r["node"]: r["root"] for r in links.collect()}
    want = {}
    for v, g in zip(signed, brute_groups([int(v) for v in values])):
        want.setdefault(g, []).append(v)
    assert {frozenset(x) for x in want.values() if len(x) > 1} == {frozenset(k for k, r in found.items() if r == root) for root in set(found.values())}


def test_components_of_long_paths(spark):
    path = [(f"n{i:04d}", f"n{i + 1:04d}") for i in range(200)] + [("x", "y"), ("y", "y"), ("y", "x"), ("q", "q")]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(path, "a string, b string")).collect()}
    assert got == {**{f"n{i:04d}": "n0000" for i in range(201)}, "x": "x", "y": "x"}
    none = components.connected_components(spark.createDataFrame([], "a long, b long"))
    assert none.count() == 0
    node, root = components.forest(np.array([5, 3, 9]), np.array([3, 1, 9]))
    assert dict(zip(node.tolist(), root.tolist())) == {5: 1, 3: 1}


def test_edges(spark):
    docs = messy(spark)
    out = simhash.near_duplicates(docs)
    rows = out.collect()
    assert len(rows) == docs.count() and rows[0]["text"] is not None or True
    assert {r["component_id"] for r in rows if r["text"] == HELLO} == {1}
    assert {r["component_id"] for r in rows if not (r["text"] or "").strip()} == {2}  # no words: linked like any other
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert all(r["row"] == "own row" for r in rows)  # an input column that no result displaces
    assert sum(r["component_first"] for r in rows) == len({r["fingerprint"] for r in rows})
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == 6 and kept.where("fingerprint = 'own fingerprint'").count() == 6
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.deduplicate(docs.limit(0)).count() == 0
