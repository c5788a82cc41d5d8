"""Embedding near-dedup against all pairs; hashing, blocks, broken vectors."""

import os

import numpy as np
import pytest

from urbanflow.llm import embeddings
from urbanflow.llm.components import forest

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, extra string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "own", "e")
                                  for i, v, lab in rows], SCHEMA)


def clusters(n=40, per=12, dim=64, seed=0):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for c in range(n):
        centre = rng.standard_normal(dim)
        for _ in range(per):
            rows.append((i, (centre + rng.standard_normal(dim) * rng.choice([0.0, 0.15, 0.27, 0.4])).astype(np.float32).tolist(), c % 3))
            i += 1
    return rows


def brute(rows, threshold=0.93):
    x = embeddings.unit(np.array([r[1] for r in rows], float))
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= threshold) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    a, b = np.nonzero(near)
    root = np.arange(len(rows))
    child, top = forest(a, b)
    root[child] = top
    return near.sum(axis=1), root


@pytest.mark.parametrize("block", [embeddings.BLOCK, 4])
def test_links_and_components_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)  # 4: buckets are cut into many blocks
    rows = clusters()
    links, root = brute(rows)
    got = {r["vec_id"]: r for r in embeddings.near_vectors(frame(spark, rows)).collect()}
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (found <= links).all() and found.sum() >= 0.99 * links.sum() > 0
    same = np.mean([got[i]["component_id"] == root[i] for i in range(len(rows))])
    assert same > 0.99 and all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert all(r["extra"] == "e" for r in got.values())


def test_recall_on_the_given_vectors(spark):
    """All labels of the smaller check table's first part, against all pairs in blocks."""
    if not os.path.isdir("/root/testdata/check_s"):
        pytest.skip("no larger table here")
    table = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").where("label = 1")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    links, _ = brute(rows)
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(table).collect()}
    found = np.array([got[r[0]] for r in rows])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum()


def planted(n, dim=64, seed=3):
    """n random vectors, and a partner of each at a cosine from 0.93 to 0.96."""
    rng = np.random.default_rng(seed)
    u, w = embeddings.unit(rng.standard_normal((n, dim))), rng.standard_normal((n, dim))
    w = embeddings.unit(w - (w * u).sum(axis=1, keepdims=True) * u)
    c = rng.uniform(0.9305, 0.96, (n, 1))
    return u, c * u + np.sqrt(1 - c * c) * w


def test_recall_and_pair_work_do_not_change_with_the_size(spark):
    met = {}
    for n in (1_000, 8_000):
        u, v = planted(n)
        rows = [(i, x, 1) for i, x in enumerate(np.concatenate((u, v)).tolist())]
        got = embeddings.near_vectors(frame(spark, rows)).collect()
        linked = {r["vec_id"] for r in got if r["n_links"]}
        assert sum(i in linked for i in range(n)) >= 0.95 * n  # recall
        assert all(r["n_links"] <= 1 for r in got)
        how = embeddings.plan(0.93, 64, int(np.ceil(np.log2(2 * n * embeddings.PER_VECTOR))))
        codes = embeddings.buckets(np.concatenate((u, v)), *how)
        _, sizes = np.unique(codes, return_counts=True)
        met[n] = (sizes.astype(float) * (sizes - 1)).sum() / (2 * n)
    print("vectors met per vector", met)
    assert met[8_000] < 2 * met[1_000] and max(met.values()) < 100  # a power of two of buckets: a factor of two


@pytest.mark.parametrize("wanted", [4, 14, 20, 32, 40])
def test_plans_keep_their_recall(wanted):
    hashes, last, tables = embeddings.plan(0.93, 64, wanted)
    assert embeddings.recall_at(0.93, 64, hashes, last, tables) >= embeddings.RECALL
    assert abs(np.log2(last) + (hashes - 1) * 7 - wanted) < 0.6  # as many buckets as wanted
    for dim in (1, 2, 3, 8):  # fewer where hashes would lose links
        low = embeddings.plan(0.93, dim, wanted)
        assert low == (1, 1, 1) or embeddings.recall_at(0.93, dim, *low) >= embeddings.RECALL


def test_hadamard_is_orthogonal_and_buckets_are_stable():
    x = embeddings.unit(np.random.default_rng(1).standard_normal((50, 48)))
    h = embeddings.hadamard(np.pad(x, ((0, 0), (0, 16))))
    assert np.allclose((h * h).sum(axis=1), 64)
    matrix = embeddings.hadamard(np.eye(8))
    assert np.allclose(matrix @ matrix.T, 8 * np.eye(8)) and set(np.unique(matrix)) == {-1.0, 1.0}
    a, b = embeddings.buckets(x), embeddings.buckets(x[::-1])[::-1]
    assert (a == b).all() and a.shape == (50, embeddings.TABLES[0] * embeddings.PROBES)
    for dim in (1, 2, 3):
        assert embeddings.buckets(embeddings.unit(np.ones((2, dim)))).shape == (2, embeddings.TABLES[0] * embeddings.PROBES)


def test_edges(spark):
    v = [1.0] + [0.0] * 7
    rows = [(0, v, 1), (1, v, 1), (1, v, 1), (2, v, 2), (3, v, None), (4, None, 1), (5, [0.0] * 8, 1), (6, [], 1),
            (7, [1.0, None] + [0.0] * 6, 1), (8, [float("nan")] * 8, 1), (9, [float("inf")] + [0.0] * 7, 1),
            (10, [2.0] + [0.0] * 7, 1), (11, [1e-30] + [0.0] * 7, 1), (12, [1.0], 1), (None, v, 1), (13, [-1.0] + [-0.0] * 7, 1)]
    got = embeddings.near_vectors(frame(spark, rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    # five rows equal in direction to row 0: 1 (twice), the one without id, 10 and 11
    assert by[0] == [(5, 0, True)] and by[1] == [(5, 0, False)] * 2 and by[None] == [(5, 0, False)]
    assert by[10] == [(5, 0, False)] and by[11] == [(5, 0, False)]
    for i in (2, 3, 4, 5, 6, 7, 8, 9, 12, 13):
        assert by[i] == [(0, i, True)], i
    assert len(got) == len(rows)
    assert embeddings.near_vectors(frame(spark, [])).count() == 0
