"""Centroid clustering against plain Lloyd rounds in Python integers."""

from hashlib import sha256

import numpy as np
import pytest
from compare import check, connect

from siltline.llm import centroids as cc
from siltline.llm.queries import ORACLE_SQL

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, vector string, distance string, ids int"


def lloyd(rows, width, k, rounds, seed=2, scale=256):
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of (vec_id, vector) rows."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == width and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in vector]))
    label = [sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    at = [q for _, (_, q) in sorted(zip(label, kept, strict=True), key=lambda x: (x[0], x[1][1]))][:k]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(at)) for _, q in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(at)):
            members = [q for (_, q), (_, own) in zip(kept, found, strict=True) if own == j]
            if members:
                at[j] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    found = assign()
    inertia = {j: sum(d for d, own in found if own == j) for j in range(len(at))}
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    total = sum(inertia.values())
    return [(i, j, d, inertia[j], total, digest[j]) for (i, _), (d, j) in zip(kept, found, strict=True)]


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_sql(spark, sf_dir):
    query = cc.op11_centroid_clustering
    assert check(spark, connect(sf_dir), sf_dir, query, ORACLE_SQL["op11_centroid_clustering"]) == ""


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_equals_plain_rounds(spark, block_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (6, 4))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + rng.normal(0, 0.5, 4)]) for i in range(240)]
    rows += [(1000 + i, [0.25, -0.5, 0.0, 1.0]) for i in range(80)]  # one value holds a quarter of all rows
    df = spark.createDataFrame([(*r, 1, 9, "x", "y", 4) for r in rows], SCHEMA)
    got = cc.cluster_vectors(df.repartition(3), width=4, clusters=9, rounds=5, block_rows=block_rows)
    assert found(got) == sorted(lloyd(rows, 4, 9, 5), key=str)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [1.0, -1.0]), (None, [0.5, 2.0]), (2, None), (3, []), (4, [1.0]), (5, [nan, 0.0]),
        (6, [inf, 0.0]), (7, [None, 1.0]), (8, [-1.0, -1.0]), (9, [1.0, 1.0]), (10, [-300000.5, 500000.0]), (11, [-0.001, 0.001]),
    ]
    df = spark.createDataFrame([(*r, None, 9, None, "y", 4) for r in rows], SCHEMA)
    for k in (1, 3, 40):  # 40: more clusters than vectors; equal vectors start two clusters, the second stays empty
        got = cc.cluster_vectors(df, width=2, clusters=k, rounds=5)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert found(got) == sorted(lloyd(rows, 2, k, 5), key=str), k


def test_no_vectors(spark):
    for rows in ([], [(1, [0.5], 1, 2, "a", "b", 3), (2, None, 1, 2, "a", "b", 3)]):
        got = cc.cluster_vectors(spark.createDataFrame(rows, SCHEMA), width=2)
        assert got.collect() == [] and got.columns[:3] == ["vec_id", "cluster", "distance"]


def test_a_component_beyond_a_long_is_refused(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0], 1, 2, "a", "b", 3)], SCHEMA)
    with pytest.raises(ValueError, match="2\\^27"):
        cc.cluster_vectors(df, width=2)


def test_only_due_vectors_are_measured_again():
    rng = np.random.default_rng(5)
    centres = rng.integers(-400, 400, (8, 16))
    codes = cc.narrowest(centres[rng.integers(0, 8, 3000)] + rng.integers(-60, 60, (3000, 16)))
    at = codes[:8].astype(np.int64)
    block, drift, due = cc.Block.of(codes, at), np.zeros(8), []
    for _ in range(12):
        counts = np.maximum(block.sums[:, -1:], 1)
        new = np.where(block.sums[:, -1:] > 0, block.sums[:, :-1] // counts, at)
        drift += cc.drifts(np.sqrt(((new - at) ** 2).sum(axis=1)))
        at = new
        due.append(block.advance(at, drift))
        plain = cc.squares(codes, at).argmin(axis=1)
        got = np.empty(3000, int)
        for j in range(8):
            got[block.members(j)] = j
            keys = block.keys[block.members(j)]
            assert all(keys[(i - 1) // 2] <= keys[i] for i in range(1, len(keys)))  # still a heap
        assert np.array_equal(got, plain)
    assert due[-1] < 3000 / 4  # once the centroids settle, few are


def test_wide_values_take_the_integer_path():
    rng = np.random.default_rng(7)
    codes, at = rng.integers(-(1 << 27), 1 << 27, (20, 64)), rng.integers(-(1 << 27), 1 << 27, (3, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c, strict=True)) for c in at] for x in codes]
    assert cc.squares(codes, at).tolist() == want
