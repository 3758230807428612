"""Hard negatives over many blocks, tiles and runs: the same rows as by hand, and few rows leave a block."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives as h
from tests.llm.test_vectors import ODD, clustered, frame, negatives_by_hand


def coded(vectors, labels, directions):
    angle = h.measured(vectors, directions)[1]
    return pd.DataFrame({"id": np.arange(len(vectors)), "label": labels, "dim": vectors.shape[1], "w": h.narrow(vectors), "home": angle.argmin(axis=1), "angle": angle.min(axis=1)})


def best(scores, ok, k):
    at = np.flatnonzero(ok)
    return at[np.lexsort((at, -scores[at]))][:k].tolist()


def test_many_blocks_and_parts_equal_brute_force(spark):
    # 64 blocks, of which the first eight give floors to the others; anchors in two parts
    rows = clustered(7, [60, 40], 200, noise=0.2) + ODD + [(9010, [2.0, 1.0], 1), (9011, [2.0, 1.5], 1), (9012, [1.0, 0.5], 2)]
    got = h.mine(frame(spark, rows), F.col("vec_id") % 3 == 0, block=5)
    want = negatives_by_hand(rows, lambda i: i % 3 == 0)
    assert len(want) > 1000
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("large", [1, 300, 2.0**30, 2.0**45])
def test_tiles_and_floors(monkeypatch, large):
    monkeypatch.setattr(h, "TILE", 7)
    monkeypatch.setattr(h, "RUN", 16)
    monkeypatch.setattr(h, "MANY", 50)
    r = np.random.default_rng(3)
    v = r.standard_normal((240, 6))
    v[40:120] = v[0]  # copies: equal scores, the smaller id first
    v[5] *= large  # sums of 16, 24, 53 bits and more
    labels = r.integers(0, 3, len(v))
    directions = {6: h.spherical_kmeans(h.unit(v[:60]), 4)}
    rows = coded(v, labels, directions[6])
    asked = rows[rows["id"] % 6 == 0]
    w = np.array([[int(np.floor(x * 256)) if abs(x) < 2**44 else int(x) * 256 for x in row] for row in v.tolist()], object)
    scores = {i: w @ w[i] for i in asked["id"]}
    near = h.positives_in(rows, asked, directions, 5).sort_values(["score", "id"], ascending=[False, True])
    ps = {i: x for i, x in near.groupby("anchor_id")}
    for i, s in scores.items():
        assert ps[i]["id"].tolist() == best(s, (labels == labels[i]) & (rows["id"] != i), 5)
    asked = asked.assign(p_scores=[ps[i]["score"].to_numpy() for i in asked["id"]])
    unknown = asked.assign(floors=[np.full(5, h.NONE) for _ in asked["id"]])
    far = h.negatives_in(rows, unknown, directions, 4, 30, 90)
    order = ["negative_score", "negative_id"]
    found = {i: x.sort_values(order, ascending=[False, True]) for i, x in far.groupby(["anchor_id", "at"])}
    for i, s in scores.items():
        for at, p in enumerate(ps[i]["score"].tolist(), 1):
            want = best(s, [a != labels[i] and 30 * p <= 100 * x <= 90 * p for a, x in zip(labels, s)], 4)
            assert found[(i, at)]["negative_id"].tolist() == want if want else (i, at) not in found
    # a floor from other blocks: rows below it stay in the block, rows at it do not
    least = {k: x["negative_score"].max() for k, x in found.items()}
    floored = asked.assign(floors=[np.array([least.get((i, at), h.NONE) for at in range(1, 6)]) for i in asked["id"]])
    few = h.negatives_in(rows, floored, directions, 4, 30, 90)
    full = far[[x == least[(i, at)] for i, at, x in zip(far["anchor_id"], far["at"], far["negative_score"])]]
    assert 0 < len(few) < len(far)
    assert sorted(map(tuple, few.to_numpy().tolist())) == sorted(map(tuple, full.to_numpy().tolist()))
