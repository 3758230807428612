"""Hard negatives and embedding near-dedup against brute force over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import embed_dedup, hard_negatives, spherical

ODD = [
    (9001, None, 1),
    (9002, [], 1),
    (9003, [1.0, None, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1),
    (9004, [1.0, float("nan")] + [0.0] * 6, 1),
    (9005, [float("inf")] + [0.0] * 7, 1),
    (9006, [1.0] * 8, None),
    (None, [1.0] * 8, 1),
    (9008, [0.0] * 8, 1),
]
COLUMNS = "vec_id long, embedding array<double>, label int, id long, v string, node long, dim int, block int"


def frame(spark, rows, columns=COLUMNS):
    return spark.createDataFrame([(*r, 7, "x", 3, 4, 5) for r in rows], columns)


def clustered(seed, groups, lone, dim=8, noise=0.05, labels=3):
    """Vectors around common centres (near copies), lone ones, exact copies and other lengths of one direction."""
    r = np.random.default_rng(seed)
    out = []
    for size in groups:
        centre, label = r.standard_normal(dim), int(r.integers(labels))
        out += [(centre + noise * np.linalg.norm(centre) * r.standard_normal(dim), label) for _ in range(size)]
    out += [(r.standard_normal(dim), int(r.integers(labels))) for _ in range(lone)]
    out += [(out[i][0] * (1 if i % 2 else 3.5), out[i][1]) for i in range(0, len(out), 9)]
    order = r.permutation(len(out))
    return [(i, [float(np.float32(x)) for x in out[j][0]], out[j][1]) for i, j in enumerate(order)]


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def negatives_by_hand(rows, anchor, positives=5, negatives=10, low=30, high=90):
    rows = [(i, [math.floor(256 * x) if abs(x) < 2**44 else int(x) * 256 for x in v], label) for i, v, label in rows if i is not None and label is not None and sound(v)]
    out = []
    for a, av, al in rows:
        if not anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(av, v)), i, label) for i, v, label in rows if i != a and len(v) == len(av))
        for s, p, _ in [x for x in scored if x[2] == al][:positives]:
            fit = [x for x in scored if x[2] != al and low * -s <= 100 * -x[0] <= high * -s]
            out += [(a, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 40])
def test_hard_negatives_equal_brute_force(spark, block):
    rows = clustered(5, [30, 20], 300, noise=0.3) + ODD + [(9010, [2.0, 1.0], 1), (9011, [2.0, 1.5], 1), (9100, [2.0, 1.0], 2), (9012, [1.0, 0.5], 2)]
    got = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = negatives_by_hand(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    assert sorted(tuple(r) for r in got.collect()) == want


def test_hard_negatives_huge_components_and_ties(spark):
    rows = [(i, [float(2**19 * (i % 5 + 1)), 3.0, -1.0], i % 2) for i in range(24)]
    got = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 6 == 0)
    assert sorted(tuple(r) for r in got.collect()) == negatives_by_hand(rows, lambda i: i % 6 == 0)
    wild = [(0, [1e308, -1e308], 0), (1, [1e308, 1.0], 0), (2, [1e-320, 5.0], 1)]
    assert hard_negatives.mine(frame(spark, wild), F.lit(True)).count() >= 0


def test_hard_negatives_empty_and_repeated(spark):
    assert hard_negatives.mine(frame(spark, []), F.lit(True)).count() == 0
    assert hard_negatives.mine(frame(spark, ODD), F.lit(True)).count() == 0
    rows = [(0, [1.0, 0.0], 0)] * 40 + [(1, [1.0, 0.0], 0), (2, [0.5, 0.0], 1), (2, [0.5, 0.0], 1)]
    got = sorted(tuple(r) for r in hard_negatives.mine(frame(spark, rows), F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 2, 65536, 32768)]


def test_score_bounds_hold():
    r = np.random.default_rng(1)
    rows = np.concatenate([r.standard_normal((300, 12)), np.zeros((2, 12)), 1e-3 * r.standard_normal((50, 12))])
    v = hard_negatives.whole(rows)
    directions = spherical.spherical_kmeans(spherical.unit(v[:100]), 4)
    angle, norm = hard_negatives.angles(v, directions), hard_negatives.norms(v)
    lower, upper = hard_negatives.intervals(angle[:40], norm[:40], angle, angle, norm, norm)
    exact = v[:40] @ v.T
    assert (lower <= exact).all() and (exact <= upper).all()
    assert (upper < norm[:40, None] * norm[None, :] * 0.9).mean() > 0.2  # the bounds say something


def dedup_by_hand(rows, threshold=0.93):
    good = [(i, np.array(v) / np.linalg.norm(v), label) for i, v, label in rows if i is not None and label is not None and sound(v) and any(v)]
    up, links = {i: i for i, _, _ in rows}, dict.fromkeys((i for i, _, _ in rows), 0)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, v, label) in enumerate(good):
        for j, w, other in good[a + 1 :]:
            if label == other and len(v) == len(w) and v @ w >= threshold:
                links[i], links[j] = links[i] + 1, links[j] + 1
                p, q = top(i), top(j)
                up[max(p, q)] = min(p, q)
    return sorted((i, links[i], top(i), top(i) == i) for i, _, _ in rows)


@pytest.mark.parametrize("block,books", [(2048, (1, 4, 16)), (24, (1, 4, 16)), (16, (1, 16, 64))])
def test_embedding_dedup_equals_brute_force(spark, monkeypatch, block, books):
    monkeypatch.setattr(embed_dedup, "CODEBOOKS", books)
    rows = clustered(3, [120, 30, 12, 5, 4, 3, 2, 2], 200) + [r for r in ODD if r[0] is not None] + [(9020, [1.0, 2.0], 0), (9021, [1.0, 2.1], 0)]
    got = embed_dedup.near_duplicates(frame(spark, rows), block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = dedup_by_hand(rows)
    assert sum(w[1] for w in want) > 10_000
    assert sorted(tuple(r) for r in got.collect()) == want


def test_embedding_dedup_extremes(spark):
    assert embed_dedup.near_duplicates(frame(spark, [])).count() == 0
    rows = [(5, [1e-200, 1e-200], 1), (3, [1e200, 1e200], 1), (4, [1.0, 1.0], 2), (7, [1.0, -1.0], 1), (8, [1.0, 1.0], None)]
    got = {r[0]: tuple(r)[1:] for r in embed_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == {5: (1, 3, False), 3: (1, 3, True), 4: (0, 4, True), 7: (0, 7, True), 8: (0, 8, True)}
    copies = [(9, [1.0, 0.0], 1)] * 50 + [(2, [1.0, 0.0], 1)] + [(None, [1.0, 0.0], 1)]
    got = sorted((tuple(r) for r in embed_dedup.near_duplicates(frame(spark, copies)).collect()), key=str)
    assert got == [(2, 50, 2, True)] + [(9, 50, 2, False)] * 50 + [(None, 0, None, True)]


def test_certain_links_of_a_large_group_need_no_products(spark):
    """A third of all rows near one centre: they are core classes, so no task gets them in pairs."""
    r = np.random.default_rng(8)
    centre = r.standard_normal(16)
    hot = spherical.unit(centre + 0.02 * r.standard_normal((3000, 16)))
    lone = spherical.unit(r.standard_normal((1000, 16)))
    points = np.concatenate([hot, lone])
    book = spherical.spherical_kmeans(points[::4], 16, 0.93)
    at, _, kind = embed_dedup.cells_of(points, book, 0.93)
    assert (kind[at < 3000] == embed_dedup.CORE).sum() == 3000


def test_nearest_of_extreme_vectors_and_two_lengths(spark):
    from strata.llm import ann

    r = np.random.default_rng(2)
    base = r.standard_normal((60, 8))
    rows = [(i, (v * [1.0, 1e-200, 1e200, 1e-310][i % 4]).tolist(), 0) for i, v in enumerate(base)]
    rows += [(100, base[0].tolist(), 0), (101, (base[0] * 1e-200).tolist(), 0)]
    rows += [(200 + i, v.tolist(), 0) for i, v in enumerate(r.standard_normal((9, 4)))]
    got = {}
    for x in ann.search(frame(spark, rows), F.col("vec_id") % 50 == 0, 5, block=16).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    assert set(got) == {0, 50, 100, 200}
    for q, found in got.items():
        v = dict((i, np.array(w)) for i, w, _ in rows)
        unit = {i: (w / np.abs(w).max()) / np.linalg.norm(w / np.abs(w).max()) for i, w in v.items() if len(w) == len(v[q])}
        want = sorted(((-(unit[q] @ w), i) for i, w in unit.items() if i != q))[:5]
        assert len(found) == 5 and max(s for _, _, s in found) <= 1 + 1e-12
        assert [round(s, 9) for _, _, s in sorted(found)] == [round(-s, 9) for s, _ in want]
        if q != 0 and q != 100:  # 0, 100 and 101 have one direction, and cosines that differ in rounding only
            assert [i for _, i, _ in sorted(found)] == [i for _, i in want]
