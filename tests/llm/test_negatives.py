"""Operator 12 against all inner products in Python integers."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricyard.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<double>, label int, uid long, comps string, norm double, lane int"


def frame(spark, rows):
    """Rows (vec_id, vector, label) with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, 7, "x", 0.5, 1) for r in rows], SCHEMA)


def brute(rows, every=10):
    """Rows count by themselves; ids may repeat."""
    fine = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(256 * x) for x in v)]
    clip = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    out = []
    for k, (a, u, lab) in enumerate(fine):
        if a % every:
            continue
        scored = [(clip(sum(p * q for p, q in zip(u, v))), i, j, other) for j, (i, v, other) in enumerate(fine) if j != k and len(u) == len(v)]
        best = sorted((r for r in scored if r[3] == lab), key=lambda r: (-r[0], r[1], r[2]))[:5]
        for p, pid, _, _ in best:
            window = [r for r in scored if r[3] != lab and 30 * p <= 100 * r[0] <= 90 * p]
            for rank, (s, i, _, _) in enumerate(sorted(window, key=lambda r: (-r[0], r[1], r[2]))[:10], 1):
                out.append((a, pid, rank, i, p, s))
    return sorted(out)


def clouds(seed, n, dim=6, labels=4, spread=0.35):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(labels * 3, dim))
    return [(i, (centres[k := int(rnd.integers(len(centres)))] + spread * rnd.normal(size=dim)).tolist(), int(k % labels)) for i in range(n)]


ODD = [(None, [1.0] * 6, 1), (2000, None, 1), (2010, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (2020, [math.nan] + [1.0] * 5, 1),
       (2030, [math.inf] + [1.0] * 5, 1), (2040, [0.0] * 6, 1), (2041, [0.001] * 6, 2), (2050, [], 1), (2051, [], 1), (2052, [], 2),
       (2060, [1.0, 2.0], 1), (2061, [1.0, 2.5], 1), (2062, [0.9, 1.5], 2), (2063, [0.4, 1.0], 3), (2070, [1.0] * 6, None),
       (2080, [1e300] * 6, 1), (2090, [1e306] * 6, 1), (-10, [0.5] * 6, 3), (30, [0.7, 0.1, 0.2, 0.3, 0.1, 0.0], 1)]


@pytest.mark.parametrize("block, anchors, lane", [(4096, 256, 131_072), (16, 4, 40)])
def test_negatives_against_all_products(spark, monkeypatch, block, anchors, lane):
    monkeypatch.setattr(ng, "BLOCK_ROWS", block)
    monkeypatch.setattr(ng, "ANCHOR_ROWS", anchors)
    rows = clouds(3, 300) + ODD + clouds(3, 300)[:25]                       # repeated rows: ids, vectors and scores tie
    got = ng.mine_negatives(frame(spark, rows).repartition(3, "vec_id"), F.col("vec_id") % 10 == 0, lane_rows=lane)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert ng.mine_negatives(frame(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_a_label_with_most_rows_and_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(ng, "BLOCK_ROWS", 32)
    rows = [(i, [2.0 ** 20 * x for x in v], 0 if i % 5 else 1) for i, v, _ in clouds(4, 200)]
    rows += [(1000 + i, [2.0 ** 30 * x for x in v], 2 + i % 2) for i, v, _ in clouds(5, 60)]       # beyond exact doubles
    got = ng.mine_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, lane_rows=50)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def as_block(rows, directions):
    comps = np.floor(np.array([v for _, v, _ in rows]) * 256)
    angles = np.arccos(np.clip(ng.unit(comps) @ directions.T, -1, 1)).astype(np.float32)
    norms = ng.norms_of(comps)
    return ng.Block({"dim": comps.shape[1], "label": rows[0][2], "n": len(rows), "ids": np.array([i for i, _, _ in rows]).tobytes(),
                     "uids": np.array([i for i, _, _ in rows]).tobytes(), "wide": False, "comps": comps.astype(np.int16).tobytes(),
                     "norms": norms.tobytes(), "angles": angles.tobytes(), "lo": angles.min(0).tolist(), "hi": angles.max(0).tolist(),
                     "least_norm": norms.min(), "most_norm": norms.max(), "wants": [[] for _ in rows]})


def test_intervals_hold_every_score_and_skip_far_rows():
    rnd = np.random.default_rng(1)
    centres = np.eye(8)
    rows = [(100 * c + i, (centres[c] + 0.05 * rnd.normal(size=8)).tolist(), 0) for c in range(8) for i in range(100)]
    directions = ng.choose_directions([v for _, v, _ in rows[::7]])[8]
    blocks = [as_block(rows[100 * c: 100 * c + 100], directions) for c in range(8)]
    for a in blocks:
        at = np.arange(a.n)
        for x in blocks:
            scores = a.comps @ x.comps.T
            lo, hi = ng.row_intervals(a, at, x)
            low, high = ng.block_interval(a, at, x)
            assert (lo <= scores).all() and (scores <= hi).all()
            assert (low[:, None] <= scores).all() and (scores <= high[:, None]).all()
    anchors = as_block(rows[:10], directions)
    wanted = [ng.windows_of(anchors, i) for i in range(anchors.n)]
    scored = ng.search(anchors, blocks, True, wanted)
    assert scored < 0.2 * anchors.n * len(rows)                 # only the anchors' own cluster gets integer scores
    for i, (w,) in enumerate(wanted):
        exact = sorted(((int(s), j) for j, s in enumerate(np.concatenate([x.comps for x in blocks]) @ anchors.comps[i]) if j != i),
                       key=lambda r: (-r[0], r[1]))[:5]
        assert [(s, j) for s, j, _ in w.rows] == [(s, rows[j][0]) for s, j in exact]
