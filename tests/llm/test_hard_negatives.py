from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airledger.llm import hard_negatives as H

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every=50, positives=5, negatives=3):
    """rows: (id, vector, label)."""
    ok = [(i, [math.floor(256 * float(x)) for x in v], label) for i, v, label in rows
          if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    anchors = {i: (i, v, label) for i, v, label in sorted((r for r in ok if r[0] is not None), key=lambda r: (r[0], str(r[2]), r[1]), reverse=True) if i % every == 0}
    for a, v, label in anchors.values():
        scored = sorted(((-sum(x * y for x, y in zip(v, w, strict=False)), i is None, i, other) for i, w, other in ok if i != a), key=lambda s: (s[0], s[1], s[2] or 0))
        for score, _, p, _ in [s for s in scored if s[3] == label][:positives]:
            hard = [s for s in scored if s[3] != label and 50 * -score <= 100 * -s[0] <= 95 * -score][:negatives]
            out += [(a, p, r, n[2], -score, -n[0]) for r, n in enumerate(hard, 1)]
    return sorted(out, key=str)


def relabelled():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def mined(rows, label=None, every=50):
    label = F.col("label") if label is None else label
    return sorted((tuple(r[c] for c in COLUMNS) for r in H.hard_negatives(rows, "vec_id", "embedding", label, lambda k: k % every == 0).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("cells", [1 << 16, 2048])
def test_table_against_brute_force(spark, monkeypatch, cells):
    """With many small blocks and groups too."""
    monkeypatch.setattr(H, "CELLS", cells)
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    plain = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in rows.collect()]
    want = brute(plain)
    assert want and mined(rows, relabelled()) == want


def test_clusters_ties_and_one_hot_label(spark, monkeypatch):
    monkeypatch.setattr(H, "CELLS", 400)
    monkeypatch.setattr(H, "HELD", 10)
    rng = random.Random(1)
    centres = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(4)]
    rows = [(i, [x + rng.uniform(-0.1, 0.1) * (i % 3) for x in centres[i % 4]], 0 if i % 3 else i % 5) for i in range(600)]
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in rows]
    want = brute(rows, every=20)
    assert want and mined(frame(spark, rows), every=20) == want


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(2)
    rows = rng.integers(-300, 300, (200, 24))
    rows[:20] = rows[0]
    rows[20:30] = 7
    for n in H.levels_of(24):
        (m, d) = H.summary(rows, n)
        exact = rows @ rows.T
        assert (m @ m.T - d @ d.T <= exact).all() and (m @ m.T + d @ d.T >= exact).all()
    finer = [(H.summary(rows, n)[1] ** 2).sum() for n in (1, 2, 4, 8)]
    assert finer == sorted(finer, reverse=True)


def test_segments_spare_exact_scores(monkeypatch):
    """Most rows are dropped before the exact score."""
    rng = np.random.default_rng(3)
    steps = np.repeat(rng.integers(-200, 200, (2000, 4)), 4, axis=1) + rng.integers(-3, 4, (2000, 16))
    rows = [{"id": i, "label": "x", "vector": v.tolist()} for i, v in enumerate(steps)]
    import pyarrow as pa
    kept = []
    inner = H.survivors
    monkeypatch.setattr(H, "survivors", lambda *a: kept.append(inner(*a)) or kept[-1])
    block = H.Block(*H.pack(pa.array(rows), 16), 16)
    found = {}
    H.find_positives(block, H.Block(*H.pack(pa.array(rows[:20]), 16), 16), found, 5)
    assert len(found) == 20 and sum(map(len, kept)) < 0.02 * 20 * 2000


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.8, 0.1], 2), (3, None, 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 2), (6, [None, 1.0], 2),
            (7, [0.7, 0.2], None), (None, [0.85, 0.1], 2), (8, [], 1), (9, [0.6], 2), (10, [0.6, 0.1, 5.0], 2), (2, [0.8, 0.1], 2), (50, [-1.0, -1.0], 3), (100, [0.0, 0.0], 1),
            (None, [1.0, 1.0], 1), (150, [1e9, 0.0], 1)]
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert mined(frame(spark, rows)) == brute([r for r in rows if r[0] != 150])


def test_empty_table_and_clashing_columns(spark):
    empty = frame(spark, [])
    assert mined(empty) == []
    rows = [(i, [float(i % 7), 1.0], i % 2) for i in range(120)]
    clash = frame(spark, rows).selectExpr("*", "1 as id", "2 as bucket", "'x' as page", "3 as vector", "4 as slice")
    assert mined(clash) == brute(rows)
    assert mined(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)])) == []
