import math

import numpy as np
import pytest

from tripmart.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=100, k=10):
    fine = {}
    for i, e, *_ in rows:
        if i is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(1024 * float(np.float32(x))) for x in e]
        fine[i] = min(fine.get(i, v), v)
    out = []
    for q, v in fine.items():
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine.items() if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def generated(n=700, d=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, d)) * 0.2
    out = []
    for i in range(n):
        v = centres[rng.integers(9)] + rng.normal(size=d) * 0.05
        out.append((i, [float(np.float32(x)) for x in v], 0))
    for i in range(n, n + 60):
        out.append((i, out[5][1], 1))  # ties
    return out


@pytest.mark.parametrize("block,chunk", [(512, 16384), (3, 90)])
def test_equals_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "CHUNK", chunk)
    rows = generated()
    assert rows_of(topk.search(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 1.0, -2.0], 0), (100, [1.0, 0.0, 0.25], 0), (1, None, 0), (2, [nan, 1.0, 1.0], 0), (3, [1.0, None, 2.0], 0),
            (4, [inf, 0.0, 0.0], 0), (None, [1.0, 1.0, 1.0], 0), (5, [0.5, 1.0], 0), (6, [], 0), (7, [0.5, 1.0, -2.0], 0),
            (7, [0.5, 1.0, -2.0], 0), (8, [0.0, 0.0, 0.0], 0), (9, [2.0, 1.0, -2.0], 0), (9, [1.0, 1.0, -2.0], 0), (200, [3.0, 4.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("block", "chunk", "n", "kind", "v", "rank", "score"):
        df = df.selectExpr("*", f"'x' AS {c}")
    assert rows_of(topk.search(df)) == brute(rows)
    assert topk.search(df.limit(0)).count() == 0
    assert rows_of(topk.search(spark.createDataFrame(rows[:1], SCHEMA))) == []


def test_bounds_hold_at_every_resolution():
    rng = np.random.default_rng(4)
    q, c = rng.integers(-600, 600, (40, 64)).astype(float), rng.integers(-600, 600, (50, 64)).astype(float)
    exact = q @ c.T
    last = None
    for s in topk.resolutions(64):
        bound = topk.Statistics(q, s).table @ topk.Statistics(c, s).table.T
        assert (bound >= exact - 1e-6).all()
        assert last is None or (bound <= last + 1e-6).all()
        last = bound
