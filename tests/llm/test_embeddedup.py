import math

import numpy as np
import pytest

from tests.llm.brute import CLASHING
from tripmart.llm import embeddedup

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    fine = []
    for at, (i, e, *_) in enumerate(rows):
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e):
            fine.append((at, [float(np.float32(x)) for x in e]))
    links = {at: set() for at in range(len(rows))}
    for at, v in fine:
        for bt, w in fine:
            if at != bt and len(v) == len(w):
                cos = sum(a * b for a, b in zip(v, w)) / (math.hypot(*v) * math.hypot(*w))
                if v == w or cos >= threshold:
                    links[at].add(bt)
    out = []
    for at, (i, *_) in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        head = None if i is None else min(rows[b][0] for b in seen)
        out.append((i, len(links[at]), head, i is None or i == head))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def generated(n=500, d=16, seed=3):
    """Groups of near copies, chains of them, exact copies, and vectors of their own."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            v = np.array(out[rng.integers(len(out))][1])
            v = v + rng.normal(size=d) * np.abs(v).mean() * rng.choice([0.0, 0.1, 0.25])
        else:
            v = rng.normal(size=d)
        out.append((i * 3 % n, [float(np.float32(x)) for x in v], 0))
    return out + [(n + k, out[7][1], 1) for k in range(40)]


@pytest.mark.parametrize("tile,step", [(4 << 20, 2 << 20), (8 * 16 * 17, 64)])
def test_equals_brute_force(spark, monkeypatch, tile, step):
    monkeypatch.setattr(embeddedup, "TILE_BYTES", tile)
    monkeypatch.setattr(embeddedup, "STEP_PRODUCTS", step)
    rows = generated()
    want = brute(rows)
    assert sum(r[1] for r in want) > 100
    assert rows_of(embeddedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0], 0), (3, [2.0, 0.0], 0), (9, [0.95, 0.05], 0), (None, [1.0, 0.0], 0), (1, None, 0), (2, [], 0),
            (4, [0.0, 0.0], 0), (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (8, [None, 1.0], 0), (10, [1.0, 0.0, 0.0], 0),
            (11, [-1.0, 0.0], 0), (12, [-1.0, -0.0], 0), (3, [0.0, 1.0], 0), (3, [0.0, 1.0], 0), (13, [1e-38, 3e38], 0),
            (14, [7.0], 0), (15, [0.5], 0), (16, [-0.5], 0), (None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in (*CLASHING, "n", "v", "w", "tile", "position", "x0", "first_id"):
        df = df.withColumn(c, df.label)
    assert rows_of(embeddedup.near_duplicates(df)) == brute(rows)
    assert embeddedup.near_duplicates(df.limit(0)).count() == 0


def test_large_components_in_double_precision(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-300, 1e-300]), (3, [1e200, -1e200])]
    got = rows_of(embeddedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")))
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_no_pair_is_lost_on_the_way(n):
    rng = np.random.default_rng(n)
    plain = rng.normal(size=(150, n))
    plain[75:] = plain[:75] + rng.normal(size=(75, n)) * 0.3
    plain /= np.linalg.norm(plain, axis=1, keepdims=True)
    turn = np.linalg.eigh(plain.T @ plain)[1][:, ::-1]
    a, b = embeddedup.Tile(plain[:90], turn), embeddedup.Tile(plain[60:], turn)
    for threshold in (0.5, 0.9, 0.95):
        got = {(int(q), int(c)) for qs, cs in embeddedup.reaching(a, b, threshold) for q, c in zip(qs, cs)}
        want = set(zip(*map(np.ndarray.tolist, np.nonzero(plain[:90] @ plain[60:].T >= threshold))))
        assert {p for p in got ^ want if abs(plain[p[0]] @ plain[60 + p[1]] - threshold) > 1e-12} == set()
