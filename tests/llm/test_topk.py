import math

import numpy as np
from pyspark.sql import functions as F

from weftline.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank string, vector string, block string"


def brute(rows, k, every=50):
    """Every score of every query."""
    found = {}
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
        if i is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for q, a in good:
        if q % every:
            continue
        scored = found.setdefault(q, [])
        scored += [
            (-sum(x * y for x, y in zip(a, b, strict=True)), i)
            for i, b in good if i != q and len(a) == len(b)
        ]
    for q, scored in found.items():
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA)
    return topk.top_k(df, F.col("vec_id") % 50 == 0, k)


def test_random_vectors_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 700)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    rnd = np.random.default_rng(3)
    v = rnd.normal(0, 0.13, (3000, 24)).astype(np.float32)
    v[100:400] = v[7]
    v[1000:1100] = 0
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    assert {tuple(r) for r in run(spark, rows).collect()} == brute(rows, 5)


def test_search_stops_early_and_is_exact():
    rnd = np.random.default_rng(4)
    values = np.floor(256 * rnd.normal(0, 0.125, (4000, 64))).astype(np.int64)
    index = topk.Postings(np.arange(4000), values)
    for q in range(0, 4000, 400):
        ids, scores = index.search(q, values[q], 5)
        every = values @ values[q]
        every[q] = -(1 << 60)
        best = np.lexsort((np.arange(4000), -every))[:5]
        assert ids.tolist() == best.tolist() and scores.tolist() == every[best].tolist()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]),
        (None, [0.5, 0.5]), (5, [1.0, 1.0]), (6, [1.0, 1.0]), (7, []), (50, []), (100, [0.0, 0.0]),
        (150, [1.0, 2.0, 3.0]), (8, [-1.0, 1.0]), (9, [0.001, -0.001]), (200, [-0.7, 0.3]),
    ]
    assert {tuple(r) for r in run(spark, rows).collect()} == brute(rows, 5)


def test_repeated_ids_are_the_querys_own(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [0.5]), (1, [0.5])]
    assert sorted(tuple(r) for r in run(spark, rows).collect()) == [(0, 1, 1, 32768), (0, 2, 1, 32768)]


def test_empty_table(spark):
    assert run(spark, []).count() == 0
