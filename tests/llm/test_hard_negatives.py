import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from small_tables import SF

from weftline.llm import hard_negatives as H
from weftline.llm import queries

SCHEMA = (
    "vec_id long, embedding array<float>, label int, rank string, anchor string, copies string, "
    "score string, windows string, vector string, block string, of string"
)
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=50):
    """All scores of every anchor row."""
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], c) for i, v, c in rows
        if i is not None and c is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, v, c in good:
        if a % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w, strict=True)), i, label == c)
            for i, w, label in good if i != a and len(w) == len(v)
        )
        for p, i, _ in [s for s in scored if s[2]][:5]:
            inside = [s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(a, i, n, j, -p, -s) for n, (s, j, _) in enumerate(inside, 1)]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(*r, *"abcdefgh") for r in rows], SCHEMA)
    found = H.hard_negatives(df, F.col("vec_id") % 50 == 0)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


def vectors(n, width, seed, classes=6):
    """Vectors around a few centres, so that windows have members and ties."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 0.2, (classes, width))
    of = rnd.integers(0, classes, n)
    v = (centres[of] + rnd.normal(0, 0.1, (n, width))).astype(np.float32)
    return [(i, x.tolist(), int(c)) for i, x, c in zip(range(n), v, rnd.integers(0, 4, n), strict=True)]


def test_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 300)
    monkeypatch.setattr(H, "ANCHOR_BLOCK", 7)
    rows = vectors(1200, 16, 1)
    one = rows[7][1]
    rows += [(2000 + i, one, i % 4) for i in range(200)]
    rows += [(3001, one, 1)] * 50 + [(3050, one, 2)] * 3 + [(50, rows[51][1], 3)]
    want = brute(rows)
    assert len(want) > 100
    assert run(spark, rows) == want


@pytest.fixture
def many_partitions(spark):
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    for n, value in zip(names, ("false", "37"), strict=True):
        spark.conf.set(n, value)
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def test_blocks_meet_over_many_partitions(spark, many_partitions, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 100)
    monkeypatch.setattr(H, "ANCHOR_BLOCK", 3)
    rows = vectors(600, 8, 5)
    want = brute(rows)
    assert want and run(spark, rows) == want


def test_hot_row(spark, monkeypatch):
    """A third of all rows is one row, and a third has one vector."""
    monkeypatch.setattr(H, "BLOCK", 50)
    rows = vectors(150, 8, 2)
    rows += [(160, rows[3][1], 1)] * 150 + [(200 + i, rows[3][1], i % 3) for i in range(150)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(5))
def test_lists_stop_early_and_lose_nothing(seed):
    rnd = np.random.default_rng(seed)
    values = rnd.integers(-300, 300, (3000, 4))
    lists = H.SortedLists(values)
    early = 0
    for _ in range(20):
        anchor = rnd.integers(-300, 300, 4)
        fit = rnd.random(3000) < 0.7
        scores = values @ anchor
        top = int(scores.max())
        windows = [(-(1 << 62), 1 << 62), (top // 2, top * 9 // 10), (top // 3, top // 3 + 50)]
        found, known = lists.search(anchor, fit, windows, 3)
        assert (known == scores[found]).all() and fit[found].all()
        early += len(found) < fit.sum()
        for least, most in windows:
            inside = np.sort(scores[fit & (scores >= least) & (scores <= most)])[::-1][:3]
            assert sorted(known[(known >= least) & (known <= most)])[::-1][:3] == inside.tolist()
    assert early


def test_zero_anchor():
    lists = H.SortedLists(np.arange(12).reshape(6, 2))
    found, scores = lists.search(np.zeros(2, np.int64), np.ones(6, bool), [(0, 0)], 3)
    assert found.tolist() == list(range(6)) and not scores.any()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25], 1), (1, None, 1), (2, [None, 1.0], 2), (3, [nan, 1.0], 1), (4, [inf, 1.0], 2),
        (None, [0.5, 0.5], 1), (5, [1.0, 1.0], None), (6, [1.0, 1.0], 1), (7, [], 1), (50, [], 1),
        (100, [0.0, 0.0], 1), (8, [0.4, -0.2], 2), (9, [0.3, -0.1], 2), (10, [0.5, -0.3], 1),
        (150, [1.0, 2.0, 3.0], 3), (200, [-0.7, 0.3], 2), (11, [0.0, 0.0], 2), (12, [0.0, 0.0], 1),
        (51, [], 2),
    ]
    want = brute(rows)
    assert want and run(spark, rows) == want


def test_no_positive_score_means_no_window(spark):
    rows = [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.6], 2)]
    assert run(spark, rows) == brute(rows) == []


def test_empty_table(spark):
    assert run(spark, []) == []


def test_registered_query(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(H.oracle_sql()).fetchall()
    found = queries.queries()["op11_hard_negatives"](spark, SF)
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    assert len(want) > 0
