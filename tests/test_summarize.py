import decimal
import fractions
import random
import statistics

import pytest
from collected import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions import render
from weftline.operators import (
    avg_count,
    median_std,
    median_std_histogram,
    merge_averages,
    min_max_count,
    value_histogram,
)


def pairs(spark, data):
    return spark.createDataFrame(data, "id int, freq int")


def check_medians(df, data):
    groups = {}
    for key, value in data:
        groups.setdefault(key, []).append(value)
    got = {r["id"]: (r["median"], r["std"]) for r in df.collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        median, std = got[key]
        assert median == statistics.median(values)
        if len(values) == 1:
            assert std is None
        else:
            assert std == pytest.approx(statistics.stdev(values), rel=1e-9, abs=1e-9)


def test_min_max_and_average(spark):
    df = pairs(spark, [(1, 5), (1, -3), (1, 7), (2, 2**31 - 1)])
    assert rows(min_max_count(df)) == [(1, -3, 7, 3), (2, 2**31 - 1, 2**31 - 1, 1)]
    assert rows(avg_count(df)) == [(1, 3, 3.0), (2, 1, float(2**31 - 1))]


def test_averages_merge(spark):
    df = pairs(spark, [(i % 3, i) for i in range(100)])
    parts = avg_count(df.where("freq < 30")).unionByName(avg_count(df.where("freq >= 30")))
    assert rows(merge_averages(parts)) == rows(avg_count(df)) == [
        (0, 34, 49.5), (1, 33, 49.0), (2, 33, 50.0)]


def test_median_edges(spark):
    data = [(1, 1), (1, 2), (1, 3), (1, 10), (2, 5), (3, -7), (3, -7), (4, -1), (4, 70000)]
    check_medians(median_std(pairs(spark, data)), data)
    full_range = [(1, -(2**31)), (1, 2**31 - 1), (2, 65535), (2, 65536), (2, 131072)]
    check_medians(median_std(pairs(spark, full_range)), full_range)


WIDE = {
    "bigint": lambda r: r.choice([r.randint(-5, 5), r.randint(-(2**62), 2**62), 2**40 + r.randint(0, 9)]),
    "decimal(18,4)": lambda r: decimal.Decimal(r.randint(-(10**9), 10**9)).scaleb(-4),
    "double": lambda r: r.choice([
        0.0, -0.0, 1.0, 2.0, r.uniform(-1, 1), r.uniform(900, 1e5), 5e-324,
        r.uniform(-1, 1) * 10.0 ** r.randint(-300, 300),
        2.0 ** r.randint(-1074, 1023)]),
    "float": lambda r: float(r.randint(-1000, 1000)) / 8,
}


@pytest.mark.parametrize("kind", WIDE)
def test_wide_medians(spark, kind):
    rng = random.Random(8)
    data = [(k, WIDE[kind](rng)) for k in range(12) for _ in range(rng.choice([1, 2, 3, 40, 41]))]
    df = spark.createDataFrame(data, f"id int, freq {kind}")
    groups = {}
    for k, v in data:
        groups.setdefault(k, []).append(v)
    got = {r["id"]: r for r in median_std(df).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        middle = sorted(values)[(len(values) - 1) // 2], sorted(values)[len(values) // 2]
        assert got[k]["median"] == (float(middle[0]) + float(middle[1])) / 2
        if len(values) == 1:
            assert got[k]["std"] is None
        elif max(map(abs, values)) < 1e150:
            floats = [fractions.Fraction(float(v)) for v in values]
            assert got[k]["std"] == pytest.approx(float(statistics.stdev(floats)), rel=1e-7)
    parts = value_histogram(df.withColumn("half", F.rand(1) < 0.5), ["id", "half"]).drop("half")
    medians = lambda rows: {r["id"]: r["median"] for r in rows.collect()}
    assert medians(median_std_histogram(parts)) == medians(median_std(df))


def test_prices_are_exact(spark):
    data = [(i % 3, round(1000 + i * 7.31 % 99, 2)) for i in range(500)]
    check_medians(median_std(spark.createDataFrame(data, "id int, freq double")), data)


def test_no_median_of_text(spark):
    with pytest.raises(TypeError):
        median_std(spark.createDataFrame([(1, "a")], "id int, freq string"))


def test_median_keeps_a_null_key(spark):
    got = rows(median_std(pairs(spark, [(None, 1), (None, 4), (1, 3)])))
    assert (None, 2.5, pytest.approx(statistics.stdev([1, 4]))) in got and len(got) == 2


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.integers(-(2**31), 2**31 - 1) | st.integers(-3, 3)),
        min_size=1,
        max_size=60,
    )
)
def test_median_random(spark, data):
    check_medians(median_std(pairs(spark, data)), data)


def test_median_of_one_large_key(spark):
    # A third of the rows in one key, its values all over the 32-bit range.
    rng = random.Random(1)
    data = [(0, rng.randrange(-(2**31), 2**31)) for _ in range(5000)]
    data += [(rng.randrange(1, 500), rng.randrange(100)) for _ in range(10000)]
    check_medians(median_std(pairs(spark, data)), data)


def test_median_without_cancellation(spark):
    data = [(1, 2_000_000_000 + i % 2) for i in range(1000)]
    check_medians(median_std(pairs(spark, data)), data)


def test_histograms_merge(spark):
    data = [(i % 7, (i * 37) % 101) for i in range(2000)]
    df = pairs(spark, data)
    parts = value_histogram(df.where("freq % 2 = 0")).unionByName(
        value_histogram(df.where("freq % 3 = 0 and freq % 2 = 1"))
    ).unionByName(value_histogram(df.where("freq % 3 <> 0 and freq % 2 = 1")))
    assert rows(median_std_histogram(parts)) == rows(median_std(df))



def test_rendered_lines(spark):
    df = pairs(spark, [(0, 1), (0, 2), (0, 2), (1, 4)])
    show = lambda d, c: [r[0] for r in d.orderBy("id").select(c.alias("x")).collect()]
    assert show(min_max_count(df), render.min_max()) == [
        "Min: 1 Max: 2 Count: 3", "Min: 4 Max: 4 Count: 1"]
    assert show(avg_count(df), render.count_average()) == ["3.0\t1.6666666", "1.0\t4.0"]
    assert show(median_std(df), render.median_std()) == ["2.0 0.57735026", "4.0 NaN"]
    ids = spark.createDataFrame([([1, 1, 5],)], "doc_ids array<bigint>")
    assert ids.select(render.id_list()).first()[0] == ": 1 1 5"
