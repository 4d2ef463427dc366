import pytest
from collected import rows
from pyspark.sql import functions as F

from weftline.operators import bloom_filter, filtering, hotlist_filter, joins, replicated_join
from weftline.operators.bloom import expected_rate


def kept(df, listed, shown="k"):
    return {r[0] for r in df.where(listed.might_contain(F.col("k"))).select(shown).collect()}


@pytest.mark.parametrize("kind", ["string", "bigint", "int", "date", "decimal(9,2)"])
def test_all_keys_pass_and_few_others(spark, kind):
    df = spark.range(20_000).select(F.col("id").cast("int").alias("i"))
    df = df.select(
        F.date_add(F.lit("2001-01-01").cast("date"), "i").alias("k") if kind == "date"
        else F.col("i").cast(kind).alias("k"), "i",
    )
    listed = bloom_filter(df.where("i % 10 = 0"), "k", 2000)
    found = kept(df, listed, "i")
    assert found >= set(range(0, 20_000, 10))
    assert len(found) < 2000 + 18_000 * 0.05


def test_filters_of_parts_merge(spark):
    df = spark.range(3000).select(F.col("id").alias("k"))
    parts = [bloom_filter(df.where(f"k % 3 = {i}"), "k", 3000) for i in range(2)]
    whole = bloom_filter(df.where("k % 3 < 2"), "k", 3000)
    merged = parts[0].merge(parts[1])
    assert rows(merged.rows) == rows(whole.rows)
    with pytest.raises(ValueError):
        whole.merge(bloom_filter(df, "k", 30))


def test_null_and_repeated_and_no_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert kept(df, bloom_filter(df.where("k = 'a' or k is null"), "k", 2)) == {"a"}
    assert kept(df, bloom_filter(df.limit(0), "k", 0)) == set()


def test_no_filter_where_it_cannot_help(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("k"))
    assert bloom_filter(df, "k", 10) is None
    assert bloom_filter(spark.range(10), "id", 10**9, max_bytes=8) is None
    assert expected_rate(1000, 1000 * 12 // 64) < 0.02


def hot_texts(spark):
    """Every text shares one listed token in a third of the rows; most tokens are not listed."""
    df = spark.range(2000).select(
        F.col("id"),
        F.concat_ws(" ", F.concat(F.lit("own"), "id"), F.concat(F.lit("x"), F.col("id") % 400),
                    F.when(F.col("id") % 3 == 0, "hot")).alias("body"),
    )
    words = spark.range(50).select(F.concat(F.lit("x"), "id").alias("token"))
    return df, words.union(spark.createDataFrame([("hot",), ("none",)], "token string"))


def test_hotlist_beyond_the_limit_shuffles_about_the_hits(spark, monkeypatch):
    df, words = hot_texts(spark)
    seen = []
    ours = filtering._may_be_listed

    def counted(tokens, *rest):
        out = ours(tokens, *rest)
        seen.append((tokens.count(), out.count()))
        return out

    monkeypatch.setattr(filtering, "_may_be_listed", counted)
    exact = hotlist_filter(df, words)
    far = hotlist_filter(df, words, inline_rows=0, max_broadcast_bytes=0)
    assert rows(far) == rows(exact)
    hits = sum(len({w for w in r.body.split() if w in {*(f"x{i}" for i in range(50)), "hot"}})
               for r in df.collect())
    (before, after), = seen
    assert hits <= after < hits * 1.2 < before / 3


def test_replicated_inner_join_beyond_the_limit_shuffles_about_the_matches(spark, monkeypatch):
    big = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("id"),
        F.concat(F.lit("b"), "id").alias("big_line"),
    )
    small = spark.createDataFrame(
        [(i, f"s{i}-{n}", n) for i in range(7, 200) for n in range(2)], "id int, small_line string, ord int"
    )
    seen = []
    ours = joins._with_listed_keys

    def counted(some, *rest):
        out = ours(some, *rest)
        seen.append(out.count())
        return out

    monkeypatch.setattr(joins, "_with_listed_keys", counted)
    want = rows(replicated_join(big, small, order_by="ord"))
    assert not seen
    assert rows(replicated_join(big, small, order_by="ord", max_broadcast_bytes=0)) == want
    assert len(want) <= seen[0] < len(want) * 1.1
    # Keys of different types are compared by the join alone.
    wide = small.withColumn("id", F.col("id").cast("bigint"))
    assert rows(replicated_join(big, wide, order_by="ord", max_broadcast_bytes=0)) == want
    # An outer join keeps all rows.
    split = replicated_join(big, small, "leftouter", order_by="ord", max_broadcast_bytes=0)
    assert split.count() == 6000
