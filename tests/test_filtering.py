import pytest
from collected import rows

from weftline.operators import (
    distinct_keys,
    frequency_lists,
    grep,
    hotlist_filter,
    posting_lists,
    postings,
    token_lists,
    top_n,
)
from weftline.operators import inverted
from weftline.sources import parse_docs, parse_words

DOCS = ["3: a b a", "1: c", "3: b", "2: d  e", "1: c", "12: A"]


@pytest.fixture
def docs(lines):
    return parse_docs(lines(*DOCS))


def test_grep_is_a_regex(lines):
    assert rows(grep(lines("abc", "xbz", "ABC"), "b[cz]$")) == [("abc",), ("xbz",)]


def test_distinct_keys(docs):
    assert rows(distinct_keys(docs)) == [(1,), (12,), (2,), (3,)]


WAYS = {
    "inline": {},
    "broadcast": {"inline_rows": 0},
    "salted": {"inline_rows": 0, "max_broadcast_bytes": 0},
}


@pytest.mark.parametrize("way", WAYS)
def test_hotlist_ways_agree(docs, lines, way):
    hot = parse_words(lines(" c ", "", "e", "  ", "c"))
    kept = hotlist_filter(docs, hot, **WAYS[way]).select("value")
    # Copies of a line stay; matching is exact in case.
    assert rows(kept) == [("1: c",), ("1: c",), ("2: d  e",)]


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("words", [2, 999, 1001])
def test_hotlist_goes_by_the_text_alone(spark, way, words):
    """Null ids, repeated ids with other texts, null texts, lists of any length."""
    data = [(1, "a b"), (1, "z z"), (None, "a q"), (None, "z"), (2, None), (2, "k"), (2, "k"), (3, "")]
    df = spark.createDataFrame(data, "id int, body string")
    listed = ["a", "k", *[f"w{i}" for i in range(words - 2)]]
    hot = spark.createDataFrame([(w,) for w in listed], "token string")
    kept = hotlist_filter(df, hot, **WAYS[way])
    assert rows(kept) == rows(df.where("body in ('a b', 'a q', 'k')"))


def test_empty_hotlist(docs, lines):
    assert hotlist_filter(docs, parse_words(lines(""))).count() == 0


def test_top_n_takes_the_last_payload(spark):
    df = spark.createDataFrame(
        [(i % 40, f"p{i}", i) for i in range(400)] + [(None, "x", 1)],
        "id int, body string, ord int",
    )
    got = [tuple(r) for r in top_n(df, 3, order_by="ord").collect()]
    assert got == [(37, "p397"), (38, "p398"), (39, "p399")]


@pytest.mark.parametrize("n", [1, 10, 39, 40, 500])
def test_top_n_sizes(spark, n):
    # More than a third of the rows share the largest key.
    data = [(i % 40 - 20, str(i), i) for i in range(400)] + [(19, f"h{i}", i) for i in range(300)]
    df = spark.createDataFrame(data, "id int, body string, ord int")
    got = [r["id"] for r in top_n(df, n, order_by="ord").collect()]
    assert got == sorted({d[0] for d in data})[-n:]


def test_top_n_of_nothing(spark):
    df = spark.createDataFrame([], "id int, body string, ord int")
    assert top_n(df, 3, order_by="ord").count() == 0


def test_postings_keep_occurrences(docs):
    index = postings(docs)
    assert rows(index) == [
        ("A", 12, 1), ("a", 3, 2), ("b", 3, 2), ("c", 1, 2), ("d", 2, 1), ("e", 2, 1)]
    lists = {(r["token"], r["chunk"]): r["doc_ids"] for r in posting_lists(index, 2).collect()}
    assert lists[("a", 1)] == [3, 3] and lists[("c", 0)] == [1, 1] and lists[("A", 6)] == [12]


def test_lists_straight_from_texts(spark):
    df = spark.range(300).selectExpr(
        "id", "concat('hot hot w', id % 7, if(id % 3 = 0, ' hot', ''), ' x', id) as body"
    )
    assert rows(token_lists(df, chunk_docs=20)) == rows(posting_lists(postings(df), 20))


def test_posting_lists_are_bounded_and_whole(spark):
    df = spark.createDataFrame([(i, "hot hot" if i % 5 else "hot") for i in range(95)], "id int, body string")
    parts = posting_lists(postings(df), 10).where("token = 'hot'").orderBy("chunk").collect()
    assert len(parts) == 10 and all(len(set(p["doc_ids"])) <= 10 for p in parts)
    joined = [i for p in parts for i in p["doc_ids"]]
    assert joined == sorted(i for i in range(95) for _ in range(2 if i % 5 else 1))


@pytest.mark.parametrize("kept", [50_000, 0])
def test_lists_follow_frequency(spark, monkeypatch, kept):
    """One list of a rare token, bounded lists of about one size of a hot one."""
    monkeypatch.setattr(inverted, "MAX_FREQUENT", kept)
    df = spark.range(3000).selectExpr(
        "id * 7 + 5 as id",
        "concat('hot ', if(id % 3 = 0, 'third third ', ''), if(id < 40, 'early ', ''), 'x', id) as body",
    )
    found = {}
    for r in frequency_lists(df, list_ids=50).orderBy("chunk").collect():
        found.setdefault(r["token"], []).append(r["doc_ids"])
    assert all(len(found[f"x{i}"]) == 1 for i in range(3000)) and len(found["early"]) == 1
    assert 55 <= len(found["hot"]) <= 65 and max(map(len, found["hot"])) <= 60
    assert 35 <= len(found["third"]) <= 45 and max(map(len, found["third"])) <= 60
    assert sum(found["third"], []) == sorted(i * 7 + 5 for i in range(0, 3000, 3) for _ in range(2))
    assert sum(found["hot"], []) == [i * 7 + 5 for i in range(3000)]


def test_a_far_id_does_not_fill_a_list(spark):
    df = spark.range(2000).selectExpr("if(id = 0, 100000000, id) as id", "'a' as body")
    lists = [r["doc_ids"] for r in frequency_lists(df, list_ids=10).collect()]
    assert max(map(len, lists)) <= 640 and sum(map(len, lists)) == 2000


def test_frequency_lists_hold_few_texts_a_task(spark, monkeypatch):
    """Texts are dealt by their bytes; the rows of a token are never shuffled for a join."""
    df = spark.range(0, 400, 1, 2).selectExpr(
        "if(id % 50 = 0, null, id) as id", "concat('hot hot w', id % 3, ' x', id % 90) as body"
    )
    whole = rows(frequency_lists(df, list_ids=20))
    assert inverted._dealt(df, "id", "body").rdd.getNumPartitions() == 2
    monkeypatch.setattr(inverted, "TASK_BYTES", 500)
    dealt = inverted._dealt(df, "id", "body")
    assert dealt.rdd.getNumPartitions() > 8 and rows(dealt) == rows(df)
    assert any(r[1] is None for r in whole)
    for most in (1, 0):
        monkeypatch.setattr(inverted, "MAX_FREQUENT", most)
        lists = frequency_lists(df, list_ids=20)
        assert rows(lists) == whole
        plan = lists._jdf.queryExecution().optimizedPlan().toString()
        joins = [x for x in plan.splitlines() if "Join " in x]
        assert all("strategy=broadcast" in x for x in joins)


def test_frequency_lists_of_nothing(spark):
    assert frequency_lists(spark.createDataFrame([(1, ""), (2, None)], "id int, body string")).count() == 0
    with pytest.raises(ValueError):
        frequency_lists(spark.createDataFrame([(1, "a")], "id int, body string"), list_ids=0)
