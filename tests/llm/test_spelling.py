import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from small_tables import SF

from weftline.llm import queries
from weftline.llm import spelling as S

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows, least_length=6, least_count=5, every=199):
    """Words and counts of (doc_id, text) rows."""
    found = Counter()
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= least_count}


def brute(words):
    near = defaultdict(list)
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    for w in words:
        near[w] = [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if one_edit(w, v)]
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 5 * n:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(near[w]), words[f] if f else None))
    return sorted(out)


def run(spark, words):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = S.spelling_variants(df)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


letters = st.text("abÿ", min_size=1, max_size=7)


@given(st.sets(letters, min_size=2, max_size=40), st.integers(1, 6), st.booleans())
def test_sorted_list(words, size, backwards):
    """Pairs of words of the size, or one longer, that begin alike."""
    ordered = sorted(w[::-1] if backwards else w for w in words if len(w) in (size, size + 1))
    if not ordered:
        return
    half = size // 2
    a, b = S.SortedList(ordered, size).near()
    got = sorted((ordered[i], ordered[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True))
    assert got == sorted(
        (v, w) for v in ordered for w in ordered
        if len(v) == size and v[:half] == w[:half] and one_edit(v, w)
    )


def made_up(n, seed, alphabet="abcdeéß", shortest=6, longest=9):
    """Words with variants at one edit, many that share both ends."""
    rnd = random.Random(seed)
    words = {}
    while len(words) < n:
        w = "".join(rnd.choices(alphabet, k=rnd.randint(shortest, longest)))
        words[w] = rnd.choice([5, 6, 30, 200, 1000, 6000])
        for _ in range(3):
            i = rnd.randrange(len(w))
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice(alphabet) + w[i + rnd.randint(0, 1):]])
            if len(w) >= shortest:
                words[w] = rnd.choice([5, 6, 30, 200, 1000, 6000])
    return words


@pytest.mark.parametrize("long_list", [20_000, 10])
def test_words(spark, monkeypatch, long_list):
    """Also with long lists cut in blocks."""
    monkeypatch.setattr(S, "LIST", long_list)
    words = made_up(1500, long_list)
    want = brute(words)
    assert sum(r[1] is not None for r in want) > 100 and any(r[1] != r[2] for r in want if r[1])
    assert run(spark, words) == want


def test_a_third_of_all_words_begins_alike(spark, monkeypatch):
    monkeypatch.setattr(S, "LIST", 50)
    words = made_up(600, 3)
    words |= {"hotbeginning" + w: n for w, n in made_up(300, 4).items()}
    assert run(spark, words) == brute(words)


def test_small_batches(spark, monkeypatch):
    monkeypatch.setattr(S, "_ROWS", 7)
    monkeypatch.setattr(S, "_QUERIES", 5)
    words = made_up(200, 5, "abc")
    assert run(spark, words) == brute(words)


def test_short_and_long_words(spark):
    long = "x" * 5000
    words = {"a": 5, "b": 30, "ab": 100, "ba": 700, "é": 9, long: 5, long + "y": 50, long[1:]: 300,
             "y" + long[2:]: 7, "\x00a": 40, "a\x00": 8, "漢字": 5, "漢": 90}
    assert run(spark, words) == brute(words)


def test_chain_of_forms(spark):
    word, words = "abcdefghijkl", {}
    for i in range(12):
        words[word[:i] + "z" * i + word[i:]] = 5 ** (i + 1)
    want = brute(words)
    assert max(len({r[2] for r in want}), 1) < 12
    assert run(spark, words) == want


def test_empty(spark, empty):
    assert run(spark, {"single": 5}) == [("single", None, "single", 5, 0, None)]
    words = S.vocabulary(empty)
    assert words.count() == 0 and S.spelling_variants(words).count() == 0


def test_vocabulary(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for every in (1, 3, 199):
        found = S.vocabulary(odd, cut_every=every, min_length=3, min_count=2)
        want = counted(rows, 3, 2, every)
        assert {r.word: r.n for r in found.collect()} == want and want
    plain = {r.word: r.n for r in S.vocabulary(odd, min_length=1, min_count=1).collect()}
    assert plain == counted(rows, 1, 1, 1 << 40)


def test_registered_query(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = brute(counted(rows))
    found = queries.queries()["op13_spelling"](spark, SF)
    assert sorted(tuple(r) for r in found.collect()) == want
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    sql = con.execute(S.oracle_sql())
    assert [d[0] for d in sql.description] == COLUMNS
    assert sorted(sql.fetchall()) == want
