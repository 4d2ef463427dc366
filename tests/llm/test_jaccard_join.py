import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from small_tables import SF

from weftline.llm import jaccard_join as J
from weftline.llm import queries

COLUMNS = ["doc_id", "n_shingles", "component_id"]
_UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def ngrams(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, 1)))


def brute(rows, percent=90, n=3):
    sets = {s: None for s in (ngrams(t, n) for _, t in rows)}
    root = {s: s for s in sets}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    having = defaultdict(list)
    for s in sets:
        for x in s:
            having[x].append(s)
    tried = set()
    for s in sets:
        shared = Counter(id(o) for x in s for o in having[x])
        by = {id(o): o for x in s for o in having[x]}
        for k, c in shared.items():
            o = by[k]
            if o is not s and (id(o), id(s)) not in tried:
                tried.add((id(s), id(o)))
                if 100 * c >= percent * (len(s) + len(o) - c):
                    a, b = find(s), find(o)
                    root[a] = b
    classes = defaultdict(list)
    for d, t in rows:
        s = ngrams(t, n)
        if s:
            classes[find(s)].append(d)
    name = {s: min((d for d in ds if d is not None), default=None) for s, ds in classes.items()}
    return sorted(
        ((d, len(s), name[find(s)] if s else d) for d, s in ((d, ngrams(t, n)) for d, t in rows)),
        key=repr,
    )


def run(df, **options):
    found = J.jaccard_classes(df, **options)
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr)


def check(df, percent=90, n=3):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = brute(rows, percent, n)
    assert run(df, percent=percent, n=n) == want
    return want


texts = st.lists(st.text("aB \t\x0b\x1c é", max_size=12), min_size=1, max_size=6)


@given(texts, st.integers(1, 4))
def test_sets(some, n):
    found = [s.tolist() for s in J.ngram_sets(pa.array(some), n)]
    want = [ngrams(t, n) for t in some]
    names = {}
    for a, b in zip(found, want, strict=True):
        assert len(a) == len(b) and a == sorted(set(a))
        assert names.setdefault(b, a) == a
    assert len({tuple(a) for a in names.values()}) == len(names)


def some_pair(rnd, size, percent):
    """Two sets that differ in as many elements as linked ones of the size can."""
    a = np.unique(rnd.integers(0, 1 << 63, size, np.uint64))
    most = J.most_apart(size, percent)
    out = int(rnd.integers(0, most + 1))
    b = np.concatenate([a[out:], rnd.integers(0, 1 << 63, most - out, np.uint64)])
    return a, np.unique(b)


@pytest.mark.parametrize("percent", [90, 80, 50, 20])
def test_linked_sets_meet(percent):
    rnd, bands = np.random.default_rng(percent), J.Bands(percent)
    different = 0
    for _ in range(1000):
        a, b = some_pair(rnd, int(rnd.integers(2, 400)), percent)
        c = J.common(a, b)
        if c == len(a) == len(b) or 100 * c < percent * (len(a) + len(b) - c):
            continue
        different += 1
        ka, kb = (bands.keys(s, J._mixed(s)) for s in (a, b))
        assert set(ka.tolist()) & set(kb.tolist())
    assert different > 100


@given(st.integers(1, 500), st.integers(1, 500), st.integers(0, 500), st.integers(0, 99))
def test_bound_is_above(m, n, c, seed):
    rnd = np.random.default_rng(seed)
    c = min(m, n, c)
    pool = np.unique(rnd.integers(0, 1 << 64, 2000, np.uint64))[:m + n - c]
    rnd.shuffle(pool)
    a, b = np.sort(pool[:m]), np.sort(pool[m - c:])
    width = min(len(J.signature(a)), len(J.signature(b)))
    one, other = J.folded(J.signature(a), width), J.folded(J.signature(b), width)
    assert J.most_common(m, n, one, other) >= c == J.common(a, b)
    for p in (90, 50):
        assert (c >= J.least_common(m, n, p)) == (100 * c >= p * (m + n - c))


def test_odd_rows(odd, empty):
    check(odd, percent=50, n=1)
    assert run(empty) == []


def made_up(n_near, n_passage, seed=1, most=6):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = rnd.choices(vocabulary, k=150)
    passage = rnd.choices(vocabulary, k=60)
    out = [base] * 30
    for _ in range(n_near):
        text = list(base)
        for _ in range(rnd.randint(1, most)):
            text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
        out.append(text)
    for _ in range(n_passage):
        own = rnd.choices(vocabulary, k=120)
        out.append(own[:60] + passage + own[60:])
    out += [[w] for w in vocabulary[:20]] + [rnd.choices(vocabulary, k=k) for k in range(2, 40)]
    rnd.shuffle(out)
    return [(i, " ".join(t)) for i, t in enumerate(out)]


@pytest.fixture
def many_partitions(spark):
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    for n, value in zip(names, ("false", "29"), strict=True):
        spark.conf.set(n, value)
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def test_many_partitions(spark, many_partitions):
    check(spark.createDataFrame(made_up(60, 60, 9), "doc_id long, text string"))


@pytest.mark.parametrize("block, few", [(256, 16), (16, 0), (16, 100)])
def test_large_groups_and_shared_passages(spark, monkeypatch, block, few):
    """Near copies most of which link to some others only; also in small blocks and pieces.

    Blocks name no pairs, or all of them do.
    """
    monkeypatch.setattr(J, "_BLOCK", block)
    monkeypatch.setattr(J, "_FEW", few)
    monkeypatch.setattr(J, "_HELD", 1 << 16 if block > 100 else 20)
    want = check(spark.createDataFrame(made_up(300, 200, block), "doc_id long, text string"))
    assert len({c for _, _, c in want}) > 260


def test_chain(spark):
    """Neighbours link, the ends share nothing."""
    words = [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(words[4 * i:4 * i + 100])) for i in range(200)]
    want = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {c for _, _, c in want} == {0}


def test_templates_that_do_not_link(spark):
    """A third of all texts has most of its words from one template."""
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(f"own{rnd.randrange(1000)}" for _ in range(80))) for i in range(200)]
    for i in range(100):
        text = list(base)
        for at in rnd.sample(range(100), 8):
            text[at] = f"own{i}x{at}"
        rows.append((1000 + i, " ".join(text)))
    rows += [(2000 + i, rows[200 + i][1] + " tail") for i in range(50)]
    want = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len({c for _, _, c in want}) == 300


def test_percent_is_checked(odd):
    with pytest.raises(ValueError):
        J.jaccard_classes(odd, percent=0)


def test_registered_query(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = brute(rows)
    assert sum(d != c for d, _, c in want) > 5
    found = queries.queries()["op12_jaccard_join"](spark, SF)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    sql = con.execute(J.oracle_sql())
    assert [d[0] for d in sql.description] == COLUMNS
    assert sorted(sql.fetchall(), key=repr) == want
