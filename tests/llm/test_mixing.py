import re
from collections import Counter, defaultdict

from weftline.llm import mixing


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Shares by weight; what is over a cap is shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, found = float(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return found | {s: left * weight[s] / total for s in open_}
        for s in over:
            found[s] = float(cap * sizes[s])
            open_.remove(s)
        left -= sum(found[s] for s in over)
    return found


def check(rows, docs):
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
    of = defaultdict(int)
    for (_, _, s), n in zip(docs, sizes, strict=True):
        of[s] += n
    want = targets(of)
    assert Counter((r.doc_id, r.size) for r in rows) == Counter(
        (d, n) for (d, _, _), n in zip(docs, sizes, strict=True)
    )
    taken, largest = defaultdict(int), defaultdict(int)
    source = {d: s for d, _, s in docs}
    for r in rows:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        s = source[r.doc_id]
        assert r.source_size == of[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in of:
        assert abs(taken[s] - want[s]) <= max(0.03 * want[s], 2 * largest[s]), s


def test_documents(documents):
    docs = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    check(mixing.mix(documents).collect(), docs)


def test_reruns_and_partitions_agree(documents):
    first = sorted(mixing.mix(documents).collect())
    assert first == sorted(mixing.mix(documents.repartition(7)).collect())


def test_hot_and_small_sources(spark):
    docs = [(i, "w " * (1 + i * 7 % 90), "hot") for i in range(3000)]
    docs += [(i, "w " * (1 + i % 50), f"s{i % 5}") for i in range(3000, 4500)]
    docs += [(i, "w", None) for i in range(4500, 4510)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    check(mixing.mix(df).collect(), docs)


def test_odd_rows(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mix(empty).count() == 0


def test_mixed_documents_repeat_rows(odd, empty, documents):
    out = mixing.mixed_documents(documents)
    assert out.columns == documents.columns
    want = Counter({r.doc_id: r.copies for r in mixing.mix(documents).collect() if r.copies})
    # Another key of the same rows draws other places, but the same number in all.
    got = Counter(r.doc_id for r in out.collect())
    assert abs(sum(got.values()) - sum(want.values())) <= 20
    assert max(got.values()) <= 3
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mixed_documents(empty).count() == 0


def test_no_words_at_all(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    rows = sorted(mixing.mix(df).collect())
    assert [(r.size, r.source_size, r.target, r.taken) for r in rows] == [(0, 0, 0.0, 0)] * 2
