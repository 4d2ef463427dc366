import random
from collections import defaultdict

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from weftline.llm import order_minhash as M


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row[:]
        for j, y in enumerate(b, 1):
            row[j] = above[j - 1] + 1 if x == y else max(above[j], row[j - 1])
    return row[-1]


letters = st.lists(st.sampled_from("abcdef"), max_size=30)


@given(letters, letters, st.integers(0, 30))
def test_alignment_in_a_band(a, b, least):
    want = subsequence(a, b)
    found = M.common_words(a, b, least)
    assert found == want if want >= least else found < least


@given(letters, st.lists(st.tuples(st.integers(0, 40), st.sampled_from("abcxyz")), max_size=4))
def test_linked(a, edits):
    b = list(a)
    for at, letter in edits:
        b[at:at + 1] = [letter]
    longer = max(len(a), len(b))
    assert M.linked(a, b) == (subsequence(a, b) >= 0.8 * longer - 1e-9)


def brute(rows):
    """Classes from all pairs of different texts."""
    texts = sorted({t or "" for _, t in rows})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    words = {t: [w for w in M._words(t) if w] for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if words[a] and words[b] and M.linked(words[a], words[b]):
                root[find(a)] = find(b)
    classes = defaultdict(list)
    for d, t in rows:
        classes[find(t or "")].append(d)
    return sorted(
        ((d, min((x for x in c if x is not None), default=None)) for c in classes.values() for d in c),
        key=repr,
    )


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in M.near_duplicates(df).collect()), key=repr)
    assert got == brute(rows)


def test_documents(documents):
    check(documents)


def test_odd_rows(odd, empty):
    check(odd)
    assert M.near_duplicates(empty).count() == 0
    assert M.deduplicated(empty).count() == 0


def made_up(n_near, n_passage, seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = rnd.choices(vocabulary, k=150)
    passage = rnd.choices(vocabulary, k=60)
    texts = [base] * 30
    for _ in range(n_near):
        text = list(base)
        for _ in range(rnd.randint(1, 12)):
            text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
        texts.append(text)
    for _ in range(n_passage):
        own = rnd.choices(vocabulary, k=120)
        texts.append(own[:60] + passage + own[60:])
    texts += [[w] for w in vocabulary[:20]] + [rnd.choices(vocabulary, k=k) for k in range(2, 40)]
    rnd.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_large_groups_and_shared_passages(spark):
    check(spark.createDataFrame(made_up(300, 300), "doc_id long, text string"))


def changed(rnd, base, share):
    text = list(base)
    for i in rnd.sample(range(len(text)), round(share * len(text))):
        text[i] = f"own{rnd.randrange(10**9)}"
    return text


def test_copies_near_the_original_only(spark):
    """Each is 0.87 like the original and mostly under 0.8 like the others."""
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    texts = [base, *[changed(rnd, base, 0.13) for _ in range(400)]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.class_id for r in found.collect()} == {0}


def test_near_pairs_among_texts_of_one_template(spark):
    rnd = random.Random(3)
    template = [f"t{i}" for i in range(120)]
    texts = []
    for i in range(150):
        own = [f"a{i}x{k}" for k in range(80)]
        texts += [own[:40] + template + own[40:]]
        texts += [changed(rnd, texts[-1], 0.1)]
    rows = list(enumerate(map(" ".join, texts)))
    rnd.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_a_block_links_all_that_any_pair_does():
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    texts = [rnd.choices("abc", k=k) for k in (5, 40, 400, 900)]
    texts += [changed(rnd, base, rnd.choice([0.05, 0.1, 0.3])) for _ in range(40)]
    texts += [["same"] * n for n in (500, 520, 610, 800)]
    texts = sorted(map(" ".join, texts), key=lambda t: len(t.split()))
    words = [t.encode().split() for t in texts]
    every = np.arange(len(texts))
    sizes = np.array(list(map(len, words)))
    for sides in (np.full(len(texts), 2), every % 2):
        root = {i: i for i in every.tolist()}
        for j in every.tolist():
            for i in range(j):
                if (sides[i] == 2 or sides[i] != sides[j]) and M.linked(words[i], words[j]):
                    x, y = M._find(root, i), M._find(root, j)
                    root[max(x, y)] = min(x, y)
        found = {i: i for i in every.tolist()}
        for i, j in zip(*M.block_links(every, sizes, every, sides, texts), strict=True):
            x, y = M._find(found, int(i)), M._find(found, int(j))
            assert x != y and M.linked(words[i], words[j])
            found[max(x, y)] = min(x, y)
        assert [M._find(found, i) for i in every.tolist()] == [M._find(root, i) for i in every.tolist()]


def test_words_moved_are_not_near(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    rnd.shuffle(words)
    turned = words[100:] + words[:100]
    rows = [(1, " ".join(words)), (2, " ".join(turned)), (3, " ".join(words[:190]))]
    got = sorted(tuple(r) for r in M.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1), (2, 2), (3, 1)]


def connected(n, a, b):
    root = np.arange(n)
    for x, y in zip(a, b, strict=True):
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        root[max(x, y)] = min(x, y)
    return (root == np.arange(n)).sum() == 1


def test_pairs_of_a_large_bucket_are_few_and_connect_it():
    sizes = np.sort(np.random.default_rng(0).integers(100, 400, 5000))
    a, b = M.bucket_pairs(np.arange(5000), sizes, np.arange(5000))
    assert len(a) < 3 * 5000 and connected(5000, a, b)
    assert (np.minimum(sizes[a], sizes[b]) >= 0.8 * np.maximum(sizes[a], sizes[b]) - 1e-9).all()
    roots = np.arange(5000) % 2
    a, b = M.bucket_pairs(np.arange(5000), sizes, roots)
    assert (roots[a] != roots[b]).all()


def test_centres():
    sizes = np.sort(np.random.default_rng(0).integers(100, 400, 500))
    found = M.centres(np.arange(500), sizes)
    assert (np.minimum(sizes, sizes[found]) >= 0.8 * np.maximum(sizes, sizes[found]) - 1e-9).all()
    assert len(set(found.tolist())) == len(M._stretches(sizes)) - 1
    half = M.centres(np.arange(0, 500, 2), sizes[::2])
    assert len(set(half.tolist()) & set(found.tolist())) >= 1


def test_components(spark):
    rnd = random.Random(6)
    links = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 80)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.id: r.root for r in M.components(spark.createDataFrame(links, "a long, b long")).collect()}
    loops = {a for a, b in links if a == b}
    assert got == {x: find(x) for x in root if x in got} and set(root) - set(got) <= loops


def test_one_of_each_class_stays(documents, odd):
    classes = {r.doc_id: r.class_id for r in M.near_duplicates(documents).collect()}
    kept = M.deduplicated(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes.values()))
    rows = M.deduplicated(odd).collect()
    # Of two rows with one id in a class, one stays; the class without ids keeps one too.
    assert len(rows) == len({c for _, c in brute([(r.doc_id, r.text) for r in odd.collect()])})


def test_run_lengths_of_neighbours_meet():
    for n in range(1, 400):
        assert M.run_lengths(n) and len(M.run_lengths(n)) <= 2
        for m in range(n, int(n / M.SIMILARITY + 1e-9) + 1):
            assert set(M.run_lengths(n)) & set(M.run_lengths(m))


def test_near_texts_of_any_length_meet():
    """Two words in ten replaced, or as many put in as the similarity allows."""
    rnd = random.Random(9)
    for n in (5, 6, 8, 10, 15, 16, 20, 48, 60, 61, 75, 200, 600):
        missed = 0
        for _ in range(100):
            a = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
            b = changed(rnd, a, int(0.2 * n + 1e-9) / n)
            longer = list(a)
            for _ in range(int(n / 0.8 + 1e-9) - n):
                longer.insert(rnd.randrange(len(longer) + 1), f"w{rnd.randrange(10**6)}")
            first, *others = (
                set(M.sketch(M.word_hashes(" ".join(t).encode())[0]).tolist()) for t in (a, b, longer)
            )
            missed += sum(not first & o for o in others)
        assert missed <= 2, n


def test_near_texts_with_words_at_other_places_meet():
    """Two words in ten left out and as many put in elsewhere: the similarity itself."""
    rnd = random.Random(10)
    for n in (5, 10, 20, 50, 61, 80, 100, 200, 500, 1000):
        missed = found = 0
        while found < 100:
            a = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
            k = int(0.2 * n + 1e-9)
            b = [a[i] for i in sorted(rnd.sample(range(n), n - k))]
            for _ in range(k):
                b.insert(rnd.randrange(len(b) + 1), f"w{rnd.randrange(10**6)}")
            if M.linked(a, b):
                found += 1
                one, other = (
                    set(M.sketch(M.word_hashes(" ".join(t).encode())[0]).tolist()) for t in (a, b)
                )
                missed += not one & other
        assert missed <= 10, n


def test_blocks_of_large_buckets_are_cut_by_words_too(spark, monkeypatch):
    """A block holds few long texts, and pairs of different blocks still meet."""
    monkeypatch.setattr(M, "_WORDS", 2000)
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(300)]
    texts = [changed(rnd, base, rnd.choice([0.12, 0.3])) for _ in range(120)]
    check(spark.createDataFrame(list(enumerate(map(" ".join, texts))), "doc_id long, text string"))


def test_sketches_tell_order():
    a = M.word_hashes(" ".join(f"w{i}" for i in range(100)).encode())[0]
    same = M.sketch(a)
    assert len(same) == M.SKETCHES and (M.sketch(a.copy()) == same).all()
    assert (M.sketch(np.concatenate([a[50:], a[:50]])) == same).mean() < 0.75


def test_small_tables_have_few_files(spark, documents, files_written):
    df = documents.limit(150).localCheckpoint()
    got, files = files_written(lambda: M.near_duplicates(df).collect())
    assert sorted(map(tuple, got), key=repr) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert files and max(files.values()) <= 4 * spark.sparkContext.defaultParallelism
    assert sum(files.values()) < 20 * len(files)
    kept, files = files_written(lambda: M.deduplicated(df).count())
    assert kept == len({r.class_id for r in got})
    assert files and sum(files.values()) < 20 * len(files)
