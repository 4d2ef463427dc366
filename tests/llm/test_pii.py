import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from weftline.llm import pii

#: The patterns of the contract.
PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def valid(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        return 14 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [
        (m.start(), i, m.end(), kind)
        for i, (kind, p) in enumerate(PATTERNS) for m in re.finditer(p, text) if valid(kind, m[0])
    ]
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def test_base_spans_are_those_of_the_patterns():
    rnd = random.Random(3)
    parts = ["@", ".", "-", " ", "+", "(", ")", "1", "255", "300", "a", "b.c", "x@y.z", "é", "_",
             "%", "00", "\n", "+1 (555) 123-4567", "10.0.0.1", "4111 1111 1111 1111",
             "4111-1111-1111-1111-"]
    for _ in range(20_000):
        text = "".join(rnd.choices(parts, k=rnd.randint(0, 25)))
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "+1(" * 60_000,
                                  "a@" * 100_000, "@" * 200_000])
def test_endless_runs_are_quick(text):
    start = time.monotonic()
    pii.base_spans(text)
    assert time.monotonic() - start < 5


def test_documents(documents, odd, empty):
    for df in (documents, odd):
        texts = {}
        for r in df.collect():
            texts.setdefault(r.doc_id, []).append(r.text or "")
        for r in pii.found(df).collect():
            want = [
                (tuple(sum(k == kind for _, _, k in s) for kind in pii.KINDS), pii.rendered(s))
                for s in map(brute, texts[r.doc_id])
            ]
            counts = r.n_email, r.n_ip, r.n_card, r.n_phone
            assert any(
                counts == c and r.base_sha256 == hashlib.sha256(t.encode()).hexdigest()
                and ",".join(x for x in r.spans.split(",") if "term" not in x) == t
                for c, t in want
            )
    assert pii.found(odd).count() == odd.count()
    assert pii.found(empty).count() == 0


def corpus():
    rnd = random.Random(1)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "re") for b in ("nan", "rop", "sil", "dem")]

    def prose(n):
        return " ".join(rnd.choices(words, k=n))

    rows = [f"{prose(20)}" for _ in range(200)]
    # Zorblax stands by one address in other words each time, far from it, kanan by all.
    rows += [f"{prose(4)} Zorblax kanan {prose(30)} zed@example.com {prose(4)}" for _ in range(5)]
    rows += [f"{prose(4)} kanan ann@example.com {prose(4)}" for _ in range(5)]
    # Two words of one text with an address, one of which another text has, too.
    rows += [f"quux veritas {prose(3)} max@example.com"] * 6 + [f"{prose(5)} veritas"]
    # Half of the texts with this word have the address, three in four with the other.
    rows += [f"{prose(3)} halfway mostly ned@example.com {prose(2)}" for _ in range(3)]
    rows += [f"halfway {prose(7)}" for _ in range(3)] + [f"mostly {prose(6)}"]
    # A word of the address itself is counted where it stands alone only.
    rows += ["only ursula@example.com lorop", "ursula lorop"]
    return rows


def telling(texts):
    """Terms that tell, from all texts, by the formula."""
    different = sorted(set(t or "" for t in texts))
    words = [set(re.findall(r"[^\W\d_]{3,}", t.lower())) for t in different]
    bare = [set(re.findall(r"[^\W\d_]{3,}", pii.blanked(t).lower())) for t in different]
    n_term = Counter(w for some in words for w in some)
    of = defaultdict(set)
    for i, t in enumerate(different):
        for span in pii.base_spans(t):
            of[pii._entity(t, span)].add(i)
    told = set()
    for texts_of in of.values():
        p = len(texts_of) / len(different)
        for w, both in Counter(w for i in texts_of for w in bare[i]).items():
            left = -math.log2((both + 0.5 * p) / (n_term[w] + 0.5))
            if p < 1 and left <= min(0.75, 0.2 * -math.log2(p)):
                told.add(w)
    return told


def test_terms_that_disclose(spark):
    rows = list(enumerate(corpus()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    told = {w for r in pii.disclosing_terms(df).collect() for w in r.terms}
    assert told == telling(t for _, t in rows) == {"zorblax", "quux", "mostly", "only"}
    spans = {r.doc_id: r for r in pii.found(df).collect()}
    for i, text in rows:
        base = brute(text)
        terms = [
            (m.start(), m.end(), "term") for m in re.finditer("[A-Za-z]+", text) if m[0].lower() in told
        ]
        assert spans[i].spans == pii.rendered(sorted([*base, *terms]))
        assert spans[i].base_sha256 == hashlib.sha256(pii.rendered(base).encode()).hexdigest()


def test_terms_of_the_tables(spark, documents, odd):
    for df in (documents, odd):
        texts = [r.text for r in df.select("text").collect()]
        told = {w for r in pii.disclosing_terms(df).collect() for w in r.terms}
        assert told == telling(texts) and told


def test_many_terms_and_texts_are_not_broadcast(spark, documents, monkeypatch):
    want = sorted(pii.found(documents).collect())
    monkeypatch.setattr(pii, "broadcast_if_few", lambda df: df)
    assert sorted(pii.found(documents).collect()) == want


def test_an_entity_of_all_texts_tells_nothing(spark):
    rows = [(i, f"word{'abcdefghij'[i % 10]} alpha own{'xyz'[i % 3]} hot@example.com") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.disclosing_terms(df).count() == 0
    # One of many texts gives little more away, unless a word is surely with it.
    more = [(100 + i, f"ownx beta{'abcdefghij'[i]}") for i in range(10)]
    df = spark.createDataFrame(rows + more, "doc_id long, text string")
    told = {w for r in pii.disclosing_terms(df).collect() for w in r.terms}
    assert told == telling(t for _, t in rows + more) and "ownx" not in told


def test_sanitised(spark, odd, empty):
    df = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(corpus())], "doc_id long, text string, terms string"
    )
    out = {r.doc_id: r for r in pii.sanitised(df).collect()}
    for i, text in enumerate(corpus()):
        if "@" not in text:
            assert out[i].text == text.replace("mostly", "[TERM]")
        else:
            assert "[EMAIL]" in out[i].text and not brute(out[i].text)
            assert ("[TERM] kanan" in out[i].text) == ("Zorblax" in text)
            assert ("kanan" in out[i].text) == ("kanan" in text)
    clean = pii.sanitised(odd)
    assert clean.schema == odd.schema and clean.count() == odd.count()
    assert not any(brute(r.text or "") for r in clean.collect())
    assert pii.sanitised(empty).count() == 0


def test_telling_terms_go_without_the_entity_too(spark):
    rows = [*corpus(), "we met Zorblax there", "a kanan there"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.found(df).collect()}
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    n = len(rows)
    assert (spans[n - 2], clean[n - 2]) == ("term:7:14", "we met [TERM] there")
    assert (spans[n - 1], clean[n - 1]) == ("", rows[-1])


def test_overlapping_spans_are_one():
    text = "call +1 4111 1111 1111 now"
    assert pii.replaced(text, [(5, 22, "phone"), (6, 22, "card")]) == "call [PHONE] now"


def test_small_tables_have_few_files(spark, documents, files_written):
    want = sorted(map(repr, pii.found(documents).collect()))
    got, files = files_written(lambda: pii.found(documents).collect())
    assert sorted(map(repr, got)) == want
    assert files and max(files.values()) <= 2 * spark.sparkContext.defaultParallelism
