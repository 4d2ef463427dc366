import hashlib

import pytest
from pyspark.sql import functions as F

from weftline.llm import multiset_hash as M


def vectors(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = M.fingerprinted(df, "text", "v").orderBy("i").collect()
    return [r.v for r in rows]


def test_order_plays_no_part(spark):
    a, b, c, d = vectors(spark, ["x y.\nz\nz", "z\nx y.\nz", "z\nx y.", "x y.\nz\nz\n"])
    assert a == b and a != c and a != d


def test_insert_and_remove(spark):
    rows = ["a b. c d!\ne", "f\n\ng h?"]
    df = spark.createDataFrame([(1, *rows, "\n".join(rows))], "i int, a string, b string, both string")
    for name in ("a", "b", "both"):
        df = M.fingerprinted(df, name, f"v_{name}")
    out = df.select(
        M.merged(F.col("v_a"), F.col("v_b")).alias("put"),
        M.merged(F.col("v_both"), F.col("v_b"), remove=True).alias("taken"),
        "v_a", "v_both",
    ).first()
    assert out.put == out.v_both and out.taken == out.v_a


def test_likeness_follows_shared_sentences(spark):
    base = [f"Sentence number {i} says {i * i}." for i in range(200)]
    other = [f"Another line {i} of {i * 7}." for i in range(200)]
    texts = [" ".join(base), " ".join(base[:100] + other[:100]), " ".join(other)]
    df = spark.createDataFrame([tuple(texts)], "a string, b string, c string")
    for name in "abc":
        df = M.fingerprinted(df, name, f"v_{name}")
    df = M.with_likeness(
        df, {"same": ("v_a", "v_a"), "half": ("v_a", "v_b"), "none": ("v_a", "v_c")}
    )
    r = df.first()
    assert r.same == 1.0 and abs(r.half - 1 / 3) < 0.2 and r.none < 0.25


def expected(rows):
    """The edited text of each row by going through them in order."""
    order = sorted(
        ((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1])
    )
    out = []
    for i, (doc, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        h = len(text) // 2
        edited = text[: len(text) - h] + after[:h]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", ["1", "8", "40"])
def test_edited_text(spark, documents, odd, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for df in (documents, odd):
            rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
            got = M.fingerprints(df).collect()
            assert sorted(
                ((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr
            ) == expected(rows)
            assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_equal_texts_have_equal_fingerprints(documents):
    found = M.fingerprints(documents).join(documents.select("doc_id", "text"), "doc_id").collect()
    by_text = {}
    for r in found:
        by_text.setdefault(r.text, set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    multisets = {tuple(sorted(t.split("\n"))) for t in by_text}
    assert len({r.fingerprint for r in found}) == len(multisets)


def test_empty_table(empty):
    assert M.fingerprints(empty).count() == 0


def test_no_python_in_the_plan(documents):
    plan = M.fingerprints(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
