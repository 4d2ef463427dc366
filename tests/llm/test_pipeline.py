from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from small_tables import SF
from sentencepiece import SentencePieceProcessor

from weftline.llm import mixing, order_minhash, pii, quality


@pytest.fixture(scope="module")
def stages(spark, documents):
    """The rows that each stage gets and gives."""
    docs, out = documents, [documents.collect()]
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        out.append(found.collect())
        docs = spark.createDataFrame(out[-1], found.schema)
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_dedup", "pii", "mixing", "encoding"]


def test_quality(stages, documents, labels):
    keep = {r.doc_id for r in quality.scored(documents, labels).collect() if r.predicted}
    assert sorted(stages[1]) == sorted(r for r in stages[0] if r.doc_id in keep)


def test_one_of_each_class(spark, stages, documents):
    before = spark.createDataFrame(stages[1], documents.schema)
    classes = {r.class_id for r in order_minhash.near_duplicates(before).collect()}
    assert sorted(stages[2]) == sorted(r for r in stages[1] if r.doc_id in classes)


def test_personal_data_is_gone(stages):
    before = {r.doc_id: r for r in stages[2]}
    assert sorted(before) == sorted(r.doc_id for r in stages[3])
    for r in stages[3]:
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        if not pii.base_spans(before[r.doc_id].text):
            assert r.text == before[r.doc_id].text


def test_mix(spark, stages, documents):
    before = {r.doc_id: r for r in stages[3]}
    got = Counter(r.doc_id for r in stages[4])
    assert max(got.values()) <= 3
    assert all(r == before[r.doc_id] for r in stages[4])
    df = spark.createDataFrame(stages[3], documents.schema)
    want = {}
    for r in mixing.mix(df).collect():
        want[before[r.doc_id].source] = r.target
    size = {r.doc_id: r.size for r in mixing.mix(df).collect()}
    largest = Counter()
    for d in before:
        largest[before[d].source] = max(largest[before[d].source], size[d])
    taken = Counter()
    for d, n in got.items():
        taken[before[d].source] += n * size[d]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * largest[s]


def test_ids(stages):
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in stages[4]}
    assert Counter(r.doc_id for r in stages[5]) == Counter(r.doc_id for r in stages[4])
    for r in stages[5]:
        assert r.ids == library.encode(texts[r.doc_id]) and r.same and r.n_tokens == len(r.ids)


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(rows, key=repr) == sorted(stages[5], key=repr)
