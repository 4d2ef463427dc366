import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from weftline.llm import suffix_pieces as M
from weftline.llm.word_ids import WordIds

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def encode(texts):
    ids, sizes = M._model(PATH)[1](M._cuts(pa.array(texts, pa.string())))
    ends = np.cumsum(sizes)
    return [ids[a:b].tolist() for a, b in zip([0, *ends], ends, strict=False)]


def check(library, texts):
    got = encode(texts)
    assert got == [library.encode(t) for t in texts]
    decode = M.Decoder(M._model(PATH)[0])
    flat = np.array([i for ids in got for i in ids], np.int64)
    back = decode(flat, np.array([len(ids) for ids in got], np.int64))
    assert back == [t.replace("▁", " ") for t in texts]


def test_made_up_texts(library):
    rnd = random.Random(2)
    parts = list(" ▁abcétheing\n\tﬁ😀\x00.,0123<s>ÀñЖ漢字") + ["  ", "    ", "ing", "the", ".,", "²."]
    check(library, ["".join(rnd.choices(parts, k=rnd.randint(0, 50))) for _ in range(2000)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
def test_any_text(texts):
    check(SentencePieceProcessor(model_file=PATH), texts)


def test_long_words_and_spaces(library):
    check(library, ["a" * 5000, " " * 300, "x" + " " * 77 + "y ", "", "ab" * 3000 + "...,"])


def test_documents(spark, documents, library):
    rows = M.encoded(documents, PATH).collect()
    assert [r.ids for r in rows] == [library.encode(r.text) for r in rows]


def test_both_ways(spark, odd, empty, library):
    rows = M.encoded_and_decoded(odd, PATH).collect()
    texts = [r.text or "" for r in odd.collect()]
    assert [r.ids for r in rows] == [library.encode(t) for t in texts]
    assert [r.same for r in rows] == ["▁" not in t for t in texts]
    assert M.encoded_and_decoded(empty, PATH).count() == 0
    back = M.decoded(M.encoded(odd, PATH), PATH).collect()
    assert [r.decoded for r in back] == [t.replace("▁", " ") for t in texts]


def test_edges_are_all_occurrences():
    pieces = M._model(PATH)[0]
    text = "▁there▁is\0▁thin"
    starts, ends, found = pieces.edges(text)
    want = sorted(
        (i, j, pieces.number[text[i:j]])
        for i in range(len(text)) for j in range(i + 1, len(text) + 1) if text[i:j] in pieces.number
    )
    assert list(zip(starts.tolist(), ends.tolist(), found.tolist(), strict=True)) == want


def test_little_memory_gives_the_same_ids(library):
    rnd = random.Random(9)
    words = WordIds(lambda parts: M._model(PATH)[1].encode(parts), M._model(PATH)[1].parts, limit=40)
    vocabulary = ["".join(rnd.choices("abcdei.,", k=rnd.randint(1, 6))) for _ in range(200)]
    for _ in range(30):
        texts = [" ".join(rnd.choices(vocabulary, k=20)) for _ in range(4)]
        ids, sizes = words(M._cuts(pa.array(texts)))
        assert ids.tolist() == [i for t in texts for i in library.encode(t)]
        assert sizes.tolist() == [len(library.encode(t)) for t in texts]
        words.trim(10)
        assert len(words.numbers) == len(words.used) == len(words.starts) - 1 <= 10
