import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

from weftline.llm import token_files as M
from weftline.llm.common import new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70_000)))
def test_pack_and_unpack(numbers):
    control, data = M.pack(np.array(numbers, np.uint32))
    back = M.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(numbers))
    assert back.tolist() == numbers


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    rows = sorted(
        ((d, t or "") for d, t in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, np.uint64(xxh64_intdigest(r[1], 42)).astype(np.int64)),
    )
    start, out = 0, []
    for doc, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        out.append((doc, start, len(ids), crc))
        start += len(ids)
    return out


#: Special tokens, capitals, letters that change with their signs, signs, marks, white space.
_ODD = [
    "<|", "|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "the", "The", "THE", "it's", "a", "B",
    "İ", "i", "ı", "ß", "É", "e\u0301", "H\u0331", "h\u0331", "J\u030c", "\u0301", "\u0307", "ﬁ", "ǅ", "Ω", "ς", "Σ",
    "漢", "1", "42", "ª", "²", "K", ".", ",", "!", "?", "%", "&", "*", "$", "#", "|", "'", "'S", "'ll",
    " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x0c", "\x1c", "\x85", "\u00a0", "\u2003", "\u2028", "\u200b", "\ufeff",
    "\x00", "_", "-", "`", "😀",
]
_tokenizer = Tokenizer.from_file(PATH)


def same_ids(texts):
    ids, lengths = M._encoder(PATH)(pa.array(texts))
    want = [_tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    got = np.split(ids, np.cumsum(lengths)[:-1])
    assert [g.tolist() for g in got] == want


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_ODD), max_size=12).map("".join), min_size=1, max_size=4))
@example(["Hello <|im_start|> World"])
@example(["OK <|x", "if a <| f then Print", "<|endoftext|>The End"])
@example(["İ.", "İ!", "İ#", "H\u0331 T\u0308. W\u030a, Y\u030a"])
def test_any_text(texts):
    same_ids(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=4))
def test_any_characters(texts):
    same_ids(texts)


@pytest.mark.parametrize("change", [
    lambda s: s["normalizer"]["normalizers"].pop(),
    lambda s: s["added_tokens"][0].update(content="at last"),
    lambda s: s["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex="[^ ]+"),
])
def test_other_tokenizer_files_encode_whole_texts(tmp_path, change):
    with open(PATH) as file:
        other = json.load(file)
    change(other)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(other))
    texts = ["The END. at last one", "two, Three! \t", ""]
    ids, lengths = M._encoder(str(path))(pa.array(texts))
    tokenizer = Tokenizer.from_file(str(path))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(want, []) and lengths.tolist() == [len(w) for w in want]
    assert M._cuts_words(PATH) and not M._cuts_words(str(path))
    assert not M._cuts_words(public_tokenizers.path("byte_bpe_50k.json"))


def test_a_third_of_all_rows_on_one_id_and_on_none(spark):
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text {i}.") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert read(spark, df) == expected(rows)
    folder = new_folder(spark, "token-files-test")
    files = M.write_token_files(df, PATH, folder, parts=12)
    assert max(r.documents for r in files.collect()) < 150


def read(spark, df):
    return sorted((tuple(r) for r in M.token_files(spark, df, PATH).collect()), key=lambda r: r[1])


def test_files_hold_what_the_library_gives(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert read(spark, documents) == expected(rows)


def test_odd_texts(spark, odd, empty):
    extra = spark.createDataFrame(
        [(100, "It's  \t<|endoftext|> <|ENDOFTEXT|> İΣΑΣ ﬁé x y!!.. a.b, it'll. 'S"),
         (101, "The END.\n\n\r thha*** 1,000 näive e\u0301\u2003É K ｆｕｌｌ \x1c ª² Ǆ")],
        "doc_id long, text string",
    )
    rows = odd.select("doc_id", "text").unionByName(extra)
    assert read(spark, rows) == expected([tuple(r) for r in rows.collect()])
    assert read(spark, odd) == expected([tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert read(spark, empty) == []


def test_ranks_and_files(spark, documents):
    folder = new_folder(spark, "token-files-test")
    files = M.write_token_files(documents, PATH, folder, parts=3)
    back = M.read_token_files(files, folder, with_ids=True).collect()
    ids = np.concatenate([r.ids for r in sorted(back, key=lambda r: r.start)])
    store, base = M._store(folder)
    ranks = M._rank_table(store, base)
    counts = np.bincount(ids)
    assert set(ranks.tolist()) == set(np.flatnonzero(counts).tolist())
    assert (np.diff(counts[ranks]) <= 0).all()
    sizes = M.file_sizes(folder)
    assert set(sizes) == {"ranks.u32", *(r.name for r in files.collect())}
    assert sum(sizes.values()) < 2 * len(ids)


def test_ranking_a_file_twice_keeps_it(spark, documents):
    """As after a task that was lost once its file was in place."""
    folder = new_folder(spark, "token-files-test")
    files = M.write_token_files(documents, PATH, folder, parts=2)
    before = sorted(M.read_token_files(files, folder).collect())
    files.select("part").mapInArrow(M._ranking(folder), "part long").count()
    assert sorted(M.read_token_files(files, folder).collect()) == before
