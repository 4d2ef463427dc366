import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm import toxicity as M

FULL = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def full(spark):
    return (
        spark.read.parquet(f"{FULL}/documents.parquet"), spark.read.parquet(f"{FULL}/labels.parquet")
    )


@pytest.fixture(scope="module")
def costs(full):
    return M.language_model(full[0])


def test_language_model_counts_everything(full):
    documents, _ = full
    documents = documents.limit(50).cache()
    counts = np.zeros([64] * 3)
    for r in documents.collect():
        s = M.symbols(f"  {r.text}  ")
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            counts[a, b, c] += 1
    counts[0, 0, 0] = 0
    found = M.language_model(documents)
    triple = counts / np.maximum(counts.sum(2, keepdims=True), 1)
    assert found.shape == (64, 64, 64) and np.isfinite(found).all()
    often = counts > 20
    often[0, 0] = False
    assert np.corrcoef(np.exp(-found[often]), triple[often])[0, 1] > 0.97


@pytest.mark.parametrize("word, plain", [
    ("1d1ot", "idiot"), ("idiiiiot", "idiot"), ("i.d.i.o.t", "idiot"), ("ID10T!", "idiot"),
    ("m0r0n", "moron"), ("tr@sh", "trash"), ("$cum", "scum"), ("p@thetic", "pathetic"),
    ("cl0wn", "clown"), ("lo$er,", "loser"), ("hello", "hello"), ("\"Word.", "word"),
])
def test_restored_words(costs, word, plain):
    assert M.restored_word(word, costs) == plain


@pytest.mark.parametrize("word", ["2024", "a@b.example.com", "http://x1y.com", "plain", "the", ""])
def test_words_left_alone(costs, word):
    assert M.restored_word(word, costs) == M.core(word)


def test_viterbi_finds_the_least_cost(costs):
    """Against all ways through the lattice."""
    def ways(word, at, letters, price):
        if at == len(word):
            s = [0, 0, *M.symbols(letters).tolist(), 0]
            steps = zip(s, s[1:], s[2:], strict=False)
            yield price + sum(float(costs[a, b, c]) for a, b, c in steps), letters
            return
        if at and word[at] == word[at - 1] and letters:
            yield from ways(word, at + 1, letters, price + M._REPEAT_COST)
        for letter, cost in M._choices(word[at], False):
            yield from ways(word, at + 1, letters + letter, price + cost)

    for word in ("1d1ot", "aa1", "tr@s5h", "b00k", "*b*", "1|1", "x$$y", "éé3"):
        assert M.restore(word, costs) == min(ways(word, 0, "", 0.0))[1]


def test_spelled_out_and_whole_texts(costs):
    assert M.restored_text("an i d i o t  and\na l0ser", costs) == "an idiot  and\na loser"
    reader = M.Reader(costs, {"<idiot>": 0, "<ab>": 1})
    texts = pa.array(["an i d i o t here", "", "x y", "id iot", "a b", "1d1ot 1d1ot"])
    assert [x.tolist() for x in reader(texts)] == [[0, 5], [0, 0]]


@pytest.mark.parametrize("times", [1, 12])
def test_spelled_out_sentences(costs, times):
    """34 and 408 letters: each one is read, and words come apart.

    Doubled letters may read as one, as the language of the tables has few.
    """
    letters = "youareastupidworthlessuselessidiot" * times
    for text in (" ".join(letters), "\n".join(letters.upper())):
        found = M.restored_text(text, costs).split()
        assert "".join(found).replace("ss", "s") == letters.replace("ss", "s")
        assert found.count("idiot") >= 1 and len(found) >= 5 * times
    assert M.restored_word(".".join(letters), costs).split().count("idiot") >= 1
    reader = M.Reader(costs, {"<idiot>": 0, "tupid": 1})
    texts = pa.array([" ".join(letters), ".".join(letters), "id" + "i" * 400 + "ot"])
    assert [x.tolist() for x in reader(texts)] == [[0, 0, 1, 1, 2], [0, 1, 0, 1, 0]]


def costs_of(words):
    """A language of these words, mostly."""
    counts = np.ones((64, 64, 64)) * 1e-3
    for word in words:
        s = [0, 0, *M.symbols(word).tolist(), 0]
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            counts[a, b, c] += 1000
    return M._costs(counts)


@pytest.mark.parametrize("letters, word", [("youidiot", "idiot"), ("killyou", "kill"), ("oyou", "you")])
def test_short_runs_may_be_several_words(letters, word):
    """Breaks are offered at any length; all letters in one count as well."""
    reader = M.Reader(costs_of(["you", "idiot", "kill", "o"]), {f"<{word}>": 0, f"<{letters}>": 1})
    found = reader(pa.array([" ".join(letters), ".".join(letters)]))
    assert {(0, 0), (0, 1), (1, 0)} <= set(zip(*(x.tolist() for x in found), strict=True))


def test_letters_of_other_scripts_stand_for_themselves():
    """Where the corpus has such words; a look-alike among Latin letters is still one."""
    costs = costs_of(["idiot", "the", "сон", "роса"])
    assert M.restored_word("сон", costs) == "сон" and M.restored_word("роса", costs) == "роса"
    assert M.restored_word("idiоt", costs) == "idiot"


def test_endless_runs_are_read_in_proportion(costs):
    start = time.monotonic()
    assert len(M.restored_text("i d i o t 1 " * 4000, costs).replace(" ", "")) >= 20_000
    assert time.monotonic() - start < 30


def test_held_out_accuracy(full):
    documents, labels = full
    scores = M.scored(documents, labels).cache()
    assert scores.count() == documents.count()
    rows = scores.join(labels, "doc_id").where(F.col("held_out")).collect()
    y = np.array([r.toxic for r in rows])
    found = np.array([r.predicted for r in rows])
    assert found[y == 1].mean() > 0.85 and found[y == 0].mean() < 0.01
    # The text decides: disguised words count as their plain spelling.
    disguised = documents.withColumn("text", F.translate("text", "io", "10"))
    model = M.trained(documents, labels, lambda d: F.crc32(d.cast("string")) % 4 != 2)
    hidden = M.with_score(disguised.join(labels, "doc_id").where("lang = 'en' and quality = 1"), model)
    by = {r.toxic: r.hit for r in hidden.groupBy("toxic").agg(
        F.avg((F.col("toxic_score") >= 0.3).cast("int")).alias("hit")).collect()}
    assert by[1] > 0.8 and by[0] < 0.05


def test_held_out_labels_play_no_part(documents, labels):
    first = sorted(M.scored(documents, labels).collect())
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(M.scored(documents.repartition(5), turned).collect()) == first


def test_odd_rows(odd, empty, labels, spark):
    rows = M.scored(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert M.scored(empty, labels).count() == 0
    assert {r.score for r in M.scored(odd, labels.limit(0)).collect()} == {0.0}
    strange = spark.createDataFrame(
        [(1, 1, None), (None, 1, 1), (4, 1, 0), (4, 0, 1), (5, 1, 0), (6, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    assert M.scored(odd, strange).count() == odd.count()
    model = M.trained(odd, strange, lambda d: d.isNotNull())
    assert M.restored(odd, model.costs).count() == odd.count()
