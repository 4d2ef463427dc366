"""Toxicity of restored text: a noisy channel undoes disguised spelling, then a model scores.

1. A character language model counts letter triples over all documents; it grows with the
   corpus, its table does not (64 symbols a place).
2. A word that may be disguised (digits or signs among letters, a letter three times in a
   row, letters set apart by signs or spaces, look-alikes of another script) is decoded.
   Each character is a column of a lattice: letters it may stand for, or nothing
   if it repeats the one before or is a separator, each at the cost of that disguise. Viterbi
   finds the letters of least cost, disguise and language model together. A run of single
   characters may be several words: the lattice offers a break after each of them. Triples
   do not know words, so the letters without breaks give features, too.
3. The restored words of a document give features, whole words and their pieces of 4 and
   5 letters. Those that labelled toxic documents have more often than others, by the
   log-likelihood ratio, at most the ``MAX_FEATURES`` strongest, enter a logistic regression on
   their presence.

A worker keeps what it found for each word, so the work goes by different words.

The model learns from a bounded sample of labelled training rows: about ``MAX_TOXIC``
toxic and ``MAX_CLEAN`` others by hash of the id, weighted back to all of them. Scores are
between 0 and 1; a text without telling features, also an empty one, gets the
share that remains. Null texts read as empty. A document with several labels is toxic if one
says so. Without a toxic or without a clean label the score is the prior, 0 without labels.
Repeated rows score alike. Empty tables give an empty result. Other columns play no part.
"""

from __future__ import annotations

import math
import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import replaced_column, text_of
from weftline.llm.word_ids import MEMORY_PARTS, WORDS_CHUNK, chunks, ranges_of, slices

MAX_TOXIC = 4_000
MAX_CLEAN = 8_000
MAX_FEATURES = 4096
THRESHOLD = 0.3
#: A feature needs this log-likelihood ratio and this many toxic documents.
MIN_RATIO, MIN_DOCUMENTS = 12.0, 3
_PIECES = (4, 5)

#: What signs and look-alikes may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou",
    "€": "e", "£": "l",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "к": "k",
    "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ι": "i", "ε": "e",
}
_SEPARATORS = ".-_*'~ "
_EDGE = ".,;:?\"'()[]{}<>%&*#|~`^=+-_!"
_STAND_COST, _ANY_COST, _REPEAT_COST, _SEPARATOR_COST = 1.0, 2.0, 0.3, 0.1

# --- the language model ----------------------------------------------------------

_SYMBOLS = 64
_BREAK = 0
_OTHER = 63
_FIRST_ACCENT, _ACCENTS = 0xDF, 33


def _symbol_table() -> np.ndarray:
    table = np.full(0x250, _OTHER, np.int64)
    for code in range(0x250):
        if not chr(code).isalpha():
            table[code] = _BREAK
    table[ord("a"):ord("z") + 1] = np.arange(1, 27)
    accents = np.arange(_FIRST_ACCENT, _FIRST_ACCENT + _ACCENTS)
    letters = accents[[chr(c).isalpha() for c in accents]]
    table[letters] = 27 + letters - _FIRST_ACCENT
    return table


_SYMBOL_OF = _symbol_table()


def symbols(text: str) -> np.ndarray:
    """Letters as numbers, everything else as a break."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    return np.where(points < len(_SYMBOL_OF), _SYMBOL_OF[points % len(_SYMBOL_OF)], _OTHER)


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(_SYMBOLS**3, np.int64)
    for _, texts in chunks(batches):
        s = symbols("  " + "  ".join(texts) + " ")
        counts += np.bincount(
            (s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], minlength=len(counts)
        )
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"triple": found, "n": counts[found]})


def language_model(documents: DataFrame) -> np.ndarray:
    """Costs (negative logarithms) of a symbol after two others, from all documents."""
    rows = documents.select(text_of("text").alias("text"))
    found = (
        rows.mapInArrow(_triples, "triple long, n long")
        .groupBy("triple")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(_SYMBOLS**3)
    for r in found:
        counts[r["triple"]] = r["n"]
    return _costs(counts.reshape([_SYMBOLS] * 3))


def _costs(counts: np.ndarray) -> np.ndarray:
    """Triples, pairs and single symbols mixed, so nothing is impossible."""
    three = counts / np.maximum(counts.sum(2, keepdims=True), 1)
    pairs = counts.sum(0)
    two = pairs / np.maximum(pairs.sum(1, keepdims=True), 1)
    one = pairs.sum(0) / max(pairs.sum(), 1)
    mixed = 0.75 * three + 0.18 * two[None] + 0.06 * one[None, None] + 0.01 / _SYMBOLS
    return -np.log(mixed).astype(np.float32)


# --- the channel -------------------------------------------------------------------

_DISGUISED = re.compile(r"[0-9@$!|+(*€£]")
_THREE = re.compile(r"([^\W\d_])\1\1")
_APART = re.compile(r"\w(?:[.\-_*'~]\w){2,}")
_SIGNS = re.compile(r"[.\-*'~]|(?<=[^_])_(?=[^_])")
_LETTER = re.compile(r"[^\W\d_]")
_ADDRESS = re.compile(r"@.*\.|://|^www\.")


def core(word: str) -> str:
    """The word in lower case without signs at its ends; a single $ or @ may be a letter."""
    found = word.lower().strip(_EDGE)
    for sign in "$@":
        if found.endswith(sign * 3):
            found = found.rstrip(sign).strip(_EDGE)
        if found.startswith(sign * 3):
            found = found.lstrip(sign).strip(_EDGE)
    return found


def disguised(word: str) -> bool:
    """Whether a core may hide another spelling."""
    if len(word) < 2 or word.isalpha() and word.isascii() and not _THREE.search(word):
        return False
    if not _LETTER.search(word) or _ADDRESS.search(word):
        return False
    return bool(
        _DISGUISED.search(word) or _THREE.search(word) or _APART.fullmatch(word)
        or any(c in STANDS_FOR for c in word)
    )


def _choices(char: str, apart: bool) -> list[tuple[str, float]]:
    """Letters that a character may stand for, and the cost; empty text for nothing."""
    found: list[tuple[str, float]] = []
    if char.isalpha():
        # Also a look-alike of another script, whose own words stay as they are.
        found.append((char, 0.0))
    cost = _ANY_COST if char == "*" else _STAND_COST
    found += [(c, cost) for c in STANDS_FOR.get(char, "")]
    if char in _SEPARATORS and (apart or not found):
        found.append(("", _SEPARATOR_COST))
    return found or [("", _STAND_COST)]


def restore(word: str, costs: np.ndarray, breaks: bool = False) -> str:
    """The letters of least cost for a core: Viterbi over the last two symbols.

    With ``breaks`` they may be several words, with spaces between them.
    """
    apart = bool(_APART.fullmatch(word))
    # (symbol before, last symbol, last letter) -> (cost, letters); what all ways have in
    # common is put aside, so a long run takes time in proportion.
    paths: dict[tuple[int, int, str], tuple[float, str]] = {(_BREAK, _BREAK, ""): (0.0, "")}
    before, settled = "", []
    for at, char in enumerate(word):
        if at % 64 == 63:
            common = len(os.path.commonprefix([letters for _, letters in paths.values()]))
            settled.append(next(iter(paths.values()))[1][:common])
            paths = {key: (cost, letters[common:]) for key, (cost, letters) in paths.items()}
        step: dict[tuple[int, int, str], tuple[float, str]] = {}

        def offer(key, cost, letters, step=step):
            if key not in step or (cost, letters) < step[key]:
                step[key] = cost, letters

        if breaks:
            for (a, b, last), (cost, letters) in list(paths.items()):
                if last:
                    key, price = (b, _BREAK, ""), cost + float(costs[a, b, _BREAK])
                    if key not in paths or (price, letters + " ") < paths[key]:
                        paths[key] = price, letters + " "
        choices = _choices(char, apart)
        for (a, b, last), (cost, letters) in paths.items():
            if char == before and last:
                offer((a, b, last), cost + _REPEAT_COST, letters)
            for letter, price in choices:
                if not letter:
                    offer((a, b, last), cost + price, letters)
                    continue
                code = ord(letter)
                s = int(_SYMBOL_OF[code]) if code < len(_SYMBOL_OF) else _OTHER
                offer((b, s, letter), cost + price + float(costs[a, b, s]), letters + letter)
        paths, before = step, char
    ends = [(cost + float(costs[a, b, _BREAK]), letters) for (a, b, _), (cost, letters) in paths.items()]
    return "".join([*settled, min(ends)[1]])


def restored_run(letters: str, costs: np.ndarray) -> str:
    """A run of characters set apart: as many words as cost least."""
    return restore(letters.lower(), costs, breaks=True)


def restored_word(word: str, costs: np.ndarray) -> str:
    found = core(word)
    if not found.isascii():
        found = unicodedata.normalize("NFKC", found)
    if disguised(found):
        if _APART.fullmatch(found):
            return restored_run(_SIGNS.sub("", found), costs)
        return restore(found, costs)
    return found


def spelled_out(
    words: list[str], each: np.ndarray, owner: np.ndarray
) -> Iterator[tuple[int, str]]:
    """Runs of three or more single characters in a text, joined: (text, word).

    ``each`` numbers the words of all texts in order, ``owner`` their texts.
    """
    single = np.fromiter(map(len, words), np.int64, len(words)) == 1
    at = np.flatnonzero(single[each])
    breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(owner[at]) != 0)) + 1
    bounds = np.concatenate([[0], breaks, [len(at)]])
    for i in np.flatnonzero(np.diff(bounds) >= 3).tolist():
        run = at[bounds[i]:bounds[i + 1]]
        yield int(owner[run[0]]), "".join(words[w] for w in each[run])


def restored_text(text: str, costs: np.ndarray) -> str:
    """``text`` with each disguised word as it was read; white space as it was."""
    parts = re.split(r"(\s+)", text)
    words = parts[::2]
    out, i = [], 0
    while i < len(words):
        j = i
        while j < len(words) and len(words[j]) == 1:
            j += 1
        if j - i >= 3 and disguised_run("".join(words[i:j])):
            out.append(restored_run("".join(words[i:j]), costs))
            i = j
        else:
            hidden = disguised(core(words[i]))
            out.append(restored_word(words[i], costs) if hidden else words[i])
            i += 1
        if 2 * i - 1 < len(parts):
            out.append(parts[2 * i - 1])
    return "".join(out)


def disguised_run(letters: str) -> bool:
    return bool(_LETTER.search(letters))


# --- features and the model ----------------------------------------------------------


def word_features(word: str) -> list[str]:
    """The word and its pieces, with marks for its ends; none for words without letters."""
    if not _LETTER.search(word):
        return []
    marked = f"<{word}>"
    n = len(marked)
    pieces = [marked[i:i + w] for w in _PIECES for i in range(n - w + 1) if w < n]
    return [marked, *pieces]


def _read(restored: str) -> list[str]:
    """The words of what was one, and if they are several all letters in one."""
    words = restored.split()
    return [*words, "".join(words)] if len(words) > 1 else words


class Reader:
    """The features of texts by word, as numbers: those in ``wanted``, or all it meets."""

    def __init__(self, costs: np.ndarray, wanted: dict[str, int] | None = None):
        self.costs, self.fixed = costs, wanted is not None
        self.numbers: dict[str, int] = wanted if wanted is not None else {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.runs: dict[str, tuple[int, ...]] = {}

    def of_run(self, run: str) -> tuple[int, ...]:
        """Those of the words of a run of single characters."""
        found = self.runs.get(run)
        if found is None:
            words = _read(restored_run(run, self.costs)) if disguised_run(run) else [run]
            found = self.runs[run] = tuple(f for word in words for f in self.of_word(word))
        return found

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            pieces = [p for w in _read(restored_word(word, self.costs)) for p in word_features(w)]
            if self.fixed:
                numbers = map(self.numbers.get, pieces)
                found = tuple({n for n in numbers if n is not None})
            else:
                found = tuple({self.numbers.setdefault(p, len(self.numbers)) for p in pieces})
            self.known[word] = found
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (text, feature), each once, by text."""
        if len(self.known) + len(self.runs) > MEMORY_PARTS:
            self.known.clear()
            self.runs.clear()
        lists = pc.utf8_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        each = coded.indices.to_numpy(zero_copy_only=False)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(texts)), sizes)
        found = [self.of_word(w) for w in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((f for fs in found for f in fs), np.int64, int(counts.sum()))
        starts = np.cumsum(counts) - counts
        telling = np.flatnonzero(counts[each])
        seen = each[telling]
        texts_of = np.repeat(owner[telling], counts[seen])
        features = flat[ranges_of(counts[seen], starts[seen])]
        joined = [
            (text, f) for text, run in spelled_out(words, each, owner) for f in self.of_run(run)
        ]
        if joined:
            more = np.array(joined, np.int64)
            texts_of = np.concatenate([texts_of, more[:, 0]])
            features = np.concatenate([features, more[:, 1]])
        pairs = np.unique(texts_of << 32 | features)
        return pairs >> 32, pairs & 0xFFFFFFFF


@dataclass
class Model:
    costs: np.ndarray
    features: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    base: float = -math.inf

    def score(self, reader: Reader, texts: pa.Array) -> np.ndarray:
        owner, features = reader(texts)
        margin = self.base + np.bincount(owner, self.weights[features], len(texts))
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-margin))


def _counted(costs: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(costs)
        counts = np.zeros((2, 0), np.int64)
        for batch, texts in slices(batches):
            toxic = batch.column(batch.schema.get_field_index("toxic"))
            labels = toxic.to_numpy(zero_copy_only=False)
            owner, features = reader(texts)
            grown = np.zeros((2, len(reader.numbers)), np.int64)
            grown[:, : counts.shape[1]] = counts
            counts = grown
            for label in (0, 1):
                counts[label] += np.bincount(
                    features[labels[owner] == label], minlength=counts.shape[1]
                )
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(reader.numbers), pa.string()), pa.array(counts[1]), pa.array(counts[0])],
            ["feature", "bad", "clean"],
        )

    return run


def _listed(costs: np.ndarray, wanted: dict[str, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(costs, wanted)
        for batch, texts in slices(batches):
            toxic = batch.column(batch.schema.get_field_index("toxic"))
            owner, features = reader(texts)
            offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(features.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([toxic, found], ["toxic", "features"])

    return run


def _ratio(bad: Column, clean: Column, n_bad: float, n_clean: float) -> Column:
    """Log-likelihood ratio of a feature that toxic documents have more often, else 0."""
    share = (bad + clean) / F.lit(n_bad + n_clean)

    def part(n: Column, of: float) -> Column:
        p = n / F.lit(of)
        return (
            F.when(n > 0, n * F.log(p / share)).otherwise(0.0)
            + F.when(n < of, (of - n) * F.log((1 - p) / F.greatest(1 - share, F.lit(1e-12))))
            .otherwise(0.0)
        )

    return F.when(bad * n_clean > clean * n_bad, 2 * (part(bad, n_bad) + part(clean, n_clean)))


def _fitted(
    rows: list[tuple[int, list[int]]], width: int, weight: tuple[float, float]
) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on presence, by accelerated gradient steps."""
    labels = np.array([r[0] for r in rows], np.float64)
    sizes = np.array([len(r[1]) for r in rows])
    columns = np.fromiter((f for r in rows for f in r[1]), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(rows)), sizes)
    worth = np.where(labels == 1, weight[1], weight[0])
    worth /= worth.sum()
    share = float((worth * labels).sum())
    theta, base = np.zeros(max(width, 1)), math.log(share / (1 - share))
    point, point_base, rate = theta.copy(), base, 4.0 / max(float(sizes.max(initial=1)), 4.0)
    for step in range(1, 401):
        margin = point_base + np.bincount(owner, point[columns], len(rows))
        wrong = worth * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels)
        slope = np.bincount(columns, wrong[owner], len(theta)) + 1e-5 * point
        new, new_base = point - rate * 4 * slope, point_base - rate * 4 * wrong.sum()
        pull = (step - 1) / (step + 2)
        point, point_base = new + pull * (new - theta), new_base + pull * (new_base - base)
        theta, base = new, new_base
    return theta, base


def trained(
    documents: DataFrame, labels: DataFrame, training: Callable[[Column], Column]
) -> Model:
    """The model from the labelled rows for which ``training(doc_id)`` is true."""
    costs = language_model(documents)
    known = labels.where(training(F.col("doc_id")) & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        share = 1.0 if n.get(1) else 0.0
        return Model(costs, base=math.inf if share else -math.inf)
    limits = {1: MAX_TOXIC, 0: MAX_CLEAN}
    steps = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(steps))
    limit = {k: steps if n[k] <= limits[k] else steps * limits[k] // n[k] for k in n}
    chosen = known.where(
        draw < F.when(F.col("toxic") == 1, F.lit(limit[1])).otherwise(F.lit(limit[0]))
    )
    # Bounded: about MAX_TOXIC + MAX_CLEAN rows.
    sample = documents.select("doc_id", text_of("text").alias("text")).join(
        F.broadcast(chosen), "doc_id"
    ).select("text", "toxic")
    drawn = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not drawn.get(1) or not drawn.get(0):
        return Model(costs, base=math.log(n[1] / n[0]))
    counts = (
        sample.mapInArrow(_counted(costs), "feature string, bad long, clean long")
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean"))
        .where(F.col("bad") >= MIN_DOCUMENTS)
    )
    ratio = _ratio(F.col("bad"), F.col("clean"), float(drawn[1]), float(drawn[0]))
    telling = (
        counts.withColumn("ratio", ratio)
        .where(F.col("ratio") >= MIN_RATIO)
        .orderBy(F.col("ratio").desc(), "feature")
        .limit(MAX_FEATURES)
        .collect()
    )
    features = {r["feature"]: i for i, r in enumerate(telling)}
    rows = sample.mapInArrow(_listed(costs, features), "toxic int, features array<int>").collect()
    rows = sorted((r["toxic"], list(r["features"])) for r in rows)
    weights, base = _fitted(rows, len(features), (n[0] / drawn[0], n[1] / drawn[1]))
    return Model(costs, features, weights, base)


def with_score(
    documents: DataFrame, model: Model, text: str = "text", to: str = "toxic_score"
) -> DataFrame:
    """``documents`` with the score in ``to``, which replaces a column of that name."""
    kept = [f for f in documents.schema if f.name != to]
    schema = T.StructType([*kept, T.StructField(to, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.costs, model.features)
        for batch, texts in slices(batches, text, WORDS_CHUNK):
            yield replaced_column(batch, to, pa.array(model.score(reader, texts)))

    return documents.mapInArrow(run, schema)


def restored(documents: DataFrame, costs: np.ndarray, text: str = "text") -> DataFrame:
    """The documents with disguised words restored; same columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, text):
            at = batch.schema.get_field_index(text)
            columns = list(batch.columns)
            columns[at] = pa.array([restored_text(t, costs) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return documents.mapInArrow(run, documents.schema)


#: Rows whose id has this remainder are held out.
FOLDS, HELD_OUT = 4, 2


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    def held(doc_id: Column) -> Column:
        return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))

    model = trained(documents, labels, lambda doc_id: doc_id.isNotNull() & ~held(doc_id))
    out = with_score(documents.select("doc_id", "text"), model)
    return out.select(
        "doc_id",
        held(F.col("doc_id")).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
