"""Quality classification from trusted positives and unlabelled text.

Negatives are never learnt from. With positives P, unlabelled documents U and the class
prior ``pi``, the risk of a scorer g is

    pi * E_P[loss(g)] + max(0, E_U[loss(-g)] - pi * E_P[loss(-g)])

The second part estimates the risk on negatives; it cannot be below zero. The loss of a margin z is
``(1 - z)**2 / 4``, and g is linear in ``phi``: ``FEATURES`` numbers of the whole text (how often
classes of bytes follow each other, how many words are new or repeat the one before,
and sizes) and ``_HIDDEN`` fixed random combinations of them. So the risk is a function of the
first and second moments of phi on P and U alone. Those of U are sums over *all* documents of the
training folds, one pass in tasks. Numbers are whole multiples of ``1 / _UNIT``, so sums are exact
and do not depend on how rows are dealt.

The risk is convex, and its least point is found exactly: without the bound it solves one linear
system; if the second part is below zero there, the least point lies where that part is zero,
which is found by bisection over systems in which it weighs less.

The prior is estimated from P and U as well. The least squares fit r of the density ratio P / U is
at most ``1 / pi``, and equal to it where no negatives are, so ``1 / E_P[r]`` estimates pi if the
classes hardly overlap, and is above it otherwise. r is fitted to one half of P and averaged
over the other, which takes the noise of either out of their product.

Last, the margin from which a document is accepted is the one of the least non-negative risk
of the 0-1 loss, over all documents of the training folds (of equal ones the middle): a pass that
counts margins in ``_BINS`` classes. The scorer sees nothing but the text.

It is fitted with a bounded sample of the labels, by hash of the id: about ``MAX_POSITIVES``
trusted documents of the training folds. Unlabelled text is not sampled.

Null texts read as empty. Rows of a document that repeat are scored alike. A document
with several labels counts as positive if one of them is. Without positives, or without texts
of theirs, all scores are 0.5. Empty tables give an empty result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import free_name, freeing, replaced_column, text_of
from weftline.llm.word_ids import chunks

MAX_POSITIVES = 8_000
THRESHOLD = 0.5
#: Random combinations of the numbers, and what is added to second moments.
_HIDDEN = 64
_RIDGE = 3e-3
_SEED = 1
#: Parts of one in which phi is counted.
_UNIT = 4096
#: Classes of margins from -2 to 2.
_BINS = 4096
#: Slope of the score at the threshold.
_STEEP = 4.0
#: Tasks that add up the sums of all others.
_SUMS = 8

#: Classes of bytes. What is in no class, from 0x80 on, is the last class.
_CLASSES = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r",
    ".", ",", "!?;:", "'\"()-", "#", "$", "%", "&", "*", "|_<>{}[]\\/=+~^`@",
)
_WIDTH = len(_CLASSES) + 1
FEATURES = _WIDTH * _WIDTH + 5


def _byte_classes() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.int64)
    for number, members in enumerate(_CLASSES):
        table[list(members.encode())] = number
    return table


_CLASS_OF = _byte_classes()


def features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text."""
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    classes = _CLASS_OF[np.frombuffer(b"".join(raw), np.uint8)]
    owner = np.repeat(np.arange(len(raw)), sizes)
    cells = _WIDTH * _WIDTH
    follows = owner[:-1] == owner[1:]
    codes = owner[:-1] * cells + classes[:-1] * _WIDTH + classes[1:]
    counts = np.bincount(codes[follows], minlength=len(raw) * cells).reshape(len(raw), cells)
    words = [_word_numbers(t) for t in texts]
    shares = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    return np.hstack([shares, np.array(words).reshape(len(raw), 5)]).astype(np.float32)


def _word_numbers(text: str) -> tuple[float, ...]:
    words = text.split()
    n = max(len(words), 1)
    lines = text.count("\n") + 1
    again = sum(map(str.__eq__, words, words[1:])) if len(words) > 1 else 0
    return (
        len(set(words)) / n ** 0.8,
        again / n,
        np.log1p(n),
        len(text) / n / 10,
        np.log1p(n / lines),
    )


class Basis:
    """phi: one, the numbers scaled by those of the positives, and random combinations of them."""

    def __init__(self, positives: np.ndarray):
        self.mean, self.spread = positives.mean(0), positives.std(0) + 0.01
        random = np.random.default_rng(_SEED)
        self.mix = random.normal(0, FEATURES**-0.5, (FEATURES, _HIDDEN))
        self.shift = random.normal(0, 1, _HIDDEN)

    def of(self, rows: np.ndarray) -> np.ndarray:
        """Whole numbers, in parts of ``_UNIT``."""
        scaled = np.clip((rows - self.mean) / self.spread, -5, 5)
        phi = np.hstack([
            np.ones((len(rows), 1)), scaled / 5, np.tanh(scaled @ self.mix + self.shift)
        ])
        return np.rint(phi * _UNIT)


@dataclass
class Moments:
    """Sums over some documents; ``second`` has those of products, with the constant one first."""

    second: np.ndarray

    @classmethod
    def of(cls, phi: np.ndarray) -> Moments:
        return cls((phi.T @ phi).astype(np.int64))

    @property
    def gram(self) -> np.ndarray:
        return self.second / self.second[0, 0]

    @property
    def mean(self) -> np.ndarray:
        return self.gram[0]


def class_prior(half: np.ndarray, other: np.ndarray, gram: np.ndarray) -> float:
    """Share of positives, from the means of two halves of P and the second moments of U."""
    ratio = np.linalg.solve(gram + _RIDGE * np.eye(len(gram)), half)
    return float(np.clip(1 / max(other @ ratio, 1e-9), 0.01, 0.99))


def least_risk(p: Moments, u: Moments, prior: float) -> np.ndarray:
    """Weights of the scorer with the least non-negative risk."""
    ridge = _RIDGE * np.eye(len(u.second))

    def negative(w: np.ndarray) -> float:
        def squared(m: Moments) -> float:
            return (w @ m.gram @ w + 2 * m.mean @ w + 1) / 4

        return squared(u) - prior * squared(p)

    def solved(less: float) -> np.ndarray:
        """The least point if the risk on negatives weighs ``1 - less``."""
        left = less * prior * p.gram + (1 - less) * u.gram + ridge
        return np.linalg.solve(left, prior * p.mean - (1 - less) * (u.mean - prior * p.mean))

    weights = solved(0.0)
    if negative(weights) >= 0:
        return weights
    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if negative(solved(middle)) < 0 else (low, middle)
    return solved(high)


def best_cut(p: np.ndarray, u: np.ndarray, prior: float) -> float:
    """The margin of the least non-negative 0-1 risk, from counts of P and U by class of margin."""
    above_p = np.append(np.cumsum(p[::-1])[::-1], 0) / max(p.sum(), 1)
    above_u = np.append(np.cumsum(u[::-1])[::-1], 0) / max(u.sum(), 1)
    risk = prior * (1 - above_p) + np.maximum(0, above_u - prior * above_p)
    best = np.flatnonzero(risk <= risk.min() + 1e-12)
    return float((best[0] + best[-1]) / 2 * 4 / len(p) - 2)


@dataclass
class Scorer:
    basis: Basis
    weights: np.ndarray
    cut: float = 0.0

    def margin(self, rows: np.ndarray) -> np.ndarray:
        return self.basis.of(rows) / _UNIT @ self.weights

    def bins(self, rows: np.ndarray) -> np.ndarray:
        """How many rows have a margin of each class."""
        places = np.floor((self.margin(rows) + 2) * _BINS / 4).astype(np.int64)
        return np.bincount(np.clip(places, 0, _BINS - 1), minlength=_BINS)

    def score(self, rows: np.ndarray) -> np.ndarray:
        # Rounded, as the last bits of a product depend on how many rows it is made for.
        above = np.round(self.margin(rows) - self.cut, 9)
        return 1 / (1 + np.exp(-_STEEP * above))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in chunks(batches):
        raw = pa.array([r.tobytes() for r in features(texts)], pa.binary())
        yield pa.RecordBatch.from_arrays([raw], ["numbers"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of all rows of 64-bit numbers of a partition, if there are any."""
    total = None
    for batch in batches:
        for raw in batch.column(0):
            one = np.frombuffer(raw.as_buffer(), np.int64)
            total = one.copy() if total is None else total + one
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def total(texts: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``of(features)`` over all texts, an array of 64-bit integers.

    One row a task, added up by ``_SUMS`` tasks, whose rows come to the driver. None without texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for _, some in chunks(batches):
            one = of(features(some))
            found = one if found is None else found + one
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["sums"])

    parts = texts.select("text").mapInArrow(freeing(run), "sums binary").repartition(_SUMS)
    rows = parts.mapInArrow(freeing(_summed), "sums binary").collect()
    return sum(np.frombuffer(r["sums"], np.int64) for r in rows) if rows else None


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def _share(wanted: int, rows: int, seed: int, *of: str) -> Column:
    """True for about ``wanted`` of ``rows`` rows, by hash."""
    steps = 1 << 30
    return F.pmod(F.xxhash64(*of, F.lit(seed)), F.lit(steps)) < F.lit(
        steps if rows <= wanted else steps * wanted // rows
    )


def trained(
    documents: DataFrame, labels: DataFrame, training: Callable[[Column], Column]
) -> Scorer | None:
    """The scorer, from the rows for which ``training(doc_id)`` is true; None without positives."""
    good = labels.where(training(F.col("doc_id")) & (F.col("quality") == 1)).select("doc_id").distinct()
    n_good = good.count()
    trusted = F.broadcast(good.where(_share(MAX_POSITIVES, n_good, 1, "doc_id")))
    pool = documents.where(training(F.col("doc_id"))).select("doc_id", text_of("text").alias("text"))
    rows = pool.join(trusted, "doc_id", "left_semi").select("text").mapInArrow(freeing(_featured), "numbers binary")
    raw = sorted(bytes(r["numbers"]) for r in rows.collect()) if n_good else []
    if not raw:
        return None
    positives = np.stack([np.frombuffer(r, np.float32) for r in raw]).astype(np.float64)
    basis = Basis(positives)
    phi = basis.of(positives)

    def products(some: np.ndarray) -> np.ndarray:
        return Moments.of(basis.of(some.astype(np.float64))).second.ravel()

    p = Moments.of(phi)
    u = Moments(total(pool, products).reshape(p.second.shape))
    # Of a single positive both halves are that one.
    halves = phi[::2], phi[1::2] if len(phi) > 1 else phi
    prior = class_prior(*(h.mean(0) / _UNIT for h in halves), u.gram)
    scorer = Scorer(basis, least_risk(p, u, prior))
    margins = total(pool, lambda some: scorer.bins(some.astype(np.float64)))
    scorer.cut = best_cut(scorer.bins(positives), margins, prior)
    return scorer


def with_score(
    documents: DataFrame, scorer: Scorer | None, text: str = "text", to: str = "quality_score"
) -> DataFrame:
    """``documents`` with the score in ``to``, which replaces a column of that name."""
    kept = [f for f in documents.schema if f.name != to]
    schema = T.StructType([*kept, T.StructField(to, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, text):
            scores = scorer.score(features(texts).astype(np.float64)) if scorer else np.full(len(texts), 0.5)
            yield replaced_column(batch, to, pa.array(scores, pa.float64()))

    return documents.mapInArrow(freeing(run), schema)


#: Rows whose id has this remainder are held out.
FOLDS, HELD_OUT = 3, 1


def _training(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, FOLDS) != HELD_OUT, F.lit(False))


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scorer = trained(documents, labels, _training)
    out = with_score(documents.select("doc_id", "text"), scorer)
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return out.select(
        "doc_id",
        held.alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def kept(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject; same columns."""
    scorer = trained(documents, labels, _training)
    name = free_name(documents, "quality_score")
    out = with_score(documents, scorer, to=name)
    return out.where(F.col(name) >= THRESHOLD).drop(name)
