"""Ids of whole texts from the ids of their words, each word encoded once a worker.

A tokenizer whose pieces never cross a cut encodes a text as its cut parts, one after the
other. Arrow finds the different words of a chunk of texts; ``WordIds`` keeps the ids of
parts it has met in one flat array and encodes only new ones, in one call a chunk. The
memory is bounded: beyond ``limit`` parts it keeps the third that most chunks used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at once; a longer text is worked on alone.
CHUNK_CHARS = 1 << 20
WORDS_CHUNK = 4 << 20
#: Parts that a worker remembers, at about 200 bytes each.
MEMORY_PARTS = 700_000


def ranges_of(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, joined."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class WordIds:
    """``encode`` gives the joined ids of parts and how many each has.

    ``parts`` cuts each of the different words in a fixed number of parts.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        parts: Callable[[pa.Array], list[list[str]]],
        limit: int = MEMORY_PARTS,
    ):
        self.encode, self.parts, self.limit = encode, parts, limit
        self.numbers: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.flat = np.empty(0, np.int32)
        self.used = np.empty(0, np.int64)

    def trim(self, keep: int) -> None:
        """Forgets all parts but the ``keep`` that most chunks used; gives memory back."""
        if len(self.numbers) <= keep:
            return
        kept = np.sort(np.argsort(-self.used, kind="stable")[:keep])
        lengths = np.diff(self.starts)[kept]
        self.flat = self.flat[ranges_of(lengths, self.starts[kept])]
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        # Half of the past counts, so that parts of new texts can take over.
        self.used = self.used[kept] // 2
        parts = list(self.numbers)
        self.numbers = {parts[i]: n for n, i in enumerate(kept.tolist())}

    def _learn(self, parts: list[str]) -> None:
        ids, lengths = self.encode(parts)
        known = len(self.numbers)
        self.numbers.update(zip(parts, range(known, known + len(parts)), strict=True))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.used = np.concatenate([self.used, np.zeros(len(parts), np.int64)])

    def _of_different(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, joined, and how many each has."""
        if len(self.numbers) > self.limit:
            self.trim(self.limit // 3)
        cut = self.parts(words)
        fresh = sorted(set().union(*cut).difference(self.numbers))
        if fresh:
            self._learn(fresh)
        numbers = np.stack([
            np.fromiter(map(self.numbers.__getitem__, c), np.int64, len(c)) for c in cut
        ], axis=1)
        self.used += np.bincount(numbers.ravel(), minlength=len(self.used))
        starts = self.starts[numbers]
        lengths = self.starts[numbers + 1] - starts
        return self.flat[ranges_of(lengths.ravel(), starts.ravel())], lengths.sum(1)

    def __call__(self, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, given as lists of words, and the number of ids of each."""
        coded = words.flatten().dictionary_encode()
        ids, sizes = self._of_different(coded.dictionary)
        each = coded.indices.to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[each]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        last = np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))
        return ids[ranges_of(lengths, starts[each])], np.diff(ends[last], prepend=0)


def halves(
    words: pa.Array, signs: str, plain: Callable[[str], bool], mark: str = ""
) -> list[list[str]]:
    """Each word and the ``signs`` at its end, which come after ``mark``.

    Only where what is left is ``plain``; other words stay whole.
    """
    stripped = pc.utf8_rtrim(words, signs)
    at = np.flatnonzero(pc.not_equal(stripped, words).to_numpy(zero_copy_only=False))
    bodies, ends = words.to_pylist(), [mark] * len(words)
    for i, body in zip(at.tolist(), stripped.take(pa.array(at)).to_pylist(), strict=True):
        if plain(body):
            ends[i] = mark + bodies[i][len(body):]
            bodies[i] = body
    return [bodies, ends]


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches of about ``size`` bytes each, with their texts (null: empty)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // size
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if a < b:
                yield batch.slice(a, b - a), pc.fill_null(column.slice(a, b - a), "")


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """As ``slices``, the texts as a list."""
    for batch, texts in slices(batches, text, size):
        yield batch, texts.to_pylist()
