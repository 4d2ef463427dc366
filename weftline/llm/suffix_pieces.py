"""SentencePiece encoding and decoding by suffix-array matching.

A text becomes its pieces as follows. Spaces turn into ``▁`` and one is put before the
text. No piece holds a ``▁`` after another character, so the text is cut before each run
of ``▁`` and equal cuts have equal ids; a worker works out each cut once, as far as it
remembers. Signs at the end of a word of letters are a cut of their own if no piece holds
one after a letter. The new cuts of a batch are joined to one text, and then:

1. the suffixes of the text, as deep as the longest piece, are sorted;
2. every piece of the vocabulary is found by binary search: its first and last suffix
   give the range of all its occurrences;
3. an occurrence is an edge from its start to its end; edges are sorted by position;
4. edges are relaxed from left to right: the state of a position is the last piece of
   the encoding of everything before it.

The model merges the best-scored neighbours first. Of such an encoding every two
neighbouring pieces encode as just these two, and a sequence of which this holds is the
encoding, since merges in one piece never depend on what is further than the next piece.
So an edge is relaxed if its start has a state and that piece and the edge's go
together; for each end one edge does. Which pairs go together is found by merging the
two pieces alone, once a pair. A character in no piece is an edge of its own that goes
with all, and becomes its UTF-8 bytes' pieces.

Decoding looks up the bytes of all ids in one table, turns ``▁`` to a space, drops the
space in front, and reads the rest as UTF-8.

Null and empty texts have no ids and decode to the empty text. A literal ``▁`` decodes to a space,
as with the library; every other text comes back whole. Texts of any length are encoded
whole. Repeated rows are encoded as often. An empty table gives an empty result. Other
columns do not matter to the ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftline.llm.common import freeing, replaced_column
from weftline.llm.word_ids import WordIds, halves, ranges_of, slices

SPACE = "▁"
_CUT = re.compile(f"{SPACE}+[^{SPACE}]*")
_BYTE = re.compile("<0x([0-9A-F]{2})>")
#: Characters of new cuts that are indexed at once.
INDEX_CHARS = 1 << 17
#: Bytes of text worked on at once, and cuts that a worker remembers: they bound its memory.
_CHUNK = 1 << 20
_MEMORY = 300_000
#: What a worker remembers between tasks.
_IDLE = 50_000
#: Pairs of pieces that a worker remembers, at nine bytes each.
_PAIR_SLOTS = 1 << 21
_MIX = 0x9E3779B97F4A7C15 - (1 << 64)
_UNKNOWN, _UNREACHED = -1, -2
#: Signs that end many words, and a mark for them that no text holds.
_SIGNS = ".,!?;:%&*$#|)\"'"
_END = "\ud800"


class Pieces:
    """The vocabulary of a SentencePiece model that merges pairs, with byte pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.score = [model.get_score(i) for i in range(len(self.text))]
        plain = [
            i for i in range(len(self.text))
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                    or model.is_unused(i))
        ]
        self.number = {self.text[i]: i for i in plain}
        self.of_byte = [0] * 256
        self.bytes = [t.replace(SPACE, " ").encode() for t in self.text]
        for i, t in enumerate(self.text):
            if model.is_byte(i):
                value = int(_BYTE.fullmatch(t)[1], 16)
                self.of_byte[value], self.bytes[i] = i, bytes([value])
            elif model.is_control(i):
                self.bytes[i] = b""
        self.longest = max(map(len, self.number))
        if any(SPACE in t.lstrip(SPACE) for t in self.number):
            raise ValueError("a piece holds a space after another character")
        found = sorted(self.number)
        self.sorted_ids = np.array([self.number[t] for t in found])
        self.sorted = np.array(found, f"U{self.longest}")
        self.lengths = np.array([len(t) for t in found])
        self.signs = "".join(
            c for c in _SIGNS if not any(
                b == c and a.isalpha() for t in self.number for a, b in zip(t, t[1:], strict=False)
            )
        )
        self._pairs = np.full(_PAIR_SLOTS, -1, np.int64)
        self._fit = np.zeros(_PAIR_SLOTS, bool)

    def together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each two pieces' text is encoded as just these two. Negative: in no piece.

        Answers are kept in slots by a hash of the pair; a slot holds the last pair asked.
        """
        fit = np.ones(len(left), bool)
        asked = np.flatnonzero((left >= 0) & (right >= 0))
        pairs = left[asked] << 32 | right[asked]
        slots = (pairs * _MIX >> 20) & (_PAIR_SLOTS - 1)
        known = self._pairs[slots] == pairs
        fit[asked] = self._fit[slots]
        if not known.all():
            new, which = np.unique(pairs[~known], return_inverse=True)
            found = np.fromiter(map(self._fits, new.tolist()), bool, len(new))
            places = (new * _MIX >> 20) & (_PAIR_SLOTS - 1)
            self._pairs[places] = new
            # Pairs of one batch may share a slot: the slot tells which pair it holds.
            last = self._pairs[places] == new
            self._fit[places[last]] = found[last]
            fit[asked[~known]] = found[which]
        return fit

    def _fits(self, pair: int) -> bool:
        left, right = pair >> 32, pair & 0xFFFFFFFF
        return self._merged(self.text[left] + self.text[right]) == [left, right]

    def _merged(self, text: str) -> list[int]:
        """Merges the best-scored neighbours, the first of equals, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.number.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.score[piece] > best):
                    best, at = self.score[piece], i
            if best is None:
                return [self.number[p] for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and piece of all occurrences of all pieces, by start and then end."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        padded = np.concatenate([points, np.zeros(self.longest, np.uint32)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[: len(points)]
        suffixes = np.ascontiguousarray(windows).view(f"U{self.longest}").ravel()
        order = np.argsort(suffixes, kind="stable")
        ordered = suffixes[order]
        first = np.searchsorted(ordered, self.sorted, "left")
        # After all suffixes that start with the piece: those below it with its last
        # character raised by one.
        last = np.searchsorted(ordered, _raised(self.sorted, self.lengths), "left")
        counts = last - first
        starts = order[ranges_of(counts, first)]
        lengths = np.repeat(self.lengths, counts)
        pieces = np.repeat(self.sorted_ids, counts)
        by_place = np.lexsort((lengths, starts))
        starts, pieces = starts[by_place], pieces[by_place]
        return starts, starts + lengths[by_place], pieces

    def encode(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the cuts, joined, and how many each has; cuts are indexed together.

        Cuts of like length are relaxed together.
        """
        order = sorted(range(len(cuts)), key=lambda i: len(cuts[i]))
        groups: list[list[str]] = [[]]
        size = 0
        for i in order:
            if groups[-1] and size + len(cuts[i]) > INDEX_CHARS:
                groups.append([])
                size = 0
            groups[-1].append(cuts[i])
            size += len(cuts[i]) + 1
        found = [self._encode(g) for g in groups if g]
        ids = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int32)
        lengths = np.zeros(len(cuts), np.int64)
        if found:
            lengths[order] = np.concatenate([f[1] for f in found])
        starts = np.zeros(len(cuts), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return ids[ranges_of(lengths, starts)], lengths

    def _encode(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # No piece holds a NUL, so no edge leaves a cut.
        text = "\0".join(cuts)
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        bases = np.cumsum(sizes + 1) - sizes - 1
        inside = np.ones(len(text) + 1, bool)
        inside[bases + sizes] = False
        starts, ends, pieces = self.edges(text)
        # Characters that are no piece are edges too.
        alone = inside.copy()
        alone[starts[ends == starts + 1]] = False
        alone = np.flatnonzero(alone)
        starts = np.concatenate([starts, alone])
        ends = np.concatenate([ends, alone + 1])
        pieces = np.concatenate([pieces, np.full(len(alone), _UNKNOWN)])
        depth = starts - np.repeat(bases, sizes + 1)[starts]
        order = np.argsort(depth, kind="stable")
        starts, ends, pieces = starts[order], ends[order], pieces[order]
        steps = np.searchsorted(depth[order], np.arange(int(sizes.max(initial=0)) + 1))
        state = np.full(len(text) + 1, _UNREACHED)
        came = np.zeros(len(text) + 1, np.int64)
        state[bases] = _UNKNOWN
        for a, b in zip(steps, steps[1:], strict=False):
            left = state[starts[a:b]]
            live = a + np.flatnonzero(left != _UNREACHED)
            live = live[self.together(state[starts[live]], pieces[live])]
            state[ends[live]] = pieces[live]
            came[ends[live]] = starts[live]
        return self._traced(text, bases, sizes, state, came)

    def _traced(self, text, bases, sizes, state, came) -> tuple[np.ndarray, np.ndarray]:
        """Follows the relaxed edges back from the end of each cut."""
        at, owner = bases + sizes, np.arange(len(bases))
        places, owners, found = [], [], []
        while True:
            live = at > bases[owner]
            at, owner = at[live], owner[live]
            if not len(at):
                break
            found.append(state[at])
            at = came[at]
            places.append(at)
            owners.append(owner)
        if not found:
            return np.empty(0, np.int32), np.zeros(len(bases), np.int64)
        places, owners, found = map(np.concatenate, (places, owners, found))
        order = np.argsort(places, kind="stable")
        places, owners, found = places[order], owners[order], found[order]
        unknown = np.flatnonzero(found == _UNKNOWN)
        if len(unknown):
            raw = [text[i].encode() for i in places[unknown].tolist()]
            width = np.ones(len(found), np.int64)
            width[unknown] = [len(r) for r in raw]
            first = np.cumsum(width) - width
            found, owners = np.repeat(found, width), np.repeat(owners, width)
            for i, r in zip(first[unknown].tolist(), raw, strict=True):
                found[i:i + len(r)] = [self.of_byte[b] for b in r]
        return found.astype(np.int32), np.bincount(owners, minlength=len(bases))


def _raised(pieces: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    points = np.array(pieces).view(np.uint32).reshape(len(pieces), -1).copy()
    points[np.arange(len(pieces)), lengths - 1] += 1
    return points.view(pieces.dtype).ravel()


_models: dict[str, tuple[Pieces, WordIds]] = {}


def _model(path: str) -> tuple[Pieces, WordIds]:
    """The worker's model, shared by its tasks, and a memory of cuts."""
    if path not in _models:
        pieces = Pieces(path)

        def parts(words: pa.Array) -> list[list[str]]:
            return halves(words, pieces.signs, lambda body: body[-1:].isalpha(), _END)

        def encode(cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            return pieces.encode([_whole(c) for c in cuts])

        _models[path] = pieces, WordIds(encode, parts, _MEMORY)
    return _models[path]


def _whole(cut: str) -> str:
    """A cut with its ``▁``; those of words after one space are kept without it."""
    if cut.startswith(_END):
        return cut[1:]
    return cut if cut.startswith(SPACE) else SPACE + cut


def _cuts(texts: pa.Array) -> pa.ListArray:
    """Cuts of each text. Words after one space come without their ``▁``."""
    odd = pc.or_(
        pc.or_(pc.match_substring(texts, SPACE), pc.match_substring(texts, "  ")),
        pc.or_(pc.starts_with(texts, " "), pc.equal(texts, "")),
    )
    words = pc.split_pattern(texts, " ")
    at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    if not len(at):
        return words
    found = [
        _CUT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts.take(at).to_pylist()
    ]
    rows = np.arange(len(texts))
    rows[at] = len(texts) + np.arange(len(at))
    return pa.concat_arrays([words, pa.array(found, words.type)]).take(pa.array(rows))


class Decoder:
    """Bytes of pieces in one table."""

    def __init__(self, pieces: Pieces):
        self.lengths = np.array([len(b) for b in pieces.bytes])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(pieces.bytes), np.uint8)

    def __call__(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        lengths = self.lengths[ids]
        raw = self.table[ranges_of(lengths, self.starts[ids])].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(sizes)].tolist()
        return [
            raw[a:b].decode("utf-8", "replace").removeprefix(" ")
            for a, b in zip([0, *ends], ends, strict=False)
        ]


def _ids_column(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))


def _encoding(path: str, text: str, to: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, words = _model(path)
        for batch, texts in slices(batches, text, _CHUNK):
            ids, sizes = words(_cuts(texts))
            yield replaced_column(batch, to, _ids_column(ids, sizes))
        words.trim(_IDLE)

    return run


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    kept = [f for f in df.schema if f.name != name]
    return T.StructType([*kept, T.StructField(name, kind)])


def encoded(df: DataFrame, path: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with the ids of the column ``text`` in ``to``, which replaces one of that name."""
    schema = _with_column(df, to, T.ArrayType(T.IntegerType()))
    return df.mapInArrow(freeing(_encoding(path, text, to)), schema)


def _decoding(path: str, ids: str, to: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(_model(path)[0])
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            yield replaced_column(batch, to, pa.array(decode(flat, sizes), pa.string()))

    return run


def decoded(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids in ``to``, which replaces a column of that name."""
    schema = _with_column(df, to, T.StringType())
    return df.mapInArrow(freeing(_decoding(path, ids, to)), schema)


def _both_ways(path: str) -> Callable:
    """Ids, and the digest of the text that decoding them gives back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, words = _model(path)
        decode = Decoder(pieces)
        for batch, texts in slices(batches, "text", _CHUNK):
            ids, sizes = words(_cuts(texts))
            back = pa.array(decode(ids, sizes), texts.type)
            digests = [hashlib.sha256(t.as_buffer()).hexdigest() for t in back]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    _ids_column(ids, sizes),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests),
                    pc.equal(back, texts),
                ],
                ["doc_id", "ids", "n_tokens", "decoded_sha256", "same"],
            )
        words.trim(_IDLE)

    return run


def encoded_and_decoded(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_tokens, decoded_sha256 and whether the text came back, per document."""
    of = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {of}, ids array<int>, n_tokens long, decoded_sha256 string, same boolean"
    return documents.select("doc_id", "text").mapInArrow(freeing(_both_ways(path)), schema)
