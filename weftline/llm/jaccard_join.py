"""Exact Jaccard join of word n-grams by size-banded tiles and bitmap signatures.

A document's set holds the hashes of its different runs of ``NGRAM`` words (A-Z lower-cased), of
the whole sequence if it has fewer words. Two documents link if ``100 * common >= percent *
together`` of their sets; classes are the connected components of the links. Equal sets
are one entry from the start.

Tiles. Sizes are cut in bands, a set belongs to the band of its size and, where a larger partner
may be in the next one, to that too. Two linked sets of a band differ in at most ``H`` elements,
where ``H`` follows from the band's largest size. The hash values are cut in more than ``H``
parts, so at least one part of the two is the same (and one that is not empty, see
``Bands``): sets meet in the tile of a band, a part and its sum. No link is missed.

Signatures. Bit ``h mod b`` of a bitmap says whether an odd number of elements falls on it. Two
sets of sizes m and n whose bitmaps differ in x bits differ in at least x elements, so they have at
most ``(m + n - x) / 2`` in common. Only pairs that this bound and their sizes allow are
intersected, as sorted arrays.

First each set is compared with the centre of its tile, among those of like size, which links most
of a large group at once. Tiles that still hold several classes are gone through in full: a
tile is cut by size into blocks of ``_BLOCK`` sets (or ``_BLOCK_BYTES``), and each two blocks
whose sizes allow a link are a task's work. By signatures alone it tells which sets may link to
another class there; such sets are intersected pair by pair, the best bound first, as classes grow
with each link, so a block gives fewer links than it has sets. As a pair meets in many tiles, sets
are not brought to all of them at once: first each set goes to one block, its largest; then the
pairs that small blocks still name are intersected, once each, and struck out if they do not
link; last, sets go to all blocks that still have a pair. Nothing is capped or dropped. The
time for unlike sets that share a part grows with the square of their number.

Elements are 64-bit hashes: two different runs of words with one hash would count as one.
Null texts read as empty; texts without words have an empty set and link with nothing, not with
each other either. Texts are read whole, repeated rows and equal sets are linked. A class is
named by its least doc_id, null if all are null. A document without words is named by its own.
Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import broadcast_if_few, saved, text_of
from weftline.llm.order_minhash import components
from weftline.llm.word_ids import slices

NGRAM = 3
PERCENT = 90
#: A band reaches from a size to this many times it.
_BAND = 1.5
#: Sets, or bytes of sets, in a block of a tile.
_BLOCK = 1024
_BLOCK_BYTES = 16 << 20
#: Blocks of up to so many sets name pairs, instead of having their sets brought to them.
_FEW = 16
#: Rows of a tile that are held at once when centres are chosen.
_HELD = 1 << 16
_SEED = 20250211

_random = np.random.default_rng(_SEED)
_OF_BYTE = _random.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_OF_PLACE = _random.integers(1, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_OF_PART, _OF_BAND = (np.uint64(x) for x in _random.integers(1, 1 << 63, 2) * 2 + 1)
_BASE = 0x5DEECE66D1234567 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# --- sets ------------------------------------------------------------------------------


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            up = np.full(n, _BASE, np.uint64)
            down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of lower-cased bytes, and where each starts."""
    inside = np.concatenate([[False], ~_IS_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[data] * up[:-1])])
    return _mixed((sums[ends] - sums[starts]) * down[starts]), starts


def ngram_sets(texts: pa.Array, n: int = NGRAM) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    raw = [t.as_buffer() for t in texts]
    words, starts = _word_hashes(_LOWER[np.frombuffer(b" ".join(raw), np.uint8)])
    ends = np.cumsum([len(r) + 1 for r in raw])
    cuts = np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64)
    runs = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for i in range(n if len(runs) else 0):
        runs += words[i:i + len(runs)] * _OF_PLACE[i]
    runs = _mixed(runs)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(runs[a:b - n + 1])
        elif b > a:
            # Its own number of words keeps it apart from longer runs.
            short = np.uint64(b - a) + (words[a:b] * _OF_PLACE[:b - a]).sum(dtype=np.uint64)
            yield _mixed(np.array([short], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def linked_sizes(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """The largest size that a set of ``size`` can link to."""
    return size * 100 // percent


def most_apart(size: int, percent: int) -> int:
    """How many elements two linked sets of at most ``size`` can differ in."""
    return 2 * size * (100 - percent) // (100 + percent)


class Bands:
    """The tiles of sets: bands of sizes and cuts of the hash values, which follow from ``percent``."""

    def __init__(self, percent: int):
        self.percent = percent
        self.tops = [0]
        self.cuts: dict[int, np.ndarray] = {}

    def of(self, size: int) -> list[int]:
        """Upper sizes of the bands in which a set meets those that it can link to, itself included."""
        largest = int(linked_sizes(size, self.percent))
        while self.tops[-1] < largest:
            self.tops.append(max(int(self.tops[-1] * _BAND), self.tops[-1] + 1))
        first, last = np.searchsorted(self.tops, [size, largest]).tolist()
        return self.tops[first:last + 1]

    def keys(self, elements: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """Keys of all tiles of a sorted set; ``mixed`` are its elements after ``_mixed``."""
        if not len(elements):
            return np.empty(0, np.int64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
        return np.concatenate([self._keys(elements, sums, t) for t in self.of(len(elements))])

    def _keys(self, elements: np.ndarray, sums: np.ndarray, top: int) -> np.ndarray:
        """Keys of the parts of a set in one band.

        There are ``spare + 1`` more parts than linked sets can differ in elements, so that many
        at least are the same. A set with up to ``spare`` empty parts leaves these out: one of
        the same parts is not empty. A set with more keeps its empty parts, too; if only empty
        parts of two sets are the same, both have more than ``spare``.
        """
        apart = most_apart(top, self.percent)
        if not apart:
            return np.empty(0, np.int64)
        spare = 1 + apart // 16
        parts = apart + spare + 1
        if top not in self.cuts:
            self.cuts[top] = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
        edges = np.concatenate([
            [0], np.searchsorted(elements, self.cuts[top]), [len(elements)]
        ]).astype(np.int64)
        number = np.arange(parts, dtype=np.uint64)
        part = sums[edges[1:]] - sums[edges[:-1]]
        band = np.full(parts, top, np.uint64) * _OF_BAND
        keys = _mixed(part + number * _OF_PART + band).view(np.int64)
        filled = edges[1:] > edges[:-1]
        return keys[filled] if parts - filled.sum() <= spare else keys


def signature(elements: np.ndarray) -> np.ndarray:
    """Bytes of the bitmap: a bit for every one to two elements, at least 64."""
    bits = 1 << max(6, (len(elements) - 1).bit_length() - 1)
    odd = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """The bitmap of fewer bits, as ``signature`` makes it."""
    if len(bitmap) == size:
        return bitmap
    return np.bitwise_xor.reduce(bitmap.reshape(-1, size), axis=0)


def _key(mixed: np.ndarray) -> str:
    """A name of the set: two sums of its elements, mixed in two ways, and its size."""
    twice = _mixed(mixed ^ _OF_PART)
    return f"{int(mixed.sum(dtype=np.uint64)):x},{int(twice.sum(dtype=np.uint64)):x},{len(mixed)}"


def _profiled(percent: int, n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch, texts in slices(batches):
            rows = []
            for elements in ngram_sets(texts, n):
                mixed = _mixed(elements)
                rows.append((
                    _key(mixed), len(elements), bands.keys(elements, mixed),
                    signature(elements).tobytes(),
                ))
            keys, sizes, tiles, bitmaps = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(keys, pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.array(tiles, pa.list_(pa.int64())),
                    pa.array(bitmaps, pa.binary()),
                ],
                ["doc_id", "key", "size", "tiles", "bitmap"],
            )

    return run


# --- bounds and intersections --------------------------------------------------------------


def least_common(m: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """The fewest common elements of linked sets of sizes ``m`` and ``n``."""
    return -(-(m + n) * percent // (100 + percent))


def most_common(
    m: np.ndarray, n: np.ndarray, one: np.ndarray, others: np.ndarray
) -> np.ndarray:
    """An upper bound of common elements from the bits that bitmaps of one width differ in."""
    differing = np.bitwise_count(one ^ others).sum(-1, dtype=np.int64)
    return (m + n - differing) // 2


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Elements in both sorted arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return 0
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


def _bitmap(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8)


def _possible(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of pairs with sizes and bitmaps those that may link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, m, n, left, right = batch.columns
            keep = []
            for x, y, one, other in zip(*(c.to_pylist() for c in (m, n, left, right)), strict=True):
                width = min(len(one), len(other))
                most = most_common(x, y, folded(_bitmap(one), width), folded(_bitmap(other), width))
                keep.append(bool(most >= least_common(x, y, percent)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    return run


def _linked(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of pairs with their sets those that link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = batch.columns
            keep = []
            for x, y in zip(left, right, strict=True):
                one, other = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                keep.append(bool(common(one, other) >= least_common(len(one), len(other), percent)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    return run


# --- tiles ------------------------------------------------------------------------------


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each value of the first column, which come together."""
    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        kept = (pa.concat_tables([kept, new]) if kept is not None else new).combine_chunks()
        edges = _starts(kept.column(0).to_numpy()).tolist()
        for x, y in zip(edges, edges[1:], strict=False):
            yield kept.slice(x, y - x)
        kept = kept.slice(edges[-1])
    if kept is not None:
        yield kept


def _met(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of the tiles with several sets, each with its block and the centre of its stretch.

    Rows (tile, size, tid) come sorted. A stretch holds ascending sizes that are alike. A tile of
    more than ``_HELD`` rows comes in pieces, whose stretches have centres of their own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        open_tile, upto = None, 0.0
        for batch in batches:
            new = [c.to_numpy() for c in batch.columns]
            kept = [np.concatenate(x) for x in zip(kept, new, strict=True)] if kept else new
            n = len(kept[0])
            last = int(np.searchsorted(kept[0], kept[0][-1])) if n else 0
            end = n if n - last > _HELD else last
            if end:
                found, cost = _met_rows([k[:end] for k in kept], open_tile, upto, percent)
                yield found
                open_tile, upto = (int(kept[0][end - 1]), cost) if end == n else (None, 0.0)
                kept = [k[end:] for k in kept]
        if kept and len(kept[0]):
            yield _met_rows(kept, open_tile, upto, percent)[0]

    return run


def _met_rows(
    rows: list[np.ndarray], open_tile: int | None, upto: float, percent: int
) -> tuple[pa.RecordBatch, float]:
    """Rows of ``_met``, and the cost of the last tile, whose first rows cost ``upto`` if it is open."""
    tile, size, tid = rows
    sizes = np.diff(np.append(_starts(tile), len(tile)))
    several = np.repeat(sizes > 1, sizes) | (tile == open_tile if open_tile is not None else False)
    tile, size, tid = tile[several], size[several], tid[several]
    starts = _starts(tile)
    ends = np.append(starts[1:], len(tile))
    cost = np.maximum(1 / _BLOCK, size * 8 / _BLOCK_BYTES)
    total = np.cumsum(cost)
    begin = total[starts] - cost[starts]
    if len(tile) and tile[0] == open_tile:
        begin[0] -= upto
    within = total - np.repeat(begin, ends - starts)
    order = _mixed(tid.astype(np.uint64))
    least = np.minimum.reduceat(order, starts) if len(starts) else order
    centre = np.repeat(tid[order == np.repeat(least, ends - starts)], ends - starts)
    # Few tiles hold sizes that are not all alike.
    for start, stop in zip(starts.tolist(), ends.tolist(), strict=True) if len(starts) else ():
        if size[stop - 1] <= linked_sizes(size[start], percent):
            continue
        while start < stop:
            top = linked_sizes(size[start], percent)
            end = start + int(np.searchsorted(size[start:stop], top, "right"))
            centre[start:end] = tid[start + order[start:end].argmin()]
            start = end
    columns = [tile, size, tid, np.floor(within - cost / 2).astype(np.int64), centre]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["tile", "size", "tid", "block", "centre"]
    ), float(within[-1]) if len(within) else 0.0


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    if not len(ordered):
        return np.empty(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])


def _find(of: dict[int, int], x: int) -> int:
    while (up := of.get(x, x)) != x:
        of[x] = of.get(up, up)
        x = up
    return x


def _bounded_pairs(
    sizes: np.ndarray, roots: np.ndarray, sides: np.ndarray, bitmaps: list[np.ndarray], percent: int,
    tids: np.ndarray, apart: list[list[int] | None],
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each place i of a block the places after it that may link, and by how much.

    Sets come by ascending size. Pairs are those of different roots and of different sides, or
    both of side 2, but for the ``tids`` that each is known to be apart from.
    """
    widths = np.array([len(b) for b in bitmaps])
    tops = np.searchsorted(sizes, linked_sizes(sizes, percent), "right")
    for width in np.unique(widths).tolist():
        start, end = np.searchsorted(widths, [width, width + 1]).tolist()
        # Larger sets have the same bitmap or a longer one.
        table = np.stack([folded(b, width) for b in bitmaps[start:int(tops[end - 1])]])
        table = table.view(np.uint64)
        for i in range(start, end):
            others = np.arange(i + 1, tops[i])
            fit = (sides[others] != sides[i]) | (sides[i] == 2)
            others = others[fit & (roots[others] != roots[i])]
            if not len(others):
                continue
            most = most_common(sizes[i], sizes[others], table[i - start], table[others - start])
            spare = most - least_common(sizes[i], sizes[others], percent)
            fit = spare >= 0
            if apart[i]:
                fit &= ~np.isin(tids[others], apart[i])
            if fit.any():
                yield i, others[fit], spare[fit]


def _signed(table: pa.Table, percent: int) -> tuple[list[np.ndarray], Iterator]:
    """The columns of a block's rows (work, size, tid, root, side, ...) and its pairs that may link."""
    columns = [c.to_numpy() for c in table.columns[:5]]
    _, size, tid, root, side = columns
    apart, bitmaps = table.column(5).to_pylist(), [_bitmap(b) for b in table.column(6).to_pylist()]
    return columns, _bounded_pairs(size, root, side, bitmaps, percent, tid, apart)


def _may_link(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a block whose signatures allow a link to another class there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            (work, size, tid, _, side), pairs = _signed(table, percent)
            met = np.zeros(len(tid), bool)
            for i, others, _spare in pairs:
                met[i] = True
                met[others] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[met], pa.int64()) for c in (work, size, tid, side)],
                ["work", "size", "tid", "side"],
            )

    return run


def _forest(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of the pairs that may link in a block the best that join all classes they could join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            (_, _, tid, root, _), pairs = _signed(table, percent)
            found = [
                (-spare, i, j) for i, others, spares in pairs
                for j, spare in zip(others.tolist(), spares.tolist(), strict=True)
            ]
            of: dict[int, int] = {}
            links = []
            for _, i, j in sorted(found):
                x, y = _find(of, int(root[i])), _find(of, int(root[j]))
                if x != y:
                    of[max(x, y)] = min(x, y)
                    links.append((int(tid[i]), int(tid[j])))
            yield _pairs_batch(links)

    return run


def _pairs_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(pairs.min(1), pa.int64()), pa.array(pairs.max(1), pa.int64())], ["a", "b"]
    )


def block_links(
    tids: np.ndarray, roots: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int,
    apart: list[list[int] | None] | None = None,
) -> list[tuple[int, int]]:
    """Links that join the classes of a block as far as any pair of it does."""
    sizes = np.array([len(s) for s in sets], np.int64)
    bitmaps = [signature(s) for s in sets]
    of: dict[int, int] = {}
    found = []
    apart = apart or [None] * len(sets)
    for i, others, spare in _bounded_pairs(sizes, roots, sides, bitmaps, percent, tids, apart):
        for j in others[np.argsort(-spare, kind="stable")].tolist():
            x, y = _find(of, int(roots[i])), _find(of, int(roots[j]))
            if x != y and common(sets[i], sets[j]) >= least_common(sizes[i], sizes[j], percent):
                of[max(x, y)] = min(x, y)
                found.append((int(tids[i]), int(tids[j])))
    return found


def _block_links(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            tid, root, side = (table.column(i).to_numpy() for i in (2, 3, 4))
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column(6)]
            apart = table.column(5).to_pylist()
            yield _pairs_batch(block_links(tid, root, side, sets, percent, apart))

    return run


# --- plan -------------------------------------------------------------------------------


def _dealt(rows: DataFrame, by: str, *order: str) -> DataFrame:
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(spread, by).sortWithinPartitions(by, *order)


class _Sets:
    """Where the sets of entries come from: the texts that stand for them, read again."""

    def __init__(self, documents: DataFrame, entries: DataFrame, n: int):
        self.documents, self.entries, self.n = documents, entries, n

    def of(self, tids: DataFrame) -> DataFrame:
        """(tid, elements) of the tids, elements as bytes of sorted 64-bit numbers."""
        wanted = saved(self.entries.join(tids.distinct(), "tid", "left_semi").select(
            "tid", F.col("key").alias("w_key"), F.col("doc_id").alias("w_id")
        ))
        ids = broadcast_if_few(wanted.select("w_id").distinct())
        n = self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in slices(batches):
                keys, sets = [], []
                for elements in ngram_sets(texts, n):
                    keys.append(_key(_mixed(elements)))
                    sets.append(elements.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(keys, pa.string()), pa.array(sets, pa.binary())],
                    ["doc_id", "key", "elements"],
                )

        of = self.documents.schema["doc_id"].dataType.simpleString()
        read = self.documents.join(ids, F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi")
        sets = read.mapInArrow(run, f"doc_id {of}, key string, elements binary")
        same = (F.col("key") == F.col("w_key")) & F.col("doc_id").eqNullSafe(F.col("w_id"))
        return saved(
            sets.join(broadcast_if_few(wanted), same)
            .select("tid", "elements").dropDuplicates(["tid"])
        )


def _pairs_linked(pairs: DataFrame, entries: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """The pairs (a, b) of tids, already written, that link."""
    signed = entries.select("tid", "size", "bitmap")
    bounded = saved(
        pairs.join(signed.toDF("a", "m", "left"), "a").join(signed.toDF("b", "n", "right"), "b")
        .select("a", "b", "m", "n", "left", "right")
        .mapInArrow(_possible(percent), "a long, b long")
    )
    ids = bounded.select(F.col("a").alias("tid")).unionByName(bounded.select(F.col("b").alias("tid")))
    whole = sets.of(ids)
    return saved(
        bounded.join(whole.toDF("a", "left"), "a").join(whole.toDF("b", "right"), "b")
        .select("a", "b", "left", "right")
        .mapInArrow(_linked(percent), "a long, b long")
    )


def _block_pairs(apart: DataFrame, percent: int) -> DataFrame:
    """(work, tile, low, high): each two blocks of a tile whose sizes allow a link."""
    blocks = saved(apart.groupBy("tile", "block").agg(
        F.min("size").alias("least"), F.max("size").alias("most")
    ))
    low = blocks.select("tile", F.col("block").alias("low"), F.col("most").alias("below"))
    high = blocks.select("tile", F.col("block").alias("high"), F.col("least").alias("above"))
    alike = (F.col("high") >= F.col("low")) & (F.col("above") * percent <= F.col("below") * 100)
    return low.join(high, "tile").where(alike).select(
        F.xxhash64("tile", "low", "high").alias("work"), "tile", "low", "high"
    )


def _star(roots: DataFrame) -> DataFrame:
    return roots.where("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b"))


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_few(roots), F.col("tid") == F.col("id"), "left").withColumn(
        "root", F.coalesce("root", "tid")
    ).drop("id")


def _joined_in_tiles(
    met: DataFrame, roots: DataFrame, entries: DataFrame, sets: _Sets, percent: int
) -> DataFrame:
    """The roots after all links between classes that the centres left apart."""
    rooted = _with_roots(met.drop("centre"), roots)
    several = rooted.groupBy("tile").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s")
    apart = saved(rooted.join(broadcast_if_few(saved(several.select("tile"))), "tile", "left_semi"))
    if apart.isEmpty():
        return roots
    pairs = saved(_block_pairs(apart, percent))
    work = apart.drop("root").join(pairs, "tile")
    here = ["work", "size", "tid"]
    sided = work.where("block = low and low = high").select(*here, F.lit(2).cast("bigint").alias("side"))
    for column, number in (("low", 0), ("high", 1)):
        one = work.where(f"block = {column} and low < high")
        sided = sided.unionByName(one.select(*here, F.lit(number).cast("bigint").alias("side")))
    struck = roots.select(F.col("id").alias("s_tid"), F.array("id").alias("apart")).limit(0)

    def dealt(rows: DataFrame, last: DataFrame) -> DataFrame:
        """Rows of blocks with their roots, what they are known to be apart from, and ``last``."""
        full = (
            _with_roots(rows, roots)
            .join(broadcast_if_few(struck), F.col("tid") == F.col("s_tid"), "left")
            .join(last, "tid")
            .select("work", "size", "tid", "root", "side", "apart", last.columns[1])
        )
        return _dealt(full, "work", "size", "tid")

    bitmaps, kept = entries.select("tid", "bitmap"), "work long, size long, tid long, side long"

    def near(rows: DataFrame) -> DataFrame:
        return saved(dealt(rows, bitmaps).mapInArrow(_may_link(percent), kept))

    def joined(rows: DataFrame) -> DataFrame:
        """The roots after the links that blocks of these rows find among their sets."""
        full = dealt(rows, sets.of(rows.select("tid")))
        links = saved(full.mapInArrow(_block_links(percent), "a long, b long").distinct())
        return saved(components(_star(roots).unionByName(links)))

    sided = near(sided)
    if sided.isEmpty():
        return roots
    roots = joined(saved(_largest(sided)))
    sided = near(sided)
    few = sided.groupBy("work").agg(F.count("*").alias("n")).where(F.col("n") <= _FEW)
    named = dealt(sided.join(few.select("work"), "work", "left_semi"), bitmaps)
    named = saved(named.mapInArrow(_forest(percent), "a long, b long").distinct())
    if not named.isEmpty():
        links = _pairs_linked(named, entries, sets, percent)
        refuted = named.join(links, ["a", "b"], "left_anti")
        refuted = refuted.unionByName(refuted.select(F.col("b").alias("a"), F.col("a").alias("b")))
        struck = saved(refuted.groupBy(F.col("a").alias("s_tid")).agg(F.collect_list("b").alias("apart")))
        roots = saved(components(_star(roots).unionByName(links)))
        sided = near(sided)
    return roots if sided.isEmpty() else joined(sided)


def _largest(sided: DataFrame) -> DataFrame:
    """Of each set's rows the one of the work with most sets."""
    sizes = sided.groupBy("work").agg(F.count("*").alias("n"))
    best = sided.join(sizes, "work").groupBy("tid").agg(F.max(F.struct("n", "work")).alias("best"))
    return sided.join(best.select("tid", "best.work"), ["tid", "work"], "left_semi").select(*sided.columns)


def jaccard_classes(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    percent: int = PERCENT,
    n: int = NGRAM,
) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    named = documents.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    of = named.schema["doc_id"].dataType.simpleString()
    profiles = saved(named.mapInArrow(
        _profiled(percent, n),
        f"doc_id {of}, key string, size long, tiles array<long>, bitmap binary",
    ))
    first = profiles.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    entries = saved(
        profiles.where("size > 0").dropDuplicates(["key"]).drop("doc_id").join(first, "key")
        .withColumn("tid", F.monotonically_increasing_id())
    )
    sets = _Sets(named, entries, n)
    tiles = entries.select(F.explode("tiles").alias("tile"), "size", "tid")
    met = saved(_dealt(tiles, "tile", "size", "tid").mapInArrow(
        _met(percent), "tile long, size long, tid long, block long, centre long"
    ))
    stars = saved(met.where("tid <> centre").select(
        F.least("tid", "centre").alias("a"), F.greatest("tid", "centre").alias("b")
    ).distinct())
    roots = saved(components(_pairs_linked(stars, entries, sets, percent)))
    roots = _joined_in_tiles(met, roots, entries, sets, percent)
    rooted = entries.join(roots, F.col("tid") == F.col("id"), "left").select(
        "key", "doc_id", F.coalesce("root", "tid").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = rooted.join(names, "root").select(F.col("key").alias("c_key"), "component_id")
    return profiles.join(classes, F.col("key") == F.col("c_key"), "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def oracle_sql(percent: int = PERCENT) -> str:
    """DuckDB SQL of the classes of ``documents`` by runs of three words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
      with recursive
      worded as (
        select doc_id, regexp_extract_all(
          translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') as words
        from documents),
      sets as (
        select doc_id, list_sort(list_distinct(case when len(words) = 0 then []
          when len(words) < {NGRAM} then [array_to_string(words, ' ')]
          else list_transform(range(1, len(words) - {NGRAM} + 2),
            lambda i: array_to_string(words[i:i + {NGRAM} - 1], ' ')) end)) as runs
        from worded),
      entries as (
        select runs, len(runs) as size, min(doc_id) as first from sets where len(runs) > 0 group by runs),
      elements as (select first, size, unnest(runs) as run from entries),
      common as (
        select a.first as a, b.first as b, any_value(a.size) as m, any_value(b.size) as n, count(*) as c
        from elements a join elements b on a.run = b.run and a.first < b.first
          and least(a.size, b.size) * 100 >= greatest(a.size, b.size) * {percent}
        group by 1, 2),
      links as (select a, b from common where 100 * c >= {percent} * (m + n - c)),
      both_ways as (select a, b from links union all select b, a from links),
      reached as (
        select first as a, first as b from entries
        union
        select r.a, l.b from reached r join both_ways l on r.b = l.a),
      named as (select a, min(b) as component_id from reached group by a)
      select s.doc_id, len(s.runs) as n_shingles, coalesce(n.component_id, s.doc_id) as component_id
      from sets s left join entries e using (runs) left join named n on e.first = n.a"""
