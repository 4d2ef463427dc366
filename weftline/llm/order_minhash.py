"""Near-duplicates by Order MinHash, verified by banded alignment.

Texts are sequences of words. Two texts are linked if an alignment pairs at least
``SIMILARITY`` of the longer one's words with equal words in the same order. Classes are
the connected components of the links; equal texts are in one class from the start.

Candidates: the k-mers of a text are its runs of ``LENGTHS`` words, fewer in short texts, each
labelled with how often it occurred before in the text; a text that a longer one of the next
class may be near has the sketches of both classes. Each of ``SKETCHES`` hash functions picks the two least
labelled k-mers and keeps them in text order, so a sketch agrees if the texts share both
and in the same order, which is sensitive to edits and not to which words a text has.
Texts with an equal sketch meet in a bucket, a run of a sorted partition. First each text
is compared with the centre of its bucket, among those of like length, which links most of
a large group at once. Then the buckets that still hold several classes are gone through
again, for pairs of different classes: up to ``ALL_PAIRS`` texts give all such pairs of like
length. A larger bucket first gives each text two partners, the middle of its stretch and its
neighbour, which is linear. Buckets that still hold several classes are then gone through in
full, block of ``_TEXTS`` (or ``_WORDS`` of theirs) against block: a table of word counts of each text bounds the words that
two can have in common from above, and the pairs of different classes which the bound allows
are verified where they meet, the best first, as classes grow with each link. So a block
gives a link for each class that it joins, not its pairs; the time for unlike texts of
one bucket does grow with the square of their number. Nothing is capped or dropped. The chance that two
texts which share the part j of their k-mers have no equal sketch is at most about
``(1 - j**2) ** SKETCHES``: 2e-5 for j = 0.34, which long texts with two words in ten replaced
have, less for short texts and fewer changes. As many words left out and put in at other places
break more k-mers: j is about 0.18, the chance 0.06. The README has measured shares.

Verification: the longest common subsequence of the words by bits of a long number, with
matches only in the band of diagonals that an alignment of enough words can reach.
Words in common bound it first. Texts are read whole.

Null texts read as empty; empty
texts are copies of each other. Repeated rows are copies. The class of a document is named by the least
doc_id in it, null if all are null. An empty table gives an empty result. Other columns pass
through ``deduplicated``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import broadcast_if_few, freeing, saved, tasks_for, text_of
from weftline.llm.word_ids import chunks

#: Words of a k-mer in texts of up to so many words; without bound for the last.
LENGTHS = ((16, 1), (60, 2), (None, 3))
SIMILARITY = 0.8
_ROUNDING = 1e-9
SKETCHES = 88
#: Buckets of up to so many texts give all pairs.
ALL_PAIRS = 16
#: Texts of a bucket that are held at once.
_BLOCK = 1 << 16
#: Texts of a large bucket, and words of theirs, on one side of a comparison of word counts.
_TEXTS = 2048
_WORDS = 1 << 20
_LINKS_A_TASK = 50_000
#: Texts whose rows, or pairs of texts to verify, are worth a task that writes a file.
_TEXTS_A_TASK = 4_000
_SEED = 20240607

_random = np.random.default_rng(_SEED)
_OF_BYTE = _random.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_OF_PLACE = _random.integers(1, 1 << 63, LENGTHS[-1][1], np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _random.integers(1, 1 << 63, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(1, 1 << 63, SKETCHES, np.uint64)
_BASE = 0x5851F42D4C957F2D
_OCCURRENCE, _FIRST, _SECOND = (np.uint64(x) for x in _random.integers(1, 1 << 63, 3) * 2 + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


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


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and where each starts; words end at ASCII white space."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], data > 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[data] * up[:-1])])
    return _mixed((sums[ends] - sums[starts]) * down[starts]), starts


def _labelled(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words with their occurrence numbers."""
    n = max(len(words) - k + 1, 1)
    runs = np.zeros(n, np.uint64)
    for i in range(min(k, len(words))):
        runs += words[i:i + n] * _OF_PLACE[i]
    runs = _mixed(runs)
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if not new.all():
        place = np.arange(n)
        before = place - np.maximum.accumulate(np.where(new, place, 0))
        runs[order] += before.astype(np.uint64) * _OCCURRENCE
    return runs


def run_lengths(n: int) -> list[int]:
    """Words of the k-mers of a text of ``n`` words: its class, and the next if near ones may be in it."""
    longest = n / SIMILARITY + _ROUNDING
    found, least = [], 0
    for most, k in LENGTHS:
        if (most is None or n <= most) and longest > least:
            found.append(k)
        least = most
        if most is None or longest < most + 1:
            break
    return found


def sketch(words: np.ndarray) -> np.ndarray:
    """Numbers of the classes of its length, see ``run_lengths``."""
    return np.concatenate([np.empty(0, np.int64), *[
        _sketch(words, k) for k in run_lengths(len(words)) if len(words)
    ]])


def _sketch(words: np.ndarray, k: int) -> np.ndarray:
    """One number per hash function from the two least k-mers in text order."""
    kmers = _labelled(words, k)
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, (1 << 21) // len(kmers))
    for a in range(0, SKETCHES, step):
        row = np.arange(len(_FACTORS[a:a + step]))
        drawn = kmers[None, :] * _FACTORS[a:a + step, None] + _SHIFTS[a:a + step, None]
        drawn ^= drawn >> np.uint64(32)
        drawn *= np.uint64(0x9E3779B97F4A7C15)
        first = drawn.argmin(1)
        drawn[row, first] = np.iinfo(np.uint64).max
        second = drawn.argmin(1)
        early, late = np.minimum(first, second), np.maximum(first, second)
        out[a:a + step] = kmers[early] * _FIRST + kmers[late] * _SECOND
    return _mixed(out + _SHIFTS).view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        raw = [t.encode() for t in texts]
        hashes, starts = word_hashes(b" ".join(raw))
        ends = np.cumsum([len(r) + 1 for r in raw])
        cuts = [0, *np.searchsorted(starts, ends).tolist()]
        sketches = [sketch(hashes[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(batch.schema.get_field_index(n)) for n in names],
                pa.array(np.diff(cuts), pa.int64()),
                pa.array(sketches, pa.list_(pa.int64())),
            ],
            [*names, "n_words", "sketch"],
        )


# --- candidates --------------------------------------------------------------------


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether lengths allow the similarity."""
    return np.minimum(a, b) >= SIMILARITY * np.maximum(a, b) - _ROUNDING


def _stretches(sizes: np.ndarray) -> np.ndarray:
    """Bounds of stretches of ascending sizes in which all are alike."""
    bounds = [0]
    while bounds[-1] < len(sizes):
        top = sizes[bounds[-1]] / SIMILARITY + _ROUNDING
        bounds.append(int(np.searchsorted(sizes, top, "right")))
    return np.array(bounds)


def centres(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text of a bucket the one of its stretch that comes first in one order of all.

    As the order is the same everywhere, the buckets of a group mostly agree on it.
    """
    order = _mixed(ids.astype(np.uint64))
    out = np.empty(len(ids), np.int64)
    bounds = _stretches(sizes)
    for a, b in zip(bounds, bounds[1:], strict=False):
        out[a:b] = ids[a + order[a:b].argmin()]
    return out


def bucket_pairs(
    ids: np.ndarray, sizes: np.ndarray, roots: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one bucket with different roots; texts come by ascending size."""
    n = len(ids)
    if n <= ALL_PAIRS:
        left, right = np.triu_indices(n, 1)
    else:
        bounds = _stretches(sizes)
        middles = (bounds[:-1] + bounds[1:] - 1) // 2
        every = np.arange(n)
        left = np.concatenate([np.repeat(middles, np.diff(bounds)), every[:-1], middles[:-1]])
        right = np.concatenate([every, every[1:], middles[1:]])
    keep = (roots[left] != roots[right]) & _alike(sizes[left], sizes[right])
    a, b = ids[left[keep]], ids[right[keep]]
    return np.minimum(a, b), np.maximum(a, b)


def _by_bucket(
    batches: Iterator[pa.RecordBatch], of: Callable[..., list[np.ndarray]], names: list[str]
) -> Iterator[pa.RecordBatch]:
    """``of`` applied to the rows of each bucket that has several.

    Rows come sorted by bucket and size; a bucket may reach over batches. An endless bucket is
    worked off in blocks that share one text.
    """
    def applied(rows: list[np.ndarray]) -> pa.RecordBatch:
        edges = np.flatnonzero(np.diff(rows[0])) + 1
        bounds = np.concatenate([[0], edges, [len(rows[0])]])
        several = np.flatnonzero(np.diff(bounds) > 1)
        found = [
            of(*(r[a:b] for r in rows))
            for a, b in zip(bounds[several].tolist(), bounds[several + 1].tolist(), strict=True)
        ]
        columns = [
            np.concatenate(c) for c in zip(*found, strict=True)
        ] or [np.empty(0, np.int64)] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    kept: list[np.ndarray] = []
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        kept = [np.concatenate(x) for x in zip(kept, new, strict=True)] if kept else new
        n = len(kept[0])
        last = int(np.searchsorted(kept[0], kept[0][-1])) if n else 0
        if n - last > _BLOCK:
            yield applied(kept)
            last = n - 1
        elif last:
            yield applied([k[:last] for k in kept])
        kept = [k[last:] for k in kept]
    if kept:
        yield applied(kept)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def of(buckets, sizes, ids):
        return [buckets, sizes, ids, centres(ids, sizes)]

    return _by_bucket(batches, of, ["bucket", "n_words", "tid", "centre"])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def of(_, sizes, ids, roots):
        return list(bucket_pairs(ids, sizes, roots))

    return _by_bucket(batches, of, ["a", "b"])


def word_counts(words: np.ndarray) -> np.ndarray:
    """How many words have each hash, of two to four times as many, at most 255."""
    bins = 1 << max(5, (2 * len(words) - 1).bit_length())
    places = (words & np.uint64(bins - 1)).astype(np.int64)
    return np.minimum(np.bincount(places, minlength=bins), 255).astype(np.uint8)


def _folded(counts: np.ndarray, bins: int) -> np.ndarray:
    if len(counts) == bins:
        return counts
    parts = counts.reshape(-1, bins).sum(0, dtype=np.int64)
    return np.minimum(parts, 255).astype(np.uint8)


# --- verification ---------------------------------------------------------------------


def common_words(a: list[str], b: list[str], least: int) -> int:
    """Length of the longest common subsequence if it is at least ``least``, else less."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    least -= head + tail
    if not a or not b:
        return head + tail
    # Matches farther off the diagonal leave too few words to pair.
    below, above = len(a) - least, len(b) - least
    if below < 0 or above < 0:
        return head + tail
    places: dict[str, int] = {}
    for j, word in enumerate(b):
        places[word] = places.get(word, 0) | 1 << j
    full = (1 << len(b)) - 1
    band = (1 << (below + above + 1)) - 1
    state = full
    for i, word in enumerate(a):
        match = places.get(word, 0)
        if match:
            shift = i - below
            match &= band << shift if shift >= 0 else band >> -shift
            hit = state & match
            if hit:
                state = ((state + hit) | (state - hit)) & full
    return head + tail + len(b) - state.bit_count()


def linked(a: list[str], b: list[str]) -> bool:
    """Whether the alignment pairs enough words of the longer text."""
    longer = max(len(a), len(b))
    least = math.ceil(SIMILARITY * longer - _ROUNDING)
    if min(len(a), len(b)) < least:
        return False
    if sum((Counter(a) & Counter(b)).values()) < least:
        return False
    return common_words(a, b, least) >= least


def _words(text: str) -> list[bytes]:
    """As ``word_hashes`` cuts them."""
    return text.encode().translate(_SPACES).split(b" ")


_SPACES = bytes(32 if i < 32 else i for i in range(256))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, left, right = batch.columns
        known: tuple[str | None, list[bytes]] = (None, [])
        keep = []
        for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True):
            if x != known[0]:
                known = x, [w for w in _words(x) if w]
            keep.append(linked(known[1], [w for w in _words(y) if w]))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])


def _find(of: dict[int, int], x: int) -> int:
    while (up := of.get(x, x)) != x:
        of[x] = of.get(up, up)
        x = up
    return x


def block_links(
    ids: np.ndarray, sizes: np.ndarray, roots: np.ndarray, sides: np.ndarray, texts: list[str]
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the classes of a block as far as any pair of it does.

    Texts come by ascending size. Pairs are those of different sides, or both of side 2.
    """
    words = [[w for w in _words(t) if w] for t in texts]
    counts = [word_counts(word_hashes(t.encode())[0]) for t in texts]
    of: dict[int, int] = {}
    roots, found = roots.copy(), []
    bins = np.array([len(c) for c in counts])
    tops = np.searchsorted(sizes, sizes / SIMILARITY + _ROUNDING, "right")
    least = np.ceil(SIMILARITY * sizes - _ROUNDING).astype(np.int64)
    for m in np.unique(bins).tolist():
        start, end = np.searchsorted(bins, [m, m + 1]).tolist()
        table = np.stack([_folded(c, m) for c in counts[start:int(tops[end - 1])]])
        # What a count of 255 leaves out may be in common, too.
        beyond = sizes[start:start + len(table)] - table.sum(1, dtype=np.int64)
        for i in range(start, end):
            others = np.arange(i + 1, tops[i])
            fit = (sides[others] != sides[i]) | (sides[i] == 2)
            others = others[fit & (roots[others] != roots[i])]
            if not len(others):
                continue
            rows = others - start
            common = np.minimum(table[i - start], table[rows]).sum(1, dtype=np.int64)
            spare = common + np.minimum(beyond[i - start], beyond[rows]) - least[others]
            others, spare = others[spare >= 0], spare[spare >= 0]
            joined = False
            for j in others[np.argsort(-spare, kind="stable")].tolist():
                x, y = _find(of, int(roots[i])), _find(of, int(roots[j]))
                if x != y and common_words(words[i], words[j], int(least[j])) >= least[j]:
                    of[max(x, y)], joined = min(x, y), True
                    found.append((int(ids[i]), int(ids[j])))
            if joined:
                different, at = np.unique(roots, return_inverse=True)
                roots = np.array([_find(of, r) for r in different.tolist()], np.int64)[at]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs.min(1), pairs.max(1)


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block; rows come sorted by block and size."""
    def of(columns: list[np.ndarray], texts: list[str]) -> pa.RecordBatch:
        a, b = block_links(columns[2], columns[1], *columns[3:], texts)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    kept: list[np.ndarray] = []
    texts: list[str] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]
        kept = [np.concatenate(x) for x in zip(kept, new, strict=True)] if kept else new
        texts += batch.columns[-1].to_pylist()
        edges = [0, *(np.flatnonzero(np.diff(kept[0])) + 1).tolist()]
        for x, y in zip(edges, edges[1:], strict=False):
            yield of([k[x:y] for k in kept], texts[x:y])
        kept, texts = [k[edges[-1]:] for k in kept], texts[edges[-1]:]
    if texts:
        yield of(kept, texts)


# --- classes ---------------------------------------------------------------------------


def components(links: DataFrame, tasks: int | None = None) -> DataFrame:
    """(id, root) of every id in the (a, b) links; root is the least id of its component.

    Alternating large and small stars: every id is linked to the least of its
    neighbourhood until each component is a star. Each round is written, so lineage stays
    short; what comes to the driver is one count and one checksum a round. A round runs in
    tasks of at least ``_LINKS_A_TASK`` links, as a small graph is not worth more; ``tasks``
    bounds those that write the links themselves.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = saved(edges.distinct(), tasks)
    before, tasks = None, max(8, edges.count() // _LINKS_A_TASK)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")
        )
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")
        large = large.where("a <> b").coalesce(tasks).distinct().coalesce(tasks)
        # Now each id points up to lesser ones: the least of them takes the others.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        small = small.select(F.col("m").alias("a"), "b").unionByName(
            small.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        )
        edges = saved(small.where("a <> b").coalesce(tasks).distinct().coalesce(tasks))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("id"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct().coalesce(tasks)
    )


def _keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.md5(text_of(text)).alias("key"), text_of(text).alias("text")
    )


def _dealt(rows: DataFrame) -> DataFrame:
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(spread, "bucket").sortWithinPartitions("bucket", "n_words", "tid")


def _whole(ids: DataFrame, texts: DataFrame, documents: DataFrame, tasks: int) -> DataFrame:
    """(tid, text) of the tids, written; ``documents`` are (doc_id, key, text)."""
    wanted = broadcast_if_few(
        saved(texts.select("tid", "key", "doc_id").join(ids.distinct(), "tid", "left_semi"), tasks)
    )
    same = (F.col("d.key") == F.col("w.key")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
    whole = (
        documents.alias("d").join(wanted.alias("w"), same)
        .select("tid", "text")
        .dropDuplicates(["tid"])
    )
    return saved(whole, tasks)


def _links(pairs: DataFrame, texts: DataFrame, documents: DataFrame, tasks: int) -> DataFrame:
    """The pairs of tids, already written, whose texts are near."""
    ids = pairs.select(F.col("a").alias("tid")).unionByName(pairs.select(F.col("b").alias("tid")))
    whole = _whole(ids, texts, documents, tasks)
    compared = (
        pairs.join(whole.select(F.col("tid").alias("a"), F.col("text").alias("left")), "a")
        .join(whole.select(F.col("tid").alias("b"), F.col("text").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    verified = compared.mapInArrow(freeing(_verified), "a long, b long")
    return saved(verified, tasks_for(pairs.sparkSession, pairs.count(), _TEXTS_A_TASK))


def _rooted(met: DataFrame, roots: DataFrame) -> DataFrame:
    return met.join(roots, F.col("tid") == F.col("id"), "left").select(
        "bucket", "n_words", "tid", F.coalesce("root", "tid").alias("root")
    )


def _stars(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("root").alias("a"), F.col("id").alias("b"))


def _rest_of_large_buckets(
    met: DataFrame, links: DataFrame, texts: DataFrame, documents: DataFrame, tasks: int
) -> DataFrame:
    """``links`` and those between texts of large buckets that they leave apart."""
    apart = _rooted(met, broadcast_if_few(saved(components(links, tasks)))).distinct()
    large = (
        apart.groupBy("bucket")
        .agg(
            F.count("*").alias("n"), F.sum("n_words").alias("words"),
            F.min("root").alias("r"), F.max("root").alias("s"),
        )
        .where((F.col("n") > ALL_PAIRS) & (F.col("r") < F.col("s")))
        .select("bucket", F.ceil(F.greatest(
            F.col("n") / _TEXTS, F.col("words") / _WORDS
        )).cast("int").alias("blocks"))
    )
    rows = saved(apart.join(broadcast_if_few(saved(large, tasks)), "bucket"), tasks)
    if rows.isEmpty():
        return links
    whole = _whole(rows.select("tid"), texts, documents, tasks)
    own = F.pmod(F.xxhash64("tid"), "blocks").cast("int")
    dealt = rows.select(
        "*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("block"),
        "n_words", "tid", "root",
        F.when(F.col("own") == F.col("other"), 2)
        .otherwise((F.col("own") < F.col("other")).cast("int")).alias("side"),
    )
    spread = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = (
        dealt.join(whole, "tid")
        .select("block", "n_words", "tid", "root", "side", "text")
        .repartition(spread, "block")
        .sortWithinPartitions("block", "n_words", "tid")
        .mapInArrow(freeing(_in_blocks), "a long, b long")
        .distinct()
    )
    return links.unionByName(saved(more, tasks))


def _tasks(documents: DataFrame) -> int:
    return tasks_for(documents.sparkSession, documents.count(), _TEXTS_A_TASK)


def near_links(
    documents: DataFrame, doc_id: str, text: str, tasks: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, key) of all documents, (tid, key, doc_id) of different texts, (a, b) links.

    Links between the texts of a class that the first round found are those to its root.
    """
    of = documents.schema[doc_id].dataType.simpleString()
    keyed = _keyed(documents, doc_id, text)
    rows = saved(
        keyed.mapInArrow(
            freeing(_sketched), f"doc_id {of}, key string, n_words long, sketch array<long>"
        )
    )
    first = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    # Equal texts have equal sketches: one row of each key stands for all.
    texts = saved(
        rows.dropDuplicates(["key"]).drop("doc_id").join(first, "key")
        .withColumn("tid", F.monotonically_increasing_id()),
        tasks,
    )
    buckets = texts.select(F.explode("sketch").alias("bucket"), "n_words", "tid")
    met = saved(
        _dealt(buckets).mapInArrow(freeing(_met), "bucket long, n_words long, tid long, centre long"), tasks
    )
    stars = met.where("tid <> centre").select(
        F.least("tid", "centre").alias("a"), F.greatest("tid", "centre").alias("b")
    )
    stars = saved(stars.distinct(), tasks)
    links = _links(stars, texts, keyed, tasks)
    roots = broadcast_if_few(saved(components(links, tasks)))
    apart = _rooted(met, roots)
    pairs = _dealt(apart).mapInArrow(freeing(_paired), "a long, b long").distinct()
    pairs = saved(pairs.join(stars, ["a", "b"], "left_anti"), tasks)
    more = _links(pairs, texts, keyed, tasks)
    found = _rest_of_large_buckets(met, _stars(roots).unionByName(more), texts, keyed, tasks)
    return rows.select("doc_id", "key"), texts.select("tid", "key", "doc_id"), found


def _classes(
    documents: DataFrame, doc_id: str, text: str, tasks: int
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key) of all documents, and (key, class_id) of all keys."""
    rows, texts, links = near_links(documents, doc_id, text, tasks)
    roots = components(links, tasks)
    rooted = texts.join(roots, texts["tid"] == roots["id"], "left").select(
        "key", "doc_id", F.coalesce("root", "tid").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    keys = rooted.join(names, "root").select(F.col("key").alias("c_key"), "class_id")
    return rows, saved(keys, tasks)


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and class_id of every document."""
    rows, keys = _classes(documents, doc_id, text, _tasks(documents))
    return rows.join(keys, rows["key"] == keys["c_key"]).select("doc_id", "class_id")


def deduplicated(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, that of the least doc_id; same columns.

    Of rows with that doc_id in the class, the least text by hash stays, and of
    rows equal in both any one.
    """
    tasks = _tasks(documents)
    rows, keys = _classes(documents, doc_id, text, tasks)
    members = rows.groupBy("key", "doc_id").agg(F.count("*").alias("n")).join(
        keys, F.col("key") == F.col("c_key")
    ).select("key", "doc_id", "n", "class_id", F.xxhash64("key", "class_id").alias("order"))
    members = saved(members, tasks)
    # A class without any id is known by its keys alone.
    group = F.when(F.col("class_id").isNull(), F.col("key"))
    first = members.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy(
        "class_id", group.alias("group")
    ).agg(F.min("key").alias("first_key"))
    kept = first.select(F.col("first_key").alias("k_key"), F.col("class_id").alias("k_doc"))
    removed = members.join(
        kept,
        (F.col("key") == F.col("k_key")) & F.col("doc_id").eqNullSafe(F.col("k_doc")),
        "left_anti",
    ).select(F.col("key").alias("r_key"), F.col("doc_id").alias("r_doc"))
    repeated = members.join(
        kept,
        (F.col("key") == F.col("k_key")) & F.col("doc_id").eqNullSafe(F.col("k_doc")),
        "left_semi",
    ).where("n > 1").select(F.col("key").alias("r_key"), F.col("doc_id").alias("r_doc"))

    def same(other: DataFrame):
        return (key == other["r_key"]) & documents[doc_id].eqNullSafe(other["r_doc"])

    key = F.md5(text_of(text))
    removed, repeated = (broadcast_if_few(saved(x, tasks)) for x in (removed, repeated))
    left = documents.join(removed, same(removed), "left_anti")
    once = left.join(repeated, same(repeated), "left_anti")
    several = left.join(repeated, same(repeated), "left_semi").dropDuplicates([doc_id, text])
    return once.unionByName(several)
