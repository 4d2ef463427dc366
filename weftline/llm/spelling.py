"""Spelling variants: frequent words at one edit, by dynamic programming over a sorted list.

Two words are near if one inserted, deleted or replaced code point makes one of the other. A
word's form is its near word of the largest count (of equal ones the smallest in code-point
order) if that count is at least ``RATIO`` times its own; following forms leads to its root.

Of two near words the shorter has ``size`` code points, and they share its first ``size // 2``
code points or its last, so each word is listed under those ends, for itself as the shorter and
as the longer one: lists of words that begin alike, forwards or backwards, each dealt to one
task. There a list is sorted, and neighbours share their first code points (their LCP).
A word is compared with the whole list at once: the row of its edit matrix for a beginning is
computed once for all words that have it, from the row of the beginning one code point
shorter, as a band of three cells (more than one off the diagonal is more than one edit).
If all three exceed one edit, the whole range of words with that beginning is skipped. The rows
of all words of a list are kept side by side in arrays, so a step is one pass over arrays.
A pair that begins and ends alike is taken from its forward list only.

A list of more than ``LIST`` words is cut by hash into blocks, and each pair of blocks is a
task; so no task holds more than two blocks. A task returns one row per word: how many
near words it met and the best of them. Counts of words are combined per task before
they are shuffled. Forms rise in count, so following them ends; roots are found by doubling, in
a few rounds.

``vocabulary`` takes runs of letters of whole texts. Null texts have none, a null doc_id reads as
empty text, repeated rows count as often as they are there, words of any length are
taken whole. Ties are settled as above. Empty tables give an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import broadcast_if_few, saved, text_of
from weftline.llm.word_ids import ranges_of

LETTERS = "[a-zÀ-ÿ]+"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: Words of a list, or of a block of a longer one.
LIST = 20_000
#: Words, and code points, that are worked on at once.
_ROWS, _CODES = 50_000, 8 << 20
_QUERIES = 1 << 16
_FAR = 2
_OUT = "word string, n_near long, near_n long, near string"


def vocabulary(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    cut_every: int | None = None,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """word, n: runs of letters, A-Z lower-cased, of a least length and count.

    With ``cut_every`` a run whose checksum with the document's id it divides loses one
    code point, at the place that the checksum says.
    """
    lowered = F.translate(text_of(text), ascii_uppercase, ascii_lowercase)
    runs = documents.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("word"),
    )
    word = F.col("word")
    if cut_every:
        h = F.crc32(F.concat("id", F.lit(":"), word).cast("binary"))
        place = (h % F.length(word)).cast("int")
        cut = F.concat(F.substr(word, F.lit(1), place), F.substr(word, place + 2))
        word = F.when(h % cut_every == 0, cut).otherwise(word)
    return (
        runs.select(word.alias("word"))
        .where(F.length("word") >= min_length)
        .groupBy("word").agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


# --- lists ----------------------------------------------------------------------------


class SortedList:
    """Different words of ``size`` or ``size + 1`` code points in order, and their shared beginnings."""

    def __init__(self, words: list[str], size: int):
        self.size = size
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) + np.uint32(1)
        self.codes = np.zeros((len(words), size + 1), np.uint32)
        self.codes[np.arange(size + 1) < self.lengths[:, None]] = codes
        same = self.codes[1:] == self.codes[:-1]
        self.lcp = np.concatenate([[-1], np.where(same.all(1), size + 1, same.argmin(1))])

    def _starts(self, depth: int) -> np.ndarray:
        """Where the ranges of words with the same first ``depth`` code points start."""
        return np.flatnonzero(self.lcp < depth)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of near words (a, b), a of ``size`` code points, that begin with the same half."""
        half = self.size // 2
        starts = self._starts(half)
        of = np.cumsum(self.lcp < half) - 1
        several = np.diff(np.append(starts, len(self.lcp)))[of] > 1
        queries = np.flatnonzero((self.lengths == self.size) & several)
        found = [
            self._search(queries[i:i + _QUERIES], of[queries[i:i + _QUERIES]])
            for i in range(0, len(queries), _QUERIES)
        ]
        return tuple(
            np.concatenate([np.empty(0, np.int64), *[f[i] for f in found]]) for i in (0, 1)
        )

    def _search(self, query: np.ndarray, range_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each query against the words of its range, by ever longer beginnings.

        The band of the row for a beginning of ``depth``: edits to the query's first
        ``depth - 1``, ``depth`` and ``depth + 1`` code points, ``_FAR`` for two or more.
        """
        size, half = self.size, self.size // 2
        before = np.full(len(query), 1 if half else _FAR, np.uint8)
        level, after = np.zeros(len(query), np.uint8), np.full(len(query), 1, np.uint8)
        starts = self._starts(half)
        out = []
        for depth in range(half, size + 1):
            deeper = self._starts(depth + 1)
            first = np.append(np.searchsorted(deeper, starts), len(deeper))
            count = (first[1:] - first[:-1])[range_]
            child = ranges_of(count, first[range_])
            each = np.repeat(np.arange(len(query)), count)
            code = self.codes[deeper[child], depth]
            query, before, level, after = query[each], before[each], level[each], after[each]
            if depth == size:
                # A word that ends here has the query's length.
                ended = (code == 0) & (level == 1)
                out.append((query[ended], deeper[child[ended]]))
            beyond = np.full(len(query), _FAR, np.uint8)

            def unlike(place: int, code=code, query=query) -> np.ndarray:
                return self.codes[query, place] != code

            shorter = np.minimum(before + unlike(depth - 1) if depth else beyond, level + 1)
            same = longer = beyond
            if depth < size:
                same = np.minimum(np.minimum(level + unlike(depth), after + 1), shorter + 1)
            if depth + 1 < size:
                longer = np.minimum(after + unlike(depth + 1), same + 1)
            keep = np.flatnonzero((np.minimum(np.minimum(shorter, same), longer) < _FAR) & (code != 0))
            query, range_ = query[keep], child[keep]
            before, level, after = (
                np.minimum(x[keep], _FAR).astype(np.uint8) for x in (shorter, same, longer)
            )
            starts = deeper
        # What is left are words one code point longer, whose last row is ``before``.
        longer = before == 1
        out.append((query[longer], starts[range_[longer]]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def near_words(
    words: list[str], counts: np.ndarray, halves: np.ndarray, size: int, backwards: bool
) -> pa.RecordBatch:
    """Per word of sorted lists the number of its near words and the best.

    ``words`` are sorted and turned round if ``backwards``. Pairs are those of different
    halves, or both of half 2.
    """
    a, b = SortedList(words, size).near()
    turned = [w[::-1] for w in words] if backwards else words
    keep = (halves[a] != halves[b]) | (halves[a] == 2)
    # A pair of one length is met from both sides.
    keep &= (a < b) | np.array([len(words[i]) > size for i in b.tolist()], bool)
    a, b = a[keep], b[keep]
    if backwards:
        half = size // 2
        keep = np.array([
            turned[i][:half] != turned[j][:half] for i, j in zip(a.tolist(), b.tolist(), strict=True)
        ], bool)
        a, b = a[keep], b[keep]
    word, near = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=turned.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[near], -counts[near], word))
    word, near = word[order], near[order]
    different, first, number = np.unique(word, return_index=True, return_counts=True)
    best = near[first]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([turned[i] for i in different.tolist()], pa.string()),
            pa.array(number, pa.int64()),
            pa.array(counts[best], pa.int64()),
            pa.array([turned[i] for i in best.tolist()], pa.string()),
        ],
        ["word", "n_near", "near_n", "near"],
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of the lists of a partition, which is sorted by list."""
    def of(rows: pa.Table) -> pa.RecordBatch:
        size, side = rows["size"][0].as_py(), rows["side"][0].as_py()
        return near_words(
            rows["ordered"].to_pylist(), rows["n"].to_numpy(), rows["half"].to_numpy(), size, side == 1
        )

    def cut(rows: pa.Table, last: bool) -> tuple[list[pa.Table], pa.Table]:
        """Runs of whole lists of like kind, and the rows that may go on in the next batch."""
        kinds = np.stack([rows[c].to_numpy() for c in ("size", "side", "low", "high")], axis=1)
        affix = rows["affix"]
        new_kind = np.any(kinds[1:] != kinds[:-1], axis=1)
        new_list = new_kind | pa.compute.not_equal(affix.slice(1), affix.slice(0, len(affix) - 1)).to_numpy()
        ends = np.append(np.flatnonzero(new_list) + 1, rows.num_rows if last else []).astype(np.int64)
        kind_ends = set((np.flatnonzero(new_kind) + 1).tolist())
        found, start, before = [], 0, 0
        for end in ends.tolist():
            most = min(_ROWS, _CODES // (int(kinds[start, 0]) + 1))
            if end - start > most and before > start:
                found.append(rows.slice(start, before - start))
                start = before
            if end in kind_ends or (last and end == rows.num_rows):
                found.append(rows.slice(start, end - start))
                start = end
            before = end
        return found, rows.slice(start)

    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        kept = (pa.concat_tables([kept, new]) if kept is not None else new).combine_chunks()
        if kept.num_rows < _ROWS:
            continue
        parts, kept = cut(kept, False)
        for part in parts:
            yield of(part)
    if kept is not None and kept.num_rows:
        for part in cut(kept, True)[0]:
            yield of(part)


def _lists(words: DataFrame) -> DataFrame:
    """Each word in its four lists, those of long lists in blocks."""
    own = F.length("word")
    sizes = F.filter(F.array(own, own - 1), lambda s: s >= 1)
    ordered = F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))
    half = F.call_function("div", F.col("size"), F.lit(2)).cast("int")
    rows = (
        words.select("word", "n", F.explode(sizes).alias("size"))
        .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("ordered", ordered)
        .withColumn("affix", F.substr("ordered", F.lit(1), half))
    )
    key = ["size", "side", "affix"]
    counts = rows.groupBy(*key).agg(F.count("*").alias("members"))
    long = saved(counts.where(F.col("members") > LIST).select(
        *key, F.ceil(F.col("members") / LIST).cast("int").alias("blocks")
    ))
    if long.isEmpty():
        return rows.withColumns({c: F.lit(v) for c, v in (("low", 0), ("high", 0), ("half", 2))})
    number = F.pmod(F.xxhash64("word"), "blocks").cast("int")
    return (
        rows.join(broadcast_if_few(long), key, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", number)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({
            "low": F.least("own", "other"), "high": F.greatest("own", "other"),
            "half": F.when(F.col("own") == F.col("other"), 2)
            .otherwise((F.col("own") < F.col("other")).cast("int")),
        })
    )


def nearest(words: DataFrame) -> DataFrame:
    """word, n_near, near_n, near of the words (word, n) that have near words."""
    spread = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = (
        _lists(words)
        .select("size", "side", "low", "high", "affix", "ordered", "half", "n")
        .repartition(spread, "size", "side", "low", "high", "affix")
        .sortWithinPartitions("size", "side", "low", "high", "ordered")
    )
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near")))
    return (
        lists.mapInArrow(_listed, _OUT)
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root of the (word, form) rows: the last word that forms lead to."""
    found = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        on = found.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        after = saved(found.join(on, F.col("root") == F.col("via"), "left"))
        if after.where(F.col("via").isNotNull()).isEmpty():
            return found
        found = after.select("word", F.coalesce("beyond", "root").alias("root"))


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of different words (word, n)."""
    words = saved(words.select("word", F.col("n").cast("bigint").alias("n")))
    near = nearest(words).withColumnRenamed("word", "w")
    formed: Column = F.col("near_n") >= ratio * F.col("n")
    rows = saved(words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n"),
    ))
    root = roots(rows.where(F.col("form").isNotNull())).withColumnRenamed("word", "w")
    return rows.join(root, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def oracle_sql(cut_every: int = 199) -> str:
    """DuckDB SQL of the registered query over ``documents``.

    The checksum runs over the UTF-8 bytes with a table of 256 entries made by its rule.
    """
    polynomial = 0xEDB88320
    return f"""
      with recursive
      crc_table as (
        select list(list_reduce(list_prepend(i, range(8)), lambda c, k:
          case when c % 2 = 1 then xor(c // 2, {polynomial}) else c // 2 end) order by i) as t
        from range(256) r(i)),
      runs as (
        select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(
          translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '{LETTERS}')) as run
        from documents),
      counted as (select id, run, count(*) as n from runs group by all),
      hashed as (
        select run, n, xor(4294967295, list_reduce(
          list_prepend(4294967295::bigint, flatten(list_transform(
            string_split(id || ':' || run, ''), lambda x: case when unicode(x) < 128
              then [unicode(x)::bigint] else [195, unicode(x)::bigint - 64] end))),
          lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) as h
        from counted, crc_table),
      words as (
        select case when h % {cut_every} = 0
            then run[:(h % length(run))::int] || run[(h % length(run) + 2)::int:]
            else run end as word,
          sum(n)::bigint as n
        from hashed group by 1),
      vocabulary as (
        select word, n, length(word) as size from words
        where length(word) >= {MIN_LENGTH} and n >= {MIN_COUNT}),
      cut as (
        select word, n, size, i, word[:i - 1] || word[i + 1:] as rest
        from vocabulary, range(1, size + 1) r(i)),
      near as (
        select a.word, b.word as other, b.n from cut a join cut b
          on a.rest = b.rest and a.i = b.i and a.word <> b.word
        union
        select a.word, b.word, b.n from cut a join vocabulary b on a.rest = b.word
        union
        select b.word, a.word, a.n from cut a join vocabulary b on a.rest = b.word),
      best as (
        select word, count(*) as n_near, max(n) as near_n from near group by word),
      formed as (
        select v.word, v.n, coalesce(b.n_near, 0) as n_near,
          case when b.near_n >= {RATIO} * v.n then b.near_n end as form_n,
          case when b.near_n >= {RATIO} * v.n then (
            select min(other) from near x where x.word = v.word and x.n = b.near_n) end as form
        from vocabulary v left join best b using (word)),
      followed as (
        select word, word as root from formed
        union all
        select f.word, g.form from followed f join formed g on f.root = g.word
        where g.form is not null)
      select f.word, f.form, r.root, f.n, f.n_near, f.form_n
      from formed f join (
        select word, root from followed join (
          select word as last from formed where form is null) on root = last) r using (word)"""
