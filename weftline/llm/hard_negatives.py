"""Hard negatives by Fagin's threshold algorithm.

Vectors become integers, ``floor(256 * x)``; a row's score for an anchor is their integer
inner product. An anchor's positives are its first rows of the same label, and the
negatives of a positive its first rows of other labels whose score lies in a share of the
positive's: ``low * positive <= 100 * score <= high * positive``. First means the higher score,
and of equal scores the smaller id.

Rows are cut in blocks. In a block each dimension has a list of the candidates sorted by their
value. An anchor reads the list of a dimension from its high end where its own value is positive
and from its low end where it is negative, all lists to the same depth, which grows. Each
candidate met is scored in full by random access. What no list has shown yet scores at
most the threshold, the sum over the dimensions of the anchor's value times the last value
read. The anchor stops once the threshold is strictly below the k-th best score of each of its
windows (below the window's low end, if fewer have been met): then no candidate left can
enter one, nor tie. Positives are searched so in lists of their own label, with one window
without bounds, and then negatives in lists of all labels, with one window per positive.

Each task searches one block for one block of anchors and returns one row per anchor with
the few members of its windows. Equal rows (same id, label and vector) are searched once
with their number and repeated in the result, so a row that is repeated often is one entry.

Rows with a null id, label or vector, or with a component that is null or not finite, take
no part. Rows with an anchor's id are its own: neither positives nor negatives of it. An id that
repeats with another label or vector is several anchors, each with its own rows. Vectors are
compared with those of the same length. Repeated rows count as often as they are there. A
window with fewer rows returns them all; an anchor without positives has no row. Empty
tables give an empty result. Other columns are not read. Scores must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import saved
from weftline.llm.topk import SCALE, integer_vector, usable

#: Vectors in a block of lists and anchors in a block of anchors, on average.
BLOCK = 2048
ANCHOR_BLOCK = 4096
#: Entries of each list that are read first; each further step reads twice as many.
FIRST_DEPTH = 8
POSITIVES = 5
NEGATIVES = 3
#: Shares of the positive's score, in percent, between which a negative's lies.
LOW, HIGH = 50, 95
_FOUND = "anchor long, found array<struct<score:bigint,vec_id:bigint,copies:bigint>>"
_LEAST, _MOST = -(1 << 62), 1 << 62


class SortedLists:
    """One list of candidates per dimension, by ascending value."""

    def __init__(self, values: np.ndarray):
        self.values = values
        columns = np.ascontiguousarray(values.T)
        self.order = np.argsort(columns, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(columns, self.order, axis=1)

    def search(
        self, anchor: np.ndarray, fit: np.ndarray, windows: list[tuple[int, int]], k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Candidates met and their scores, when no window can gain or tie a member.

        Those in ``fit`` only; each window is (least, most) score.
        """
        n = len(self.values)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.full(n, not len(up) and not len(down))
        scores = np.zeros(n, np.int64)
        depth, step = 0, FIRST_DEPTH
        while depth < n and not met.all():
            end = min(n, depth + step)
            new = np.zeros(n, bool)
            new[self.order[up, n - end:n - depth].ravel()] = True
            new[self.order[down, depth:end].ravel()] = True
            new &= ~met
            fresh = np.flatnonzero(new)
            scores[fresh] = self.values[fresh] @ anchor
            met |= new
            threshold = int(
                anchor[up] @ self.sorted[up, n - end] + anchor[down] @ self.sorted[down, end - 1]
            )
            depth, step = end, 2 * step
            if _closed(scores[met & fit], threshold, windows, k):
                break
        found = np.flatnonzero(met & fit)
        return found, scores[found]


def _closed(scores: np.ndarray, threshold: int, windows: list[tuple[int, int]], k: int) -> bool:
    """Whether scores up to the threshold change no window."""
    for least, most in windows:
        if threshold < least:
            continue
        inside = scores[(scores >= least) & (scores <= most)]
        if len(inside) < k or threshold >= np.partition(inside, -k)[-k]:
            return False
    return True


def _members(
    ids: np.ndarray, scores: np.ndarray, windows: list[tuple[int, int]], k: int
) -> np.ndarray:
    """Places of the first k of each window, each place once."""
    order = np.lexsort((ids, -scores))
    ordered = scores[order]
    return order[np.unique(np.concatenate([
        np.flatnonzero((ordered >= least) & (ordered <= most))[:k] for least, most in windows
    ]))]


def _searched(k: int, same_label: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The search of one block of rows for one block of anchors."""
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, list]] = []
        if len(rows) and len(anchors):
            ids, copies = rows["vec_id"].to_numpy(), rows["copies"].to_numpy()
            labels = rows["label"].to_numpy()
            values = np.stack(rows["vector"].to_numpy())
            parts: dict[object, tuple[np.ndarray, SortedLists]] = {}
            if same_label:
                for label in set(anchors["label"]):
                    own = np.flatnonzero(labels == label)
                    parts[label] = own, SortedLists(values[own])
            else:
                parts[None] = np.arange(len(ids)), SortedLists(values)
            for number, vec_id, label, vector, windows in zip(
                *(anchors[c] for c in ("anchor", "vec_id", "label", "vector", "windows")),
                strict=True,
            ):
                own, lists = parts[label if same_label else None]
                fit = ids[own] != vec_id
                if not same_label:
                    fit &= labels != label
                spans = [(w["least"], w["most"]) for w in windows]
                found, scores = lists.search(vector, fit, spans, k)
                places = own[found]
                best = _members(ids[places], scores, spans, k)
                if len(best):
                    at = places[best]
                    out.append((number, [
                        {"score": s, "vec_id": i, "copies": c} for s, i, c in zip(
                            scores[best].tolist(), ids[at].tolist(), copies[at].tolist(),
                            strict=True,
                        )
                    ]))
        return pd.DataFrame(out, columns=["anchor", "found"])

    return run


def _numbered(rows: DataFrame, name: str, blocks: int, others: int) -> DataFrame:
    """Rows with their own block, once for each of the other side's blocks.

    Both numbers are ints on both sides: a cogroup deals its keys by their types.
    """
    other = "anchor_block" if name == "block" else "block"
    return rows.withColumn(
        name, F.pmod(F.xxhash64("vec_id", "vector", F.lit(name)), F.lit(blocks)).cast("int")
    ).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def _found(
    rows: DataFrame, n_rows: int, anchors: DataFrame, n_anchors: int, k: int, same_label: bool
) -> DataFrame:
    """(anchor, score, vec_id, copies) of what each block has for each anchor's windows."""
    blocks, anchor_blocks = n_rows // BLOCK + 1, n_anchors // ANCHOR_BLOCK + 1
    keys = ["block", "anchor_block", "width"]
    return (
        _numbered(rows, "block", blocks, anchor_blocks).groupBy(*keys)
        .cogroup(_numbered(anchors, "anchor_block", anchor_blocks, blocks).groupBy(*keys))
        .applyInPandas(_searched(k, same_label), _FOUND)
        .select("anchor", F.inline("found"))
    )


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k rows of each group with their ``rank``, copies counted."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    repeated = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    return repeated.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    *,
    label: Column | None = None,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` and ``label`` are columns of ``embeddings``; the shares are in percent.
    """
    named = embeddings.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        (F.col("label") if label is None else label).alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    rows = saved(
        named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
        .withColumn("vector", integer_vector(F.col("vector")))
        .groupBy("vec_id", "label", "vector")
        .agg(F.count("*").alias("copies"), F.max("is_anchor").alias("is_anchor"))
        .select(
            F.monotonically_increasing_id().alias("anchor"),
            "vec_id", "label", "vector", "copies", "is_anchor", F.size("vector").alias("width"),
        )
    )
    counts = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    candidates = rows.drop("is_anchor", "anchor")
    # Columns of their own, as rows and anchors meet in a cogroup.
    anchors = rows.where("is_anchor").select(
        *[F.col(c).alias(c) for c in ("anchor", "vec_id", "label", "vector", "width")]
    )

    def window(least: Column, most: Column) -> Column:
        return F.struct(least.cast("bigint").alias("least"), most.cast("bigint").alias("most"))

    everything = F.array(window(F.lit(_LEAST), F.lit(_MOST)))
    near = saved(_first(
        _found(candidates, counts[0], anchors.withColumn("windows", everything), counts[1],
               positives, True),
        ["anchor"], positives,
    ).select(
        F.col("anchor").alias("of"), F.col("rank").alias("place"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    ).withColumns({
        # Whole scores in the share of the positive's, ends included.
        "least": F.ceil(F.col("positive_score") * low / F.lit(100).cast("decimal(3,0)")),
        "most": F.floor(F.col("positive_score") * high / F.lit(100).cast("decimal(3,0)")),
    }).where("least <= most"))
    windows = near.groupBy("of").agg(F.collect_set(window(F.col("least"), F.col("most"))).alias("windows"))
    asked = anchors.join(windows, F.col("anchor") == F.col("of")).drop("of")
    found = _found(candidates, counts[0], asked, counts[1], negatives, False)
    inside = (F.col("anchor") == F.col("of")) & F.col("score").between(F.col("least"), F.col("most"))
    best = _first(found.join(near, inside), ["of", "place"], negatives)
    again = rows.where("is_anchor").select(
        F.col("anchor").alias("again"), F.col("vec_id").alias("anchor_id"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("row"),
    )
    return best.join(again, F.col("of") == F.col("again")).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def oracle_sql(every: int = 50) -> str:
    """DuckDB SQL of the registered query over ``embeddings``."""
    return f"""
      with vectors as (
        select row_number() over () as number, vec_id,
          case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
          list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
        from embeddings
        where vec_id is not null and label is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
      scored as (
        select a.number, a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
          list_inner_product(a.v, c.v)::bigint as score
        from vectors a join vectors c on a.vec_id <> c.vec_id and len(a.v) = len(c.v)
        where a.vec_id % {every} = 0),
      positives as (
        select *, row_number() over (partition by number order by score desc, vec_id) as place
        from scored where same qualify place <= {POSITIVES})
      select p.anchor_id, p.vec_id as positive_id,
        (row_number() over (
          partition by p.number, p.place order by n.score desc, n.vec_id))::int as rank,
        n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
      from positives p join scored n on n.number = p.number and not n.same
        and {LOW} * p.score <= 100 * n.score and 100 * n.score <= {HIGH} * p.score
      qualify rank <= {NEGATIVES}"""
