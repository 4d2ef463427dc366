"""Exact top-k inner products by an impact-ordered score-at-a-time index.

Vectors become integers, ``floor(256 * x)``. The index cuts them in blocks. In a block
every dimension has one posting list, ordered by value and cut in segments of equal
quantised impact by an offset table. A query takes the segments of all dimensions by
descending impact (query value times posting value), level by level, and adds each
posting's part to its vector's sum. After a level a vector that was seen in ``n`` of
the ``d`` dimensions scores at most ``sum + (d - n) * level``, since what it has not
shown yet is below the level. Vectors whose bound falls short of the k-th best exact
score so far cannot be members. The query stops when few possible members are left
(``RESCORE`` of them) or all postings are read, and scores those exactly. So the
result is exact; nothing is cut off on a guess.

Blocks meet blocks of queries, never single rows: each task indexes one block of vectors,
takes one block of queries to it, and returns at most k rows a query. A last window
per query orders at most k rows per block.

Vectors that are null, or hold a null or a number that is not finite, take no part, nor
do rows with a null id. Vectors are compared with those of the same length. Rows with a query's
id are its own, also when the id repeats. Equal scores go to the smaller id. With fewer
than k candidates all are returned. Empty tables give an empty result. Other columns
are not read. Scores must fit 64 bits.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a block of the index and queries in a block of queries, on average.
BLOCK = 16384
QUERY_BLOCK = 16384
#: At most so many quantised impacts a dimension.
SEGMENTS = 1024
#: A query stops early once at most this many vectors can still be members.
RESCORE = 256
SCALE = 256
_HITS = "query_id long, vec_id long, score long"


def integer_vector(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))


def usable(vector: Column) -> Column:
    """Not null and all components finite."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )


class Postings:
    """The index of one block.

    ``postings[d]`` holds vector numbers by ascending value in dimension ``d`` and
    ``ordered[d]`` those values; ``starts[d, i]`` is where values of at least
    ``marks[i]`` start in them.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        columns = np.ascontiguousarray(values.T)
        self.postings = np.argsort(columns, axis=1, kind="stable")
        self.ordered = np.take_along_axis(columns, self.postings, axis=1)
        low, high = int(values.min(initial=0)), int(values.max(initial=0))
        self.marks = np.linspace(low, high + 1, min(SEGMENTS, high - low + 1) + 1)
        self.starts = np.array([np.searchsorted(row, self.marks) for row in self.ordered])
        self.starts = self.starts.reshape(len(columns), len(self.marks))

    def _edges(self, weights: np.ndarray, level: float) -> np.ndarray:
        """For each query value where the postings of impact ``level`` or more end or start.

        Rounds to whole segments, outward, so no posting of such an impact is left out.
        """
        with np.errstate(divide="ignore", invalid="ignore"):
            value = level / weights
        after = np.searchsorted(self.marks, value, "right")
        return np.clip(np.where(weights > 0, after - 1, after), 0, len(self.marks) - 1)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the block's best k, by score and then id."""
        n = len(self.ids)
        own = self.ids == query_id
        dims = np.flatnonzero(query)
        weights = query[dims]
        sums = np.zeros(n, np.int64)
        left = np.full(n, len(dims), np.int64)
        done = self.starts[dims, np.where(weights > 0, len(self.marks) - 1, 0)]
        bar, members, scores = None, None, None
        for level in _levels(weights, self.marks):
            reached = self.starts[dims, self._edges(weights, level)]
            for dim, weight, a, b in zip(dims, weights, done, reached, strict=True):
                if a != b:
                    cut = slice(min(a, b), max(a, b))
                    hit = self.postings[dim, cut]
                    sums[hit] += weight * self.ordered[dim, cut]
                    left[hit] -= 1
            done = reached
            if n <= RESCORE or level == -np.inf:
                continue
            seeds = np.argpartition(sums, n - 4 * k)[n - 4 * k:] if n > 4 * k else np.arange(n)
            seeds = seeds[~own[seeds]]
            if len(seeds) < k:
                continue
            found = np.partition(self.values[seeds] @ query, -k)[-k]
            bar = found if bar is None else max(bar, found)
            possible = np.flatnonzero(sums + np.ceil(left * level) >= bar)
            if len(possible) <= RESCORE:
                members, scores = possible, self.values[possible] @ query
                break
        if members is None:
            members, scores = np.arange(n), sums
        keep = ~own[members]
        members, scores = members[keep], scores[keep]
        if len(members) > k:
            keep = scores >= np.partition(scores, -k)[-k]
            members, scores = members[keep], scores[keep]
        order = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members[order]], scores[order]


def _levels(weights: np.ndarray, marks: np.ndarray) -> list[float]:
    """Descending impacts: powers of two below the largest, zero, and down again."""
    largest = float(np.abs(weights).max(initial=0)) * float(np.abs(marks).max())
    parts = [largest / 2**i for i in range(5, 9)]
    return [*parts, 0.0, *[-x for x in reversed(parts)], -np.inf]


def _searched(k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        hits = []
        if len(vectors) and len(queries):
            index = Postings(vectors["vec_id"].to_numpy(), np.stack(vectors["vector"].to_numpy()))
            for query_id, query in zip(queries["vec_id"], queries["vector"], strict=True):
                ids, scores = index.search(query_id, query, k)
                hits.append(
                    pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores})
                )
        return pd.concat(hits) if hits else pd.DataFrame(
            {c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")}
        )

    return run


def _blocked(rows: DataFrame, size: int, seed: int) -> tuple[DataFrame, int]:
    """Rows with a block number; as many blocks as hold ``size`` rows each."""
    blocks = rows.count() // size + 1
    number = F.pmod(F.xxhash64("vec_id", "vector", F.lit(seed)), F.lit(blocks))
    return rows.withColumn("block", number), blocks


def top_k(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the best k rows of each row with ``is_query``."""
    rows = embeddings.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        integer_vector(F.col(vector)).alias("vector"),
        F.size(vector).alias("width"),
        is_query.alias("is_query"),
    )
    vectors, blocks = _blocked(rows.drop("is_query"), BLOCK, 1)
    queries, query_blocks = _blocked(
        rows.where("is_query").drop("is_query").dropDuplicates(["vec_id", "vector"]),
        QUERY_BLOCK, 2,
    )

    def dealt(df: DataFrame, name: str, to: int) -> DataFrame:
        return df.withColumnRenamed("block", name).withColumn(
            "block" if name == "query_block" else "query_block",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(to - 1).cast("bigint"))),
        )

    keys = ["block", "query_block", "width"]
    pairs = dealt(vectors, "block", query_blocks).groupBy(*keys).cogroup(
        dealt(queries, "query_block", blocks).groupBy(*keys)
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        pairs.applyInPandas(_searched(k), _HITS)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def oracle_sql(every: int = 50, k: int = 5) -> str:
    """DuckDB SQL of ``top_k`` over ``embeddings``, queries by divisible ids."""
    return f"""
      with vectors as (
        select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
        from embeddings
        where vec_id is not null and embedding is not null and len(list_filter(
          embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
      scored as (
        select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
        from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
        where q.vec_id % {every} = 0),
      ranked as (
        select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank
        from scored)
      select query_id, rank, vec_id, score from ranked where rank <= {k}"""
