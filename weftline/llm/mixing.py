"""Mixing sources to target weights by systematic sampling.

Each source has a target of words. Its documents stand in a fixed order, each with
the same expected number of copies, the source's rate ``target / size``. With the
prefix sum of expected copies and one random offset of the source, a document is
emitted once per integer that its interval crosses.

The order within a source goes by size class, so that any stretch of it holds every
size in proportion and the words taken stay near the target. Prefix sums come from
counts of (source, size class, bucket); a bucket is a hash of the row, and there are
as many buckets as blocks of ``BUCKET_ROWS`` rows. No window holds a source: the widest
holds the size classes of a source (at most 8 per power of two), the buckets of a
size class, or the rows of one bucket.

Null texts have size 0. Null sources are one source, the last. Rows of size 0 are
never taken for words (``taken`` is 0). Repeated rows are separate documents. An empty
table gives an empty result. Other columns of the input, whatever their names, play
no part in ``mix`` and are kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import saved

#: What ends a word, as in the contract of the size.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "weftline-mix"
BUCKET_ROWS = 2000
#: Random numbers are multiples of 2**-20, so that sums with them stay exact.
_OFFSETS = 1 << 20


def _hash(text: Column, chars: int = 8) -> Column:
    """An integer of the first hex digits of md5, reproducible in any engine."""
    return F.conv(F.substring(F.md5(text), 1, chars), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, size) rows to (source, source_size, target, rate).

    The shares follow the weights in code point order of the sources. A target stops
    at ``cap`` times its source's size; what is over goes to the others by weight.
    In order of size per weight the capped sources come first, so one ordered pass
    over the sources finds the common level: the first source that the level of the
    remaining words and weights does not fill, and all after it, are below their caps.
    One row per source meets in one task, the list that the weights enumerate.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(int(w)) for w in weights])
    ordered = per_source.withColumn(
        "weight",
        F.element_at(choices, ((F.row_number().over(by_name) - 1) % len(weights) + 1)),
    )
    everything = Window.partitionBy()
    by_fill = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    words_left = F.sum("source_size").over(everything) - cap * F.coalesce(
        F.sum("source_size").over(before), F.lit(0)
    )
    steps = ordered.select(
        "*", words_left.alias("words_left"), F.sum("weight").over(after).alias("weight_left")
    )
    below = F.col("words_left") * F.col("weight") < (
        cap * F.col("source_size") * F.col("weight_left")
    )
    level = F.max(
        F.when(below, F.struct(F.col("weight_left"), F.col("words_left") / F.col("weight_left")))
    )
    steps = steps.select(
        "source", "source_size", "weight", level.over(everything)["col2"].alias("level")
    )
    full = (F.col("source_size") * cap).cast("double")
    target = F.coalesce(F.least(full, F.col("level") * F.col("weight")), full)
    return steps.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size"))
        .otherwise(0.0)
        .alias("rate"),
    )


def _size_class() -> Column:
    """Bit length and the two bits after the first: classes at most 25 percent wide."""
    bits = F.bin("size")
    return F.length(bits) * 4 + F.conv(
        F.concat(F.lit("0"), F.substring(F.rpad(bits, 3, "0"), 2, 2)), 2, 10
    ).cast("int")


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``rank``, their place from 0 within the source."""
    buckets = rows.count() // BUCKET_ROWS + 1
    identity = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
    rows = rows.select(
        *rows.columns,
        _size_class().alias("size_class"),
        (_hash(F.concat(F.lit(SEED), identity)) % buckets).alias("bucket"),
    )
    cell = ["source", "size_class", "bucket"]
    place = Window.partitionBy(*cell).orderBy("size", *[F.col(k).asc_nulls_last() for k in keys])
    counts = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    in_class = Window.partitionBy("source", "size_class").orderBy("bucket")
    classes = counts.groupBy("source", "size_class").agg(F.sum("n").alias("n"))
    in_source = Window.partitionBy("source").orderBy("size_class")
    classes = classes.select(
        F.col("source").alias("c_source"),
        F.col("size_class").alias("c_size_class"),
        (F.sum("n").over(in_source) - F.col("n")).alias("classes_before"),
    )
    counts = counts.select(
        *[F.col(c).alias(f"b_{c}") for c in cell],
        (F.sum("n").over(in_class) - F.col("n")).alias("buckets_before"),
    )
    starts = counts.join(
        classes,
        F.col("b_source").eqNullSafe(F.col("c_source"))
        & (F.col("b_size_class") == F.col("c_size_class")),
    ).select(
        *[f"b_{c}" for c in cell], (F.col("classes_before") + F.col("buckets_before")).alias("start")
    )
    numbered = rows.withColumn("place", F.row_number().over(place))
    return numbered.join(
        starts,
        F.col("source").eqNullSafe(F.col("b_source"))
        & (F.col("size_class") == F.col("b_size_class"))
        & (F.col("bucket") == F.col("b_bucket")),
    ).withColumn("rank", F.col("start") + F.col("place") - 1)


def sample_copies(
    rows: DataFrame, keys: list[str], weights=WEIGHTS, cap: int = CAP
) -> DataFrame:
    """Rows of (keys, source, size) with source_size, target and ``copies``.

    The narrow rows are written once, so that texts are read once.
    """
    rows = saved(rows)
    targets = source_targets(rows.select("source", "size"), weights, cap).withColumnRenamed(
        "source", "t_source"
    )
    offset = (
        _hash(F.concat(F.lit(SEED + ":offset:"), F.coalesce("source", F.lit("\0")))) % _OFFSETS
    ) / _OFFSETS
    crossed = F.floor(F.col("rate") * (F.col("rank") + 1) + offset) - F.floor(
        F.col("rate") * F.col("rank") + offset
    )
    ranked = _ranked(rows, keys)
    return ranked.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).select(
        *rows.columns,
        "source_size",
        "target",
        F.least(crossed, F.lit(cap)).cast("bigint").alias("copies"),
    )


def mix(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    cap: int = CAP,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    return sample_copies(rows, ["doc_id"], weights, cap).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def mixed_documents(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    cap: int = CAP,
) -> DataFrame:
    """The documents of the mix, each as often as it is taken; same columns.

    The copies are found on narrow rows and joined back by id and a hash of the text.
    Rows equal in both get equal places in any order, so their copies are added up and
    dealt out: every such row gets the copies of its turn.
    """
    key = F.xxhash64(F.col(doc_id), F.col(text), F.col(source))
    turn = Window.partitionBy("mix_key").orderBy("mix_key")
    rows = documents.select(
        key.alias("mix_key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
    )
    copies = (
        sample_copies(rows, ["mix_key"], weights, cap)
        .groupBy("mix_key")
        .agg(F.sum("copies").alias("mix_copies"), F.count("*").alias("mix_rows"))
    )
    columns = [documents[c] for c in documents.columns]
    keyed = documents.select(F.struct(*columns).alias("mix_row"), key.alias("mix_key"))
    joined = keyed.join(copies.where("mix_copies > 0"), "mix_key")
    share = F.expr("mix_copies div mix_rows") + (
        F.row_number().over(turn) <= F.col("mix_copies") % F.col("mix_rows")
    ).cast("int")
    single = joined.where("mix_rows = 1").select("mix_row", F.col("mix_copies").alias("n"))
    repeated = joined.where("mix_rows > 1").select("mix_row", share.alias("n"))
    taken = single.unionByName(repeated).where("n > 0")
    return taken.select("mix_row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select(
        "mix_row.*"
    )


def oracle_sql() -> str:
    """DuckDB SQL for ``mix`` over ``documents``, without the column ``copies``."""
    def number(expr: str) -> str:
        return f"cast('0x' || substr(md5({expr}), 1, 8) as bigint)"

    return f"""
      with sized as (
        select doc_id, source,
          coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size from documents),
      sources as (
        select source, sum(size)::bigint as source_size,
          [{', '.join(map(str, WEIGHTS))}][
            (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] as weight
        from sized group by source),
      steps as (
        select *, sum(source_size) over () - {CAP} * coalesce(sum(source_size) over (
            order by source_size / weight, source nulls last
            rows between unbounded preceding and 1 preceding), 0) as words_left,
          sum(weight) over (order by source_size / weight, source nulls last
            rows between current row and unbounded following) as weight_left
        from sources),
      level as (
        select arg_max(words_left::double / weight_left, weight_left) as level from steps
        where words_left * weight < {CAP} * source_size * weight_left),
      targets as (
        select source, source_size,
          coalesce(least({CAP} * source_size::double, level * weight),
            {CAP} * source_size::double) as target
        from steps left join level on true),
      classed as (
        select *, length(bin(size)) * 4 + cast('0b' || substr(rpad(bin(size), 3, '0'), 2, 2) as int)
            as size_class,
          {number(f"'{SEED}' || coalesce(doc_id::varchar, '-')")}
            % (select count(*) // {BUCKET_ROWS} + 1 from sized) as bucket
        from sized),
      ranked as (
        select *, row_number() over (
          partition by source order by size_class, bucket, size, doc_id nulls last) - 1 as rank
        from classed),
      rated as (
        select r.*, source_size, target,
          case when source_size > 0 then target / source_size else 0.0::double end as rate,
          ({number(f"'{SEED}:offset:' || coalesce(r.source, chr(0))")} % {_OFFSETS})
            / {_OFFSETS}::double as shift
        from ranked r join targets t on r.source is not distinct from t.source)
      select doc_id, size, source_size, target, size * least({CAP},
          cast(floor(rate * (rank + 1) + shift) - floor(rate * rank + shift) as bigint)) as taken
      from rated"""
