"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs (its lines). Each paragraph is hashed
to a wide vector, and the document's fingerprint is the sum of those vectors modulo
powers of two, so the order of paragraphs plays no part and paragraphs can be put in
or taken out without the rest of the text (``merged``). A vector has two parts:

* ``EXACT`` numbers modulo 2**32, halves of 64-bit hashes of the paragraph. Equal
  multisets have equal sums; others agree by chance once in 2**256.
* numbers modulo 2**32 that carry likeness. Each sentence of the paragraph adds the
  sign bits of its hashes. With ``n`` sentences and bit sums ``c`` the sums of
  signs are ``2 * c - n``, and the product of two documents' sign sums estimates how
  many sentences they share. Two 32-bit sums share one 64-bit number.

``likeness`` is the estimated share of common sentences, ``ab / (aa + bb - ab)`` held
to 0..1; equal fingerprints give 1. Its standard error is about
1 / sqrt(64 * HASHES).

Null texts read as empty. An empty text is one empty paragraph. Repeated rows have
equal fingerprints. ``edited`` gives each row the text of the next one by descending
id (ties by text, null ids last, after the last the first): ids are cut in ranges by
quantiles, each range is one window, and the first document of a range is also sent
to the range before it. An empty table gives an empty result. Only the id and text
columns are read, other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import cut_points, range_number, text_of

EXACT = 8
HASHES = 2
_LOW = (1 << 32) - 1
_LANES = (1 << 32) | 1
_PARAGRAPH = "\n"
_SENTENCE = r"(?<=[.!?]) +"
#: Stands for null ids, which come last in descending order.
_NO_ID = -(1 << 63)


def _sum(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, x: total + of(x))


def _bits(hashes: Column, shift: Column) -> Column:
    """Sums of bit ``shift`` and bit ``shift + 32``, in one number."""
    return _sum(
        hashes,
        lambda h: F.call_function("shiftrightunsigned", h, shift).bitwiseAND(F.lit(_LANES)),
    )


def _all_bits(hashes: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda shift: _bits(hashes, shift))


def _with_units(df: DataFrame, text: str, tag: str) -> DataFrame:
    """Adds hash arrays of the paragraphs and sentences of ``text``.

    They are columns of their own so that each is computed once a row.
    """
    lines = F.split(F.col(text), _PARAGRAPH)
    sentences = F.flatten(F.transform(lines, lambda p: F.split(p, _SENTENCE)))

    def hashed(parts: Column, seed: int) -> Column:
        return F.transform(parts, lambda part: F.xxhash64(part, F.lit(seed)))

    exact = [hashed(lines, i).alias(f"{tag}_p{i}") for i in range(EXACT // 2)]
    likeness = [hashed(sentences, -1 - i).alias(f"{tag}_s{i}") for i in range(HASHES)]
    return df.select("*", *exact, *likeness)


def _vector(tag: str) -> Column:
    """The sums of one text, as an array; the last number counts sentences."""
    exact = [
        _sum(F.col(f"{tag}_p{i}"), half).bitwiseAND(F.lit(_LOW))
        for i in range(EXACT // 2)
        for half in (
            lambda h: h.bitwiseAND(F.lit(_LOW)),
            lambda h: F.shiftrightunsigned(h, 32),
        )
    ]
    likeness = [_all_bits(F.col(f"{tag}_s{i}")) for i in range(HASHES)]
    count = F.array(F.size(f"{tag}_s0").cast("bigint"))
    return F.concat(F.array(*exact), *likeness, count)


def fingerprinted(df: DataFrame, text: str, vector: str) -> DataFrame:
    """Adds the column ``vector`` for the column ``text``, which holds no null."""
    kept = df.columns
    return _with_units(df, text, "u").select(*kept, _vector("u").alias(vector))


def hex_of(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def merged(left: Column, right: Column, remove: bool = False) -> Column:
    """The vector of the paragraphs of both; with ``remove`` those of ``left`` less ``right``.

    The paragraphs of ``right`` must be among those of ``left`` when they are removed.
    """
    def modulo(x: Column) -> Column:
        return x.bitwiseAND(F.lit(_LOW))

    sums = F.zip_with(left, right, lambda a, b: a - b if remove else a + b)
    return F.concat(
        F.transform(F.slice(sums, 1, EXACT), modulo),
        F.slice(sums, EXACT + 1, 32 * HASHES + 1),
    )


def _signs(vector: Column) -> Column:
    """Sums of signs: both halves of each number, twice, less the count."""
    counts = F.slice(vector, EXACT + 1, 32 * HASHES)
    n = F.element_at(vector, -1)
    halves = F.concat(
        F.transform(counts, lambda c: c.bitwiseAND(F.lit(_LOW))),
        F.transform(counts, lambda c: F.shiftrightunsigned(c, 32)),
    )
    return F.transform(halves, lambda c: (2 * c - n).cast("double"))


def _product(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x
    )


def with_likeness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds for each name the likeness of two vector columns."""
    kept = df.columns
    vectors = sorted({v for pair in pairs.values() for v in pair})
    signed = df.select("*", *[_signs(F.col(v)).alias(f"signs_{v}") for v in vectors])
    products = signed.select(
        *kept,
        *[_product(F.col(f"signs_{v}"), F.col(f"signs_{v}")).alias(f"own_{v}") for v in vectors],
        *[
            _product(F.col(f"signs_{a}"), F.col(f"signs_{b}")).alias(f"both_{n}")
            for n, (a, b) in pairs.items()
        ],
    )

    def share(name: str, a: str, b: str) -> Column:
        both = F.col(f"both_{name}")
        every = F.col(f"own_{a}") + F.col(f"own_{b}") - both
        return (
            F.when(F.col(a) == F.col(b), 1.0)
            .when(every <= 0, 0.0)
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), both / every)))
            .alias(name)
        )

    return products.select(*kept, *[share(n, a, b) for n, (a, b) in pairs.items()])


def with_next(df: DataFrame, key: str, text: str, carried: list[str]) -> DataFrame:
    """Adds ``next_<c>`` for each carried column: that of the next row by descending key.

    One shuffle. The largest key of each range (one number a range, at most as many
    as shuffle partitions) goes to the driver; its rows are sent to two ranges.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("place", F.coalesce(F.col(key), F.lit(_NO_ID)))
    keys = keyed.select("place")
    cuts = cut_points(keys, "place", parts)
    number = range_number(F.col("place"), cuts)
    tops = dict(
        keys.groupBy(number.alias("range")).agg(F.max("place")).collect()
    )
    filled = sorted(tops)
    # The range above gets the top of this one as its last row; the lowest, the largest key.
    goes_to = dict(zip(filled, [*filled[1:], *filled[:1]], strict=True))
    ranges = range(len(cuts) + 1)
    top = F.array(*[F.lit(tops.get(i)).cast("bigint") for i in ranges])
    target = F.array(*[F.lit(goes_to.get(i)).cast("int") for i in ranges])
    ranged = keyed.withColumn("range", number)
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(
        F.element_at(target, F.col("range") + 1).alias("range"), F.lit(True).alias("guest")
    )
    is_top = F.element_at(top, F.col("range") + 1) == F.col("place")
    dealt = ranged.select(
        *df.columns, "place",
        F.explode(F.when(is_top, F.array(own, guest)).otherwise(F.array(own))).alias("seat"),
    ).select(*df.columns, "place", "seat.range", "seat.guest")
    order = Window.partitionBy("range").orderBy("guest", F.col("place").desc(), text)
    following = F.lead(F.struct(*carried)).over(order).alias("following")
    return (
        dealt.select(*df.columns, "guest", following)
        .where("not guest")
        .select(*df.columns, *[F.col(f"following.{c}").alias(f"next_{c}") for c in carried])
    )


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document, of its edited text, and their likeness."""
    own = documents.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    own = fingerprinted(own, "text", "vector")
    pairs = with_next(own, "doc_id", "text", ["text", "vector"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring("next_text", F.lit(1), half),
    )
    pairs = pairs.withColumn("n_chars", F.char_length("text").cast("bigint")).select(
        "doc_id", "n_chars", "vector", "next_vector", edited.alias("edited_text")
    )
    done = with_likeness(
        fingerprinted(pairs, "edited_text", "edited_vector"),
        {"near_edited": ("vector", "edited_vector"), "near_next": ("vector", "next_vector")},
    )
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        hex_of(F.col("vector")).alias("fingerprint"),
        hex_of(F.col("edited_vector")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
