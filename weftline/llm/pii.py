"""Personal data: base patterns, and terms that give protected entities away.

Base spans are e-mail addresses, IPv4 addresses, payment cards and phone numbers, found by the
patterns of the contract, leftmost and without overlap per kind. A match that fails
its check is dropped and not tried again. The finders read each character a bounded number
of times, also in texts of one endless run of digits.

A term can name an entity without the pattern. How strongly is estimated from co-occurrence in
the texts of the whole corpus, each different text counted once: ``n(e)`` hold an entity, ``n(t)``
a term, ``n(e, t)`` both, the term outside of all spans, among ``n``. The chance that a
text with the term holds the entity is drawn towards that of any text by ``PRIOR`` texts,

    p(e) = n(e) / n        p(e | t) = (n(e, t) + PRIOR * p(e)) / (n(t) + PRIOR)

so few texts tell less than many. Of the ``-log2 p(e)`` bits that name the entity, the term
leaves ``-log2 p(e | t)``. A term that leaves at most ``MOST_LEFT`` bits, and at most
``SHARE_LEFT`` of all there are, is a span of kind ``term`` wherever it stands, also in texts
without that entity. Both limits are the same at every size of the corpus. With them a word
of one text only, which holds the entity, is telling; a word of two texts if the entity is in
both; of four if it is in three. An entity of all texts makes no word telling. Terms are words
of three letters or more, in lower case.

Entities and terms whose best possible estimate misses the limits are left out before they are
joined, which changes no result.

``sanitised`` generalises spans to the names of their kinds.

Null texts read as empty. Repeated rows have the same spans. Very long texts are read
whole. Spans are in code points, the end exclusive. Empty tables give an empty result. Other
columns pass through ``sanitised`` and do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import (
    broadcast_if_few, free_name, freeing, replaced_column, saved, tasks_for, text_of,
)
from weftline.llm.word_ids import chunks
from weftline.operators.bloom import bloom_filter

#: The kinds in their order, as in the contract.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Texts of prior belief, bits that a telling term may leave at most, and the share of all bits.
PRIOR = 0.5
MOST_LEFT = 0.75
SHARE_LEFT = 0.2
#: What an entity needs at least one of; other texts are not sent to Python.
MAY_HOLD = "[0-9@]"
_TERMS = r"(\p{L}{3,})"
#: Texts whose rows are worth a task that writes a file.
_TEXTS_A_TASK = 4_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[Span]:
    """An address starts where the run of local characters before its ``@`` starts."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end(), "email"
        free = found.end() if found else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[Span]:
    """Each four parts in a row of a run of dotted numbers."""
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end, "ip"
            start = end + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                yield m.start(), m.end(), "card"


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.start(), m.end(), "phone"


_MAY_HOLD = re.compile(MAY_HOLD)


def base_spans(text: str) -> list[Span]:
    """By start and then kind."""
    if not _MAY_HOLD.search(text):
        return []
    found = [*_emails(text), *_ips(text), *_cards(text), *_phones(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def term_spans(text: str, terms: set[str], base: list[Span]) -> list[Span]:
    """Whole words among ``terms``, outside of the base spans."""
    found, i = [], 0
    taken = _merged(base)
    for m in _WORD.finditer(text) if terms else ():
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if (i == len(taken) or taken[i][0] >= m.end()) and m[0].lower() in terms:
            found.append((m.start(), m.end(), TERM))
    return found


def _merged(spans: list[Span]) -> list[Span]:
    """Spans that overlap as one, of the kind of the first."""
    out: list[Span] = []
    for start, end, kind in spans:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), out[-1][2])
        else:
            out.append((start, end, kind))
    return out


def replaced(text: str, spans: list[Span]) -> str:
    """``text`` with each span as the name of its kind in brackets."""
    parts, at = [], 0
    for start, end, kind in _merged(spans):
        parts += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*parts, text[at:]])


def rendered(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _entity(text: str, span: Span) -> str:
    start, end, kind = span
    value = text[start:end]
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else _NOT_DIGIT.sub('', value)}"


def blanked(text: str) -> str:
    """``text`` with a space for each base span."""
    parts, at = [], 0
    for start, end, _ in _merged(base_spans(text)):
        parts.append(text[at:start])
        at = end
    return " ".join([*parts, text[at:]])


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different entities of each text."""
    for batch, texts in chunks(batches):
        keys = batch.column(batch.schema.get_field_index("text_key")).to_pylist()
        rows = [
            (key, entity) for key, text in zip(keys, texts, strict=True)
            for entity in dict.fromkeys(_entity(text, span) for span in base_spans(text))
        ]
        columns = list(zip(*rows, strict=True)) or [[], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())],
            ["text_key", "entity"],
        )


def _blanking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        yield replaced_column(batch, "text", pa.array(map(blanked, texts), pa.string()))


def _terms_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TERMS)))


def _suspects(text: str) -> Column:
    """The text if it may hold an entity, else empty."""
    return F.when(F.col(text).rlike(MAY_HOLD), F.col(text)).otherwise(F.lit(""))


def _left(n_both: Column, n_term: Column, n_entity: Column, n: int) -> Column:
    """Bits that the term leaves of the entity."""
    share = (n_both + PRIOR * n_entity / n) / (n_term + PRIOR)
    return -F.log2(share)


def _tells(n_both: Column, n_term: Column, n_entity: Column, n: int) -> Column:
    most = F.least(F.lit(MOST_LEFT), SHARE_LEFT * -F.log2(n_entity / n))
    return (n_entity < n) & (_left(n_both, n_term, n_entity, n) <= most)


def disclosing_terms(documents: DataFrame, text: str = "text") -> DataFrame:
    """(text_key, terms): the telling terms of each text that holds any.

    ``text_key`` is the 64-bit hash of the text.
    """
    key = F.xxhash64(text_of(text)).alias("text_key")
    rows = documents.select(key, text_of(text).alias("text"))
    tasks = tasks_for(documents.sparkSession, documents.count(), _TEXTS_A_TASK)
    mentions = saved(
        rows.withColumn("text", _suspects("text")).where("text <> ''")
        .mapInArrow(freeing(_mentions), "text_key long, entity string").distinct(),
        tasks,
    )
    nothing = rows.limit(0).select("text_key", F.array("text").alias("terms"))
    counted = saved(rows.groupBy("text_key").agg(F.count("*").alias("copies")), tasks)
    n = counted.count()
    entities = mentions.groupBy("entity").agg(F.count("*").alias("n_entity"))
    best = F.col("n_entity")
    entities = saved(entities.where(_tells(best, best, best, n)), tasks)
    held = saved(
        mentions.join(broadcast_if_few(entities), "entity")
        .groupBy("text_key").agg(F.collect_list(F.struct("entity", "n_entity")).alias("held")),
        tasks,
    )
    if held.isEmpty():
        return nothing
    # A copy of a text weighs its share, so that each different text counts once.
    copied = broadcast_if_few(saved(counted.where("copies > 1"), tasks))
    weight = (1 / F.coalesce("copies", F.lit(1))).alias("weight")
    of = "weight double, held array<struct<entity:string,n_entity:bigint>>, text string"
    spoken = (
        rows.join(broadcast_if_few(held), "text_key")
        .join(copied, "text_key", "left")
        .select(weight, "held", "text")
        .mapInArrow(freeing(_blanking), of)
        .select("weight", "held", F.explode(_terms_of(F.col("text"))).alias("term"))
        .select("weight", "term", F.inline("held"))
        .groupBy("entity", "n_entity", "term")
        .agg(F.round(F.sum("weight")).cast("bigint").alias("n_both"))
    )
    n_term = (
        rows.join(copied, "text_key", "left")
        .select(weight, F.explode(_terms_of(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.round(F.sum("weight")).cast("bigint").alias("n_term"))
    )
    largest = entities.agg(F.max("n_entity")).first()[0]
    most = (largest + PRIOR) * 2**MOST_LEFT - PRIOR
    told = saved(
        spoken.join(n_term.where(F.col("n_term") <= most), "term")
        .where(_tells(F.col("n_both"), F.col("n_term"), F.col("n_entity"), n))
        .select("term")
        .distinct(),
        tasks,
    )
    if told.isEmpty():
        return nothing
    terms = rows.select("text_key", F.explode(_terms_of(F.col("text"))).alias("term"))
    return (
        _listed(terms, told, "term")
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set("term")).alias("terms"))
        .coalesce(tasks)
    )


def _listed(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """The rows whose key is listed; of many keys a Bloom filter drops most others first."""
    few = broadcast_if_few(listed)
    if few is listed:
        keys = bloom_filter(listed, key, listed.count())
        rows = rows.where(keys.might_contain(F.col(key))) if keys else rows
    return rows.join(few, key, "left_semi")


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def _all_spans(
    batch: pa.RecordBatch, texts: list[str], terms: str
) -> Iterator[tuple[list, list]]:
    terms = batch.column(batch.schema.get_field_index(terms)).to_pylist()
    for text, telling in zip(texts, terms, strict=True):
        base = base_spans(text)
        extra = term_spans(text, set(telling or ()), base)
        order = [*KINDS, TERM].index
        yield base, sorted([*base, *extra], key=lambda s: (s[0], order(s[2]))) if extra else base


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        rows = []
        for base, spans in _all_spans(batch, texts, "terms"):
            kinds = [kind for _, _, kind in base]
            digest = hashlib.sha256(rendered(base).encode()).hexdigest()
            rows.append((*map(kinds.count, KINDS), digest, rendered(spans)))
        columns = list(zip(*rows, strict=True))
        types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [*_columns(batch, ["doc_id"]),
             *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
            ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
        )


def _with_terms(df: DataFrame, telling: DataFrame, text: str, to: str) -> DataFrame:
    """``df`` with ``to``, the telling terms of each row's text.

    If they are many, only rows that may have some are shuffled to them.
    """
    key = free_name(df, "text_key")
    rows = df.withColumn(key, F.xxhash64(text_of(text)))
    telling = saved(telling).select(F.col("text_key").alias(key), F.col("terms").alias(to))
    few = broadcast_if_few(telling)
    keys = bloom_filter(telling, key, telling.count()) if few is telling else None
    if keys is None:
        return rows.join(few, key, "left").drop(key)
    may = keys.might_contain(F.col(key))
    none = F.lit(None).cast(telling.schema[to].dataType).alias(to)
    joined = rows.where(may).join(telling, key, "left").drop(key)
    return rows.where(~may).drop(key).select("*", none).unionByName(joined)


def found(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans of every document."""
    telling = disclosing_terms(documents, text)
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), text_of(text).alias("text")
    )
    rows = _with_terms(rows, telling, "text", "terms")
    needed = F.when(F.col("terms").isNotNull(), F.col("text")).otherwise(_suspects("text"))
    rows = rows.withColumn("text", needed)
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"doc_id {documents.schema[doc_id].dataType.simpleString()}, {counts}"
    return rows.mapInArrow(freeing(_counting), f"{schema}, base_sha256 string, spans string")


def _replacing(text: str, terms: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, text):
            nulls = _columns(batch, [text])[0].is_null().to_pylist()
            out = [
                None if null else replaced(t, spans) if spans else t
                for null, t, (_, spans) in zip(
                    nulls, texts, _all_spans(batch, texts, terms), strict=True
                )
            ]
            names = [n for n in batch.schema.names if n != terms]
            columns = _columns(batch, names)
            columns[names.index(text)] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def sanitised(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span generalised to its kind; same columns and rows."""
    telling = disclosing_terms(documents, text)
    terms = free_name(documents, "terms")
    rows = _with_terms(documents, telling, text, terms)
    return rows.mapInArrow(freeing(_replacing(text, terms)), T.StructType(list(documents.schema)))
