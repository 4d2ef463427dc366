"""Line formats to typed columns.

Every parser takes a DataFrame with a ``value`` line and gives typed columns;
``keep`` names further columns to carry along. ``mode="failfast"`` stops the job
at a malformed line, ``"dropmalformed"`` leaves such lines out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.tokens import REGEX_SPACE, TRIM_CHARS, split_fields

MODES = ("failfast", "dropmalformed")


def strict_int(text: Column) -> Column:
    """32-bit integer of a plain digit string, else NULL; blanks are not trimmed."""
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("int"))


def _checked(
    df: DataFrame, columns: dict[str, Column], mode: str, keep: Sequence[str]
) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    parsed = df.select(*[c.alias(name) for name, c in columns.items()], "value", *keep)
    if mode == "dropmalformed":
        return parsed.dropna(subset=list(columns))
    # A filter, since a column that is not asked for would not be computed.
    whole = F.lit(True)
    for name in columns:
        whole = whole & F.col(name).isNotNull()
    shown = F.coalesce(F.col("value"), F.lit("null"))
    fail = F.raise_error(F.concat(F.lit("malformed line: "), shown))
    return parsed.where(F.when(whole, F.lit(True)).otherwise(fail.cast("boolean")))


def parse_pairs(
    df: DataFrame, mode: str = "failfast", separator: str = " ", keep: Sequence[str] = ()
) -> DataFrame:
    """``id freq`` lines to ``id INT, freq INT``; one separator between fields.

    Pass ``separator=REGEX_SPACE`` to accept any one whitespace character.
    """
    fields = split_fields(F.col("value"), separator)
    columns = {
        "id": strict_int(F.get(fields, F.lit(0))),
        "freq": strict_int(F.get(fields, F.lit(1))),
    }
    return _checked(df, columns, mode, keep).drop("value")


def parse_docs(
    df: DataFrame,
    mode: str = "failfast",
    keep: Sequence[str] = (),
    fields: Sequence[str] = ("id", "body"),
) -> DataFrame:
    """``id:body`` lines to ``id INT, body STRING`` and the line.

    The body is the text between the first and the second colon, unchanged. Of
    the two, only the ``fields`` asked for have to be there.
    """
    parts = split_fields(F.col("value"), ":")
    columns = {
        "id": strict_int(F.get(parts, F.lit(0))),
        "body": F.get(parts, F.lit(1)),
    }
    return _checked(df, {name: columns[name] for name in fields}, mode, keep)


def parse_entities(
    df: DataFrame, mode: str = "failfast", keep: Sequence[str] = ()
) -> DataFrame:
    """``id payload`` lines to ``id INT`` and the whole line."""
    first = F.get(F.split(F.col("value"), r"\s+", 2), F.lit(0))
    return _checked(df, {"id": strict_int(first)}, mode, keep)


def parse_profiles(
    df: DataFrame, mode: str = "failfast", keep: Sequence[str] = ()
) -> DataFrame:
    """Lines to ``user_id`` (first token) and ``attribute`` (last token)."""
    body = F.rtrim(F.col("value"), F.lit(REGEX_SPACE))
    fields = F.split(body, r"\s")
    columns = {
        "user_id": F.nullif(F.get(fields, F.lit(0)), F.lit("")),
        "attribute": F.nullif(F.element_at(fields, -1), F.lit("")),
    }
    return _checked(df, columns, mode, keep).drop("value")


def parse_words(df: DataFrame) -> DataFrame:
    """Side-list lines to trimmed, non-blank, distinct ``token`` rows."""
    token = F.trim(F.col("value"), F.lit(TRIM_CHARS)).alias("token")
    return df.select(token).where(F.col("token") != "").distinct()
