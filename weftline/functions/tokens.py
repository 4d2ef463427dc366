"""Token rules, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters of an ASCII regex `\s`, of the default tokenizer
# delimiters (no vertical tab), and of a `trim` that strips all controls.
REGEX_SPACE = " \t\n\x0b\f\r"
TOKENIZER_SPACE = " \t\n\r\f"
TRIM_CHARS = "".join(chr(c) for c in range(0x21))


def split_keep_leading(text: Column) -> Column:
    """Split on whitespace runs; a leading empty token stays, trailing ones go.

    An empty text gives one empty token, a text of blanks only gives none.
    """
    body = F.rtrim(text, F.lit(REGEX_SPACE))
    none = F.array().cast("array<string>")
    return F.when((body == "") & (text != ""), none).otherwise(F.split(body, r"\s+"))


def split_non_empty(text: Column) -> Column:
    """Split on the tokenizer's delimiters.

    The outer trim leaves at most one empty token, for a text without any word;
    filter it out after exploding.
    """
    return F.split(F.trim(text, F.lit(TOKENIZER_SPACE)), r"[ \t\n\r\f]+")


def split_trimmed(text: Column) -> Column:
    """Split on whitespace, with control characters trimmed off every token."""
    return _trimmed(text, r"\s+", r"[\x00-\x08\x0e-\x1f]")


def split_blanks(text: Column) -> Column:
    """Split on blanks only; other controls are trimmed off the ends of a token.

    Adjacent blanks give empty tokens.
    """
    return _trimmed(text, " ", r"[\x00-\x1f]")


def _trimmed(text: Column, pattern: str, controls: str) -> Column:
    """The tokens; the trim of each runs only on texts that hold controls at all."""
    tokens = F.split(text, pattern)
    return F.when(
        text.rlike(controls), F.transform(tokens, lambda t: F.trim(t, F.lit(TRIM_CHARS)))
    ).otherwise(tokens)


# Fixed value: the characters with a meaning of their own in a regular expression.
_REGEX_CHARS = ".$|()[{^?*+\\"


def split_fields(text: Column, separators: str) -> Column:
    """Split on any one separator character, without trailing empty fields.

    A single plain character takes Java's split without a regular expression.
    """
    if len(separators) == 1 and separators not in _REGEX_CHARS:
        pattern = separators
    else:
        pattern = "[" + separators.replace("\\", "\\\\").replace("^", "\\^") + "]"
    return F.split(F.rtrim(text, F.lit(separators)), pattern)
