import pytest
from collected import rows
from pyspark.sql import functions as F

from weftline.functions.tokens import split_fields, split_keep_leading, split_trimmed
from weftline.operators import chain_word_count, word_count

# Invented prose with a trailing blank, a blank line, and a dash in hair spaces.
SAMPLE = [
    "The ferry leaves at noon, an hour before the tide turns, ",
    "",
    "and the crew\u200a\u2014\u200aseven of them\u200a\u2014\u200aload a cart, a crate of pears and a bell.",
    "An empty crate is left for the harbour cat. ",
]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", [""]),
        ("  ", []),
        (" a", ["", "a"]),
        ("a ", ["a"]),
        (" a  b ", ["", "a", "b"]),
        ("a\t\n\x0b\f\rb", ["a", "b"]),
        ("a\u200ab", ["a\u200ab"]),
        ("a\u00a0b", ["a\u00a0b"]),
    ],
)
def test_split_keep_leading(lines, text, expected):
    df = lines(text).select(split_keep_leading(F.col("value")).alias("t"))
    assert df.first()["t"] == expected


def test_split_trimmed_strips_controls(lines):
    df = lines("a\x01 \x02b c\x03d").select(split_trimmed(F.col("value")).alias("t"))
    assert df.first()["t"] == ["a", "b", "c\x03d"]


@pytest.mark.parametrize(
    "text, expected", [("87:", ["87"]), ("a::b::", ["a", "", "b"]), ("a: b", ["a", " b"])]
)
def test_split_fields_drops_trailing_empty(lines, text, expected):
    assert lines(text).select(split_fields(F.col("value"), ":").alias("t")).first()["t"] == expected


@pytest.mark.parametrize("sep", list(" :.|^\\\t"))
def test_split_fields_takes_any_separator(lines, sep):
    df = lines(sep.join(["a", "b", "", "c", ""]))
    assert df.select(split_fields(F.col("value"), sep).alias("t")).first()["t"] == ["a", "b", "", "c"]


def test_word_count_sample(lines):
    counts = dict(rows(word_count(lines(*SAMPLE))))
    # 11 words, one empty token, 14 words and 9; "the" and "a" 3, "of", "and", "crate" 2.
    assert sum(counts.values()) == 11 + 1 + 14 + 9 and len(counts) == 28
    assert counts[""] == 1 and counts["a"] == 3 and counts["of"] == 2 and counts["crate"] == 2
    assert counts["the"] == 3 and counts["The"] == 1 and counts["and"] == 2
    assert counts["crew\u200a\u2014\u200aseven"] == 1 and counts["them\u200a\u2014\u200aload"] == 1


def test_chain_word_count_sample(lines):
    counts = dict(rows(chain_word_count(lines(*SAMPLE))))
    # Without the empty token; "The" and "the" are one, as are "An" and "an".
    assert len(counts) == 25 and sum(counts.values()) == 34
    assert "" not in counts and counts["THE"] == 4 and counts["AN"] == 2 and counts["A"] == 3


def test_chain_word_count_edges(lines):
    df = lines("", "   ", " straße x ", "a\x0bb")
    assert rows(chain_word_count(df)) == [("A\x0bB", 1), ("STRASSE", 1), ("X", 1)]
