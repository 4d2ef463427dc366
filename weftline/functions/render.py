"""Text forms of the typed results, for sinks that need exact lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _float_text(value: Column) -> Column:
    return value.cast("float").cast("string")


def tab_line(*columns: str) -> Column:
    """``key \\t value`` with every field as text; NULL becomes ``null``."""
    return F.concat_ws(
        "\t", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    )


# The layouts of the rendered tuples.


def count_average(count: str = "cnt", average: str = "average") -> Column:
    return F.concat_ws("\t", _float_text(F.col(count)), _float_text(F.col(average)))


def min_max(low: str = "min_freq", high: str = "max_freq", count: str = "cnt") -> Column:
    return F.concat(
        F.lit("Min: "), F.col(low).cast("string"),
        F.lit(" Max: "), F.col(high).cast("string"),
        F.lit(" Count: "), F.col(count).cast("string"),
    )


def median_std(median: str = "median", std: str = "std") -> Column:
    """Median and deviation; a deviation that is not defined shows as ``NaN``."""
    shown = F.coalesce(_float_text(F.col(std)), F.lit("NaN"))
    return F.concat_ws(" ", _float_text(F.col(median)), shown)


def id_list(ids: str = "doc_ids") -> Column:
    """``: id id id`` of an array of ids."""
    return F.concat(F.lit(": "), F.array_join(F.col(ids).cast("array<string>"), " "))
