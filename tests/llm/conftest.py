import random
from collections import Counter
from pathlib import Path

import pytest

from small_tables import SF

from weftline.llm.common import ready


@pytest.fixture(autouse=True)
def _workers(spark):
    ready(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


#: Names that the operators use inside, as columns of the input.
CLASHES = (
    "ids size rank bucket range guest vector text_key terms key tid n copies trusted toxic "
    "quality quality_score toxic_score place block found target n_words r_key mix_key"
).split()

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma.", "délta", "x", "Ünder", "omega,", "42", "\n", "a@b.co"]
    long = " ".join(rnd.choice(words) for _ in range(30_000))
    prose = " ".join(rnd.choice(words) for _ in range(60))
    return [
        (1, "", "en", "a", 0),
        (2, None, None, None, None),
        (3, long, "en", "a", len(long)),
        (4, prose, "en", "b", len(prose)),
        (4, prose, "en", "b", len(prose)),
        (5, prose, "de", None, None),
        (None, prose + " end", "de", "b", None),
        (None, None, None, None, None),
        (7, "one", "en", "a", 3),
        (7, "two words", "en", "c", 9),
        (8, " \n\t ", "en", "c", 4),
        (9, "mail bob@example.com or 10.0.0.1, call +1 (555) 123-4567", "en", "a", 56),
        (-3, "ÄÖÜ 漢字 😀 ▁ \x00 end", "xx", "", 17),
    ]


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing names."""
    df = spark.createDataFrame(odd_rows(), COLUMNS)
    return df.selectExpr("*", *[f"'{c}!' as {c}" for c in CLASHES])


@pytest.fixture
def empty(odd):
    return odd.limit(0)


@pytest.fixture
def files_written(spark):
    """Runs a function with 40 partitions a shuffle, none merged: its result, files of each table it saves."""
    def run(of):
        wanted = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
        before = {k: spark.conf.get(k) for k in wanted}
        known = _part_files(spark)
        for k, v in wanted.items():
            spark.conf.set(k, v)
        try:
            result = of()
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        return result, Counter(f.parent for f in _part_files(spark) - known)

    return run


def _part_files(spark):
    folder = spark.sparkContext.getCheckpointDir()
    return set(Path(folder.removeprefix("file:")).glob("rdd-*/part-*")) if folder else set()
