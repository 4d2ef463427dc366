"""A corpus pipeline over ``documents``: from raw text to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes each
stage's rows as Parquet to the shared folder and reads them back for the next, so a stage
that is lost starts from files. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import mixing, order_minhash, pii, quality, suffix_pieces
from weftline.llm.common import new_folder, ready


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = ready(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept(docs, labels)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ready(spark)
    return order_minhash.deduplicated(docs)


def _pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is generalised to the name of its kind; ``n_chars`` follows the text."""
    ready(spark)
    out = pii.sanitised(docs)
    if "n_chars" not in out.columns:
        return out
    length = F.char_length("text").cast(out.schema["n_chars"].dataType)
    changed = F.when(F.col("text").isNotNull(), length).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ready(spark)
    return mixing.mixed_documents(docs)


def _encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document of the mix, and the digest of what they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    ready(spark)
    return suffix_pieces.encoded_and_decoded(docs, model)


STAGES = [
    ("quality", _quality),
    ("near_dedup", _near_dedup),
    ("pii", _pii),
    ("mixing", _mixing),
    ("encoding", _encoding),
]

#: The classifier, the sketches and the encoder have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
