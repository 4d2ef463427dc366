"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import (
    hard_negatives,
    jaccard_join,
    mixing,
    multiset_hash,
    order_minhash,
    pii,
    quality,
    spelling,
    suffix_pieces,
    token_files,
    topk,
    toxicity,
    url_rules,
)
from weftline.llm.common import ready


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf}/{name}.parquet")


def _mixing(spark, sf):
    return mixing.mix(_table(spark, sf, "documents")).drop("copies")


def _multiset_hash(spark, sf):
    return multiset_hash.fingerprints(_table(spark, sf, "documents"))


def _token_files(spark, sf):
    documents = _table(spark, sf, "documents")
    return token_files.token_files(spark, documents, public_tokenizers.path("word_bpe_49k.json"))


def _quality(spark, sf):
    return quality.scored(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def _pii(spark, sf):
    return pii.found(_table(spark, sf, "documents"))


def _toxicity(spark, sf):
    return toxicity.scored(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def _order_minhash(spark, sf):
    return order_minhash.near_duplicates(_table(spark, sf, "documents"))


def _suffix_pieces(spark, sf):
    documents = _table(spark, sf, "documents")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return suffix_pieces.encoded_and_decoded(documents, model)


def _topk(spark, sf):
    return topk.top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def _url_rules(spark, sf):
    return url_rules.judge(_table(spark, sf, "pages"))


def _hard_negatives(spark, sf):
    """One label in seven is off by one."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    return hard_negatives.hard_negatives(
        _table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0,
        label=F.coalesce(shifted, "label"),
    )


def _jaccard_join(spark, sf):
    return jaccard_join.jaccard_classes(_table(spark, sf, "documents"))


def _spelling(spark, sf):
    """One run of letters in 199 loses a letter first."""
    words = spelling.vocabulary(_table(spark, sf, "documents"), cut_every=199)
    return spelling.spelling_variants(words)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": _toxicity,
        "op2_token_files": _token_files,
        "op3_quality": _quality,
        "op4_pii": _pii,
        "op5_multiset_hash": _multiset_hash,
        "op6_suffix_pieces": _suffix_pieces,
        "op7_topk": _topk,
        "op8_order_minhash": _order_minhash,
        "op9_url_rules": _url_rules,
        "op10_mixing": _mixing,
        "op11_hard_negatives": _hard_negatives,
        "op12_jaccard_join": _jaccard_join,
        "op13_spelling": _spelling,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_topk": topk.oracle_sql(),
        "op10_mixing": mixing.oracle_sql(),
        "op11_hard_negatives": hard_negatives.oracle_sql(),
        "op12_jaccard_join": jaccard_join.oracle_sql(),
        "op13_spelling": spelling.oracle_sql(),
    }
