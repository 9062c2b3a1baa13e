"""The queries of this subpackage's operators, over the given tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from . import decontaminate as op1
from . import tokens as op2
from . import jaccard as op3
from . import media as op4
from . import quality as op5
from . import toxicity as op7
from . import urls as op6
from . import language as op10
from . import packing as op8
from . import lm as op9
from . import merkle as op11
from . import bpe as op12
from . import negatives as op13

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.token_output(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.ngram_jaccard(table(spark, sf_dir, "documents"))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.stored_media(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.url_filter(table(spark, sf_dir, "pages"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.language(table(spark, sf_dir, "documents"))


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.best_fit_apart(table(spark, sf_dir, "documents"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.score(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.tampered_proofs(table(spark, sf_dir, "documents"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.round_trip(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.hard_negatives(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {"op1_decontaminate": op1_decontaminate, "op2_token_output": op2_token_output, "op3_ngram_jaccard": op3_ngram_jaccard, "op4_media": op4_media, "op5_quality": op5_quality, "op7_toxicity": op7_toxicity, "op6_url_filter": op6_url_filter, "op10_language": op10_language, "op8_best_fit": op8_best_fit, "op9_lm_score": op9_lm_score, "op11_merkle_manifest": op11_merkle_manifest, "op12_bpe": op12_bpe, "op13_hard_negatives": op13_hard_negatives}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": op1.ORACLE, "op11_merkle_manifest": op11.ORACLE, "op13_hard_negatives": op13.ORACLE}
