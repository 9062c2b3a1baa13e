"""A corpus pipeline of five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's
docs. All but the last return the columns of docs. Rows are judged each by its own text, whether their doc_id is null, repeated or
neither: verdicts are carried by a key of doc_id and text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accordium.llm.common import row_key, written
from accordium.llm.decontaminate import decontaminate
from accordium.llm.jaccard import ngram_jaccard
from accordium.llm.language import keep_identified
from accordium.llm.packing import best_fit
from accordium.llm.quality import keep_good
from accordium.session import table


#: Keys are broadcast up to so many (8 bytes each); beyond that Spark shuffles both sides.
BROADCAST_IDS = 2_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts 1 for."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return keep_identified(docs)


def _keyed(docs: DataFrame) -> DataFrame:
    """docs for an operator, with the row's key for its doc_id."""
    return docs.select(row_key().alias("doc_id"), "text")


def _free(docs: DataFrame) -> str:
    """A name that no column of docs has, whatever its case."""
    taken, name = {c.lower() for c in docs.columns}, "key"
    while name in taken:
        name += "_"
    return name


def _by_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """docs joined with a column of distinct keys, which are broadcast only where they are few enough."""
    name = _free(docs)
    keys = written(keys.select(F.col(keys.columns[0]).alias(name)), "keys")
    return docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys, row_key() == F.col(name), how)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents: that with the least doc_id, a null one coming last. Of rows that repeat doc_id and
    text, the first by the other columns stays (by those that can be ordered)."""
    placed = ngram_jaccard(_keyed(docs)).select(F.col("doc_id").alias("key"), "component_id")
    ids = docs.select(row_key().alias("key"), F.col("doc_id").isNull().alias("missing"), "doc_id").distinct()
    least = placed.distinct().join(ids, "key").groupBy("component_id").agg(F.min(F.struct("missing", "doc_id", "key")).alias("r"))
    kept = _by_keys(docs, least.select("r.key"), "left_semi")
    repeated = docs.groupBy("doc_id", F.xxhash64("text")).count().where("count > 1")
    if repeated.isEmpty():
        return kept
    place, rest = _free(docs), [F.col(f"`{c}`") for c, t in docs.dtypes if c not in ("doc_id", "text") and "map<" not in t and t != "variant"]
    first = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy(*rest, "doc_id"))  # Spark cuts ranks before it shuffles
    return kept.withColumn(place, first).where(F.col(place) == 1).drop(place)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontaminate(_keyed(docs), table(spark, sf_dir, "benchmark")).where("contaminated").select("doc_id").distinct()
    return _by_keys(docs, found, "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins."""
    return best_fit(docs)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontaminated), ("packing", packed)]

#: Models and packing aren't expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
