"""Exact samples for each stratum, their report, and content hashes: order-free, and by order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .ranks import least_by_hash


def target_rows(n: Column, fraction: float, floor: int) -> Column:
    """min(n, max(floor, n * fraction rounded half up))."""
    return F.least(n, F.greatest(F.lit(floor), F.floor(n * fraction + 0.5)))


def stratified(df: DataFrame, stratum: str, key: str, fraction: float, floor: int, seed: str = "") -> DataFrame:
    """A sample without replacement of exact size in each stratum, null being one; rows are chosen by the sha256 of seed and key.

    The last hash that is taken is found by counts of hash prefixes (ranks.least_by_hash), so that no stratum is sorted, however
    hot. Of rows that repeat a key any are taken; a null key never is. Columns that start with two underscores are reserved.
    """
    order = F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256)
    return least_by_hash(df, stratum, order, target_rows(F.col("__rank_n"), fraction, floor))


def report(df: DataFrame, sample: DataFrame, stratum: str, fraction: float) -> DataFrame:
    """stratum, source, sampled, bernoulli_miss: the chance that plain sampling loses the stratum."""
    source = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("source"))
    taken = sample.groupBy(stratum).agg(F.count(F.lit(1)).alias("sampled"))
    return source.join(taken, stratum, "left").select(F.col(stratum).alias("stratum"), "source", F.coalesce("sampled", F.lit(0)).cast("long").alias("sampled"), F.round(F.pow(F.lit(1 - fraction), F.col("source")), 6).alias("bernoulli_miss"))


def thin_strata(counts: DataFrame, floor: int) -> DataFrame:
    """Strata of a report of which fewer than `floor` rows, and not all, were taken, or none."""
    return counts.where((F.col("sampled") < F.least(F.lit(floor), F.col("source"))) | (F.col("sampled") == 0)).select("stratum", "source", "sampled")


def content_hash(df: DataFrame, fingerprint: Column) -> DataFrame:
    """Rows, and sums over four 8-digit pieces of the rows' fingerprints as text: the same for any order, and mergeable. Sums are
    decimals of 38 digits, which no number of rows overflows."""
    f = df.select(fingerprint.alias("f"))
    return f.agg(F.count(F.lit(1)).alias("n_rows"), *(F.coalesce(F.sum(F.conv(F.substring("f", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").cast("string").alias(f"h{i}") for i in range(4)))


def _hash_of_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row, f: the sha256 of the texts of a sorted partition, of which only a batch is held at once."""
    digest = hashlib.sha256()
    for batch in batches:
        digest.update("".join(batch.column("f").to_pylist()).encode())
    yield pa.RecordBatch.from_arrays([pa.array([digest.hexdigest()])], names=["f"])


def ordered_hash(df: DataFrame, keys: list[str], fingerprint: Column, run: int = 1024, depth: int | None = None) -> DataFrame:
    """n_rows and hash: a sha256 that depends on the rows' order by keys (nulls first), and on nothing else.

    Rows are numbered in order over ranges of partitions; the fingerprints of each run of rows are hashed in order, so are the
    hashes of each run of runs, until one is left. Runs are aligned to numbers, not partitions: any partitioning gives the same,
    runs can be kept and compared to find where two tables differ, and no task sees more than `run` of them. Rows that are equal
    in all keys stand in order of their fingerprints. A null fingerprint counts as an empty text. No rows give the hash of nothing.

    Where a depth is named, the hash is that of a tree of at most so many levels (2 at least): the last takes all that is left as one
    run, whose hashes (one for `run` ** (depth - 1) rows) go through one task in order, a batch at a time.
    """
    if depth is not None and depth < 2:
        raise ValueError("a depth must be 2 at least")
    order = [F.col(f"`{k}`") for k in keys]
    rows = df.select(*(c.alias(f"k{i}") for i, c in enumerate(order)), F.coalesce(fingerprint, F.lit("")).alias("f")).withColumn("n", F.monotonically_increasing_id())
    by = [*(f"k{i}" for i in range(len(keys))), "f", "n"]  # the number splits equal rows over ranges
    placed = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).select("f").withColumn("at", F.monotonically_increasing_id()))
    parts = placed.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("low"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition of a job
    starts = parts.select("part", "low", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    level = placed.join(F.broadcast(starts), F.shiftright("at", 33) == F.col("part")).select((F.col("base") + F.col("at") - F.col("low")).alias("i"), "f")
    n = placed.count()
    left, levels = max(n, 2), 0  # a single row is hashed once
    while left > 1:
        levels += 1
        if levels == depth and left > run:
            level = level.repartition(1).sortWithinPartitions("i").select("f").mapInArrow(_hash_of_all, "f string")
            break
        runs = level.groupBy(F.floor(F.col("i") / run).alias("i")).agg(F.array_sort(F.collect_list(F.struct("i", "f"))).alias("x"))
        level = written(runs.select("i", F.sha2(F.array_join(F.transform("x", lambda r: r.f), ""), 256).alias("f")))
        left = -(-left // run)
    return level.agg(F.lit(n).cast("long").alias("n_rows"), F.coalesce(F.max("f"), F.sha2(F.lit(""), 256)).alias("hash"))
