"""Ranks found by counts against sorting, with small bounds so that several passes are made."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from accordium.operators import governance, ranks, sampling


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [3, 4_096])
def test_sample_is_the_least_hashes(spark, monkeypatch, few):
    monkeypatch.setattr(ranks, "FEW", few)
    monkeypatch.setattr(ranks, "DIGITS", 1 if few == 3 else 3)
    rows = [(i, "hot" if i % 3 else None if i % 5 == 0 else f"s{i % 7}") for i in range(1_500)] + [(9_000, "lone"), (9_001, "two"), (9_002, "two"), (None, "two")]
    df = spark.createDataFrame(rows, "k long, s string").withColumn("n", F.lit(1)).withColumn("prefix", F.lit("x"))
    got = sampling.stratified(df, "s", "k", 0.05, 4, "seed")
    want = []
    for s in {s for _, s in rows}:
        n = sum(x == s for _, x in rows)
        keys = sorted((hashlib.sha256(f"seed{k}".encode()).hexdigest(), k) for k, x in rows if x == s and k is not None)
        want += [k for _, k in keys[: min(n, max(4, int(n * 0.05 + 0.5)))]]
    assert sorted(r.k for r in got.collect()) == sorted(want) and got.columns == df.columns
    assert "Window" not in plan(got)


def test_sample_of_repeated_keys(spark, monkeypatch):
    """As many rows as asked, also where all have the same key."""
    monkeypatch.setattr(ranks, "FEW", 10)
    df = spark.range(2_000).select(F.lit(7).alias("k"), F.when(F.col("id") < 1_900, "a").otherwise("b").alias("s"), "id")
    got = sampling.stratified(df, "s", "k", 0.1, 5)
    assert {r.s: r["count"] for r in got.groupBy("s").count().collect()} == {"a": 190, "b": 10} and got.select("id").distinct().count() == 200
    mixed = df.withColumn("k", F.when(F.col("id") % 2 == 0, F.col("id").cast("int")).otherwise(7))
    got = sampling.stratified(mixed, "s", "k", 0.9, 5)
    assert {r.s: r["count"] for r in got.groupBy("s").count().collect()} == {"a": 1_710, "b": 90}
    assert sampling.stratified(df.limit(0), "s", "k", 0.1, 5).count() == 0


@pytest.mark.parametrize(("few", "splits"), [(5, 3), (4_096, 32)])
def test_order_statistics(spark, monkeypatch, few, splits):
    monkeypatch.setattr(ranks, "FEW", few)
    monkeypatch.setattr(ranks, "SPLITS", splits)
    rng = random.Random(1)
    groups = {"normal": [rng.gauss(0, 1) for _ in range(3_000)], "ties": [1.0] * 900 + [2.0] * 5 + [-3.0] * 40, "wide": [10.0 ** rng.randrange(-300, 300) for _ in range(400)], "one": [4.5], None: [float(x) for x in range(77)], "inf": [float("-inf")] * 3 + [1.0, float("inf")], "none": [None, float("nan")]}
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values] + [("normal", None), ("ties", float("nan"))], "by string, value double").withColumn("k", F.lit(1)).repartition(5)
    n = F.col("runs")
    got = ranks.order_statistics(df, "by", "value", {"least": F.lit(0), "third": F.lit(3), "half": F.ceil(n / 2), "most": n + 5})
    want = {}
    for g, values in groups.items():
        clean = sorted(v for v in values if v is not None and v == v)
        if clean:
            want[g] = (len(clean), clean[0], clean[min(3, len(clean)) - 1], clean[(len(clean) + 1) // 2 - 1], clean[-1])
    assert {r.by: (r.runs, r.least, r.third, r.half, r.most) for r in got.collect()} == want
    assert "Window" not in plan(got)
    assert ranks.order_statistics(df.limit(0), "by", "value", {"x": n}).count() == 0


def test_latencies_of_whole_numbers(spark):
    df = spark.range(1, 1_001).select((F.col("id") % 2).alias("type"), "id")
    got = {r.type: (r.runs, r.p50, r.p25, r.p90) for r in governance.latencies(df, "type", "id", (0.25, 0.9)).collect()}
    assert got == {0: (500, 501.0, 250, 900), 1: (500, 500.0, 249, 899)}


def test_hash_by_order(spark):
    """The same for any partitioning, another where two rows change places."""
    rows = [(i, f"v{i}") for i in range(500)] + [(None, "n"), (7, "again"), (7, "again")]
    df = spark.createDataFrame(rows, "k long, f string")

    def digest(df, run=8):
        return tuple(sampling.ordered_hash(df, ["k"], F.col("f"), run).first())

    level = [f for _, _, f in sorted((k is not None, k or 0, f) for k, f in rows)]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i : i + 8]).encode()).hexdigest() for i in range(0, len(level), 8)]
    assert digest(df) == digest(df.repartition(7)) == digest(df.orderBy(F.desc("k")).coalesce(1)) == (503, level[0])
    swapped = df.withColumn("f", F.when(F.col("k") == 100, "v101").when(F.col("k") == 101, "v100").otherwise(F.col("f")))
    assert digest(swapped)[1] != level[0] and digest(df, 1024)[1] != level[0]
    assert digest(df.limit(0)) == (0, hashlib.sha256(b"").hexdigest()) and digest(df.where("k = 3")) == (1, hashlib.sha256(b"v3").hexdigest())
    assert digest(df.withColumn("f", F.lit(None).cast("string")).where("k = 3"))[1] == hashlib.sha256(b"").hexdigest()


def test_hash_by_order_of_two_levels(spark):
    """However many runs there are, the second level is the last, as in the query's SQL."""
    df = spark.range(503).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("f"))

    def sha(texts):
        return hashlib.sha256("".join(texts).encode()).hexdigest()

    def digest(df, depth):
        return tuple(sampling.ordered_hash(df, ["k"], F.col("f"), 8, depth).first())

    rows = [f"v{i}" for i in range(503)]
    runs = [sha(rows[i : i + 8]) for i in range(0, 503, 8)]
    assert digest(df, 2) == digest(df.repartition(7), 2) == (503, sha(runs))
    assert digest(df, 3) == (503, sha(sha(runs[i : i + 8]) for i in range(0, 63, 8)))
    assert digest(df, 4) == digest(df, None) and digest(df.where("k < 60"), 2) == digest(df.where("k < 60"), None)
    assert digest(df.limit(0), 2) == (0, sha([])) and digest(df.where("k = 3"), 2) == (1, sha(["v3"]))
