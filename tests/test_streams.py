"""State and idempotence of streams over batches, restarts and replays."""

from pyspark.sql import functions as F

from accordium.plans.queries import rule, suite
from accordium.session import scratch
from accordium.streaming import nonces
from accordium.streaming import quarantine as qs

OUT = "row string, key_id string, nonce string, first string, refused boolean"


def test_nonce_guard(spark):
    root = scratch(spark)
    uses = lambda rows: spark.createDataFrame(rows, "row string, key_id string, nonce string, first string").write.mode("append").parquet(f"{root}/in")
    stream = lambda: spark.readStream.schema("row string, key_id string, nonce string, first string").parquet(f"{root}/in")
    read = lambda: {r.row: (r.first, r.refused) for r in spark.read.schema(OUT).parquet(f"{root}/out").collect()}
    uses([("b", "k1", "n", "x"), ("a", "k1", "n", "x"), ("c", "k2", "n", "x"), ("d", None, "n", "x"), ("e", "k1", None, "x"), ("f", "k1", "m", "x")])
    nonces.guard_once(stream(), f"{root}/out", f"{root}/state")
    first = {"a": ("a", False), "b": ("a", True), "c": ("c", False), "d": (None, True), "e": (None, True), "f": ("f", False)}
    assert read() == first
    uses([("0", "k1", "n", "x"), ("g", "k3", "n", "x"), ("h", "k1", "m", "x")] + [(f"z{i}", "hot", str(i % 150), "x") for i in range(300)])
    nonces.guard_once(stream(), f"{root}/out", f"{root}/state")
    got = read()
    assert {k: v for k, v in got.items() if k[0] != "z"} == first | {"0": ("a", True), "g": ("g", False), "h": ("f", True)}
    assert sum(refused for k, (_, refused) in got.items() if k[0] == "z") == 150
    nonces.guard_once(stream(), f"{root}/out", f"{root}/state")
    assert read() == got  # nothing new, nothing judged again


def test_replayed_batch_adds_nothing(spark):
    rules = suite(rule("column_values_to_be_between", column="v", max_value=10), rule("column_values_to_be_unique", column="k"), rule("table_row_count_to_be_between", min_value=3))
    root = scratch(spark)
    schema = "k long, v long"

    def feed(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/in")

    def run():
        qs.quarantine_once(spark.readStream.schema(schema).parquet(f"{root}/in"), rules, f"{root}/out", f"{root}/state", {"dataset": "d"})
        rows = qs.kept(spark, f"{root}/out", qs.rows_schema(spark.createDataFrame([], schema).schema))
        return sorted((r.batch, r.k, r.v, tuple(r.expectation)) for r in rows.collect())

    between, unique = "column_values_to_be_between(v)", "column_values_to_be_unique(k)"
    feed((1, 11), (2, 5), (2, 6), (None, 3))
    first = run()
    assert first == [(0, 1, 11, (between,)), (0, 2, 5, (unique,)), (0, 2, 6, (unique,))]
    feed((1, 11), (3, 12), (3, 12))  # the first is stored already; the equal ones are both new
    second = run()
    assert second == sorted([*first, (1, 3, 12, (between, unique)), (1, 3, 12, (between, unique))])
    assert qs.forget_commit(spark, f"{root}/state") == 1
    assert run() == second
    results = {(r.batch, r.ordinal): (r.success, r.unexpected_count) for r in qs.results(spark, f"{root}/out").collect()}
    assert results == {(0, 0): (False, 1), (0, 1): (False, 2), (0, 2): (True, 0), (1, 0): (False, 3), (1, 1): (False, 2), (1, 2): (True, 0)}


def test_nothing_is_kept_yet(spark):
    assert qs.kept(spark, scratch(spark), qs.rows_schema(spark.range(1).schema)).count() == 0


def test_uses_of_encrypted_values(spark):
    df = spark.createDataFrame([(1, "enc:v1:abc:def", 5), (2, "plain", 5), (3, None, 5)], "id long, c string, key long")
    assert [tuple(r) for r in nonces.encrypted_uses(df, "id", "c", "key").collect()] == [("1", "5", "abc")]
    assert nonces.encrypted_uses(df.where(F.lit(False)), "id", "c", "key").count() == 0
