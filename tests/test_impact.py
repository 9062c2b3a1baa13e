"""Who is affected by a removed field, and who blocks it."""

from accordium.operators import governance as gov
from accordium.plans import contracts

USAGE, DIFF = "consumer string, dataset string, name string, line int", "dataset string, name string, type string, change string"


def test_uses_that_cannot_be_told_count_for_all(spark):
    usage = spark.createDataFrame([("star", "d", "*", 1), ("dynamic", "d", None, 2), ("f", "d", "f", 3), ("other", "d", "g", 4), ("else", "e", None, 5), (None, "d", "*", 6), ("f", "d", "f", 7)], USAGE)
    diff = spark.createDataFrame([("d", "f", "int", "removed"), ("d", "f2", "int", "removed"), ("d", "n", "int", "added"), ("d", "t", "int", "changed")], DIFF)
    hits = gov.affected(usage, diff)
    assert sorted(tuple(r) for r in hits.collect()) == sorted([(c, "d", f) for c in ("star", "dynamic") for f in ("f", "f2")] + [("f", "d", "f")])
    acks = spark.createDataFrame([("star", "*", "7"), ("dynamic", "f", "7"), ("f", "f", "8")], "consumer string, field string, change string")
    blocked = lambda *a, **k: sorted((r.consumer, r.field) for r in gov.blocking(hits, *a, **k).collect())
    assert blocked(acks, "7") == [("dynamic", "f2"), ("f", "f")]
    registered = spark.createDataFrame([("star", "d"), ("f", "e"), ("f", "e"), ("dynamic", "d")], "consumer string, dataset string")
    assert blocked(acks, "7", registered) == [("dynamic", "f2")]
    warned = gov.unregistered(hits, registered)
    assert [tuple(r) for r in warned.collect()] == [("f", "d", "f")]
    verdict = gov.impact_verdict(diff, hits, gov.blocking(hits, acks, "7", registered), warned).collect()
    assert [r.asDict() for r in verdict] == [{"dataset": "d", "removed": 2, "retyped": 1, "affected": 5, "blocking": 1, "warned": 1, "passed": False}]
    assert gov.affected(usage.limit(0), diff).count() == 0 and gov.affected(usage, diff.limit(0)).count() == 0


def test_lint_of_missing_values():
    good = {"subject": "a-value", "schema": "a.avsc", "owner": "x", "compatibility": "BACKWARD", "delta_path": "s3a://l/a"}
    bare = {"owner": "x", "compatibility": "BACKWARD", "schema": "b.avsc", "delta_path": "s3a://l/b"}
    found = contracts.lint({"a": good, "b": bare, "c": bare | {"schema": "c.avsc", "delta_path": "s3a://l/c"}})
    assert ("b", "subject is missing") in found and not any("also that of" in f for _, f in found)


def test_uses_as_bits_are_the_rows(spark):
    """Blocks of many fields, names in two datasets, a null name, acks of single fields and of all."""
    fields = [(f"d{i % 2}", f"f{i // 2 % 400}" if i else None, "int", "removed") for i in range(700)] + [("e", "f1", "int", "removed"), (None, "f1", "int", "removed"), ("d0", "kept", "int", "changed")]
    uses = [(c, d, "*" if c % 3 == 0 else None if c % 3 == 1 and d == "d0" else f"f{c * 7 % 400}", c) for c in range(20) for d in ("d0", "d1", "e")] + [(2, "d0", "*", 0), (1, None, "*", 0), (1, "e", "f1", 0), (1, "e", "f1", 1)]
    acks = [(0, "*"), (3, "f5"), (3, "f5"), (3, "f9"), (4, "f1"), (1, "f1"), (2, "none"), (6, None), (19, f"f{19 * 7}")]
    hits = gov.impact(spark.createDataFrame(uses, USAGE.replace("consumer string", "consumer int")), spark.createDataFrame(fields, DIFF))
    gone = {(d, f) for d, f, _, change in fields if change == "removed"}
    want = {(c, d, f) for c, d, name, _ in uses for e, f in gone if d and d == e and name in ("*", None, f)}
    kept = {(c, d, f) for c, d, f in want if (f is None or (c, f) not in acks) and (c, "*") not in acks}  # no ack is of a null name
    acks = spark.createDataFrame(acks, "consumer int, field string")

    def rows(found):
        got = [tuple(r) for r in found.rows().collect()]
        assert len(got) == len(set(got)) == sum(r.n for r in found.count("dataset", "n").collect())
        return set(got)

    assert len(want) > 5000 and rows(hits) == want
    assert rows(gov.blocking(hits, acks)) == kept and rows(hits.acked(acks)) == want - kept
    assert {tuple(r) for r in gov.blocking(hits.rows(), acks).select("consumer", "dataset", "field").collect()} == kept
    registered = spark.createDataFrame([(c, d) for c in range(0, 20, 2) for d in ("d0", "e")] + [(0, "e")], "consumer int, dataset string")
    assert rows(gov.blocking(hits, acks, registered=registered)) == {x for x in kept if x[0] % 2 == 0 and x[1] != "d1"}
    assert rows(gov.unregistered(hits, registered)) == {x for x in want if x[0] % 2 or x[1] == "d1"}


def test_uses_are_counted_without_a_row_each(spark):
    """200 million uses: 4,000 consumers of all of a dataset of 50,000 removed fields."""
    usage = spark.range(4_000).selectExpr("id as consumer", "'d' as dataset", "'*' as name")
    diff = spark.range(50_000).selectExpr("'d' as dataset", "cast(id as string) as name", "'int' as type", "'removed' as change")
    hits = gov.impact(usage, diff)
    acks = usage.where("consumer % 4 = 0").selectExpr("consumer", "'*' as field").union(spark.createDataFrame([(1, "17")], "consumer long, field string"))
    verdict = gov.impact_verdict(diff, hits, gov.blocking(hits, acks)).first()
    assert (verdict.affected, verdict.blocking) == (200_000_000, 150_000_000 - 1)
    assert hits.acked(acks).count("consumer", "n").where("consumer < 3").orderBy("consumer").collect() == [(0, 50_000), (1, 1)]
