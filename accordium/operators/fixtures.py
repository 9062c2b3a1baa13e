"""The gate of a fixture: suite and contract agree, the sample has the contract's columns, its manifest is true, strata are
covered, no personal data leaks, and the suite passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import TOKEN, row_fingerprint
from . import governance, quality, sampling

FINDINGS = "level string, finding string, name string, n long"


def set_findings(suite: DataFrame, contract: DataFrame, fixture: DataFrame) -> DataFrame:
    """level, finding, name from the names of columns that a suite, a contract and a fixture have: a suite's or a fixture's
    column outside the contract is an error, a contract's column that the fixture lacks only a warning (it is stale)."""
    s, c, x = (d.select("name").distinct() for d in (suite, contract, fixture))
    parts = [(s.join(c, "name", "left_anti"), "error", "suite column not in contract"), (x.join(c, "name", "left_anti"), "error", "fixture column not in contract"), (c.join(x, "name", "left_anti"), "warning", "fixture is stale")]
    found = [d.select(F.lit(level).alias("level"), F.lit(what).alias("finding"), "name") for d, level, what in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


def content(fixture: DataFrame) -> DataFrame:
    """n_rows and the order-free hash of all columns."""
    return sampling.content_hash(fixture, row_fingerprint(*fixture.columns))


def manifest_findings(fixture: DataFrame, manifest: DataFrame, strata: DataFrame, floor: int) -> DataFrame:
    """Rows and hash against a manifest's (n_rows, h0 to h3), and strata (stratum, source, sampled): thin ones, or none at all."""
    have, want = content(fixture), manifest.select("n_rows", *(f"h{i}" for i in range(4)))
    wrong = have.join(want, "n_rows", "left_anti").select(F.lit("error").alias("level"), F.lit("rows differ from the manifest").alias("finding"), F.lit(None).cast("string").alias("name"), F.col("n_rows").alias("n"))
    changed = have.join(want, [f"h{i}" for i in range(4)], "left_anti").select(F.lit("error"), F.lit("content differs from the manifest"), F.lit(None).cast("string"), "n_rows")
    thin = sampling.thin_strata(strata, floor).select(F.lit("error"), F.lit("stratum below the floor"), F.col("stratum").cast("string"), F.col("sampled").cast("long"))
    none = strata.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("error"), F.lit("no strata are recorded"), F.lit(None).cast("string"), "n")
    return wrong.union(changed).union(thin).union(none)


def gate(fixture: DataFrame, rules: list[quality.Rule], contract: Sequence[str], manifest: DataFrame, strata: DataFrame, floor: int, guarded: Sequence[str]) -> DataFrame:
    """level, finding, name, n: everything that is wrong with a fixture. Without errors it passes.

    A suite that names columns outside the contract isn't run. Values themselves are never returned.
    """
    spark = fixture.sparkSession
    names = [spark.createDataFrame([(n,) for n in sorted(set(v))], "name string") for v in (quality.suite_columns(rules), contract, fixture.columns)]
    out = set_findings(*names).withColumn("n", F.lit(0).cast("long")).unionByName(manifest_findings(fixture, manifest, strata, floor))
    if present := [c for c in guarded if c in fixture.columns]:
        leaks = governance.leaks(fixture.select(*(F.col(c).cast("string").alias(c) for c in present)), present, TOKEN).where("leaked > 0")
        out = out.union(leaks.select(F.lit("error"), F.lit("values that aren't tokens"), "column", "leaked"))
    if not quality.suite_columns(rules) - set(contract):
        failed = quality.summary(fixture, rules).where("not success")
        out = out.union(failed.select(F.lit("error"), F.concat(F.lit("rule failed: "), F.regexp_replace("expectation", "^expect_", "")), "target", F.col("unexpected_count").cast("long")))
    return out


def passed(findings: DataFrame) -> DataFrame:
    """passed, errors, warnings."""
    return findings.agg((F.count_if(F.col("level") == "error") == 0).alias("passed"), F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings"))
