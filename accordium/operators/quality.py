"""Expectation suites compiled to Spark: counts of violations in one aggregate, offending rows, samples.

A rule's predicate is true for the rows it doesn't expect. Nulls are only unexpected for not_null; NaN counts as null.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = "expect_"


@dataclass(frozen=True)
class Rule:
    """One expectation: its type and arguments; ordinal is its place in the suite."""

    ordinal: int
    kind: str
    kwargs: dict = field(hash=False)

    @property
    def columns(self) -> list[str]:
        return [self.kwargs[k] for k in ("column", "column_A", "column_B") if k in self.kwargs] + list(self.kwargs.get("column_list", []))

    @property
    def target(self) -> str:
        return ",".join(self.columns) or "(table)"

    @property
    def label(self) -> str:
        return f"{self.kind.removeprefix(PREFIX)}({self.target})"


def load_suite(doc: dict) -> list[Rule]:
    """Rules of a parsed suite; a suite without a name or without expectations is refused."""
    if not doc.get("expectation_suite_name"):
        raise ValueError("suite has no name")
    if not doc.get("expectations"):
        raise ValueError("suite has no expectations")
    return [Rule(i, e["expectation_type"], dict(e.get("kwargs", {}))) for i, e in enumerate(doc["expectations"])]


def suite_columns(rules: list[Rule]) -> set[str]:
    return {c for r in rules for c in r.columns}


def _value(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        raise ValueError(f"column {name} is missing")
    c = F.col(f"`{name}`")
    return F.when(~F.isnan(c), c) if dict(df.dtypes)[name] in ("double", "float") else c


def unexpected(df: DataFrame, rule: Rule) -> Column | None:
    """The rule's predicate over df; None for a rule about the table. For unique it reads a column that _counted() adds."""
    k, a = rule.kind.removeprefix(PREFIX), rule.kwargs
    if k == "table_row_count_to_be_between":
        return None
    if k == "column_pair_values_a_to_be_greater_than_b":
        x, y = _value(df, a["column_A"]), _value(df, a["column_B"])
        return x.isNotNull() & y.isNotNull() & ~((x >= y) if a.get("or_equal") else (x > y))
    c = _value(df, a["column"])
    if k == "column_values_to_not_be_null":
        return c.isNull()
    if k == "column_values_to_be_unique":
        return F.col(_mark(rule)).isNotNull() if _mark(rule) in df.columns else F.lit(False)
    if k == "column_values_to_match_regex":
        try:  # at run time a wrong pattern would stop the other rules too
            df.sparkSession._jvm.java.util.regex.Pattern.compile(a["regex"])
        except IllegalArgumentException as e:
            raise ValueError(f"invalid regex: {str(e).splitlines()[0]}") from e
        wrong = ~c.rlike(a["regex"])
    elif k == "column_values_to_be_between":
        ends = ([c < a["min_value"]] if a.get("min_value") is not None else []) + ([c > a["max_value"]] if a.get("max_value") is not None else [])
        wrong = reduce(lambda p, q: p | q, ends, F.lit(False))
    elif k == "column_value_lengths_to_equal":
        wrong = F.length(c) != a["value"]
    elif k == "column_values_to_be_in_set":
        wrong = ~c.isin(*a["value_set"])
    else:
        raise ValueError(f"unknown expectation {rule.kind}")
    return F.coalesce(wrong, F.lit(False))


def _mark(rule: Rule) -> str:
    return f"__repeated_{rule.ordinal}"


def _counted(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """df with a mark for each uniqueness rule: null but where the value occurs again. Values are counted with partial sums and
    only the repeated ones are joined back, so that a frequent value isn't sorted in one task."""
    for r in rules:
        if r.kind == "expect_column_values_to_be_unique" and r.kwargs.get("column") in df.columns:
            c = _value(df, r.kwargs["column"])
            again = df.select(c.alias("__v")).where("__v is not null").groupBy("__v").agg(F.count(F.lit(1)).alias(_mark(r))).where(F.col(_mark(r)) > 1)
            df = df.join(again, c == F.col("__v"), "left").drop("__v")
    return df


def _compiled(df: DataFrame, rules: list[Rule]) -> tuple[list[tuple[Rule, Column | None]], list[tuple[Rule, str]]]:
    """Rules with their predicates, and those that can't be evaluated with the reason: they fail, and don't stop the others."""
    good, bad = [], []
    for r in rules:
        try:
            p = unexpected(df, r)
            if p is not None:
                df.select(p).schema  # noqa: B018  analysis only
            good.append((r, p))
        except (ValueError, KeyError, AnalysisException) as e:
            bad.append((r, str(e)[:200]))
    return good, bad


def summary(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """ordinal, expectation, target, success, unexpected_count, error: one row for each rule.

    All row rules and the row count are one aggregate; each uniqueness rule is a grouped count of its key, so no window sorts
    the table.
    """
    good, bad = _compiled(df, rules)
    unique = [r for r, _ in good if r.kind == "expect_column_values_to_be_unique"]
    plain = [(r, p) for r, p in good if r not in unique]
    spark = df.sparkSession
    aggs = [F.count(F.lit(1)) if p is None else F.count_if(p) for _, p in plain]
    parts = []
    if plain:
        one = df.agg(*(a.alias(f"r{r.ordinal}") for (r, _), a in zip(plain, aggs, strict=True)))
        parts.append(one.select(F.explode(F.array(*(F.struct(F.lit(r.ordinal).alias("ordinal"), F.col(f"r{r.ordinal}").alias("n")) for r, _ in plain))).alias("x")).select("x.ordinal", "x.n"))
    for r in unique:
        c = _value(df, r.kwargs["column"])
        groups = df.where(c.isNotNull()).groupBy(c.alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit(r.ordinal).alias("ordinal"), "n"))
    names = spark.createDataFrame([(r.ordinal, r.kind, r.target, r.kwargs.get("min_value") if p is None and r in dict((x.ordinal, x) for x, _ in plain).values() else None, r.kwargs.get("max_value") if p is None else None, p is None and r not in unique) for r, p in good], "ordinal int, expectation string, target string, low long, high long, counts boolean") if good else None
    out = None
    if parts:
        counts = reduce(DataFrame.unionByName, parts)
        fits = (F.col("n") >= F.coalesce("low", F.lit(0))) & (F.col("n") <= F.coalesce("high", F.col("n")))
        found = counts.join(F.broadcast(names), "ordinal")
        out = found.select("ordinal", "expectation", "target", F.when(F.col("counts"), fits).otherwise(F.col("n") == 0).alias("success"), F.when(F.col("counts"), 0).otherwise(F.col("n")).cast("long").alias("unexpected_count"), F.lit(None).cast("string").alias("error"))
    if bad:
        failed = spark.createDataFrame([(r.ordinal, r.kind, r.target, False, 0, e) for r, e in bad], "ordinal int, expectation string, target string, success boolean, unexpected_count long, error string")
        out = failed if out is None else out.unionByName(failed)
    return out


def verdict(results: DataFrame) -> DataFrame:
    return results.agg(F.bool_and("success").alias("passed"), F.count_if(~F.col("success")).alias("failed"))


def table_failures(results: DataFrame) -> DataFrame:
    """Failed rules that name no row, with the error where there was one."""
    label = F.concat(F.regexp_replace("expectation", "^expect_", ""), F.lit("("), "target", F.lit(")"))
    return results.where("not success and unexpected_count = 0").select("ordinal", F.concat(label, F.coalesce(F.concat(F.lit(" [error: "), "error", F.lit("]")), F.lit(""))).alias("label"))


def offending(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that break a rule, with the labels of those rules in suite order in `expectation`. An empty table gives none."""
    columns = df.columns
    df = _counted(df, rules)
    good, _ = _compiled(df, rules)
    preds = [(r, p) for r, p in good if p is not None]
    if not preds:
        return df.select(*columns).withColumn("expectation", F.array().cast("array<string>")).where(F.lit(False))
    labels = F.array(*(F.when(p, F.lit(r.label)) for r, p in preds))
    return df.withColumn("expectation", F.filter(labels, lambda x: x.isNotNull())).where(F.size("expectation") > 0).select(*columns, "expectation")


def samples(df: DataFrame, rules: list[Rule], size: int = 5) -> DataFrame:
    """ordinal, label, sample: the least distinct unexpected values of each rule over one column, `size` at most."""
    df = _counted(df, rules)
    good, _ = _compiled(df, rules)
    parts = []
    for r, p in good:
        if p is not None and "column" in r.kwargs:
            v = df.where(p).select(F.col(r.kwargs["column"]).cast("string").alias("v")).distinct().orderBy("v").limit(size)
            parts.append(v.agg(F.concat_ws("|", F.sort_array(F.collect_list("v"))).alias("sample")).select(F.lit(r.ordinal).alias("ordinal"), F.lit(r.label).alias("label"), "sample"))
    if not parts:
        return df.sparkSession.createDataFrame([], "ordinal int, label string, sample string")
    return reduce(DataFrame.unionByName, parts)


def validate(df: DataFrame, rules: list[Rule], result_format: str = "SUMMARY", engine: str = "spark") -> tuple[DataFrame, DataFrame | None]:
    """The summary with samples; with COMPLETE the offending rows too. Other formats and engines are refused."""
    if engine != "spark":
        raise NotImplementedError(f"engine {engine}")
    if result_format not in ("SUMMARY", "COMPLETE"):
        raise ValueError(f"result format {result_format}")
    found = summary(df, rules).join(F.broadcast(samples(df, rules).select("ordinal", "sample")), "ordinal", "left")  # a row for each rule
    return found, offending(df, rules) if result_format == "COMPLETE" else None
