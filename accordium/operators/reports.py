"""What people look at: panels over metrics, runs of gates, listings in order, a day's rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .governance import latencies


@dataclass(frozen=True)
class Panel:
    """An aggregate over the series of one metric, by some labels or (by=None) for each series; orelse: what is shown where there is
    no series; where: which values, or which labels with which value, count."""

    title: str
    metric: str
    how: str
    by: tuple[str, ...] | None = ()
    orelse: float | None = None
    value: float | None = None
    label: tuple[str, str] | None = None


#: The dashboard's panels and the metrics that they show.
PANELS = (
    Panel("completed erasures", "erasure_completions_total", "max"),
    Panel("failing checkpoints", "ge_checkpoint_pass", "count", orelse=0, value=0),
    Panel("drifted workspaces", "terraform_drift", "sum", orelse=0),
    Panel("rejected changes", "schema_gate_rejections_total", "sum", orelse=0),
    Panel("checkpoints", "ge_checkpoint_pass", "max", by=None),
    Panel("quarantined rows", "quarantine_rows_total", "max", by=None),
    Panel("quarantined rows of the last run", "quarantine_rows_last_run", "max", by=None),
    Panel("rejections by gate", "schema_gate_rejections_total", "max", by=("gate",)),
    Panel("median latency by gate", "gate_latency_seconds", "max", by=("gate",), label=("quantile", "0.5")),
    Panel("drift by workspace", "terraform_drift", "max", by=("workspace",)),
    Panel("drifted attributes", "terraform_drift_attribute", "max", by=("workspace", "resource", "attribute")),
)


def _shown(labels: Column) -> Column:
    """Labels as text: name=value, by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e.key, F.lit("="), e.value)), ",")


def panels(metrics: DataFrame, shown: tuple[Panel, ...] = PANELS) -> DataFrame:
    """panel, labels, value of metrics (name, labels map<string, string>, value), all panels in one pass over the series.

    A label that a series lacks is an empty text. Null values count for nothing. A panel without series has no row, but where it
    says what is shown instead.
    """
    spark = metrics.sparkSession
    keep = F.array().cast("array<string>")
    rows = [(p.title, p.metric, p.how, p.by is None, list(p.by or ()), None if p.value is None else float(p.value), p.label[0] if p.label else None, p.label[1] if p.label else None) for p in shown]
    asked = F.broadcast(spark.createDataFrame(rows, "panel string, name string, how string, each boolean, by array<string>, only double, label string, is string"))  # a row for each panel
    labels = F.coalesce("labels", F.create_map().cast("map<string,string>"))
    series = metrics.where("value is not null").select("name", labels.alias("labels"), F.col("value").cast("double").alias("value")).join(asked, "name")
    series = series.where((F.col("only").isNull() | (F.col("value") == F.col("only"))) & (F.col("label").isNull() | (F.try_element_at("labels", F.col("label")) == F.col("is"))))
    chosen = F.map_from_arrays(F.coalesce("by", keep), F.transform(F.coalesce("by", keep), lambda b: F.coalesce(F.try_element_at(F.col("labels"), b), F.lit(""))))
    key = F.when(F.col("each"), _shown(F.col("labels"))).otherwise(_shown(chosen))
    found = series.select("panel", "how", key.alias("labels"), "value").groupBy("panel", "how", "labels").agg(F.max("value").alias("max"), F.sum("value").alias("sum"), F.count("value").cast("double").alias("count"))
    out = found.select("panel", "labels", F.when(F.col("how") == "max", F.col("max")).when(F.col("how") == "sum", F.col("sum")).otherwise(F.col("count")).alias("value"))
    instead = spark.createDataFrame([(p.title, "", float(p.orelse)) for p in shown if p.orelse is not None], "panel string, labels string, value double")
    return out.unionByName(instead.join(out.select("panel").distinct(), "panel", "left_anti"))


def gate_runs(runs: DataFrame, fast: str = "(?i)fast path") -> DataFrame:
    """gate, runs, rejections, full_checks, p50, p90 of runs(gate, status, conclusion, started, completed, steps array of (name,
    conclusion)): runs that are completed with success or failure; failures are rejections.

    Latencies, in seconds, are those of full checks: a run with both times in which no step that succeeded is named like `fast`.
    All of them count. A gate without any has null latencies.
    """
    done = runs.where("status = 'completed' and conclusion in ('success', 'failure')")
    counts = done.groupBy("gate").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("conclusion") == "failure").alias("rejections"))
    short = F.coalesce(F.exists("steps", lambda s: F.coalesce(s["name"].rlike(fast) & (s.conclusion == "success"), F.lit(False))), F.lit(False))
    full = done.where(F.col("started").isNotNull() & F.col("completed").isNotNull() & ~short).select("gate", (F.unix_micros(F.col("completed").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))).alias("us"))
    took = latencies(full.select("gate", (F.col("us") / 1e6).alias("s")), "gate", "s").select(F.col("gate").alias("of"), F.col("runs").alias("full_checks"), "p50", "p90")
    joined = counts.join(took, F.col("gate").eqNullSafe(F.col("of")), "left")
    return joined.select("gate", "runs", "rejections", F.coalesce("full_checks", F.lit(0)).alias("full_checks"), "p50", "p90")


def on_day(c: Column, day: date) -> Column:
    """Whether a time is on a day (UTC), as a range that reaches the scan of a timestamp column."""
    first, after = (F.lit(d.isoformat()).cast("timestamp_ntz") for d in (day, day + timedelta(days=1)))
    return (c >= first) & (c < after)


def ms_on_day(c: Column, day: date) -> Column:
    """The same for milliseconds since 1970."""
    start = (day - date(1970, 1, 1)).days * 86_400_000
    return (c >= start) & (c < start + 86_400_000)


def quarantine_listing(rows: DataFrame, key: str) -> DataFrame:
    """Quarantined rows in order of run and key, each with the rules it broke as one text."""
    broken = F.array_join(F.transform("expectation", lambda e: F.regexp_replace(e, "^(expect_)?column_", "")), "; ")
    return rows.orderBy(F.asc_nulls_first("run_ts"), F.asc_nulls_first(key)).select(key, "run_ts", "source_version", "checkpoint_id", broken.alias("broken"))


def audit_listing(audit: DataFrame) -> DataFrame:
    """Audit records in order of completion: request, whether it is the first of its subject or which one it repeats, rows, verdict."""
    kind = F.when(F.col("rerun_of").isNull(), "primary").otherwise(F.concat(F.lit("rerun of "), F.col("rerun_of")))
    return audit.orderBy(F.asc_nulls_first("completed_ts"), "request_id").select("request_id", "completed_ts", kind.alias("kind"), "rows_deleted", (F.coalesce("verified_lake", F.lit(False)) & F.coalesce("verified_crypto", F.lit(False))).alias("verified"))


def numbered(history: DataFrame, subject: str, *order: str) -> DataFrame:
    """history with n, each subject's rows counted from 1 in their order, and file, the name of such a version (v0001)."""
    n = F.row_number().over(Window.partitionBy(subject).orderBy(*order)).cast("long")
    return history.withColumn("n", n).withColumn("file", F.format_string("v%04d", "n"))


def first_places(uses: DataFrame, by: str, path: str, line: str, most: int = 3) -> DataFrame:
    """by, locations: the first few places (path:line) of a use, in their order; Spark cuts ranks before it shuffles."""
    ranked = uses.select(by, path, line).distinct().withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy(path, line))).where(F.col("__r") <= most)
    held = ranked.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(path).alias("p"), F.col(line).alias("l")))).alias("x"))
    return held.select(by, F.array_join(F.transform("x", lambda x: F.concat(x.p.cast("string"), F.lit(":"), x.l.cast("string"))), ",").alias("locations"))
