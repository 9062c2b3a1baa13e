"""Decisions over metadata tables: names that look personal, classification changes, field diffs, impact, lineage drift,
drift reverts, metrics and alerts. Every one is a join or an aggregate of DataFrames."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .impact import Impact, impact
from .ranks import order_statistics

#: Ranks of classes and of treatments; tokens and encryption are equal.
CLASS_RANK = {"NOT_PII": 0, "QUASI_IDENTIFIER": 1, "DIRECT_IDENTIFIER": 2}
TREATMENT_RANK = {"NONE": 0, "TOKENIZE_HMAC": 1, "ENCRYPT_AESGCM": 1}

#: Patterns that are held by every task.
MOST_PATTERNS = 100_000


def required_text(pattern: str) -> str:
    """The longest piece of text, in lower case, that whatever matches a regular expression must hold; empty where none can be told.

    Only what stands outside of groups and classes counts, without letters that a quantifier may drop; an alternative at the top, a
    mode that changes how the expression is read, or quoting give none.
    """
    if re.search(r"\(\?[a-zA-Z]*[xu-]|\\Q", pattern):
        return ""
    runs, run, i, depth = [], "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            following = pattern[i + 1 : i + 2]
            i += 1
            if depth == 0:
                run, done = (run + following, None) if following and not following.isalnum() else ("", run)
                runs += [done] if done else []
        elif c == "[":
            end = i + 1 + (pattern[i + 1 : i + 2] == "^")
            end += pattern[end : end + 1] == "]"
            level = 1
            while end < len(pattern) and level:
                level += {"[": 1, "]": -1}.get(pattern[end], 0)
                end += 1 + (pattern[end] == "\\")
            i = end - 1
            runs, run = [*runs, run], ""
        elif c in "()":
            depth += 1 if c == "(" else -1
            runs, run = [*runs, run], ""
        elif depth:
            pass
        elif c == "|":
            return ""
        elif c in "?*{":
            runs, run = [*runs, run[:-1]], ""
            i = pattern.find("}", i) if c == "{" and "}" in pattern[i:] else i
        elif c in "+.^$":
            runs, run = [*runs, run], ""
        else:
            run += c
        i += 1
    best = max([*runs, run], key=len)
    return best.translate(_LOWER) if best.isascii() else ""


_LOWER = {c: c + 32 for c in range(65, 91)}


def _candidates(texts: list[tuple[int, str]]):
    """(name) to (name, at): places of the patterns whose required text occurs in a name, found by one automaton for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton, always = ahocorasick.Automaton(), [i for i, t in texts if not t]
        held: dict[str, list[int]] = {}
        for i, t in texts:
            if t:
                held.setdefault(t, []).append(i)
        for t, places in held.items():
            automaton.add_word(t, places)
        if held:
            automaton.make_automaton()
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                hit = set(always)
                for _, places in automaton.iter(name.translate(_LOWER)) if held else ():
                    hit.update(places)
                found.append(sorted(hit))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["name", "at"])

    return run


def suspicious(fields: DataFrame, patterns: DataFrame) -> DataFrame:
    """fields(table, name) and the first pattern (ord, pattern) found in the name, case of A-Z not minded.

    Distinct names go once through an automaton of the texts that the patterns require; only the patterns that it leaves are tried as
    regular expressions. Patterns are a rule file: up to MOST_PATTERNS, an error beyond. Null names and patterns match nothing.
    """
    rules = [(r.ord, r.pattern) for r in patterns.where("pattern is not null").select("ord", "pattern").orderBy("ord", "pattern").limit(MOST_PATTERNS + 1).collect()]
    if len(rules) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns")
    spark = fields.sparkSession
    places = F.broadcast(spark.createDataFrame([(i, p) for i, (_, p) in enumerate(rules)], "at int, pattern string"))
    names = fields.select(F.col("name").cast("string").alias("name")).where("name is not null").distinct()
    tried = names.mapInArrow(_candidates([(i, required_text(p)) for i, (_, p) in enumerate(rules)]), "name string, at array<int>").select("name", F.explode("at").alias("at"))
    hit = tried.join(places, "at").where(F.expr("rlike(name, concat('(?i)', pattern))")).groupBy("name").agg(F.min_by("pattern", "at").alias("pattern"))
    return fields.select("table", "name").distinct().join(hit, "name").select("table", "name", "pattern")


def unclassified(fields: DataFrame, patterns: DataFrame, catalog: DataFrame) -> DataFrame:
    """Suspicious fields that catalog(table, name) doesn't list."""
    return suspicious(fields, patterns).join(catalog.select("table", "name"), ["table", "name"], "left_anti")


def _rank(ranks: dict[str, int], c: Column) -> Column:
    return F.create_map(*(x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))))[c]


def downgrades(base: DataFrame, head: DataFrame, live: DataFrame) -> DataFrame:
    """table, name, finding: DELETED where a protected entry goes while its column lives, DOWNGRADED where a rank drops."""
    b, h = base.select("table", "name", F.col("class").alias("c0"), F.col("treatment").alias("t0")), head.select("table", "name", F.col("class").alias("c1"), F.col("treatment").alias("t1"))
    both = b.join(h, ["table", "name"], "left").join(live.select("table", "name", F.lit(True).alias("live")), ["table", "name"], "left")
    dropped = (_rank(CLASS_RANK, F.col("c1")) < _rank(CLASS_RANK, F.col("c0"))) | (_rank(TREATMENT_RANK, F.col("t1")) < _rank(TREATMENT_RANK, F.col("t0")))
    finding = F.when(F.col("c1").isNull() & (F.col("c0") != "NOT_PII") & F.col("live"), "DELETED").when(dropped, "DOWNGRADED")
    return both.select("table", "name", finding.alias("finding")).where("finding is not null")


def field_diff(base: DataFrame, head: DataFrame) -> DataFrame:
    """dataset, name, change (removed, added, changed) from fields (dataset, name, type)."""
    b, h = base.select("dataset", "name", F.col("type").alias("t0"), F.lit(1).alias("b")), head.select("dataset", "name", F.col("type").alias("t1"), F.lit(1).alias("h"))
    both = b.join(h, ["dataset", "name"], "full_outer")
    change = F.when(F.col("h").isNull(), "removed").when(F.col("b").isNull(), "added").when(~F.col("t0").eqNullSafe(F.col("t1")), "changed")
    return both.select("dataset", "name", F.coalesce("t0", "t1").alias("type"), change.alias("change")).where("change is not null")


def renames(diff: DataFrame, order: str = "name") -> DataFrame:
    """dataset, old, new: the only added field of a type is a new name of the first removed one of that type, by `order`."""
    new = diff.where("change = 'added'").groupBy("dataset", "type").agg(F.min("name").alias("new"), F.count(F.lit(1)).alias("n")).where("n = 1")
    old = diff.where("change = 'removed'").groupBy("dataset", "type").agg(F.min_by("name", order).alias("old"))
    return old.join(new, ["dataset", "type"]).select("dataset", "old", "new")


def affected(usage: DataFrame, diff: DataFrame) -> DataFrame:
    """consumer, dataset, field: uses (consumer, dataset, name) of removed fields, a row each; see impact(), which counts and settles
    them without."""
    return impact(usage, diff).rows()


def blocking(hits: DataFrame | Impact, acks: DataFrame, change: str | None = None, registered: DataFrame | None = None) -> DataFrame | Impact:
    """Affected fields that no ack (consumer, field or `*`) covers; where a change is named, acks (with `change`) of that one only.
    Where registered(consumer, dataset) is given, only its consumers block: others can't ack, and are told by unregistered()."""
    if change is not None:
        acks = acks.where(F.col("change") == change)
    if isinstance(hits, Impact):
        return (hits if registered is None else hits.registered(registered)).unacked(acks)
    if registered is not None:
        hits = hits.join(registered.select("consumer", "dataset").distinct(), ["consumer", "dataset"], "left_semi")
    all_ = acks.where("field = '*'").select("consumer").distinct()
    return hits.join(all_, "consumer", "left_anti").join(acks.select("consumer", "field").distinct(), ["consumer", "field"], "left_anti")


def unregistered(hits: DataFrame | Impact, registered: DataFrame) -> DataFrame | Impact:
    """Affected fields of consumers that haven't registered for the dataset: a warning each."""
    if isinstance(hits, Impact):
        return hits.registered(registered, those=False)
    return hits.join(registered.select("consumer", "dataset").distinct(), ["consumer", "dataset"], "left_anti").select("consumer", "dataset", "field")


def impact_verdict(diff: DataFrame, hits: DataFrame | Impact, blocked: DataFrame | Impact, warned: DataFrame | Impact | None = None) -> DataFrame:
    """For each changed dataset: fields removed and retyped, affected uses, those that block, those that only warn (unregistered()),
    and whether the change may pass."""
    per = diff.groupBy("dataset").agg(F.count_if(F.col("change") == "removed").alias("removed"), F.count_if(F.col("change") == "changed").alias("retyped"))
    named = {"affected": hits, "blocking": blocked} | ({} if warned is None else {"warned": warned})
    joined = per
    for name, rows in named.items():
        counts = rows.count("dataset", name) if isinstance(rows, Impact) else rows.groupBy("dataset").agg(F.count(F.lit(1)).alias(name))
        joined = joined.join(counts, "dataset", "left")
    return joined.fillna(0, list(named)).where("removed + retyped > 0").withColumn("passed", F.col("blocking") == 0)


def lineage_drift(found: DataFrame, declared: DataFrame) -> DataFrame:
    """consumer, dataset, finding: UNREGISTERED where code reads what isn't declared, STALE the other way round."""
    f, d = found.select("consumer", "dataset", F.lit(1).alias("f")).distinct(), declared.select("consumer", "dataset", F.lit(1).alias("d")).distinct()
    return f.join(d, ["consumer", "dataset"], "full_outer").where("f is null or d is null").select("consumer", "dataset", F.when(F.col("d").isNull(), "UNREGISTERED").otherwise("STALE").alias("finding"))


def registration_findings(found: DataFrame, declared: DataFrame, datasets: DataFrame, repos: DataFrame, owners: DataFrame | None = None) -> DataFrame:
    """consumer, dataset, finding from uses found in code (consumer, dataset), declared reads (consumer, dataset, repo), known
    datasets, existing repos, and consumers whose entry has an owner rule (None: no rules are kept).

    UNREGISTERED CONSUMER: code reads what isn't declared. UNKNOWN DATASET: declared, but no such dataset. STALE LINEAGE:
    declared, but not found in a repo that exists. MISSING CONSUMER REPO and NO CODEOWNER are of a consumer (dataset null).
    """
    found = found.select("consumer", "dataset").distinct()
    declared = declared.select("consumer", "dataset", "repo").distinct()
    known = datasets.select("dataset", F.lit(True).alias("known")).distinct()
    there = repos.select("repo", F.lit(True).alias("there")).distinct()
    fresh = found.join(declared, ["consumer", "dataset"], "left_anti").withColumn("finding", F.lit("UNREGISTERED CONSUMER"))
    reads = declared.join(known, "dataset", "left").join(there, "repo", "left").join(found.withColumn("used", F.lit(True)), ["consumer", "dataset"], "left")
    label = F.when(F.col("known").isNull(), "UNKNOWN DATASET").when(F.col("there") & F.col("used").isNull(), "STALE LINEAGE")
    out = fresh.unionByName(reads.select("consumer", "dataset", label.alias("finding")).where("finding is not null"))
    none = F.lit(None).cast(dict(declared.dtypes)["dataset"]).alias("dataset")
    lost = declared.select("consumer", "repo").distinct().join(there, "repo", "left_anti").select("consumer", none, F.lit("MISSING CONSUMER REPO").alias("finding"))
    out = out.unionByName(lost)
    if owners is not None:
        out = out.unionByName(declared.select("consumer").distinct().join(owners.select("consumer"), "consumer", "left_anti").select("consumer", none, F.lit("NO CODEOWNER").alias("finding")))
    return out


def dangling(usage: DataFrame, contract: DataFrame) -> DataFrame:
    """Qualified uses of fields that the dataset doesn't have."""
    return usage.where("name <> '*'").join(contract.select("dataset", "name").distinct(), ["dataset", "name"], "left_anti")


def leaks(df: DataFrame, guarded: list[str], pattern: str) -> DataFrame:
    """column, leaked: values of guarded columns that aren't tokens; the values themselves aren't returned."""
    counts = df.agg(*(F.count_if(F.col(c).isNotNull() & ~F.col(c).rlike(pattern)).alias(c) for c in guarded))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("leaked")) for c in guarded))).alias("x")).select("x.column", "x.leaked")


def scan_universe(base: DataFrame, head: DataFrame) -> DataFrame:
    """What a scan of consumers looks for: datasets of either side with all the names they have or had (dataset, name, type), and how
    they are found (subject, topic, path; of head where both have the dataset). base and head are (dataset, subject, topic, delta_path,
    names array<string>)."""
    sides = [d.select("dataset", "subject", "topic", "delta_path", F.coalesce("names", F.array().cast("array<string>")).alias("names"), F.lit(i).alias("side")) for i, d in enumerate((base, head))]
    both = sides[0].unionByName(sides[1]).where("dataset is not null")
    last = F.max_by(F.struct("subject", "topic", "delta_path"), "side").alias("f")
    return both.groupBy("dataset").agg(last, F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names")).select("dataset", "f.*", "names")


def drift_changes(attributes: DataFrame) -> DataFrame:
    """workspace, address, path of attributes (with before and after) that a plan finds changed, each once."""
    return attributes.where("not (before <=> after)").select("workspace", "address", "path").distinct()


def reverts(drifted: DataFrame, planned: DataFrame) -> DataFrame:
    """Attributes (address, path) that drifted and that the plan would set back: after the drift is before the plan."""
    p = planned.select("address", "path", F.col("before").alias("p0"), F.col("after").alias("p1"))
    return drifted.join(p, ["address", "path"]).where("after <=> p0 and before <=> p1").select("address", "path", "before", "after")


def worst_exit(workspaces: DataFrame) -> DataFrame:
    """1 if a workspace failed, else 2 if one drifted, else 0."""
    return workspaces.agg(F.when(F.max((F.col("code") == 1).cast("int")) == 1, 1).when(F.max((F.col("code") == 2).cast("int")) == 1, 2).otherwise(0).alias("exit_code"))


def latencies(runs: DataFrame, by: str, value: str, quantiles: tuple[float, ...] = (0.9,)) -> DataFrame:
    """runs, the true median as p50, and nearest-rank quantiles, for each `by`. Null and NaN values are left out.

    Ranks are found by counts that narrow from pass to pass (ranks.order_statistics): no group is sorted.
    """
    n = F.col("runs")
    names = {f"p{round(100 * q)}": q for q in quantiles}
    ranks = {"__low": F.ceil(n / 2), "__high": F.floor(n / 2) + 1, **{k: F.ceil(F.round(F.lit(q) * n, 9)) for k, q in names.items()}}
    out = order_statistics(runs, by, value, ranks)
    return out.select(by, "runs", ((F.col("__low") + F.col("__high")) / 2).alias("p50"), *names)


def alerts(metrics: DataFrame, now: int) -> DataFrame:
    """alert, label of metrics (name, label, value) at a given time: failing, quarantined, stale, drift, unplanned."""
    fired = F.when((F.col("name") == "checkpoint_pass") & (F.col("value") == 0), "CheckpointFailing").when((F.col("name") == "quarantine_rows_last_run") & (F.col("value") > 0), "RowsQuarantined").when((F.col("name") == "last_run_ts") & (now - F.col("value") > 2 * 86400), "Stale").when((F.col("name") == "drift") & (F.col("value") > 0), "Drift").when((F.col("name") == "plan_ok") & (F.col("value") == 0), "DriftCheckFailed")
    return metrics.groupBy("name", "label").agg(F.max("value").alias("value")).select(fired.alias("alert"), "label").where("alert is not null")


def exposition(metrics: DataFrame) -> DataFrame:
    """One line of the metrics text format for each row: name, value, and either `labels`, a map of any number of labels (written by
    name; null or empty: no braces), or `label`, the value of the only one. Rows without a name or value have no line."""
    from ..functions.scalars import escaped_label

    if "labels" in metrics.columns:
        pairs = F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e.key, F.lit('="'), escaped_label(e.value), F.lit('"')))
        inside = F.array_join(pairs, ",")
        braces = F.when(F.coalesce(inside, F.lit("")) == "", "").otherwise(F.concat(F.lit("{"), inside, F.lit("}")))
    else:
        braces = F.concat(F.lit('{label="'), escaped_label("label"), F.lit('"}'))
    return metrics.select(F.concat("name", braces, F.lit(" "), F.col("value").cast("string")).alias("line")).where("line is not null")
