"""Registry and catalog decisions over many entries at once: catalog lint, gate plan, schema versions, references, audit rows, JSON diffs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import normal_path
from ..session import written

#: Classes, treatments and key scopes of a catalog.
PROTECTED = ["DIRECT_IDENTIFIER", "QUASI_IDENTIFIER"]
TREATED = ["TOKENIZE_HMAC", "ENCRYPT_AESGCM"]
SCOPES = ["SUBJECT", "PLATFORM"]


def catalog_findings(catalog: DataFrame, fields: DataFrame, subject_key: str) -> DataFrame:
    """table, name, finding of catalog(table, name, class, treatment, key_scope, reason) against fields(table, name).

    An entry of an unknown table has no other finding. A missing scope is SUBJECT. Tables that hold protected columns and
    lack the subject key are findings of that key.
    """
    tables = fields.select("table", F.lit(True).alias("known")).distinct()
    columns = fields.select("table", "name", F.lit(True).alias("live")).distinct()
    c, t, scope = F.coalesce("class", F.lit("")), F.coalesce("treatment", F.lit("")), F.coalesce("key_scope", F.lit("SUBJECT"))
    protected, treated = c.isin(PROTECTED), t.isin(TREATED)
    found = F.array(
        F.when(~c.isin(*PROTECTED, "NOT_PII"), "BAD_CLASS"), F.when(~t.isin(*TREATED, "NONE"), "BAD_TREATMENT"), F.when(protected & ~treated, "UNTREATED"), F.when((c == "NOT_PII") & (t != "NONE"), "TREATED_NOT_PII"),
        F.when((c == "NOT_PII") & (F.trim(F.coalesce("reason", F.lit(""))) == ""), "NO_REASON"), F.when(treated & ~scope.isin(SCOPES), "BAD_SCOPE"), F.when(treated & (scope == "PLATFORM") & ~((t == "TOKENIZE_HMAC") & (c == "QUASI_IDENTIFIER")), "SURVIVES_ERASURE"), F.when(F.col("live").isNull(), "STALE"),
    )
    entries = catalog.join(tables, "table", "left").join(columns, ["table", "name"], "left")
    each = entries.select("table", "name", F.explode(F.when(F.col("known").isNull(), F.array(F.lit("UNKNOWN_TABLE"))).otherwise(F.array_compact(found))).alias("finding"))
    holding = catalog.where(F.col("class").isin(PROTECTED)).select("table").distinct().join(tables, "table", "left_semi")
    lost = holding.join(fields.where(F.col("name") == subject_key).select("table"), "table", "left_anti")
    return each.union(lost.select("table", F.lit(subject_key), F.lit("NO_SUBJECT_KEY")))


def removed_datasets(base: DataFrame, head: DataFrame) -> DataFrame:
    """Datasets of base that head lacks; a plan with any of them is refused."""
    return base.select("dataset").join(head.select("dataset"), "dataset", "left_anti")


def gate_plan(base: DataFrame, head: DataFrame, changed: DataFrame, infra: bool = False) -> DataFrame:
    """dataset, mode, reason, mode_changed, subject_changed of the datasets that a change selects.

    base and head are (dataset, subject, schema, mode), changed has the paths. The mode in force on base judges; infra says
    that the gate itself was changed, which selects every dataset.
    """
    b = base.select("dataset", *(F.col(c).alias(f"{c}_b") for c in ("subject", "schema", "mode")))
    both = head.join(b, "dataset", "left").withColumn("before", F.coalesce("schema_b", "schema"))
    paths = changed.select("path").distinct()
    touched = both.select("dataset", F.explode(F.array_distinct(F.array("schema", "before"))).alias("path")).join(paths, "path", "left_semi").select("dataset", F.lit(True).alias("touched")).distinct()
    reason = F.when(F.col("touched"), "schema changed").when(F.lit(infra), "self-test")
    changes = [F.coalesce(F.col(c) != F.col(f"{c}_b"), F.lit(False)).alias(f"{c}_changed") for c in ("mode", "subject")]
    return both.join(touched, "dataset", "left").select("dataset", F.coalesce("mode_b", "mode").alias("mode"), reason.alias("reason"), *changes).where("reason is not null")


def latest_schema(history: DataFrame) -> DataFrame:
    """subject, version, schema of the last version of history(subject, version, schema)."""
    return history.groupBy("subject").agg(F.max("version").alias("version"), F.max_by("schema", "version").alias("schema"))


def registered(offered: DataFrame) -> DataFrame:
    """subject, canonical, version: schemas offered(subject, at, schema) are registered once, in order of their first offer.

    Two texts are one schema where their JSON is equal but for white space and the order of keys; invalid JSON has no version.
    """
    canonical = F.to_json(F.try_parse_json("schema"))
    first = offered.select("subject", "at", canonical.alias("canonical")).where("canonical is not null").groupBy("subject", "canonical").agg(F.min("at").alias("at"))
    return first.select("subject", "canonical", F.row_number().over(Window.partitionBy("subject").orderBy("at", "canonical")).cast("long").alias("version"))


def references(literals: DataFrame, datasets: DataFrame) -> DataFrame:
    """id, dataset, kind of literals(id, literal) that name datasets(dataset, subject, topic, delta_path).

    Subjects and topics stand in comma lists, paths are meant by themselves and by what lies below them: a literal's own
    ancestors are joined by equality. The first of subject, topic and delta_path counts.
    """
    pieces = literals.select("id", F.explode(F.transform(F.split("literal", ","), lambda p: F.trim(p))).alias("key"))
    plain = lambda c: F.regexp_replace(normal_path(c), "^s3://", "")
    parts = F.split(plain("literal"), "/")
    above = literals.select("id", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("key"))
    kinds = [(pieces, F.col("subject"), 0), (pieces, F.col("topic"), 1), (above, plain("delta_path"), 2)]
    found = None
    for keys, name, rank in kinds:
        hit = keys.join(datasets.select("dataset", name.alias("key")), "key").select("id", "dataset", F.lit(rank).alias("rank"))
        found = hit if found is None else found.union(hit)
    return found.groupBy("id", "dataset").agg(F.min("rank").alias("rank")).select("id", "dataset", F.element_at(F.array(*map(F.lit, ("subject", "topic", "delta_path"))), F.col("rank") + 1).alias("kind"))


def audit_tables(audit: DataFrame) -> DataFrame:
    """A row for each table of each audit record: request_id, table, rows, before, after (versions)."""
    zipped = F.arrays_zip("tables_touched", "rows_deleted_by_table", "pre_delete_versions", "vacuum_versions")
    return audit.select("request_id", F.inline(zipped)).toDF("request_id", "table", "rows", "before", "after")


#: Levels of JSON that a pass over the rows opens; deeper ones are left to a next pass, over what is still closed.
LEVELS = 4


def leaf_diff(pairs: DataFrame) -> DataFrame:
    """id, path, before, after for each leaf that differs in pairs(id, before, after) of JSON texts.

    Objects on both sides are opened, also where they are texts within JSON; lists are leaves, and leaves are compared as text, so
    1 and "1" are equal. A key that one side lacks is null there; a null id and repeated rows are kept as they are, and an empty
    table gives an empty result. Other columns are ignored, whatever their names. Rows are opened where they are, LEVELS levels in
    one pass without a shuffle; only what is deeper than that is written and goes through another pass.
    """
    opened = lambda c: F.when(F.ltrim(c).startswith("{"), F.try_parse_json(c))
    objects = opened(F.col("before")).isNotNull() & opened(F.col("after")).isNotNull()
    b, a = (F.from_json(c, "map<string,string>") for c in ("before", "after"))
    path = lambda key: F.when(F.col("path") == "", key).otherwise(F.concat("path", F.lit("."), key))
    below = lambda x, y: F.transform(F.array_union(F.map_keys(x), F.map_keys(y)), lambda k: F.struct(path(k).alias("path"), F.try_element_at(x, k).alias("before"), F.try_element_at(y, k).alias("after")))
    row, out = F.array(F.struct("path", "before", "after")), None
    level = pairs.select("id", F.lit("").alias("path"), F.col("before").cast("string").alias("before"), F.col("after").cast("string").alias("after"))
    while True:
        for _ in range(LEVELS):
            maps = level.where("not (before <=> after)").withColumn("open", objects).withColumn("b", F.when(F.col("open"), b)).withColumn("a", F.when(F.col("open"), a))
            level = maps.select("id", F.inline(F.when(F.col("open"), below(F.col("b"), F.col("a"))).otherwise(row)))
        level = written(level.where("not (before <=> after)").withColumn("open", objects))
        leaves, level = level.where("not open").drop("open"), level.where("open").drop("open")
        out = leaves if out is None else out.union(leaves)
        if level.isEmpty():
            return out
