"""Governance files as rows: Spark reads them, tasks turn YAML into JSON, and expressions take them apart. What is wrong with a file is
a row of findings, not an error. Keys never become rows; edits keep all that they don't mean to change, comments too."""

from __future__ import annotations

import json
import os
import re
import secrets
from collections import Counter
from collections.abc import Iterator
from datetime import date
from pathlib import Path

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Rule, load_suite
from ..plans.contracts import MODES

#: Names of keys, and the variables that come before the file; the last key may be missing.
KEYS = {"kek": "GOV_KEK", "fixtures_key": "GOV_FIXTURES_KEY", "audit_hmac_key": "GOV_AUDIT_HMAC_KEY", "token_key": "GOV_TOKEN_KEY"}
OPTIONAL = ("token_key",)
#: What an entry of the registry says, and what of it must be said.
ENTRY = ("schema", "subject", "owner", "compatibility", "ge_suite", "delta_path", "fixture")
DATASET = "datasets map<string, struct<" + ", ".join(f"{k}: string" for k in ENTRY) + ">>"
CATALOG = "subject_key string, columns map<string, struct<class: string, treatment: string, key_scope: string, reason: string>>, detection struct<name_patterns: array<string>>"
ACK = "struct<fields: array<string>, by: string, reason: string, date: string>"
LINEAGE = "consumer string, team string, repo string, reads array<string>, acks map<string, string>"


class BadFile(ValueError):
    pass


class BadKey(RuntimeError):
    pass


def read(spark: SparkSession, path: str | Path, names: str = "*") -> DataFrame:
    """file (the path below a folder, or a file's name), text of all files of such names; none where there is no such path."""
    root = str(path).rstrip("/")
    try:
        files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=names)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "file string, text string")
    name = root.rsplit("/", 1)[-1]
    whole = F.url_decode(F.col("_metadata.file_path"))
    below = F.regexp_extract(whole, f"/{re.escape(name)}/(.+)$", 1)
    return files.select(F.when(below == "", F.regexp_extract(whole, "([^/]+)$", 1)).otherwise(below).alias("file"), F.col("value").alias("text"))


def _json(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml  # optional: only these readers need it

    for pdf in batches:
        docs, wrong = [], []
        for text in pdf["text"]:
            try:
                docs.append(json.dumps(yaml.safe_load(text) or {}, default=str))
                wrong.append(None)
            except yaml.YAMLError as e:
                docs.append(None)
                wrong.append(str(e).replace("\n", " ")[:200])
        yield pd.DataFrame({"file": pdf["file"], "doc": docs, "error": wrong})


def parsed(files: DataFrame) -> DataFrame:
    """file, doc (YAML or JSON as JSON text; an empty file is `{}`), error where it is neither."""
    return files.select("file", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(_json, "file string, doc string, error string")


def registry(files: DataFrame) -> DataFrame:
    """dataset and the entry's values of parsed registry files; what an entry doesn't say is null."""
    entries = parsed(files).select(F.explode(F.from_json("doc", DATASET).datasets).alias("dataset", "e"))
    return entries.select("dataset", *(F.col(f"e.{k}") for k in ENTRY))


def table_of(path: str | Column) -> Column:
    """The table's name: the last step of its path."""
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)


def _told(rows: DataFrame, keys: list[str], checks: dict[str, Column]) -> DataFrame:
    """The keys and a finding for each check that holds."""
    found = F.array_compact(F.array(*(F.when(c, F.lit(text)) for text, c in checks.items())))
    return rows.select(*keys, F.explode(found).alias("finding"))


def lint_registry(entries: DataFrame) -> DataFrame:
    """dataset, finding of registry entries: values that are missing, modes, subjects and paths that aren't allowed, values that more
    than one dataset has (said of each of them)."""
    lacks = {f"lacks {k}": F.coalesce(F.trim(k), F.lit("")) == "" for k in ENTRY if k != "fixture"}
    forms = {
        "mode isn't allowed": ~F.col("compatibility").isin(*MODES),
        "subject isn't a topic's key or value": ~F.col("subject").rlike("-(key|value)$"),
        "path isn't in object storage": ~F.col("delta_path").startswith("s3a://"),
    }
    out = _told(entries, ["dataset"], lacks | forms)
    for k in ("subject", "schema", "delta_path"):
        shared = entries.where(F.col(k).isNotNull()).groupBy(k).agg(F.collect_set("dataset").alias("of")).where(F.size("of") > 1)
        out = out.unionByName(shared.select(F.explode("of").alias("dataset"), F.lit(f"shares its {k}").alias("finding")))
    return out


def lint_schemas(entries: DataFrame, files: DataFrame) -> DataFrame:
    """dataset, schema, finding of registry entries and schema files(file, text): files that are missing, aren't JSON, aren't named
    records, have no fields or one name twice; and files that no entry names (dataset null)."""
    named = entries.where("schema is not null").select("dataset", "schema")
    shape = F.from_json("text", "type string, name string, fields array<struct<name: string>>")
    both = named.join(files.select(F.col("file").alias("schema"), "text"), "schema", "left").withColumn("s", shape).withColumn("valid", F.try_parse_json("text").isNotNull())
    names = F.transform(F.coalesce("s.fields", F.array().cast("array<struct<name: string>>")), lambda f: f["name"])
    there = F.col("text").isNotNull()
    record = F.coalesce((F.col("s.type") == "record") & (F.col("s.name") != ""), F.lit(False))
    out = _told(both, ["dataset", "schema"], {
        "schema file is missing": ~there, "schema isn't JSON": there & ~F.col("valid"), "schema isn't a named record": F.col("valid") & ~record,
        "schema has no fields": record & (F.size(names) == 0), "schema has a name twice": record & (F.size(F.array_distinct(names)) < F.size(names)),
    })
    orphans = files.select(F.col("file").alias("schema")).join(named.select("schema").distinct(), "schema", "left_anti")
    return out.unionByName(orphans.select(F.lit(None).cast("string").alias("dataset"), "schema", F.lit("no dataset has this schema").alias("finding")))


def schema_rows(entries: DataFrame, files: DataFrame) -> DataFrame:
    """dataset, pos, name, type (JSON), nullable, has_default of the contracts' fields; a dataset without a readable schema has none."""
    parts = F.from_json("text", "fields array<map<string, string>>").fields
    each = entries.join(files.select(F.col("file").alias("schema"), "text"), "schema").select("dataset", F.posexplode(parts).alias("pos", "f"))
    kind = F.col("f")["type"]
    union = F.from_json(kind, "array<string>")
    return each.select("dataset", "pos", F.col("f")["name"].alias("name"), kind.alias("type"), (kind.startswith("[") & F.coalesce(F.array_contains(union, "null"), F.lit(False))).alias("nullable"), F.map_contains_key("f", "default").alias("has_default"))


def catalog(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (table, name, class, treatment, key_scope, reason, subject_key) and patterns of names (ord, pattern) of catalog files.

    An entry's key is `table.column`, cut at the first dot; one without a dot has a null name, one without a body null values but for
    the treatment NONE and the scope SUBJECT. Patterns are what governance.suspicious() takes.
    """
    doc = parsed(files).select(F.from_json("doc", CATALOG).alias("c"))
    each = doc.select("c.subject_key", F.explode("c.columns").alias("key", "e"))
    at = F.instr("key", ".")
    entries = each.select(
        F.when(at > 0, F.substring_index("key", ".", 1)).otherwise(F.col("key")).alias("table"), F.when(at > 0, F.expr("substring(key, instr(key, '.') + 1)")).alias("name"), F.col("e.class").alias("class"),
        F.coalesce("e.treatment", F.lit("NONE")).alias("treatment"), F.coalesce("e.key_scope", F.lit("SUBJECT")).alias("key_scope"), F.col("e.reason").alias("reason"), "subject_key",
    )
    return entries, doc.select(F.posexplode("c.detection.name_patterns").alias("ord", "pattern")).where("pattern is not null")


def suite(path: str | Path) -> list[Rule]:
    """The rules of a suite, as they are compiled into a plan."""
    import yaml

    p = Path(path)
    if not p.is_file():
        raise BadFile(f"no suite at {path}")
    return load_suite(yaml.safe_load(p.read_text()) or {})


def _entries(files: DataFrame) -> DataFrame:
    doc = F.from_json("doc", LINEAGE)
    return parsed(files).select("file", "error", F.regexp_extract("file", r"([^/]+?)(\.[^./]*)?$", 1).alias("stem"), doc.alias("e")).select("file", "error", "stem", "e.*")


def _acks(entries: DataFrame) -> DataFrame:
    each = entries.select("file", "consumer", F.explode("acks").alias("change", "raw"))
    one = F.when(F.ltrim("raw").startswith("["), F.from_json("raw", f"array<{ACK}>")).otherwise(F.array(F.from_json("raw", ACK)))
    return each.select("file", "consumer", "change", F.explode_outer(one).alias("ack"))


def reads(files: DataFrame) -> DataFrame:
    """consumer, team, repo, dataset that lineage files declare."""
    return _entries(files).select("consumer", "team", "repo", F.explode("reads").alias("dataset"))


def acks(files: DataFrame) -> DataFrame:
    """consumer, change, field that lineage files ack."""
    return _acks(_entries(files)).select("consumer", "change", F.explode("ack.fields").alias("field"))


def lint_lineage(files: DataFrame) -> DataFrame:
    """file, finding of lineage files; one with findings isn't to be relied on."""
    entries = _entries(files)
    checks = {"isn't YAML": F.col("error").isNotNull()}
    checks |= {f"doesn't say its {k}": F.col("error").isNull() & (F.coalesce(F.col(k), F.lit("")) == "") for k in ("consumer", "team", "repo")}
    checks |= {"lists no datasets that it reads": F.col("error").isNull() & (F.coalesce(F.size(F.array_compact("reads")), F.lit(0)) < 1), "is named after another consumer": F.col("consumer") != F.col("stem")}
    given = _acks(entries)
    wrong = {"acks something that isn't a change's number": ~F.col("change").rlike("^[0-9]+$"), "acks no fields": F.coalesce(F.size(F.filter("ack.fields", lambda f: F.trim(f) != "")), F.lit(0)) < 1}
    return _told(entries, ["file"], checks).unionByName(_told(given, ["file"], wrong)).distinct()


def owned(files: DataFrame) -> DataFrame:
    """path of each rule of owners files."""
    lines = files.select(F.explode(F.split("text", r"\R")).alias("line")).select(F.trim("line").alias("line"))
    return lines.where("line <> '' and not startswith(line, '#')").select(F.regexp_replace(F.regexp_extract("line", r"^\S+", 0), "^/", "").alias("path")).distinct()


def sources(spark: SparkSession, folder: str) -> DataFrame:
    """consumer, path, source of all Python and SQL files below folder/<consumer>/."""
    parts = F.split("file", "/", 2)
    return read(spark, folder, "*.{py,sql}").where("contains(file, '/')").select(parts[0].alias("consumer"), parts[1].alias("path"), F.col("text").alias("source"))


def _flaw(text: str | None, needed: bool) -> str | None:
    """What is wrong with a key's text."""
    if not text:
        return "isn't set" if needed else None
    if not re.fullmatch(r"(?:[0-9a-fA-F]{2})*", text):
        return "isn't made of hexadecimal digits"
    return None if len(text) == 64 else f"has {len(text) // 2} bytes where 32 are needed"


def keys(path: str | Path) -> dict[str, bytes]:
    """Keys by name, from variables before the file. All that is wrong with any of them is said at once; no key's value is."""
    held = _plain(path)
    texts = {name: str(os.environ.get(variable) or held.get(name) or "") for name, variable in KEYS.items()}
    wrong = [f"{name} {flaw}" for name, text in texts.items() if (flaw := _flaw(text, name not in OPTIONAL))]
    again = Counter(text.lower() for text in texts.values() if text)
    wrong += [f"{name} is a key for something else too" for name, text in texts.items() if again[text.lower()] > 1]
    if wrong:
        raise BadKey(", ".join(wrong))
    return {name: bytes.fromhex(text) for name, text in texts.items() if text}


def _plain(path: str | Path) -> dict:
    import yaml

    p = Path(path)
    return (yaml.safe_load(p.read_text()) or {}) if p.is_file() else {}


def init_keys(path: str | Path) -> list[str]:
    """Draws the keys that a file lacks and appends them; names of what was added. Only the owner may read the file."""
    p = Path(path)
    added = [name for name in KEYS if not _plain(p).get(name)]
    p.parent.mkdir(parents=True, exist_ok=True)
    with os.fdopen(os.open(p, os.O_WRONLY | os.O_CREAT | os.O_APPEND, 0o600), "a") as f:
        os.fchmod(f.fileno(), 0o600)
        f.writelines(f"{name}: '{secrets.token_hex(32)}'\n" for name in added)
    return added


def _members(node) -> dict:
    """Value nodes of a mapping by key."""
    return {k.value: v for k, v in node.value} if node is not None and isinstance(node.value, list) and node.id == "mapping" else {}


def acknowledge(folder: str | Path, consumer: str, change: int, fields: list[str], reason: str, by: str | None = None) -> None:
    """Adds an ack to a consumer's entry, which must be there. The text goes in where it belongs; all else stays as it stands."""
    import yaml

    p = Path(folder) / f"{consumer}.yml"
    if not p.is_file():
        raise BadFile(f"there is no entry of {consumer}")
    text = p.read_text()
    text += "" if text.endswith("\n") else "\n"
    top = _members(yaml.compose(text))
    said = {"fields": [f.strip() for f in fields if f.strip()], "by": by or top["team"].value, "reason": reason, "date": date.today().isoformat()}
    item, held = json.dumps(said, ensure_ascii=False), top.get("acks")
    changes = _members(held)
    if not changes:  # none yet: `acks: {}`, `acks:` or nothing at all
        block = f"\n  '{change}':\n    - {item}"
        text = f"{text}acks:{block}\n" if held is None else text[: held.start_mark.index].rstrip(" ") + block + text[held.end_mark.index :]
    elif held.flow_style or str(change) in changes and (changes[str(change)].flow_style or changes[str(change)].id != "sequence"):
        whole = yaml.safe_load(text)["acks"]
        lists = {str(k): v if isinstance(v, list) else [v] for k, v in whole.items()}
        lists.setdefault(str(change), []).append(said)
        lines = "".join(f"  '{k}':\n" + "".join(f"    - {json.dumps(x, ensure_ascii=False, default=str)}\n" for x in v) for k, v in lists.items())
        text = text[: held.start_mark.index].rstrip(" \n") + "\n" + lines + text[held.end_mark.index :].lstrip("\n")
    else:
        before = changes.get(str(change))
        last, deep = (before.value[-1], before.start_mark.column) if before else (held.value[-1][1], held.start_mark.column)
        end = text.rfind("\n", 0, last.end_mark.index) + 1 if last.end_mark.column == 0 or not text[last.start_mark.index : last.end_mark.index].strip() else text.find("\n", last.end_mark.index) + 1
        own = f"{' ' * deep}- {item}\n" if before else f"{' ' * deep}'{change}':\n{' ' * deep}  - {item}\n"
        text = text[:end] + own + text[end:]
    p.write_text(text)


def edit_contract(root: str | Path, schema: str, field: str, new: str | None = None, suite_file: str | None = None) -> int:
    """Drops a field of a contract, or renames it; where a suite is named, its rules too. Returns how many rules were touched."""
    import yaml

    p = Path(root) / schema
    doc = json.loads(p.read_text())
    if not any(f["name"] == field for f in doc["fields"]):
        raise BadFile(f"{schema} has no field {field}")
    doc["fields"] = [{**f, "name": new} if f["name"] == field else f for f in doc["fields"] if new or f["name"] != field]
    p.write_text(json.dumps(doc, indent=2) + "\n")
    if suite_file is None:
        return 0
    s = Path(root) / suite_file
    text = s.read_text()
    items = _members(yaml.compose(text))["expectations"].value
    spans, touched = [], 0
    for i, item in enumerate(items):
        named = [v for k, v in _members(_members(item).get("kwargs")).items() if k in ("column", "column_A", "column_B") and v.value == field]
        touched += bool(named)
        if new:
            spans += [(v.start_mark.index, v.end_mark.index, new) for v in named]
        elif named:  # from the item's own line to the next one's
            line = lambda node: text.rfind("\n", 0, node.start_mark.index) + 1
            spans.append((line(item), line(items[i + 1]) if i + 1 < len(items) else item.end_mark.index, ""))
    for a, b, put in sorted(spans, reverse=True):
        text = text[:a] + put + text[b:]
    s.write_text(text)
    return touched


def relevant(changed: DataFrame, pattern: str) -> bool:
    """Whether a changed path matches; a wrong pattern is an error, not a no."""
    return not changed.where(F.col("path").rlike(pattern)).isEmpty()
