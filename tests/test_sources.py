"""Files of the governance repository, generators, bad rows, the fixture gate."""

import json
import stat

import pytest
from pyspark.sql import functions as F

from accordium.operators import fixtures, governance
from accordium.operators import quality as q
from accordium.sources import files, generators

REGISTRY = """# all datasets
datasets:
  shop.sales:
    {schema: sales.avsc, subject: shop.sales-value, owner: shop, compatibility: FULL, ge_suite: sales.yml, delta_path: s3a://lake/sales/}
  shop.stock:
    schema: stock.avsc
    subject: shop.stock
    compatibility: NONE
    delta_path: s3a://lake/sales/
"""
SUITE = """expectation_suite_name: sales
expectations:
  # every sale has a number
  - expectation_type: expect_column_values_to_not_be_null
    kwargs: {column: number}
  - expectation_type: expect_column_values_to_be_between
    kwargs: {column: price, min_value: 0}  # cents
  - expectation_type: expect_column_values_to_be_unique
    kwargs: {column: number}
"""
SCHEMA = {"type": "record", "name": "sale", "fields": [{"name": "number", "type": "string"}, {"name": "price", "type": ["null", "long"], "default": None}]}


def text_files(spark, **texts):
    return spark.createDataFrame([(name.replace("__", "."), t) for name, t in texts.items()], "file string, text string")


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def root(tmp_path):
    (tmp_path / "registry.yml").write_text(REGISTRY)
    (tmp_path / "schemas").mkdir()
    (tmp_path / "schemas/sales.avsc").write_text(json.dumps(SCHEMA))
    (tmp_path / "schemas/old.avsc").write_text("{}")
    (tmp_path / "sales.yml").write_text(SUITE)
    return tmp_path


def test_registry(spark, root):
    entries = files.registry(files.read(spark, root / "registry.yml"))
    assert {r.dataset: r.owner for r in entries.collect()} == {"shop.sales": "shop", "shop.stock": None}
    assert found(entries.select(files.table_of("delta_path"))) == [("sales",), ("sales",)]
    assert files.registry(files.read(spark, root / "none.yml")).count() == 0
    assert found(files.lint_registry(entries)) == [("shop.sales", "shares its delta_path"), ("shop.stock", "lacks ge_suite"), ("shop.stock", "lacks owner"), ("shop.stock", "mode isn't allowed"), ("shop.stock", "shares its delta_path"), ("shop.stock", "subject isn't a topic's key or value")]
    schemas = files.read(spark, root / "schemas", "*.avsc")
    assert found(files.schema_rows(entries, schemas)) == [("shop.sales", 0, "number", "string", False, False), ("shop.sales", 1, "price", '["null","long"]', True, True)]


def test_lint_of_schemas(spark):
    texts = {"good": json.dumps(SCHEMA), "cut": "{", "list": "[1]", "plain": '{"type": "string"}', "bare": '{"type": "record", "name": "r", "fields": []}', "twice": json.dumps(SCHEMA | {"fields": SCHEMA["fields"][:1] * 2}), "alone": "{}"}
    entries = spark.createDataFrame([(n, n) for n in [*texts, "gone"] if n != "alone"] + [("none", None)], "dataset string, schema string")
    got = {r.schema: r.finding for r in files.lint_schemas(entries, text_files(spark, **texts)).collect()}
    assert got == {"cut": "schema isn't JSON", "list": "schema isn't a named record", "plain": "schema isn't a named record", "bare": "schema has no fields", "twice": "schema has a name twice", "gone": "schema file is missing", "alone": "no dataset has this schema"}


def test_catalog(spark):
    text = "subject_key: person\ncolumns:\n  staff.name: {class: DIRECT_IDENTIFIER, treatment: TOKENIZE_HMAC}\n  staff.home.street:\n  loose: {class: NOT_PII, reason: x}\ndetection:\n  name_patterns: ['(^|_)name$', phone]\n"
    entries, patterns = files.catalog(text_files(spark, catalog__yml=text, empty__yml=""))
    key = lambda r: (r[0], r[1] or "")
    assert sorted((tuple(r) for r in entries.collect()), key=key) == [("loose", None, "NOT_PII", "NONE", "SUBJECT", "x", "person"), ("staff", "home.street", None, "NONE", "SUBJECT", None, "person"), ("staff", "name", "DIRECT_IDENTIFIER", "TOKENIZE_HMAC", "SUBJECT", None, "person")]
    assert found(patterns) == [(0, "(^|_)name$"), (1, "phone")]
    names = spark.createDataFrame([("t", "first_Name"), ("t", "x")], "table string, name string")
    assert found(governance.suspicious(names, patterns)) == [("t", "first_Name", "(^|_)name$")]


def test_lineage_files(spark):
    texts = text_files(
        spark, bi__yml="consumer: bi\nteam: insight\nrepo: repos/bi\nreads: [shop.sales, shop.stock]\nacks:\n  7: [{fields: [price, ' '], by: insight}]\n  '8': {fields: [number]}\n",
        word__yml="consumer: word\nteam: t\nrepo: r\nreads: shop.sales\n", other__yml="consumer: else\nteam: t\nrepo: r\nreads: [a]\nacks: {soon: [{fields: [a]}], 9: [{by: x}], 10: }\n", cut__yml="consumer: [", none__yml="",
    )
    assert found(files.reads(texts).where("consumer = 'bi'")) == [("bi", "insight", "repos/bi", "shop.sales"), ("bi", "insight", "repos/bi", "shop.stock")]
    assert found(files.acks(texts).where("consumer = 'bi' and field <> ' '")) == [("bi", "7", "price"), ("bi", "8", "number")]
    assert found(files.lint_lineage(texts)) == [("cut.yml", "isn't YAML"), ("none.yml", "doesn't say its consumer"), ("none.yml", "doesn't say its repo"), ("none.yml", "doesn't say its team"), ("none.yml", "lists no datasets that it reads"), ("other.yml", "acks no fields"), ("other.yml", "acks something that isn't a change's number"), ("other.yml", "is named after another consumer"), ("word.yml", "lists no datasets that it reads")]


@pytest.mark.parametrize("end", ["", "acks: {}\n", "acks:\n", "acks: {'5': [{fields: [a]}]}\n# end\n", "acks:\n  '5':\n    - {fields: [a]}  # why\n# end\n", "acks:\n  '11':\n    - fields: [a]\n      by: x\n\nlast: 1\n", "acks:\n  '11': {fields: [a]}\nlast: 1\n"])
def test_acks_keep_what_is_there(spark, tmp_path, end):
    before = "# who reads what\nconsumer: bi  # us\nteam: insight\nrepo: repos/bi\nreads:\n  - shop.sales\n" + end
    (tmp_path / "bi.yml").write_text(before)
    files.acknowledge(tmp_path, "bi", 11, ["price", " number ", ""], 'a "quoted" reason: ja')
    files.acknowledge(tmp_path, "bi", 12, ["*"], "all", "me")
    after = (tmp_path / "bi.yml").read_text()
    assert [c for c in ("# who reads what", "# us", "# why", "# end") if c in before and c not in after] == []
    texts = files.read(spark, tmp_path, "*.yml")
    old = {("bi", "5", "a")} if "'5'" in end else {("bi", "11", "a")} if "'11'" in end else set()
    assert {tuple(r) for r in files.acks(texts).collect()} == {("bi", "11", "price"), ("bi", "11", "number"), ("bi", "12", "*")} | old
    assert files.lint_lineage(texts).count() == 0 and files.reads(texts).count() == 1
    with pytest.raises(files.BadFile):
        files.acknowledge(tmp_path, "nobody", 1, ["a"], "")


def test_edits_of_contracts(root):
    assert files.edit_contract(root, "schemas/sales.avsc", "price", "cents", "sales.yml") == 1
    assert [r.target for r in files.suite(root / "sales.yml")] == ["number", "cents", "number"]
    text = (root / "sales.yml").read_text()
    assert "# every sale has a number" in text and "# cents" in text
    assert files.edit_contract(root, "schemas/sales.avsc", "number", None, "sales.yml") == 2
    assert [r.target for r in files.suite(root / "sales.yml")] == ["cents"] and files.edit_contract(root, "schemas/sales.avsc", "cents") == 0
    with pytest.raises(files.BadFile):
        files.edit_contract(root, "schemas/sales.avsc", "gone")
    with pytest.raises(files.BadFile):
        files.suite(root / "none.yml")


def test_owners_and_sources(spark, root):
    rules = text_files(spark, CODEOWNERS="# all\n/lineage/bi.yml  @insight\r\n\n  *.sql @shop\n")
    assert found(files.owned(rules)) == [("*.sql",), ("lineage/bi.yml",)] and files.owned(rules.limit(0)).count() == 0
    for name in ("bi/jobs/a.py", "ml/q.sql", "ml/notes.txt", "top.py"):
        (root / "consumers" / name).parent.mkdir(parents=True, exist_ok=True)
        (root / "consumers" / name).write_text("x = 1\ny = 2\n")
    assert found(files.sources(spark, str(root / "consumers"))) == [("bi", "jobs/a.py", "x = 1\ny = 2\n"), ("ml", "q.sql", "x = 1\ny = 2\n")]
    changed = spark.createDataFrame([("contracts/a.yml",), ("README",)], "path string")
    assert files.relevant(changed, "^contracts/") and not files.relevant(changed, "^infra/")


def test_keys(root, monkeypatch):
    for v in files.KEYS.values():
        monkeypatch.delenv(v, raising=False)
    p = root / "conf/keys.yml"
    with pytest.raises(files.BadKey) as e:
        files.keys(p)
    assert [n for n in files.KEYS if n in str(e.value)] == [n for n in files.KEYS if n not in files.OPTIONAL]
    assert files.init_keys(p) == list(files.KEYS) and files.init_keys(p) == []
    assert stat.S_IMODE(p.stat().st_mode) == 0o600 and {len(v) for v in files.keys(p).values()} == {32}
    good = files.keys(p)
    for text, part in (("zz", "hexadecimal"), ("ab", "has 1 bytes"), (good["token_key"].hex().upper(), "something else")):
        monkeypatch.setenv("GOV_KEK", text)
        with pytest.raises(files.BadKey, match=part) as e:
            files.keys(p)
        assert good["token_key"].hex() not in str(e.value).lower()


def test_generators(spark):
    c, t = generators.customers(spark, 3000, 7), generators.transactions(spark, 5000, 300, 7)
    assert sorted(map(tuple, c.collect())) == sorted(map(tuple, generators.customers(spark, 3000, 7).repartition(5).collect()))
    s = c.agg(F.count_distinct("customer_id").alias("ids"), F.avg(F.col("updated_at").isNotNull().cast("int")).alias("kept"), F.min(F.col("ssn").rlike(r"^\d{3}-\d\d-\d{4}$")).alias("form")).first()
    assert s.ids == 3000 and 0.35 < s.kept < 0.45 and s.form
    x = t.agg(F.count_distinct("transaction_id").alias("ids"), F.min("amount_minor").alias("low"), F.percentile("amount_minor", 0.5).alias("mid"), F.avg("risk_score").alias("risk"), F.max("risk_score").alias("most"), F.min(F.col("updated_at") >= F.col("created_at")).alias("order"), F.min(F.col("transaction_id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")).alias("form")).first()
    assert x.ids == 5000 and x.low == 0 and 3000 < x.mid < 5000 and x.most <= 1 and x.order and x.form and abs(x.risk - 0.2) < 0.01
    y = t.agg(F.avg((F.col("amount_minor") == 0).cast("int")).alias("zero"), F.avg((F.col("status") == "PENDING").cast("int")).alias("pending"), F.min((F.col("status") == F.col("event_type")) | (F.col("status") == "PENDING")).alias("same")).first()
    assert 0.002 < y.zero < 0.009 and 0.02 < y.pending < 0.04 and y.same
    assert generators.conform(c, [("email", False), ("phone", True)]).columns == ["email", "phone"]
    with pytest.raises(ValueError, match="phone"):
        generators.conform(c, [("phone", False)])
    bad = generators.with_bad_rows(t, t.limit(2), [{"amount_minor": F.lit(-5)}, {"currency": F.lit("ZZ")}])
    assert bad.count() == 5004 and bad.where("amount_minor < 0").count() == 2 and bad.where("currency = 'ZZ'").count() == 2 and bad.columns == t.columns


def test_strata_have_their_exact_counts(spark):
    """All rows: the given counts. Fewer: quotas that add up."""
    for make, column, weights in ((lambda n: generators.customers(spark, n, 3), "country", generators.COUNTRIES), (lambda n: generators.transactions(spark, n, 50, 3), "currency", generators.CURRENCIES)):
        for n in (sum(weights.values()), 1_000, 7):
            got = {r[column]: r["count"] for r in make(n).groupBy(column).count().collect()}
            assert got == {k: c for k, c in generators.quotas(weights, n).items() if c}
    assert generators.quotas(generators.COUNTRIES, 50_000) == generators.COUNTRIES and sum(generators.quotas(generators.CURRENCIES, 12_345).values()) == 12_345


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1_000, 4_099])
def test_permutation(spark, n):
    rows = spark.range(n).select("id", generators.permuted(1, "x", n).alias("p"), generators.permuted(2, "x", n).alias("q")).orderBy("id").collect()
    assert sorted(r.p for r in rows) == sorted(r.q for r in rows) == list(range(n))
    if n >= 1_000:  # neighbours are far apart, and seeds differ
        gaps = [abs(a.p - b.p) for a, b in zip(rows, rows[1:], strict=False)]
        assert 0.2 * n < sum(gaps) / len(gaps) < 0.5 * n and len(set(gaps)) > n // 4 and sum(r.p == r.q for r in rows) < 20


def test_fixture_gate(spark):
    df = spark.createDataFrame([("a" * 64, 1), ("b" * 64, 2), (None, 3)], "id string, n int")
    rules = q.load_suite({"expectation_suite_name": "s", "expectations": [{"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "n", "min_value": 0}}]})
    strata = spark.createDataFrame([("x", 2, 2), ("y", 1, 1)], "stratum string, source long, sampled long")
    good = fixtures.gate(df, rules, ["id", "n"], fixtures.content(df), strata, 1, ["id"])
    assert good.isEmpty() and tuple(fixtures.passed(good).first()) == (True, 0, 0)
    changed = fixtures.gate(df.withColumn("extra", F.lit(1)), rules, ["id", "m"], fixtures.content(df), strata.where("source > 5"), 1, ["id", "n"])
    assert {(r.level, r.finding, r.name) for r in changed.collect()} == {("error", "suite column not in contract", "n"), ("error", "fixture column not in contract", "extra"), ("error", "fixture column not in contract", "n"), ("warning", "fixture is stale", "m"), ("error", "content differs from the manifest", None), ("error", "no strata are recorded", None), ("error", "values that aren't tokens", "n")}


def test_result_formats(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (-4,)], "n int")
    rules = q.load_suite({"expectation_suite_name": "s", "expectations": [{"expectation_type": f"expect_column_values_{k}", "kwargs": a} for k, a in (("to_be_unique", {"column": "n"}), ("to_match_regex", {"column": "n", "regex": "["}), ("to_be_between", {"column": "n", "min_value": 0}))]})
    found, rows = q.validate(df, rules, "COMPLETE")
    assert {(r.ordinal, r.success, r.unexpected_count, r.sample) for r in found.collect()} == {(0, False, 2, "1"), (1, False, 0, None), (2, False, 1, "-4")}
    assert sorted((r.n, len(r.expectation)) for r in rows.collect()) == [(-4, 1), (1, 1), (1, 1)] and q.validate(df, rules)[1] is None
    with pytest.raises(ValueError):
        q.validate(df, rules, "BASIC")
    with pytest.raises(NotImplementedError):
        q.validate(df, rules, engine="pandas")
    assert q.samples(df, []).isEmpty() and q.offending(df.limit(0), rules).isEmpty()
