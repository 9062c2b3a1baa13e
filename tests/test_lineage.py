"""The scan of sources: columns by line, wildcards, names made at run time, aliases, scopes of SQL, registration findings."""

import pytest

from accordium.operators import governance as gov
from accordium.plans import lineage, scopes

NAMED = [("sales.orders", "shop.sales.orders-value", "shop.sales.orders", "s3a://shop/orders"), ("hr.staff", "shop.hr.staff-value", "shop.hr.staff", "s3a://shop/staff")]
LOAD = 'orders = spark.read.parquet("s3a://shop/orders")\n'


def used(spark, *files):
    named = spark.createDataFrame(NAMED, "dataset string, subject string, topic string, delta_path string")
    facts = lineage.scan(spark.createDataFrame(list(files), "consumer string, path string, source string"))
    refs = lineage.references(facts, named)
    rows = lineage.usage(facts, refs).unionByName(scopes.sql_usage(scopes.sql_uses(facts), refs, named))
    return refs.collect(), rows.collect()


def test_fields_by_line(spark):
    job = 'TOPICS = "shop.hr.other,shop.sales.orders"\nstream = spark.readStream.option("subscribe", TOPICS).load()\nparts = stream.select(F.col("o.price"), "o.ordered_at")\nbusy = parts.filter("o.state <> \'done\' or price > 9").groupBy("region").agg(F.max("price"))\n'
    refs, rows = used(spark, ("depot", "jobs/load.py", job))
    assert {(r.dataset, r.kind, r.line) for r in refs} == {("sales.orders", "topic", 1)}
    assert {(r.name, r.line, r.qualified) for r in rows} == {("price", 3, True), ("ordered_at", 3, True), ("state", 4, True), ("price", 4, False), ("region", 4, False)}


@pytest.mark.parametrize(("code", "name"), [("orders.select(F.lit(1), '*')", "*"), ("orders.select(names(), 'x.*')", "*"), ("orders.selectExpr('region', '*')", "*"), ("orders.drop(*wanted)", None), ("orders.groupBy(F.col(prefix + '_id'))", None), ("orders.where(f'{field} > 1')", None), ("orders.select(['a_%s' % k for k in keys])", None), ("orders.sort('{}_at'.format(kind))", None)])
def test_all_and_what_cannot_be_told(spark, code, name):
    _, rows = used(spark, ("depot", "load.py", LOAD + code + "\n"))
    assert name in [r.name for r in rows if r.dataset == "sales.orders"]


def test_own_names_are_no_fields(spark):
    code = LOAD + "t = orders.withColumn('net', F.col('gross') - F.col('tax')).withColumnRenamed('sku', 'article')\nt.selectExpr('net * 2 as twice').select('twice', 'article', F.lower('city').alias('town')).orderBy('town')\n"
    _, rows = used(spark, ("depot", "load.py", code))
    assert {r.name for r in rows} == {"gross", "tax", "sku", "city"}


def test_sql_files_and_others(spark):
    sql = "-- staff by city; 'no' table\nselect city,\n       count(distinct person_id) as n\nfrom parquet.`s3a://shop/staff/part=1`\nwhere note <> 'shop.sales.orders'\ngroup by city;\n\nselect *\nfrom elsewhere"
    refs, rows = used(spark, ("bi", "q.sql", sql), ("bi", "broken.py", "def ("), ("bi", "none.py", None), ("bi", "empty.sql", ""))
    assert {(r.dataset, r.kind) for r in refs} == {("hr.staff", "delta_path"), ("sales.orders", "topic")}
    assert {(r.dataset, r.name, r.line) for r in rows} == {("hr.staff", "city", 2), ("hr.staff", "person_id", 3), ("hr.staff", "note", 5), ("hr.staff", "city", 6)}


def test_columns_of_other_tables_are_not_charged(spark):
    """A join of two datasets in Python's spark.sql: each column counts for its own."""
    code = 'spark.sql("""\nselect o.region, s.name\nfrom parquet.`s3a://shop/orders` o\njoin parquet.`s3a://shop/staff` s on s.person_id = o.seller\n""")\n'
    _, rows = used(spark, ("bi", "job.py", code))
    assert {(r.dataset, r.name, r.line) for r in rows} == {("sales.orders", "region", 2), ("hr.staff", "name", 2), ("hr.staff", "person_id", 4), ("sales.orders", "seller", 4)}


def test_unparsable_sql_fails_closed(spark):
    _, rows = used(spark, ("bi", "q.sql", "select region from parquet.`s3a://shop/orders`;\nselect frm where 's3a://shop/orders' !!"))
    assert {(r.dataset, r.name, r.line) for r in rows} == {("sales.orders", "region", 1), ("sales.orders", None, 2)}


SCOPES = {
    "two lines": ("select a,\n b from t", {(1, "t", "a"), (2, "t", "b")}),
    "cte": ("with x as (select a, b as c from t where d > 1) select x.c, a from x where c > 2", {(1, "t", n) for n in "abd"}),
    "cte over a cte": ("with x as (select * from t), y as (select a from x) select a, z from y, u", {(1, "t", "*"), (1, "t", "a"), (1, "u", "z")}),
    "self join": ("select l.a, r.b from t l join t r on l.k = r.parent", {(1, "t", n) for n in ("a", "b", "k", "parent")}),
    "using": ("select a.x from t a join u b using (id)", {(1, "t", "x"), (1, "t", "id"), (1, "u", "id")}),
    "unqualified in a join": ("select x from t, u", {(1, "t", "x"), (1, "u", "x")}),
    "derived beside a table": ("select k, v from (select a as k from t) s, u", {(1, "t", "a"), (1, "u", "v")}),
    "correlated": ("select a from t where exists (select 1 from u where u.k = t.k and q > 0)", {(1, "t", "a"), (1, "t", "k"), (1, "u", "k"), (1, "u", "q")}),
    "in and scalar": ("select (select max(m) from w) as mx from t where a in (select b from u)", {(1, "w", "m"), (1, "t", "a"), (1, "u", "b")}),
    "aliases in clauses": ("select a + b as s, count(*) as n from t group by s having n > 1 order by s, n", {(1, "t", "a"), (1, "t", "b")}),
    "order by a hidden column": ("select a as x from t order by x, b", {(1, "t", "a"), (1, "t", "b")}),
    "later items": ("select a as x, x + b as y from t", {(1, "t", "a"), (1, "t", "b")}),
    "star of one": ("select l.*, r.b from t l, u r", {(1, "t", "*"), (1, "u", "b")}),
    "star of a query": ("select * from (select a, b from t) where a > 1", {(1, "t", "a"), (1, "t", "b")}),
    "union": ("select a from t union all select b from u order by a", {(1, "t", "a"), (1, "u", "b")}),
    "lateral view": ("select item, t.id from t lateral view explode(items) e as item", {(1, "t", "items"), (1, "t", "id")}),
    "lambda": ("select transform(xs, e -> e + y) from t", {(1, "t", "xs"), (1, "t", "y")}),
    "nested field": ("select s.f.g, t.s.h from t", {(1, "t", "s")}),
    "qualified table": ("select db.t.a, t.b from db.t", {(1, "db.t", "a"), (1, "db.t", "b")}),
    "insert": ("insert into z select a from t", {(1, "t", "a")}),
    "create": ("create table z as select a from t", {(1, "t", "a")}),
    "column aliases": ("with x(p, q) as (select a, b from t) select p from x where q > 1", {(1, "t", "a"), (1, "t", "b")}),
    "lateral join": ("select o.a, l.m from t o, lateral (select max(v) as m from u where u.k = o.k) l", {(1, "t", "a"), (1, "t", "k"), (1, "u", "v"), (1, "u", "k")}),
    "window": ("select row_number() over (partition by p order by o) as r from t", {(1, "t", "p"), (1, "t", "o")}),
    "from first": ("from t |> where a > 1 |> select b", {(1, "t", "a"), (1, "t", "b")}),
    "values": ("select a from values (1) v(a)", set()),
    "case": ("select A.x from T a where a.Y = 1", {(1, "T", "x"), (1, "T", "Y")}),
}


@pytest.mark.parametrize("name", SCOPES)
def test_scopes(spark, name):
    text, want = SCOPES[name]
    assert {(line, table, column) for line, table, column, _ in scopes.column_uses(spark, text)} == want


def test_statements():
    text = "select ';' as a -- ; no end\n; /* ; */ select `x;y`\n;\n"
    assert [(n, s.strip()) for n, s in scopes.statements(text)] == [(0, "select ';' as a -- ; no end"), (1, "/* ; */ select `x;y`"), (2, "")]


def test_registration(spark):
    found = spark.createDataFrame([("a", "pay.tx"), ("b", "pay.tx")], "consumer string, dataset string")
    declared = spark.createDataFrame([("a", "pay.tx", "ra"), ("c", "pay.tx", "rc"), ("c", "gone", "rc"), ("d", "pay.tx", "rd")], "consumer string, dataset string, repo string")
    repos, owners = spark.createDataFrame([("ra",), ("rc",)], "repo string"), spark.createDataFrame([("a",), ("c",)], "consumer string")
    known = spark.createDataFrame([("pay.tx",), ("crm.people",)], "dataset string")
    got = {tuple(r) for r in gov.registration_findings(found, declared, known, repos, owners).collect()}
    assert got == {("b", "pay.tx", "UNREGISTERED CONSUMER"), ("c", "gone", "UNKNOWN DATASET"), ("c", "pay.tx", "STALE LINEAGE"), ("d", None, "MISSING CONSUMER REPO"), ("d", None, "NO CODEOWNER")}
