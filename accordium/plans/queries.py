"""Registered queries over the given tables and their SQL. Each name's operators are listed in the README."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import governance as gov
from ..operators import quality as q
from ..operators import quarantine as qr
from ..operators import registry as reg
from ..operators import reports as rep
from ..operators import sampling as sm
from ..session import scratch, table, written
from ..sources import generators as gen
from ..sources import lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
KEY = bytes(range(32))


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def rule(kind: str, **kwargs) -> dict:
    return {"expectation_type": "expect_" + kind, "kwargs": kwargs}


def suite(*rules: dict) -> list[q.Rule]:
    return q.load_suite({"expectation_suite_name": "suite", "expectations": list(rules)})


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]
ORDERS = suite(
    rule("table_row_count_to_be_between", min_value=1), rule("column_values_to_not_be_null", column="o_orderkey"), rule("column_values_to_be_unique", column="o_orderkey"),
    rule("column_values_to_be_between", column="o_totalprice", min_value=2000, max_value=400000), rule("column_values_to_be_in_set", column="o_orderstatus", value_set=["F", "O"]), rule("column_value_lengths_to_equal", column="o_orderstatus", value=1),
)
CUSTOMER = suite(
    rule("table_row_count_to_be_between", min_value=100_000_000), rule("column_values_to_not_be_null", column="c_name"), rule("column_values_to_match_regex", column="c_name", regex="^Customer#0*[1-9][0-9]*[02468]$"),
    rule("column_values_to_be_between", column="c_acctbal", min_value=0), rule("column_values_to_be_in_set", column="c_mktsegment", value_set=SEGMENTS), rule("column_value_lengths_to_equal", column="c_mktsegment", value=9), rule("column_values_to_not_be_null", column="c_missing"),
)
LINEITEM = suite(rule("column_values_to_be_unique", column="l_orderkey"), rule("column_values_to_be_between", column="l_quantity", max_value=45), rule("column_pair_values_a_to_be_greater_than_b", column_A="l_extendedprice", column_B="l_quantity", or_equal=True, ignore_row_if="either_value_is_missing"), rule("column_values_to_be_in_set", column="l_returnflag", value_set=["A", "N"]))


def _row(i: int, kind: str, target: str, success: str, count: str, src: str, error: str = "cast(null as varchar)") -> str:
    return f"select {i} as ordinal, 'expect_{kind}' as expectation, '{target}' as target, {success} as success, cast({count} as bigint) as unexpected_count, {error} as error from {src}"


def _counted(i: int, kind: str, target: str, pred: str, src: str) -> str:
    return _row(i, kind, target, f"count(*) filter ({pred}) = 0", f"count(*) filter ({pred})", src)


def _dups(i: int, column: str, src: str) -> str:
    return _row(i, "column_values_to_be_unique", column, "coalesce(sum(n), 0) = 0", "coalesce(sum(n), 0)", f"(select count(*) as n from {src} where {column} is not null group by {column} having count(*) > 1)")


@query(" union all ".join([_row(0, "table_row_count_to_be_between", "(table)", "count(*) >= 1", "0", "orders"), _counted(1, "column_values_to_not_be_null", "o_orderkey", "o_orderkey is null", "orders"), _dups(2, "o_orderkey", "orders"), _counted(3, "column_values_to_be_between", "o_totalprice", "o_totalprice < 2000 or o_totalprice > 400000", "orders"), _counted(4, "column_values_to_be_in_set", "o_orderstatus", "o_orderstatus not in ('F', 'O')", "orders"), _counted(5, "column_value_lengths_to_equal", "o_orderstatus", "length(o_orderstatus) <> 1", "orders")]))
def suite_summary_orders(spark, d):
    return q.summary(table(spark, d, "orders"), ORDERS)


@query(" union all ".join([_row(0, "table_row_count_to_be_between", "(table)", "count(*) >= 100000000", "0", "customer"), _counted(1, "column_values_to_not_be_null", "c_name", "c_name is null", "customer"), _counted(2, "column_values_to_match_regex", "c_name", "not regexp_matches(c_name, '^Customer#0*[1-9][0-9]*[02468]$')", "customer"), _counted(3, "column_values_to_be_between", "c_acctbal", "c_acctbal < 0", "customer"), _counted(4, "column_values_to_be_in_set", "c_mktsegment", "c_mktsegment not in ('AUTOMOBILE', 'BUILDING', 'FURNITURE')", "customer"), _counted(5, "column_value_lengths_to_equal", "c_mktsegment", "length(c_mktsegment) <> 9", "customer"), _row(6, "column_values_to_not_be_null", "c_missing", "false", "0", "(select 1)", "'column c_missing is missing'")]))
def suite_summary_customer(spark, d):
    return q.summary(table(spark, d, "customer"), CUSTOMER)


LINEITEM_SQL = " union all ".join([_dups(0, "l_orderkey", "lineitem"), _counted(1, "column_values_to_be_between", "l_quantity", "l_quantity > 45", "lineitem"), _counted(2, "column_pair_values_a_to_be_greater_than_b", "l_extendedprice,l_quantity", "l_extendedprice < l_quantity", "lineitem"), _counted(3, "column_values_to_be_in_set", "l_returnflag", "l_returnflag not in ('A', 'N')", "lineitem")])


@query(LINEITEM_SQL)
def suite_summary_lineitem(spark, d):
    return q.summary(table(spark, d, "lineitem"), LINEITEM)


@query(f"select bool_and(success) as passed, count(*) filter (not success) as failed from ({LINEITEM_SQL})")
def suite_verdict(spark, d):
    return q.verdict(q.summary(table(spark, d, "lineitem"), LINEITEM))


@query("select 0 as ordinal, 'table_row_count_to_be_between((table))' as label from (select count(*) as n from customer) where n < 100000000 union all select 6, 'column_values_to_not_be_null(c_missing) [error: column c_missing is missing]'")
def table_level_failures(spark, d):
    return q.table_failures(q.summary(table(spark, d, "customer"), CUSTOMER))


CUSTOMER_BAD = """select c_custkey, concat_ws(';', case when not regexp_matches(c_name, '^Customer#0*[1-9][0-9]*[02468]$') then 'column_values_to_match_regex(c_name)' end,
 case when c_acctbal < 0 then 'column_values_to_be_between(c_acctbal)' end, case when c_mktsegment not in ('AUTOMOBILE', 'BUILDING', 'FURNITURE') then 'column_values_to_be_in_set(c_mktsegment)' end,
 case when length(c_mktsegment) <> 9 then 'column_value_lengths_to_equal(c_mktsegment)' end) as labels from customer"""


@query(f"select * from ({CUSTOMER_BAD}) where labels <> ''")
def offending_rows_customer(spark, d):
    return q.offending(table(spark, d, "customer"), CUSTOMER).select("c_custkey", F.concat_ws(";", "expectation").alias("labels"))


@query("""select l_orderkey, l_linenumber, concat_ws(';', case when n > 1 then 'column_values_to_be_unique(l_orderkey)' end, case when l_quantity > 45 then 'column_values_to_be_between(l_quantity)' end,
 case when l_extendedprice < l_quantity then 'column_pair_values_a_to_be_greater_than_b(l_extendedprice,l_quantity)' end, case when l_returnflag not in ('A', 'N') then 'column_values_to_be_in_set(l_returnflag)' end) as labels
 from (select *, count(*) over (partition by l_orderkey) as n from lineitem) where n > 1 or l_quantity > 45 or l_extendedprice < l_quantity or l_returnflag not in ('A', 'N')""")
def offending_labels_lineitem(spark, d):
    return q.offending(table(spark, d, "lineitem"), LINEITEM).select("l_orderkey", "l_linenumber", F.concat_ws(";", "expectation").alias("labels"))


def _violations(name: str, tab: str, key: str, r: dict, sql: str, prepare=None) -> None:
    def run(spark, d):
        df = table(spark, d, tab)
        return q.offending(prepare(df) if prepare else df, suite(r)).select(key)

    run.__name__ = name
    query(sql)(run)


_violations("notnull_violations", "customer", "c_custkey", rule("column_values_to_not_be_null", column="v"), "select c_custkey from customer where c_mktsegment = 'BUILDING'", lambda df: df.withColumn("v", F.nullif("c_mktsegment", F.lit("BUILDING"))))
_violations("unique_violations", "lineitem", "l_orderkey", rule("column_values_to_be_unique", column="k"), "select l_orderkey from (select *, count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem) where n > 1", lambda df: df.withColumn("k", F.concat_ws("-", "l_orderkey", "l_linenumber")))
_violations("regex_violations", "customer", "c_custkey", rule("column_values_to_match_regex", column="c_name", regex="[13579]$"), "select c_custkey from customer where not regexp_matches(c_name, '[13579]$')")
_violations("between_violations", "orders", "o_orderkey", rule("column_values_to_be_between", column="o_totalprice", min_value=5000, max_value=300000), "select o_orderkey from orders where o_totalprice < 5000 or o_totalprice > 300000")
_violations("length_violations", "part", "p_partkey", rule("column_value_lengths_to_equal", column="p_brand", value=8), "select p_partkey from part where length(p_brand) <> 8")
_violations("inset_violations", "events", "event_id", rule("column_values_to_be_in_set", column="event_type", value_set=["click", "view"]), "select event_id from events where event_type not in ('click', 'view')")


@query("select l_orderkey, l_linenumber, cast(o_orderdate as varchar) as o, cast(l_shipdate as varchar) as s from lineitem join orders on l_orderkey = o_orderkey where l_shipdate < o_orderdate")
def pair_violations(spark, d):
    joined = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    bad = q.offending(joined, suite(rule("column_pair_values_a_to_be_greater_than_b", column_A="l_shipdate", column_B="o_orderdate", or_equal=True)))
    return bad.select("l_orderkey", "l_linenumber", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("s"))


@query("select 0 as ordinal, 'column_values_to_be_in_set(c_mktsegment)' as label, string_agg(v, '|' order by v) as sample from (select distinct c_mktsegment as v from customer where c_mktsegment not in ('AUTOMOBILE', 'BUILDING', 'FURNITURE') order by v limit 5)")
def unexpected_samples(spark, d):
    return q.samples(table(spark, d, "customer"), suite(rule("column_values_to_be_in_set", column="c_mktsegment", value_set=SEGMENTS)))


PRINT = "sha256(concat_ws(chr(31), coalesce('v' || o_custkey, 'n'), coalesce('v' || o_orderkey, 'n'), coalesce('v' || o_orderstatus, 'n')))"


def _quarantine(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    bad = q.offending(orders, suite(rule("column_values_to_be_in_set", column="o_orderstatus", value_set=["F", "O"])))
    return qr.evidence(bad, {"dataset": "orders", "suite": "orders", "run_ts": 1, "source_version": 3})


STORED = "o_orderkey % 3 = 0"
BAD = f"(select o_orderkey, o_custkey, o_orderstatus, {PRINT} as row_fingerprint from orders where o_orderstatus not in ('F', 'O'))"


@query(f"select row_fingerprint, o_orderkey, 'orders' as dataset, 'column_values_to_be_in_set(o_orderstatus)' as labels from {BAD} where row_fingerprint not in (select row_fingerprint from {BAD} where o_orderkey % 3 = 0)")
def quarantine_new(spark, d):
    rows = _quarantine(spark, d)
    return qr.new_rows(rows, rows.where(STORED)).select("row_fingerprint", "o_orderkey", "dataset", F.concat_ws(";", "expectation").alias("labels"))


@query(f"select count(*) as held, cast(sum(case when o_orderkey in (select l_orderkey from lineitem) then 1 else 0 end) as bigint) as live from {BAD}")
def quarantine_still_in_source(spark, d):
    rows = _quarantine(spark, d)
    live = qr.still_in_source(rows, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    return rows.agg(F.count(F.lit(1)).alias("held")).crossJoin(live.agg(F.count(F.lit(1)).alias("live")))  # one row each


@query(f"with b as (select * from {BAD}), s as (select distinct row_fingerprint from b where o_orderkey % 3 = 0) select added, before + added as total from (select count(*) as added from b where row_fingerprint not in (select * from s)), (select count(*) as before from s)")
def quarantine_totals(spark, d):
    rows = _quarantine(spark, d)
    return qr.totals(rows, rows.where(STORED))


MINOR = "cast(round(o_totalprice * 100) as bigint)"


@query("select strftime(o_orderdate, '%Y-%m-%d') as day, o_orderstatus, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as minor, count(*) as n from orders group by all")
def daily_totals(spark, d):
    return table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus").agg(F.sum(F.expr(MINOR)).alias("minor"), F.count(F.lit(1)).alias("n"))


@query("select o_custkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') as week, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as minor from orders group by all")
def weekly_spend(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey", F.date_format(F.date_trunc("week", "o_orderdate"), "yyyy-MM-dd").alias("week")).agg(F.sum(F.expr(MINOR)).alias("minor"))


def _hmac_sql(value: str) -> str:
    inner, outer = fn.hmac_pads(KEY)
    blob = lambda b: "'" + "".join(f"\\x{x:02X}" for x in b) + "'::blob"
    return f"sha256({blob(outer)} || unhex(sha256({blob(inner)} || encode({value}))))"


@query(f"select c_custkey, {_hmac_sql('c_name')} as token from customer")
def tokenize_platform(spark, d):
    return table(spark, d, "customer").select("c_custkey", fn.token("c_name", KEY).alias("token"))


@query(f"select c_custkey, {_hmac_sql(chr(39) + 'c_name:' + chr(39) + ' || c_name')} as token from customer")
def tokenize_fixture(spark, d):
    return table(spark, d, "customer").select("c_custkey", fn.token(F.concat(F.lit("c_name:"), "c_name"), KEY).alias("token"))


@query(f"select c_custkey, {_hmac_sql(chr(39) + 'erasure-subject|' + chr(39) + ' || c_custkey')} as subject_hash from customer")
def subject_hash(spark, d):
    return table(spark, d, "customer").select("c_custkey", fn.token(F.concat(F.lit("erasure-subject|"), F.col("c_custkey").cast("string")), KEY).alias("subject_hash"))


def _deks(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", F.unhex(F.sha2(F.concat(F.lit("dek|"), F.col("c_custkey").cast("string")), 256)).alias("dek"))


@query("select c_custkey, c_name as plain, true as sealed from customer")
def encrypt_roundtrip(spark, d):
    aad = F.concat(F.col("c_custkey").cast("string"), F.lit("|customer.c_name"))
    sealed = _deks(spark, d).withColumn("blob", fn.encrypt("c_name", F.col("dek"), aad))
    return sealed.select("c_custkey", fn.decrypt("blob", F.col("dek"), aad).alias("plain"), fn.is_encrypted("blob").alias("sealed"))


@query("select c_custkey, cast(null as varchar) as plain from customer")
def encrypt_tamper_null(spark, d):
    aad = lambda c: F.concat(F.col("c_custkey").cast("string"), F.lit(f"|customer.{c}"))
    sealed = _deks(spark, d).withColumn("blob", fn.encrypt("c_name", F.col("dek"), aad("c_name")))
    return sealed.select("c_custkey", fn.decrypt("blob", F.col("dek"), aad("c_phone"), strict=False).alias("plain"))


@query("select count(*) as n, cast(0 as bigint) as reused from customer")
def nonce_reuse_audit(spark, d):
    from ..operators.crypto import audited

    sealed = _deks(spark, d).select("c_custkey", F.lit(1).alias("scope"), fn.encrypt("c_name", F.col("dek"), F.lit("x")).alias("blob"))
    return audited(sealed, "blob", "scope")


@query("""with v as (select c_custkey, case when c_custkey % 2 = 0 then lower(c_mktsegment) else left(c_name, 3) end as l from customer)
select c_custkey, (case when length(l) > 4 then left(l, 2) || repeat('•', greatest(length(l) - 4, 3)) || right(l, 2) else left(l, 1) || '•••' end) || '@example.com' as masked from v""")
def email_mask(spark, d):
    local = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.left("c_name", F.lit(3)))
    return table(spark, d, "customer").select("c_custkey", fn.mask_email(F.concat(local, F.lit("@example.com"))).alias("masked"))


@query("select s_suppkey, substr(sha256('fingerprint:' || s_name), 1, 12) as fingerprint from supplier")
def key_fingerprint(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", fn.key_fingerprint("s_name").alias("fingerprint"))


@query("select page_id, rtrim(regexp_replace(replace(url, 'https://', 's3a://'), '^s3[an]?://', 's3://'), '/') as path from pages")
def path_normal(spark, d):
    return table(spark, d, "pages").select("page_id", fn.normal_path(F.replace("url", F.lit("https://"), F.lit("s3a://"))).alias("path"))


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as utc from events")
def epoch_text(spark, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("select 'c_name' as \"column\", count(*) filter (c_custkey % 7 = 0) as leaked from customer union all select 'c_mktsegment', count(*) from customer")
def pii_leak_counts(spark, d):
    c = table(spark, d, "customer").select(F.when(F.col("c_custkey") % 7 != 0, fn.token("c_name", KEY)).otherwise(F.col("c_name")).alias("c_name"), "c_mktsegment")
    return gov.leaks(c, ["c_name", "c_mktsegment"], fn.TOKEN)


#: Patterns of names that look personal, in order.
PATTERNS = ((1, "(^|_)name$"), (2, "e?mail"), (3, "(^|_)ip($|_)"), (4, "p00"))


def _fields(spark, d, low: int, high: int) -> DataFrame:
    """Fields of datasets, derived from parts: brands are datasets, types' first words decide the type."""
    return table(spark, d, "part").where(F.col("p_size").between(low, high)).select(F.col("p_brand").alias("dataset"), F.concat(F.lit("p"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("name"), F.when(F.col("p_size") % 7 == low % 7, "long").otherwise("string").alias("type"))


def _fields_sql(low: int, high: int) -> str:
    return f"(select p_brand as dataset, 'p' || lpad(cast(p_partkey as varchar), 6, '0') as name, case when p_size % 7 = {low % 7} then 'long' else 'string' end as type from part where p_size between {low} and {high})"


@query(f"select dataset as \"table\", name, 'p00' as pattern from {_fields_sql(1, 50)} where name like '%p00%'")
def pii_name_detection(spark, d):
    return gov.suspicious(_fields(spark, d, 1, 50).withColumnRenamed("dataset", "table"), spark.createDataFrame(PATTERNS, "ord int, pattern string"))


@query(f"select dataset as \"table\", name, 'p00' as pattern from {_fields_sql(1, 50)} where name like '%p00%' and type <> 'long'")
def pii_unclassified(spark, d):
    fields = _fields(spark, d, 1, 50).withColumnRenamed("dataset", "table")
    return gov.unclassified(fields, spark.createDataFrame(PATTERNS, "ord int, pattern string"), fields.where("type = 'long'"))


@query("""select p_brand as "table", p_name || p_partkey as name, case when p_size % 5 = 0 then 'DELETED' else 'DOWNGRADED' end as finding from part where (p_size % 5 = 0 and p_size % 3 > 0 and p_partkey % 2 = 0) or (p_size % 5 = 1 and p_size % 3 > 0)""")
def classification_downgrades(spark, d):
    part = table(spark, d, "part").select(F.col("p_brand").alias("table"), F.concat("p_name", "p_partkey").alias("name"), "p_size", "p_partkey")
    cls = F.when(F.col("p_size") % 3 == 0, "NOT_PII").when(F.col("p_size") % 3 == 1, "QUASI_IDENTIFIER").otherwise("DIRECT_IDENTIFIER")
    treat = F.when(F.col("p_size") % 3 == 0, "NONE").otherwise("TOKENIZE_HMAC")
    base = part.select("table", "name", cls.alias("class"), treat.alias("treatment"))
    head = part.where("p_size % 5 <> 0").select("table", "name", F.when(F.col("p_size") % 5 == 1, "NOT_PII").otherwise(cls).alias("class"), F.when(F.col("p_size") % 5 == 1, "NONE").otherwise(treat).alias("treatment"))
    return gov.downgrades(base, head, part.where("p_partkey % 2 = 0").select("table", "name"))


DIFF = f"(select coalesce(b.dataset, h.dataset) as dataset, coalesce(b.name, h.name) as name, coalesce(b.type, h.type) as type, case when h.name is null then 'removed' when b.name is null then 'added' when b.type <> h.type then 'changed' end as change from {_fields_sql(1, 40)} b full join {_fields_sql(10, 50)} h on b.dataset = h.dataset and b.name = h.name where h.name is null or b.name is null or b.type <> h.type)"


def _diff(spark, d):
    return gov.field_diff(_fields(spark, d, 1, 40), _fields(spark, d, 10, 50))


@query(f"select * from {DIFF}")
def field_diff(spark, d):
    return _diff(spark, d)


RENAMES = f"with x as (select *, count(*) over (partition by dataset, type, change) as n, row_number() over (partition by dataset, type, change order by name) as r from {DIFF} where change <> 'changed') select r.dataset, r.name as old, a.name as new from x r join x a using (dataset, type) where r.change = 'removed' and a.change = 'added' and r.r = 1 and a.n = 1"


@query(RENAMES)
def rename_guess(spark, d):
    return gov.renames(_diff(spark, d))


#: Line items are uses: suppliers read parts; every eleventh reads all of a dataset, of some others it can't be told what they read.
USAGE = "(select distinct l_suppkey as consumer, p_brand as dataset, case when l_suppkey % 11 = 0 then '*' when l_suppkey % 13 = 5 then null else 'p' || lpad(cast(p_partkey as varchar), 6, '0') end as name from lineitem join part on l_partkey = p_partkey)"
HITS = f"(select distinct u.consumer, u.dataset, r.name as field from {USAGE} u join {DIFF} r on r.dataset = u.dataset and r.change = 'removed' and (u.name = r.name or u.name = '*' or u.name is null))"
#: Who has registered for what: most consumers of most datasets.
REGISTERED = "(consumer + ascii(right(dataset, 1))) % 4 <> 0"


def _uses(spark, d):
    """Uses as they are found, repeated ones too."""
    used = table(spark, d, "lineitem").select("l_suppkey", "l_partkey").join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return used.select(F.col("l_suppkey").alias("consumer"), F.col("p_brand").alias("dataset"), F.when(F.col("l_suppkey") % 11 == 0, "*").when(F.col("l_suppkey") % 13 != 5, F.concat(F.lit("p"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"))).alias("name"))


def _usage(spark, d):
    return _uses(spark, d).distinct()


@query(f"select * from {HITS}")
def impact_affected(spark, d):
    return gov.affected(_uses(spark, d), _diff(spark, d))


@query(f"select consumer, field, dataset from {HITS} where {REGISTERED} and consumer % 3 <> 0 and not (consumer % 3 = 1 and right(field, 1) in ('0', '2', '4'))")
def impact_blocking(spark, d):
    uses = _uses(spark, d)
    hits = gov.impact(uses, _diff(spark, d))
    acks = hits.rows().where("consumer % 3 = 1 and right(field, 1) in ('0', '2', '4') and field <> '*'").select("consumer", "field").union(table(spark, d, "supplier").where("s_suppkey % 3 = 0").select("s_suppkey", F.lit("*")))
    return gov.blocking(hits, acks, registered=uses.where(REGISTERED)).rows()


@query(f"select consumer, dataset, field from {HITS} where not ({REGISTERED})")
def impact_unregistered(spark, d):
    uses = _uses(spark, d)
    return gov.unregistered(gov.impact(uses, _diff(spark, d)), uses.where(REGISTERED)).rows()


@query(f"select consumer, count(*) as acked from {HITS} where consumer % 3 = 0 group by all")
def ack_scope(spark, d):
    acks = table(spark, d, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("consumer"), F.lit("*").alias("field"))
    return gov.impact(_uses(spark, d), _diff(spark, d)).acked(acks).count("consumer", "acked")


@query("""with f as (select distinct o_custkey as consumer, o_orderpriority as dataset from orders where o_orderkey % 4 <> 0), g as (select distinct o_custkey as consumer, o_orderpriority as dataset from orders where o_orderkey % 4 <> 1)
select coalesce(f.consumer, g.consumer) as consumer, coalesce(f.dataset, g.dataset) as dataset, case when g.consumer is null then 'UNREGISTERED' else 'STALE' end as finding from f full join g on f.consumer = g.consumer and f.dataset = g.dataset where f.consumer is null or g.consumer is null""")
def lineage_drift(spark, d):
    pairs = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("consumer"), F.col("o_orderpriority").alias("dataset"))
    return gov.lineage_drift(pairs.where("o_orderkey % 4 <> 0"), pairs.where("o_orderkey % 4 <> 1"))


@query(f"""with h as {HITS}, b as (select * from h where consumer % 3 <> 0 and {REGISTERED}), w as (select * from h where not ({REGISTERED})), d as (select dataset, count(*) filter (change = 'removed') as removed, count(*) filter (change = 'changed') as retyped from {DIFF} group by all)
select dataset, removed, retyped, coalesce(a, 0) as affected, coalesce(k, 0) as blocking, coalesce(x, 0) as warned, coalesce(k, 0) = 0 as passed from d left join (select dataset, count(*) as a from h group by all) using (dataset) left join (select dataset, count(*) as k from b group by all) using (dataset) left join (select dataset, count(*) as x from w group by all) using (dataset) where removed + retyped > 0""")
def impact_verdict(spark, d):
    diff, uses = written(_diff(spark, d)), _uses(spark, d)
    hits, registered = gov.impact(uses, diff), uses.where(REGISTERED)
    acks = table(spark, d, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("consumer"), F.lit("*").alias("field"), F.lit("7").alias("change"))
    return gov.impact_verdict(diff, hits, gov.blocking(hits, acks, "7", registered), gov.unregistered(hits, registered))


@query("""with f as (select distinct o_custkey as consumer, o_orderpriority as dataset from orders where o_orderkey % 4 <> 0), g as (select distinct o_custkey as consumer, o_orderpriority as dataset, o_custkey % 50 as repo from orders where o_orderkey % 4 <> 1)
select consumer, dataset, 'UNREGISTERED CONSUMER' as finding from f where not exists (select 1 from g where g.consumer = f.consumer and g.dataset = f.dataset)
union all select consumer, dataset, 'UNKNOWN DATASET' from g where dataset = '5-LOW'
union all select consumer, dataset, 'STALE LINEAGE' from g where dataset <> '5-LOW' and repo <> 7 and not exists (select 1 from f where g.consumer = f.consumer and g.dataset = f.dataset)
union all select distinct consumer, null, 'MISSING CONSUMER REPO' from g where repo = 7
union all select distinct consumer, null, 'NO CODEOWNER' from g where consumer % 9 = 0""")
def registration_findings(spark, d):
    pairs = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("consumer"), F.col("o_orderpriority").alias("dataset"), (F.col("o_custkey") % 50).alias("repo"))
    datasets = pairs.select("dataset").distinct().where("dataset <> '5-LOW'")
    return gov.registration_findings(pairs.where("o_orderkey % 4 <> 0"), pairs.where("o_orderkey % 4 <> 1"), datasets, pairs.select("repo").distinct().where("repo <> 7"), pairs.select("consumer").where("consumer % 9 <> 0").distinct())


@query(f"select dataset, name, consumer from {USAGE} u where name <> '*' and not exists (select 1 from {_fields_sql(10, 50)} c where c.dataset = u.dataset and c.name = u.name)")
def dangling_fields(spark, d):
    return gov.dangling(_usage(spark, d), _fields(spark, d, 10, 50))


@query("with t as (select c_mktsegment as s, count(*) as n from customer group by all) select s as stratum, n as source, least(n, greatest(5, cast(floor(n * 0.05 + 0.5) as bigint))) as sampled, round(pow(0.95, n), 6) as bernoulli_miss from t")
def stratified_sample_counts(spark, d):
    c = table(spark, d, "customer")
    return sm.report(c, sm.stratified(c, "c_mktsegment", "c_custkey", 0.05, 5), "c_mktsegment", 0.05)


@query("select o_orderkey, o_orderpriority from (select *, row_number() over (partition by o_orderpriority order by sha256(cast(o_orderkey as varchar)), o_orderkey) as r, count(*) over (partition by o_orderpriority) as n from orders) where r <= least(n, greatest(5, cast(floor(n * 0.01 + 0.5) as bigint)))")
def stratified_sample_rows(spark, d):
    return sm.stratified(table(spark, d, "orders"), "o_orderpriority", "o_orderkey", 0.01, 5).select("o_orderkey", "o_orderpriority")


@query("with f as (select sha256(cast(o_orderkey as varchar) || '|' || o_orderstatus) as f from orders) select count(*) as n_rows, " + ", ".join(f"cast(cast(coalesce(sum(cast('0x' || substr(f, {1 + 8 * i}, 8) as bigint)), 0) as hugeint) as varchar) as h{i}" for i in range(4)) + " from f")
def content_hash(spark, d):
    return sm.content_hash(table(spark, d, "orders"), F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus"), 256))


@query("select l_returnflag as workspace, l_partkey as address, l_linenumber as path from lineitem where l_quantity = 25 group by all")
def drift_changes(spark, d):
    drawn = (F.col("l_quantity") == 25).cast("int")
    return gov.drift_changes(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("workspace"), F.col("l_partkey").alias("address"), F.col("l_linenumber").alias("path"), drawn.alias("before"), F.lit(0).alias("after")))


@query("""with x as (select c_custkey as address, c_mktsegment as path, c_nationkey as before, c_nationkey % 5 as after from customer), p as (select address, path, after as p0, case when address % 2 = 0 then before else before + 1 end as p1 from x)
select x.address, x.path, x.before, x.after from x join p on x.address = p.address and x.path = p.path where after = p0 and before = p1""")
def drift_reverts(spark, d):
    x = table(spark, d, "customer").select(F.col("c_custkey").alias("address"), F.col("c_mktsegment").alias("path"), F.col("c_nationkey").alias("before"), (F.col("c_nationkey") % 5).alias("after"))
    return gov.reverts(x, x.select("address", "path", F.col("after").alias("before"), F.when(F.col("address") % 2 == 0, F.col("before")).otherwise(F.col("before") + 1).alias("after")))


@query("select case when max(case when s_nationkey = 3 then 1 else 0 end) = 1 then 1 when max(case when s_acctbal < 0 then 1 else 0 end) = 1 then 2 else 0 end as exit_code from supplier")
def worst_exit(spark, d):
    return gov.worst_exit(table(spark, d, "supplier").select(F.when(F.col("s_nationkey") == 3, 1).when(F.col("s_acctbal") < 0, 2).otherwise(0).alias("code")))


@query("select event_type, count(*) as runs, median(value) as p50, quantile_disc(value, 0.9) as p90 from events group by all")
def gate_latency_quantiles(spark, d):
    return gov.latencies(table(spark, d, "events"), "event_type", "value")


@query("""with r as (select o_orderpriority as gate, o_orderstatus <> 'P' as done, case o_orderkey % 4 when 0 then 'failure' when 1 then 'cancelled' else 'success' end as conclusion, case when o_custkey % 9 > 0 then o_totalprice end as s, o_custkey % 5 = 0 as fast from orders),
d as (select * from r where done and conclusion <> 'cancelled'), f as (select gate, count(*) as full_checks, median(s) as p50, quantile_disc(s, 0.9) as p90 from (select gate, floor(s) as s from d where s is not null and not fast) group by gate)
select gate, count(*) as runs, count(*) filter (conclusion = 'failure') as rejections, coalesce(any_value(full_checks), 0) as full_checks, any_value(p50) as p50, any_value(p90) as p90 from d left join f using (gate) group by gate""")
def gate_rejections(spark, d):
    """Orders are runs: how many were rejected by gate, and how long full checks took."""
    o, key = table(spark, d, "orders"), F.col("o_custkey")
    started = F.col("o_orderdate").cast("timestamp")
    step = F.struct(F.when(key % 5 == 0, "Fast path: nothing changed").otherwise("Full check").alias("name"), F.lit("success").alias("conclusion"))
    runs = o.select(F.col("o_orderpriority").alias("gate"), F.when(F.col("o_orderstatus") == "P", "in_progress").otherwise("completed").alias("status"), F.when(F.col("o_orderkey") % 4 == 0, "failure").when(F.col("o_orderkey") % 4 == 1, "cancelled").otherwise("success").alias("conclusion"), started.alias("started"), F.when(key % 9 > 0, F.timestamp_seconds(F.unix_seconds(started) + F.floor("o_totalprice"))).alias("completed"), F.array(step).alias("steps"))
    return rep.gate_runs(runs)


def _metrics(spark, d):
    e = table(spark, d, "events").withColumn("label", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    name = F.element_at(F.array(*map(F.lit, ("checkpoint_pass", "quarantine_rows_last_run", "last_run_ts", "drift", "plan_ok"))), (F.col("event_id") % 5 + 1).cast("int"))
    return e.select(name.alias("name"), "label", F.when(F.col("event_id") % 5 == 2, F.unix_seconds(F.col("ts").cast("timestamp"))).otherwise(F.col("event_id") % 2).alias("value"))


METRICS = "(select ['checkpoint_pass', 'quarantine_rows_last_run', 'last_run_ts', 'drift', 'plan_ok'][event_id % 5 + 1] as name, 'u' || user_id as label, case when event_id % 5 = 2 then cast(floor(epoch(ts)) as bigint) else event_id % 2 end as value from events)"


@query(f"""select case name when 'checkpoint_pass' then 'CheckpointFailing' when 'quarantine_rows_last_run' then 'RowsQuarantined' when 'last_run_ts' then 'Stale' when 'drift' then 'Drift' else 'DriftCheckFailed' end as alert, label
 from (select name, label, max(value) as value from {METRICS} group by all) where (name in ('checkpoint_pass', 'plan_ok') and value = 0) or (name in ('quarantine_rows_last_run', 'drift') and value > 0) or (name = 'last_run_ts' and 1706659200 - value > 172800)""")
def alert_predicates(spark, d):
    return gov.alerts(_metrics(spark, d), 1706659200)


@query(f"select name || '{{label=\"' || label || '\"}} ' || value as line from (select name, label, max(value) as value from {METRICS} group by all)")
def metrics_exposition(spark, d):
    return gov.exposition(_metrics(spark, d).groupBy("name", "label").agg(F.max("value").alias("value")))


@query("""select 'panel{day="' || strftime(ts, '%Y-%m-%d') || '",kind="' || event_type || '",user="u\\"' || user_id % 3 || '"} ' || count(*) as line from events group by strftime(ts, '%Y-%m-%d'), event_type, user_id % 3""")
def labelled_exposition(spark, d):
    labels = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("day"), F.date_format("ts", "yyyy-MM-dd"), F.lit("user"), F.concat(F.lit('u"'), (F.col("user_id") % 3).cast("string")))
    series = table(spark, d, "events").select(F.to_json(labels).alias("key"), labels.alias("labels")).groupBy("key").agg(F.any_value("labels").alias("labels"), F.count(F.lit(1)).alias("value"))
    return gov.exposition(series.withColumn("name", F.lit("panel")))


PANEL_METRICS = ("erasure_completions_total", "ge_checkpoint_pass", "terraform_drift", "schema_gate_rejections_total", "quarantine_rows_total", "gate_latency_seconds", "terraform_drift_attribute")
PANEL_SQL = f"""(select {list(PANEL_METRICS)}[event_id % 7 + 1] as name, 'g' || user_id % 5 as gate, 'w' || user_id % 3 as workspace, ['0.5', '0.9'][event_id % 2 + 1] as quantile, 'a' || user_id % 4 as attribute, case when event_id % 7 = 1 then cast(user_id % 2 as double) else floor(value) end as value from events)"""
EACH_SQL = "'attribute=' || attribute || ',gate=' || gate || ',quantile=' || quantile || ',workspace=' || workspace"


def _panel(title: str, metric: str, how: str, labels: str = "''", where: str = "true", orelse: bool = False) -> str:
    value = f"coalesce({how}, 0)" if orelse else how
    return f"select '{title}' as panel, {labels} as labels, cast({value} as double) as value from {PANEL_SQL} where name = '{metric}' and {where}" + (" group by all" if labels != "''" else "" if orelse else " having count(*) > 0")


@query(" union all ".join([
    _panel("completed erasures", "erasure_completions_total", "max(value)"), _panel("failing checkpoints", "ge_checkpoint_pass", "count(*)", where="value = 0", orelse=True), _panel("drifted workspaces", "terraform_drift", "sum(value)", orelse=True),
    _panel("rejected changes", "schema_gate_rejections_total", "sum(value)", orelse=True), _panel("checkpoints", "ge_checkpoint_pass", "max(value)", EACH_SQL), _panel("quarantined rows", "quarantine_rows_total", "max(value)", EACH_SQL),
    _panel("quarantined rows of the last run", "quarantine_rows_last_run", "max(value)", EACH_SQL), _panel("rejections by gate", "schema_gate_rejections_total", "max(value)", "'gate=' || gate"), _panel("median latency by gate", "gate_latency_seconds", "max(value)", "'gate=' || gate", "quantile = '0.5'"),
    _panel("drift by workspace", "terraform_drift", "max(value)", "'workspace=' || workspace"), _panel("drifted attributes", "terraform_drift_attribute", "max(value)", "'attribute=' || attribute || ',resource=,workspace=' || workspace"),
]))
def dashboard_panels(spark, d):
    """Events as series of seven metrics; one that no event is of shows nothing, or what stands for nothing."""
    e, user = table(spark, d, "events"), F.col("user_id")
    text = lambda letter, n: F.concat(F.lit(letter), (user % n).cast("string"))
    labels = F.create_map(F.lit("gate"), text("g", 5), F.lit("workspace"), text("w", 3), F.lit("quantile"), F.when(F.col("event_id") % 2 == 0, "0.5").otherwise("0.9"), F.lit("attribute"), text("a", 4))
    name = F.element_at(F.array(*map(F.lit, PANEL_METRICS)), (F.col("event_id") % 7 + 1).cast("int"))
    return rep.panels(e.select(name.alias("name"), labels.alias("labels"), F.when(F.col("event_id") % 7 == 1, (user % 2).cast("double")).otherwise(F.floor("value").cast("double")).alias("value")))


def _lake(spark, d) -> tuple[str, str]:
    """Orders and customers as versioned tables of one lake; the customers aren't in the catalog."""
    root = scratch(spark)
    lake.VersionedTable(spark, f"{root}/orders").append(table(spark, d, "orders").withColumnRenamed("o_custkey", "subject"))
    lake.VersionedTable(spark, f"{root}/crm/customer").append(table(spark, d, "customer").withColumnRenamed("c_custkey", "subject"))
    lake.VersionedTable(spark, f"{root}/part").append(table(spark, d, "part"))
    return root, f"{root}/orders"


def _erasure(spark, d, **more):
    from ..operators.crypto import KeyStore
    from .erasure import Erasure

    root, orders = _lake(spark, d)
    keys = scratch(spark)
    return root, Erasure(spark, {"orders": orders}, "subject", KeyStore(spark, f"{keys}/keys", KEY), f"{keys}/audit", KEY, roots=[root], **more)


@query("select o_orderkey, o_custkey from orders where o_custkey <> 37")
def subject_delete_survivors(spark, d):
    t = lake.VersionedTable(spark, f"{scratch(spark)}/orders")
    t.append(table(spark, d, "orders"))
    t.delete(F.col("o_custkey") == 37)
    return t.read(columns=["o_orderkey", "o_custkey"])


@query("select count(*) filter (o_custkey = 37) as deleted, count(*) as before, count(*) filter (o_custkey <> 37) as after, false as old_readable from orders")
def delete_proof(spark, d):
    t = lake.VersionedTable(spark, f"{scratch(spark)}/orders")
    t.append(table(spark, d, "orders"))
    n = t.read(0).count()
    deleted = t.delete(F.col("o_custkey") == 37).rows_changed
    t.vacuum(0, enforce=False)
    return t.read().agg(F.lit(deleted).cast("long").alias("deleted"), F.lit(n).cast("long").alias("before"), F.count(F.lit(1)).alias("after"), F.lit(t.readable(0)).alias("old_readable"))


@query("select 'orders' as holding, 'catalog' as source, count(*) as n from orders where o_custkey = 37 having count(*) > 0 union all select 'crm/customer', 'sweep', count(*) from customer where c_custkey = 37 having count(*) > 0")
def holdings_count(spark, d):
    _, e = _erasure(spark, d)
    return spark.createDataFrame([(h.name, h.source, h.rows) for h in e.intake("37")], "holding string, source string, n long")


@query("with k as (select min(cast(k as varchar)) as control from (select o_custkey as k from orders union all select c_custkey from customer) where k <> 37) select control, (select count(*) from orders where cast(o_custkey as varchar) = control) as n, true as verified from k")
def control_intact(spark, d):
    root, e = _erasure(spark, d)
    done = e.run("37", "r1")
    left = lake.VersionedTable(spark, f"{root}/orders").read().where(F.col("subject").cast("string") == done["control"])
    return left.agg(F.lit(done["control"]).alias("control"), F.count(F.lit(1)).alias("n"), F.lit(done["verified"]).alias("verified"))


@query("""select 'r1' as request_id, 'crm/customer' as "table", (select count(*) from customer where c_custkey = 37) as rows, true as uncatalogued, cast(1 as bigint) as backup_sets where (select count(*) from customer where c_custkey = 37) > 0
 union all select 'r1', 'orders', (select count(*) from orders where o_custkey = 37), false, 1 where (select count(*) from orders where o_custkey = 37) > 0""")
def erasure_audit(spark, d):
    from .erasure import backup_sets

    backups = scratch(spark)
    root, e = _erasure(spark, d, backups=backups)
    lake.freeze(spark, root, backups, "one")
    e.run("37", "r1")
    audit = e.audit.read()
    tables = reg.audit_tables(audit).join(audit.select("request_id", "uncatalogued_tables", backup_sets().alias("backup_sets")), "request_id")
    return tables.select("request_id", "table", "rows", F.array_contains("uncatalogued_tables", F.col("table")).alias("uncatalogued"), "backup_sets")


@query("""select o_orderkey as request_id, case when o_orderkey % 3 = 0 then 'Request ' || o_orderkey || ' to erase your data was completed on ' || strftime(o_orderdate, '%Y-%m-%d %H:%M') || ' UTC.' || chr(10) || 'The data had been erased under request ' || (o_orderkey + 1) || ' before; that was verified again.'
 else 'Request ' || o_orderkey || ' to erase your data was completed on ' || strftime(o_orderdate, '%Y-%m-%d %H:%M') || ' UTC.' || chr(10) || o_custkey || ' record(s) of ' || (case when o_custkey > 0 then 1 else 0 end) || ' dataset(s) were deleted; their history can''t be restored.' end || chr(10) || 'The key of your personal data is destroyed, so encrypted copies in ' || (case when o_orderstatus = 'F' then 1 else 2 end) || ' backup set(s) can''t be read.'
 || (case when o_orderkey % 2 = 0 then chr(10) || '1 team(s) that work with copies are notified.' else '' end) as message from orders""")
def erasure_notification(spark, d):
    from .erasure import notification

    o, key = table(spark, d, "orders"), F.col("o_orderkey")
    sets = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("a/x"), F.lit("a/y"))).otherwise(F.array(F.lit("a/x"), F.lit("b/x")))
    return notification(o.select(key.cast("string").alias("request_id"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("completed_ts"), F.when(key % 3 == 0, (key + 1).cast("string")).alias("rerun_of"), F.col("o_custkey").alias("rows_deleted"), F.array(F.col("o_custkey"), F.lit(0).cast("long")).alias("rows_deleted_by_table"), sets.alias("backups_covered"), F.when(key % 2 == 0, F.array(F.lit("t"))).otherwise(F.array().cast("array<string>")).alias("downstream_to_notify"))).select(F.col("request_id").cast("long").alias("request_id"), "message")


@query("select 'orders' as \"table\", true as whole, (select count(*) from orders) as n union all select 'crm/customer', true, (select count(*) from customer) union all select 'part', true, (select count(*) from part)")
def backup_tables(spark, d):
    root, _ = _lake(spark, d)
    backups = scratch(spark)
    lake.freeze(spark, root, backups, "2024-01-01")
    bad = lake.verify(spark, backups, lake.latest(spark, backups)).count()
    by = lake.objects_by_table(lake.manifest(spark, backups, "2024-01-01")).where("objects >= 2 and bytes > 0")
    counts = None
    for name in lake.tables_below(spark, f"{backups}/2024-01-01/objects"):
        one = lake.VersionedTable(spark, f"{backups}/2024-01-01/objects/{name}").read().agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.union(one)
    return by.join(counts, "table").select("table", F.lit(bad == 0).alias("whole"), "n")


@query("""with a as (select c_custkey, c_nationkey, c_mktsegment, c_acctbal > 0 as ok, row_number() over (partition by c_nationkey order by c_custkey) as r from customer) select count(*) filter (r = 1 and ok and c_mktsegment <> 'BUILDING') as completed, count(*) filter (r > 1) as reruns from a""")
def audit_primary_counts(spark, d):
    from .erasure import completed

    c = table(spark, d, "customer")
    first = c.groupBy("c_nationkey").agg(F.min("c_custkey").alias("first"))
    audit = c.join(F.broadcast(first), "c_nationkey").select(F.when(F.col("c_custkey") != F.col("first"), F.col("first").cast("string")).alias("rerun_of"), (F.col("c_acctbal") > 0).alias("verified_lake"), (F.col("c_mktsegment") != "BUILDING").alias("verified_crypto"))
    return completed(audit)


@query("select o_orderkey, n, 'v' || lpad(cast(n as varchar), 4, '0') as file from (select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as n from orders)")
def history_order(spark, d):
    return rep.numbered(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey", "n", "file")


@query("select l_suppkey, string_agg(l_partkey || ':' || l_linenumber, ',' order by l_partkey, l_linenumber) as locations from (select *, row_number() over (partition by l_suppkey order by l_partkey, l_linenumber) as r from (select distinct l_suppkey, l_partkey, l_linenumber from lineitem)) where r <= 3 group by all")
def usage_locations(spark, d):
    return rep.first_places(table(spark, d, "lineitem"), "l_suppkey", "l_partkey", "l_linenumber")


@query("select o_orderstatus, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as minor, count(*) as n from orders where cast(o_orderdate as date) = (select cast(min(o_orderdate) as date) + 7 from orders) group by all")
def day_totals(spark, d):
    """One day of orders, a week after the first one: the range of the day reaches the scan."""
    from datetime import timedelta

    orders = table(spark, d, "orders")
    day = orders.agg(F.to_date(F.min("o_orderdate"))).first()[0] + timedelta(days=7)
    return orders.where(rep.on_day(F.col("o_orderdate"), day)).groupBy("o_orderstatus").agg(F.sum(F.expr(MINOR)).alias("minor"), F.count(F.lit(1)).alias("n"))


@query(f"select o_orderkey, cast(1 as bigint) as run_ts, 'values_to_be_in_set(o_orderstatus)' as broken from {BAD}")
def quarantine_listing(spark, d):
    return rep.quarantine_listing(_quarantine(spark, d), "o_orderkey").select("o_orderkey", "run_ts", "broken")


@query("""with b as (select p_brand as dataset, p_type as name from part where p_size < 30), h as (select p_brand as dataset, p_type as name from part where p_size > 20)
select dataset, case when exists (select 1 from h where h.dataset = x.dataset) then 'h' else 'b' end as topic, string_agg(distinct name, ',' order by name) as names from (select * from b union select * from h) x group by dataset""")
def scan_universe(spark, d):
    part = table(spark, d, "part")
    side = lambda rows, mark: part.where(rows).groupBy(F.col("p_brand").alias("dataset")).agg(F.collect_set("p_type").alias("names")).select("dataset", F.lit("s").alias("subject"), F.lit(mark).alias("topic"), F.lit("p").alias("delta_path"), "names")
    return gov.scan_universe(side("p_size < 30", "b"), side("p_size > 20", "h")).select("dataset", "topic", F.array_join("names", ",").alias("names"))


@query("select page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 1) as bucket, regexp_extract(rtrim(regexp_replace(url, '^https?://', ''), '/'), '^[^/]*/(.*)$', 1) as key, '/lake/' || rtrim(regexp_replace(url, '^https?://', ''), '/') as place, '/q/' || split_part(url, '.', -1) as own from pages")
def path_parts(spark, d):
    stored = F.regexp_replace("url", "^https?://", "s3n://")
    b = fn.bucket_and_key(stored)
    return table(spark, d, "pages").select("page_id", b.bucket.alias("bucket"), b.key.alias("key"), fn.placed_path(stored, "/lake/").alias("place"), fn.table_path("url", "/q").alias("own"))


@query("select event_type, count(*) as n from events where value < 10 or value > 90 group by all")
def stream_checkpoint(spark, d):
    from ..streaming.checkpoint import run_once

    root = scratch(spark)
    schema = table(spark, d, "events").schema
    rules = suite(rule("column_values_to_be_between", column="value", min_value=10, max_value=90))
    out = run_once(spark, d, schema, rules, f"{root}/out", f"{root}/state", "event_id", "events.parquet", "ts", "40 days")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("select event_id, event_type, cast(json_extract(props, '$.k') as bigint) as k from events where event_type in ('click', 'purchase')")
def framed_stream(spark, d):
    """Events as framed JSON messages in files, read as a stream, stripped, decoded and held to two types."""
    from ..streaming.checkpoint import framed_events

    root, e = scratch(spark), table(spark, d, "events")
    body = F.to_json(F.struct("event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k")))
    e.select(F.concat(F.unhex(F.lit("0000000007")), F.encode(body, "UTF-8")).alias("value")).write.parquet(f"{root}/in")

    def decode(raw: DataFrame) -> DataFrame:
        return raw.select(F.from_json(F.decode("payload", "UTF-8"), "event_id long, event_type string, k long").alias("e")).select("e.*")

    stream = framed_events(spark, "parquet", {"path": f"{root}/in"}, decode, "event_type", ("click", "purchase"))
    stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query("select l_orderkey % 97 as bucket, count(*) as n, count(*) filter (l_returnflag <> 'X') as kept from lineitem where l_shipdate >= timestamp '1995-01-01' group by all")
def status_filter(spark, d):
    return table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz")).groupBy((F.col("l_orderkey") % 97).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") != "X").alias("kept"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def nested_projection(spark, d):
    return table(spark, d, "events").withColumn("e", F.from_json("props", "k long")).select("event_id", F.col("e.k").alias("k"))


@query("""with donors as (select * from orders where o_orderkey % 1000 = 1), bad as (select * replace (-o_totalprice as o_totalprice) from donors union all select * replace ('ZZ' as o_orderstatus) from donors), x as (select * from orders union all select * from bad)
select o_orderkey, concat_ws(';', case when o_totalprice < 0 then 'column_values_to_be_between(o_totalprice)' end, case when o_orderstatus = 'ZZ' then 'column_values_to_be_in_set(o_orderstatus)' end, case when o_orderstatus = 'ZZ' then 'column_value_lengths_to_equal(o_orderstatus)' end) as labels from x where o_totalprice < 0 or o_orderstatus = 'ZZ'""")
def bad_row_injection(spark, d):
    orders = table(spark, d, "orders")
    mixed = gen.with_bad_rows(orders, orders.where("o_orderkey % 1000 = 1"), [{"o_totalprice": -F.col("o_totalprice")}, {"o_orderstatus": F.lit("ZZ")}])
    rules = suite(rule("column_values_to_be_between", column="o_totalprice", min_value=0), rule("column_values_to_be_in_set", column="o_orderstatus", value_set=["F", "O", "P"]), rule("column_value_lengths_to_equal", column="o_orderstatus", value=1))
    return q.offending(mixed, rules).select("o_orderkey", F.concat_ws(";", "expectation").alias("labels"))


@query("""with names as (select distinct 'f' || p_partkey as name from part where p_size > 10 and p_partkey % 7 = 0), c as (select distinct 'f' || p_partkey as name from part where p_size between 2 and 40), f as (select distinct 'f' || p_partkey as name from part where p_size < 30 and p_partkey % 3 <> 0)
select 'error' as level, 'suite column not in contract' as finding, name from names where name not in (select name from c) union all select 'error', 'fixture column not in contract', name from f where name not in (select name from c)
union all select 'warning', 'fixture is stale', name from c where name not in (select name from f)""")
def fixture_sets(spark, d):
    from ..operators.fixtures import set_findings

    part = table(spark, d, "part").withColumn("name", F.concat(F.lit("f"), F.col("p_partkey").cast("string")))
    return set_findings(part.where("p_size > 10 and p_partkey % 7 = 0"), part.where("p_size between 2 and 40"), part.where("p_size < 30 and p_partkey % 3 <> 0"))


@query("""select 'warning' as level, 'fixture is stale' as finding, 'c_extra' as name, cast(0 as bigint) as n union all select 'error', 'values that aren''t tokens', 'c_name', count(*) from customer
union all select 'error', 'rule failed: column_values_to_be_between', 'c_acctbal', count(*) filter (c_acctbal < 0) from customer having count(*) filter (c_acctbal < 0) > 0
union all select 'error', 'stratum below the floor', c_mktsegment, count(*) // 1000 from customer group by c_mktsegment having count(*) // 1000 < least(5, count(*)) or count(*) // 1000 = 0""")
def fixture_gate(spark, d):
    from ..operators import fixtures

    c = table(spark, d, "customer")
    strata = c.groupBy(F.col("c_mktsegment").alias("stratum")).agg(F.count(F.lit(1)).alias("source")).withColumn("sampled", F.floor(F.col("source") / 1000))
    return fixtures.gate(c, suite(rule("column_values_to_be_between", column="c_acctbal", min_value=0)), [*c.columns, "c_extra"], fixtures.content(c), strata, 5, ["c_name", "c_missing"])


@query("select ordinal, expectation, target, success, unexpected_count, case when ordinal = 1 then 'invalid regex' end as error from (" + " union all ".join([_counted(0, "column_values_to_be_between", "c_acctbal", "c_acctbal < 0", "customer"), _row(1, "column_values_to_match_regex", "c_name", "false", "0", "(select 1)"), _dups(2, "c_nationkey", "customer")]) + ")")
def suite_with_errors(spark, d):
    rules = suite(rule("column_values_to_be_between", column="c_acctbal", min_value=0), rule("column_values_to_match_regex", column="c_name", regex="("), rule("column_values_to_be_unique", column="c_nationkey"))
    found, _ = q.validate(table(spark, d, "customer"), rules)
    return found.drop("sample").withColumn("error", F.regexp_extract("error", "^[^:]+", 0))


CATALOG_SQL = """(select p_brand as "table", 'c' || (p_partkey % 40) as name, p_partkey, ['DIRECT_IDENTIFIER', 'QUASI_IDENTIFIER', 'NOT_PII', 'OTHER'][p_size % 4 + 1] as class,
  ['NONE', 'TOKENIZE_HMAC', 'ENCRYPT_AESGCM', 'MASK'][p_partkey % 4 + 1] as treatment, case when p_size % 3 = 0 then 'PLATFORM' when p_size % 7 = 0 then 'TEAM' end as scope, case when p_size > 25 then p_type end as reason from part)"""


@query(f"""with c as {CATALOG_SQL}, f as (select distinct p_brand as "table", 'c' || (p_size % 30) as name from part where p_brand <> 'Brand#13'), k as (select distinct "table" from f),
 e as (select c.*, k."table" is not null as known, f.name is not null as live from c left join k using ("table") left join f on f."table" = c."table" and f.name = c.name), p as (select *, class in ('DIRECT_IDENTIFIER', 'QUASI_IDENTIFIER') as protected, treatment in ('TOKENIZE_HMAC', 'ENCRYPT_AESGCM') as treated from e)
 select "table", name, finding, count(*) as n from (select "table", name, 'UNKNOWN_TABLE' as finding from p where not known union all select "table", name, 'BAD_CLASS' from p where known and class = 'OTHER' union all select "table", name, 'BAD_TREATMENT' from p where known and treatment = 'MASK'
 union all select "table", name, 'UNTREATED' from p where known and protected and not treated union all select "table", name, 'TREATED_NOT_PII' from p where known and class = 'NOT_PII' and treatment <> 'NONE' union all select "table", name, 'NO_REASON' from p where known and class = 'NOT_PII' and reason is null
 union all select "table", name, 'BAD_SCOPE' from p where known and treated and scope = 'TEAM' union all select "table", name, 'SURVIVES_ERASURE' from p where known and treated and scope = 'PLATFORM' and not (treatment = 'TOKENIZE_HMAC' and class = 'QUASI_IDENTIFIER') union all select "table", name, 'STALE' from p where known and not live
 union all select distinct "table", 'c7', 'NO_SUBJECT_KEY' from p where known and protected and "table" not in (select "table" from f where name = 'c7')) group by all""")
def pii_catalog_findings(spark, d):
    part = table(spark, d, "part")

    def pick(of: str, *names: str):
        return F.element_at(F.array(*map(F.lit, names)), (F.col(of) % 4 + 1).cast("int"))

    scope = F.when(F.col("p_size") % 3 == 0, "PLATFORM").when(F.col("p_size") % 7 == 0, "TEAM")
    catalog = part.select(F.col("p_brand").alias("table"), F.concat(F.lit("c"), (F.col("p_partkey") % 40).cast("string")).alias("name"), pick("p_size", "DIRECT_IDENTIFIER", "QUASI_IDENTIFIER", "NOT_PII", "OTHER").alias("class"), pick("p_partkey", "NONE", "TOKENIZE_HMAC", "ENCRYPT_AESGCM", "MASK").alias("treatment"), scope.alias("key_scope"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("reason"))
    fields = part.where("p_brand <> 'Brand#13'").select(F.col("p_brand").alias("table"), F.concat(F.lit("c"), (F.col("p_size") % 30).cast("string")).alias("name"))
    return reg.catalog_findings(catalog, fields, "c7").groupBy("table", "name", "finding").agg(F.count(F.lit(1)).alias("n"))


def _registries(spark, d):
    """Registries before and after a change, derived from customers: the rich are new, debtors are removed or moved."""
    c = table(spark, d, "customer")
    name, bal = F.col("c_custkey").cast("string"), F.col("c_acctbal")
    base = c.where(bal < 5000).select(name.alias("dataset"), F.col("c_name").alias("subject"), F.col("c_name").alias("schema"), F.col("c_mktsegment").alias("mode"))
    head = c.where(bal > -500).select(name.alias("dataset"), F.when(bal < 0, F.lower("c_name")).otherwise(F.col("c_name")).alias("subject"), F.col("c_name").alias("schema"), F.when(bal < 1000, "FULL").otherwise(F.col("c_mktsegment")).alias("mode"))
    return base, head


@query("""select cast(c_custkey as varchar) as dataset, case when c_acctbal < 5000 then c_mktsegment when c_acctbal < 1000 then 'FULL' else c_mktsegment end as mode, 'schema changed' as reason, c_acctbal < 1000 as mode_changed, c_acctbal < 0 as subject_changed
 from customer where c_acctbal > -500 and c_custkey in (select o_custkey from orders where o_orderstatus = 'P')""")
def gate_plan(spark, d):
    changed = table(spark, d, "orders").where("o_orderstatus = 'P'").select("o_custkey").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("path"))
    return reg.gate_plan(*_registries(spark, d), changed)


@query("select cast(c_custkey as varchar) as dataset from customer where c_acctbal < 5000 and c_acctbal <= -500")
def registry_removals(spark, d):
    return reg.removed_datasets(*_registries(spark, d))


@query("select user_id as subject, max(event_id) as version, arg_max(props, event_id) as schema from events group by all")
def latest_schema(spark, d):
    return reg.latest_schema(table(spark, d, "events").select(F.col("user_id").alias("subject"), F.col("event_id").alias("version"), F.col("props").alias("schema")))


@query("select subject, k, row_number() over (partition by subject order by e, k) as version from (select user_id as subject, cast(json_extract(props, '$.k') as bigint) as k, min(event_id) as e from events group by all)")
def schema_versions(spark, d):
    offered = table(spark, d, "events").select(F.col("user_id").alias("subject"), F.col("event_id").alias("at"), F.col("props").alias("schema"))
    return reg.registered(offered).select("subject", F.get_json_object("canonical", "$.k").cast("long").alias("k"), "version")


@query("""with p as (select page_id, regexp_replace(url, '^https?://', '') as path from pages), d as (select distinct regexp_extract(path, '^[^/?#]+/[^/?#]+') as dataset from p)
 select page_id as id, dataset, case when rtrim(path, '/') like '%/1' and dataset = rtrim(path, '/') then 'topic' else 'delta_path' end as kind from p, d where dataset <> '' and (rtrim(path, '/') = dataset or starts_with(rtrim(path, '/'), dataset || '/'))""")
def dataset_references(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.regexp_replace("url", "^https?://", "").alias("path"))
    datasets = pages.select(F.regexp_extract("path", "^[^/?#]+/[^/?#]+", 0).alias("dataset")).where("dataset <> ''").distinct()
    named = datasets.select("dataset", F.concat("dataset", F.lit("-value")).alias("subject"), F.when(F.col("dataset").endswith("/1"), F.col("dataset")).alias("topic"), F.concat(F.lit("s3a://"), "dataset").alias("delta_path"))
    return reg.references(pages.select(F.col("page_id").alias("id"), F.concat(F.lit("s3n://"), "path").alias("literal")).union(pages.where("path like '%/1'").select("page_id", "path")), named)


@query("select o_orderkey as request_id, unnest(['orders', o_orderstatus]) as \"table\", unnest([o_custkey, o_custkey + 1]) as rows, unnest([o_orderkey, 1]) as before, unnest([o_orderkey + 2, 3]) as after from orders")
def audit_tables(spark, d):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    audit = table(spark, d, "orders").select(key.alias("request_id"), F.array(F.lit("orders"), "o_orderstatus").alias("tables_touched"), F.array(cust, cust + 1).alias("rows_deleted_by_table"), F.array(key, F.lit(1).cast("long")).alias("pre_delete_versions"), F.array(key + 2, F.lit(3).cast("long")).alias("vacuum_versions"))
    return reg.audit_tables(audit)


@query("""with e as (select event_id as id, cast(json_extract(props, '$.k') as bigint) as k, event_type as t from events) select id, 'a.k' as path, cast(k as varchar) as before, cast(k // 2 as varchar) as after from e where k <> k // 2
 union all select id, 't', t, 'click' from e where t <> 'click' union all select id, 'new', null, t from e""")
def json_leaf_diff(spark, d):
    e = table(spark, d, "events").select("event_id", "props", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    before = F.to_json(F.struct(F.col("props").alias("a"), F.col("event_type").alias("t")))  # a is JSON within JSON
    after = F.to_json(F.struct(F.struct(F.floor(F.col("k") / 2).alias("k")).alias("a"), F.lit("click").alias("t"), F.col("event_type").alias("new")))
    return reg.leaf_diff(e.select(F.col("event_id").alias("id"), before.alias("before"), after.alias("after")))


def queries() -> dict[str, Query]:
    from . import histories, subjects  # noqa: F401  register their own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import histories, subjects  # noqa: F401

    return dict(SQL)
