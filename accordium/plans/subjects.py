"""Queries over keys of subjects, what they protect, and repeated erasures, with their SQL. Keys are random, so results show what doesn't depend on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators.crypto import KeyStore, SubjectErased, decrypt_view, protect, reveal
from ..session import scratch, table, written
from ..sources import lake
from .queries import KEY, _erasure, _hmac_sql, query

CATALOG = {"o_orderpriority": {"treatment": "ENCRYPT_AESGCM"}, "o_orderstatus": {"treatment": "TOKENIZE_HMAC", "key_scope": "PLATFORM"}, "o_totalprice": {"treatment": "NONE"}}


def _orders(spark, d):
    """Orders of which some have no priority; some of those have no customer either."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 35 != 0, F.col("o_custkey"))).withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")))


def _store(spark) -> KeyStore:
    return KeyStore(spark, f"{scratch(spark)}/keys", KEY)


@query(f"""select o_orderkey, case when o_orderkey % 5 <> 0 and o_custkey not in (4, 37) then o_orderpriority end as priority, {_hmac_sql("o_orderstatus")} as status, o_totalprice as price, o_orderkey % 5 <> 0 as sealed from orders""")
def erased_reveal(spark, d):
    """Protected orders in plain text after the keys of two customers are destroyed."""
    store = _store(spark)
    sealed = written(protect(_orders(spark, d), CATALOG, "o_custkey", store, KEY, "orders").withColumn("sealed", F.coalesce(fn.is_encrypted("o_orderpriority"), F.lit(False))))
    for subject in ("4", "37"):
        store.destroy(subject)
    return reveal(sealed, CATALOG, "o_custkey", store, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), "sealed")


@query("""select count(*) as n, min(o_orderkey) as first, max(o_orderkey) as last from orders where o_orderkey % 5 <> 0 group by o_custkey, o_orderpriority
 union all select count(*), min(o_orderkey), max(o_orderkey) from orders where o_orderkey % 5 = 0 having count(*) > 0""")
def subject_tokens(spark, d):
    """Tokens under a subject's own key: equal for equal values of one customer, and never for two customers."""
    own = {"o_orderpriority": {"treatment": "TOKENIZE_HMAC", "key_scope": "SUBJECT"}}
    tokens = written(protect(_orders(spark, d), own, "o_custkey", _store(spark), KEY, "orders"))
    return tokens.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")).drop("o_orderpriority")


@query("""with s as (select distinct cast(o_custkey as varchar) as name from orders where o_orderkey % 35 <> 0)
select 'same' as what, name, cast(1 as bigint) as n from s where name <> '37' union all select 'count', 'live', count(*) from s where name <> '37' union all select 'count', 'destroyed', 2
union all select 'refused', 'batch', 1 union all select 'kept', '37', 1 union all select 'exposed', '37', 0 union all select 'exposed', 'unknown', 0""")
def key_states(spark, d):
    """One key for each customer, the same when it is asked for again; one is destroyed twice, and so is one that never was."""
    store, ids = _store(spark), _orders(spark, d).select("o_custkey")
    first = written(store.get_or_create(ids))
    once, _ = store.destroy("37"), store.destroy("unknown")
    twice = store.destroy("37")
    try:
        store.get_or_create(ids.unionByName(spark.createDataFrame([(37,)], "o_custkey long")))
        refused = 0
    except SubjectErased:
        refused = 1
    again = store.get_or_create(ids.where("o_custkey <> 37"))
    same = again.join(first.withColumnRenamed("dek", "old"), "subject_id").where("dek = old").select(F.lit("same").alias("what"), F.col("subject_id").alias("name"), F.lit(1).cast("long").alias("n"))
    counts = store.counts().select(F.lit("count").alias("what"), F.explode(F.create_map(F.lit("live"), "live", F.lit("destroyed"), "destroyed")).alias("name", "n"))
    rest = [("refused", "batch", refused), ("kept", "37", int(once == twice)), *(("exposed", s, len(store.history_exposure(s))) for s in ("37", "unknown"))]
    return same.union(counts).union(spark.createDataFrame(rest, "what string, name string, n long"))


@query("""select place, o_orderkey, case when o_orderkey % 5 <> 0 then o_orderpriority end as priority from orders, (values ('live'), ('backup')) p(place) where o_custkey = 37 and o_orderkey % 35 <> 0""")
def subject_view(spark, d):
    """One customer's orders in plain text, from the protected table and from a backup of it."""
    from .erasure import view_from_backup

    store, root, backups = _store(spark), scratch(spark), scratch(spark)
    t = lake.VersionedTable(spark, f"{root}/orders")
    t.append(protect(_orders(spark, d), CATALOG, "o_custkey", store, KEY, "orders"))
    lake.freeze(spark, root, backups, "one")
    live = decrypt_view(t.read(), CATALOG, "o_custkey", store, "orders", "37")
    kept = view_from_backup(store, backups, "one", "orders", CATALOG, "o_custkey", "37")
    rows = live.withColumn("place", F.lit("live")).unionByName(kept.withColumn("place", F.lit("backup")))
    return rows.select("place", "o_orderkey", F.col("o_orderpriority").alias("priority"))


@query("""with n as (select (select count(*) from orders where o_custkey = 37) as o, (select count(*) from customer where c_custkey = 37) as c)
select 'request' as what, 'r1' as name, o + c as n, cast(null as varchar) as rerun_of, true as passed from n union all select 'request', 'r2', 0, 'r1', true from n
union all select 'subject', 'r1', 0, null, true union all select 'key', '37', 0, null, true union all select 'rows', 'orders', 0, null, true from n where o > 0 union all select 'rows', 'crm/customer', 0, null, true from n where c > 0
union all select 'version', 'orders@0', 0, null, true from n where o > 0 union all select 'version', 'crm/customer@0', 0, null, true from n where c > 0 union all select 'subject', 'r1', 0, null, false""")
def erasure_rerun(spark, d):
    """A customer is erased twice; the second record points to the first, which is verified for this customer and for another."""
    from .erasure import verify_record

    _, e = _erasure(spark, d)
    for request in ("r1", "r2"):
        e.run("37", request)
    records = e.audit.read().select(F.lit("request").alias("what"), F.col("request_id").alias("name"), F.col("rows_deleted").alias("n"), "rerun_of", (F.col("verified_lake") & F.col("verified_crypto")).alias("passed"))
    checks = verify_record(e, "r1", "37").union(verify_record(e, "r1", "4"))
    return records.union(checks.select(F.col("check").alias("what"), F.col("place").alias("name"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("string").alias("rerun_of"), "passed"))
