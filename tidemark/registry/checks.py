"""Data-quality operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import quality as q
from ..session import scratch_path
from .base import query
from .shapes import _DIFF, _versions


@query("dq_sequence_gaps", """with k as (select distinct l_orderkey, l_linenumber from lineitem), p as (select *, lag(l_linenumber) over (partition by l_orderkey order by l_linenumber) as prev_l_linenumber from k)
    select l_orderkey, l_linenumber, prev_l_linenumber, l_linenumber - prev_l_linenumber as gap from p where l_linenumber - prev_l_linenumber <> 1""")
def sequence_gaps(t):
    return q.sequence_gaps(t.lineitem.select("l_orderkey", "l_linenumber").distinct(), ["l_orderkey"], "l_linenumber", chunk=F.expr("l_linenumber div 4"))


@query("dq_compare_subset", _DIFF)
def compare_subset(t):
    return q.compare_subset(*_versions(t), ["o_orderkey", "o_orderstatus"])


@query("dq_count_matches_parent", """select o_orderkey, expected, coalesce(n, 0) as actual from (select o_orderkey, o_orderkey % 7 + 1 as expected from orders) left join (select l_orderkey, count(*) as n from lineitem group by 1) on l_orderkey = o_orderkey where coalesce(n, 0) <> expected""")
def count_matches(t):
    parents = t.orders.select("o_orderkey", (F.col("o_orderkey") % 7 + 1).alias("expected"))
    return q.count_matches_parent(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), parents, "o_orderkey", "expected")


@query("dq_child_has_parent", "select distinct l_orderkey from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'P')")
def child_has_parent(t):
    parents = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return q.child_has_parent(t.lineitem, parents, ["l_orderkey"])


@query("dq_parent_has_child", "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def parent_has_child(t):
    return q.parent_has_child(t.orders, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], threshold=2)


@query("dq_missing_rows", "select p_partkey, p_name from part where not exists (select 1 from lineitem where l_partkey = p_partkey and l_discount > 0.09 and l_quantity > 40)")
def missing_rows(t):
    sold = t.lineitem.filter("l_discount > 0.09 and l_quantity > 40").withColumnRenamed("l_partkey", "p_partkey")
    return q.missing_rows(t.part.select("p_partkey", "p_name"), sold, ["p_partkey"])


@query("dq_missing_for_key", """select l_orderkey, l_linenumber, l_partkey from lineitem a where l_suppkey = 7 and l_shipdate < timestamp '2001-01-01'
    and not exists (select 1 from lineitem b where b.l_tax > 0 and a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber and a.l_partkey = b.l_partkey)""")
def missing_for_key(t):
    base = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    copy = t.lineitem.filter("l_tax > 0")
    out = q.missing_for_key(base, copy, ["l_orderkey", "l_linenumber", "l_partkey"], F.col("l_suppkey") == 7, "l_shipdate", F.lit(datetime(2001, 1, 1)))
    return out.select("l_orderkey", "l_linenumber", "l_partkey")


@query("dq_not_null", "select event_id from events where event_type = 'error'")
def not_null(t):
    holed = t.events.select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))
    return q.not_null(holed, ["event_id", "event_type"]).select("event_id")


@query("dq_unique", "select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1")
def unique(t):
    return q.unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_type", """select l_orderkey, l_linenumber, 'l_returnflag' as column_name from lineitem union all select l_orderkey, l_linenumber, 'l_tax' from lineitem where l_tax <> floor(l_tax)""")
def types(t):
    """Rows whose values, read as text, are no whole numbers."""
    as_text = t.lineitem.select("l_orderkey", "l_linenumber", *[F.col(c).cast("string").alias(c) for c in ("l_partkey", "l_returnflag", "l_tax")])
    return q.untyped(as_text, ["l_orderkey", "l_linenumber"], {"l_partkey": "bigint", "l_returnflag": "bigint", "l_tax": "decimal(20,6)"}, whole=["l_partkey", "l_returnflag", "l_tax"])


@query("dq_column_exists", """select event_type, count(*) as n_records from events where event_type <> 'error' group by 1""")
def column_exists(t):
    """Records whose payload lacks a field."""
    record = F.when(F.col("event_type") == "error", F.to_json(F.struct("event_id", "value"))).otherwise(F.to_json(F.struct("event_id")))
    return q.without_fields(t.events.select("event_type", record.alias("data")), "data", ["value"]).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_records"))


@query("dq_regex", "select c_custkey from customer where not regexp_matches(c_name, '^Customer#0+[0-9]{1,3}$')")
def regexes(t):
    return q.matches(t.customer, "c_name", "^Customer#0+[0-9]{1,3}$").select("c_custkey")


@query("dq_in_set", "select event_id, event_type from events where event_type not in ('click', 'view', 'purchase')")
def in_set(t):
    return q.in_set(t.events, "event_type", ["click", "view", "purchase"]).select("event_id", "event_type")


@query("dq_recent", "select strftime(m, '%Y-%m-%d %H:%M:%S') as newest from (select max(ts) as m from events) where m < timestamp '2024-02-15'")
def recent(t):
    return q.recent(t.events, "ts", F.lit(datetime(2024, 2, 15)))


@query("dq_profile", """select 'not_null:l_orderkey' as check_name, 0::bigint as failures union all select 'not_null:flag', count(*) filter (where l_returnflag = 'N') from lineitem
    union all select 'regex:l_linestatus', count(*) filter (where l_linestatus <> 'O') from lineitem union all select 'in_set:l_returnflag', count(*) filter (where l_returnflag not in ('A', 'R')) from lineitem""")
def profile(t):
    df = t.lineitem.withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("N")))
    return q.profile(df, ["l_orderkey", "flag"], {"l_linestatus": "^O$"}, {"l_returnflag": ["A", "R"]})


@query("dq_store_failures", "select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1")
def store_failures(t):
    path = scratch_path(t.spark, "failures")
    q.store_failures(q.unique(t.lineitem, ["l_orderkey", "l_linenumber"]), path)
    return t.spark.read.parquet(path)


@query("dq_severity", """with k as (select distinct l_orderkey as id from lineitem), g as (select id - lag(id) over (order by id) as gap from k) select count(*) filter (where gap <> 1) as n,
    case when count(*) filter (where gap <> 1) > 1000000 then 'error' when count(*) filter (where gap <> 1) > 10 then 'warn' else 'pass' end as verdict from g""")
def severity(t):
    ids = t.lineitem.select(F.lit(1).alias("chain"), "l_orderkey").distinct()
    n = q.sequence_gaps(ids, ["chain"], "l_orderkey", chunk=F.expr("l_orderkey div 1000")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("n", q.severity(F.col("n"), 10, 1_000_000).alias("verdict"))
