"""Window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import newest
from ..operators import windows as w
from .base import query


@query("op_dedup_latest", """select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""")
def dedup_latest(t):
    return w.dedup_latest(t.events, ["user_id"], [newest("ts"), newest("event_id")]).select("user_id", "event_id", "event_type")


@query("op_dedup_latest_two_sided", """with a as (select *, row_number() over (partition by block_id, msg_index order by ts desc, event_id desc) as r1 from v_msgs),
    b as (select *, row_number() over (partition by tx_id, msg_type order by ts desc, event_id desc) as r2 from v_msgs)
    select a.event_id from a join b on a.event_id = b.event_id where r1 = 1 and r2 = 1""")
def two_sided(t):
    """Newest per position and newest per identity, both over all rows."""
    order = [newest("ts"), newest("event_id")]
    m = t.msgs.select("event_id", "block_id", "msg_index", "tx_id", "msg_type", "ts")
    by_place = w.dedup_latest(m, ["block_id", "msg_index"], order)
    by_name = w.dedup_latest(m, ["tx_id", "msg_type"], order)
    return by_place.join(by_name.select("event_id"), "event_id", "left_semi").select("event_id")


@query("op_dedup_priority", """select l_partkey, l_orderkey, l_linenumber, l_suppkey from (select *, row_number() over (partition by l_partkey order by case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 else 3 end,
    o_orderdate desc, l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_quantity) as rn from lineitem join orders on l_orderkey = o_orderkey) where rn = 1""")
def dedup_priority(t):
    p = F.col("o_orderpriority")
    rank = F.when(p == "1-URGENT", 1).when(p == "2-HIGH", 2).otherwise(3)
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ties = [newest("o_orderdate"), "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity"]
    return w.dedup_priority(lines, ["l_partkey"], rank, ties).select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")


@query("op_nth_latest", "select strftime(d, '%Y-%m-%d') as cutoff from (select distinct cast(o_orderdate as date) as d from orders order by 1 desc limit 3) order by 1 limit 1")
def nth_latest(t):
    return w.nth_latest(t.orders, F.to_date("o_orderdate"), 3, "cutoff")


@query("op_rank", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, rank() over (partition by l_orderkey order by l_linenumber) - 1 as rnk from lineitem")
def rank(t):
    ranked = w.rank_in_group(t.lineitem, ["l_orderkey"], ["l_linenumber"], chunk=F.expr("l_linenumber div 2"))
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("rnk") - 1).alias("rnk"))


@query("op_lag_gap", """with k as (select distinct l_orderkey from lineitem where l_returnflag = 'R') select l_orderkey, lag(l_orderkey) over (order by l_orderkey) as prev_l_orderkey, l_orderkey - lag(l_orderkey) over (order by l_orderkey) as gap from k""")
def lag_gap(t):
    ids = t.lineitem.filter("l_returnflag = 'R'").select(F.lit(1).alias("chain"), "l_orderkey").distinct()
    return w.lag_gap(ids, ["chain"], "l_orderkey", chunk=F.expr("l_orderkey div 1000")).drop("chain")


@query("op_lead_interval", """select o_custkey, start_day, coalesce(lead(start_day) over (partition by o_custkey order by start_day) - 1, 1000000000000000000) as end_value from (select distinct o_custkey, start_day from v_versions)""")
def lead_interval(t):
    starts = t.versions.select("o_custkey", "start_day").distinct()
    return w.lead_interval(starts, ["o_custkey"], "start_day", chunk=F.expr("start_day div 365"))


@query("op_group_by_marker", """select event_id, cast(nullif(sum(case when event_type = 'signup' then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) - 1, -1) as varchar) as session_no from events""")
def group_by_marker(t):
    marked = w.group_by_marker(w.time_chunks(t.events, ["user_id"], "ts", "span"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", "session_no", chunk=F.col("span"))
    return marked.select("event_id", F.col("session_no").cast("string").alias("session_no"))


_GROUPED = """select *, nullif(sum(case when is_action then 1 else 0 end) over (partition by tx_id order by msg_index rows unbounded preceding) - 1, -1) as msg_group from v_msgs"""


@query("op_subgroup_backfill", f"""with g as ({_GROUPED}), m as (select *, case when is_module then rank() over (partition by tx_id, msg_group, is_module order by msg_index) - 1 end as r from g)
    select event_id, coalesce(first_value(r ignore nulls) over (partition by tx_id, msg_group order by msg_index rows between current row and unbounded following), 0) as sub from m where msg_group is not null""")
def subgroup_backfill(t):
    chunk = F.expr("msg_index div 4")
    g = w.group_by_marker(t.msgs, ["tx_id"], ["msg_index"], F.col("is_action"), "msg_group", chunk=chunk).filter("msg_group is not null")
    ranked = w.rank_in_group(g, ["tx_id", "msg_group", "is_module"], ["msg_index"], "r", chunk=chunk)
    marked = F.when(F.col("is_module"), F.col("r") - 1)
    return w.subgroup_backfill(ranked, ["tx_id", "msg_group"], ["msg_index"], marked, F.lit(0), "sub", chunk=chunk).select("event_id", "sub")


@query("op_ffill", """select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as balance from events""")
def ffill(t):
    v = F.when(F.col("event_type") == "purchase", F.col("value"))
    return w.ffill(w.time_chunks(t.events, ["user_id"], "ts", "span"), ["user_id"], ["ts", "event_id"], v, "balance", chunk=F.col("span")).select("event_id", "balance")


@query("op_running_sum", """select event_id, cast(sum(cast(value as decimal(18,2))) over (partition by user_id order by ts, event_id rows unbounded preceding) as double) as balance from events""")
def running_sum(t):
    summed = w.running_sum(w.time_chunks(t.events, ["user_id"], "ts", "span"), ["user_id"], ["ts", "event_id"], F.col("value").cast("decimal(18,2)"), "balance", chunk=F.col("span"))
    return summed.select("event_id", F.col("balance").cast("double").alias("balance"))


@query("op_broadcast_max", "select event_id, max(case when msg_type = 'purchase' then value end) over (partition by tx_id) as top from v_msgs")
def broadcast_max(t):
    top = F.max(F.when(F.col("msg_type") == "purchase", F.col("value")))
    return w.broadcast_agg(t.msgs, ["tx_id"], top=top).select("event_id", "top")


@query("op_mod_batches", """select o_orderkey, (rn - 1) // 20 as range_no, (rn - 1) // 20 // 100 as call_no from (select o_orderkey, row_number() over (order by o_orderkey) as rn from orders where o_orderstatus = 'F')""")
def mod_batches(t):
    return w.mod_batches(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey"), "o_orderkey", 20, 100)


@query("op_ntile_batches", """select o_orderkey, (rn - 1) // 2000 as range_no from (select o_orderkey, row_number() over (order by o_orderkey) as rn from orders)""")
def ntile_batches(t):
    return w.mod_batches(t.orders.select("o_orderkey"), "o_orderkey", 2000, 1).drop("call_no")


@query("op_array_sort_rank", """with n as (select distinct o_orderkey as tx, 'ORIGIN' as addr, [-1] as path from orders union all select distinct l_orderkey, l_linenumber || '_' || l_suppkey, [l_linenumber, cast(l_suppkey as int)] from lineitem)
    select tx, addr, row_number() over (partition by tx order by path) - 1 as trace_index from n""")
def array_sort_rank(t):
    root = t.orders.select(F.col("o_orderkey").alias("tx"), F.lit("ORIGIN").alias("addr"))
    leaf = t.lineitem.select(F.col("l_orderkey").alias("tx"), F.concat(F.col("l_linenumber"), F.lit("_"), F.col("l_suppkey")).alias("addr")).distinct()
    first_step = F.coalesce(F.get(F.split("addr", "_"), F.lit(0)).try_cast("int"), F.lit(-1))
    return w.tree_position(root.unionByName(leaf), ["tx"], "addr", chunk=first_step)


@query("op_count_prefix_pairs", """with w as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, regexp_extract_all(substr(data, 3), '.{32}') as ws from v_words), p as (select *, unnest(range(0, 2)) as pair_no from w)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, pair_no, ws[2 * pair_no + 1] as first_word, ws[2 * pair_no + 2] as second_word from p""")
def count_prefix_pairs(t):
    from ..functions.hexwords import hex_words
    halves = t.words.withColumn("ws", hex_words("data", 32))
    return w.word_pairs(halves, "ws").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("pair_no").cast("bigint").alias("pair_no"), "first_word", "second_word")
