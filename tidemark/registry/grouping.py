"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import increments as inc
from ..operators import joins
from .base import query

DEC = "decimal(18,2)"


def dec(col):
    return F.col(col).cast(DEC)


@query("op_group_agg", """select l_returnflag, l_linestatus, count(*) as n, cast(sum(cast(l_quantity as decimal(18,2))) as double) as qty, min(l_extendedprice) as lo, max(l_extendedprice) as hi,
    cast(sum(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))) as double) as revenue from lineitem group by all""")
def group_agg(t):
    revenue = F.sum(dec("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("double")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(dec("l_quantity")).cast("double").alias("qty"),
        F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"), revenue.alias("revenue"))


@query("op_count_distinct", """select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour, count(distinct user_id) as n_user_id, count(distinct case when event_type <> 'error' then user_id end) as ok,
    count(distinct case when event_type = 'error' then user_id end) as failed from events group by 1""")
def count_distinct(t):
    err = F.col("event_type") == "error"
    hourly = t.events.withColumn("hour", F.date_trunc("hour", "ts"))
    return agg.distinct_counts(hourly, ["hour"], "user_id", ok=~err, failed=err)


@query("op_conditional_agg", """select user_id, count(*) filter (where event_type = 'click') as clicks, cast(sum(case when event_type = 'error' then 1 else 0 end) as bigint) as errors,
    min(case when event_type = 'purchase' then value end) as least_buy from events group by 1""")
def conditional(t):
    e = F.col("event_type")
    return t.events.groupBy("user_id").agg(
        F.count_if(e == "click").alias("clicks"), F.sum(F.when(e == "error", 1).otherwise(0)).alias("errors"),
        F.min(F.when(e == "purchase", F.col("value"))).alias("least_buy"))


@query("op_having", "select l_partkey, count(distinct l_suppkey) as n from lineitem group by 1 having count(distinct l_suppkey) < 25")
def having(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("n")).filter("n < 25")


@query("op_kv_pivot", """select tx_id, max(case when attribute_key = 'click' then attribute_value end) as click, max(case when attribute_key = 'purchase' then attribute_value end) as purchase from v_attrs group by 1""")
def kv_pivot(t):
    return agg.pivot_known(t.attrs, ["tx_id"], "attribute_key", "attribute_value", {"click": "click", "purchase": "purchase"})


@query("op_kv_pivot_map", """with m as (select tx_id, attribute_key as k, max(attribute_value) as v from v_attrs group by 1, 2) select tx_id, string_agg(k || '=' || v, ',' order by k) as j from m group by 1""")
def kv_pivot_map(t):
    return agg.pivot_map(t.attrs, ["tx_id"], "attribute_key", "attribute_value")


@query("op_array_agg", """select l_returnflag, l_shipdate, part_no, string_agg(cast(l_partkey as varchar), ',' order by l_partkey) as parts from (select l_returnflag, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate, l_partkey,
    (row_number() over (partition by l_returnflag, l_shipdate order by l_partkey, l_orderkey, l_linenumber, l_suppkey) - 1) // 10000 as part_no from lineitem) group by 1, 2, 3""")
def array_agg(t):
    return agg.ordered_arrays(t.lineitem, ["l_returnflag", "l_shipdate"], ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey"], "l_partkey", "parts", chunk=F.expr("l_partkey div 100000"))


@query("op_array_agg_ordered", """with s as (select o_custkey, o_orderkey, (row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1) // 5 as part_no from orders)
    select s.o_custkey, part_no, string_agg(cast(s.o_orderkey as varchar), ',' order by o.o_orderdate, s.o_orderkey) as order_keys from s join orders o on s.o_orderkey = o.o_orderkey group by 1, 2""")
def array_agg_ordered(t):
    return agg.ordered_arrays(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey", "order_keys", size=5, chunk=F.year("o_orderdate"))


@query("op_array_agg_distinct", """select l_suppkey, part_no, string_agg(cast(l_partkey as varchar), ',' order by l_partkey) as parts from (select *, (row_number() over (partition by l_suppkey order by l_partkey) - 1) // 10000 as part_no
    from (select distinct l_suppkey, l_partkey from lineitem where l_returnflag = 'R')) group by 1, 2""")
def array_agg_distinct(t):
    return agg.distinct_arrays(t.lineitem.filter("l_returnflag = 'R'"), ["l_suppkey"], "l_partkey", "parts", chunk=F.expr("l_partkey div 100000"))


@query("op_array_union_agg", "select o_custkey, count(distinct l_partkey) as n_parts from lineitem join orders on l_orderkey = o_orderkey group by 1")
def array_union_agg(t):
    daily = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "o_orderdate").agg(F.collect_set("l_partkey").alias("parts"))
    return agg.array_union_size(daily, ["o_custkey"], "parts", "n_parts")


@query("op_capped_collect", """select o_custkey, string_agg(cast(l_partkey as varchar), ',' order by l_partkey) as parts from (select o_custkey, l_partkey, row_number() over (partition by o_custkey order by l_partkey) as rn
    from (select distinct o_custkey, l_partkey from lineitem join orders on l_orderkey = o_orderkey)) where rn <= 5 group by 1""")
def capped_collect(t):
    pairs = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey").distinct()
    return agg.capped_collect(pairs, ["o_custkey"], ["l_partkey"], "l_partkey", 5, "parts")


@query("op_running_totals_merge", """select user_id, count(*) as n_events, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_ts from events group by 1""")
def running_totals(t):
    def totals(cond):
        return t.events.filter(cond).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.max("ts").alias("last_ts"))
    old = F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")
    return agg.merge_totals(totals(old), totals(~old), ["user_id"], ["n_events"], ["last_ts"])


_DAYS = """select user_id, cast(ts as date) as d, sum(cast(value as decimal(18,2))) as v from events where event_type = '{}' group by 1, 2"""


@query("op_ratio_accumulate", f"""with i as ({_DAYS.format('purchase')}), o as ({_DAYS.format('click')})
    select coalesce(i.user_id, o.user_id) as user_id, strftime(coalesce(i.d, o.d), '%Y-%m-%d') as d,
    round(coalesce(case when o.v is null then 1.0 else cast(i.v as double) / (cast(i.v as double) + cast(o.v as double)) end, 0.0), 6) as share from i full join o on i.user_id = o.user_id and i.d = o.d""")
def ratio_accumulate(t):
    def side(kind):
        return t.events.filter(F.col("event_type") == kind).groupBy("user_id", F.to_date("ts").alias("d")).agg(F.sum(dec("value")).alias("v"))
    shares = agg.share_in(side("purchase"), side("click"), ["user_id", "d"], "v", "share", one_sided=1.0)
    return shares.withColumn("share", F.round("share", 6))


@query("op_union_of_sums", """select user_id, strftime(d, '%Y-%m-%d') as d, cast(sum(n) as bigint) as n from (select user_id, cast(ts as date) as d, count(*) as n from events group by 1, 2
    union all select o_custkey, cast(o_orderdate as date), count(*) from orders group by 1, 2) group by 1, 2""")
def union_of_sums(t):
    e = t.events.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("a"))
    o = t.orders.groupBy(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("a"))
    return agg.sum_sources([e, o], ["user_id", "d"], "a", "n")


@query("op_rolling_window_agg", """with daily as (select user_id, cast(ts as date) as d, count(*) as n, sum(cast(value as decimal(18,2))) as v from events group by 1, 2), dates as (select distinct cast(ts as date) as score_date from events)
    select user_id, strftime(score_date, '%Y-%m-%d') as score_date, cast(sum(n) as bigint) as n, count(*) as active_days, cast(sum(v) as double) as v from daily join dates on d <= score_date and d > score_date - interval 7 days group by 1, 2""")
def rolling(t):
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.sum(dec("value")).alias("v"))
    dates = t.events.select(F.to_date("ts").alias("score_date")).distinct()
    spread = agg.trailing_days(daily, "d", dates, "score_date", 7)
    return spread.groupBy("user_id", "score_date").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("active_days"), F.sum("v").cast("double").alias("v"))


@query("op_first_seen", "select o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') as o_orderdate from orders group by 1")
def first_seen(t):
    from ..operators.windows import first_seen as first
    return first(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate"])


@query("op_tumbling_hour", """select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour, count(*) as n, count(distinct user_id) as users from events
    where date_trunc('hour', ts) < date_trunc('hour', (select max(ts) from events)) group by 1""")
def tumbling_hour(t):
    as_of = F.lit(t.events.agg(F.max("ts")).first()[0])
    closed = inc.closed_hours(t.events, "ts", as_of).withColumn("hour", F.date_trunc("hour", "ts"))
    per_user = closed.groupBy("hour", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("hour").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("users"))


@query("op_touched_hours", """with b as (select distinct date_trunc('hour', ts) as h from v_arrival where _inserted_timestamp >= timestamp '2024-01-29')
    select strftime(h, '%Y-%m-%d %H:%M:%S') as hour, count(*) as n from events join b on date_trunc('hour', ts) = h group by 1""")
def touched_hours(t):
    batch = t.arrivals.filter("_inserted_timestamp >= timestamp_ntz '2024-01-29'")
    rows = inc.touched_hours(batch, t.events, "ts")
    return rows.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query("op_sliding_days", """with daily as (select event_type, cast(ts as date) as d, count(*) as n from events group by 1, 2), dates as (select distinct cast(ts as date) as score_date from events)
    select event_type, strftime(score_date, '%Y-%m-%d') as score_date, cast(sum(n) as bigint) as n from daily join dates on d <= score_date and d > score_date - interval 90 days group by 1, 2""")
def sliding_days(t):
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    dates = t.events.select(F.to_date("ts").alias("score_date")).distinct()
    return agg.trailing_days(daily, "d", dates, "score_date", 90).groupBy("event_type", "score_date").agg(F.sum("n").alias("n"))


@query("op_day_complete", """select strftime(d, '%Y-%m-%d') as block_date from (select cast(ts as date) as d, count(distinct date_trunc('hour', ts)) as n from events where event_type <> 'view' group by 1) where n = 24""")
def day_complete(t):
    return inc.complete_days(t.events.filter("event_type <> 'view'"), "ts")


@query("op_unprocessed_days", """select strftime(d, '%Y-%m-%d') as d from (select distinct cast(o_orderdate as date) as d from orders except select distinct cast(l_shipdate as date) from lineitem where l_returnflag = 'R')""")
def unprocessed(t):
    spine = t.orders.select(F.to_date("o_orderdate").alias("d"))
    done = t.lineitem.filter("l_returnflag = 'R'").select(F.to_date("l_shipdate").alias("d"))
    return inc.unprocessed_days(spine, done, "d")


# --- late data -----------------------------------------------------------------------------------

@query("op_late_parent", """with known as (select * from v_blocks where block_id < 400) select event_id, strftime(coalesce(block_timestamp, timestamp '2099-12-31'), '%Y-%m-%d %H:%M:%S') as block_timestamp
    from v_msgs m left join known k on m.block_id = k.block_id""")
def late_parent(t):
    """Half of the blocks have arrived; the messages of the others wait with the sentinel time."""
    known = t.blocks.filter("block_id < 400")
    return inc.late_parent(None, t.msgs.select("event_id", "block_id"), known, ["block_id"], ["event_id"], "block_timestamp").select("event_id", "block_timestamp")


@query("op_late_parent_repair", """select event_id, strftime(b.block_timestamp, '%Y-%m-%d %H:%M:%S') as block_timestamp from v_msgs m join v_blocks b on m.block_id = b.block_id where m.block_id < 700""")
def late_parent_repair(t):
    """Two runs: the second sees more blocks and dates the rows that were pending."""
    facts = t.msgs.select("event_id", "block_id")
    one = inc.late_parent(None, facts, t.blocks.filter("block_id < 400"), ["block_id"], ["event_id"], "block_timestamp")
    again = inc.late_parent(one, facts.filter(F.lit(False)), t.blocks.filter("block_id < 700"), ["block_id"], ["event_id"], "block_timestamp")
    merged = inc.merge_upsert(one, again, ["event_id"])
    return inc.settled(merged, "block_timestamp").select("event_id", "block_timestamp")


@query("op_heal_nulls", """with p as (select * from v_prices where token in ('click', 'view')) select event_id, p.close as price from events e
    join p on p.token = e.event_type and p.hour = date_trunc('hour', e.ts) where e.value > 10""")
def heal_nulls(t):
    """Rows over 10 lost their price; prices arrive for two of the five tokens."""
    stored = t.events.select("event_id", F.col("event_type").alias("token"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
                             F.when(F.col("value") <= 10, F.lit(1.0)).alias("price"))
    dim = t.prices_hourly.filter(F.col("token").isin("click", "view"))
    return inc.heal_nulls(stored, dim, ["token", "hour"], {"price": "close"}).select("event_id", "price")


@query("op_heal_groups", """with g as (select distinct date_trunc('hour', ts) as h from events e join v_prices p on p.token = e.event_type and p.hour = date_trunc('hour', e.ts) where e.value > 100 and e.event_type = 'click')
    select event_id, case when g.h is not null then p.close when value <= 100 then 1.0 end as price from events e left join g on date_trunc('hour', ts) = g.h
    left join v_prices p on p.token = e.event_type and p.hour = date_trunc('hour', ts)""")
def heal_groups(t):
    """Hours with a healable click are computed again as a whole."""
    stored = t.events.select("event_id", F.col("event_type").alias("token"), "ts", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
                             F.when(F.col("value") <= 100, F.lit(1.0)).alias("price"))
    prices = t.prices_hourly
    groups = inc.healable_groups(stored.filter("token = 'click'"), prices, ["token", "hour"], {"price": "close"}, ["hour"])
    def recompute(members):
        priced = joins.hourly(members.drop("price"), prices, "token", "ts", cols=("close",))
        return priced.withColumnRenamed("close", "price").select(*stored.columns)
    return inc.heal_groups(stored, groups, ["hour"], recompute).select("event_id", "price")
