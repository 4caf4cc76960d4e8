"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, windows
from .base import day_no, query


@query("op_join_inner", "select o_orderkey, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey")
def inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "c_mktsegment")


@query("op_join_left", "select c_custkey, o_orderkey, o_orderstatus from customer left join orders on c_custkey = o_custkey")
def left(t):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey", "o_orderstatus")


@query("op_join_full", """with s as (select l_partkey as part, cast(l_shipdate as date) as d, count(*) as n from lineitem where l_returnflag = 'N' group by 1, 2),
    r as (select l_partkey as part, cast(l_shipdate as date) as d, count(*) as n from lineitem where l_returnflag = 'R' group by 1, 2)
    select coalesce(s.part, r.part) as part, strftime(coalesce(s.d, r.d), '%Y-%m-%d') as d, coalesce(s.n, 0) as sold, coalesce(r.n, 0) as returned
    from s full join r on s.part = r.part and s.d = r.d""")
def full(t):
    def per_day(flag, out):
        return t.lineitem.filter(F.col("l_returnflag") == flag).groupBy(F.col("l_partkey").alias("part"), F.to_date("l_shipdate").alias("d")).agg(F.count(F.lit(1)).alias(out))
    both = per_day("N", "sold").join(per_day("R", "returned"), ["part", "d"], "full")
    return both.select("part", "d", F.coalesce("sold", F.lit(0)).alias("sold"), F.coalesce("returned", F.lit(0)).alias("returned"))


@query("op_join_semi", "select c_custkey from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')")
def semi(t):
    done = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(done, "c_custkey", "left_semi").select("c_custkey")


@query("op_join_anti", "select p_partkey from part where not exists (select 1 from lineitem where l_partkey = p_partkey and l_quantity > 48)")
def anti(t):
    sold = t.lineitem.filter("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.join(sold, "p_partkey", "left_anti").select("p_partkey")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("op_join_cross", """select n_name, p as priority from nation, (values ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) v(p)""")
def cross(t):
    """Every row with each entry of a literal list: an explode, no product of two tables."""
    return t.nation.select("n_name", F.explode(F.array(*[F.lit(p) for p in PRIORITIES])).alias("priority"))


@query("op_join_self", """select a.l_orderkey, a.l_linenumber as out_line, b.l_linenumber as in_line, a.l_partkey as out_part, b.l_partkey as in_part, a.l_suppkey as out_supp, b.l_suppkey as in_supp
    from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_quantity = b.l_quantity where a.l_returnflag = 'R' and b.l_returnflag = 'N'""")
def self_join(t):
    def role(flag, p):
        return t.lineitem.filter(F.col("l_returnflag") == flag).select(
            "l_orderkey", "l_quantity", F.col("l_linenumber").alias(f"{p}_line"), F.col("l_partkey").alias(f"{p}_part"), F.col("l_suppkey").alias(f"{p}_supp"))
    return role("R", "out").join(role("N", "in"), ["l_orderkey", "l_quantity"]).drop("l_quantity")


_INTERVALS = """select o_custkey, start_day, coalesce(lead(start_day) over (partition by o_custkey order by start_day) - 1, 1000000000000000000) as end_value
    from (select distinct o_custkey, start_day from v_versions)"""


@query("op_join_range", f"""with iv as ({_INTERVALS}) select l_orderkey, l_linenumber, l_partkey, l_suppkey, start_day from lineitem join orders o on l_orderkey = o_orderkey
    join iv on iv.o_custkey = o.o_custkey and date_diff('day', date '1992-01-01', cast(l_shipdate as date)) between start_day and end_value""")
def in_range(t):
    """The customer's order interval that holds each ship date."""
    starts = t.versions.select("o_custkey", "start_day").distinct()
    intervals = windows.lead_interval(starts, ["o_custkey"], "start_day", chunk=F.expr("start_day div 365"))
    shipped = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("o_custkey").alias("cust"), day_no("l_shipdate").alias("ship_day"))
    hit = joins.in_interval(shipped, intervals, {"cust": "o_custkey"}, "ship_day", "start_day", "end_value", width=365)
    return hit.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "start_day")


@query("op_join_spine", """with r as (select user_id, min(cast(ts as date)) as lo from events group by 1)
    select user_id, strftime(unnest(range(lo, date '2024-02-01', interval 1 day)), '%Y-%m-%d') as day from r""")
def spine(t):
    first = t.events.groupBy("user_id").agg(F.to_date(F.min("ts")).alias("lo"))
    return joins.daily_spine(first, "lo", F.lit("2024-01-31").cast("date")).select("user_id", "day")


@query("op_join_theta_gap", """with k as (select distinct l_orderkey as id from lineitem), g as (select lag(id) over (order by id) as p, id from k)
    select unnest(range(p + 1, id)) as missing from g where id - p > 1""")
def theta_gap(t):
    """Order keys no line refers to, between neighbours."""
    ids = t.lineitem.select(F.lit(1).alias("chain"), F.col("l_orderkey").alias("id")).distinct()
    gaps = windows.lag_gap(ids, ["chain"], "id", chunk=F.expr("id div 10000")).filter("gap > 1")
    return joins.missing_between(gaps, "prev_id", "id").select("missing")


@query("op_join_theta_le", """with c as (select l_orderkey, count(*) as n from lineitem group by 1) select l_orderkey, unnest(range(1, cast(ceil(n / 3.0) as bigint) + 1)) as page from c""")
def theta_le(t):
    counts = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return joins.pages(counts, "n", 3).select("l_orderkey", F.col("page").cast("bigint").alias("page"))


@query("op_join_nearest_preceding", """with s as (select *, last_value(case when event_type = 'click' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as click_id from events)
    select event_id, click_id from s where event_type = 'purchase' and click_id is not null""")
def nearest(t):
    hit = joins.nearest_preceding(
        windows.time_chunks(t.events, ["user_id"], "ts", "span"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "click", F.col("event_type") == "purchase", ["event_id"], chunk=F.col("span"))
    return hit.select("event_id", F.col("prev_event_id").alias("click_id"))


@query("op_join_ordered_match", """select a.event_id, min(b.event_id) as match_id from v_msgs a join v_msgs b on a.tx_id = b.tx_id and a.msg_type = b.msg_type and b.msg_index > a.msg_index group by 1""")
def ordered_match(t):
    """The next message of the same type in the transaction. The nearest later match is the next row in
    order, so no pairs are formed."""
    nxt = windows.neighbour(t.msgs, ["tx_id", "msg_type"], ["msg_index", "event_id"], "event_id", "match_id", ahead=True, chunk=F.expr("msg_index div 10000"))
    return nxt.filter(F.col("match_id").isNotNull()).select("event_id", "match_id")


@query("op_join_hour", """select e.event_id, p.close as price, round(e.value * p.close, 4) as usd, q.open as price_out from events e
    left join v_prices p on p.token = e.event_type and p.hour = date_trunc('hour', e.ts)
    left join v_prices q on q.token = 'purchase' and q.hour = date_trunc('hour', e.ts)""")
def hour(t):
    p = t.prices_hourly
    with_in = joins.hourly(t.events.withColumn("out_token", F.lit("purchase")), p, "event_type", "ts", cols=("close",))
    both = joins.hourly(with_in, p, "out_token", "ts", cols=("open",), prefix="out_")
    return both.select("event_id", F.col("close").alias("price"), F.round(F.col("value") * F.col("close"), 4).alias("usd"), F.col("out_open").alias("price_out"))


@query("op_join_null_safe", """with a as (select o_orderkey, nullif(o_orderpriority, '5-LOW') as p from orders), b as (select nullif(o_orderpriority, '5-LOW') as p, count(*) as n from orders group by 1)
    select o_orderkey, coalesce(a.p, '-') as p, n from a left join b on coalesce(a.p, '-1') = coalesce(b.p, '-1')""")
def null_safe(t):
    a = t.orders.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"))
    b = a.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    return joins.null_safe(a, b, ["p"]).select("o_orderkey", F.coalesce("p", F.lit("-")).alias("p"), "n")


@query("op_join_or", """select c_custkey, n_nationkey from customer join nation on c_nationkey = n_nationkey or lower(c_mktsegment) = lower(substr(n_name, 1, 9))""")
def either(t):
    n = t.nation
    pairs = [(F.col("c_nationkey"), F.col("n_nationkey")), (F.lower("c_mktsegment"), F.lower(F.substring("n_name", 1, 9)))]
    return joins.either_key(t.customer, n, pairs, ["c_custkey", "n_nationkey"]).select("c_custkey", "n_nationkey")


_KEYWORDS = "(select distinct regexp_extract(p_name, '([^ ]+)$', 1) as kw from part)"


@query("op_join_ilike", f"select p_partkey, kw from part, {_KEYWORDS} where p_name ilike '%' || kw || '%'")
def ilike(t):
    words = t.part.select(F.regexp_extract("p_name", "([^ ]+)$", 1).alias("kw")).distinct()
    return joins.contains_any(t.part, "p_name", words, "kw").select("p_partkey", "kw")


@query("op_join_ilike_many", "select p_partkey, piece from part, (select distinct substr(p_name, 3, 7) as piece from part) where p_name ilike '%' || piece || '%'")
def ilike_many(t):
    """The same with about as many patterns as rows."""
    pieces = t.part.select(F.substring("p_name", 3, 7).alias("piece")).distinct()
    return joins.contains_any(t.part, "p_name", pieces, "piece").select("p_partkey", "piece")


_TRACES = """select o_orderkey as tx, 'ORIGIN' as addr, o_orderstatus = 'P' as bad from orders where o_orderpriority = '1-URGENT'
    union all select l_orderkey, l_linenumber || '', bool_or(l_returnflag = 'R') from lineitem group by l_orderkey, l_linenumber
    union all select l_orderkey, l_linenumber || '_' || l_suppkey, bool_or(l_linestatus = 'F' and l_tax = 0) from lineitem group by l_orderkey, l_linenumber, l_suppkey"""


def line_traces(t):
    root = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("tx"), F.lit("ORIGIN").alias("addr"), (F.col("o_orderstatus") == "P").alias("bad"))
    li = t.lineitem
    line = li.groupBy(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").cast("string").alias("addr")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("bad"))
    leaf = li.groupBy(F.col("l_orderkey").alias("tx"), F.concat(F.col("l_linenumber"), F.lit("_"), F.col("l_suppkey")).alias("addr")).agg(
        F.bool_or((F.col("l_linestatus") == "F") & (F.col("l_tax") == 0)).alias("bad"))
    return root.unionByName(line).unionByName(leaf)


@query("op_join_regex_descendant", f"""with tr as ({_TRACES}) select a.tx, a.addr, bool_or(coalesce(b.bad, false) and (b.addr = 'ORIGIN' or regexp_full_match(a.addr, b.addr || '(_[0-9]+)*'))) as failed
    from tr a left join tr b on a.tx = b.tx and b.bad group by 1, 2""")
def descendant(t):
    return joins.inside_flagged(line_traces(t), ["tx"], "addr", F.col("bad"), "failed").select("tx", "addr", "failed")


@query("op_join_multi_dim", """with k as (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey, array[c_nationkey, s_nationkey, null] as toks from lineitem join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'token0=' || c.n_name || ',token1=' || s.n_name as n_name_by_token, 'token0=' || toks[1] || ',token1=' || toks[2] as tokens
    from k join nation c on c.n_nationkey = toks[1] join nation s on s.n_nationkey = toks[2]""")
def multi_dim(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(*keys, "c_nationkey", "s_nationkey").distinct()
    tokens = F.array("c_nationkey", "s_nationkey", F.lit(None).cast("int"))
    return joins.many_roles(rows, keys, tokens, t.nation, "n_nationkey", ["n_name"])
