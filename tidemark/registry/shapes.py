"""Projections, filters, flattening, set operations, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import common as c
from ..functions import labels
from ..operators import joins, rows, sets
from .base import query


@query("op_json_project", """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, json_extract_string(props, '$.missing') as missing from events""")
def json_project(t):
    fields = {"k": (["$.kk", "$.k"], "bigint"), "missing": (["$.missing"], "string")}
    return rows.json_project(t.events, "props", fields, ["event_id"])


@query("op_filter", """select p_partkey, p_type, p_brand from part where p_type ilike '%econ%' and p_size between 5 and 40
    and p_brand || '|' || p_type not in ('Brand#1|ECONOMY') and p_name like '%ring'""")
def filters(t):
    pair = F.concat("p_brand", F.lit("|"), "p_type")
    keep = F.col("p_type").ilike("%econ%") & F.col("p_size").between(5, 40) & ~pair.isin("Brand#1|ECONOMY") & F.col("p_name").like("%ring")
    return t.part.filter(keep).select("p_partkey", "p_type", "p_brand")


@query("op_scalar_subquery_filter", "select o_orderkey from orders where o_orderdate = (select max(o_orderdate) from orders where o_orderdate < (select max(o_orderdate) from orders))")
def scalar_subquery_filter(t):
    t.orders.createOrReplaceTempView("tidemark_orders")
    return t.spark.sql("""select o_orderkey from tidemark_orders where o_orderdate =
        (select max(o_orderdate) from tidemark_orders where o_orderdate < (select max(o_orderdate) from tidemark_orders))""")


@query("op_case_map", "select o_orderkey, case o_orderstatus when 'F' then 'finished' when 'O' then 'open' else o_orderstatus end as status from orders")
def case_map(t):
    s = F.col("o_orderstatus")
    return t.orders.select("o_orderkey", F.when(s == "F", "finished").when(s == "O", "open").otherwise(s).alias("status"))


@query("op_first_non_null", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(s_name, c_name, 'unknown') as party from lineitem
    left join supplier on l_suppkey = s_suppkey and s_acctbal > 5000 left join customer on l_partkey = c_custkey""")
def first_non_null(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    s = t.supplier.filter("s_acctbal > 5000")
    named = li.join(s, li.l_suppkey == s.s_suppkey, "left").join(t.customer, F.col("l_partkey") == F.col("c_custkey"), "left")
    return named.select(*li.columns, F.coalesce("s_name", "c_name", F.lit("unknown")).alias("party"))


@query("op_surrogate_key", "select l_orderkey, l_linenumber, md5(l_orderkey || '-' || l_linenumber || '-' || coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_')) as line_id from lineitem")
def surrogate(t):
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return t.lineitem.select("l_orderkey", "l_linenumber", c.surrogate_key("l_orderkey", "l_linenumber", flag).alias("line_id"))


@query("op_usd_outlier_null", """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round(case when l_returnflag <> 'A' and (b is null or abs((a - b) / nullif(b, 0)) > 0.75 or abs((a - b) / nullif(a, 0)) > 0.75) then null else a end, 2) as a_usd,
    round(case when l_linestatus <> 'F' and (a is null or abs((b - a) / nullif(a, 0)) > 0.75 or abs((b - a) / nullif(b, 0)) > 0.75) then null else b end, 2) as b_usd
    from (select *, l_extendedprice as a, round(p_retailprice * l_quantity, 2) as b from lineitem left join part on l_partkey = p_partkey)""")
def usd_outlier(t):
    priced = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    priced = priced.withColumn("a", F.col("l_extendedprice")).withColumn("b", F.round(F.col("p_retailprice") * F.col("l_quantity"), 2))
    return priced.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        c.usd_unless_outlier("a", "b", F.col("l_returnflag") != "A").alias("a_usd"),
        c.usd_unless_outlier("b", "a", F.col("l_linestatus") != "F").alias("b_usd"))


@query("op_usd_cap", "select o_orderkey, round(case when o_totalprice < 250000 then o_totalprice end, 2) as usd from orders")
def usd_cap(t):
    return t.orders.select("o_orderkey", c.usd_below("o_totalprice", 250000).alias("usd"))


_PADDED = "'0x' || lpad(cast(l_partkey as varchar), 40, '0')"


@query("op_pool_label", f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
    coalesce(p_brand, substr({_PADDED}, 1, 5) || '...' || substr({_PADDED}, 39)) || '-' || s_name || ' ' || cast(round(l_tax * 100) as int) || ' 0 V3' as label,
    case when p_brand < s_name then p_brand || '-' || s_name else s_name || '-' || p_brand end as pair
    from lineitem left join part on l_partkey = p_partkey and p_size > 10 left join supplier on l_suppkey = s_suppkey""")
def pool_label(t):
    named = t.lineitem.join(t.part.filter("p_size > 10"), F.col("l_partkey") == F.col("p_partkey"), "left").join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    address = F.concat(F.lit("0x"), F.lpad(F.col("l_partkey").cast("string"), 40, "0"))
    fee = F.round(F.col("l_tax") * 100).cast("int")
    label = labels.pool_label([("p_brand", address), ("s_name", F.lit(None).cast("string"))], fee, F.lit(None).cast("int"), "V3")
    return named.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", label.alias("label"), labels.pair_name("p_brand", "s_name").alias("pair"))


@query("op_lateral_flatten", "select vec_id, unnest(range(len(embedding))) as pos, round(cast(unnest(embedding) as double), 6) as x from embeddings")
def lateral_flatten(t):
    return rows.flatten(t.embeddings, "embedding", "pos", "x").select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("x"))


@query("op_lateral_flatten_outer", """select event_id, key, value from (select event_id, unnest(case when event_type = 'error' then [null] else map_keys(m) end) as key,
    unnest(case when event_type = 'error' then [null] else map_values(m) end) as value from (select event_id, event_type, cast(props::json as map(varchar, varchar)) as m from events))""")
def lateral_flatten_outer(t):
    m = F.when(F.col("event_type") != "error", F.from_json("props", "map<string,string>"))
    return rows.flatten_map(t.events.select("event_id", m.alias("m")), "m", outer=True).select("event_id", "key", "value")


@query("op_json_leaves", """with l as (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag from lineitem), i as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_returnflag) - 1 as i from l)
    select l_orderkey, 'order' as path, l_orderkey || '' as value from (select distinct l_orderkey from l) union all select l_orderkey, 'lines[' || i || '].n', l_linenumber || '' from i union all select l_orderkey, 'lines[' || i || '][''part.key'']', l_partkey || '' from i
    union all select l_orderkey, 'lines[' || i || '].by.ids[0]', l_suppkey || '' from i where l_returnflag <> 'N' union all select l_orderkey, 'lines[' || i || '].by.ids[1][0].flag', l_returnflag from i where l_returnflag <> 'N' union all select l_orderkey, 'lines[' || i || '].by.ids', '[]' from i where l_returnflag = 'N'""")
def json_leaves(t):
    """Payloads whose arrays hold numbers, objects and arrays; some are empty."""
    line = ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
    orders = t.lineitem.select("l_orderkey", *line).distinct().groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*line))).alias("lines"))

    def one(x):
        ids = F.concat(F.lit("["), x["l_suppkey"].cast("string"), F.lit(',[{"flag":"'), x["l_returnflag"], F.lit('"}]]'))
        return F.concat(F.lit('{"n":'), x["l_linenumber"].cast("string"), F.lit(',"part.key":'), x["l_partkey"].cast("string"), F.lit(',"by":{"ids":'), F.when(x["l_returnflag"] == "N", F.lit("[]")).otherwise(ids), F.lit("}}"))

    text = F.concat(F.lit('{"order":'), F.col("l_orderkey").cast("string"), F.lit(',"lines":['), F.array_join(F.transform("lines", one), ","), F.lit("]}"))
    return rows.json_leaves(orders.select("l_orderkey", text.alias("payload")), "payload")


@query("op_flatten_recursive", """with l as (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, l_shipdate from lineitem)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, 'ORIGIN' as trace_address, null as parent_address, l_returnflag as kind from l
    union all select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, '0', 'ORIGIN', l_linestatus from l
    union all select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, '1', 'ORIGIN', 'last' from l
    union all select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, '0_0', '0', 'leaf' from l where l_returnflag <> 'N'""")
def flatten_recursive(t):
    """A nested payload per line: its status below it, and a leaf below that for some."""
    line = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    leaf = F.when(F.col("l_returnflag") != "N", F.array(F.struct(F.lit("leaf").alias("kind"))))
    first = F.struct(F.col("l_linestatus").alias("kind"), leaf.alias("calls"))
    last = F.struct(F.lit("last").alias("kind"), F.lit(None).cast("array<struct<kind:string>>").alias("calls"))
    tree = F.struct(F.col("l_returnflag").alias("kind"), F.array(first, last).alias("calls"))
    once = t.lineitem.select(*line, "l_returnflag", "l_linestatus", "l_shipdate").distinct()
    stored = t.table("trees", lambda: once.select(*line, F.to_json(tree).alias("payload")))
    return rows.flatten_tree(stored, "payload", "calls", {"kind": "kind"}, step=1)


@query("op_split_rows", r"select doc_id, w as word, count(*) as n from (select doc_id, unnest(regexp_split_to_array(text, '[ \n\t]+')) as w from documents) group by 1, 2")
def split_rows(t):
    return rows.split_rows(t.documents.select("doc_id", "text"), "text", r"[ \n\t]+", "word").groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@query("op_range_explode", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, unnest(range(l_linenumber, l_linenumber + cast(l_quantity as bigint) - 5)) as unit from lineitem where l_quantity - 5 > 0""")
def range_explode(t):
    n = F.col("l_quantity").cast("bigint") - 5
    return joins.int_range(t.lineitem, F.col("l_linenumber").cast("bigint"), n, "unit").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "unit")


# --- sorts and top-k ---------------------------------------------------------------------------


@query("op_topk", """select l_partkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as revenue from lineitem group by 1 order by 2 desc, 1 limit 20""")
def topk(t):
    sums = t.lineitem.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"))
    return sums.orderBy(F.col("revenue").desc(), "l_partkey").limit(20)


@query("op_topk_stale_first", """select c_custkey from (select c_custkey, max(o_orderdate) as d from customer left join orders on c_custkey = o_custkey group by 1)
    order by coalesce(d, timestamp '1970-01-01'), c_custkey limit 20""")
def topk_stale(t):
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"))
    seen = t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
    return seen.orderBy(F.coalesce("d", F.lit("1970-01-01").cast("timestamp_ntz")), "c_custkey").limit(20).select("c_custkey")


@query("op_sort", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey")
def sort(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(c.newest("o_totalprice"), c.oldest("o_orderkey"))


# --- set operations ----------------------------------------------------------------------------


@query("op_union_all", "select c_custkey as party, c_nationkey as nation, 'customer' as platform from customer union all select s_suppkey, s_nationkey, 'supplier' from supplier")
def union_all(t):
    return sets.union_labelled({
        "customer": t.customer.select(F.col("c_custkey").alias("party"), F.col("c_nationkey").alias("nation")),
        "supplier": t.supplier.select(F.col("s_suppkey").alias("party"), F.col("s_nationkey").alias("nation"))})


@query("op_union_distinct", "select c_nationkey as nation from customer union select s_nationkey from supplier")
def union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("nation")).union(t.supplier.select("s_nationkey")).distinct()


@query("op_intersect", """select l_orderkey from lineitem join part on l_partkey = p_partkey where p_type = 'ECONOMY'
    intersect select l_orderkey from lineitem join part on l_partkey = p_partkey where p_type = 'SMALL'""")
def intersect(t):
    typed = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_type")
    return typed.filter("p_type = 'ECONOMY'").select("l_orderkey").intersect(typed.filter("p_type = 'SMALL'").select("l_orderkey"))


@query("op_except", "select p_partkey from part except select l_partkey from lineitem where l_quantity > 45 except select l_partkey from lineitem where l_discount = 0")
def except_chain(t):
    big = t.lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    full = t.lineitem.filter("l_discount = 0").select(F.col("l_partkey").alias("p_partkey"))
    return sets.missing(t.part.select("p_partkey"), big, full)


_A = "select o_orderkey, o_orderstatus from orders where o_orderdate < timestamp '1999-01-01'"
_B = "select o_orderkey, case when o_orderpriority = '5-LOW' then 'X' else o_orderstatus end as o_orderstatus from orders where o_orderdate >= timestamp '1996-01-01'"


def _versions(t):
    a = t.orders.filter("o_orderdate < timestamp_ntz '1999-01-01'").select("o_orderkey", "o_orderstatus")
    b = t.orders.filter("o_orderdate >= timestamp_ntz '1996-01-01'").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return a, b


_DIFF = f"""select 'in_actual_not_in_expected' as which_diff, * from ({_A} except {_B})
    union all select 'in_expected_not_in_actual', * from ({_B} except {_A})"""


@query("op_symmetric_diff", _DIFF)
def symmetric_diff(t):
    return sets.symmetric_diff(*_versions(t), ["o_orderkey", "o_orderstatus"])
