"""Scans, sources, sinks, increments and merges over the given tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from ..functions.common import part
from ..operators import increments as inc
from ..operators import rows
from ..session import scratch_path
from ..sources import files
from .base import query

CUT = datetime(2024, 1, 20)


def _landed(t, only=None, batch: str = "", path: str | None = None):
    """Events as a landing zone would deliver them: JSON files below a day folder."""
    path = path or scratch_path(t.spark, "landed")
    events = t.events if only is None else t.events.filter(only)
    payload = F.to_json(F.struct("event_id", "event_type", "value"))
    meta = F.to_json(F.struct(F.col("event_id").alias("id")))
    day = F.date_format("ts", "yyyyMMdd")
    out = f"{path}/{batch}" if batch else path
    events.select(F.col("event_type").alias("value"), meta.alias("metadata"), payload.alias("data"), day.alias("key")).write.partitionBy("key").json(out)
    return path


def _day_key():
    """Landed as <root>/key=<day>/<file>."""
    return part(part(F.col("file_name"), "/", 1), "=", 2).cast("bigint")


_SCAN_SQL = """select cast(strftime(ts, '%Y%m%d') as bigint) as partition_key, event_id, event_type, value from events"""


def _typed(df):
    fields = {"event_id": (["$.event_id"], "bigint"), "event_type": (["$.event_type"], "string"), "value": (["$.value"], "double")}
    return rows.json_project(df.drop("value"), "data", fields, ["partition_key"])


@query("op_scan_files", _SCAN_SQL + " where ts >= timestamp '2024-01-20' and event_type <> 'view'")
def scan_files(t):
    """Two landings: views, then, a moment later, the rest. Only files since the second count, from a floor on."""
    import time

    path = _landed(t, F.col("event_type") == "view", "first")
    time.sleep(2)
    since = datetime.now(timezone.utc).replace(tzinfo=None)
    time.sleep(1)
    _landed(t, F.col("event_type") != "view", "second", path)
    key = F.regexp_extract("file_name", "key=([0-9]+)/", 1).cast("bigint")
    return _typed(files.scan_files(t.spark, path, key, since, floor=20240120))


@query("op_path_key", _SCAN_SQL)
def scan_path_key(t):
    """Landed as a/b/c/<key>_rest: the key comes from the path."""
    path = scratch_path(t.spark, "keyed")
    payload = F.to_json(F.struct("event_id", "event_type", "value"))
    named = F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("_part"))
    t.events.select(F.lit("").alias("value"), F.lit("").alias("metadata"), payload.alias("data"), F.lit("b").alias("a"), F.lit("c").alias("b"), F.lit("d").alias("c"), named.alias("k")).write.partitionBy("a", "b", "c", "k").json(path)
    name = F.regexp_replace("file_name", "[a-z]+=", "")
    return _typed(files.scan_full_history(t.spark, path, files.path_key(4, name)))


@query("op_scan_full_history", _SCAN_SQL)
def scan_full_history(t):
    path = _landed(t)
    return _typed(files.scan_full_history(t.spark, path, _day_key()))


@query("op_partition_floor", """with f as (select max(o_orderkey) as m from orders)
    select o_orderkey, (o_orderkey + 500) // 1000 * 1000 as bucket from orders, f
    where (o_orderkey + 500) // 1000 * 1000 >= (m + 500) // 1000 * 1000 - 4000""")
def partition_floor(t):
    low = files.partition_floor(t.orders, "o_orderkey", back=4000)
    bucketed = t.orders.select("o_orderkey", F.round("o_orderkey", -3).alias("bucket"))
    return bucketed.filter(F.col("bucket") >= low)


@query("op_error_filter", "select event_id, event_type from events where event_type <> 'error'")
def error_filter(t):
    err = F.when(F.col("event_type") == "error", F.lit('{"error": {"code": "-32000"}}')).otherwise(F.lit('{"result": 1}'))
    return rows.without_errors(t.events.withColumn("data", err), "data").select("event_id", "event_type")


@query("op_error_filter_codes", "select event_id, event_type from events where not (event_type = 'error' and value > 20)")
def error_filter_codes(t):
    code = F.when(F.col("value") > 20, F.lit("-32000")).otherwise(F.lit("7"))
    err = F.when(F.col("event_type") == "error", F.concat(F.lit('{"error": {"code": "'), code, F.lit('"}}')))
    data = F.coalesce(err, F.lit('{"result": 1}'))
    return rows.without_errors(t.events.withColumn("data", data), "data", files.SKIPPED_ERROR_CODES).select("event_id", "event_type")


@query("op_seed", "select c_custkey, n_name, r_name from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey")
def seed(t):
    path = scratch_path(t.spark, "seed")
    t.nation.write.option("header", "true").csv(path)
    nation = files.read_seed(t.spark, path, ["n_nationkey", "n_name", "n_regionkey"])
    named = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey").cast("int"), "left")
    return named.join(t.region, F.col("n_regionkey").cast("int") == F.col("r_regionkey"), "left").select("c_custkey", "n_name", "r_name")


_TIERS = [("AUTOMOBILE", "gold"), ("BUILDING", "silver"), ("MACHINERY", "bronze")]


@query("op_inline_map", """select c_custkey, coalesce(tier, 'none') as tier from customer left join
    (values ('AUTOMOBILE', 'gold'), ('BUILDING', 'silver'), ('MACHINERY', 'bronze')) m(seg, tier) on c_mktsegment = seg""")
def inline_map(t):
    tiers = files.inline_map(t.spark, _TIERS, ["seg", "tier"])
    return t.customer.join(tiers, F.col("c_mktsegment") == F.col("seg"), "left").select("c_custkey", F.coalesce("tier", F.lit("none")).alias("tier"))


@query("op_number_sequence", "select unnest(range(1, (select max(o_orderkey) from orders) + 1)) as block_number")
def number_sequence(t):
    top = t.orders.agg(F.max("o_orderkey").alias("m")).first()["m"]
    return files.number_sequence(t.spark, 1, top)


@query("op_view", "select l_returnflag, count(*) as n from lineitem where l_quantity > 10 group by 1")
def view(t):
    t.lineitem.filter("l_quantity > 10").createOrReplaceTempView("tidemark_big_lines")
    return t.spark.sql("select l_returnflag, count(*) as n from tidemark_big_lines group by l_returnflag")


@query("op_table", "select l_returnflag, count(*) as n from lineitem where l_quantity > 10 group by 1")
def table(t):
    path = scratch_path(t.spark, "table")
    t.lineitem.filter("l_quantity > 10").select("l_returnflag", "l_orderkey").write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("op_ephemeral", "select l_returnflag, count(*) as n from lineitem where l_quantity > 10 group by 1")
def ephemeral(t):
    big = t.lineitem.filter("l_quantity > 10")
    return big.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("op_increment", """with tgt as (select max(_inserted_timestamp) as m from v_arrival where _inserted_timestamp < timestamp '2024-01-20')
    select event_id, strftime(_inserted_timestamp, '%Y-%m-%d %H:%M:%S') as arrived from v_arrival, tgt where _inserted_timestamp >= m - interval 90 minutes""")
def increment(t):
    target = t.arrivals.filter(F.col("_inserted_timestamp") < F.lit(CUT))
    new = inc.increment(t.arrivals, target, "_inserted_timestamp", timedelta(minutes=90))
    return new.select("event_id", F.col("_inserted_timestamp").alias("arrived"))


@query("op_increment_floor", """with tgt as (select max(_inserted_timestamp) as m from v_arrival where _inserted_timestamp < timestamp '2024-01-20')
    select event_id from v_arrival, tgt where _inserted_timestamp >= greatest(m - interval 12 hours, timestamp '2024-01-23')""")
def increment_floor(t):
    target = t.arrivals.filter(F.col("_inserted_timestamp") < F.lit(CUT))
    return inc.increment(t.arrivals, target, "_inserted_timestamp", timedelta(hours=12), floor_days=7, as_of=datetime(2024, 1, 30)).select("event_id")


@query("op_late_lookback", """with tgt as (select max(_inserted_timestamp) as m from v_arrival where _inserted_timestamp < timestamp '2024-01-20')
    select count(*) as n_seen, cast(count(*) filter (where ts < m) as bigint) as n_late from v_arrival, tgt where _inserted_timestamp >= m - interval 4 hours""")
def late_lookback(t):
    target = t.arrivals.filter(F.col("_inserted_timestamp") < F.lit(CUT))
    mark = inc.high_water(target, "_inserted_timestamp")
    again = inc.newer_than(t.arrivals, "_inserted_timestamp", mark, timedelta(hours=4))
    return again.agg(F.count(F.lit(1)).alias("n_seen"), F.count_if(F.col("ts") < F.lit(mark)).alias("n_late"))


def _changed(t):
    """One segment's customers re-arrive, and the suppliers come as new keys."""
    again = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", F.lit("changed").alias("c_name"))
    new = t.supplier.select((F.col("s_suppkey") + 10**9).alias("c_custkey"), F.col("s_name").alias("c_name"))
    return again.unionByName(new).withColumn("loaded", F.lit("batch"))


def _stored(t):
    return t.customer.select("c_custkey", "c_name", F.lit("stored").alias("loaded"))


_CHANGED = """(select c_custkey, 'changed' as c_name, 'batch' as loaded from customer where c_mktsegment = 'BUILDING'
    union all select s_suppkey + 1000000000, s_name, 'batch' from supplier)"""


@query("op_merge_upsert", f"""select coalesce(o.c_custkey, b.c_custkey) as c_custkey, coalesce(b.c_name, o.c_name) as c_name,
    case when o.c_custkey is not null then 'stored' else b.loaded end as loaded from customer o full join {_CHANGED} b on o.c_custkey = b.c_custkey""")
def merge_upsert(t):
    return inc.merge_upsert(_stored(t), _changed(t), ["c_custkey"], keep=["loaded"])


@query("op_merge_update_columns", f"""select coalesce(o.c_custkey, b.c_custkey) as c_custkey, case when o.c_custkey is not null then o.c_name else b.c_name end as c_name,
    coalesce(b.loaded, 'stored') as loaded from customer o full join {_CHANGED} b on o.c_custkey = b.c_custkey""")
def merge_update_columns(t):
    return inc.merge_update_columns(_stored(t), _changed(t), ["c_custkey"], ["loaded"])


def _day_batch(t):
    return t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit(datetime(2001, 1, 1)))).select("o_orderkey", F.to_date("o_orderdate").alias("d"), F.lit("new").alias("src"))


_DAY_BATCH = "(select o_orderkey, cast(o_orderdate as date) as d, 'new' as src from orders where o_orderstatus = 'F' and o_orderdate >= timestamp '2001-01-01')"


@query("op_delete_insert", f"""select o_orderkey, strftime(d, '%Y-%m-%d') as d, src from (select o_orderkey, cast(o_orderdate as date) as d, 'old' as src from orders
    where cast(o_orderdate as date) not in (select d from {_DAY_BATCH}) union all select * from {_DAY_BATCH})""")
def delete_insert(t):
    stored = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"), F.lit("old").alias("src"))
    return inc.delete_insert(stored, _day_batch(t), ["d"])


@query("op_dest_predicate", """with b as (select min(o_orderdate) - interval 7 days as lo, max(o_orderdate) as hi from orders
    where o_orderpriority = '1-URGENT' and year(o_orderdate) = 1998) select o_orderkey, o_custkey from orders, b where o_orderdate between lo and hi""")
def dest_predicate(t):
    batch = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 1998))
    return inc.destination_range(t.orders, batch, "o_orderdate", back=timedelta(days=7), upper=True).select("o_orderkey", "o_custkey")


@query("op_post_delete", "select doc_id, quality, toxic from labels where toxic <> 1")
def post_delete(t):
    return inc.post_delete(t.labels, F.col("toxic") == 1)


@query("op_cluster", "select strftime(o_orderdate, '%Y') as yr, count(*) as n, min(o_orderkey) as lo, max(o_orderkey) as hi from orders where year(o_orderdate) >= 1997 group by 1")
def cluster(t):
    path = scratch_path(t.spark, "cluster")
    rows_by_year = t.orders.withColumn("yr", F.date_format("o_orderdate", "yyyy"))
    rows_by_year.repartitionByRange("yr", "o_orderkey").sortWithinPartitions("yr", "o_orderkey").write.partitionBy("yr").parquet(path)
    back = t.spark.read.parquet(path).filter(F.col("yr") >= "1997")
    return back.groupBy(F.col("yr").cast("string").alias("yr")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query("op_schema_evolve", """select event_id, event_type, cast(null as varchar) as extra from events where event_type in ('click', 'view')
    union all select event_id, cast(null as varchar), event_type || '!' from events where event_type not in ('click', 'view')""")
def schema_evolve(t):
    old_shape = F.col("event_type").isin("click", "view")
    old = t.events.filter(old_shape).select("event_id", "event_type")
    new = t.events.filter(~old_shape).select("event_id", F.concat("event_type", F.lit("!")).alias("extra"))
    return old.unionByName(new, allowMissingColumns=True)


@query("op_upsert_partitions", """select event_id, strftime(ts, '%Y-%m-%d') as day, case when event_type = 'purchase' and ts >= timestamp '2024-01-20' then value * 2 else value end as value from events""")
def upsert_partitions(t):
    """A partitioned table rewritten only in the days its batch touches."""
    path = scratch_path(t.spark, "upsert")
    base = t.events.select("event_id", F.to_date("ts").alias("day"), "value", "event_type")
    inc.write_partitions(base, path, "day")
    batch = base.filter((F.col("event_type") == "purchase") & (F.col("day") >= F.lit(CUT.date()))).withColumn("value", F.col("value") * 2)
    inc.upsert_partitions(t.spark, path, batch, ["event_id", "day"], "day")
    return t.spark.read.parquet(path).select("event_id", "day", "value")
