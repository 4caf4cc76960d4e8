"""Message-side jobs, run on payloads that Spark builds from the event table.

Ten consecutive events form a transaction. An event becomes a message by its type: click an action,
view a module note, purchase a transfer, signup a `tx` entry with fee and sequence, error a signer
entry. Attributes are base64 text in JSON, as a node delivers them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..operators import increments as inc
from ..plans.cosmos import core, reports, stats
from ..session import staged
from .base import VIEWS, block_of, query

# for the query on late blocks: the first block that has not landed yet
LANDED = 700
NOW = datetime(2024, 2, 1)


def kv(*pairs):
    return F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs])


def event_attributes():
    k = F.get_json_object("props", "$.k")
    user = F.concat(F.lit("u"), F.col("user_id"))
    e = F.col("event_type")
    return (
        F.when(e == "click", kv(("action", F.concat(F.lit("act"), k)), ("sender", user)))
        .when(e == "view", kv(("module", F.lit("bank"))))
        .when(e == "purchase", kv(("recipient", F.concat(F.lit("r"), k)), ("sender", user), ("amount", F.concat(k, F.lit("utok")))))
        .when(e == "signup", kv(("fee", F.concat(k, F.lit("usei"))), ("acc_seq", F.concat(user, F.lit("/"), F.col("event_id")))))
        .otherwise(kv(("sei_addr", F.concat(F.lit("s"), F.col("user_id")))))
    )


MSG_TYPES = {"click": "message", "view": "message", "purchase": "transfer", "signup": "tx", "error": "signer"}


def message_type(types=None):
    out = F.lit(None).cast("string")
    for event, kind in (types or MSG_TYPES).items():
        out = F.when(F.col("event_type") == event, F.lit(kind)).otherwise(out)
    return out


def raw_transactions(t, kind=None, attrs=None) -> DataFrame:
    """One JSON payload per transaction; `kind` and `attrs` give other meanings to the event types."""
    kind = message_type() if kind is None else kind
    coded = F.transform(event_attributes() if attrs is None else attrs, lambda a: F.struct(F.base64(a["key"]).alias("key"), F.base64(a["value"]).alias("value")))
    event = F.struct((F.col("event_id") % 10).alias("i"), kind.alias("type"), coded.alias("attributes"))
    txs = t.events.groupBy(F.concat(F.lit("T"), F.expr("cast(event_id div 10 as string)")).alias("hash")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("_inserted_timestamp"), F.count_if(F.col("event_type") == "error").alias("errors"),
        F.array_sort(F.collect_list(event)).alias("events"))
    events = F.transform("events", lambda m: F.struct(m["type"].alias("type"), m["attributes"].alias("attributes")))
    result = F.struct(F.when(F.col("errors") >= 4, F.lit(5)).alias("code"), F.lit(100).alias("gas_used"), F.col("errors").alias("gas_wanted"), events.alias("events"))
    height = block_of("first_ts").cast("string")
    return txs.select(F.to_json(F.struct(height.alias("height"), "hash", result.alias("tx_result"))).alias("data"), "_inserted_timestamp")


def raw_blocks(t) -> DataFrame:
    """One JSON payload per landed block."""
    txs = t.events.groupBy(F.expr("event_id div 10").alias("tx")).agg(F.min("ts").alias("ts"))
    heads = txs.groupBy(block_of("ts").alias("h")).agg(F.min("ts").alias("time"), F.count(F.lit(1)).alias("n"))
    heads = heads.withColumn("txs", F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("n")), lambda i: i.cast("string")))
    header = F.struct(F.col("h").cast("string").alias("height"), F.lit("main-1").alias("chain_id"), F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"),
                      F.concat(F.lit("p"), F.col("h") % 7).alias("proposer_address"))
    block = F.struct(F.struct(F.struct(header.alias("header"), F.struct("txs").alias("data")).alias("block")).alias("result"))
    return heads.select(F.to_json(block).alias("data"), F.col("time").alias("_inserted_timestamp"))


def blocks(t):
    return core.blocks(raw_blocks(t))


def transactions(t):
    return core.transactions(raw_transactions(t), blocks(t))


def other_attributes(t, types, attrs, name="attributes") -> DataFrame:
    """Attribute table of the same events under other message types (a map from event types, or a column)."""
    kind = message_type(types) if isinstance(types, dict) else types
    txs = core.transactions(raw_transactions(t, kind, attrs), blocks(t))
    return t.table(name, lambda: core.msg_attributes(core.messages(txs)))


def final(t):
    """Finished transactions, which read the transactions and their attributes several times: stored ones."""
    txs = t.table("transactions", lambda: transactions(t))
    attrs = t.table("transaction_attributes", lambda: core.msg_attributes(core.messages(txs)))
    return t.table("final", lambda: core.transactions_final(txs, attrs))


def messages(t):
    return core.messages(transactions(t))


def attributes(t):
    return core.msg_attributes(messages(t))


VIEWS.update({
    "c_ev": """select 'T' || (event_id // 10) as tx_id, event_id % 10 as msg_index, event_id, user_id, event_type, json_extract_string(props, '$.k') as k, ts,
        case event_type when 'click' then 'message' when 'view' then 'message' when 'purchase' then 'transfer' when 'signup' then 'tx' else 'signer' end as msg_type from events""",
    "c_tx": """select tx_id, cast(floor((epoch(min(ts)) - 1704067200) / 3600) as bigint) as block_id, count(*) filter (where event_type = 'error') < 4 as tx_succeeded, min(ts) as first_ts from c_ev group by 1""",
    "c_blk": "select block_id, min(first_ts) as block_timestamp, count(*) as tx_count from c_tx group by 1",
    "c_grp": """select e.*, t.block_id, b.block_timestamp, t.tx_succeeded, nullif(sum(case when event_type = 'click' then 1 else 0 end) over (partition by e.tx_id order by msg_index rows unbounded preceding) - 1, -1) as msg_group,
        arg_max(msg_type, msg_index) over (partition by e.tx_id) as last_type from c_ev e join c_tx t on e.tx_id = t.tx_id join c_blk b on b.block_id = t.block_id""",
    "c_rank": """select *, case when event_type = 'view' and msg_group is not null then row_number() over (partition by tx_id, msg_group, event_type order by msg_index) - 1 end as r from c_grp""",
    "c_msg": """select * exclude (r), case when msg_group is not null then coalesce(first_value(r ignore nulls) over (partition by tx_id, msg_group order by msg_index rows between current row and unbounded following),
        case when last_type <> 'tx' then 0 end) end as msg_sub_group from c_rank""",
    "c_att": """select *, unnest(range(0, len(pairs))) as attribute_index, unnest(pairs)[1] as attribute_key, unnest(pairs)[2] as attribute_value from (select *, case event_type when 'click' then [['action', 'act' || k], ['sender', 'u' || user_id]]
        when 'view' then [['module', 'bank']] when 'purchase' then [['recipient', 'r' || k], ['sender', 'u' || user_id], ['amount', k || 'utok']] when 'signup' then [['fee', k || 'usei'], ['acc_seq', 'u' || user_id || '/' || event_id]]
        else [['sei_addr', 's' || user_id]] end as pairs from c_msg)""",
    "c_sender": """select tx_id, arg_min(split_part(attribute_value, '/', 1), (msg_index, attribute_index)) as signer from c_att where attribute_key in ('acc_seq', 'sei_addr') group by 1""",
    "c_xfer": """select a.block_id, a.block_timestamp, a.tx_id, a.tx_succeeded, a.msg_index, 'u' || a.user_id as sender, 'r' || a.k as receiver, a.k as amount, 'utok' as currency from c_msg a join c_sender s on a.tx_id = s.tx_id where a.event_type = 'purchase'""",
    "c_fin": """select t.tx_id, t.block_id, b.block_timestamp, t.tx_succeeded, s.signer as tx_from, coalesce(f.fee, '0usei') as fee from c_tx t join c_blk b on t.block_id = b.block_id left join c_sender s on t.tx_id = s.tx_id
        left join (select tx_id, arg_min(attribute_value, (msg_index, attribute_index)) as fee from c_att where attribute_key = 'fee' group by 1) f on t.tx_id = f.tx_id""",
})

_TS = "strftime(block_timestamp, '%Y-%m-%d %H:%M:%S') as block_timestamp"


@query("chain_blocks", f"select block_id, {_TS}, 'main-1' as chain_id, tx_count, 'p' || (block_id % 7) as proposer_address, md5(block_id || '') as blocks_id from c_blk")
def q_blocks(t):
    return blocks(t).select("block_id", "block_timestamp", "chain_id", F.col("tx_count").cast("bigint").alias("tx_count"), "proposer_address", "blocks_id")


@query("chain_transactions", f"""select t.tx_id, t.block_id, t.tx_succeeded, strftime(coalesce(b.block_timestamp, timestamp '2099-12-31'), '%Y-%m-%d %H:%M:%S') as block_timestamp, 10 as n_msgs, md5(t.tx_id) as transactions_id
    from c_tx t left join c_blk b on t.block_id = b.block_id and b.block_id < {LANDED}""")
def q_transactions(t):
    """The newest blocks have not landed: their transactions carry the sentinel time."""
    late = core.transactions(raw_transactions(t), blocks(t).filter(F.col("block_id") < LANDED))
    return late.select("tx_id", "block_id", "tx_succeeded", "block_timestamp", F.size("msgs").alias("n_msgs"), "transactions_id")


@query("chain_transactions_final", f"select tx_id, block_id, {_TS}, tx_succeeded, tx_from, fee from c_fin")
def q_final(t):
    return final(t).select("tx_id", "block_id", "block_timestamp", "tx_succeeded", "tx_from", "fee")


_MSG = "select tx_id, block_id, msg_index, msg_type, cast(msg_group as varchar) as msg_group, cast(msg_sub_group as varchar) as msg_sub_group, md5(tx_id || '-' || msg_index) as msgs_id from c_msg"


@query("chain_msgs", _MSG)
def q_msgs(t):
    return messages(t).select("tx_id", "block_id", F.col("msg_index").cast("bigint").alias("msg_index"), "msg_type", F.col("msg_group").cast("string").alias("msg_group"), F.col("msg_sub_group").cast("string").alias("msg_sub_group"), "msgs_id")


@query("chain_msgs_any_size", _MSG)
def q_msgs_any(t):
    """The numbering for transactions of any size."""
    rows = core.split_messages(inc.settled(transactions(t), "block_timestamp")).drop("msg")
    numbered = core.number_message_rows(rows, chunk=F.expr("msg_index div 4"))
    return core.keyed(numbered, "msgs_id", "tx_id", "msg_index").select(
        "tx_id", "block_id", F.col("msg_index").cast("bigint").alias("msg_index"), "msg_type", F.col("msg_group").cast("string").alias("msg_group"), F.col("msg_sub_group").cast("string").alias("msg_sub_group"), "msgs_id")


@query("chain_msg_attributes", "select tx_id, msg_index, attribute_index, msg_type, coalesce(msg_group || ':' || msg_sub_group, '-') as msg_group, attribute_key, attribute_value from c_att")
def q_attributes(t):
    out = core.fact_msg_attributes(attributes(t))
    return out.select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), F.col("attribute_index").cast("bigint").alias("attribute_index"), "msg_type", F.coalesce("msg_group", F.lit("-")).alias("msg_group"), "attribute_key", "attribute_value")


@query("chain_transfers", f"select block_id, {_TS}, tx_id, tx_succeeded, 'SEI' as transfer_type, msg_index, sender, receiver, amount, currency, md5(tx_id || '-' || msg_index) as transfers_id from c_xfer")
def q_transfers(t):
    out = core.transfers(attributes(t)).drop("_inserted_timestamp")
    return out.withColumn("msg_index", F.col("msg_index").cast("bigint"))


@query("chain_transfers_hourly", """select strftime(date_trunc('hour', block_timestamp), '%Y-%m-%d %H:%M:%S') as hour, currency, count(*) as n_transfers, count(distinct sender) as n_senders, cast(sum(cast(amount as bigint)) as varchar) as volume from c_xfer group by 1, 2""")
def q_hourly(t):
    rows = core.transfers(attributes(t)).withColumn("hour", F.date_trunc("hour", "block_timestamp"))
    per_sender = rows.groupBy("hour", "currency", "sender").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("v"))
    return per_sender.groupBy("hour", "currency").agg(F.sum("n").alias("n_transfers"), F.count(F.lit(1)).alias("n_senders"), F.sum("v").cast("decimal(38,0)").cast("string").alias("volume"))


@query("chain_block_metrics_hourly", """select strftime(date_trunc('hour', block_timestamp), '%Y-%m-%d %H:%M:%S') as block_timestamp_hour, min(block_id) as block_number_min, max(block_id) as block_number_max, count(*) as block_count from c_blk group by 1""")
def q_block_metrics(t):
    return stats.block_metrics(blocks(t), NOW).select("block_timestamp_hour", "block_number_min", "block_number_max", "block_count")


@query("chain_metrics_hourly", """select strftime(date_trunc('hour', block_timestamp), '%Y-%m-%d %H:%M:%S') as block_timestamp_hour, count(distinct tx_id) as transaction_count, count(distinct case when tx_succeeded then tx_id end) as transaction_count_success,
    count(distinct case when not tx_succeeded then tx_id end) as transaction_count_failed, count(distinct tx_from) as unique_from_count, sum(cast(regexp_extract(fee, '^([0-9]+)', 1) as bigint)) / 1000000.0 as total_fees from c_fin group by 1""")
def q_metrics(t):
    return stats.transaction_metrics(final(t), NOW).drop("_inserted_timestamp", "core_metrics_hourly_id")


@query("chain_ez_core_metrics", """with m as (select date_trunc('hour', block_timestamp) as h, sum(cast(regexp_extract(fee, '^([0-9]+)', 1) as bigint)) / 1000000.0 as fees from c_fin group by 1), p as (select hour, close * 1000000 as close from v_prices where token = 'click' and close > 15),
    f as (select h, fees, last_value(close ignore nulls) over (order by h rows unbounded preceding) as price from m left join p on p.hour = m.h), b as (select date_trunc('hour', block_timestamp) as h, count(*) as block_count from c_blk group by 1)
    select strftime(f.h, '%Y-%m-%d %H:%M:%S') as block_timestamp_hour, block_count, fees as total_fees_native, round(fees * price, 2) as total_fees_usd from f join b on f.h = b.h""")
def q_ez_metrics(t):
    """Fees at the last known price; prices above 15 exist for some hours only."""
    prices = t.prices_hourly.filter("token = 'click' and close > 15").select(F.lit("usei").alias("token_address"), "hour", (F.col("close") * 1000000).alias("price"))
    out = stats.ez_core_metrics(stats.block_metrics(blocks(t), NOW), stats.transaction_metrics(final(t), NOW), prices)
    return out.select("block_timestamp_hour", "block_count", "total_fees_native", F.col("total_fees_usd").alias("total_fees_usd"))


@query("chain_missing_blocks", """with b as (select block_id, lag(block_id) over (order by block_id) as p from (select distinct block_id from c_tx t where exists (select 1 from c_ev e where e.tx_id = t.tx_id and event_type = 'click' and cast(k as int) > 90)))
    select unnest(range(p + 1, block_id)) as missing_id, p as prev_block_id, block_id from b where block_id - p > 1""")
def q_missing_blocks(t):
    """Blocks without a large click, seen from their neighbours."""
    big = t.events.filter((F.col("event_type") == "click") & (F.get_json_object("props", "$.k").cast("int") > 90)).select(F.expr("event_id div 10").alias("tx")).distinct()
    txs = t.events.groupBy(F.expr("event_id div 10").alias("tx")).agg(F.min("ts").alias("ts")).join(big, "tx", "left_semi")
    return stats.missing_blocks(txs.select(block_of("ts").alias("block_id")), width=50)


@query("chain_blocks_completeness", f"""with b as (select * from c_blk where block_id not between 100 and 120 and block_timestamp < timestamp '2024-01-29') select 'blocks' as test_name, min(block_id) as min_block, max(block_id) as max_block, max(block_id) - min(block_id) + 1 as blocks_tested,
    max(block_id) - min(block_id) + 1 - count(*) as blocks_impacted_count from b""")
def q_completeness(t):
    summary, _ = stats.blocks_completeness(blocks(t).filter("block_id not between 100 and 120"), datetime(2024, 1, 30))
    return summary.select("test_name", "min_block", "max_block", "blocks_tested", "blocks_impacted_count")


@query("chain_transactions_completeness", """with told as (select block_id, tx_count from c_blk), have as (select block_id, count(*) as n from c_tx where tx_succeeded group by 1)
    select 'transactions' as test_name, count(*) as blocks_tested, count(*) filter (where coalesce(n, 0) <> tx_count) as blocks_impacted_count, cast(sum(abs(coalesce(n, 0) - tx_count)) as bigint) as transactions_impacted_count
    from told t left join have h on t.block_id = h.block_id where t.block_id >= (select min(block_id) from have)""")
def q_tx_completeness(t):
    """Failed transactions went missing."""
    b = blocks(t)
    metas = b.select("block_id", "block_timestamp", F.col("tx_count").cast("bigint").alias("num_txs"))
    gaps = stats.transaction_gaps(transactions(t).filter("tx_succeeded"), b, metas, datetime(2024, 2, 10))
    return stats.transactions_completeness(gaps).select("test_name", "blocks_tested", "blocks_impacted_count", "transactions_impacted_count")


def _stored(report: reports.Report) -> reports.Report:
    return reports.Report(staged(report.row, "report"), staged(report.lost, "report_lost"), staged(report.tested, "report_tested"))


_REPORT_TS = "strftime(min(block_timestamp), '%Y-%m-%d %H:%M:%S') as min_block_timestamp, strftime(max(block_timestamp), '%Y-%m-%d %H:%M:%S') as max_block_timestamp"


@query("chain_blocks_report", f"""with b as (select * from c_blk where block_id not between 100 and 120 and block_id not between 500 and 510 and block_timestamp < timestamp '2024-01-29'), g as (select block_id, lag(block_id) over (order by block_id) as p from b)
    select 'blocks' as test_name, min(block_id) as min_block, max(block_id) as max_block, {_REPORT_TS}, max(block_id) - min(block_id) + 1 as blocks_tested, max(block_id) - min(block_id) + 1 - count(*) as blocks_impacted_count, (select count(*) from g where block_id - p > 1) as lost_ranges from b""")
def q_blocks_report(t):
    """Two reports; the second reads from the oldest loss of the first. Blocks 200 to 205 came in between."""
    b = t.table("blocks_tested", lambda: blocks(t)).filter("block_id not between 100 and 120")
    first = _stored(reports.blocks_report(b.filter("block_id not between 200 and 205"), datetime(2024, 1, 16), bucket=50))
    second = reports.blocks_report(b.filter("block_id not between 500 and 510"), datetime(2024, 1, 30), first, bucket=50)
    return second.row.drop("test_timestamp")


@query("chain_lost_ranges", """with b as (select block_id, lag(block_id) over (order by block_id) as p from c_blk where block_id not between 100 and 120 and block_timestamp < timestamp '2024-01-29') select p + 1 as lost_from, block_id - 1 as lost_to, block_id - p - 1 as n from b where block_id - p > 1""")
def q_lost(t):
    return reports.blocks_report(t.table("blocks_tested", lambda: blocks(t)).filter("block_id not between 100 and 120"), datetime(2024, 1, 30)).lost


@query("chain_transactions_report", f"""with told as (select * from c_blk where block_timestamp < timestamp '2024-01-29 12:00:00'), have as (select block_id, count(*) as n from c_tx where tx_succeeded group by 1), d as (select t.block_id, t.block_timestamp, coalesce(n, 0) - tx_count as diff from told t left join have h on t.block_id = h.block_id),
    l as (select block_id, lag(block_id) over (order by block_id) as p from d where diff <> 0) select 'transactions' as test_name, min(block_id) as min_block, max(block_id) as max_block, {_REPORT_TS}, count(*) as blocks_tested, count(*) filter (where diff <> 0) as blocks_impacted_count,
    cast(sum(abs(diff)) as bigint) as transactions_impacted_count, (select count(*) from l where p is null or block_id - p > 1) as lost_ranges from d""")
def q_transactions_report(t):
    """Failed transactions went missing; two reports, of which the second takes up the first."""
    metas = t.table("blocks_tested", lambda: blocks(t)).select("block_id", "block_timestamp", F.col("tx_count").cast("bigint").alias("num_txs"))
    txs = t.table("tested_transactions", lambda: transactions(t).select("block_id", "tx_id", "tx_succeeded")).filter("tx_succeeded")
    first = _stored(reports.transactions_report(txs, metas, datetime(2024, 1, 16), bucket=50))
    return reports.transactions_report(txs, metas, datetime(2024, 1, 30), first, bucket=50).row.drop("test_timestamp")


@query("chain_block_metas", f"""select block_id, {_TS}, 'main-1' as chain_id, tx_count as num_txs, block_id * 10 + if(block_id % 7 = 0, 2, 1) as block_size from c_blk""")
def q_metas(t):
    """Pages of up to twenty blocks, wrapped in two ways; some blocks stand in a later page too."""
    meta = F.struct(F.struct(F.lit("main-1").alias("chain_id"), F.col("block_id").cast("string").alias("height"), F.date_format("block_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time")).alias("header"),
                    F.col("tx_count").cast("string").alias("num_txs"), (F.col("block_id") * 10 + F.col("version")).cast("string").alias("block_size"))
    rows = blocks(t).withColumn("version", F.explode(F.when(F.col("block_id") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    pages = rows.groupBy(F.expr("block_id div 20").alias("page"), "version").agg(F.sort_array(F.collect_list(meta)).alias("block_metas"))
    result = F.struct(F.struct("block_metas", F.lit("x").alias("last_height")).alias("result"))
    one, many = F.to_json(F.struct(result.alias("data"))), F.to_json(F.struct(F.array(result).alias("data")))
    stamp = F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(version, 0)")
    out = core.block_metas(pages.select(F.when(F.col("page") % 2 == 0, one).otherwise(many).alias("data"), stamp.alias("_inserted_timestamp")))
    return out.select("block_id", "block_timestamp", "chain_id", "num_txs", "block_size")
