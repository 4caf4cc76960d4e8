"""Contract-side jobs, run on payloads that Spark builds from the line items.

Every line item is a transaction of the block of its ship date. Its receipt carries two logs: a token
transfer of the part, and a collectible transfer (single or batch by line status). Its call tree has a
delegate call, which fails for some lines, and a creation below it. Payloads are made row by row, so no
group is ever collected.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..operators.rows import once
from ..operators.sets import union_all
from ..plans import worklists as wl
from ..plans.evm import core, replaced, values as V
from ..session import Appended, discard, scratch_path, staged
from .base import VIEWS, Tables, day_no, query

NOW = datetime(2002, 1, 1)


def hexn(c, width=None):
    h = F.lower(F.hex(c))
    return F.lpad(h, width, "0") if width else h


def address(c):
    return F.concat(F.lit("0x"), hexn(c, 40))


def topic(c):
    return F.concat(F.lit("0x"), hexn(c, 64))


def qhex(c):
    """Quantity as a node writes it."""
    return F.concat(F.lit("0x"), hexn(c))


def lines(t) -> DataFrame:
    """Line items with integers for every measure, a hash and a position. Both follow from the measures and are worked
    out by each reader: they would be most of the stored table."""
    rows = measures(t)
    return rows if "tx_hash" in rows.columns else _hashed(rows)


def measures(t) -> DataFrame:
    """The line items as they are stored, for readers that need neither hash nor position."""
    return t.table("lines", lambda: _lines(t))


def _lines(t) -> DataFrame:
    li = t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("qty"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("disc"), F.round(F.col("l_tax") * 100).cast("bigint").alias("tax"), "l_returnflag", "l_linestatus", F.col("l_shipdate").alias("ts")).distinct()
    return li.withColumn("block_number", day_no("ts"))


def _hashed(rows: DataFrame) -> DataFrame:
    text = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "qty", "cents", "disc", "tax", "l_returnflag", "l_linestatus", "block_number")
    h = F.col("_h")
    return once(rows.withColumn("_h", F.sha2(text, 256)), "_h").withColumns({"tx_hash": F.concat(F.lit("0x"), h), "tx_position": F.conv(F.substring(h, 1, 12), 16, 10).cast("bigint")}).drop("_h")


def raw_blocks(t) -> DataFrame:
    """One payload per ship date; the transaction count stands in for the list."""
    per = measures(t).groupBy("block_number").agg(F.min("ts").alias("ts"), F.count(F.lit(1)).alias("n"))
    body = F.struct(qhex(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("timestamp"), qhex("n").alias("gasUsed"), F.concat(F.lit("0xb"), F.col("block_number")).alias("hash"), F.array().cast("array<string>").alias("transactions"))
    return per.select("block_number", F.round("block_number", -3).alias("partition_key"), F.to_json(F.struct(body.alias("result"))).alias("data"), F.col("ts").alias("_inserted_timestamp"))


def raw_transactions(t, call=None) -> DataFrame:
    """`call` is the selector that transactions of open lines call."""
    call = F.lit("0xa9059cbb") if call is None else call
    inp = F.when(F.col("l_linestatus") == "O", F.concat(call, hexn("l_partkey", 64))).otherwise(F.lit("0x"))
    body = F.struct(
        F.col("tx_hash").alias("hash"), address("l_suppkey").alias("from"), address("l_orderkey").alias("to"), F.lit("0x5208").alias("gas"), qhex("cents").alias("gasPrice"), qhex("l_linenumber").alias("nonce"),
        qhex(F.col("qty") * 10**15).alias("value"), inp.alias("input"))
    meta = F.struct(F.struct(qhex("tx_position").alias("transactionIndex")).alias("data"))
    return once(lines(t).select("block_number", F.round("block_number", -3).alias("partition_key"), F.to_json(meta).alias("value"), F.to_json(body).alias("data"), F.col("ts").alias("_inserted_timestamp")), "data")


def _log(i, contract, topics, data):
    return F.struct(contract.alias("address"), F.array(*topics).alias("topics"), data.alias("data"), F.lit(f"0x{i}").alias("logIndex"), F.lit(False).alias("removed"), qhex("tx_position").alias("transactionIndex"))


def raw_receipts(t, more=()) -> DataFrame:
    """`more` are further logs of each receipt."""
    token = _log(0, address("l_partkey"), [F.lit(V.TRANSFER), topic("l_suppkey"), topic("l_orderkey")], F.concat(F.lit("0x"), hexn(F.col("qty") * 1000, 64)))
    batch_data = F.concat(F.lit("0x"), *[hexn(c, 64) for c in (F.lit(64), F.lit(160), F.lit(2), F.col("l_partkey"), F.col("l_suppkey"), F.lit(2), F.col("l_linenumber"), F.col("qty"))])
    batch = _log(1, address("l_orderkey"), [F.lit(V.TRANSFER_BATCH), topic("l_linenumber"), topic("l_suppkey"), topic("l_orderkey")], batch_data)
    single = _log(1, address("l_suppkey"), [F.lit(V.TRANSFER), topic("l_orderkey"), topic("l_suppkey"), topic("l_partkey")], F.lit("0x"))
    second = F.when(F.col("l_linestatus") == "O", single).otherwise(batch)
    body = F.struct(
        F.col("tx_hash").alias("transactionHash"), qhex("tx_position").alias("transactionIndex"), address("l_suppkey").alias("from"), address("l_orderkey").alias("to"),
        F.when(F.col("l_returnflag") == "R", F.lit("0x0")).otherwise(F.lit("0x1")).alias("status"), qhex(21000 + F.col("l_linenumber")).alias("gasUsed"), qhex("cents").alias("effectiveGasPrice"), F.array(token, second, *more).alias("logs"))
    return once(lines(t).select("block_number", F.round("block_number", -3).alias("partition_key"), F.to_json(body).alias("data"), F.col("ts").alias("_inserted_timestamp")), "data")


def raw_traces(t) -> DataFrame:
    made = F.struct(F.lit("CREATE").alias("type"), address("l_orderkey").alias("from"), address(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("to"), F.lit("0x6000").alias("input"), F.lit("0x0").alias("value"))
    delegate = F.struct(
        F.lit("DELEGATECALL").alias("type"), address("l_orderkey").alias("from"), address("l_partkey").alias("to"), F.lit("0xabcd").alias("input"), qhex("disc").alias("value"),
        F.when(F.col("tax") == 0, F.lit("execution reverted")).alias("error"), F.array(made).alias("calls"))
    top = F.struct(
        F.lit("CALL").alias("type"), address("l_suppkey").alias("from"), address("l_orderkey").alias("to"), qhex(F.col("qty") * 10**15).alias("value"), F.lit("0x5208").alias("gas"), qhex(21000 + F.col("l_linenumber")).alias("gasUsed"),
        F.when(F.col("l_returnflag") == "R", F.lit("out of gas")).alias("error"), F.array(delegate).alias("calls"))
    body = F.struct(F.col("tx_hash").alias("txHash"), top.alias("result"))
    meta = F.struct(F.col("tx_position").alias("array_index"))
    return once(lines(t).select("block_number", F.round("block_number", -3).alias("partition_key"), F.to_json(meta).alias("value"), F.to_json(body).alias("data"), F.col("ts").alias("_inserted_timestamp")), "data")


def blocks(t):
    return t.table("blocks", lambda: core.fact_blocks(core.latest_blocks(t.view("raw_blocks", lambda: raw_blocks(t)))))


def receipts(t):
    return t.table("receipts", lambda: core.latest_receipts(t.view("raw_receipts", lambda: raw_receipts(t))))


def latest_transactions(t):
    return t.table("latest_transactions", lambda: core.latest_transactions(t.view("raw_transactions", lambda: raw_transactions(t))))


def transactions(t):
    out = t.table("transactions", lambda: t.needed("transactions", core.fact_transactions(latest_transactions(t), blocks(t), receipts(t))))
    t.release("latest_transactions")
    return out


def early_transactions(t):
    """Transactions as stored while the blocks from number 2500 on were missing."""
    return t.table("early_transactions", lambda: t.needed("early_transactions", core.fact_transactions(latest_transactions(t), blocks(t).filter("block_number < 2500"), receipts(t))))


def logs(t):
    out = t.table("logs", lambda: t.needed("logs", core.fact_event_logs(receipts(t), transactions(t))))
    t.release("receipts")
    return out


def traces(t):
    if "traces" not in t._tables:
        txs = transactions(t)
        t.release("receipts")
        nodes = core.traces(t.view("raw_traces", lambda: raw_traces(t)))
        t.table("traces", lambda: t.needed("traces", core.fact_traces(nodes, txs)))
        discard(nodes)
    return t._tables["traces"]


#: Stored tables of the chain, those that others are made of first.
STORED = ("blocks", "receipts", "latest_transactions", "early_transactions", "transactions", "logs", "traces")


#: What logs and calls read of a transaction.
FOR_LOGS = ["block_number", "tx_hash", "block_timestamp", "tx_position", "origin_function_signature"]
FOR_TRACES = [*FOR_LOGS, "from_address", "to_address", "tx_succeeded"]


def only(t, **read: list[str]) -> tuple[DataFrame, ...]:
    """Tables of the chain for a query that reads no others of it, each with the columns that it reads: the others, 256-bit
    numbers and keys above all, are not worked out. Tables they are made of are removed."""
    makers = {"transactions": transactions, "logs": logs, "traces": traces}
    for_others = [*FOR_LOGS * ("logs" in read), *FOR_TRACES * ("traces" in read)]
    t.read = {n: set(cols) for n, cols in {**read, "transactions": [*read.get("transactions", []), *for_others]}.items()}
    out = tuple(makers[n](t) for n in read)
    t.release(*[n for n in STORED if n not in read])
    return out


ORIGIN = ["origin_function_signature", "origin_from_address", "origin_to_address"]
#: What is read of logs: by totals, by transfers and beside decoded logs.
EVENTS = ["block_number", "block_timestamp", "contract_address"]
TRANSFERS = ["block_number", "block_timestamp", "tx_hash", "tx_position", "event_index", *ORIGIN, "contract_address", "topic_0", "topic_1", "topic_2", "data", "event_removed", "tx_succeeded", "fact_event_logs_id"]
LOGGED = ["block_number", "tx_hash", "event_index", "block_timestamp", "topics", "topic_0", "topic_1", "topic_2", "topic_3", "data", "event_removed", *ORIGIN]
#: What is read of calls: by totals, creations and moves of the coin.
CALLS = ["block_number", "block_timestamp", "to_address", "input", "tx_succeeded", "trace_succeeded"]
CREATIONS = [*CALLS, "tx_hash", "from_address", "type"]
MOVES = ["block_number", "block_timestamp", "tx_hash", "tx_position", "trace_index", "trace_address", "type", "from_address", "to_address", "value", "value_precise_raw", "value_precise", *ORIGIN, "tx_succeeded", "trace_succeeded"]


def contracts(t):
    """Token data from the parts; small parts have no name, and a fifth of the sizes no decimals."""
    return t.part.select(
        address("p_partkey").alias("address"), F.col("p_brand").alias("symbol"), F.when(F.col("p_type") != "SMALL", F.col("p_name")).alias("name"),
        F.when(F.col("p_size") > 10, (F.col("p_size") % 10).cast("int")).alias("decimals"))


def prices(t):
    """Token prices for the days the token shipped with a discount over 2 %, and a coin price per order day.
    An odd divisor keeps products off the rounding ties on which engines differ."""
    shipped = t.lineitem.filter("l_discount > 0.02").select("l_partkey", F.col("l_shipdate").alias("hour")).distinct()
    token = shipped.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "hour", address("l_partkey").alias("token_address"), (F.col("p_retailprice") / 3.14159).alias("price"), (F.col("p_size") > 25).alias("is_verified"), F.lit(False).alias("is_native"))
    coin = t.orders.groupBy(F.col("o_orderdate").alias("hour")).agg((F.max("o_totalprice") / 3.14159).alias("price")).select("hour", F.lit("coin").alias("token_address"), "price", F.lit(True).alias("is_verified"), F.lit(True).alias("is_native"))
    return token.unionByName(coin)


VIEWS.update({
    "e_line": """select *, '0x' || h as tx_hash, cast('0x' || substr(h, 1, 12) as bigint) as tx_position from (select *, sha256(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || qty || '-' || cents || '-' || disc || '-' || tax || '-' || l_returnflag || '-' || l_linestatus || '-' || block_number) as h
        from (select distinct l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint) as qty, cast(round(l_extendedprice * 100) as bigint) as cents, cast(round(l_discount * 100) as bigint) as disc,
        cast(round(l_tax * 100) as bigint) as tax, l_returnflag, l_linestatus, l_shipdate as ts, date_diff('day', date '1992-01-01', cast(l_shipdate as date)) as block_number from lineitem))""",
    "e_contract": """select '0x' || lpad(lower(to_hex(p_partkey)), 40, '0') as address, p_partkey, p_brand as symbol, case when p_type <> 'SMALL' then p_name end as name, case when p_size > 10 then p_size % 10 end as decimals from part""",
    "e_price": """select distinct l_shipdate as hour, l_partkey, p_retailprice / 3.14159 as price, p_size > 25 as is_verified from lineitem join part on l_partkey = p_partkey where l_discount > 0.02""",
    "e_coin": "select o_orderdate as hour, max(o_totalprice) / 3.14159 as price from orders group by 1",
})


def addr(c):
    return f"'0x' || lpad(lower(to_hex({c})), 40, '0')"


_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S') as block_timestamp"


@query("evm_blocks", f"select block_number, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as block_timestamp, count(*) as gas_used, '0xb' || block_number as block_hash from e_line group by block_number")
def q_blocks(t):
    return blocks(t).select("block_number", "block_timestamp", "gas_used", "block_hash")


@query("evm_transactions", f"""select block_number, {_TS}, tx_hash, tx_position, {addr('l_suppkey')} as from_address, {addr('l_orderkey')} as to_address, qty / 1000.0 as value, qty || '000000000000000' as value_precise_raw,
    l_returnflag <> 'R' as tx_succeeded, 21000 + l_linenumber as gas_used, cents / 1e9 as gas_price, l_linenumber as nonce, case when l_linestatus = 'O' then '0xa9059cbb' else '0x' end as origin_function_signature,
    cents * (21000 + l_linenumber) / 1e18 as tx_fee from e_line""")
def q_transactions(t):
    read = ["block_number", "block_timestamp", "tx_hash", "tx_position", "from_address", "to_address", "value", "value_precise_raw", "tx_succeeded", "gas_used", "gas_price", "nonce", "origin_function_signature", "tx_fee"]
    return only(t, transactions=read)[0].select(*read)


@query("evm_heal_transactions", f"""select tx_hash, {_TS}, l_returnflag <> 'R' as tx_succeeded from e_line where block_number >= 2500""")
def q_heal_transactions(t):
    """The blocks arrive; waiting transactions get their time in a second run."""
    old = early_transactions(t)
    t.release("latest_transactions")
    return core.heal_transactions(old, blocks(t), receipts(t)).select("tx_hash", "block_timestamp", "tx_succeeded")


def _with_lines(t, rows: DataFrame) -> Tables:
    """The same folder, its chain made of other line items."""
    other = Tables(t.spark, t.folder)
    other._tables["lines"] = rows
    return other


#: Transactions that are worked on at a time by queries that go through them in parts.
PART = 1 << 21


def by_parts(t, step, *labels: str, lazy: bool = False) -> list[DataFrame]:
    """What `step` makes of the transactions of one part after another, for steps whose rows meet none of another
    transaction: a stored table for each label. `step` gets the folder with the lines of the part, and the condition by
    which tables of all transactions are cut the same. The disks hold the tables and shuffles of one part at a time.
    With `lazy` a single part is not stored."""
    n = -(-measures(t).count() // PART)
    if n <= 1:
        return [made if lazy else staged(made, label) for made, label in zip(step(t, F.lit(True)), labels, strict=True)]
    mine = F.pmod(F.xxhash64("tx_hash"), F.lit(n))
    if "line_parts" not in t._tables:
        t.keep("line_parts", staged(lines(t).withColumn("_part", mine).drop("tx_hash", "tx_position"), "line_parts"))
    out = [Appended(label) for label in labels]
    for k in range(n):
        rows = staged(t._tables["line_parts"].filter(F.col("_part") == k).drop("_part"), "lines_of_part")
        part = _with_lines(t, rows)
        for table, made in zip(out, step(part, mine == k), strict=True):
            table.add(made)
        part.release(*part._tables)
    return [table.table() for table in out]


def _old_lines(t) -> DataFrame:
    """Every tenth block as it was stored at first: some transactions missing, and some that the chain dropped later."""
    rows = lines(t)
    late = F.col("block_number") % 10 == 0
    dropped = rows.filter(late & F.col("disc").isin(3, 4)).withColumn("tx_hash", F.concat(F.lit("0x"), F.sha2(F.concat(F.lit("old"), "tx_hash"), 256)))
    return rows.filter(~late | (F.col("disc") != 3)).unionByName(dropped)


def replaced_tables(t) -> dict[str, DataFrame]:
    old = _with_lines(t, staged(_old_lines(t), "old_lines"))
    first = F.when(F.col("block_number") % 10 == 0, F.concat(F.lit("0xold"), F.col("block_number"))).otherwise(F.col("block_hash"))
    tables = {"transactions": transactions(old), "logs": logs(old), "traces": traces(old), "blocks": blocks(old).withColumn("block_hash", first)}
    paths = {name: scratch_path(t.spark, f"stored_{name}") for name in tables}
    for name, df in tables.items():
        replaced.store(df, paths[name], 100)
    now = t.view("raw_blocks", lambda: raw_blocks(t)).select("block_number", F.get_json_object("data", "$.result.hash").alias("block_hash"))
    changed = staged(replaced.replaced_blocks(replaced.stored(t.spark, paths["blocks"]), now), "replaced")
    new = _with_lines(t, staged(lines(t).join(changed, "block_number", "left_semi"), "new_lines"))
    replaced.replace(t.spark, paths, changed, {"transactions": transactions(new), "logs": logs(new), "traces": traces(new), "blocks": blocks(new)}, 100)
    return {name: replaced.stored(t.spark, path) for name, path in paths.items()}


VIEWS["e_log"] = f"""select *, 0 as event_index, {addr('l_partkey')} as contract_address from e_line union all select *, 1, case when l_linestatus = 'O' then {addr('l_suppkey')} else {addr('l_orderkey')} end from e_line"""


@query("evm_event_logs", f"""select block_number, {_TS}, tx_hash, tx_position, event_index, contract_address, l_returnflag <> 'R' as tx_succeeded, {addr('l_suppkey')} as origin_from_address,
    case when event_index = 0 or l_linestatus = 'O' then '{V.TRANSFER}' else '{V.TRANSFER_BATCH}' end as topic_0, md5(tx_hash || '-' || event_index) as fact_event_logs_id from e_log""")
def q_logs(t):
    read = ["block_number", "block_timestamp", "tx_hash", "tx_position", "event_index", "contract_address", "tx_succeeded", "origin_from_address", "topic_0", "fact_event_logs_id"]
    return only(t, logs=read)[0].select(*read)


@query("evm_heal_event_logs", f"select tx_hash, event_index, {_TS} from e_log where block_number >= 2500")
def q_heal_logs(t):
    t.read = {"early_transactions": set(FOR_LOGS), "transactions": set(FOR_LOGS)}
    early, txs = early_transactions(t), transactions(t)
    old = t.table("early_logs", lambda: core.fact_event_logs(receipts(t), early).select("block_number", "tx_hash", "event_index", "block_timestamp", "origin_function_signature"))
    t.release("receipts", "early_transactions", "blocks")
    return core.heal_event_logs(old, txs).select("tx_hash", "event_index", "block_timestamp")


VIEWS["e_trace"] = f"""select tx_hash, block_number, ts, l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey, tax, 'ORIGIN' as trace_address, 0 as trace_index, 1 as sub_traces, 'CALL' as type, {addr('l_suppkey')} as from_address, {addr('l_orderkey')} as to_address, qty / 1000.0 as value, l_returnflag <> 'R' as trace_succeeded from e_line
    union all select tx_hash, block_number, ts, l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey, tax, '0', 1, 1, 'DELEGATECALL', {addr('l_orderkey')}, {addr('l_partkey')}, disc / 1e18, l_returnflag <> 'R' and tax <> 0 from e_line
    union all select tx_hash, block_number, ts, l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey, tax, '0_0', 2, 0, 'CREATE', {addr('l_orderkey')}, {addr('(l_orderkey * 10 + l_linenumber)')}, 0.0, l_returnflag <> 'R' and tax <> 0 from e_line"""


@query("evm_traces", f"""select block_number, {_TS}, tx_hash, trace_address, trace_index, sub_traces, type, from_address, to_address, value, trace_succeeded, type || '_' || trace_address as identifier, l_returnflag <> 'R' as tx_succeeded from e_trace""")
def q_traces(t):
    read = ["block_number", "block_timestamp", "tx_hash", "trace_address", "trace_index", "sub_traces", "type", "from_address", "to_address", "value", "trace_succeeded", "identifier", "tx_succeeded"]
    out = only(t, traces=read)[0].select(*read)
    return out.withColumn("trace_index", F.col("trace_index").cast("bigint")).withColumn("sub_traces", F.col("sub_traces").cast("bigint"))


@query("evm_replaced_blocks", """select 'transactions' as kind, block_number, count(*) as n, min(tx_hash) as first, max(tx_hash) as last from e_line group by 2 union all select 'logs', block_number, count(*), min(tx_hash || event_index), max(tx_hash || event_index) from e_log group by 2
    union all select 'traces', block_number, count(*), min(tx_hash || trace_index), max(tx_hash || trace_index) from e_trace group by 2 union all select 'blocks', block_number, 1, '0xb' || block_number, '0xb' || block_number from (select distinct block_number from e_line)""")
def q_replaced(t):
    """Tables stored before a tenth of the blocks was replaced, after the replacement."""
    ids = {"transactions": F.col("tx_hash"), "logs": F.concat("tx_hash", F.col("event_index").cast("string")), "traces": F.concat("tx_hash", F.col("trace_index").cast("string")), "blocks": F.col("block_hash")}
    parts = [df.groupBy(F.lit(name).alias("kind"), "block_number").agg(F.count(F.lit(1)).alias("n"), F.min(ids[name]).alias("first"), F.max(ids[name]).alias("last")) for name, df in replaced_tables(t).items()]
    return union_all(parts)


@query("evm_created_contracts", """select to_address as created_contract_address, arg_max(tx_hash, (ts, block_number, tx_hash)) as tx_hash, arg_max(from_address, (ts, block_number, tx_hash)) as creator_address from e_trace where type = 'CREATE' and trace_succeeded group by 1""")
def q_created(t):
    return core.created_contracts(*only(t, traces=CREATIONS)).select("created_contract_address", "tx_hash", "creator_address")


@query("evm_heal_traces", f"select tx_hash, cast(trace_index as bigint) as trace_index, {_TS}, l_returnflag <> 'R' as tx_succeeded from e_trace where block_number >= 2500")
def q_heal_traces(t):
    """Calls stored while the blocks from number 2500 on were missing."""
    early, txs = early_transactions(t), transactions(t)
    t.release("receipts", "blocks")
    nodes = core.traces(t.view("raw_traces", lambda: raw_traces(t)))
    stored = t.table("early_traces", lambda: core.fact_traces(nodes, early))
    discard(nodes, early)
    return core.heal_traces(stored, txs).select("tx_hash", F.col("trace_index").cast("bigint").alias("trace_index"), "block_timestamp", "tx_succeeded")


@query("evm_heal_native_transfers", """select tx_hash, cast(trace_index as bigint) as trace_index, round(value * c.price, 2) as amount_usd from e_trace x join e_coin c on c.hour = x.ts
    where value > 0 and trace_succeeded and l_returnflag <> 'R' and type <> 'DELEGATECALL'""")
def q_heal_native(t):
    """Moves stored before any price was known."""
    stored = core.native_transfers(*only(t, traces=MOVES), prices(t).filter(F.lit(False)))
    out = core.heal_native_transfers(stored, prices(t))
    return out.select("tx_hash", F.col("trace_index").cast("bigint").alias("trace_index"), F.round("amount_usd", 2).alias("amount_usd"))


def reads(t) -> DataFrame:
    """Answers to the token calls for contracts that the first three lines of an order made."""
    made = lines(t).filter("l_linenumber <= 3").select("l_orderkey", "l_linenumber", "ts").dropDuplicates(["l_orderkey", "l_linenumber"])

    def text(c):
        return F.concat(F.lit("0x" + "0" * 128), F.hex(c))

    answers = [(V.READ_NAME, text(F.concat(F.lit("Token "), F.col("l_orderkey")))), (V.READ_SYMBOL, text(F.concat(F.lit("T"), F.col("l_orderkey")))), (V.READ_DECIMALS, topic("l_linenumber"))]
    each = F.explode(F.array(*[F.struct(F.lit(sig).alias("sig"), out.alias("out")) for sig, out in answers]))
    rows = made.select(address(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("contract_address"), "ts", each.alias("r"))
    return rows.select("contract_address", F.col("r.sig").alias("function_sig"), F.col("r.out").alias("read_result"), F.col("ts").alias("_inserted_timestamp"))


@query("evm_dim_contracts", """select to_address as address, case when l_linenumber <= 3 then 'T' || l_orderkey end as symbol, case when l_linenumber <= 3 then 'Token ' || l_orderkey end as name, case when l_linenumber <= 3 then cast(l_linenumber as int) end as decimals,
    arg_max(tx_hash, (ts, block_number, tx_hash)) as created_tx_hash, arg_max(from_address, (ts, block_number, tx_hash)) as creator_address from e_trace where type = 'CREATE' and trace_succeeded group by to_address, l_orderkey, l_linenumber""")
def q_dim_contracts(t):
    out = core.dim_contracts(core.created_contracts(*only(t, traces=CREATIONS)), core.contract_reads(reads(t)))
    return out.select("address", "symbol", "name", "decimals", "created_tx_hash", "creator_address")


@query("evm_relevant_contracts", f"""with e as (select contract_address, count(*) as n, max(block_number) as b from e_log group by 1), c as (select to_address as contract_address, count(*) as n, max(block_number) as b from e_trace where trace_succeeded and type <> 'CALL' group by 1)
    select coalesce(e.contract_address, c.contract_address) as contract_address, coalesce(e.n, 0) as total_event_count, coalesce(c.n, 0) as total_call_count, coalesce(e.n, 0) + coalesce(c.n, 0) as total_interaction_count,
    coalesce(e.b, 0) as latest_event_block, coalesce(c.b, 0) as latest_call_block from e full join c on e.contract_address = c.contract_address""")
def q_relevant(t):
    out = core.relevant_contracts(*only(t, logs=EVENTS, traces=CALLS), stamp="block_timestamp")
    return out.select("contract_address", "total_event_count", "total_call_count", "total_interaction_count", "latest_event_block", "latest_call_block")


@query("evm_relevant_contracts_in_two_runs", f"""with e as (select contract_address, count(*) as n from e_log group by 1), c as (select to_address as contract_address, count(*) as n from e_trace where trace_succeeded and type <> 'CALL' group by 1)
    select coalesce(e.contract_address, c.contract_address) as contract_address, coalesce(e.n, 0) as total_event_count, coalesce(c.n, 0) as total_call_count from e full join c on e.contract_address = c.contract_address
    where coalesce(e.contract_address, c.contract_address) in (select contract_address from e_log where ts >= timestamp '2001-01-01' union select to_address from e_trace where trace_succeeded and type <> 'CALL' and ts >= timestamp '2001-01-01')""")
def q_relevant_two(t):
    """Totals stored up to 2000, then the rows since: contracts active since carry the sum of both."""
    old = F.col("block_timestamp") < F.lit(datetime(2001, 1, 1))
    all_logs, all_traces = only(t, logs=EVENTS, traces=CALLS)
    stored = core.relevant_contracts(all_logs.filter(old), all_traces.filter(old), stamp="block_timestamp")
    out = core.relevant_contracts(all_logs, all_traces, stored, stamp="block_timestamp")
    return out.select("contract_address", "total_event_count", "total_call_count")


_SHIFT = "case when decimals is not null then qty * 1000.0 / power(10, decimals) end"


@query("evm_token_transfers", f"""select x.tx_hash, {addr('l_suppkey')} as from_address, {addr('l_orderkey')} as to_address, x.contract_address, cast(qty * 1000 as varchar) as raw_amount_precise, {_SHIFT} as amount,
    round({_SHIFT} * p.price, 2) as amount_usd, symbol, name, coalesce(p.is_verified, false) as token_is_verified from e_log x left join e_contract c on c.address = x.contract_address and (decimals is not null or symbol is not null or name is not null)
    left join e_price p on p.l_partkey = x.l_partkey and p.hour = x.ts where event_index = 0 and l_returnflag <> 'R'""")
def q_token_transfers(t):
    return core.token_transfers(*only(t, logs=TRANSFERS), contracts(t), prices(t)).select("tx_hash", "from_address", "to_address", "contract_address", "raw_amount_precise", "amount", "amount_usd", "symbol", "name", "token_is_verified")


@query("evm_heal_token_transfers", f"""select x.tx_hash, round(qty * 1000.0 / power(10, decimals) * p.price, 2) as amount_usd from e_log x join e_contract c on c.address = x.contract_address join e_price p on p.l_partkey = x.l_partkey and p.hour = x.ts
    where event_index = 0 and l_returnflag <> 'R' and decimals is not null and symbol like 'Brand#1%'""")
def q_heal_token_transfers(t):
    """Stored without any price; prices arrive for some brands' tokens."""
    stored = core.token_transfers(*only(t, logs=TRANSFERS), contracts(t), prices(t).filter(F.lit(False)))
    brands = contracts(t).filter(F.col("symbol").like("Brand#1%")).select(F.col("address").alias("token_address"))
    arrived = prices(t).join(brands, "token_address", "left_semi")
    return core.heal_token_transfers(stored, contracts(t), arrived).select("tx_hash", "amount_usd")


@query("evm_native_transfers", """select tx_hash, cast(trace_index as bigint) as trace_index, value as amount, round(value * c.price, 2) as amount_usd, from_address, to_address from e_trace x left join e_coin c on c.hour = x.ts
    where value > 0 and trace_succeeded and l_returnflag <> 'R' and type <> 'DELEGATECALL'""")
def q_native(t):
    out = core.native_transfers(*only(t, traces=MOVES), prices(t)).select("tx_hash", F.col("trace_index").cast("bigint").alias("trace_index"), "amount", "amount_usd", "from_address", "to_address")
    return out


@query("evm_nft_transfers", f"""select tx_hash, 1 as intra_event_index, {addr('l_orderkey')} as from_address, {addr('l_suppkey')} as to_address, cast(l_partkey as varchar) as token_id, '1' as quantity, 'erc721' as token_standard from e_line where l_returnflag <> 'R' and l_linestatus = 'O'
    union all select tx_hash, i, {addr('l_suppkey')}, {addr('l_orderkey')}, cast(case i when 1 then l_partkey else l_suppkey end as varchar), cast(case i when 1 then l_linenumber else qty end as varchar), 'erc1155' from e_line, (values (1), (2)) v(i) where l_returnflag <> 'R' and l_linestatus <> 'O'""")
def q_nft(t):
    return core.nft_transfers(*only(t, logs=[*TRANSFERS, "topic_3"]), contracts(t)).select("tx_hash", "intra_event_index", "from_address", "to_address", "token_id", "quantity", "token_standard")


def decoded(t) -> DataFrame:
    """Decoded form of the token transfers, as a decoder would land them; the amount has no name."""
    params = F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in (("from", address("l_suppkey")), ("to", address("l_orderkey")), ("", F.col("qty").cast("string")))])
    body = F.struct(F.lit("Transfer").alias("name"), address("l_partkey").alias("address"), params.alias("data"))
    return lines(t).select("block_number", F.concat("tx_hash", F.lit("-0")).alias("id"), F.to_json(body).alias("data"), F.col("ts").alias("_inserted_timestamp"))


@query("evm_decoded_logs", f"select block_number, tx_hash, 0::bigint as event_index, 'Transfer' as event_name, {addr('l_partkey')} as contract_address, 'anonymous_2=' || qty || ',from=' || {addr('l_suppkey')} || ',to=' || {addr('l_orderkey')} as decoded_flat from e_line")
def q_decoded(t):
    return core.decoded_logs(decoded(t)).select("block_number", "tx_hash", "event_index", "event_name", "contract_address", "decoded_flat")


@query("evm_ez_decoded_event_logs", f"select block_number, {_TS}, tx_hash, 'Transfer' as event_name, name as contract_name, l_returnflag <> 'R' as tx_succeeded, {addr('l_suppkey')} as origin_from_address from e_line left join e_contract c on c.p_partkey = l_partkey")
def q_ez_decoded(t):
    out = core.ez_decoded_event_logs(core.decoded_logs(decoded(t)), *only(t, logs=LOGGED, transactions=["block_number", "tx_hash", "tx_position", "tx_succeeded"]), contracts(t))
    return out.select("block_number", "block_timestamp", "tx_hash", "event_name", "contract_name", "tx_succeeded", "origin_from_address")


# --- worklists over the same blocks -----------------------------------------------------------------


def _head(t) -> int:
    """The newest block that any payload names."""
    return lines(t).agg(F.max("block_number")).first()[0] or 0


@query("worklist_blocks", "select b as block_number, (b + 500) // 1000 * 1000 as partition_key from (select unnest(range(1, (select max(block_number) from e_line) + 1)) as b) where b not in (select block_number from e_line)")
def q_blocks_to_fetch(t):
    return wl.blocks_to_fetch(wl.expected_blocks(t.spark, _head(t)), wl.fetched(raw_blocks(t), "id"))


@query("worklist_pages", """with c as (select l_orderkey as block_number, count(*) as n from lineitem group by 1) select block_number, (block_number + 500) // 1000 * 1000 as partition_key, cast(page_number as int) as page_number
    from (select block_number, unnest(range(1, cast(ceil(n / 3.0) as bigint) + 1)) as page_number from c) where page_number > 1""")
def q_pages_to_fetch(t):
    """Orders as blocks, three lines to a page; first pages have landed."""
    counts = t.lineitem.groupBy(F.col("l_orderkey").alias("block_number")).agg(F.count(F.lit(1)).alias("tx_count"))
    done = counts.select("block_number", F.lit(1).alias("page_number"))
    return wl.pages_to_fetch(counts, done, size=3)


@query("worklist_max_block_by_date", "select strftime(d, '%Y-%m-%d') as block_date, n as block_number from (select cast(o_orderdate as date) as d, max(o_orderkey) as n from orders group by 1) where d <> (select max(cast(o_orderdate as date)) from orders)")
def q_max_by_date(t):
    return wl.max_block_by_date(t.orders.select(F.col("o_orderdate").alias("block_timestamp"), F.col("o_orderkey").alias("block_number")))


@query("worklist_evm_addresses", f"select {addr('l_suppkey')} as evm_address, min(block_number) as block_id_associated, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as block_timestamp_associated from e_line group by l_suppkey")
def q_evm_addresses(t):
    return wl.evm_addresses(*only(t, transactions=["block_number", "block_timestamp", "from_address"])).select("evm_address", "block_id_associated", "block_timestamp_associated")


@query("worklist_missing_traces", "select distinct block_number from e_line where l_returnflag = 'A' and tax = 8")
def q_missing_traces(t):
    """Calls of some lines were never stored."""
    tx = lines(t)
    have = tx.filter("not (l_returnflag = 'A' and tax = 8)").select("block_number", "tx_hash")
    return wl.missing_traces(tx, have, 0)


@query("worklist_unconfirmed_blocks", "select distinct block_number from e_line where l_returnflag = 'N' and disc = 7 and block_number >= 1500")
def q_unconfirmed(t):
    tx = lines(t)
    return wl.unconfirmed_blocks(tx.select("block_number", "tx_hash"), tx.filter("not (l_returnflag = 'N' and disc = 7)"), 1500)


@query("worklist_backlog", "select b as block_number, (b + 500) // 1000 * 1000 as partition_key from (select unnest(range(1000, (select max(block_number) from e_line) + 1)) as b) where b not in (select block_number from e_line where l_returnflag = 'A') or b in (select block_number from e_line where tax = 8 and disc = 9)")
def q_backlog(t):
    """Expected blocks whose receipts are missing, and blocks to retry."""
    rows = lines(t)
    retry = rows.filter("tax = 8 and disc = 9").select("block_number").filter("block_number >= 1000")
    return wl.evm_backlog(wl.expected_blocks(t.spark, _head(t)), rows.filter("l_returnflag = 'A'").select("block_number").distinct(), [retry], low=1000, cap=1_000_000)


@query("worklist_range_calls", """with m as (select distinct l_orderkey as b, from lineitem where l_returnflag = 'R'), r as (select b, (row_number() over (order by b) - 1) // 20 as range_no from m)
    select range_no // 100 as call_no, range_no, min(b) as min_block, max(b) as max_block, string_agg(cast(b as varchar), ',' order by b) as blocks from r group by 1, 2""".replace("as b, from", "as b from"))
def q_range_calls(t):
    return wl.range_calls(t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("block_id")))


@query("worklist_contracts_to_read", """with e as (select contract_address, count(*) as n, max(block_number) as b from e_log group by 1), top as (select * from e where n >= 25 order by n desc, contract_address limit 200)
    select contract_address, b as latest_block, sig as function_sig from top, (values ('0x313ce567'), ('0x06fdde03'), ('0x95d89b41')) v(sig)""")
def q_contracts_to_read(t):
    relevant = core.relevant_contracts(*only(t, logs=EVENTS, traces=CALLS), stamp="block_timestamp")
    return wl.contracts_to_read(relevant).select("contract_address", "latest_block", "function_sig")


def event_abis(t) -> DataFrame:
    """Interface versions per token: one from block 0, brands over ten a second one from block 2000."""
    first = t.part.select(address("p_partkey").alias("parent_contract_address"), F.lit(0).cast("bigint").alias("start_block"), F.when(F.length("p_brand") > 7, 1999).otherwise(10**18).cast("bigint").alias("end_block"), F.lit("v1").alias("abi"))
    second = t.part.filter("length(p_brand) > 7").select(address("p_partkey").alias("parent_contract_address"), F.lit(2000).cast("bigint").alias("start_block"), F.lit(10**18).alias("end_block"), F.lit("v2").alias("abi"))
    return first.unionByName(second).withColumn("event_signature", F.lit(V.TRANSFER))


@query("worklist_logs_to_decode", """select x.block_number, tx_hash || '-' || event_index as _log_id, case when length(p_brand) > 7 and x.block_number >= 2000 then 'v2' else 'v1' end as abi from e_log x join part p on x.contract_address = '0x' || lpad(lower(to_hex(p_partkey)), 40, '0')
    where (event_index = 0 or l_linestatus = 'O') and l_returnflag <> 'R' and not (event_index = 0 and disc = 5)""")
def q_logs_to_decode(t):
    """Transfers with an interface version valid at their block; some are decoded already."""
    done = lines(t).filter("disc = 5").select("block_number", F.concat("tx_hash", F.lit("-0")).alias("_log_id"))
    return wl.logs_to_decode(*only(t, logs=["block_number", "block_timestamp", "tx_hash", "event_index", "contract_address", "topics", "topic_0", "data", "tx_succeeded"]), event_abis(t), done, width=500).select("block_number", "_log_id", "abi")
