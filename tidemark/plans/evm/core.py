"""Blocks, transactions, receipts, logs, call traces and transfers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ...functions.common import greatest_strict, newest
from ...functions.hexwords import decimal_adjust, hex_to_number, hex_to_text, hex_to_text_number, hex_words, topic_address, word
from ...operators import increments as inc
from ...operators.aggregates import merge_totals
from ...operators.joins import inside_flagged_payload
from ...operators.rows import flatten, flatten_tree, once
from ...operators.sets import union_all
from ...operators.windows import dedup_latest
from ...session import staged
from ..audit import keyed
from . import values as V

STAMP = "_inserted_timestamp"
GWEI = 9
COIN = 18


def last_desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def hex_long(c) -> Column:
    return hex_to_number(c).cast("bigint")


def scaled(c: Column, digits: int) -> Column:
    return c.cast("double") / F.pow(F.lit(10.0), F.lit(digits))


def _variant(df: DataFrame, col: str) -> DataFrame:
    return once(df.withColumn("_v", F.try_parse_json(F.col(col))), "_v")


def _text(path: str) -> Column:
    return F.try_variant_get("_v", f"$.{path}", "string")


def _json(path: str) -> Column:
    return F.to_json(F.try_variant_get("_v", f"$.{path}", "variant"))


# --- latest payloads --------------------------------------------------------------------------------


def latest_blocks(raw: DataFrame) -> DataFrame:
    """Newest payload per block; both landing shapes (with and without `result`)."""
    rows = _variant(raw.filter(F.col("data").isNotNull()), "data")
    body = F.coalesce(F.try_variant_get("_v", "$.result", "variant"), F.col("_v"))
    rows = rows.select("block_number", "partition_key", F.to_json(body).alias("block_json"), STAMP)
    return keyed(dedup_latest(rows, ["block_number"], [newest(STAMP), newest("block_json")]), "blocks_id", "block_number")


def latest_transactions(raw: DataFrame) -> DataFrame:
    """Newest payload per (block, position)."""
    index = F.try_variant_get(F.try_parse_json("value"), "$.data.transactionIndex", "string")
    rows = raw.filter(F.col("data").isNotNull()).select("block_number", "partition_key", hex_long(index).alias("tx_position"), F.col("data").alias("transaction_json"), STAMP)
    rows = once(rows, "tx_position").filter(F.col("tx_position").isNotNull())
    return keyed(dedup_latest(rows, ["block_number", "tx_position"], [newest(STAMP), newest("transaction_json")]), "transactions_id", "block_number", "tx_position")


def latest_receipts(raw: DataFrame) -> DataFrame:
    """Receipts that are the newest of their position and in the newest block of their hash, both judged
    over all rows."""
    rows = _variant(raw.filter(F.col("data").isNotNull()), "data").select(
        "block_number", _text("transactionHash").alias("tx_hash"), "partition_key", hex_long(_text("transactionIndex")).alias("tx_position"), F.col("data").alias("receipts_json"), STAMP)
    by_place = dedup_latest(rows, ["block_number", "tx_position"], [newest(STAMP), newest("receipts_json")])
    # the hash test compares blocks only, and only hashes of several blocks can fail it: they are counted without the
    # payloads, and those few are stored, so that payloads need not lie by hash
    top = rows.groupBy("tx_hash").agg(F.max("block_number").alias("_top"), F.min("block_number").alias("_low"))
    several = staged(top.filter("_low < _top").select(F.col("tx_hash").alias("_hash"), "_top"), "moved_receipts")
    placed = by_place.filter(F.col("tx_hash").isNotNull() & F.col("block_number").isNotNull())
    kept = placed.join(several, F.col("tx_hash") == F.col("_hash"), "left").filter("_top is null or block_number = _top").drop("_hash", "_top")
    return keyed(kept, "receipts_id", "block_number", "tx_position")


def confirmed_blocks(raw: DataFrame) -> DataFrame:
    """Transactions of the newest confirmation per block; newest block per transaction."""
    rows = _variant(raw, "data").select(
        F.try_variant_get(F.try_parse_json("value"), "$.BLOCK_NUMBER", "bigint").alias("block_number"), _text("result.hash").alias("block_hash"),
        F.try_variant_get("_v", "$.result.transactions", "array<string>").alias("_txs"), STAMP)
    latest = dedup_latest(rows, ["block_number"], [newest(STAMP), newest("block_hash")])
    each = flatten(latest, "_txs", "_i", "tx_hash").select("block_number", "block_hash", "tx_hash", STAMP)
    return keyed(dedup_latest(each, ["tx_hash"], [newest("block_number")]), "confirmed_blocks_id", "tx_hash")


# --- typed facts --------------------------------------------------------------------------------------


def fact_blocks(latest: DataFrame) -> DataFrame:
    rows = _variant(latest, "block_json")
    num = {"size": "size", "gas_used": "gasUsed", "gas_limit": "gasLimit", "base_fee_per_gas": "baseFeePerGas", "nonce": "nonce"}
    text = {"miner": "miner", "mix_hash": "mixHash", "extra_data": "extraData", "parent_hash": "parentHash", "sha3_uncles": "sha3Uncles", "receipts_root": "receiptsRoot",
            "state_root": "stateRoot", "transactions_root": "transactionsRoot", "logs_bloom": "logsBloom"}
    when = F.timestamp_seconds(hex_long(_text("timestamp"))).cast("timestamp_ntz")
    out = rows.select(
        "block_number", _text("hash").alias("block_hash"), when.alias("block_timestamp"), F.lit(V.NETWORK).alias("network"),
        F.size(F.try_variant_get("_v", "$.transactions", "array<variant>")).alias("tx_count"), *[hex_long(_text(p)).alias(n) for n, p in num.items()],
        hex_to_number(_text("difficulty")).alias("difficulty"), hex_to_number(_text("totalDifficulty")).alias("total_difficulty"),
        *[_text(p).alias(n) for n, p in text.items()], _json("uncles").alias("uncle_blocks"))
    return keyed(out, "fact_blocks_id", "block_number")


def _receipt_fields(receipts: DataFrame) -> DataFrame:
    status = _text("status")
    return _variant(receipts, "receipts_json").select(
        "block_number", "tx_hash", hex_long(_text("gasUsed")).alias("gas_used"), hex_long(_text("cumulativeGasUsed")).alias("cumulative_gas_used"),
        scaled(hex_long(_text("effectiveGasPrice")), GWEI).alias("effective_gas_price"),
        F.when(status == "0x1", F.lit(True)).when(status == "0x0", F.lit(False)).alias("tx_succeeded"), hex_long(_text("type")).alias("tx_type"))


def _with_outcome(txs: DataFrame, blocks: DataFrame, receipts: DataFrame) -> DataFrame:
    """Block time, and receipt columns with the fee = price × gas used, exact as text."""
    times = blocks.select("block_number", "block_timestamp")
    r = _receipt_fields(receipts).withColumnsRenamed({"block_number": "_block", "tx_hash": "_hash"})
    # the block is only tested, so that rows lie by hash, as the deduplication wants them
    on = (F.col("tx_hash") == F.col("_hash")) & (F.col("block_number") - F.col("_block") == 0)
    rows = txs.join(times, "block_number", "left").join(r, on, "left").drop("_block", "_hash")
    fee = F.try_multiply(F.col("_gas_price_wei"), F.col("gas_used").cast("decimal(38,0)")).cast("decimal(38,0)")
    exact = decimal_adjust(fee, F.lit(COIN))
    return rows.withColumn("tx_fee_precise", F.coalesce(exact, F.lit("0"))).withColumn("tx_fee", F.coalesce(exact.cast("double"), F.lit(0.0)))


TX_COLUMNS = ["block_number", "block_timestamp", "tx_hash", "from_address", "to_address", "origin_function_signature", "value", "value_precise_raw", "value_precise", "tx_fee", "tx_fee_precise",
              "tx_succeeded", "tx_type", "nonce", "tx_position", "input_data", "gas_price", "effective_gas_price", "gas_used", "gas_limit", "cumulative_gas_used", "max_fee_per_gas",
              "max_priority_fee_per_gas", "access_list", "y_parity", "r", "s", "v"]


def fact_transactions(latest: DataFrame, blocks: DataFrame, receipts: DataFrame) -> DataFrame:
    """Typed transactions with block time, receipt outcome and fee; newest block per hash."""
    rows = _variant(latest, "transaction_json").select(
        "block_number", "tx_position", _text("hash").alias("tx_hash"), _text("from").alias("from_address"), F.nullif(_text("to"), F.lit("")).alias("to_address"),
        F.left(_text("input"), F.lit(10)).alias("origin_function_signature"), hex_to_text_number(_text("value")).alias("value_precise_raw"), hex_long(_text("gas")).alias("gas_limit"),
        hex_to_number(_text("gasPrice")).alias("_gas_price_wei"), _text("input").alias("input_data"), hex_long(_text("nonce")).alias("nonce"), _text("r").alias("r"), _text("s").alias("s"),
        hex_long(_text("v")).alias("v"), scaled(hex_to_number(_text("maxFeePerGas")), GWEI).alias("max_fee_per_gas"),
        scaled(hex_to_number(_text("maxPriorityFeePerGas")), GWEI).alias("max_priority_fee_per_gas"), hex_long(_text("yParity")).alias("y_parity"), _json("accessList").alias("access_list"))
    rows = rows.withColumn("value_precise", decimal_adjust("value_precise_raw", F.lit(COIN))).withColumn("gas_price", scaled(F.col("_gas_price_wei"), GWEI))
    rows = _with_outcome(rows.withColumn("value", F.col("value_precise").cast("double")), blocks, receipts).select(*TX_COLUMNS)
    best = dedup_latest(rows, ["tx_hash"], [newest("block_number"), last_desc("block_timestamp"), last_desc("tx_succeeded")])
    return keyed(best, "fact_transactions_id", "tx_hash")


def heal_transactions(stored: DataFrame, blocks: DataFrame, receipts: DataFrame) -> DataFrame:
    """Stored transactions without time or outcome for which a block or receipt has arrived."""
    healed = ["block_timestamp", "gas_used", "cumulative_gas_used", "effective_gas_price", "tx_succeeded", "tx_type", "tx_fee", "tx_fee_precise"]
    needy = stored.filter("block_timestamp is null or tx_succeeded is null")
    wei = F.round(F.col("gas_price") * 10**GWEI).cast("decimal(38,0)")
    old = needy.withColumn("_had_time", F.col("block_timestamp").isNotNull()).withColumn("_had_outcome", F.col("tx_succeeded").isNotNull())
    fresh = _with_outcome(old.drop(*healed).withColumn("_gas_price_wei", wei), blocks, receipts)
    better = (~F.col("_had_time") & F.col("block_timestamp").isNotNull()) | (~F.col("_had_outcome") & F.col("tx_succeeded").isNotNull())
    return fresh.filter(better).select(*stored.columns)


LOG_SCHEMA = "array<struct<address:string,data:string,logIndex:string,removed:boolean,topics:array<string>,transactionIndex:string>>"
LOG_COLUMNS = ["block_number", "block_timestamp", "tx_hash", "tx_position", "event_index", "contract_address", "topics", "topic_0", "topic_1", "topic_2", "topic_3", "data", "event_removed",
               "origin_from_address", "origin_to_address", "origin_function_signature", "tx_succeeded"]


def fact_event_logs(receipts: DataFrame, txs: DataFrame) -> DataFrame:
    """One row per log of a receipt with its transaction's time, position and function."""
    schema = f"struct<from:string,to:string,status:string,logs:{LOG_SCHEMA}>"
    status = F.col("_r.status")
    base = receipts.select("block_number", "tx_hash", F.from_json("receipts_json", schema).alias("_r")).filter(F.size("_r.logs") > 0)
    each = base.select(
        "block_number", "tx_hash", F.col("_r.from").alias("origin_from_address"), F.col("_r.to").alias("origin_to_address"),
        F.when(status == "0x1", F.lit(True)).when(status == "0x0", F.lit(False)).alias("tx_succeeded"), F.explode("_r.logs").alias("_l"))
    logs = each.select(
        "block_number", "tx_hash", "origin_from_address", "origin_to_address", "tx_succeeded", F.col("_l.address").alias("contract_address"), F.col("_l.data").alias("data"),
        hex_long("_l.logIndex").alias("event_index"), F.col("_l.removed").alias("event_removed"), F.col("_l.topics").alias("topics"), hex_long("_l.transactionIndex").alias("_index"))
    t = txs.select(F.col("block_number").alias("_block"), F.col("tx_hash").alias("_hash"), "block_timestamp", F.col("tx_position").alias("_pos"), "origin_function_signature")
    # the block is only tested, so that rows lie by hash, as the deduplication wants them
    on = (F.col("tx_hash") == F.col("_hash")) & (F.col("block_number") - F.col("_block") == 0)
    rows = logs.join(t, on, "left").withColumn("tx_position", F.coalesce("_pos", "_index"))
    best = dedup_latest(rows, ["tx_hash", "event_index"], [newest("block_number"), last_desc("block_timestamp"), last_desc("origin_function_signature")])
    best = best.withColumns({f"topic_{i}": F.get("topics", F.lit(i)) for i in range(4)}).select(*LOG_COLUMNS)
    return keyed(best, "fact_event_logs_id", "tx_hash", "event_index")


def heal_event_logs(stored: DataFrame, txs: DataFrame) -> DataFrame:
    """Stored logs without time or function whose transaction is there now."""
    fill = {"block_timestamp": "block_timestamp", "origin_function_signature": "origin_function_signature"}
    return inc.heal_nulls(stored, txs, ["block_number", "tx_hash"], fill)


# --- traces -------------------------------------------------------------------------------------------


def traces(raw: DataFrame) -> DataFrame:
    """Call-tree payloads to one row per call with path and parent, newest arrival per transaction.

    The deduplicated payloads are written first, since descending the tree may take several rounds.
    """
    rows = _variant(raw, "data").select("block_number", "partition_key", F.try_variant_get(F.try_parse_json("value"), "$.array_index", "bigint").alias("tx_position"),
                                        _text("txHash").alias("tx_hash"), _json("result").alias("_tree"), STAMP)
    rows = once(rows, "_tree").filter(F.col("_tree").isNotNull())
    latest = staged(dedup_latest(rows, ["block_number", "tx_position", "tx_hash"], [newest(STAMP), newest("_tree")]), "traces")
    # trees, not their nodes, are sent to their transaction, where all further steps find them
    nodes = flatten_tree(latest.repartition("block_number", "tx_hash"), "_tree", "calls", {}, node="trace_json").withColumnRenamed("parent_address", "parent_trace_address")
    best = dedup_latest(nodes, ["block_number", "tx_hash", "trace_address"], [newest(STAMP), newest("tx_position")])
    out = best.withColumn("trace_address_array", F.split("trace_address", "_")).drop("tx_position")
    return keyed(out, "traces_id", "block_number", "tx_hash", "trace_address")


def order_traces(nodes: DataFrame) -> DataFrame:
    """Depth-first position and number of direct children. A transaction's calls come out of one payload
    row, so its group fits a task; both steps share the partitioning by transaction. For the count each node is
    also shown, without its columns, to its parent, so that no call meets its parent by a join."""
    path = F.transform(F.split("trace_address", "_"), lambda p: F.when(p == "ORIGIN", F.lit(-1)).otherwise(p.cast("int")))
    key = ["block_number", "tx_hash"]
    tx = Window.partitionBy(*key).orderBy("_path")
    placed = nodes.withColumn("_path", path).withColumn("trace_index", F.row_number().over(tx) - 1).drop("_path")
    rest = [c for c in placed.columns if c not in key]
    own = F.struct(F.col("trace_address").alias("at"), F.struct(*rest).alias("node"))
    child = F.struct(F.col("parent_trace_address").alias("at"), F.lit(None).cast(placed.select(F.struct(*rest).alias("n")).schema["n"].dataType).alias("node"))
    each = placed.select(*key, F.inline(F.array(own, child))).filter(F.col("at").isNotNull() | F.col("node").isNotNull())
    counted = each.withColumn("sub_traces", F.count_if(F.col("node").isNull()).over(Window.partitionBy(*key, "at")))
    return counted.filter(F.col("node").isNotNull()).select(*key, "node.*", "sub_traces")


TRACE_COLUMNS = ["block_number", "block_timestamp", "tx_hash", "tx_position", "trace_index", "from_address", "to_address", "input", "output", "type", "trace_address", "sub_traces", "value",
                 "value_precise_raw", "value_precise", "value_hex", "gas", "gas_used", "origin_from_address", "origin_to_address", "origin_function_signature", "trace_succeeded", "error_reason",
                 "revert_reason", "tx_succeeded", "identifier", "data", "trace_status"]


def fact_traces(nodes: DataFrame, txs: DataFrame) -> DataFrame:
    """Calls in order, typed, failed when they or a call above them carry an error."""
    rows = _variant(order_traces(nodes), "trace_json").withColumn("error_reason", _text("error"))
    key = ["block_number", "tx_hash"]
    rows = inside_flagged_payload(rows, key, "trace_address", F.col("error_reason").isNotNull(), "_failed")
    raw_value = F.coalesce(hex_to_text_number(_text("value")), F.lit("0"))
    typed = rows.withColumn("value_precise_raw", raw_value).select(
        *key, "trace_address", "trace_index", "sub_traces", "error_reason", _text("revertReason").alias("revert_reason"), _text("from").alias("from_address"), _text("to").alias("to_address"),
        F.coalesce(_text("value"), F.lit("0x0")).alias("value_hex"), "value_precise_raw", decimal_adjust("value_precise_raw", F.lit(COIN)).alias("value_precise"),
        hex_long(_text("gas")).alias("gas"), hex_long(_text("gasUsed")).alias("gas_used"), _text("input").alias("input"), _text("output").alias("output"), _text("type").alias("type"),
        F.col("trace_json").alias("data"), (~F.col("_failed")).alias("trace_succeeded"))
    typed = typed.withColumn("value", F.col("value_precise").cast("double")).withColumn("identifier", F.concat("type", F.lit("_"), "trace_address"))
    typed = typed.withColumn("trace_status", F.when(F.col("trace_succeeded"), F.lit("SUCCESS")).otherwise(F.lit("FAIL")))
    t = txs.select(*key, "block_timestamp", "origin_function_signature", F.col("from_address").alias("origin_from_address"), F.col("to_address").alias("origin_to_address"), "tx_position", "tx_succeeded")
    return keyed(typed.join(t, key, "left").select(*TRACE_COLUMNS), "fact_traces_id", "tx_hash", "trace_index")


def heal_traces(stored: DataFrame, txs: DataFrame) -> DataFrame:
    """Stored calls without transaction data whose transaction is there now."""
    t = txs.withColumnsRenamed({"from_address": "_of", "to_address": "_ot"})
    fill = {"tx_position": "tx_position", "block_timestamp": "block_timestamp", "tx_succeeded": "tx_succeeded", "origin_function_signature": "origin_function_signature",
            "origin_from_address": "_of", "origin_to_address": "_ot"}
    needy = stored.filter("tx_position is null or block_timestamp is null or tx_succeeded is null")
    return inc.heal_nulls(needy, t, ["block_number", "tx_hash"], fill)


# --- contracts ----------------------------------------------------------------------------------------


def created_contracts(trace_facts: DataFrame) -> DataFrame:
    """Successful creations, newest per address."""
    made = trace_facts.filter(F.col("type").ilike("create%") & F.col("to_address").isNotNull() & F.col("input").isNotNull() & (F.col("input") != "0x") & F.col("tx_succeeded") & F.col("trace_succeeded"))
    stamp = "modified_timestamp" if "modified_timestamp" in trace_facts.columns else "block_timestamp"
    rows = made.select("block_number", "block_timestamp", "tx_hash", F.col("to_address").alias("created_contract_address"), F.col("from_address").alias("creator_address"),
                       F.col("input").alias("created_contract_input"), F.col(stamp).alias(STAMP))
    return keyed(dedup_latest(rows, ["created_contract_address"], [newest(STAMP), newest("block_number"), newest("tx_hash")]), "created_contracts_id", "created_contract_address")


def contract_reads(reads: DataFrame) -> DataFrame:
    """Token name, symbol and decimals from function-call answers (contract_address, function_sig,
    read_result)."""
    ok = reads.filter(F.col("read_result").isNotNull() & (F.col("read_result") != "0x") & (F.length("read_result") <= V.READ_LIMIT))
    text = hex_to_text(F.substr("read_result", F.lit(64 * 2 + 3)))
    digits = hex_to_text_number("read_result")
    out = ok.groupBy("contract_address").agg(
        F.max(F.when(F.col("function_sig") == V.READ_NAME, text)).alias("token_name"), F.max(F.when(F.col("function_sig") == V.READ_SYMBOL, text)).alias("token_symbol"),
        F.max(F.when((F.col("function_sig") == V.READ_DECIMALS) & (F.length(digits) < 3), digits.cast("int"))).alias("token_decimals"), F.max(STAMP).alias(STAMP))
    return keyed(out, "contracts_id", "contract_address")


def dim_contracts(created: DataFrame, reads: DataFrame) -> DataFrame:
    """Creations with token data; the stamps are null-strict."""
    r = reads.select(F.lower("contract_address").alias("_a"), "token_symbol", "token_name", "token_decimals", F.col(STAMP).alias("_rs"))
    rows = created.join(r, F.lower("created_contract_address") == F.col("_a"), "left")
    return rows.select(
        F.col("created_contract_address").alias("address"), F.col("token_symbol").alias("symbol"), F.col("token_name").alias("name"), F.col("token_decimals").alias("decimals"),
        F.col("block_number").alias("created_block_number"), F.col("block_timestamp").alias("created_block_timestamp"), F.col("tx_hash").alias("created_tx_hash"), "creator_address",
        F.col("created_contracts_id").alias("dim_contracts_id"), greatest_strict(STAMP, "_rs").alias("modified_timestamp"))


def relevant_contracts(logs: DataFrame, trace_facts: DataFrame, stored: DataFrame | None = None, stamp: str = "modified_timestamp") -> DataFrame:
    """Event and call totals per contract, added to the stored totals of contracts that were active.

    Each side is counted by partial aggregation before it meets the other, so a contract with a third of
    all logs costs one row per task.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    marks = ["max_inserted_timestamp_logs", "max_inserted_timestamp_traces", "latest_event_block", "latest_call_block"]
    if stored is not None:
        logs = inc.newer_than(logs, stamp, inc.high_water(stored, marks[0]), strict=True)
        trace_facts = inc.newer_than(trace_facts, stamp, inc.high_water(stored, marks[1]), strict=True)
    calls = trace_facts.filter(F.col("tx_succeeded") & F.col("trace_succeeded") & F.col("to_address").isNotNull() & F.col("input").isNotNull() & (F.col("input") != "0x"))
    none_t, none_n, zero = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    e = logs.groupBy("contract_address").agg(F.count(F.lit(1)).alias("total_event_count"), F.max(stamp).cast("timestamp_ntz").alias(marks[0]), F.max("block_number").cast("bigint").alias(marks[2]))
    e = e.withColumns({"total_call_count": zero, marks[1]: none_t, marks[3]: none_n})
    c = calls.groupBy(F.col("to_address").alias("contract_address")).agg(F.count(F.lit(1)).alias("total_call_count"), F.max(stamp).cast("timestamp_ntz").alias(marks[1]), F.max("block_number").cast("bigint").alias(marks[3]))
    c = c.withColumns({"total_event_count": zero, marks[0]: none_t, marks[2]: none_n})
    cols = ["contract_address", "total_event_count", "total_call_count", *marks]
    add = ["total_event_count", "total_call_count"]
    totals = merge_totals(e.select(*cols), c.select(*cols), ["contract_address"], add, marks)
    if stored is not None:
        active = stored.join(totals.select("contract_address"), "contract_address", "left_semi").select(*cols)
        totals = merge_totals(active, totals, ["contract_address"], add, marks)
    out = totals.withColumn("total_interaction_count", F.col(add[0]) + F.col(add[1]))
    out = out.withColumns({marks[0]: F.coalesce(marks[0], epoch), marks[1]: F.coalesce(marks[1], epoch), marks[2]: F.coalesce(marks[2], F.lit(0)), marks[3]: F.coalesce(marks[3], F.lit(0))})
    return keyed(out, "relevant_contracts_id", "contract_address")


# --- decoded logs -------------------------------------------------------------------------------------


def decoded_logs(raw: DataFrame) -> DataFrame:
    """Decoded log payloads (block_number, id = hash-index, data) with a flat name → value map; unnamed
    parameters are called anonymous_<position>. Newest arrival per log."""
    rows = _variant(raw, "data").filter(F.schema_of_variant("_v").startswith("OBJECT"))
    rows = rows.select(F.col("block_number").cast("bigint").alias("block_number"), F.split_part("id", F.lit("-"), F.lit(1)).alias("tx_hash"), F.split_part("id", F.lit("-"), F.lit(2)).try_cast("bigint").alias("event_index"),
                       _text("name").alias("event_name"), F.lower(_text("address")).alias("contract_address"), F.col("data").alias("decoded_data"), STAMP,
                       F.from_json(F.to_json(F.try_variant_get("_v", "$.data", "variant")), "array<struct<name:string,value:string>>").alias("_p"))
    latest = dedup_latest(rows, ["block_number", "tx_hash", "event_index"], [newest(STAMP), newest("decoded_data")])
    named = F.transform("_p", lambda p, i: F.struct(F.when(p["name"] == "", F.concat(F.lit("anonymous_"), i.cast("string"))).otherwise(p["name"]).alias("key"), p["value"].alias("value")))
    # one parameter list per log: the map is built in the row, the last of equal names wins
    flat = F.aggregate(F.filter(named, lambda e: e["value"].isNotNull() & e["key"].isNotNull()), F.expr("cast(map() as map<string,string>)"),
                       lambda m, e: F.map_concat(F.map_filter(m, lambda k, _v: k != e["key"]), F.create_map(e["key"], e["value"])))
    out = once(latest.withColumn("decoded_flat", flat).drop("_p"), "decoded_flat").filter(F.size("decoded_flat") > 0)
    return keyed(out, "decoded_logs_id", "block_number", "tx_hash", "event_index")


def ez_decoded_event_logs(decoded: DataFrame, logs: DataFrame, txs: DataFrame, contracts: DataFrame) -> DataFrame:
    """Decoded logs with the log's columns, the transaction's outcome and the contract's name."""
    own = ["block_timestamp", "topics", "topic_0", "topic_1", "topic_2", "topic_3", "data", "event_removed", "origin_from_address", "origin_to_address", "origin_function_signature"]
    key = ["block_number", "tx_hash"]
    rows = decoded.select(*key, "event_index", "event_name", "contract_address", F.col("decoded_data").alias("full_decoded_log"), F.col("decoded_flat").alias("decoded_log"))
    rows = rows.join(logs.select(*key, "event_index", *own), [*key, "event_index"], "left").join(txs.select(*key, "tx_position", "tx_succeeded"), key, "left")
    names = contracts.filter(F.col("name").isNotNull()).select(F.col("address").alias("contract_address"), F.col("name").alias("contract_name"))
    rows = rows.join(names, "contract_address", "left")
    best = dedup_latest(rows, ["tx_hash", "event_index"], [last_desc("block_timestamp"), last_desc("tx_succeeded"), last_desc("contract_name"), newest("block_number")])
    return keyed(best, "ez_decoded_event_logs_id", "tx_hash", "event_index")


def heal_decoded_logs(stored: DataFrame, logs: DataFrame, txs: DataFrame, contracts: DataFrame) -> DataFrame:
    """Stored decoded logs that lack transaction data or a contract name and can get it now.

    The published condition mixes AND and OR without brackets; meant and used here is: outcome or time
    missing, and the log's time known.
    """
    key = ["block_number", "tx_hash", "event_index"]
    times = logs.select(*key, "block_timestamp").filter(F.col("block_timestamp").isNotNull()).join(txs.select("block_number", "tx_hash", "tx_succeeded"), ["block_number", "tx_hash"], "left")
    a = inc.heal_nulls(stored, times, key, {"block_timestamp": "block_timestamp", "tx_succeeded": "tx_succeeded"})
    names = contracts.filter(F.col("name").isNotNull()).select(F.col("address").alias("contract_address"), F.col("name").alias("_name"))
    b = inc.heal_nulls(stored, names, ["contract_address"], {"contract_name": "_name"})
    rows = union_all([a, b])
    healed = ["block_timestamp", "tx_succeeded", "contract_name"]
    both = rows.groupBy(*key).agg(*[F.max(c).alias(c) for c in healed])
    return stored.drop(*healed).join(both, key).select(*stored.columns)


# --- transfers ----------------------------------------------------------------------------------------


def _prices(prices: DataFrame, native: bool) -> DataFrame:
    if native:
        return prices.filter(F.col("is_native")).groupBy(F.col("hour").alias("_hour")).agg(F.max("price").alias("_native_price"))
    return prices.select(F.col("hour").alias("_hour"), F.col("token_address").alias("contract_address"), F.col("price").alias("_price"), F.col("is_verified").alias("_verified"))


def _hour() -> Column:
    return F.date_trunc("hour", F.col("block_timestamp")).cast("timestamp_ntz")


def _token_usd() -> Column:
    """The wrapped chain coin falls back to the chain coin's price."""
    wrapped = F.col("contract_address") == V.WRAPPED_NATIVE
    price = F.when(wrapped, F.coalesce("_price", "_native_price")).otherwise(F.col("_price"))
    return F.when(F.col("decimals").isNotNull() & price.isNotNull(), F.round(F.col("amount") * price, 2))


TOKEN_TRANSFER = ["block_number", "block_timestamp", "tx_hash", "tx_position", "event_index", "from_address", "to_address", "contract_address", "token_standard", "token_is_verified", "name", "symbol", "decimals",
                  "raw_amount_precise", "raw_amount", "amount_precise", "amount", "amount_usd", "origin_function_signature", "origin_from_address", "origin_to_address", "ez_token_transfers_id"]


def _amounts(rows: DataFrame, prices: DataFrame) -> DataFrame:
    rows = rows.withColumn("amount_precise", F.when(F.col("decimals").isNotNull(), decimal_adjust("raw_amount_precise", "decimals"))).withColumn("amount", F.col("amount_precise").cast("double"))
    rows = rows.withColumn("_hour", _hour()).join(_prices(prices, False), ["_hour", "contract_address"], "left").join(_prices(prices, True), "_hour", "left")
    verified = F.when(F.col("contract_address") == V.WRAPPED_NATIVE, F.lit(True)).otherwise(F.coalesce("_verified", F.lit(False)))
    return rows.withColumn("amount_usd", _token_usd()).withColumn("token_is_verified", verified)


def _token_dim(contracts: DataFrame) -> DataFrame:
    known = F.col("decimals").isNotNull() | F.col("symbol").isNotNull() | F.col("name").isNotNull()
    return contracts.filter(known).select(F.col("address").alias("contract_address"), "decimals", "symbol", "name")


def token_transfers(logs: DataFrame, contracts: DataFrame, prices: DataFrame) -> DataFrame:
    """Fungible token transfers with exact and USD amounts."""
    ok = F.col("tx_succeeded") & ~F.col("event_removed") & F.col("topic_1").isNotNull() & F.col("topic_2").isNotNull() & F.col("data").isNotNull()
    rows = logs.filter((F.col("topic_0") == V.TRANSFER) & ok).select(
        "block_number", "block_timestamp", "tx_hash", "tx_position", "event_index", "origin_function_signature", "origin_from_address", "origin_to_address", "contract_address",
        topic_address("topic_1").alias("from_address"), topic_address("topic_2").alias("to_address"), hex_to_text_number(F.substring("data", 3, 64)).alias("raw_amount_precise"),
        F.lit("erc20").alias("token_standard"), F.col("fact_event_logs_id").alias("ez_token_transfers_id"))
    rows = rows.filter(F.col("raw_amount_precise").isNotNull()).withColumn("raw_amount", F.col("raw_amount_precise").cast("double"))
    return best_token_transfers(_amounts(rows.join(_token_dim(contracts), "contract_address", "left"), prices).select(*TOKEN_TRANSFER))


def best_token_transfers(rows: DataFrame) -> DataFrame:
    """One row per transfer: the one that knows most."""
    order = [last_desc(c) for c in ("amount_usd", "token_is_verified", "decimals", "symbol", "name")]
    return dedup_latest(rows, ["ez_token_transfers_id"], order)


def heal_token_transfers(stored: DataFrame, contracts: DataFrame, prices: DataFrame, verified: DataFrame | None = None, since=None) -> DataFrame:
    """Stored transfers that can improve: a price has come, token data has come, or (with `verified`) the
    token has been verified since."""
    recent = stored if since is None else stored.filter(F.col("block_timestamp") >= F.lit(since))
    broken = recent.filter("amount_usd is null or decimals is null or symbol is null or name is null")
    dims = _token_dim(contracts).withColumnsRenamed({"decimals": "_d", "symbol": "_s", "name": "_n"})
    filled = broken.join(dims, "contract_address", "left")
    had = ["amount_usd", "decimals", "symbol", "name"]
    filled = filled.withColumns({f"_had_{c}": F.col(c).isNotNull() for c in had})
    filled = filled.withColumns({"decimals": F.coalesce("decimals", "_d"), "symbol": F.coalesce("symbol", "_s"), "name": F.coalesce("name", "_n")}).drop("_d", "_s", "_n", "amount_usd", "token_is_verified", "amount_precise", "amount")
    fresh = _amounts(filled, prices)
    better = " or ".join(f"(not _had_{c} and {c} is not null)" for c in had)
    parts = [fresh.filter(better).select(*TOKEN_TRANSFER)]
    if verified is not None:
        tokens = verified.select(F.col("token_address").alias("contract_address")).distinct()
        again = stored.join(tokens, "contract_address", "left_semi").drop("amount_usd", "token_is_verified", "amount_precise", "amount")
        parts.append(_amounts(again, prices).select(*TOKEN_TRANSFER))
    return best_token_transfers(union_all(parts))


NATIVE_TRANSFER = ["block_number", "block_timestamp", "tx_hash", "tx_position", "trace_index", "trace_address", "type", "from_address", "to_address", "amount", "amount_precise_raw", "amount_precise",
                   "amount_usd", "origin_from_address", "origin_to_address", "origin_function_signature", "ez_native_transfers_id"]


def _coin_price(rows: DataFrame, prices: DataFrame) -> DataFrame:
    wrapped = prices.filter(F.col("token_address") == V.WRAPPED_NATIVE).select(F.col("hour").alias("_hour"), F.col("price").alias("_wrapped_price"))
    rows = rows.withColumn("_hour", _hour()).join(wrapped, "_hour", "left").join(_prices(prices, True), "_hour", "left")
    return rows.withColumn("_coin_price", F.coalesce("_wrapped_price", "_native_price"))


def native_transfers(trace_facts: DataFrame, prices: DataFrame) -> DataFrame:
    """Chain-coin moves of successful calls with their USD value."""
    moved = trace_facts.filter((F.col("value") > 0) & F.col("tx_succeeded") & F.col("trace_succeeded") & ~F.col("type").isin("DELEGATECALL", "STATICCALL"))
    rows = moved.withColumnsRenamed({"value": "amount", "value_precise_raw": "amount_precise_raw", "value_precise": "amount_precise"})
    rows = _coin_price(rows, prices).withColumn("amount_usd", F.round(F.col("amount") * F.col("_coin_price"), 2))
    return keyed(rows, "ez_native_transfers_id", "tx_hash", "trace_index").select(*NATIVE_TRANSFER)


def heal_native_transfers(stored: DataFrame, prices: DataFrame) -> DataFrame:
    rows = _coin_price(stored.filter(F.col("amount_usd").isNull()), prices).filter(F.col("_coin_price").isNotNull())
    return rows.withColumn("amount_usd", F.col("amount") * F.col("_coin_price")).select(*stored.columns)


NFT_TRANSFER = ["block_number", "block_timestamp", "tx_hash", "event_index", "intra_event_index", "token_transfer_type", "is_mint", "from_address", "to_address", "contract_address", "token_id", "quantity",
                "token_standard", "name", "origin_function_signature", "origin_from_address", "origin_to_address", "ez_nft_transfers_id"]


def nft_transfers(logs: DataFrame, contracts: DataFrame) -> DataFrame:
    """Non-fungible transfers: single, counted, and batches whose id and quantity arrays are zipped by
    position inside the row."""
    single = (F.col("topic_0") == V.TRANSFER) & (F.col("data") == "0x") & F.col("topic_3").isNotNull()
    counted, batch = F.col("topic_0") == V.TRANSFER_SINGLE, F.col("topic_0") == V.TRANSFER_BATCH
    rows = logs.filter(F.col("tx_succeeded") & ~F.col("event_removed") & (single | counted | batch)).withColumn("_w", hex_words("data"))
    kind = F.when(single, F.lit("erc721_Transfer")).when(counted, F.lit("erc1155_TransferSingle")).otherwise(F.lit("erc1155_TransferBatch"))
    rows = rows.withColumn("token_transfer_type", kind).withColumn("from_address", F.when(single, topic_address("topic_1")).otherwise(topic_address("topic_2")))
    rows = rows.withColumn("to_address", F.when(single, topic_address("topic_2")).otherwise(topic_address("topic_3"))).filter(F.col("to_address").isNotNull())

    def pair(i, token, quantity):
        return F.struct(F.lit(i).cast("int").alias("i") if isinstance(i, int) else i.cast("int").alias("i"), token.alias("token"), quantity.alias("quantity"))

    none = F.lit(None).cast("string")
    n = hex_to_number(word("_w", 2)).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    many = F.filter(F.transform(at, lambda i: pair(i + 1, F.get("_w", 3 + i), F.get("_w", 4 + n + i))), lambda p: p["token"].isNotNull() & p["quantity"].isNotNull())
    one = F.array(pair(1, F.when(single, F.col("topic_3")).otherwise(word("_w", 0)), F.when(single, none).otherwise(word("_w", 1))))
    rows = rows.withColumn("_p", F.explode(F.when(batch, many).otherwise(one)))
    names = contracts.filter(F.col("name").isNotNull() & (F.col("name") != "")).select(F.col("address").alias("contract_address"), "name")
    out = rows.join(names, "contract_address", "left").withColumns({
        "intra_event_index": F.col("_p.i"), "token_id": F.coalesce(hex_to_text_number("_p.token"), F.lit("0")), "quantity": F.coalesce(hex_to_text_number("_p.quantity"), F.lit("1")),
        "is_mint": F.col("from_address") == V.ZERO_ADDRESS, "token_standard": F.when(single, F.lit("erc721")).otherwise(F.lit("erc1155"))})
    return keyed(out, "ez_nft_transfers_id", "tx_hash", "event_index", "intra_event_index").select(*NFT_TRANSFER)


def heal_nft_names(stored: DataFrame, contracts: DataFrame) -> DataFrame:
    names = contracts.filter(F.col("name").isNotNull()).select(F.col("address").alias("contract_address"), F.col("name").alias("_name"))
    return inc.heal_nulls(stored, names, ["contract_address"], {"name": "_name"})


def labels(shared: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Address labels of the EVM side, merged into the stored ones, soft-deleted rows removed."""
    mine = keyed(shared.filter(F.col("address").like("0x%")), "labels_id", "labels_combined_id")
    merged = mine if stored is None else inc.merge_upsert(stored, mine, ["labels_combined_id"])
    return inc.post_delete(merged, F.col("_is_deleted"))


def dim_labels(rows: DataFrame) -> DataFrame:
    out = rows.select("blockchain", "creator", "address", "address_name", "label_type", "label_subtype", F.col("project_name").alias("label"), "labels_id")
    return keyed(out, "dim_labels_id", "labels_id").drop("labels_id")
