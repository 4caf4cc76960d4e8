"""Blocks, transactions, messages, attributes, transfers and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ...functions.coins import coin_amount, coin_denom, rate_amount, rate_denom
from ...functions.common import base64_text, concat_ws_strict, greatest_strict, newest, oldest
from ...operators import increments as inc
from ...operators.joins import daily_spine
from ...operators.rows import flatten, json_project, json_walk
from ...operators.sets import union_all
from ...operators.windows import broadcast_agg, dedup_latest, dedup_priority, ffill, group_by_marker, rank_in_group, running_sum, subgroup_backfill
from ..audit import keyed, published
from . import values as V
from .attrs import BLOCK, EVENT, GROUP, STAMP, has, objects, of_type, tx_sender

# messages of one transaction are cut into ranges of this many, as block-level events share one id
MSG_RANGE = 10_000

TX_SCHEMA = """struct<height:string, hash:string, tx_result:struct<code:bigint, codespace:string, gas_used:bigint,
    gas_wanted:bigint, log:string, data:string, events:array<struct<type:string, attributes:array<struct<key:string, value:string>>>>>>"""

ATTRIBUTES = ["block_id", "block_timestamp", "tx_id", "tx_succeeded", "tx_type", "msg_group", "msg_sub_group", "msg_index", "msg_type"]


def msg_range() -> Column:
    return F.expr(f"msg_index div {MSG_RANGE}")


# --- landed payloads ------------------------------------------------------------------------------


def landed_blocks(raw: DataFrame) -> DataFrame:
    """Legacy landing rows (block_number, data, stamp) in two payload shapes."""
    def at(path):
        return [f"$.result.block{path}", f"$.data.result.block{path}"]
    fields = {"_txs": (at(".data.txs"), "array<variant>"), "header": (at(".header"), "variant"), "chain_id": (at(".header.chain_id"), "string"), "_time": (at(".header.time"), "string"), "_block": (at(""), "variant")}
    rows = json_project(raw, "data", fields).filter(F.col("_block").isNotNull())
    return rows.select(
        F.col("block_number").alias("block_id"), F.coalesce(F.size("_txs"), F.lit(0)).alias("tx_count"), F.to_json("header").alias("header"),
        "chain_id", F.col("_time").try_cast("timestamp_ntz").alias("block_timestamp"), "data", STAMP)


def landed_transactions(raw: DataFrame) -> DataFrame:
    """Legacy landing rows to one row per transaction, two payload shapes; a page without any keeps a row."""
    fields = {"_txs": (["$.result.txs", "$.data.result.txs"], "array<variant>"), "_err": (["$.error.code"], "string")}
    rows = json_project(raw, "data", fields).filter(F.col("_err").isNull())
    each = flatten(rows, "_txs", "tx_block_index", "_tx", outer=True)
    return each.select(F.col("block_number").alias("block_id"), F.try_variant_get("_tx", "$.hash", "string").alias("tx_id"), "tx_block_index", F.to_json("_tx").alias("tx"), STAMP)


# --- blocks ---------------------------------------------------------------------------------------


def blocks(raw: DataFrame) -> DataFrame:
    """Landed block payloads to typed blocks, newest arrival per (chain, block)."""
    head = "$.result.block.header"
    fields = {
        "block_id": ([f"{head}.height"], "bigint"), "chain_id": ([f"{head}.chain_id"], "string"), "_time": ([f"{head}.time"], "string"),
        "proposer_address": ([f"{head}.proposer_address"], "string"), "validator_hash": ([f"{head}.validators_hash"], "string"),
        "_txs": (["$.result.block.data.txs"], "array<variant>"), "_header": ([head], "variant"),
    }
    rows = json_project(raw, "data", fields, [STAMP]).filter(F.col("block_id").isNotNull())
    typed = rows.select(
        "block_id", F.col("_time").try_cast("timestamp_ntz").alias("block_timestamp"), F.lit(V.CHAIN).alias("blockchain"), "chain_id",
        F.coalesce(F.when(F.col("_txs").isNotNull(), F.size("_txs")), F.lit(0)).alias("tx_count"), "proposer_address", "validator_hash",
        F.to_json("_header").alias("header"), STAMP)
    return keyed(dedup_latest(typed, ["chain_id", "block_id"], [newest(STAMP), newest("header")]), "blocks_id", "block_id")


def block_metas(raw: DataFrame) -> DataFrame:
    """Chain-info payloads to one row per height, newest arrival. The list of metas stands at
    data….result.block_metas, in one page or several, however deep the pages are wrapped."""
    each = json_walk(raw.select("data", STAMP), "data", "data**.result.block_metas[*]")
    get = lambda p, t: F.try_variant_get("value", p, t)
    rows = each.select(
        get("$.header.chain_id", "string").alias("chain_id"), get("$.header.height", "bigint").alias("block_id"),
        get("$.header.time", "string").try_cast("timestamp_ntz").alias("block_timestamp"), get("$.block_size", "bigint").alias("block_size"),
        F.to_json(get("$.header", "variant")).alias("block_header"), F.to_json(get("$.block_id", "variant")).alias("block_id_object"),
        get("$.num_txs", "bigint").alias("num_txs"), STAMP)
    return keyed(dedup_latest(rows, ["block_id"], [newest(STAMP), newest("block_header")]), "blockchain_id", "block_id")


# --- transactions ---------------------------------------------------------------------------------


def parse_transactions(raw: DataFrame) -> DataFrame:
    """Landed transaction payloads to typed rows, newest arrival per transaction. The schema is declared:
    one pass of the JSON reader, unused branches are skipped."""
    tx = F.from_json("data", TX_SCHEMA)
    rows = raw.select(tx.alias("t"), "data", STAMP).filter(F.col("t.hash").isNotNull())
    r = "t.tx_result."
    typed = rows.select(
        F.col("t.height").try_cast("bigint").alias("block_id"), F.col("t.hash").alias("tx_id"), F.col(r + "code").isNull().alias("tx_succeeded"),
        F.col(r + "code").alias("tx_code"), F.col(r + "codespace").alias("codespace"), F.col(r + "gas_used").alias("gas_used"), F.col(r + "gas_wanted").alias("gas_wanted"),
        base64_text(r + "data").alias("tx_type"), F.col(r + "events").alias("msgs"), F.to_json(F.try_parse_json(r + "log")).alias("tx_log"), F.col("data").alias("full_tx"), STAMP)
    return dedup_latest(typed, ["tx_id"], [newest(STAMP), newest("full_tx")])


def transactions(raw: DataFrame, chain_blocks: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Transactions with their block's time. Rows whose block is missing carry the sentinel time; stored
    ones are tried again each run. One row per transaction: earliest time, then success, then arrival."""
    dim = chain_blocks.select("block_id", "block_timestamp")
    fresh = inc.with_parent_time(parse_transactions(raw), dim, ["block_id"], "block_timestamp")
    rows = fresh
    if stored is not None:
        waiting = stored.filter(inc.is_pending("block_timestamp")).drop("block_timestamp")
        rows = fresh.unionByName(waiting.join(dim, "block_id").select(*[c for c in stored.columns]).drop("transactions_id"), allowMissingColumns=True)
    best = dedup_latest(rows, ["tx_id"], [oldest("block_timestamp"), newest("tx_succeeded"), newest(STAMP)])
    return keyed(best, "transactions_id", "tx_id")


def transactions_final(txs: DataFrame, attrs: DataFrame) -> DataFrame:
    """Transactions with fee and sender; pending ones are hidden."""
    rel = of_type(attrs, "tx", "signer")
    order = ["msg_index", "attribute_index"]
    fee = dedup_latest(rel.filter(has(None, "fee")), ["tx_id"], order).select("tx_id", F.col("attribute_value").alias("fee"))
    keys = [k for _, k in V.SENDER_SOURCES]
    first = dedup_latest(rel.filter(F.col("attribute_key").isin(*keys)), ["tx_id"], order)
    spender = first.select("tx_id", F.split_part("attribute_value", F.lit("/"), F.lit(1)).alias("tx_from"))
    out = inc.settled(txs, "block_timestamp").join(fee, "tx_id", "left").join(spender, "tx_id", "left")
    cols = ["block_id", "block_timestamp", "tx_id", "tx_from", "tx_succeeded", "codespace", F.coalesce("fee", F.lit(V.ZERO_FEE)).alias("fee"),
            "gas_used", "gas_wanted", "tx_code", "msgs", STAMP]
    return keyed(out.select(*cols), "transactions_final_id", "tx_id")


# --- messages -------------------------------------------------------------------------------------


def split_messages(txs: DataFrame) -> DataFrame:
    """One row per event of a transaction, with the first attribute decoded."""
    each = flatten(txs.select("block_id", "block_timestamp", "tx_id", "tx_succeeded", "tx_type", "msgs", STAMP), "msgs", "msg_index", "msg")
    first = F.get(F.col("msg.attributes"), F.lit(0))
    key, value = base64_text(first["key"]), base64_text(first["value"])
    rows = each.drop("msgs").withColumn("msg_type", F.col("msg.type")).withColumn("attribute_key", key).withColumn("attribute_value", value)
    flag = lambda v: F.coalesce(F.col("attribute_key") == v, F.lit(False))
    return rows.withColumn("is_action", flag("action")).withColumn("is_module", flag("module"))


def number_messages(rows: DataFrame) -> DataFrame:
    """Message groups and sub-groups.

    An action event opens a group, events before the first one have none. Inside a group the module
    events are ranked; every event takes the rank of the next module event at or after it. Where none
    follows it is 0, unless the transaction's last event is of type `tx`.

    The events of a transaction come out of one payload row, so a group fits a task, and all windows
    share one partitioning by transaction. For events that arrive as rows of their own see
    number_message_rows().
    """
    tx = Window.partitionBy("tx_id")
    so_far = tx.orderBy("msg_index").rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("tx_id", "msg_group")
    rest = group.orderBy("msg_index").rowsBetween(0, Window.unboundedFollowing)
    marked = Window.partitionBy("tx_id", "msg_group", "_marked").orderBy("msg_index")
    opened = F.sum(F.when(F.col("is_action"), 1).otherwise(0)).over(so_far)
    return _sub_numbers(
        rows.withColumn("msg_group", F.nullif(opened - 1, F.lit(-1))).withColumn("_last", F.max_by("msg_type", "msg_index").over(tx)),
        lambda df: df.withColumn("_exec", F.bool_or(_is_action_message()).over(group)),
        lambda df: df.withColumn("_r", F.row_number().over(marked)),
        lambda df, number, default: df.withColumn("msg_sub_group", F.coalesce(F.first(number, ignorenulls=True).over(rest), default)),
    )


def number_message_rows(rows: DataFrame, chunk: Column | None = None) -> DataFrame:
    """The same numbering for event rows of which one transaction may hold any share: every step works in
    ranges of a transaction and carries its state across them."""
    chunk = msg_range() if chunk is None else chunk
    by = ["tx_id", "msg_group"]
    grouped = group_by_marker(rows, ["tx_id"], ["msg_index"], F.col("is_action"), "msg_group", chunk=chunk)
    return _sub_numbers(
        broadcast_agg(grouped, ["tx_id"], _last=F.max_by("msg_type", "msg_index")),
        lambda df: broadcast_agg(df, by, _exec=F.bool_or(_is_action_message())),
        lambda df: rank_in_group(df, [*by, "_marked"], ["msg_index"], "_r", chunk=chunk),
        lambda df, number, default: subgroup_backfill(df, by, ["msg_index"], number, default, "msg_sub_group", chunk=chunk),
    )


def _is_action_message() -> Column:
    return F.coalesce((F.col("msg_type") == "message") & (F.col("attribute_key") == "action"), F.lit(False))


def _sub_numbers(grouped: DataFrame, with_exec, with_rank, with_fill) -> DataFrame:
    in_group = F.col("msg_group").isNotNull()
    ranked_rows = F.col("_exec") & F.col("is_module") & (F.col("msg_type") == "message") & in_group
    ranked = with_rank(with_exec(grouped).withColumn("_marked", ranked_rows))
    number = F.when(F.col("_marked"), F.col("_r") - 1)
    filled = with_fill(ranked, number, F.when(F.col("_last") != "tx", F.lit(0)))
    return filled.withColumn("msg_sub_group", F.when(in_group, F.col("msg_sub_group"))).drop("_last", "_exec", "_marked", "_r")


def messages(txs: DataFrame) -> DataFrame:
    """One row per event of a dated transaction, numbered."""
    numbered = number_messages(inc.settled(split_messages(txs), "block_timestamp"))
    cols = ["block_id", "block_timestamp", "tx_id", "tx_succeeded", "tx_type", "msg_group", "msg_sub_group", "msg_index", "msg_type", "msg", STAMP]
    return keyed(numbered.select(*cols), "msgs_id", "tx_id", "msg_index")


def msg_attributes(msgs: DataFrame) -> DataFrame:
    """One row per attribute, keys and values decoded."""
    each = flatten(msgs.select(*ATTRIBUTES, F.col("msg.attributes").alias("_a"), STAMP), "_a", "attribute_index", "_kv")
    rows = each.select(*ATTRIBUTES, "attribute_index", base64_text("_kv.key").alias("attribute_key"), base64_text("_kv.value").alias("attribute_value"), STAMP)
    return keyed(rows, "msg_attributes_id", "tx_id", "msg_index", "attribute_index")


# --- transfers ------------------------------------------------------------------------------------


def transfers(attrs: DataFrame) -> DataFrame:
    """Transfer events with sender, receiver, amount and unit; transactions without a signer are left out."""
    rel = of_type(attrs, "tx", "signer", "transfer")
    moves = objects(of_type(rel, "transfer"), EVENT, {"sender": "_from", "recipient": "receiver", "amount": "_raw"})
    signed = moves.join(tx_sender(rel, "_signer"), "tx_id").filter(F.col("_raw").isNotNull())
    out = signed.select(
        *BLOCK, F.lit(V.NATIVE_TRANSFER).alias("transfer_type"), "msg_index", F.coalesce("_from", "_signer").alias("sender"), "receiver",
        coin_amount("_raw").alias("amount"), coin_denom("_raw").alias("currency"), STAMP)
    return keyed(out, "transfers_id", "tx_id", "msg_index")


# --- oracle votes ---------------------------------------------------------------------------------


def oracle_votes(attrs: DataFrame) -> DataFrame:
    """Aggregate exchange-rate votes to one row per (vote, currency).

    Attribute values that are JSON objects are opened into their fields first.
    """
    voting = attrs.filter(has("message", "action", V.ORACLE_VOTE_ACTION)).select(*GROUP, "block_timestamp").distinct()
    votes = of_type(attrs, "aggregate_vote").join(voting, [*GROUP, "block_timestamp"], "left_semi")
    fields = F.from_json("attribute_value", "map<string,string>")
    opened = votes.select("*", F.explode_outer(F.when(F.col("attribute_value").startswith("{"), fields)).alias("_k", "_v"))
    flat = opened.withColumn("attribute_key", F.coalesce("_k", "attribute_key")).withColumn("attribute_value", F.coalesce("_v", "attribute_value"))
    agg = objects(flat, [*BLOCK, "msg_group", "msg_sub_group"], ["voter", "exchange_rates"])
    order = ["msg_index", "attribute_index"]
    signer = dedup_latest(attrs.filter(has(None, "acc_seq")), ["tx_id"], order).select("tx_id", F.split_part("attribute_value", F.lit("/"), F.lit(1)).alias("tx_sender"))
    split = agg.withColumn("raw_exchange_rates", F.explode(F.split("exchange_rates", ",")))
    rows = split.join(signer, "tx_id").withColumn("amount", rate_amount("raw_exchange_rates")).withColumn("currency", rate_denom("raw_exchange_rates"))
    keyed_rows = rows.withColumn("_unique_key", concat_ws_strict("-", *GROUP, "voter", "currency"))
    return keyed(keyed_rows.drop("exchange_rates"), "oracle_votes_id", "_unique_key")


# --- addresses ------------------------------------------------------------------------------------


def address_mapping_onchain(attrs: DataFrame) -> DataFrame:
    """First association event of each native address."""
    rel = of_type(attrs, "address_associated").filter("tx_succeeded")
    pairs = objects(rel, ["block_timestamp", "block_id", "tx_id", "msg_index"], {V.NATIVE_ADDRESS_KEY: "native_address", V.EVM_ADDRESS_KEY: "evm_address"})
    first = dedup_latest(pairs, ["native_address"], ["block_timestamp", "block_id", "tx_id", "msg_index"])
    out = first.select(F.col("block_timestamp").alias("block_timestamp_associated"), F.col("block_id").alias("block_id_associated"), "native_address", F.lower("evm_address").alias("evm_address"))
    return keyed(out, "address_mapping_onchain_id", "native_address")


def address_mapping_api(raw: DataFrame, evm_addresses: DataFrame) -> DataFrame:
    """Associations answered by the API, newest per EVM address, for addresses seen on chain."""
    value, data = F.try_parse_json("value"), F.try_parse_json("data")
    rows = raw.select(F.try_variant_get(value, "$.EVM_ADDRESS", "string").alias("evm_address"), F.try_variant_get(data, "$.result", "string").alias("native_address"), STAMP)
    latest = dedup_latest(rows, ["evm_address"], [newest(STAMP), newest("native_address")])
    seen = evm_addresses.select("evm_address", "block_timestamp_associated", "block_id_associated")
    out = latest.join(seen, "evm_address").select("block_timestamp_associated", "block_id_associated", "native_address", F.lower("evm_address").alias("evm_address"), STAMP)
    return keyed(out, "address_mapping_api_id", "native_address")


def dim_address_mapping(onchain: DataFrame, api: DataFrame) -> DataFrame:
    """On-chain associations, and those of the API for addresses without one."""
    cols = ["block_timestamp_associated", "block_id_associated", "native_address", "evm_address"]
    extra = api.select(*cols).join(onchain.select("native_address"), "native_address", "left_anti")
    combo = union_all([onchain.select(*cols), extra.select(*cols)])
    return keyed(combo.withColumn("evm_address", F.lower("evm_address")), "dim_address_mapping_id", "native_address")


# --- assets and contracts -------------------------------------------------------------------------


def asset_metadata(token_info: DataFrame, shared_assets: DataFrame, api_prices: DataFrame) -> DataFrame:
    """Token metadata from three sources: contract over shared list over price list."""
    get = lambda p, t: F.try_variant_get(F.try_parse_json("data"), p, t)
    own = token_info.filter(F.col("data").isNotNull() & get("$.exchange_rate_decimals", "string").isNull()).select(
        F.col("contract_address").alias("currency"), get("$.decimals", "int").alias("decimals"), get("$.name", "string").alias("token_name"), get("$.symbol", "string").alias("symbol"), F.lit(1).alias("_rank"))
    shared = shared_assets.filter(F.col("address").like("ibc%")).select(
        F.col("address").alias("currency"), F.col("decimal").cast("int").alias("decimals"), F.col("label").alias("token_name"), F.col("project_name").alias("symbol"), F.lit(2).alias("_rank"))
    priced = api_prices.select(F.col("contract_address").alias("currency"), F.col("decimals").cast("int").alias("decimals"), F.col("name").alias("token_name"), "symbol", F.lit(3).alias("_rank"))
    best = dedup_priority(union_all([own, shared, priced]), ["currency"], F.col("_rank"), ["symbol", "token_name", "decimals"])
    return keyed(best.drop("_rank"), "asset_metadata_id", "currency")


def contracts_instantiate(attrs: DataFrame) -> DataFrame:
    rows = attrs.filter(has("instantiate", "_contract_address")).select(
        F.col("attribute_value").alias("contract_address"), F.col("tx_id").alias("init_tx_id"), F.col("block_timestamp").alias("init_by_block_timestamp"), STAMP)
    return keyed(dedup_latest(rows, ["contract_address"], [newest(STAMP), newest("init_tx_id")]), "contracts_id", "contract_address")


def contracts(created: DataFrame, listed: DataFrame, labels: DataFrame) -> DataFrame:
    """Created contracts with the list's names, the label table's where the list has none.

    The row order compares stamps null-strictly: a contract absent from the list has no such stamp.
    """
    names = ["admin", "init_by_account_address", "label"]
    b = listed.select("contract_address", *[F.col(n).alias(f"_b_{n}") for n in names], F.col(STAMP).alias("_bs"))
    c = labels.select("contract_address", *[F.col(n).alias(f"_c_{n}") for n in names], F.col(STAMP).alias("_cs"))
    joined = created.join(b, "contract_address", "left").join(c, "contract_address", "left")
    long_ago = F.lit(V.EPOCH_STAMP).cast("timestamp_ntz")
    rows = joined.withColumn("_order", greatest_strict(STAMP, "_bs")).select(
        "contract_address", *[F.coalesce(f"_b_{n}", f"_c_{n}").alias(n) for n in names], "init_by_block_timestamp", "_order",
        F.greatest(F.col(STAMP), F.coalesce("_bs", long_ago), F.coalesce("_cs", long_ago)).alias(STAMP))
    best = dedup_latest(rows, ["contract_address"], [newest("_order"), newest(STAMP), oldest("label")]).drop("_order")
    return keyed(best, "contracts_id", "contract_address")


def contract_payload(raw: DataFrame, row_id: str, error_code: bool = False) -> DataFrame:
    """Newest API answer per contract, split into its parts (config, info, status and token answers share
    one shape; the plain contract answer carries its code in the error)."""
    v = F.try_parse_json("data")
    get = lambda p: F.try_variant_get(v, p, "variant")
    text = lambda p: F.try_variant_get(v, p, "string")
    if error_code:
        cols = [F.to_json(get("$.data")).alias("data"), text("$.error.code").alias("code")]
    else:
        cols = [F.to_json(get("$.data.data")).alias("data"), *[text(f"$.data.{n}").alias(n) for n in ("code", "details", "message")]]
    rows = raw.select("contract_address", F.col("data").alias("_raw"), STAMP, *cols)
    return keyed(dedup_latest(rows, ["contract_address"], [newest(STAMP), newest("_raw")]).drop("_raw"), row_id, "contract_address")


def latest_per_contract(raw: DataFrame, row_id: str) -> DataFrame:
    rest = sorted(c for c in raw.columns if c not in (STAMP, "contract_address"))
    return keyed(dedup_latest(raw, ["contract_address"], [newest(STAMP), *[newest(c) for c in rest]]), row_id, "contract_address")


# --- balances -------------------------------------------------------------------------------------


def balances_staked(staking: DataFrame) -> DataFrame:
    """Running staked balance per (address, currency); everything but a delegation takes away."""
    signed = F.when(F.col("action") == "delegate", F.col("amount")).otherwise(-F.col("amount"))
    rows = staking.withColumn("address", F.col("delegator_address")).withColumn("amount", signed.cast("decimal(38,0)"))
    ordered = ["block_timestamp", "msg_group", "tx_id", "msg_index"]
    summed = running_sum(rows, ["address", "currency"], ordered, F.col("amount"), "balance", chunk=F.to_date("block_timestamp"))
    cols = ["block_id", "block_timestamp", "tx_id", "msg_group", "msg_index", "address", "amount", F.col("balance").cast("decimal(38,0)").alias("balance"), "currency", STAMP]
    return summed.select(*cols)


def daily_balances(balances: DataFrame, as_of, stored: DataFrame | None = None) -> DataFrame:
    """Balance of every (address, currency) for every day since its first, carried forward.

    With a stored table, work starts at its second newest day: stored balances of that day, overridden by
    new movements, are carried on from there.
    """
    pair = ["address", "currency"]
    end_of_day = [newest("block_timestamp"), newest("msg_group"), newest("tx_id"), newest("msg_index")]
    days = balances.withColumn("date", F.to_date("block_timestamp"))
    if stored is not None:
        top = stored.agg(F.max("date").alias("m")).first()["m"]
        start = F.date_sub(F.lit(top), 1)
        days = days.filter(F.col("date") >= start)
    latest = dedup_latest(days, [*pair, "date"], end_of_day).select("date", *pair, "balance")
    if stored is not None:
        carried = stored.filter(F.col("date") == start).select("date", *pair, "balance").join(latest.select("date", *pair), ["date", *pair], "left_anti")
        latest = latest.unionByName(carried)
    first = latest.groupBy(*pair).agg(F.min("date").alias("_lo"))
    spine = daily_spine(first, "_lo", F.lit(as_of).cast("date"), "date").drop("_lo")
    filled = ffill(spine.join(latest, ["date", *pair], "left"), pair, ["date"], F.col("balance"), "_b", chunk=F.year("date"))
    out = filled.select("date", F.lit("staked").alias("balance_type"), *pair, F.col("_b").alias("balance"))
    return keyed(out, "daily_balances_staked_id", "address", "currency", "date")


# --- published views ------------------------------------------------------------------------------


def group_text() -> Column:
    return F.concat(F.col("msg_group").cast("string"), F.lit(":"), F.col("msg_sub_group").cast("string")).alias("msg_group")


def fact_blocks(df: DataFrame) -> DataFrame:
    return published(df, ["block_id", "block_timestamp", "chain_id", "tx_count", "proposer_address", "validator_hash", "header"], "blocks_id", "fact_blocks_id", "block_id")


def fact_transactions(df: DataFrame) -> DataFrame:
    cols = ["block_id", "block_timestamp", "tx_id", "tx_from", "tx_succeeded", "codespace", "fee", "gas_used", "gas_wanted", "tx_code", "msgs"]
    return published(df, cols, "transactions_final_id", "fact_transactions_id", "tx_id")


def fact_msgs(df: DataFrame) -> DataFrame:
    return published(df, [*BLOCK, group_text(), "msg_index", "msg_type", "msg"], "msgs_id", "fact_msgs_id", "tx_id", "msg_index")


def fact_msg_attributes(df: DataFrame) -> DataFrame:
    cols = [*BLOCK, group_text(), "msg_index", "msg_type", "attribute_index", "attribute_key", "attribute_value"]
    return published(df, cols, "msg_attributes_id", "fact_msg_attributes_id", "tx_id", "msg_index", "attribute_index")


def fact_transfers(native: DataFrame, ibc: DataFrame) -> DataFrame:
    cols = [*BLOCK, "transfer_type", "sender", "amount", "currency", "receiver"]
    parts = [published(native, cols, "transfers_id", "fact_transfers_id", "tx_id", "msg_index"), published(ibc, cols, "transfers_ibc_id", "fact_transfers_id", "tx_id", "msg_index")]
    return union_all(parts)


def fact_oracle_votes(df: DataFrame) -> DataFrame:
    cols = [*BLOCK, "msg_group", "msg_sub_group", "tx_sender", "voter", "amount", "currency"]
    return published(df, cols, "oracle_votes_id", "fact_oracle_votes_id", "_unique_key")


def dim_labels(labels: DataFrame) -> DataFrame:
    return labels.select("blockchain", "creator", "address", "label_type", "label_subtype", F.col("project_name").alias("label"), "address_name",
                         F.col("labels_combined_id").alias("dim_labels_id"), "inserted_timestamp", "modified_timestamp")


def dim_tokens(assets: DataFrame) -> DataFrame:
    return published(assets, ["currency", "decimals", "token_name", "symbol"], "asset_metadata_id", "dim_tokens_id", "currency")


def chain_labels(shared: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Labels of this chain, merged into the stored ones, soft-deleted rows removed."""
    mine = shared.filter(F.col("blockchain") == V.CHAIN)
    merged = mine if stored is None else inc.merge_upsert(stored, mine, ["labels_combined_id"])
    return inc.post_delete(merged, F.col("_is_deleted"))
