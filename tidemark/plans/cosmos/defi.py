"""Swaps, liquidity actions and bridge events of the message side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.coins import coin_amount, coin_denom
from ...functions.common import newest, oldest
from ...operators.joins import hourly
from ...operators.rows import json_project
from ...operators.sets import union_all
from ...operators.windows import broadcast_agg, dedup_latest
from ..audit import keyed, published
from . import values as V
from .attrs import BLOCK, EVENT, GROUP, STAMP, both, fee_payer, groups_calling, groups_doing, has, number, objects, of_type, tx_sender, with_coin

SWAP = [*BLOCK, "swapper", "msg_group", "msg_sub_group", "msg_index", "amount_in", "currency_in", "amount_out", "currency_out", "pool_address", "pool_name"]
LP = [*BLOCK, "msg_group", "msg_sub_group", "msg_index", "liquidity_provider_address", "lp_action", "pool_address", "pool_name",
      "token1_amount", "token1_currency", "token2_amount", "token2_currency", "lp_token_amount", "lp_token_address"]


def numbers(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: number(n) for n in names})


def first_of_key(attrs: DataFrame) -> DataFrame:
    """First value of a repeated key within an event."""
    return dedup_latest(attrs, ["tx_id", "msg_index", "attribute_key"], ["attribute_index"])


# --- pools ----------------------------------------------------------------------------------------


def pair_pools(attrs: DataFrame, created: DataFrame, factory: str = V.PAIR_FACTORY) -> DataFrame:
    """Pool and share-token addresses from transactions that both created a contract and called the factory."""
    day = F.to_date("block_timestamp").alias("_day")
    made = created.select(F.col("init_tx_id").alias("tx_id"), F.to_date("init_by_block_timestamp").alias("_day")).distinct()
    called = attrs.filter(has("execute", "_contract_address", factory)).select("tx_id", day).distinct()
    kinds = ["liquidity_token_addr", "pair_contract_addr"]
    rel = of_type(attrs, "wasm").filter(F.col("attribute_key").isin(*kinds, "action")).withColumn("_day", F.to_date("block_timestamp"))
    rel = rel.join(both(made, called), ["tx_id", "_day"], "left_semi").drop("_day")
    action = F.max(F.when(F.col("attribute_key") == "action", F.col("attribute_value")))
    rel = broadcast_agg(rel, ["tx_id", "msg_index"], _action=action)
    live = ~F.coalesce("_action", F.lit("")).isin("deregister", "deactivate_pool") & F.col("attribute_key").isin(*kinds)
    out = rel.filter(live).select(*BLOCK, F.col("attribute_value").alias("contract_address"), F.col("attribute_key").alias("type"), STAMP)
    return keyed(out, "dex_metadata_astroport_id", "contract_address")


def listed_pools(raw: DataFrame) -> DataFrame:
    """Newest listing per pool."""
    rest = sorted(c for c in raw.columns if c not in (STAMP, "pool_address"))
    return keyed(dedup_latest(raw, ["pool_address"], [newest(STAMP), *[oldest(c) for c in rest]]), "dex_metadata_seaswap_id", "pool_address")


def pair_contracts(pools: DataFrame, contracts: DataFrame) -> DataFrame:
    named = contracts.select("contract_address", F.col("label").alias("pool_name"))
    return pools.filter("type = 'pair_contract_addr'").select("contract_address").distinct().join(named, "contract_address", "left")


def labelled(contracts: DataFrame, pattern: str) -> DataFrame:
    return contracts.filter(F.col("label").ilike(pattern)).select("contract_address", F.col("label").alias("pool_name"))


# --- swaps ----------------------------------------------------------------------------------------


def swaps_astroport(attrs: DataFrame, pools: DataFrame, contracts: DataFrame) -> DataFrame:
    """Swap events of groups that call a pool and carry a swap action; the fee payer is the swapper."""
    rel = pair_contracts(pools, contracts)
    txs = first_of_key(attrs)
    groups = both(groups_calling(txs, rel), groups_doing(txs, "swap"))
    wasm = of_type(txs, "wasm").filter("attribute_key <> 'action'").join(groups, GROUP, "left_semi")
    names = {"_contract_address": "pool_address", "ask_asset": "currency_out", "offer_asset": "currency_in", "offer_amount": "amount_in", "return_amount": "amount_out",
             "commission_amount": "commission_amount", "maker_fee_amount": "maker_fee_amount", "spread_amount": "spread_amount"}
    legs = objects(wasm, EVENT, names).filter(F.col("currency_out").isNotNull())
    legs = numbers(legs, "amount_in", "amount_out", "commission_amount", "maker_fee_amount", "spread_amount")
    paid = fee_payer(txs, "swapper").join(groups.select("tx_id").distinct(), "tx_id", "left_semi")
    rows = legs.join(paid, "tx_id").join(rel.withColumnRenamed("contract_address", "pool_address"), "pool_address")
    return keyed(rows.select(*SWAP, "commission_amount", "maker_fee_amount", "spread_amount", STAMP), "dex_swaps_astroport_id", "tx_id", "msg_index")


def swaps_fuzio(attrs: DataFrame, contracts: DataFrame) -> DataFrame:
    """Swap events; the incoming unit is that of the transfer of the same amount before the event, the
    outgoing one that of a transfer after it. Of equal transfers the first counts."""
    rel = labelled(contracts, "Fuzio%Pool%")
    keys = [*GROUP, "msg_index"]
    txs = of_type(attrs, "wasm", "transfer", "tx")
    marks = txs.filter(has("wasm", "action", "swap") | has("wasm", "native_transferred")).select(*keys).distinct()
    events = both(groups_calling(txs, rel, keys, "wasm"), marks)
    names = {"_contract_address": "pool_address", "native_sold": "_i1", "input_token_amount": "_i2", "token_bought": "_o1", "native_transferred": "_o2"}
    wasm = objects(of_type(txs, "wasm").join(events.select("tx_id", "msg_index"), ["tx_id", "msg_index"], "left_semi"), EVENT, names)
    wasm = wasm.withColumn("amount_in", F.coalesce(number("_i1"), number("_i2"))).withColumn("amount_out", F.coalesce(number("_o1"), number("_o2")))
    groups = events.select(*GROUP).distinct()
    moves = with_coin(objects(of_type(txs, "transfer").join(groups, GROUP, "left_semi"), keys, {"amount": "_raw"}).drop(STAMP), "_raw")
    once = dedup_latest(moves, [*GROUP, "amount"], ["msg_index"])
    came = once.select(*GROUP, F.col("amount").alias("amount_in"), F.col("msg_index").alias("_in_at"), F.col("currency").alias("currency_in"))
    went = once.select(*GROUP, F.col("amount").alias("amount_out"), F.col("msg_index").alias("_out_at"), F.col("currency").alias("currency_out"))
    rows = wasm.join(came, [*GROUP, "amount_in"], "left").withColumn("currency_in", F.when(F.col("msg_index") > F.col("_in_at"), F.col("currency_in")))
    rows = rows.join(went, [*GROUP, "amount_out"], "left").withColumn("currency_out", F.when(F.col("msg_index") < F.col("_out_at"), F.col("currency_out")))
    paid = fee_payer(txs, "swapper").join(events.select("tx_id").distinct(), "tx_id", "left_semi")
    rows = rows.join(paid, "tx_id").join(rel.withColumnRenamed("contract_address", "pool_address"), "pool_address")
    return keyed(rows.select(*SWAP, STAMP), "dex_swaps_fuzio_id", "tx_id", "msg_index")


def swaps_seaswap(attrs: DataFrame, listed: DataFrame) -> DataFrame:
    """Swap events whose incoming amount the fee payer sent and whose outgoing amount they received, as a
    coin or as a contract token."""
    rel = listed.select(F.col("pool_address").alias("contract_address"), "pool_name")
    txs = groups_calling(attrs, rel, ["tx_id"])
    paid = fee_payer(attrs, "swapper").join(txs, "tx_id", "left_semi")
    names = {"_contract_address": "pool_address", "native_sold": "native_sold", "token_bought": "token_bought", "action": "action", "amount": "amount", "to": "_to"}
    wasm = numbers(objects(of_type(attrs, "wasm").join(paid, "tx_id"), [*EVENT, "swapper"], names), "native_sold", "token_bought", "amount")
    moves = objects(of_type(attrs, "transfer").join(paid, "tx_id"), [*GROUP, "msg_index", "swapper"], {"sender": "_sender", "recipient": "_recipient", "amount": "_raw"}).drop(STAMP)
    moves = with_coin(moves, "_raw")
    sent = moves.filter("_sender = swapper").select(*GROUP, F.col("amount").alias("native_sold"), F.col("amount").alias("amount_in"), F.col("currency").alias("currency_in")).distinct()
    got = moves.filter("_recipient = swapper").select(*GROUP, F.col("amount").alias("token_bought"), F.col("amount").alias("_x"), F.col("currency").alias("_xc")).distinct()
    got_token = wasm.filter("action = 'transfer' and _to = swapper").select(*GROUP, F.col("amount").alias("token_bought"), F.col("amount").alias("_w"), F.col("pool_address").alias("_wc")).distinct()
    rows = wasm.filter(F.col("native_sold").isNotNull()).join(sent, [*GROUP, "native_sold"]).join(got, [*GROUP, "token_bought"], "left").join(got_token, [*GROUP, "token_bought"], "left")
    rows = rows.withColumn("amount_out", F.coalesce("_x", "_w")).withColumn("currency_out", F.coalesce("_xc", "_wc")).filter(F.col("amount_out").isNotNull())
    rows = rows.join(rel.withColumnRenamed("contract_address", "pool_address"), "pool_address", "left")
    return keyed(rows.select(*SWAP, STAMP), "dex_swaps_seaswap_id", "tx_id", "msg_index")


def fact_dex_swaps(by_platform: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in by_platform.items():
        cols = [F.lit(name).alias("platform"), *SWAP]
        parts.append(published(df, cols, f"dex_swaps_{name}_id", "fact_dex_swaps_id", "tx_id", "msg_index"))
    return union_all(parts)


COMBINED = ["block_id", "block_timestamp", "tx_id", "originated_from", "platform", "swapper", "origin_from_address", "pool_address", "amount_in_unadj", "amount_in", "amount_in_usd",
            "amount_out_unadj", "amount_out", "amount_out_usd", "token_in", "symbol_in", "token_out", "symbol_out", "index", "swaps_combined_id"]


def _adjusted(raw: str, decimals: str) -> Column:
    return F.col(raw).cast("double") / F.pow(F.lit(10.0), F.col(decimals))


def swaps_combined(by_platform: dict[str, DataFrame], prices: DataFrame, tokens: DataFrame, addresses: DataFrame) -> DataFrame:
    """Three platforms in one shape with decimals, USD values and the EVM address of the swapper."""
    rows = union_all([
        df.select("block_id", "block_timestamp", "tx_id", F.lit(V.CHAIN).alias("originated_from"), F.lit(name).alias("platform"), "swapper", "pool_address",
                  F.col("amount_in").alias("amount_in_unadj"), F.col("amount_out").alias("amount_out_unadj"), F.col("currency_in").alias("token_in"),
                  F.col("currency_out").alias("token_out"), F.col("msg_index").alias("index"), F.col(f"dex_swaps_{name}_id").alias("swaps_combined_id"))
        for name, df in by_platform.items()])
    return _enrich_swaps(rows, prices, tokens, addresses).select(*COMBINED)


def _enrich_swaps(rows: DataFrame, prices: DataFrame, tokens: DataFrame, addresses: DataFrame) -> DataFrame:
    for side in ("in", "out"):
        dim = tokens.select(F.col("currency").alias(f"token_{side}"), F.col("decimals").alias(f"_d_{side}"), F.col("symbol").alias(f"symbol_{side}"))
        rows = rows.join(dim, f"token_{side}", "left")
        rows = hourly(rows, prices, f"token_{side}", "block_timestamp", "token_address", "hour", ("price",), f"_{side}_")
        rows = rows.withColumn(f"amount_{side}", _adjusted(f"amount_{side}_unadj", f"_d_{side}"))
        rows = rows.withColumn(f"amount_{side}_usd", F.col(f"amount_{side}") * F.col(f"_{side}_price"))
    who = addresses.select(F.col("native_address").alias("swapper"), F.col("evm_address").alias("origin_from_address"))
    return rows.join(who, "swapper", "left")


def heal_swaps(stored: DataFrame, prices: DataFrame, tokens: DataFrame, addresses: DataFrame) -> DataFrame:
    """Stored swaps with a gap that the newly arrived prices, token data or addresses can fill.

    Each side uses its own token's decimals. (The published job uses the input token's for both; that is
    an error there.)
    """
    gaps = ["origin_from_address", "amount_in", "amount_in_usd", "amount_out", "amount_out_usd", "symbol_in", "symbol_out"]
    needy = stored.filter(" or ".join(f"{g} is null" for g in gaps))
    fresh = _enrich_swaps(needy.drop(*gaps), prices, tokens, addresses).select("swaps_combined_id", *[F.col(g).alias(f"_n_{g}") for g in gaps])
    joined = needy.join(fresh, "swaps_combined_id")
    better = " or ".join(f"({g} is null and _n_{g} is not null)" for g in gaps)
    filled = [F.coalesce(c, f"_n_{c}").alias(c) if c in gaps else F.col(c) for c in stored.columns]
    return joined.filter(better).select(*filled)


# --- liquidity ------------------------------------------------------------------------------------


def lp_astroport(attrs: DataFrame, pools: DataFrame, contracts: DataFrame) -> DataFrame:
    """Adding and removing liquidity: two coins from one text, the share token from the mint or burn of the
    same amount."""
    rel = pair_contracts(pools, contracts)
    acts = ["provide_liquidity", "mint", "withdraw_liquidity", "burn"]
    groups = both(groups_calling(attrs, rel), groups_doing(attrs, *acts))
    noise = F.col("attribute_key").isin("user", "claimed_reward", "claimed_finished_reward")
    other = (F.col("attribute_key") == "action") & ~F.col("attribute_value").isin(*acts)
    rows = of_type(attrs, "wasm").filter(~noise & ~other).join(groups, GROUP, "left_semi")
    names = {"_contract_address": "contract_address", "action": "action", "sender": "_sender", "receiver": "_receiver", "to": "_to", "assets": "_a1",
             "refund_assets": "_a2", "share": "_s1", "withdrawn_share": "_s2", "amount": "amount"}
    wasm = objects(rows, EVENT, names).filter(F.col("action").isin(*acts)).withColumn("amount", number("amount"))
    wasm = wasm.withColumn("lp_token_amount", F.coalesce(number("_s1"), number("_s2"))).withColumn("_assets", F.coalesce("_a1", "_a2"))
    wasm = wasm.withColumn("token1_raw", F.split_part("_assets", F.lit(","), F.lit(1))).withColumn("token2_raw", F.regexp_replace(F.split_part("_assets", F.lit(","), F.lit(2)), "(?s)^.", ""))
    shares = dedup_latest(wasm.filter(F.col("action").isin("mint", "burn")), [*GROUP, "amount"], ["msg_index"])
    shares = shares.select(*GROUP, F.col("amount").alias("lp_token_amount"), F.col("contract_address").alias("lp_token_address"))
    moves = wasm.filter(F.col("action").isin("provide_liquidity", "withdraw_liquidity")).join(shares, [*GROUP, "lp_token_amount"])
    moves = moves.join(rel, "contract_address").join(tx_sender(attrs, "_signer"), "tx_id")
    out = moves.select(
        *EVENT, F.coalesce("_sender", "_to", "_receiver", "_signer").alias("liquidity_provider_address"), F.col("action").alias("lp_action"),
        F.col("contract_address").alias("pool_address"), "pool_name", coin_amount("token1_raw").alias("token1_amount"), coin_denom("token1_raw").alias("token1_currency"),
        coin_amount("token2_raw").alias("token2_amount"), coin_denom("token2_raw").alias("token2_currency"), "lp_token_amount", "lp_token_address", STAMP)
    return keyed(out, "lp_actions_astroport_id", "tx_id", "msg_index")


_TWO_TOKENS = {"_contract_address": "contract_address", "action": "action", "token1_amount": "_p1", "token2_amount": "_p2", "token1_returned": "_r1", "token2_returned": "_r2",
               "liquidity_received": "_lin", "liquidity_burned": "_lout", "to": "_to", "from": "_from"}


def _two_token_actions(attrs: DataFrame, rel: DataFrame, acts: list[str]) -> tuple[DataFrame, DataFrame]:
    """Events of the groups and the account of their mint or burn."""
    groups = both(groups_calling(attrs, rel), groups_doing(attrs, *acts))
    wasm = objects(of_type(attrs, "wasm").join(groups, GROUP, "left_semi"), EVENT, _TWO_TOKENS)
    who = wasm.filter(F.col("action").isin("mint", "burn_from")).select(*GROUP, F.coalesce("_to", "_from").alias("liquidity_provider_address"))
    wasm = wasm.withColumn("token1_amount", F.coalesce(number("_p1"), number("_r1"))).withColumn("token2_amount", F.coalesce(number("_p2"), number("_r2")))
    return wasm.withColumn("lp_token_amount", F.coalesce(number("_lin"), number("_lout"))), who


def lp_fuzio(attrs: DataFrame, contracts: DataFrame, contract_info: DataFrame) -> DataFrame:
    rel = labelled(contracts, "Fuzio%")
    fields = {"lp_token_address": (["$.lp_token_address"], "string"), "token1_currency": (["$.token1_denom.native"], "string"), "token2_currency": (["$.token2_denom.native"], "string")}
    info = json_project(contract_info, "data", fields, ["contract_address"])
    wasm, who = _two_token_actions(attrs, rel, ["add_liquidity", "mint", "remove_liquidity", "burn_from"])
    rows = wasm.filter(F.col("action").isin("add_liquidity", "remove_liquidity")).join(who, GROUP).join(rel, "contract_address").join(info, "contract_address")
    out = rows.withColumn("lp_action", F.col("action")).withColumn("pool_address", F.col("contract_address")).select(*LP, STAMP)
    return keyed(out, "lp_actions_fuzio_id", "tx_id", "msg_index")


def lp_seaswap(attrs: DataFrame, listed: DataFrame) -> DataFrame:
    rel = listed.select(F.col("pool_address").alias("contract_address"), "pool_name", F.col("token1_denom").alias("token1_currency"), F.col("token2_denom").alias("token2_currency"), "lp_token_address")
    wasm, who = _two_token_actions(attrs, rel, ["mint", "burn_from"])
    rows = wasm.filter(F.col("lp_token_amount").isNotNull()).join(who, GROUP).join(rel, "contract_address")
    act = F.when(F.col("_lin").isNotNull(), F.lit("add_liquidity")).when(F.col("_lout").isNotNull(), F.lit("remove_liquidity"))
    out = rows.withColumn("lp_action", act).withColumn("pool_address", F.col("contract_address")).select(*LP, STAMP)
    return keyed(out, "lp_actions_seaswap_id", "tx_id", "msg_index")


def lp_levana(attrs: DataFrame, contracts: DataFrame, contract_status: DataFrame, scale: dict[str, int] = V.COLLATERAL_DECIMALS) -> DataFrame:
    """Deposits and withdrawals of one market platform, collateral scaled per contract."""
    rel = labelled(contracts, "Levana%")
    fields = {"token1_currency": (["$.collateral.native.denom"], "string"), "market_id": (["$.config.market_id"], "string")}
    info = json_project(contract_status, "data", fields, ["contract_address"])
    txs = attrs.filter(F.col("msg_type").ilike("wasm%lp%"))
    called = txs.filter(has(None, "_contract_address")).select("tx_id", "msg_index", F.col("attribute_value").alias("contract_address"))
    events = called.join(rel.select("contract_address"), "contract_address", "left_semi").select("tx_id", "msg_index").distinct()
    names = {"_contract_address": "contract_address", "addr": "liquidity_provider_address", "kind": "lp_action", "collateral": "_c", "tokens": "_t"}
    wasm = objects(txs.join(events, ["tx_id", "msg_index"], "left_semi"), [*EVENT, "msg_type"], names).filter(F.col("lp_action").isNotNull())
    amount = F.col("_c").try_cast("double")
    scaled = amount
    for contract, digits in scale.items():
        scaled = F.when(F.col("contract_address") == contract, amount * 10.0**digits).otherwise(scaled)
    none = F.lit(None).cast("string")
    rows = wasm.join(rel, "contract_address").join(info, "contract_address")
    out = rows.select(
        *EVENT, "liquidity_provider_address", "lp_action", F.col("contract_address").alias("pool_address"), F.coalesce("pool_name", "market_id").alias("pool_name"),
        scaled.alias("token1_amount"), "token1_currency", F.lit(None).cast("double").alias("token2_amount"), none.alias("token2_currency"),
        F.col("_t").try_cast("double").alias("lp_token_amount"), none.alias("lp_token_address"), STAMP)
    return keyed(out, "lp_actions_levana_id", "tx_id", "msg_index")


def _share_contracts(contracts: DataFrame, contract_config: DataFrame):
    config = json_project(contract_config, "data", {"pool_address": (["$.lp_token_contract"], "string")}, ["contract_address"])
    named = contracts.select(F.col("contract_address").alias("pool_address"), F.col("label").alias("pool_name"))
    rel = contracts.filter(F.col("label").ilike("Fuzio%")).select("contract_address", F.col("label").alias("staking_pool_name"))
    return rel, rel.join(config, "contract_address").join(named, "pool_address")


def lp_staking_fuzio(attrs: DataFrame, contracts: DataFrame, contract_config: DataFrame) -> DataFrame:
    """Bonding and unbonding of share tokens."""
    rel, full = _share_contracts(contracts, contract_config)
    groups = both(groups_calling(attrs, rel), groups_doing(attrs, "bond", "unbond"))
    wasm = objects(of_type(attrs, "wasm").join(groups, GROUP, "left_semi"), EVENT, {"_contract_address": "contract_address", "action": "lp_staking_action", "owner": "liquidity_provider_address", "amount": "amount"})
    rows = wasm.filter(F.col("lp_staking_action").isin("bond", "unbond")).withColumn("amount", number("amount")).join(full, "contract_address")
    return rows.select(*EVENT, "liquidity_provider_address", "lp_staking_action", F.col("contract_address").alias("staking_pool_address"), "staking_pool_name", "amount", "pool_address", "pool_name", STAMP)


def lp_staking_rewards_fuzio(attrs: DataFrame, contracts: DataFrame, contract_config: DataFrame) -> DataFrame:
    """Reward withdrawals: the withdrawing event of a staking contract and the coin sent from it."""
    rel, full = _share_contracts(contracts, contract_config)
    groups = both(groups_calling(attrs, rel), groups_doing(attrs, "withdraw"))
    near = of_type(attrs, "wasm", "transfer").join(groups, GROUP, "left_semi")
    names = {"_contract_address": "contract_address", "action": "lp_reward_action", "owner": "liquidity_provider_address", "amount": "_raw", "sender": "_sender", "recipient": "_recipient"}
    rows = objects(near, [*EVENT, "msg_type"], names)
    took = rows.filter(F.col("liquidity_provider_address").isNotNull()).drop("_raw", "_sender", "_recipient", "msg_type")
    paid = rows.filter(F.col("_recipient").isNotNull()).select(*GROUP, F.col("_sender").alias("contract_address"), F.col("_recipient").alias("liquidity_provider_address"), "_raw")
    hit = took.join(paid, [*GROUP, "contract_address", "liquidity_provider_address"]).join(full, "contract_address")
    return with_coin(hit, "_raw", "reward_amount", "reward_currency").select(
        *EVENT, "liquidity_provider_address", "lp_reward_action", F.col("contract_address").alias("staking_pool_address"), "staking_pool_name", "reward_amount", "reward_currency", "pool_address", "pool_name", STAMP)


# Fixed value: the published names of each platform's actions.
LP_ACTIONS = {
    "astroport": {"provide_liquidity": "add_liquidity", "withdraw_liquidity": "remove_liquidity"},
    "levana": {"deposit-lp": "add_liquidity", "deposit-xlp": "add_liquidity", "reinvest-yield-lp": "add_liquidity", "reinvest-yield-xlp": "add_liquidity", "withdraw": "remove_liquidity"},
}


def fact_lp_actions(by_platform: dict[str, DataFrame]) -> DataFrame:
    """Four platforms with one set of action names; one platform's other actions are left out."""
    parts = []
    for name, df in by_platform.items():
        recode = LP_ACTIONS.get(name)
        if recode:
            if name == "levana":
                df = df.filter(F.col("lp_action").isin(*recode))
            action = F.lit(None).cast("string")
            for old, new in recode.items():
                action = F.when(F.col("lp_action") == old, F.lit(new)).otherwise(action)
            df = df.withColumn("lp_action", action)
        df = df.withColumns({c: F.col(c).cast("double") for c in ("token1_amount", "token2_amount")})
        cols = [F.lit(name).alias("platform"), *[c for c in LP if c != "lp_token_amount"]]
        parts.append(published(df, cols, f"lp_actions_{name}_id", "fact_lp_actions_id", "tx_id", "msg_index"))
    return union_all(parts)


# --- bridge ---------------------------------------------------------------------------------------


def _bridge_events(attrs: DataFrame, contract: str, types: tuple[str, ...] = ("wasm",)) -> DataFrame:
    """Attributes of the events that name the bridge contract."""
    hit = of_type(attrs, "wasm").filter(has("wasm", "_contract_address", contract)).select("tx_id", "msg_index", F.to_date("block_timestamp").alias("_day")).distinct()
    return of_type(attrs, *types).withColumn("_day", F.to_date("block_timestamp")).join(hit, ["tx_id", "msg_index", "_day"], "left_semi").drop("_day")


def bridge_assets(attrs: DataFrame, contract: str = V.BRIDGE_CONTRACT) -> DataFrame:
    """Registered assets, newest registration per (address, chain)."""
    rows = objects(_bridge_events(attrs, contract), [*BLOCK, "msg_index"], {"_contract_address": "contract_address", "action": "action", "token_address": "token_address", "token_chain": "token_chain"})
    rows = rows.filter("action = 'register_asset'").withColumn("token_chain", number("token_chain").cast("bigint"))
    return dedup_latest(rows, ["token_address", "token_chain"], [newest("block_timestamp"), newest("tx_id"), newest("msg_index")])


def bridge_chains(attrs: DataFrame, chain_ids: DataFrame, contract: str = V.BRIDGE_CONTRACT) -> DataFrame:
    """Registered chains with their names, newest registration per chain."""
    rows = objects(_bridge_events(attrs, contract), [*BLOCK, "msg_index"], {"_contract_address": "contract_address", "chain_address": "chain_address", "chain_id": "chain_id"})
    rows = rows.filter(F.col("chain_address").isNotNull() & F.col("chain_id").isNotNull())
    latest = dedup_latest(rows, ["chain_id"], [newest("block_timestamp"), newest("tx_id"), newest("msg_index")])
    names = chain_ids.select(F.col("wormhole_chain_id").cast("string").alias("chain_id"), "chain_name", F.col("address").alias("foreign_address"))
    return latest.join(names, "chain_id", "left")


BURN_FIELDS = {
    "from": "from_address", "transfer.amount": "transfer_amount", "transfer.block_time": "transfer_block_time", "transfer.nonce": "transfer_nonce", "transfer.recipient": "transfer_recipient",
    "transfer.recipient_chain": "transfer_recipient_chain", "transfer.sender": "transfer_sender", "transfer.token": "transfer_token", "transfer.token_chain": "transfer_token_chain",
    "message.message": "message_message", "message.nonce": "message_nonce", "message.sender": "message_sender", "message.sequence": "message_sequence",
}


def bridge_burns(attrs: DataFrame, contract: str = V.BRIDGE_CONTRACT) -> DataFrame:
    """Outgoing bridge transfers: transactions that name the bridge and burn, one row per group and amount,
    with the group's contracts and actions as sorted arrays."""
    wasm = of_type(attrs, "wasm").withColumn("_day", F.to_date("block_timestamp"))
    named = wasm.filter(has("wasm", "_contract_address", contract)).select("tx_id", "_day").distinct()
    burned = wasm.filter(has("wasm", "action", "burn_from")).select("tx_id", "_day").distinct()
    rel = wasm.join(both(named, burned), ["tx_id", "_day"], "left_semi").drop("_day")
    body = rel.filter(~F.col("attribute_key").isin("_contract_address", "action", "amount"))
    rows = objects(body, [*BLOCK, "msg_group", "msg_sub_group"], BURN_FIELDS)
    rows = numbers(rows, "transfer_amount", "transfer_block_time", "transfer_nonce", "transfer_recipient_chain", "transfer_token_chain", "message_nonce", "message_sequence")

    def arrays(key, out):
        # distinct values of one message group: combined map-side, and few
        return rel.filter(F.col("attribute_key") == key).groupBy(*GROUP).agg(F.array_sort(F.collect_set("attribute_value")).alias(out))

    amount = rel.filter("attribute_key = 'amount'").select(*GROUP, F.col("attribute_value").alias("amount")).distinct()
    return rows.join(arrays("_contract_address", "contract_address_array"), GROUP).join(arrays("action", "action_array"), GROUP).join(amount, GROUP)


def bridge_mints(attrs: DataFrame, contract: str = V.BRIDGE_CONTRACT) -> DataFrame:
    """Completed incoming transfers with the account the middle recipient paid."""
    names = {"_contract_address": "contract_address", "action": "action", "amount": "amount", "contract": "token_contract", "fee": "fee", "recipient": "recipient_middle", "relayer": "relayer"}
    rows = objects(_bridge_events(attrs, contract, ("wasm", "transfer")), [*BLOCK, "msg_index"], names).filter("action = 'complete_transfer_wrapped'")
    rows = numbers(rows, "amount", "fee").withColumn("_day", F.to_date("block_timestamp"))
    paid = objects(of_type(attrs, "transfer").withColumn("_day", F.to_date("block_timestamp")), ["_day", "tx_id", "msg_index"], {"sender": "recipient_middle", "amount": "amount_raw", "recipient": "recipient"})
    return rows.join(paid.drop("msg_index", STAMP), ["_day", "tx_id", "recipient_middle"]).drop("_day")
