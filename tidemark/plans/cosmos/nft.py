"""NFT sales of two marketplaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ...functions.coins import BASE_DENOM
from ...operators.joins import hourly
from ...operators.sets import union_all
from ...operators.windows import dedup_latest
from ..audit import keyed
from . import values as V
from .attrs import BLOCK, EVENT, GROUP, has, number, objects, of_type, tx_sender

SALE = [*BLOCK, "msg_group", "msg_sub_group", "msg_index", "event_type", "nft_address", "token_id", "buyer_address", "seller_address", "amount", "currency", "marketplace_contract"]


def sales_pallet(attrs: DataFrame, contract: str = V.MARKET_ONE) -> DataFrame:
    """Direct sales and accepted bids of the first marketplace.

    The buyer and seller come from the sale event, the token's transfer event, or the signer. Of a
    repeated attribute the first one counts.
    """
    kinds = ("wasm-buy_now", "wasm-accept_bid")
    rel = dedup_latest(of_type(attrs, *kinds, "wasm", "tx", "signer"), ["tx_id", "msg_index", "attribute_key"], ["attribute_index"])
    sale_txs = of_type(rel, *kinds).filter(has(None, "_contract_address", contract)).select("tx_id").distinct()
    in_sale = rel.join(sale_txs, "tx_id", "left_semi")
    names = {"nft_address": "_nft", "collection_address": "_collection", "nft_token_id": "_t1", "token_id": "_t2", "nft_seller": "_nft_seller", "buyer": "_buyer", "seller": "_seller",
             "sold_to": "_sold_to", "bidder": "_bidder", "_contract_address": "marketplace_contract", "sale_price": "_price"}
    sold = objects(of_type(in_sale, *kinds), [*EVENT, "msg_type"], names)
    raw = F.replace(F.replace(F.col("_price"), F.lit("native:"), F.lit("")), F.lit(f"{BASE_DENOM}:"), F.lit(""))
    sold = sold.withColumn("_raw", raw)
    names = {"sender": "marketplace_contract", "token_id": "_t2", "recipient": "_m_recipient", "buyer": "_m_buyer", "bidder": "_m_bidder", "_contract_address": "_nft"}
    moved = objects(of_type(in_sale, "wasm"), [*GROUP, "msg_index"], names).filter(F.col("marketplace_contract").isNotNull())
    moved = dedup_latest(moved, ["tx_id", "_nft", "_t2", "marketplace_contract"], ["msg_index"]).select("tx_id", "_nft", "_t2", "marketplace_contract", "_m_recipient", "_m_buyer", "_m_bidder")
    rows = sold.join(moved, ["tx_id", "_nft", "_t2", "marketplace_contract"], "left").join(tx_sender(rel, "_signer"), "tx_id")
    kind = F.when(F.col("msg_type") == kinds[0], F.lit("sale")).when(F.col("msg_type") == kinds[1], F.lit("bid_won"))
    # the amount is the first digit run wherever it stands; the unit is the text behind it
    digits = F.regexp_extract("_raw", "([0-9]+)", 1)
    unit = F.when(F.col("_price").contains(BASE_DENOM), F.lit(BASE_DENOM)).otherwise(F.expr("right(_raw, length(_raw) - length(regexp_extract(_raw, '([0-9]+)', 1)))"))
    out = rows.select(
        *EVENT, kind.alias("event_type"), F.coalesce("_nft", "_collection").alias("nft_address"), F.coalesce("_t1", "_t2").alias("token_id"),
        F.coalesce("_m_recipient", "_m_buyer", "_sold_to", "_buyer", "_bidder", "_m_bidder", "_signer").alias("buyer_address"),
        F.coalesce("_nft_seller", "_seller", "_signer").alias("seller_address"), digits.try_cast("decimal(38,0)").alias("amount"), unit.alias("currency"), "marketplace_contract")
    return keyed(out, "nft_sales_pallet_id", "tx_id", "msg_index")


def sales_dagora(attrs: DataFrame, contract: str = V.MARKET_TWO) -> DataFrame:
    """Sales of the second marketplace; token and collection come from one text 'token, collection'."""
    rel = of_type(attrs, "wasm-execute-exchange", "wasm")
    events = rel.filter(has(None, "_contract_address", contract)).select("tx_id", "msg_index").distinct()
    rel = rel.join(events, ["tx_id", "msg_index"], "left_semi")
    sold = objects(of_type(rel, "wasm-execute-exchange"), [*EVENT, "msg_type"], {"buyer": "buyer_address", "seller": "seller_address", "_contract_address": "marketplace_contract", "amount": "amount", "token": "currency"})
    about = objects(of_type(rel, "wasm"), [*GROUP, "msg_index"], {"action": "_action", "_contract_address": "marketplace_contract", "nft": "_nft"}).filter(F.col("_action").isNull())
    about = about.select(*GROUP, "marketplace_contract", F.split_part("_nft", F.lit(", "), F.lit(1)).alias("token_id"), F.split_part("_nft", F.lit(", "), F.lit(2)).alias("nft_address"))
    rows = sold.join(about, [*GROUP, "marketplace_contract"], "left").withColumn("event_type", F.lit("sale")).withColumn("amount", number("amount"))
    return keyed(rows.select(*SALE), "nft_sales_dagora_id", "tx_id", "msg_index")


def sales_combined(by_platform: dict[str, DataFrame]) -> DataFrame:
    parts = [df.select(*SALE).withColumnRenamed("marketplace_contract", "platform_address").withColumn("platform_name", F.lit(name)) for name, df in by_platform.items()]
    return keyed(union_all(parts), "nft_sales_combined_id", "tx_id", "msg_index")


def fact_nft_sales(combined: DataFrame) -> DataFrame:
    return combined.withColumnsRenamed({"amount": "amount_raw", "nft_sales_combined_id": "fact_nft_sales_id"})


def ez_nft_sales(facts: DataFrame, tokens: DataFrame, chain_prices: DataFrame, contract_names: DataFrame, price_id: str = V.PRICE_ID) -> DataFrame:
    """Sales with decimals, USD value at the chain coin's hourly close, and the collection's name."""
    dim = tokens.select("currency", "decimals")
    prices = chain_prices.filter(F.col("id") == price_id).withColumn("token", F.lit("chain"))
    names = contract_names.select(F.col("contract_address").alias("nft_address"), F.try_variant_get(F.try_parse_json("data"), "$.data.name", "string").alias("project_name"))
    rows = hourly(facts.withColumn("_chain", F.lit("chain")), prices, "_chain", "block_timestamp", "token", "recorded_hour", ("close",))
    rows = rows.join(dim, "currency", "left").join(names, "nft_address", "left")
    rows = rows.withColumn("amount", F.col("amount_raw").cast("double") / F.pow(F.lit(10.0), F.col("decimals")))
    return rows.select(*BLOCK, "msg_group", "msg_sub_group", "msg_index", "event_type", "buyer_address", "seller_address", "nft_address", "token_id", "project_name",
                       "platform_address", "platform_name", "amount", (F.col("amount") * F.col("close")).alias("amount_usd"), "currency", F.col("fact_nft_sales_id").alias("ez_nft_sales_id"))
