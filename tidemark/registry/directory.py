"""Addresses, assets, contracts, offers and worklists: what the other tables are named and filled by."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..plans import prices as pr, worklists as wl
from ..plans.cosmos import core, nft, values as V
from .base import VIEWS, block_of, query
from .chain import blocks, kv
from .evm import addr, address, lines
from .exchanges import attributes, k, text, user

OLD, NEW = datetime(2020, 1, 1), datetime(2030, 1, 1)
STAMP = "_inserted_timestamp"


def versions(rows, **old):
    """Rows that came twice; the older ones carry other values."""
    older = rows.withColumns({**{c: F.lit(v) for c, v in old.items()}, STAMP: F.lit(OLD)})
    return rows.withColumn(STAMP, F.lit(NEW)).unionByName(older)


# --- addresses ------------------------------------------------------------------------------------


VIEWS.update({
    "a_chain": "select 'a' || kk as native, lower(arg_min('0X' || event_id, row(block_timestamp, block_id, tx_id, msg_index))) as evm, arg_min(block_id, row(block_timestamp, block_id, tx_id, msg_index)) as block_id from d_buy where tx_succeeded group by 1",
    "a_api": "select 'a' || c_custkey as native, '0x' || c_custkey as evm, arg_min(block_id, row(ts, block_id)) as block_id from v_msgs join customer on c_custkey = user_id group by c_custkey",
})


@query("chain_address_mapping", "select native as native_address, evm as evm_address, block_id as block_id_associated from a_chain union all select native, evm, block_id from a_api where native not in (select native from a_chain)")
def q_mapping(t):
    """Associations on chain, and the API's answers for addresses without one."""
    pair = kv(("sei_addr", text("a", k())), ("evm_addr", text("0X", F.col("event_id"))))
    onchain = core.address_mapping_onchain(attributes(t, "associations", (F.lit("address_associated"), pair), (F.lit("other"), kv(("x", F.lit("y"))))))
    key = F.col("c_custkey")
    raw = versions(t.customer.select(F.to_json(F.struct(text("0x", key).alias("EVM_ADDRESS"))).alias("value"), F.to_json(F.struct(text("a", key).alias("result"))).alias("data")), data='{"result":"old"}')
    used = t.events.select(text("0x", F.col("user_id")).alias("from_address"), F.col("ts").alias("block_timestamp"), block_of("ts").alias("block_number"))
    api = core.address_mapping_api(raw, wl.evm_addresses(used))
    return core.dim_address_mapping(onchain, api).select("native_address", "evm_address", "block_id_associated")


# --- assets and contracts -------------------------------------------------------------------------


@query("chain_asset_metadata", """with s as (select 'c' || p_partkey as currency, p_size as decimals, p_name as token_name, p_brand as symbol, 1 as r from part where p_partkey % 2 = 0 and p_partkey % 10 <> 0 union all select 'ibc/' || s_suppkey, 6, s_name, 'S' || s_nationkey, 2 from supplier
    union all select 'c' || p_partkey, 9, 'listed', 'L' || p_size, 3 from part where p_partkey % 3 = 0 union all select 'ibc/' || p_partkey, 9, 'listed', 'L' || p_size, 3 from part where p_partkey % 3 = 0)
    select currency, arg_min(decimals, r) as decimals, arg_min(token_name, r) as token_name, arg_min(symbol, r) as symbol, md5(currency) as asset_metadata_id from s group by currency""")
def q_assets(t):
    """Token answers before the shared list before the price list; answers of exchange rates are no tokens."""
    n = F.col("p_partkey")
    rate = F.when(n % 10 == 0, F.lit("8")).alias("exchange_rate_decimals")
    own = t.part.filter(n % 2 == 0).select(text("c", n).alias("contract_address"), F.to_json(F.struct(F.col("p_size").alias("decimals"), F.col("p_name").alias("name"), F.col("p_brand").alias("symbol"), rate)).alias("data"))
    shared = t.supplier.select(F.explode(F.array(text("ibc/", F.col("s_suppkey")), text("0x", F.col("s_suppkey")))).alias("address"), F.lit(6).alias("decimal"), F.col("s_name").alias("label"), text("S", F.col("s_nationkey")).alias("project_name"))
    third = t.part.filter(n % 3 == 0)
    listed = third.select(F.explode(F.array(text("c", n), text("ibc/", n))).alias("contract_address"), F.lit(9).alias("decimals"), F.lit("listed").alias("name"), text("L", F.col("p_size")).alias("symbol"))
    return core.asset_metadata(own, shared, listed).select("currency", "decimals", "token_name", "symbol", "asset_metadata_id")


@query("chain_contracts", """with x as (select tx_id, max(ts) as seen from c_ev group by 1), i as (select 'i' || (event_id % 500) as contract_address, arg_max(block_timestamp, row(seen, d.tx_id)) as made from d_buy d join x on x.tx_id = d.tx_id group by 1)
    select i.contract_address, c_name as label, coalesce('adm' || c_custkey, if(s_suppkey is null, null, 'own' || s_suppkey)) as admin, strftime(made, '%Y-%m-%d %H:%M:%S') as init_by_block_timestamp
    from i left join customer on c_custkey % 2 = 0 and 'i' || c_custkey = i.contract_address left join supplier on 'i' || s_suppkey = i.contract_address""")
def q_contracts(t):
    """Created contracts with the names of the list, then those of the label answers; a list's newest page counts."""
    attrs = attributes(t, "instantiations", (F.lit("instantiate"), kv(("_contract_address", text("i", F.col("event_id") % 500)))), (F.lit("other"), kv(("x", F.lit("y")))))
    none = F.lit(None).cast("string")
    listed = versions(t.customer.filter("c_custkey % 2 = 0").select(text("i", F.col("c_custkey")).alias("contract_address"), text("adm", F.col("c_custkey")).alias("admin"), none.alias("init_by_account_address"), F.col("c_name").alias("label")), label="old", admin="old")
    named = t.supplier.select(text("i", F.col("s_suppkey")).alias("contract_address"), text("own", F.col("s_suppkey")).alias("admin"), none.alias("init_by_account_address"), none.alias("label"), F.lit(OLD).alias(STAMP))
    return core.contracts(core.contracts_instantiate(attrs), listed, named).select("contract_address", "label", "admin", "init_by_block_timestamp")


@query("chain_contract_answers", """select 'c' || p_partkey as contract_address, if(p_size > 25, '{"size":' || p_size || '}', null) as data, if(p_size > 25, null, 'E' || p_size) as code from part""")
def q_answers(t):
    """The newest answer of each contract, a body or an error."""
    good = F.col("p_size") > 25
    body = F.struct(F.when(good, F.struct(F.col("p_size").alias("size"))).alias("data"), F.when(~good, text("E", F.col("p_size"))).alias("code"))
    raw = versions(t.part.select(text("c", F.col("p_partkey")).alias("contract_address"), F.to_json(F.struct(body.alias("data"))).alias("data")), data='{"data":{"code":"old"}}')
    return core.contract_payload(raw, "contract_info_id").select("contract_address", "data", "code")


@query("price_asset_metadata", f"""with t as (select {addr('p_partkey')} as token_address, 'P' || p_partkey as asset_id, lower(p_brand) as symbol, p_size as decimals, p_partkey, false as is_native from part union all select 'usei', 'sei-network', 'SEI', 6, null, true)
    select token_address, asset_id, coalesce(if(p_partkey % 5 = 0, 'D' || p_partkey, null), if(p_partkey % 3 = 0, 'C' || p_partkey, null), symbol) as symbol, coalesce(if(p_partkey % 5 = 0, 7, null), if(p_partkey % 3 = 0, 8, null), decimals) as decimals, is_native from t""")
def q_metadata(t):
    """Two providers name each token, the alphabetically first counts; the chain's own tables know better."""
    n = F.col("p_partkey")
    stamp = F.lit(OLD).cast("timestamp_ntz")
    stamps = [stamp.alias("inserted_timestamp"), stamp.alias("modified_timestamp")]
    base = [F.lit(False).alias("is_deprecated"), F.lit(True).alias("is_verified"), stamp.alias("is_verified_modified_timestamp"), F.lit("chain").alias("blockchain"), *stamps]
    one = t.part.select(address(n).alias("token_address"), text("P", n).alias("asset_id"), F.lower("p_brand").alias("symbol"), F.col("p_name").alias("name"), F.col("p_size").cast("int").alias("decimals"), F.lit("a").alias("provider"), F.lit("x").alias("complete_token_asset_metadata_id"), *base)
    two = one.withColumns({"provider": F.lit("b"), "symbol": F.lit("other")})
    native = t.region.filter("r_regionkey = 0").select(F.lit(V.PRICE_ID).alias("asset_id"), F.lit("SEI").alias("symbol"), F.lit("Sei").alias("name"), F.lit(6).alias("decimals"), F.lit("y").alias("complete_native_asset_metadata_id"), *base)
    own = t.part.filter(n % 5 == 0).select(address(n).alias("currency"), text("D", n).alias("symbol"), F.lit("d").alias("token_name"), F.lit(7).alias("decimals"))
    contracts = t.part.filter(n % 3 == 0).select(address(n).alias("address"), text("C", n).alias("symbol"), F.lit("c").alias("name"), F.lit(8).alias("decimals"))
    out = pr.ez_asset_metadata(one.unionByName(two), native, own, contracts)
    return out.select("token_address", "asset_id", "symbol", F.col("decimals").cast("bigint").alias("decimals"), "is_native")


# --- offers ---------------------------------------------------------------------------------------


def offers(t):
    """Direct sales and accepted bids; errors move tokens on behalf of the market."""
    token = text("t", k() % 5)
    price = F.when(k() % 2 == 0, F.concat(F.lit("native:usei:"), k().cast("string"))).otherwise(F.concat(k().cast("string"), F.lit("ub")))
    sale = kv(("_contract_address", F.when(k() < 80, "market").otherwise("else")), ("nft_address", text("col", k() % 3)), ("nft_token_id", token), ("token_id", token), ("nft_seller", F.when(k() % 4 < 2, user("s"))), ("sale_price", price), ("sold_to", F.when(k() % 3 == 0, user("b"))))
    moved = kv(("_contract_address", text("col", k() % 3)), ("sender", F.lit("market")), ("token_id", token), ("recipient", user("r")))
    attrs = attributes(t, "offer_attributes", (F.when(k() % 2 == 0, "wasm-buy_now").otherwise("wasm-accept_bid"), sale), (F.lit("wasm"), moved))
    return nft.sales_pallet(attrs, "market")


VIEWS["o_sale"] = """select w.tx_id, w.msg_index, w.block_timestamp, if(kk % 2 = 0, 'sale', 'bid_won') as event_type, 'col' || (kk % 3) as nft_address, 't' || (kk % 5) as token_id, coalesce(recipient, if(kk % 3 = 0, 'b' || user_id, null), signer) as buyer_address,
    coalesce(if(kk % 4 < 2, 's' || user_id, null), signer) as seller_address, kk as amount, if(kk % 2 = 0, 'usei', 'ub') as currency, if(kk < 80, 'market', 'else') as market from d_buy w join m_signer s on s.tx_id = w.tx_id
    left join (select tx_id, 'col' || (kk % 3) as nft, 't' || (kk % 5) as token, arg_min('r' || user_id, msg_index) as recipient from d_err group by 1, 2, 3) m on m.tx_id = w.tx_id and nft = 'col' || (kk % 3) and token = 't' || (kk % 5) and kk < 80
    where w.tx_id in (select tx_id from d_buy where kk < 80)"""


@query("nft_sales_offers", "select tx_id, msg_index, event_type, nft_address, token_id, buyer_address, seller_address, cast(amount as varchar) as amount, currency, market as marketplace_contract from o_sale")
def q_offers(t):
    return offers(t).select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "event_type", "nft_address", "token_id", "buyer_address", "seller_address", "amount", "currency", "marketplace_contract")


@query("nft_sales_valued", """select tx_id, msg_index, if(nft_address = 'col2', null, 'Set ' || substr(nft_address, 4)) as project_name, 'pallet' as platform_name, amount / power(10, if(currency = 'usei', 2, 1)) as amount,
    round(amount / power(10, if(currency = 'usei', 2, 1)) * close, 6) as amount_usd, currency from o_sale left join v_prices on token = 'click' and hour = date_trunc('hour', block_timestamp)""")
def q_valued(t):
    """Sales with decimals, the coin's hourly close and the names that collections answer."""
    decimals = t.spark.createDataFrame([("usei", 2), ("ub", 1)], "currency string, decimals int")
    closes = t.prices_hourly.filter("token = 'click'").select(F.lit(V.PRICE_ID).alias("id"), F.col("hour").alias("recorded_hour"), "close")
    n = F.col("r_regionkey")
    names = t.region.filter(n < 2).select(text("col", n).alias("contract_address"), F.to_json(F.struct(F.struct(text("Set ", n).alias("name")).alias("data"))).alias("data"))
    out = nft.ez_nft_sales(nft.fact_nft_sales(nft.sales_combined({"pallet": offers(t)})), decimals, closes, names)
    return out.select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "project_name", "platform_name", "amount", F.round("amount_usd", 6).alias("amount_usd"), "currency")


# --- worklists ------------------------------------------------------------------------------------


@query("worklist_counts", """with b as (select block_id from c_blk), r as (select unnest(range((select min(block_id) from b), (select max(block_id) from b) + 1)) as block_number)
    select block_number from r where block_number not in (select block_id from b where block_id % 7 <> 0) or block_number % 7 <> 0 and block_number % 11 = 0""")
def q_counts(t):
    """Some counts have not landed, others disagree with the chain's; answers have two shapes."""
    b = t.table("counted_blocks", lambda: blocks(t).select("block_id", "tx_count"))
    n = F.col("tx_count") + F.when(F.col("block_id") % 11 == 0, 1).otherwise(0)
    by_value = F.col("block_id") % 2 == 0
    asked = F.to_json(F.struct(F.struct(F.array(F.concat(F.lit("tx.height="), F.col("block_id").cast("string"))).alias("params")).alias("request")))
    raw = b.filter("block_id % 7 <> 0").select(
        F.when(by_value, F.to_json(F.struct(F.col("block_id").alias("BLOCK_NUMBER")))).otherwise("{}").alias("value"), F.when(by_value, "{}").otherwise(asked).alias("metadata"),
        F.when(by_value, F.to_json(F.struct(F.struct(n.cast("string").alias("total_count")).alias("result")))).otherwise(n.cast("string")).alias("data"), F.lit(OLD).alias(STAMP))
    ends = b.agg(F.min("block_id").alias("lo"), F.max("block_id").alias("hi")).first()
    metas = b.select("block_id", F.col("tx_count").cast("bigint").alias("num_txs"))
    return wl.counts_to_fetch(wl.expected_blocks(t.spark, ends["hi"], ends["lo"]), wl.fetched_counts(raw), metas).select("block_number")


@query("worklist_addresses", f"select distinct {addr('l_suppkey')} as evm_address from e_line join supplier on s_suppkey = l_suppkey where s_nationkey >= 10")
def q_addresses(t):
    """Sending addresses without an association on chain and without an answer."""
    used = lines(t).select(address("l_suppkey").alias("from_address"), F.col("ts").alias("block_timestamp"), "block_number")
    who = address("s_suppkey").alias("evm_address")
    raw = t.supplier.filter("s_nationkey between 5 and 9").select(F.to_json(F.struct(who)).alias("value"), F.lit(OLD).alias(STAMP))
    raw = raw.withColumn("value", F.replace("value", F.lit("evm_address"), F.lit("EVM_ADDRESS")))
    return wl.addresses_to_fetch(wl.evm_addresses(used), t.supplier.filter("s_nationkey < 5").select(who), wl.fetched_addresses(raw))
