"""Exchanges, liquidity and the bridge of the message side, on payloads built from the event table.

Clicks open groups and views are module notes, as in `messages`. Purchases and errors are what each job reads; their
number `k` decides which of its messages they become. Pools are named after the first eight nations.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..plans.cosmos import core, defi
from .base import VIEWS, query
from .chain import kv, other_attributes

POOLS = 8
OLD, NEW = datetime(2024, 1, 1), datetime(2024, 1, 2)
GROUP = "tx_id, msg_group, msg_sub_group"


def k(by=1):
    return F.floor(F.get_json_object("props", "$.k").cast("int") / by)


def text(prefix, c):
    return F.concat(F.lit(prefix), c.cast("string"))


def user(prefix):
    return text(prefix, F.col("user_id"))


def payer():
    return text("p", F.expr("event_id div 10") % 7)


def unit():
    return F.element_at(F.array(F.lit("ua"), F.lit("ub"), F.lit("uc")), (F.col("user_id") % 3 + 1).cast("int"))


def attributes(t, name, purchase, error):
    """Attribute table in which purchases and errors are (message type, attributes)."""
    e = F.col("event_type")
    kinds, attrs = zip(purchase, error)
    kind = F.when(e == "signup", "tx").when(e == "purchase", kinds[0]).when(e == "error", kinds[1]).otherwise("message")
    signed = kv(("fee", text("", k())), ("acc_seq", F.concat(user("u"), F.lit("/"), F.col("event_id"))), ("fee_payer", payer()))
    body = F.when(e == "click", kv(("action", F.lit("act")))).when(e == "view", kv(("module", F.lit("bank")))).when(e == "signup", signed).when(e == "purchase", attrs[0]).otherwise(attrs[1])
    return other_attributes(t, kind, body, name)


def pools(t, name, prefix="pool", count=POOLS):
    """One row per pool: its number, address and label."""
    n = F.col("n_nationkey")
    return t.nation.filter(n < count).select(n.alias("n"), text(prefix, n).alias("contract_address"), text(f"{name} ", n).alias("label"))


def listed(t):
    """The listing of pools, and an older one with other names."""
    rows = pools(t, "Pool").select(
        F.col("contract_address").alias("pool_address"), F.col("label").alias("pool_name"), F.lit("ua").alias("token1_denom"), F.lit("ub").alias("token2_denom"), text("lp", F.col("n")).alias("lp_token_address"))
    older = rows.withColumns({"pool_name": F.lit("old"), "_inserted_timestamp": F.lit(OLD)})
    return defi.listed_pools(rows.withColumn("_inserted_timestamp", F.lit(NEW)).unionByName(older))


def pool(n=9):
    return text("pool", k() % n)


VIEWS.update({
    "d_ev": "select *, 'u' || substr('abc', cast(user_id % 3 as int) + 1, 1) as unit from m_ev",
    "d_buy": "select * from d_ev where event_type = 'purchase'",
    "d_err": "select * from d_ev where event_type = 'error'",
    "d_pay": "select distinct tx_id, 'p' || ((event_id // 10) % 7) as payer from m_ev where event_type = 'signup'",
})


# --- swaps ----------------------------------------------------------------------------------------


def by_position(t):
    """Swap messages between transfers of the same amounts."""
    swap = F.when(k() % 4 == 0, kv(("_contract_address", pool()), ("action", F.lit("other")), ("native_sold", k(20)), ("token_bought", k(20) + 1)))
    swap = swap.when(k() % 4 == 1, kv(("_contract_address", pool()), ("input_token_amount", k(20)), ("native_transferred", k(20) + 1)))
    swap = swap.otherwise(kv(("_contract_address", pool()), ("action", F.lit("swap")), ("native_sold", k(20)), ("token_bought", k(20) + 1)))
    attrs = attributes(t, "position_attributes", (F.lit("wasm"), swap), (F.lit("transfer"), kv(("amount", F.concat(k(20).cast("string"), unit())))))
    return defi.swaps_fuzio(attrs, pools(t, "Fuzio Pool").unionByName(pools(t, "Other", count=9).filter("n = 8")))


def by_party(t):
    """Swap messages whose amounts the fee payer sent and received, as a coin or as a token."""
    called = k() % 5 == 0
    token = kv(("_contract_address", text("tok", k() % 3)), ("action", F.lit("transfer")), ("amount", k(50) + 1), ("to", F.when(k() % 2 == 0, payer()).otherwise(F.lit("x"))))
    body = F.when(called, kv(("_contract_address", pool()))).when(k() % 5 == 1, token).otherwise(kv(("_contract_address", pool()), ("native_sold", k(50)), ("token_bought", k(50) + 1)))
    odd = k() % 2 == 1
    moved = kv(("sender", F.when(odd, payer()).otherwise(F.lit("x"))), ("recipient", F.when(odd, F.lit("x")).otherwise(payer())), ("amount", F.concat(k(50).cast("string"), unit())))
    attrs = attributes(t, "party_attributes", (F.when(called, "execute").otherwise("wasm"), body), (F.lit("transfer"), moved))
    return defi.swaps_seaswap(attrs, listed(t))


VIEWS.update({
    "d_move": f"select {GROUP}, kk // 20 as a, min(msg_index) as at, arg_min(unit, msg_index) as unit from d_err group by all",
    "d_pos": """select w.block_id, w.block_timestamp, w.tx_id, w.msg_index, payer as swapper, kk // 20 as ain, case when w.msg_index > i.at then i.unit end as cin, kk // 20 + 1 as aout, case when w.msg_index < o.at then o.unit end as cout, 'pool' || (kk % 9) as pool, 'Fuzio Pool ' || (kk % 9) as pool_name
        from d_buy w join d_pay p on p.tx_id = w.tx_id left join d_move i on i.tx_id = w.tx_id and i.msg_group = w.msg_group and i.msg_sub_group = w.msg_sub_group and i.a = kk // 20
        left join d_move o on o.tx_id = w.tx_id and o.msg_group = w.msg_group and o.msg_sub_group = w.msg_sub_group and o.a = kk // 20 + 1 where kk % 4 <> 0 and kk % 9 < 8""",
    "d_party": f"""select w.block_id, w.block_timestamp, w.tx_id, w.msg_index, payer as swapper, kk // 50 as ain, s.unit as cin, kk // 50 + 1 as aout, coalesce(g.unit, c.tok) as cout, 'pool' || (kk % 9) as pool, case when kk % 9 < 8 then 'Pool ' || (kk % 9) end as pool_name
        from d_buy w join d_pay p on p.tx_id = w.tx_id join (select distinct {GROUP}, kk // 50 as a, unit from d_err where kk % 2 = 1) s on s.tx_id = w.tx_id and s.msg_group = w.msg_group and s.msg_sub_group = w.msg_sub_group and s.a = kk // 50
        left join (select distinct {GROUP}, kk // 50 as a, unit from d_err where kk % 2 = 0) g on g.tx_id = w.tx_id and g.msg_group = w.msg_group and g.msg_sub_group = w.msg_sub_group and g.a = kk // 50 + 1
        left join (select distinct {GROUP}, kk // 50 + 1 as a, 'tok' || (kk % 3) as tok from d_buy where kk % 5 = 1 and kk % 2 = 0) c on c.tx_id = w.tx_id and c.msg_group = w.msg_group and c.msg_sub_group = w.msg_sub_group and c.a = kk // 50 + 1
        where kk % 5 >= 2 and coalesce(g.unit, c.tok) is not null and w.tx_id in (select tx_id from d_buy where kk % 5 = 0 and kk % 9 < 8)""",
    "d_swap": "select 'fuzio' as platform, * from d_pos union all select 'seaswap', * from d_party",
    "d_price": "select case token when 'click' then 'ua' else 'ub' end as unit, hour, close from v_prices where token in ('click', 'view')",
    "d_token": "select * from (values ('ua', 1, 'SA'), ('ub', 2, 'SB')) v(unit, decimals, symbol)",
})

_SWAPS = "tx_id, msg_index, swapper, cast(ain as varchar) as amount_in, cin as currency_in, cast(aout as varchar) as amount_out, cout as currency_out, pool as pool_address, pool_name"


def swap_columns(df, *more):
    return df.select(*more, "tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "swapper", "amount_in", "currency_in", "amount_out", "currency_out", "pool_address", "pool_name")


@query("dex_swaps_by_position", f"select {_SWAPS} from d_pos")
def q_position(t):
    return swap_columns(by_position(t))


@query("dex_swaps_by_party", f"select {_SWAPS} from d_party")
def q_party(t):
    return swap_columns(by_party(t))


@query("dex_swaps_published", f"""select platform, block_id, strftime(block_timestamp, '%Y-%m-%d %H:%M:%S') as block_timestamp, {_SWAPS}, md5(tx_id || '-' || msg_index) as fact_dex_swaps_id from d_swap""")
def q_published(t):
    out = defi.fact_dex_swaps({"fuzio": by_position(t), "seaswap": by_party(t)})
    stamps = out.select("platform", "block_id", "block_timestamp", "fact_dex_swaps_id", "tx_id", "msg_index", "swapper", "amount_in", "currency_in", "amount_out", "currency_out", "pool_address", "pool_name")
    return swap_columns(stamps, "platform", "block_id", "block_timestamp", "fact_dex_swaps_id")


def prices(t):
    named = F.when(F.col("token") == "click", "ua").otherwise("ub")
    return t.prices_hourly.filter("token in ('click', 'view')").select(named.alias("token_address"), "hour", F.col("close").alias("price"))


def tokens(t):
    return t.spark.createDataFrame([("ua", 1, "SA"), ("ub", 2, "SB")], "currency string, decimals int, symbol string")


def addresses(t):
    n = F.col("n_nationkey")
    return t.nation.filter(n < 4).select(text("p", n).alias("native_address"), text("0x", n).alias("evm_address"))


_VALUED = """v as (select s.*, case when substr(swapper, 2) in ('0', '1', '2', '3') then '0x' || substr(swapper, 2) end as origin, ain / power(10, a.decimals) as vin, aout / power(10, b.decimals) as vout, a.symbol as sin, b.symbol as sout, p.close as pin, q.close as pout
    from d_swap s left join d_token a on a.unit = cin left join d_token b on b.unit = cout left join d_price p on p.unit = cin and p.hour = date_trunc('hour', block_timestamp) left join d_price q on q.unit = cout and q.hour = date_trunc('hour', block_timestamp))"""
_VALUES = "tx_id, msg_index as index, platform, swapper, origin as origin_from_address, vin as amount_in, round(vin * pin, 6) as amount_in_usd, vout as amount_out, round(vout * pout, 6) as amount_out_usd, sin as symbol_in, sout as symbol_out"


def valued(df):
    return df.select("tx_id", F.col("index").cast("bigint").alias("index"), "platform", "swapper", "origin_from_address", "amount_in", F.round("amount_in_usd", 6).alias("amount_in_usd"), "amount_out", F.round("amount_out_usd", 6).alias("amount_out_usd"), "symbol_in", "symbol_out")


@query("dex_swaps_valued", f"with {_VALUED} select {_VALUES} from v")
def q_valued(t):
    """Swaps of two platforms with decimals, prices of the hour and the swapper's other address."""
    return valued(defi.swaps_combined({"fuzio": by_position(t), "seaswap": by_party(t)}, prices(t), tokens(t), addresses(t)))


@query("dex_heal_swaps_valued", f"with {_VALUED} select {_VALUES} from v where platform = 'fuzio' and (origin is not null or cin = 'ub' or cout = 'ub')")
def q_heal_valued(t):
    """Stored while one token and no address was known; the others arrive."""
    known = tokens(t).filter("currency = 'ua'")
    stored = t.table("stored_swaps", lambda: defi.swaps_combined({"fuzio": by_position(t)}, prices(t).filter("token_address = 'ua'"), known, addresses(t).filter(F.lit(False))))
    return valued(defi.heal_swaps(stored, prices(t), tokens(t), addresses(t)))


@query("dex_pair_pools", """select 'c' || event_id as contract_address, case when kk % 3 = 1 then 'pair_contract_addr' else 'liquidity_token_addr' end as type, tx_id, block_id from d_buy
    where kk % 3 <> 0 and kk % 5 <> 0 and tx_id in (select tx_id from d_buy where kk % 3 = 0 and kk < 75) and tx_id in (select tx_id from d_err where kk < 50)""")
def q_pairs(t):
    """Some transactions call the factory and create a contract; some pools are closed in the same event."""
    own = text("c", F.col("event_id"))
    act = ("action", F.when(k() % 5 == 0, "deregister").otherwise("create"))
    body = F.when(k() % 3 == 0, kv(("_contract_address", F.when(k() < 75, "factory").otherwise("else")))).when(k() % 3 == 1, kv(("pair_contract_addr", own), act)).otherwise(kv(("liquidity_token_addr", own), act))
    attrs = attributes(t, "pair_attributes", (F.when(k() % 3 == 0, "execute").otherwise("wasm"), body), (F.when(k() < 50, "instantiate").otherwise("other"), kv(("_contract_address", text("i", F.col("event_id"))))))
    return defi.pair_pools(attrs, core.contracts_instantiate(attrs), "factory").select("contract_address", "type", "tx_id", "block_id")


# --- liquidity ------------------------------------------------------------------------------------

def _calls():
    return k() % 3 == 0


def lp_pairs(t):
    """Two coins in one text; the share token is minted or burned by another message of the group."""
    even = k() % 2 == 0
    coins = F.concat(k().cast("string"), F.lit("ua, "), (k() + 1).cast("string"), F.lit("ub"))
    who = F.when(k() % 4 == 0, user("u"))
    body = F.when(_calls(), kv(("_contract_address", pool())))
    body = body.when(even, kv(("_contract_address", pool()), ("action", F.lit("provide_liquidity")), ("assets", coins), ("share", k(50)), ("sender", who)))
    body = body.otherwise(kv(("_contract_address", pool()), ("action", F.lit("withdraw_liquidity")), ("refund_assets", coins), ("withdrawn_share", k(50))))
    share = kv(("_contract_address", text("lp", F.col("user_id") % 3)), ("action", F.when(k() >= 80, "claim").when(even, "mint").otherwise("burn")), ("amount", k(50)))
    attrs = attributes(t, "lp_pair_attributes", (F.when(_calls(), "execute").otherwise("wasm"), body), (F.lit("wasm"), share))
    named = pools(t, "Pool")
    return defi.lp_astroport(attrs, named.withColumn("type", F.lit("pair_contract_addr")), named)


def two_tokens(t):
    added = kv(("_contract_address", pool()), ("action", F.lit("add_liquidity")), ("token1_amount", k()), ("token2_amount", k() + 1), ("liquidity_received", k() + 2))
    taken = kv(("_contract_address", pool()), ("action", F.lit("remove_liquidity")), ("token1_returned", k()), ("token2_returned", k() + 1), ("liquidity_burned", k() + 2))
    body = F.when(_calls(), kv(("_contract_address", pool()))).when(k() % 2 == 0, added).otherwise(taken)
    share = ("_contract_address", F.lit("lp"))
    share = F.when(k() >= 80, kv(share, ("action", F.lit("claim")), ("to", user("x")))).when(k() % 2 == 0, kv(share, ("action", F.lit("mint")), ("to", user("u")))).otherwise(kv(share, ("action", F.lit("burn_from")), ("from", user("v"))))
    return attributes(t, "two_token_attributes", (F.when(_calls(), "execute").otherwise("wasm"), body), (F.lit("wasm"), share))


def lp_answers(t):
    """Answers of the pools about their tokens; the last pool has none."""
    native = F.struct(F.lit("ua").alias("native")), F.struct(F.lit("ub").alias("native"))
    data = F.to_json(F.struct(text("lp", F.col("n")).alias("lp_token_address"), native[0].alias("token1_denom"), native[1].alias("token2_denom")))
    return pools(t, "x", count=POOLS - 1).select("contract_address", data.alias("data"))


def lp_info(t):
    return defi.lp_fuzio(two_tokens(t), pools(t, "Fuzio Pool"), lp_answers(t))


def lp_listed(t):
    return defi.lp_seaswap(two_tokens(t), listed(t))


def lp_markets(t):
    """Deposits and withdrawals whose message type names them."""
    kinds = F.array(*[F.lit(x) for x in ("deposit-lp", "reinvest-yield-xlp", "withdraw", "other")])
    body = kv(("_contract_address", pool()), ("addr", user("u")), ("kind", F.element_at(kinds, (k() % 4 + 1).cast("int"))), ("collateral", F.concat(k().cast("string"), F.lit(".5"))), ("tokens", k()))
    silent = kv(("_contract_address", pool()), ("collateral", k()))
    attrs = attributes(t, "lp_market_attributes", (F.when(k() % 5 == 0, "wasm").otherwise("wasm-lp-deposit"), body), (F.lit("wasm-lp-collect"), silent))
    collateral = F.struct(F.struct(F.lit("ua").alias("denom")).alias("native"))
    data = F.to_json(F.struct(collateral.alias("collateral"), F.struct(text("M", F.col("n")).alias("market_id")).alias("config")))
    status = pools(t, "x", count=POOLS - 1).select("contract_address", data.alias("data"))
    return defi.lp_levana(attrs, pools(t, "Levana"), status, {"pool1": 6})


_CALLED = f"(select distinct {GROUP} from d_buy where kk % 3 = 0 and kk % 9 < 8)"
VIEWS.update({
    "d_lp_pair": f"""select w.tx_id, w.msg_index, case when kk % 4 = 0 then 'u' || user_id else signer end as provider, case when kk % 2 = 0 then 'provide_liquidity' else 'withdraw_liquidity' end as act, 'pool' || (kk % 9) as pool, 'Pool ' || (kk % 9) as pool_name,
        kk as a1, 'ua' as c1, kk + 1 as a2, 'ub' as c2, kk // 50 as share, lp from d_buy w join {_CALLED} g using ({GROUP}) join m_signer s on s.tx_id = w.tx_id
        join (select {GROUP}, kk // 50 as a, arg_min('lp' || (user_id % 3), msg_index) as lp from d_err where kk < 80 group by 1, 2, 3, 4) m on m.tx_id = w.tx_id and m.msg_group = w.msg_group and m.msg_sub_group = w.msg_sub_group and m.a = kk // 50 where kk % 3 <> 0 and kk % 9 < 8""",
    "d_two": f"""select w.tx_id, w.msg_index, h.who as provider, case when kk % 2 = 0 then 'add_liquidity' else 'remove_liquidity' end as act, kk % 9 as n, kk as a1, 'ua' as c1, kk + 1 as a2, 'ub' as c2, kk + 2 as share, 'lp' || (kk % 9) as lp
        from d_buy w join {_CALLED} g using ({GROUP}) join (select {GROUP}, if(kk % 2 = 0, 'u', 'v') || user_id as who from d_err where kk < 80) h using ({GROUP}) where kk % 3 <> 0 and kk % 9 < 8""",
    "d_lp_info": "select tx_id, msg_index, provider, act, 'pool' || n as pool, 'Fuzio Pool ' || n as pool_name, a1, c1, a2, c2, share, lp from d_two where n < 7",
    "d_lp_listed": "select tx_id, msg_index, provider, act, 'pool' || n as pool, 'Pool ' || n as pool_name, a1, c1, a2, c2, share, lp from d_two",
    "d_lp_market": """select tx_id, msg_index, 'u' || user_id as provider, case kk % 4 when 0 then 'deposit-lp' when 1 then 'reinvest-yield-xlp' when 2 then 'withdraw' else 'other' end as act, 'pool' || (kk % 9) as pool, 'Levana ' || (kk % 9) as pool_name,
        (kk + 0.5) * case when kk % 9 = 1 then 1000000 else 1 end as a1, 'ua' as c1, null as a2, null as c2, kk as share, null as lp from d_buy where kk % 5 <> 0 and kk % 9 < 7""",
})
_LP = "tx_id, msg_index, provider as liquidity_provider_address, act as lp_action, pool as pool_address, pool_name, {a}(a1 as {b}) as token1_amount, c1 as token1_currency, {a}(a2 as {b}) as token2_amount, c2 as token2_currency, {a}(share as {b}) as lp_token_amount, lp as lp_token_address"
_LP_TEXT, _LP_NUMBER = _LP.format(a="cast", b="varchar"), _LP.format(a="cast", b="double")


def lp_columns(df):
    return df.withColumn("msg_index", F.col("msg_index").cast("bigint")).select(
        "tx_id", "msg_index", "liquidity_provider_address", "lp_action", "pool_address", "pool_name", "token1_amount", "token1_currency", "token2_amount", "token2_currency", "lp_token_amount", "lp_token_address")


@query("lp_actions_pairs", f"select {_LP_TEXT} from d_lp_pair")
def q_lp_pairs(t):
    return lp_columns(lp_pairs(t))


@query("lp_actions_answered", f"select {_LP_TEXT} from d_lp_info")
def q_lp_info(t):
    return lp_columns(lp_info(t))


@query("lp_actions_listed", f"select {_LP_TEXT} from d_lp_listed")
def q_lp_listed(t):
    return lp_columns(lp_listed(t))


@query("lp_actions_markets", f"select {_LP_NUMBER} from d_lp_market")
def q_lp_markets(t):
    return lp_columns(lp_markets(t))


@query("lp_actions_published", """with u as (select 'astroport' as platform, * replace (if(act = 'provide_liquidity', 'add_liquidity', 'remove_liquidity') as act) from d_lp_pair union all by name select 'fuzio' as platform, * from d_lp_info union all by name select 'seaswap' as platform, * from d_lp_listed
    union all by name select 'levana' as platform, * replace (if(act = 'withdraw', 'remove_liquidity', 'add_liquidity') as act) from d_lp_market where act <> 'other')
    select platform, tx_id, msg_index, provider as liquidity_provider_address, act as lp_action, pool as pool_address, cast(a1 as double) as token1_amount, cast(a2 as double) as token2_amount, lp as lp_token_address, md5(tx_id || '-' || msg_index) as fact_lp_actions_id from u""")
def q_lp_all(t):
    out = defi.fact_lp_actions({"astroport": lp_pairs(t), "fuzio": lp_info(t), "seaswap": lp_listed(t), "levana": lp_markets(t)})
    return out.select("platform", "tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "liquidity_provider_address", "lp_action", "pool_address", "token1_amount", "token2_amount", "lp_token_address", "fact_lp_actions_id")


def staking_contracts(t):
    """Staking contracts and, for all but the last, the pool whose shares they hold."""
    stakes, own = pools(t, "Fuzio Staking", "st"), pools(t, "Pool")
    config = pools(t, "x", "st", POOLS - 1).select("contract_address", F.to_json(F.struct(text("pool", F.col("n")).alias("lp_token_contract"))).alias("data"))
    return stakes.unionByName(own), config


@query("lp_staking", f"""select w.tx_id, w.msg_index, 'u' || user_id as liquidity_provider_address, if(kk % 4 = 1, 'bond', 'unbond') as lp_staking_action, 'st' || (kk % 9) as staking_pool_address, cast(kk as varchar) as amount, 'pool' || (kk % 9) as pool_address, 'Pool ' || (kk % 9) as pool_name
    from d_buy w join {_CALLED} g using ({GROUP}) where kk % 3 <> 0 and kk % 4 in (1, 2) and kk % 9 < 7""")
def q_lp_staking(t):
    stake = text("st", k() % 9)
    act = F.when(k() % 4 == 1, "bond").when(k() % 4 == 2, "unbond").otherwise("claim")
    body = F.when(_calls(), kv(("_contract_address", stake))).otherwise(kv(("_contract_address", stake), ("action", act), ("owner", user("u")), ("amount", k())))
    attrs = attributes(t, "lp_staking_attributes", (F.when(_calls(), "execute").otherwise("wasm"), body), (F.lit("other"), kv(("x", F.lit("y")))))
    out = defi.lp_staking_fuzio(attrs, *staking_contracts(t))
    return out.select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "liquidity_provider_address", "lp_staking_action", "staking_pool_address", "amount", "pool_address", "pool_name")


@query("lp_staking_rewards", f"""select w.tx_id, w.msg_index, 'o' || (w.kk % 2) as liquidity_provider_address, 'st' || (w.kk % 3) as staking_pool_address, cast(e.kk as varchar) as reward_amount, e.unit as reward_currency, 'pool' || (w.kk % 3) as pool_address
    from d_buy w join (select distinct {GROUP} from d_buy where kk % 4 = 0) g using ({GROUP}) join d_err e on e.tx_id = w.tx_id and e.msg_group = w.msg_group and e.msg_sub_group = w.msg_sub_group and e.kk % 3 = w.kk % 3 and e.kk % 2 = w.kk % 2 where w.kk % 4 <> 0""")
def q_lp_rewards(t):
    """Withdrawals of a staking contract and the coins that it sent."""
    stake, owner, called = text("st", k() % 3), text("o", k() % 2), k() % 4 == 0
    body = F.when(called, kv(("_contract_address", stake))).otherwise(kv(("_contract_address", stake), ("action", F.lit("withdraw")), ("owner", owner)))
    paid = kv(("sender", stake), ("recipient", owner), ("amount", F.concat(k().cast("string"), unit())))
    attrs = attributes(t, "lp_reward_attributes", (F.when(called, "execute").otherwise("wasm"), body), (F.lit("transfer"), paid))
    out = defi.lp_staking_rewards_fuzio(attrs, *staking_contracts(t))
    return out.select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "liquidity_provider_address", "staking_pool_address", "reward_amount", "reward_currency", "pool_address")


# --- bridge ---------------------------------------------------------------------------------------


def registrations(t):
    """Purchases register assets, errors chains; every ninth at another contract."""
    at = F.when(k() % 9 < 8, "bridge").otherwise("else")
    asset = kv(("_contract_address", at), ("action", F.lit("register_asset")), ("token_address", text("t", k())), ("token_chain", k() % 5))
    return attributes(t, "registrations", (F.lit("wasm"), asset), (F.lit("wasm"), kv(("_contract_address", at), ("chain_address", text("a", F.col("event_id"))), ("chain_id", k() % 5))))


_NEWEST = "row(block_timestamp, tx_id, msg_index)"


@query("bridge_assets", f"""select 't' || kk as token_address, kk % 5 as token_chain, arg_max(tx_id, {_NEWEST}) as tx_id, arg_max(msg_index, {_NEWEST}) as msg_index from d_buy where kk % 9 < 8 group by kk""")
def q_assets(t):
    return defi.bridge_assets(registrations(t), "bridge").select("token_address", "token_chain", "tx_id", F.col("msg_index").cast("bigint").alias("msg_index"))


@query("bridge_chains", f"""select c.*, n_name as chain_name, '0x' || n_regionkey as foreign_address from (select cast(kk % 5 as varchar) as chain_id, arg_max('a' || event_id, {_NEWEST}) as chain_address from d_err where kk % 9 < 8 group by 1) c left join nation on cast(n_nationkey as varchar) = chain_id and n_nationkey < 4""")
def q_chains(t):
    names = t.nation.filter("n_nationkey < 4").select(F.col("n_nationkey").alias("wormhole_chain_id"), F.col("n_name").alias("chain_name"), text("0x", F.col("n_regionkey")).alias("address"))
    return defi.bridge_chains(registrations(t), names, "bridge").select("chain_id", "chain_address", "chain_name", "foreign_address")


@query("bridge_message_burns", f"""with r as (select *, case when event_type = 'error' then 'c' || (kk % 4) when kk % 3 = 0 then 'bridge' else 'tok' || (kk % 3) end as contract, case when event_type = 'error' then 'x' when kk % 3 = 0 then 'transfer' else 'burn_from' end as act
    from d_ev where event_type in ('purchase', 'error') and tx_id in (select tx_id from d_buy where kk % 3 = 0) and tx_id in (select tx_id from d_buy where kk % 3 <> 0)),
    g as (select {GROUP}, max(case when act = 'transfer' then 'u' || user_id end) as from_address, max(case when act = 'transfer' then kk || '' end) as transfer_amount, max(case when act = 'x' then kk || '' end) as message_sequence,
    array_to_string(list_sort(list(distinct contract)), ',') as contract_address_array, array_to_string(list_sort(list(distinct act)), ',') as action_array, count(*) filter (where act <> 'burn_from') as n from r group by all)
    select g.* exclude (n), amount from g join (select distinct {GROUP}, kk || '' as amount from r where act = 'burn_from') using ({GROUP}) where n > 0""")
def q_message_burns(t):
    sent = kv(("_contract_address", F.lit("bridge")), ("action", F.lit("transfer")), ("from", user("u")), ("transfer.amount", k()))
    body = F.when(_calls(), sent).otherwise(kv(("_contract_address", text("tok", k() % 3)), ("action", F.lit("burn_from")), ("amount", k())))
    attrs = attributes(t, "burn_attributes", (F.lit("wasm"), body), (F.lit("wasm"), kv(("_contract_address", text("c", k() % 4)), ("action", F.lit("x")), ("message.sequence", k()))))
    return defi.bridge_burns(attrs, "bridge").select("tx_id", "msg_group", "msg_sub_group", "from_address", "transfer_amount", "message_sequence", "contract_address_array", "action_array", "amount")


@query("bridge_message_mints", """select w.tx_id, w.msg_index, cast(w.kk as varchar) as amount, 'mid' || (w.kk % 3) as recipient_middle, 'end' || e.user_id as recipient, e.kk || e.unit as amount_raw from d_buy w join d_err e on e.tx_id = w.tx_id and e.kk % 3 = w.kk % 3 where w.kk % 9 < 8 and w.kk % 2 = 0""")
def q_message_mints(t):
    done = kv(("_contract_address", F.when(k() % 9 < 8, "bridge").otherwise("else")), ("action", F.when(k() % 2 == 0, "complete_transfer_wrapped").otherwise("x")), ("amount", k()), ("fee", F.lit(1)), ("recipient", text("mid", k() % 3)))
    paid = kv(("sender", text("mid", k() % 3)), ("recipient", user("end")), ("amount", F.concat(k().cast("string"), unit())))
    out = defi.bridge_mints(attributes(t, "mint_attributes", (F.lit("wasm"), done), (F.lit("transfer"), paid)), "bridge")
    return out.select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "amount", "recipient_middle", "recipient", "amount_raw")
