"""Governance, staking, votes, balances, swaps and sales on payloads built from the event table.

The event types are given the message types of each job. Clicks stay actions and views stay module
notes, so groups and sub-groups are those of chain_msgs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..plans.cosmos import core, defi, gov, nft, values as V
from .base import VIEWS, query
from .chain import kv, other_attributes

NOW = datetime(2024, 2, 5)
K = "cast(json_extract_string(props, '$.k') as int)"


def k():
    return F.get_json_object("props", "$.k")


def user(p="u"):
    return F.concat(F.lit(p), F.col("user_id"))


def by_type(**attrs):
    e = F.col("event_type")
    out = None
    for name, a in attrs.items():
        out = F.when(e == name, a) if out is None else out.when(e == name, a)
    return out


SIGNED = {"click": "message", "view": "message", "signup": "tx"}


def head(action="act", *more):
    return {
        "click": kv(("action", F.lit(action)), *more), "view": kv(("module", F.lit("bank"))),
        "signup": kv(("fee", F.concat(k(), F.lit("usei"))), ("acc_seq", F.concat(user(), F.lit("/"), F.col("event_id"))), ("fee_payer", user("p")))}


VIEWS.update({
    "m_ev": f"select m.*, {K} as kk from c_msg m join (select event_id as eid, props from events) p on m.event_id = p.eid",
    "m_signer": "select tx_id, arg_min('u' || user_id, msg_index) as signer, min('u' || user_id) as caller, arg_min('p' || user_id, msg_index) as payer from c_msg where event_type = 'signup' group by 1",
    "m_act": "select *, row_number() over (partition by tx_id, msg_group, msg_sub_group order by msg_index desc) as rk from m_ev where event_type = 'purchase'",
    "m_spent": "select *, row_number() over (partition by tx_id, msg_group, msg_sub_group order by msg_index desc) as rk from m_ev where event_type = 'error'",
    "m_stake": """select a.*, s.caller, g.sender, d.spender as s2, e.spender as s3, sg.signer, coalesce(g.sender, d.spender, e.spender, sg.signer) as delegator from m_act a join m_signer sg on a.tx_id = sg.tx_id left join m_signer s on s.tx_id = a.tx_id
        left join (select tx_id, msg_group, msg_sub_group, arg_min('u' || user_id, msg_index) as sender from m_ev where event_type = 'click' group by 1, 2, 3) g on a.tx_id = g.tx_id and a.msg_group = g.msg_group and a.msg_sub_group is not distinct from g.msg_sub_group
        left join (select tx_id, msg_group, msg_sub_group, rk, kk // 20 as amt, 's' || user_id as spender from m_spent) d on a.tx_id = d.tx_id and a.msg_group = d.msg_group and a.msg_sub_group is not distinct from d.msg_sub_group and a.rk = d.rk and d.amt = a.kk // 20
        left join (select tx_id, msg_group, msg_sub_group, kk // 20 as amt, arg_max('s' || user_id, msg_index) as spender from m_spent group by 1, 2, 3, 4) e on a.tx_id = e.tx_id and a.msg_group = e.msg_group and a.msg_sub_group is not distinct from e.msg_sub_group and e.amt = a.kk // 20""",
})


def staking(t):
    amount = F.concat(F.expr("cast(get_json_object(props, '$.k') as int) div 20"), F.lit("usei"))
    types = {**SIGNED, "purchase": "delegate", "error": "coin_spent"}
    attrs = by_type(**head("/Delegate", ("module", F.lit("staking")), ("sender", user())), purchase=kv(("validator", F.concat(F.lit("v"), k())), ("amount", amount)), error=kv(("spender", user("s")), ("amount", amount)))
    return gov.staking(other_attributes(t, types, attrs))


@query("gov_staking", """select tx_id, msg_index, signer as tx_caller_address, 'delegate' as action, delegator as delegator_address, cast(kk // 20 as varchar) as amount, 'usei' as currency, 'v' || kk as validator_address from m_stake""")
def q_staking(t):
    return staking(t).select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "tx_caller_address", "action", "delegator_address", "amount", "currency", "validator_address")


@query("gov_balances_staked", """select tx_id, msg_index, delegator as address, cast(sum(kk // 20) over (partition by delegator order by block_timestamp, msg_group nulls last, tx_id, msg_index rows unbounded preceding) as varchar) as balance from m_stake""")
def q_balances(t):
    return core.balances_staked(staking(t)).select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "address", "balance")


@query("gov_daily_balances", """with b as (select delegator as address, cast(block_timestamp as date) as d, sum(kk // 20) as v from m_stake group by 1, 2), s as (select address, unnest(range(min(d), timestamp '2024-02-06', interval 1 day)) as d from b group by 1)
    select s.address, strftime(s.d, '%Y-%m-%d') as date, cast(sum(coalesce(v, 0)) over (partition by s.address order by s.d rows unbounded preceding) as varchar) as balance from s left join b on s.address = b.address and s.d = b.d""")
def q_daily(t):
    return core.daily_balances(core.balances_staked(staking(t)), NOW).select("address", "date", "balance")


@query("gov_daily_balances_in_two_runs", """with b as (select delegator as address, cast(block_timestamp as date) as d, sum(kk // 20) as v from m_stake group by 1, 2), s as (select address, unnest(range(min(d), timestamp '2024-02-06', interval 1 day)) as d from b group by 1),
    f as (select s.address, s.d, sum(coalesce(v, 0)) over (partition by s.address order by s.d rows unbounded preceding) as balance from s left join b on s.address = b.address and s.d = b.d)
    select address, strftime(d, '%Y-%m-%d') as date, cast(balance as varchar) as balance from f where d >= date '2024-01-19'""")
def q_daily_two(t):
    """Stored up to 20 January, then carried on from the day before."""
    balances = t.table("balances", lambda: core.balances_staked(staking(t)))
    stored = core.daily_balances(balances.filter("block_timestamp < timestamp_ntz '2024-01-21'"), datetime(2024, 1, 20))
    return core.daily_balances(balances, NOW, stored).select("address", "date", "balance")


@query("gov_staking_rewards", """with w as (select * from m_ev where event_type = 'purchase'), p as (select * from m_ev where event_type = 'error'), c as (select w.tx_id, w.msg_group, w.msg_sub_group, 'v' || w.kk as val, 's' || p.user_id as del, w.kk // 20 as a
    from w join p on w.tx_id = p.tx_id and w.msg_group = p.msg_group and w.msg_sub_group = p.msg_sub_group and w.kk // 20 = p.kk // 20), x as (select c.*, s.caller, unnest(['usei', 'ibc/AB']) as currency, unnest([a + 3, 7]) as amt from c join m_signer s on c.tx_id = s.tx_id)
    select tx_id, caller as tx_caller_address, msg_group, msg_sub_group, del as delegator_address, val as validator_address, currency, cast(sum(amt) as varchar) as amount from x group by all""")
def q_rewards(t):
    amount = F.concat(F.expr("cast(get_json_object(props, '$.k') as int) div 20"), F.lit("usei,7ibc/AB,3"))
    types = {**SIGNED, "purchase": "withdraw_rewards", "error": "transfer"}
    attrs = by_type(**head(), purchase=kv(("validator", F.concat(F.lit("v"), k())), ("amount", amount)), error=kv(("recipient", user("s")), ("amount", amount)))
    return gov.staking_rewards(other_attributes(t, types, attrs)).select("tx_id", "tx_caller_address", "msg_group", "msg_sub_group", "delegator_address", "validator_address", "currency", "amount")


@query("gov_validator_commission", """with w as (select tx_id, msg_group, msg_sub_group, max(kk // 50) as a from m_ev where event_type = 'purchase' and msg_group is not null and msg_sub_group is not null group by 1, 2, 3),
    o as (select tx_id, msg_group, msg_sub_group, max('operator' || user_id) as op from m_ev where event_type = 'click' group by 1, 2, 3), r as (select * from m_ev where event_type = 'error'),
    s as (select tx_id, min('u' || user_id) as caller from m_ev m where event_type = 'signup' and (msg_group is null or exists (select 1 from w where w.tx_id = m.tx_id and w.msg_group = m.msg_group and w.msg_sub_group = m.msg_sub_group)) group by 1)
    select w.tx_id, w.msg_group, w.msg_sub_group, s.caller as tx_caller_address, o.op as validator_address_operator, 's' || r.user_id as validator_address_reward, cast(w.a as double) as amount, 'usei' as currency
    from w join s on w.tx_id = s.tx_id join r on r.tx_id = w.tx_id and r.msg_group = w.msg_group and r.msg_sub_group = w.msg_sub_group and r.kk // 50 = w.a left join o on o.tx_id = w.tx_id and o.msg_group = w.msg_group and o.msg_sub_group = w.msg_sub_group""")
def q_commission(t):
    amount = F.concat(F.expr("cast(get_json_object(props, '$.k') as int) div 50"), F.lit("usei"))
    types = {**SIGNED, "purchase": "withdraw_commission", "error": "transfer"}
    attrs = by_type(**head("act", ("sender", user("operator"))), purchase=kv(("amount", amount)), error=kv(("recipient", user("s")), ("amount", amount)))
    rel = other_attributes(t, types, attrs)
    return gov.validator_commission(rel).select("tx_id", "msg_group", "msg_sub_group", "tx_caller_address", "validator_address_operator", "validator_address_reward", "amount", "currency")


VOTED = """(select distinct tx_id, msg_group, msg_sub_group from m_ev where event_type = 'click' and msg_sub_group is not null)"""


@query("gov_votes", f"""select v.tx_id, v.msg_group, v.msg_sub_group, max(kk) as proposal_id, max(case when event_type = 'click' then 'u' || user_id end) as voter, cast(max(case when event_type = 'purchase' then 'opt' || kk end) as varchar) as vote_option,
    max(case when event_type = 'purchase' then cast(kk as double) / 100 end) as vote_weight from (select * from m_ev where event_type in ('click', 'purchase')) v join {VOTED} g on v.tx_id = g.tx_id and v.msg_group = g.msg_group and v.msg_sub_group = g.msg_sub_group group by 1, 2, 3""".replace("max(kk) as proposal_id", "max(case when event_type = 'purchase' then kk % 10 end) as proposal_id"))
def q_votes(t):
    option = F.to_json(F.struct(F.concat(F.lit("opt"), k()).alias("option"), (k().cast("double") / 100).cast("string").alias("weight")))
    types = {**SIGNED, "purchase": "proposal_vote", "error": "signer"}
    attrs = by_type(**head(V.GOV_VOTE_ACTION, ("sender", user())), purchase=kv(("proposal_id", k().cast("int") % 10), ("option", option)), error=kv(("sei_addr", user("s"))))
    return gov.votes(other_attributes(t, types, attrs)).select("tx_id", "msg_group", "msg_sub_group", "proposal_id", "voter", "vote_option", "vote_weight")


@query("gov_proposal_deposits", """select a.tx_id, a.kk as proposal_id, s.signer as depositor, cast(a.kk as double) as amount, 'usei' as currency from m_ev a join m_signer s on s.tx_id = a.tx_id where a.event_type = 'purchase'""")
def q_deposits(t):
    types = {**SIGNED, "purchase": "proposal_deposit", "error": "other"}
    attrs = by_type(**head(), purchase=kv(("proposal_id", k()), ("amount", F.concat(k(), F.lit("usei")))), error=kv(("x", F.lit("y"))))
    return gov.proposal_deposits(other_attributes(t, types, attrs)).select("tx_id", "proposal_id", "depositor", "amount", "currency")


@query("gov_submitted_proposals", """select a.tx_id, a.kk as proposal_id, s.signer as proposer, 'type' || v.kk as proposal_type from m_ev a join m_ev v on a.tx_id = v.tx_id and a.event_type = 'purchase' and v.event_type = 'purchase' join m_signer s on s.tx_id = a.tx_id""")
def q_proposals(t):
    types = {**SIGNED, "purchase": "submit_proposal", "error": "other"}
    attrs = by_type(**head(), purchase=kv(("proposal_id", k()), ("proposal_type", F.concat(F.lit("type"), k()))), error=kv(("x", F.lit("y"))))
    return gov.submitted_proposals(other_attributes(t, types, attrs)).select("tx_id", "proposal_id", "proposer", "proposal_type")


@query("chain_oracle_votes", f"""with v as (select v.tx_id, v.msg_group, v.msg_sub_group, max('u' || user_id) as voter, max('0.' || kk || 'uatom,' || kk || 'ueth') as rates from m_ev v join {VOTED} g on v.tx_id = g.tx_id and v.msg_group = g.msg_group and v.msg_sub_group = g.msg_sub_group
    where event_type = 'purchase' group by 1, 2, 3), x as (select v.*, s.signer, unnest(string_split(rates, ',')) as r from v join m_signer s on s.tx_id = v.tx_id)
    select tx_id, msg_group, msg_sub_group, signer as tx_sender, voter, cast(regexp_extract(r, '^([0-9.]+)', 1) as double) as amount, regexp_extract(r, '([a-z]+)$', 1) as currency from x""")
def q_oracle(t):
    rates = F.concat(F.lit("0."), k(), F.lit("uatom,"), k(), F.lit("ueth"))
    types = {**SIGNED, "purchase": "aggregate_vote", "error": "other"}
    attrs = by_type(**head(V.ORACLE_VOTE_ACTION), purchase=kv(("voter", user()), ("exchange_rates", rates)), error=kv(("x", F.lit("y"))))
    return core.oracle_votes(other_attributes(t, types, attrs)).select("tx_id", "msg_group", "msg_sub_group", "tx_sender", "voter", F.col("amount").cast("double").alias("amount"), "currency")


# --- swaps and sales ------------------------------------------------------------------------------


@query("dex_swaps_pool_events", """with e as (select distinct tx_id, msg_group, msg_sub_group from m_ev where event_type = 'error' and kk < 80), w as (select * from m_ev where event_type = 'purchase')
    select w.tx_id, w.msg_index, s.payer as swapper, cast(w.kk as varchar) as amount_in, 'in' || (w.kk % 3) as currency_in, cast(w.kk + 5 as varchar) as amount_out, 'pool' || (w.kk % 9) as pool_address, 'Pool ' || (w.kk % 9) as pool_name
    from w join e on w.tx_id = e.tx_id and w.msg_group = e.msg_group and w.msg_sub_group = e.msg_sub_group join m_signer s on s.tx_id = w.tx_id where w.kk % 9 < 8""")
def q_astroport(t):
    """Swap events of groups that call a pool."""
    ki = k().cast("int")
    types = {**SIGNED, "purchase": "wasm", "error": "execute"}
    attrs = by_type(**head(), purchase=kv(
        ("_contract_address", F.concat(F.lit("pool"), ki % 9)), ("action", F.lit("swap")), ("ask_asset", F.lit("out")), ("offer_asset", F.concat(F.lit("in"), ki % 3)), ("offer_amount", ki), ("return_amount", ki + 5)),
        error=kv(("_contract_address", F.when(ki < 80, F.concat(F.lit("pool"), ki % 8)).otherwise(F.lit("other")))))
    names = t.nation.filter("n_nationkey < 8").select(F.concat(F.lit("pool"), F.col("n_nationkey")).alias("contract_address"), F.concat(F.lit("Pool "), F.col("n_nationkey")).alias("label"))
    pools = names.select("contract_address", F.lit("pair_contract_addr").alias("type"))
    out = defi.swaps_astroport(other_attributes(t, types, attrs), pools, names)
    return out.select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "swapper", "amount_in", "currency_in", "amount_out", "pool_address", "pool_name")


@query("nft_sales_exchange", """select a.tx_id, a.msg_index, 'b' || a.user_id as buyer_address, 'market' as marketplace_contract, cast(a.kk as varchar) as amount, 'tok' || b.kk as token_id, 'col' || b.user_id as nft_address
    from (select * from m_ev where event_type = 'purchase' and kk >= 20) a left join (select * from m_ev where event_type = 'error' and kk >= 30) b on a.tx_id = b.tx_id and a.msg_group = b.msg_group and a.msg_sub_group = b.msg_sub_group""")
def q_dagora(t):
    ki = k().cast("int")
    types = {**SIGNED, "purchase": "wasm-execute-exchange", "error": "wasm"}
    attrs = by_type(**head(), purchase=kv(("_contract_address", F.when(ki >= 20, F.lit("market")).otherwise(F.lit("x"))), ("buyer", user("b")), ("seller", user("s")), ("amount", ki), ("token", F.lit("usei"))),
                    error=kv(("_contract_address", F.when(ki >= 30, F.lit("market")).otherwise(F.lit("x"))), ("nft", F.concat(F.lit("tok"), ki, F.lit(", col"), F.col("user_id")))))
    out = nft.sales_dagora(other_attributes(t, types, attrs), "market")
    return out.select("tx_id", F.col("msg_index").cast("bigint").alias("msg_index"), "buyer_address", "marketplace_contract", "amount", "token_id", "nft_address")
