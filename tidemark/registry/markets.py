"""Exchange and bridge jobs on event logs that Spark builds from parts and line items.

Every part is a pool: a pair for ECONOMY and SMALL parts, a fee pool for the others. Its tokens carry the
ids 2p and 2p + 1. Every line item is a swap of its part's pool and a burn on the bridge. Suppliers are pools of several tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import increments as inc
from ..plans.evm import bridge, bridge_values as B, dex, dex_values as D, values as V
from ..session import staged_parts
from . import evm
from .base import VIEWS, query
from .evm import addr, address, by_parts, hexn, lines, measures, topic

CREATED = "1995-01-01 00:00:00"
VAULT = 3 * 10**9


def word(c):
    return hexn(c, 64)


def signed_word(c):
    """64 digits of a signed bigint."""
    return F.when(c < 0, F.lpad(hexn(c), 64, "f")).otherwise(word(c))


def _log_columns(df: DataFrame, **cols) -> DataFrame:
    fixed = {"event_removed": F.lit(False), "tx_succeeded": F.lit(True), "tx_position": F.lit(0).cast("bigint"), "origin_function_signature": F.lit("0xf"), "fact_event_logs_id": F.lit("x")}
    df = df.withColumns({**fixed, **cols})
    topics = ["topic_0", "topic_1", "topic_2", "topic_3"]
    df = df.withColumns({t: F.lit(None).cast("string") for t in topics if t not in df.columns})
    return df.select("block_number", "block_timestamp", "tx_hash", "event_index", "contract_address", F.array(*topics).alias("topics"), *topics, "data", "event_removed", "origin_from_address", "origin_to_address",
                     "origin_function_signature", "tx_succeeded", "tx_position", "fact_event_logs_id", F.col("block_timestamp").alias("modified_timestamp"))


def pick(rows, i):
    """i-th factory of a fixed list."""
    return F.element_at(F.array(*[F.lit(r[0]) for r in rows]), (i % len(rows) + 1).cast("int"))


def creations(t) -> DataFrame:
    pair = F.col("p_type").isin("ECONOMY", "SMALL")
    pool, spacing = F.col("p_partkey") + 10**9, F.col("p_size").cast("bigint")
    return _log_columns(
        t.part, block_number=F.col("p_partkey"), block_timestamp=F.lit(CREATED).cast("timestamp_ntz"), tx_hash=F.concat(F.lit("0xp"), F.col("p_partkey")), event_index=F.lit(0).cast("bigint"),
        contract_address=F.when(pair, pick(D.PAIR_FACTORIES, F.col("p_size"))).otherwise(pick(D.POOL_FACTORIES, F.col("p_size"))), topic_0=F.when(pair, F.lit(D.PAIR_CREATED)).otherwise(F.lit(D.POOL_CREATED)),
        topic_1=topic(F.col("p_partkey") * 2), topic_2=topic(F.col("p_partkey") * 2 + 1), topic_3=F.when(~pair, topic(spacing * 100)),
        data=F.concat(F.lit("0x"), F.when(pair, F.concat(word(pool), word(spacing))).otherwise(F.concat(signed_word(-spacing), word(pool)))), origin_from_address=F.lit("0xa"), origin_to_address=F.lit("0xb"))


def swap_logs(t) -> DataFrame:
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").isin("ECONOMY", "SMALL").alias("pair"))
    rows = lines(t).join(kinds, "l_partkey").withColumn("amt", F.col("qty") * 1000)
    flag, z = F.col("l_returnflag"), F.lit(0).cast("bigint")
    v2 = F.when(flag == "A", F.concat(word(F.col("amt")), word(z), word(z), word(F.col("cents")))).when(flag == "N", F.concat(word(z), word(F.col("amt")), word(F.col("cents")), word(z))).otherwise(
        F.concat(word(F.col("qty")), word(F.col("amt")), word(F.col("cents")), word(z)))
    a0 = F.when(flag == "A", F.col("amt")).otherwise(-F.col("cents"))
    a1 = F.when(flag == "A", -F.col("cents")).otherwise(F.col("amt"))
    v3 = F.concat(signed_word(a0), signed_word(a1), word(F.col("cents")), word(F.col("qty")), signed_word(-F.col("disc")))
    return _log_columns(
        rows, block_timestamp=F.col("ts"), event_index=F.lit(1).cast("bigint"), contract_address=address(F.col("l_partkey") + 10**9), topic_0=F.when(F.col("pair"), F.lit(D.SWAP_V2)).otherwise(F.lit(D.SWAP_V3)),
        topic_1=topic("l_suppkey"), topic_2=topic("l_orderkey"), data=F.concat(F.lit("0x"), F.when(F.col("pair"), v2).otherwise(v3)), origin_from_address=address("l_suppkey"), origin_to_address=address("l_orderkey"))


def tokens(t) -> DataFrame:
    """Token data: the first token of a part always, the second when the part is large."""
    first = t.part.select(address(F.col("p_partkey") * 2).alias("address"), F.concat(F.lit("T"), F.col("p_partkey")).alias("symbol"), "p_name", (F.col("p_size") % 10).cast("int").alias("decimals"))
    second = t.part.filter("p_size > 25").select(address(F.col("p_partkey") * 2 + 1).alias("address"), F.concat(F.lit("U"), F.col("p_partkey")).alias("symbol"), "p_name", F.lit(3).alias("decimals"))
    return first.unionByName(second).withColumnRenamed("p_name", "name")


def token_prices(t) -> DataFrame:
    days = t.lineitem.filter("l_discount > 0.02").select("l_partkey", F.col("l_shipdate").alias("hour")).distinct().join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    first = days.select("hour", address(F.col("l_partkey") * 2).alias("token_address"), (F.col("p_retailprice") / 3.14159).alias("price"), F.lit(True).alias("is_verified"))
    second = days.select("hour", address(F.col("l_partkey") * 2 + 1).alias("token_address"), (F.col("p_retailprice") / 2.71828).alias("price"), F.lit(False).alias("is_verified"))
    return first.unionByName(second)


def _case(rows, key):
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(rows))
    return f"case {key} % {len(rows)} {whens} end"


PLATFORM2 = _case([f"{r[1]}-{r[2]}" for r in D.PAIR_FACTORIES], "p_size")
PLATFORM3 = _case([f"{r[1]}-{r[2]}" for r in D.POOL_FACTORIES], "p_size")


def shorts(c):
    return f"(substr({addr(c)}, 1, 5) || '...' || substr({addr(c)}, 39))"


VIEWS.update({
    "x_pool": f"""select p_partkey, p_size, p_type, {addr('(p_partkey + 1000000000)')} as pool_address, case when p_type in ('ECONOMY', 'SMALL') then {PLATFORM2} else {PLATFORM3} end as platform, {addr('(p_partkey * 2)')} as token0, {addr('(p_partkey * 2 + 1)')} as token1,
        'T' || p_partkey as symbol0, case when p_size > 25 then 'U' || p_partkey end as symbol1, p_size % 10 as decimals0, case when p_size > 25 then 3 end as decimals1, p_retailprice / 3.14159 as price0, p_retailprice / 2.71828 as price1 from part""",
    "x_name": f"""select *, symbol0 || '-' || coalesce(symbol1, {shorts('(p_partkey * 2 + 1)')}) || case platform when 'uniswap-v3' then ' ' || p_size * 100 || ' ' || -p_size || ' UNI-V3 LP' when 'dragonswap-v2' then ' ' || p_size * 100 || ' ' || -p_size || ' DRAGON-V2 LP' else '' end as pool_name from x_pool""",
    "x_swap": """select l.tx_hash, l.ts, l.l_returnflag, p.*, l.l_partkey, case when l_returnflag = 'A' then 0 else 1 end as side, qty * 1000 as amount_in_unadj, cents as amount_out_unadj from e_line l join x_name p on p.p_partkey = l.l_partkey""",
    "x_full": """select s.*, case side when 0 then token0 else token1 end as token_in, case side when 0 then token1 else token0 end as token_out, case side when 0 then decimals0 else decimals1 end as decimals_in, case side when 0 then decimals1 else decimals0 end as decimals_out,
        case when d.hour is not null then case side when 0 then price0 else price1 end end as price_in, case when d.hour is not null then case side when 0 then price1 else price0 end end as price_out, d.hour is not null as priced
        from x_swap s left join (select distinct l_partkey as pk, l_shipdate as hour from lineitem where l_discount > 0.02) d on d.pk = s.l_partkey and d.hour = s.ts""",
    "x_done": """select *, case when decimals_in is null then cast(amount_in_unadj as double) else amount_in_unadj / power(10.0, decimals_in) end as amount_in, case when decimals_out is null then cast(amount_out_unadj as double) else amount_out_unadj / power(10.0, decimals_out) end as amount_out from x_full""",
    "x_usd": "select *, case when decimals_in is not null then amount_in * price_in end as in_usd, case when decimals_out is not null then amount_out * price_out end as out_usd from x_done",
})


def _vault_id():
    """A supplier's pool: an address and twelve more bytes."""
    return F.concat(address(F.col("s_suppkey") + VAULT), F.lpad(hexn("s_suppkey"), 24, "0"))


def _vault_log(df: DataFrame, **cols) -> DataFrame:
    return _log_columns(df, block_number=F.col("s_suppkey"), block_timestamp=F.lit(CREATED).cast("timestamp_ntz"), tx_hash=F.concat(F.lit("0xv"), F.col("s_suppkey")), contract_address=F.lit(D.VAULTS[0][0]),
                        topic_1=_vault_id(), data=F.lit("0x"), origin_from_address=F.lit("0xa"), origin_to_address=F.lit("0xb"), **cols)


def vault_registrations(t) -> DataFrame:
    return _vault_log(t.supplier, event_index=F.lit(0).cast("bigint"), topic_0=F.lit(D.POOL_REGISTERED))


def vault_pools(t) -> DataFrame:
    """Suppliers are pools of two to five tokens, those of the parts that follow their number. A tenth was never read."""
    n = (F.col("s_suppkey") % 4 + 2).cast("int")
    listed = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit('"'), address((F.col("s_suppkey") + i) * 2), F.lit('"')))
    told = F.create_map(F.lit("poolId"), _vault_id(), F.lit("tokens"), F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")), F.lit("assetManagers"), F.lit("[]"))
    decoded = _vault_log(t.supplier.withColumn("told", told), event_index=F.lit(1).cast("bigint"), topic_0=F.lit(D.TOKENS_REGISTERED))
    maps = t.supplier.select(F.concat(F.lit("0xv"), F.col("s_suppkey")).alias("tx_hash"), told.alias("decoded_log"))
    text = lambda c: F.concat(F.lit("0x"), word(F.lit(32).cast("bigint")), word(F.length(c).cast("bigint")), F.rpad(F.lower(F.hex(c.cast("binary"))), 64, "0"))
    answer = {V.READ_NAME: text(F.concat(F.lit("Pool "), F.col("s_suppkey"))), V.READ_SYMBOL: text(F.concat(F.lit("P"), F.col("s_suppkey"))), V.READ_DECIMALS: F.concat(F.lit("0x"), word(F.lit(18).cast("bigint")))}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("function_sig"), v.alias("read_result")) for k, v in answer.items()]))
    read = t.supplier.filter("s_suppkey % 10 <> 0").select(address(F.col("s_suppkey") + VAULT).alias("pool_address"), each.alias("a"), F.lit(CREATED).cast("timestamp_ntz").alias("_inserted_timestamp")).select("pool_address", "a.*", "_inserted_timestamp")
    return t.table("vault_pools", lambda: dex.vault_pools(vault_registrations(t), decoded.join(maps, "tx_hash"), read))


def vault_swap_logs(t) -> DataFrame:
    """Lines with status F swap one token of their supplier's pool for the next."""
    n = F.col("l_suppkey") % 4 + 2
    rows = lines(t).filter("l_linestatus = 'F'").withColumn("s_suppkey", F.col("l_suppkey")).withColumns({"i": F.col("l_linenumber") % n, "j": (F.col("l_linenumber") + 1) % n})
    return _log_columns(
        rows, block_timestamp=F.col("ts"), event_index=F.lit(7).cast("bigint"), contract_address=F.lit(D.VAULTS[0][0]), topic_0=F.lit(D.VAULT_SWAP), topic_1=_vault_id(), topic_2=topic((F.col("l_suppkey") + F.col("i")) * 2), topic_3=topic((F.col("l_suppkey") + F.col("j")) * 2),
        data=F.concat(F.lit("0x"), word(F.col("qty") * 500), word(F.col("cents") * 3)), origin_from_address=address("l_suppkey"), origin_to_address=address("l_orderkey"))


VIEWS.update({
    "y_pool": f"select s_suppkey, {addr(f'(s_suppkey + {VAULT})')} as pool_address, 'Pool ' || s_suppkey as pool_name, 'P' || s_suppkey as pool_symbol, unnest(range(0, s_suppkey % 4 + 2)) as i from supplier where s_suppkey % 10 <> 0",
    "y_token": f"select y.*, {addr('((s_suppkey + i) * 2)')} as token, case when p_partkey is not null then 'T' || p_partkey end as symbol, p_size % 10 as decimals from y_pool y left join part on p_partkey = s_suppkey + i",
    "y_named": """select pool_address, 'jellyswap-v1' as platform, pool_name, string_agg('token' || i || '=' || token, ',' order by i) as tokens, string_agg('token' || i || '=' || symbol, ',' order by i) as symbols, string_agg('token' || i || '=' || decimals, ',' order by i) as decimals from y_token group by 1, 2, 3""",
    "y_swap": f"""select tx_hash, ts, 'Pool ' || l_suppkey as pool_name, l_suppkey + l_linenumber % (l_suppkey % 4 + 2) as a, l_suppkey + (l_linenumber + 1) % (l_suppkey % 4 + 2) as b, qty * 500 as amount_in_unadj, cents * 3 as amount_out_unadj from e_line join supplier on s_suppkey = l_suppkey where l_linestatus = 'F' and l_suppkey % 10 <> 0""",
    "y_day": "select distinct l_partkey as pk, l_shipdate as hour from lineitem where l_discount > 0.02",
    "y_done": f"""select s.*, {addr('(a * 2)')} as token_in, {addr('(b * 2)')} as token_out, case when p.p_size is null then cast(amount_in_unadj as double) else amount_in_unadj / power(10.0, p.p_size % 10) end as amount_in, case when q.p_size is null then cast(amount_out_unadj as double) else amount_out_unadj / power(10.0, q.p_size % 10) end as amount_out,
        case when d.hour is not null then p.p_retailprice / 3.14159 end as price_in, case when e.hour is not null then q.p_retailprice / 3.14159 end as price_out
        from y_swap s left join part p on p.p_partkey = a left join part q on q.p_partkey = b left join y_day d on d.pk = a and d.hour = s.ts left join y_day e on e.pk = b and e.hour = s.ts""",
    "x_all": """select tx_hash, platform, pool_name, token_in, token_out, amount_in, amount_out, in_usd, out_usd from x_usd
        union all select tx_hash, 'jellyswap-v1', pool_name, token_in, token_out, amount_in, amount_out, amount_in * price_in, amount_out * price_out from y_done""",
})


@query("dex_pool_read_batches", f"""select pool_address, s_suppkey as block_number, (rn - 1) // 7 + 1 as batch_no, sig as function_sig, rpad(sig, 64, '0') as input from (select s_suppkey, {addr(f'(s_suppkey + {VAULT})')} as pool_address, row_number() over (order by s_suppkey) as rn from supplier),
    (values ('{V.READ_NAME}'), ('{V.READ_SYMBOL}'), ('{V.READ_DECIMALS}')) as f(sig)""")
def q_read_batches(t):
    return dex.pool_read_batches(dex.registered_pools(vault_registrations(t)), 7)


@query("dex_vault_pools", "select pool_address, pool_name, pool_symbol, 18 as pool_decimals, max(case when i = 0 then token end) as token0, max(case when i = 1 then token end) as token1, max(case when i = 4 then token end) as token4 from y_token group by 1, 2, 3")
def q_vault_pools(t):
    return vault_pools(t).select("pool_address", "pool_name", "pool_symbol", "pool_decimals", "token0", "token1", "token4")


@query("dex_vault_swaps", "select tx_hash, pool_name, token_in, token_out, amount_in_unadj || '' as amount_in_unadj, amount_out_unadj || '' as amount_out_unadj from y_done")
def q_vault_swaps(t):
    return dex.vault_swaps(vault_swap_logs(t), vault_pools(t)).select("tx_hash", "pool_name", "token_in", "token_out", "amount_in_unadj", "amount_out_unadj")


def pools(t):
    logs = creations(t)
    return dex.pairs_v2(logs), dex.pools_v3(logs), vault_pools(t)


def all_swaps(t, logs, v2p, v3p, vault):
    return dex.swaps_v2(logs, v2p), dex.swaps_v3(logs, v3p), dex.vault_swaps(vault_swap_logs(t), vault)


@query("dex_pools_v2", "select pool_address, token0, token1, platform, cast(p_size as varchar) as pool_id from x_pool where p_type in ('ECONOMY', 'SMALL')")
def q_v2_pools(t):
    return dex.pairs_v2(creations(t)).select("pool_address", "token0", "token1", "platform", "pool_id")


@query("dex_pools_v3", "select pool_address, token0 as token0_address, token1 as token1_address, platform, p_size * 100 as fee, p_size / 100.0 as fee_percent, -p_size as tick_spacing from x_pool where p_type not in ('ECONOMY', 'SMALL')")
def q_v3_pools(t):
    out = dex.pools_v3(creations(t)).select("pool_address", "token0_address", "token1_address", "platform", "fee", "fee_percent", "tick_spacing")
    return out


@query("dex_complete_pools", """select pool_address, platform, pool_name, 'token0=' || token0 || ',token1=' || token1 as tokens, 'token0=' || symbol0 || coalesce(',token1=' || symbol1, '') as symbols, 'token0=' || decimals0 || coalesce(',token1=' || decimals1, '') as decimals from x_name
    union all select pool_address, platform, pool_name, tokens, symbols, decimals from y_named""")
def q_pools(t):
    return dex.complete_pools(*pools(t), tokens(t)).select("pool_address", "platform", "pool_name", "tokens", "symbols", "decimals")


@query("dex_swaps_v2", """select tx_hash, token_in, token_out, cast(amount_in_unadj as varchar) as amount_in_unadj, cast(amount_out_unadj as varchar) as amount_out_unadj, platform from x_full where p_type in ('ECONOMY', 'SMALL')""")
def q_swaps_v2(t):
    v2, *_ = all_swaps(t, t.table("swap_logs", lambda: swap_logs(t)), *pools(t))
    return v2.select("tx_hash", "token_in", "token_out", "amount_in_unadj", "amount_out_unadj", "platform")


@query("dex_swaps_v3", """select tx_hash, token_in, token_out, cast(amount_in_unadj as double) as amount_in_unadj, cast(amount_out_unadj as double) as amount_out_unadj, platform from x_full where p_type not in ('ECONOMY', 'SMALL')""")
def q_swaps_v3(t):
    v2p, v3p, many = pools(t)
    v3p = t.table("fee_pools", lambda: v3p)

    def swaps(p, _):
        _, v3, _ = all_swaps(p, swap_logs(p), v2p, v3p, many)
        return [v3.select("tx_hash", "token_in", "token_out", "amount_in_unadj", "amount_out_unadj", "platform")]

    return by_parts(t, swaps, "swaps_v3", lazy=True)[0]


def complete(t, columns, prices=None, label="swaps"):
    """The named columns of the completed swaps, and the pools. The lines behind them go when the swaps are read."""
    v2p, v3p, many = pools(t)
    v2p, v3p, dims = t.table("pairs", lambda: v2p), t.table("fee_pools", lambda: v3p), tokens(t)
    named = t.table("pools", lambda: dex.complete_pools(v2p, v3p, many, dims))
    swaps = all_swaps(t, swap_logs(t), v2p, v3p, many)
    prices = token_prices(t) if prices is None else prices
    logs = measures(t).count() + vault_swap_logs(t).count()
    return dex.complete_swaps(*swaps, dims, prices, named, columns, logs, lambda: t.release("lines", "pairs", "fee_pools", "vault_pools"), label), named


@query("dex_complete_swaps", "select tx_hash, platform, pool_name, token_in, token_out, amount_in, amount_out, in_usd as amount_in_usd, out_usd as amount_out_usd from x_all")
def q_complete(t):
    out = ["tx_hash", "platform", "pool_name", "token_in", "token_out", "amount_in", "amount_out", "amount_in_usd", "amount_out_usd"]
    return complete(t, out)[0].select(*out)


@query("dex_ez_swaps", """select tx_hash, round(case when out_usd is null or abs((in_usd - out_usd) / nullif(out_usd, 0)) > 0.75 or abs((in_usd - out_usd) / nullif(in_usd, 0)) > 0.75 then null else in_usd end, 2) as amount_in_usd,
    round(case when in_usd is null or abs((out_usd - in_usd) / nullif(in_usd, 0)) > 0.75 or abs((out_usd - in_usd) / nullif(out_usd, 0)) > 0.75 then null else out_usd end, 2) as amount_out_usd from x_all""")
def q_ez(t):
    read = ["tx_hash", "version", "complete_dex_swaps_id", *[f"{c}_{s}{e}" for s in ("in", "out") for c, e in (("token", ""), ("token", "_is_verified"), ("amount", "_usd"))]]
    return dex.ez_swaps(complete(t, read)[0]).select("tx_hash", "amount_in_usd", "amount_out_usd")


@query("dex_heal_swaps", "select tx_hash, pool_name, in_usd as amount_in_usd, out_usd as amount_out_usd from x_all")
def q_heal(t):
    """Swaps stored before any price was known; one run heals every group that can gain."""
    prices, out = token_prices(t), ["tx_hash", "pool_name", "amount_in_usd", "amount_out_usd"]
    rows, named = complete(t, ["tx_hash", "pool_id", *dex.GROUP, *dex.LOOKED_UP, *dex.ENRICHED], prices.filter(F.lit(False)), "stored_swaps")
    stored = t.keep("stored_swaps", rows)
    return dex.heal_swaps(stored, tokens(t), prices, named, columns=out).select(*out)


# --- bridge ---------------------------------------------------------------------------------------


def burn_logs(t) -> DataFrame:
    evm = F.col("l_linestatus") == "O"
    to = F.when(evm, word(F.col("l_orderkey"))).otherwise(F.lpad(hexn("l_orderkey"), 64, "e"))
    return _log_columns(
        lines(t), block_timestamp=F.col("ts"), event_index=F.lit(2).cast("bigint"), contract_address=F.lit(B.BURNERS[0][0]), topic_0=F.lit(B.DEPOSIT_FOR_BURN), topic_1=topic(F.col("l_partkey") * 2), topic_2=topic("l_suppkey"),
        data=F.concat(F.lit("0x"), word(F.col("qty") * 1000), to, word(F.col("l_linenumber")), to, to), origin_from_address=address("l_suppkey"), origin_to_address=address("l_orderkey"))


def domains(t):
    return t.nation.filter("n_regionkey <> 3").select(F.col("n_nationkey").alias("domain"), F.lower("n_name").alias("chain"))


VIEWS["x_burn"] = f"""select l.*, {addr('(l_partkey * 2)')} as token_address, case when l_linestatus = 'O' then {addr('l_orderkey')} else lpad(lower(to_hex(l_orderkey)), 64, 'e') end as receiver, lower(n_name) as chain, p_size % 10 as decimals, p_retailprice / 3.14159 as price0, 'T' || l_partkey as symbol
    from e_line l join part on p_partkey = l_partkey left join nation on n_nationkey = l_linenumber and n_regionkey <> 3"""


@query("bridge_burns", f"select tx_hash, token_address, {addr('l_suppkey')} as sender, receiver as destination_chain_receiver, cast(l_linenumber as varchar) as destination_chain_id, chain as destination_chain, cast(qty * 1000 as varchar) as amount_unadj from x_burn")
def q_burns(t):
    return bridge.burns(burn_logs(t), domains(t)).select("tx_hash", "token_address", "sender", "destination_chain_receiver", "destination_chain_id", "destination_chain", "amount_unadj")


@query("bridge_complete_activity", """with n as (select n_nationkey, lower(n_name) as nm from nation), d as (select distinct l_partkey as pk, l_shipdate as hour from lineitem where l_discount > 0.02)
    select tx_hash, coalesce(chain, nm) as destination_chain, symbol as token_symbol, qty * 1000 / power(10.0, decimals) as amount, case when d.hour is not null then round(qty * 1000 / power(10.0, decimals) * price0, 2) end as amount_usd, d.hour is not null as token_is_verified
    from x_burn b left join n on n.n_nationkey = b.l_linenumber left join d on d.pk = b.l_partkey and d.hour = b.ts where coalesce(chain, nm) is not null and coalesce(chain, nm) <> 'sei'""")
def q_activity(t):
    """Chains the seed does not name are found by id in a second table."""
    return activity(t, ["tx_hash", "destination_chain"], token_prices(t)).select("tx_hash", "destination_chain", "token_symbol", "amount", "amount_usd", "token_is_verified")


def activity(t, columns, prices, store: bool = False) -> DataFrame:
    """The named columns of the completed burns, and what is looked up for them. Chosen by transactions, looked up by time."""
    chains = t.nation.select(F.col("n_nationkey").alias("chain_id"), F.col("n_name").alias("chain"))
    read = list(dict.fromkeys([*columns, *bridge.LOOKED_UP]))
    best = by_parts(t, lambda p, _: [bridge.newest_activity([bridge.burns(burn_logs(p), domains(p))], chains).select(*read)], "newest_activity")[0]
    t.release("line_parts", "lines")
    return bridge.enriched_in_parts(best, columns, tokens(t), prices, evm.PART, "activity", store)


@query("bridge_ez_activity", """with n as (select n_nationkey, lower(n_name) as nm, n_regionkey from nation), d as (select distinct l_partkey as pk, l_shipdate as hour from lineitem where l_discount > 0.02)
    select tx_hash, coalesce(r_name, coalesce(chain, nm)) as destination_chain, case when d.hour is not null then round(qty * 1000 / power(10.0, decimals) * price0, 2) end as amount_usd
    from x_burn b left join n on n.n_nationkey = b.l_linenumber left join region on n.n_regionkey = r_regionkey and r_regionkey = 1 left join d on d.pk = b.l_partkey and d.hour = b.ts where coalesce(chain, nm) is not null""")
def q_ez_activity(t):
    """Chains of one region go by the region's name."""
    standard = t.nation.filter("n_regionkey = 1").join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.lower("n_name").alias("variation"), F.col("r_name").alias("standardized_name"))
    return bridge.ez_activity(activity(t, ["tx_hash", "destination_chain"], token_prices(t)), standard).select("tx_hash", "destination_chain", "amount_usd")


@query("bridge_heal_activity", """with n as (select n_nationkey, lower(n_name) as nm from nation), d as (select distinct l_partkey as pk, l_shipdate as hour from lineitem where l_discount > 0.02)
    select tx_hash, case when d.hour is not null then round(qty * 1000 / power(10.0, decimals) * price0, 2) end as amount_usd from x_burn b join n on n.n_nationkey = b.l_linenumber left join d on d.pk = b.l_partkey and d.hour = b.ts""")
def q_heal_activity(t):
    """Stored without any price. A group to heal lies in one block."""
    prices = token_prices(t)
    read = ["tx_hash", *bridge.GROUP, *bridge.LOOKED_UP]
    stored = activity(t, read, prices.filter(F.lit(False)), store=True)
    cuts = inc.ranges(stored, "block_number", evm.PART)
    near = (lambda some: dex.prices_during(some, prices)) if len(cuts) > 1 else (lambda some: prices)
    healed = (bridge.heal_activity(some, tokens(t), near(some)).select("tx_hash", "amount_usd") for some in map(stored.filter, cuts))
    return next(healed) if len(cuts) == 1 else staged_parts(healed, "healed_activity")
