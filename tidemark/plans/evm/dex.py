"""Exchange pools and swaps out of event logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.common import newest, surrogate_key, usd_unless_outlier
from ...functions.hexwords import hex_to_number, hex_to_text, hex_words, signed_hex_to_number, topic_address, word
from ...functions.labels import joined_sides, pair_name, pool_label, side_name
from ...operators import increments as inc
from ...operators.joins import hourly, many_roles
from ...operators.sets import union_all
from ...operators.windows import consecutive, dedup_latest
from ...session import Relay, discard, staged, staged_parts
from ...sources.files import inline_map
from ..audit import keyed
from . import dex_values as D
from . import values as V

ORIGIN = ["origin_function_signature", "origin_from_address", "origin_to_address"]
KIND = ["platform", "protocol", "version", "type"]
STAMP = "modified_timestamp"


def _factories(df: DataFrame, rows: list[tuple]) -> DataFrame:
    return inline_map(df.sparkSession, rows, ["contract_address", "protocol", "version", "type"])


def _logs(logs: DataFrame, topic: str) -> DataFrame:
    log_id = F.concat("tx_hash", F.lit("-"), F.col("event_index").cast("string"))
    return logs.filter((F.col("topic_0") == topic) & F.col("tx_succeeded")).withColumn("_log_id", log_id).withColumn("_w", hex_words("data"))


def platform() -> Column:
    return F.concat("protocol", F.lit("-"), "version").alias("platform")


def short_word(words, i: int) -> Column:
    """Address in the last 20 bytes of a data word."""
    return topic_address(word(words, i))


# --- pools --------------------------------------------------------------------------------------------


def pairs_v2(logs: DataFrame, factories: list[tuple] = D.PAIR_FACTORIES) -> DataFrame:
    """Pairs created by known factories, newest creation per address."""
    rows = _logs(logs, D.PAIR_CREATED).join(_factories(logs, factories), "contract_address")
    out = rows.select(
        "block_number", "block_timestamp", "tx_hash", "contract_address", "event_index", F.lit("PairCreated").alias("event_name"), topic_address("topic_1").alias("token0"), topic_address("topic_2").alias("token1"),
        short_word("_w", 0).alias("pool_address"), hex_to_number(word("_w", 1)).alias("pool_id"), platform(), "protocol", "version", "type", "_log_id", STAMP)
    return dedup_latest(out, ["pool_address"], [newest(STAMP), newest("_log_id")])


def pools_v3(logs: DataFrame, factories: list[tuple] = D.POOL_FACTORIES) -> DataFrame:
    """Pools with fee and tick spacing (signed words), newest creation per address."""
    rows = _logs(logs, D.POOL_CREATED).join(_factories(logs, factories), "contract_address")
    fee = signed_hex_to_number("topic_3").cast("bigint")
    out = rows.select(
        "block_number", "block_timestamp", "tx_hash", "event_index", F.lit("PoolCreated").alias("event_name"), "contract_address", F.lower(topic_address("topic_1")).alias("token0_address"),
        F.lower(topic_address("topic_2")).alias("token1_address"), fee.alias("fee"), (fee / 10000).alias("fee_percent"), signed_hex_to_number(word("_w", 0)).cast("bigint").alias("tick_spacing"),
        short_word("_w", 1).alias("pool_address"), platform(), "protocol", "version", "type", "_log_id", STAMP)
    return dedup_latest(out, ["pool_address"], [newest(STAMP), newest("_log_id")])


def registered_pools(logs: DataFrame, vaults: list[tuple] = D.VAULTS) -> DataFrame:
    rows = _logs(logs, D.POOL_REGISTERED).join(_factories(logs, vaults), "contract_address")
    return rows.select("block_number", "block_timestamp", "event_index", "tx_hash", "contract_address", F.col("topic_1").alias("pool_id"), F.substring("topic_1", 1, 42).alias("pool_address"),
                       platform(), "protocol", "version", "type", F.lit("PoolRegistered").alias("event_name"), "_log_id", F.col(STAMP).alias("_inserted_timestamp"))


def pool_read_batches(pools: DataFrame, size: int = D.READ_BATCH) -> DataFrame:
    """Reads still to make: every pool with each of three functions, in numbered batches of pools by address."""
    by_address = pools.groupBy("pool_address").agg(F.max("block_number").alias("block_number"))
    numbered = consecutive(by_address, ["pool_address"], "row_no").withColumn("batch_no", F.expr(f"(row_no - 1) div {size} + 1")).drop("row_no")
    sigs = F.array(*[F.lit(s) for s in (V.READ_NAME, V.READ_SYMBOL, V.READ_DECIMALS)])
    return numbered.select("pool_address", "block_number", "batch_no", F.explode(sigs).alias("function_sig")).withColumn("input", F.rpad("function_sig", 64, "0"))


def vault_pools(logs: DataFrame, decoded: DataFrame, reads: DataFrame, vaults: list[tuple] = D.VAULTS) -> DataFrame:
    """Pools of several tokens with names read from the chain; `reads` holds (pool_address, function_sig,
    read_result, _inserted_timestamp)."""
    pools = registered_pools(logs, vaults)
    made = pools.select("tx_hash").distinct()
    tokens = decoded.filter((F.col("topic_0") == D.TOKENS_REGISTERED) & F.col("tx_succeeded")).join(_factories(logs, vaults), "contract_address").join(made, "tx_hash", "left_semi")
    listed = F.from_json(F.col("decoded_log")["tokens"], "array<string>")
    tokens = tokens.select(F.col("decoded_log")["poolId"].alias("pool_id"), *[F.get(listed, F.lit(i)).alias(f"token{i}") for i in range(D.MAX_TOKENS)], F.col("decoded_log")["assetManagers"].alias("asset_managers"))
    text = hex_to_text(word(hex_words("read_result"), 2))
    digits = F.when(F.col("read_result") != "0x", hex_to_number(F.left("read_result", F.lit(66))))
    by_pool = reads.groupBy("pool_address").agg(
        F.min(F.when(F.col("function_sig") == V.READ_SYMBOL, text)).alias("pool_symbol"), F.min(F.when(F.col("function_sig") == V.READ_NAME, text)).alias("pool_name"),
        F.min(digits).cast("int").alias("pool_decimals"), F.max("_inserted_timestamp").alias("_read_at"))
    rows = by_pool.join(pools, "pool_address", "left").join(tokens, "pool_id", "left").filter(F.col("token0").isNotNull())
    best = dedup_latest(rows, ["pool_address"], [newest("_read_at"), newest("_log_id")])
    return best.drop("_inserted_timestamp").withColumnRenamed("_read_at", "_inserted_timestamp")


POOL = ["block_number", "block_timestamp", "tx_hash", "contract_address", "pool_address", "pool_id", "pool_name", "fee", "tick_spacing", *[f"token{i}" for i in range(D.MAX_TOKENS)], *KIND, "_id", "_inserted_timestamp"]


def _as_pool(df: DataFrame, **cols: Column) -> DataFrame:
    none = {"pool_name": "string", "fee": "bigint", "tick_spacing": "bigint", **{f"token{i}": "string" for i in range(D.MAX_TOKENS)}}
    df = df.withColumns({"pool_id": F.lit(D.NO_POOL_ID), "_id": F.col("_log_id"), **cols})
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in none.items() if c not in df.columns})
    return df.select(*POOL)


def all_pools(v2: DataFrame, v3: DataFrame, vault: DataFrame) -> DataFrame:
    stamp = F.col(STAMP)
    return union_all([
        _as_pool(v3, token0=F.col("token0_address"), token1=F.col("token1_address"), _inserted_timestamp=stamp),
        _as_pool(v2, _inserted_timestamp=stamp),
        _as_pool(vault)])


def token_dim(contracts: DataFrame) -> DataFrame:
    """Token data, the chain coin under the zero address with the wrapped coin's decimals."""
    cols = [F.col("address").alias("contract_address"), F.col("symbol").alias("token_symbol"), F.col("decimals").alias("token_decimals")]
    coin = contracts.filter(F.col("address") == V.WRAPPED_NATIVE).select(F.lit(V.ZERO_ADDRESS).alias("contract_address"), F.lit(D.COIN_SYMBOL).alias("token_symbol"), F.col("decimals").alias("token_decimals"))
    return contracts.select(*cols).unionByName(coin)


def coin_prices(prices: DataFrame) -> DataFrame:
    """Hourly prices, the chain coin under the zero address at the wrapped coin's price."""
    cols = ["token_address", "hour", "price", "is_verified"]
    return prices.select(*cols).unionByName(prices.filter(F.col("token_address") == V.WRAPPED_NATIVE).withColumn("token_address", F.lit(V.ZERO_ADDRESS)).select(*cols))


def name_pools(pools: DataFrame, contracts: DataFrame) -> DataFrame:
    """Pools with token, symbol and decimals maps and a display name.

    The eight token columns become rows, meet the token table in one join, and come back as maps.
    """
    key = ["pool_address", "pool_id"]
    tokens = F.array(*[F.col(f"token{i}") for i in range(D.MAX_TOKENS)])
    maps = many_roles(pools, key, tokens, token_dim(contracts), "contract_address", ["token_symbol", "token_decimals"])
    maps = maps.withColumnsRenamed({"token_symbol_by_token": "symbols", "token_decimals_by_token": "decimals"})
    rows = pools.join(maps, key, "left")

    def side(i):
        return F.try_element_at(F.col("symbols"), F.lit(f"token{i}")), F.col(f"token{i}")

    two = [side(0), side(1)]
    own = F.col("pool_name")
    hook = F.right(own, F.lit(42))
    hooked = F.concat(pool_label(two, "fee", "tick_spacing", ""), F.when(hook.rlike("^0x[0-9a-fA-F]+$"), hook).otherwise(F.lit("")), F.lit(f" {D.HOOKED_SUFFIX}"))
    name = F.when((F.col("platform") != D.HOOKED) & own.isNotNull(), own)
    for p, suffix in D.FEE_SUFFIX.items():
        name = name.when(own.isNull() & (F.col("platform") == p), pool_label(two, "fee", "tick_spacing", suffix))
    name = name.when(own.isNull() & (F.col("platform") == D.MANY_TOKENS), joined_sides([side(i) for i in range(D.MAX_TOKENS)]))
    name = name.when(F.col("platform") == D.HOOKED, hooked).otherwise(F.concat(side_name(*two[0]), F.lit("-"), side_name(*two[1])))
    return rows.withColumn("pool_name", name).withColumn("complete_dex_liquidity_pools_id", surrogate_key(*key))


def complete_pools(v2: DataFrame, v3: DataFrame, vault: DataFrame, contracts: DataFrame) -> DataFrame:
    return name_pools(all_pools(v2, v3, vault), contracts)


GROUP = ["block_number", "platform", "version"]


def heal_pools(stored: DataFrame, contracts: DataFrame) -> DataFrame:
    """Target with whole (block, platform, version) groups named again where a token without decimals is
    known now."""
    known = token_dim(contracts).filter(F.col("token_decimals").isNotNull()).select(F.col("contract_address").alias("_tok"))
    missing = F.filter(F.map_keys("tokens"), lambda k: ~F.map_contains_key(F.coalesce("decimals", F.create_map().cast("map<string,int>")), k))
    open_tokens = stored.select(*GROUP, F.explode(F.transform(missing, lambda k: F.col("tokens")[k])).alias("_tok"))
    groups = open_tokens.join(known, "_tok", "left_semi").select(*GROUP).distinct()

    def again(members):
        # a name made of addresses is made anew; one read from the chain stays
        made = F.col("platform").isin(*D.FEE_SUFFIX) | F.col("pool_name").contains("...")
        fresh = members.withColumn("pool_name", F.when(~made, F.col("pool_name"))).select(*POOL)
        return name_pools(fresh, contracts).select(*stored.columns)

    return inc.heal_groups(stored, groups, GROUP, again)


# --- swaps --------------------------------------------------------------------------------------------


SWAP_BASE = ["block_number", "block_timestamp", "tx_hash", "event_index", "event_name", *ORIGIN, "contract_address", "sender", "tx_to", "amount_in_unadj", "amount_out_unadj", "token_in", "token_out", *KIND, "_log_id", STAMP]


def swaps_v2(logs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Swaps of pairs; the legs are the non-zero amounts, and where both came in and the first goes out the
    second counts as the input."""
    p = pairs.select(F.col("pool_address").alias("contract_address"), "token0", "token1", *KIND)
    rows = _logs(logs, D.SWAP_V2).join(p, "contract_address")
    rows = rows.withColumns({n: hex_to_number(word("_w", i)) for i, n in enumerate(("_in0", "_in1", "_out0", "_out1"))})
    i0, i1, o0, o1 = [F.coalesce(F.col(c) != 0, F.lit(False)) for c in ("_in0", "_in1", "_out0", "_out1")]
    second = (i0 & i1 & o0) | (~i0 & i1)
    out = rows.select(
        "block_number", "block_timestamp", "tx_hash", "event_index", F.lit("Swap").alias("event_name"), *ORIGIN, "contract_address", topic_address("topic_1").alias("sender"), topic_address("topic_2").alias("tx_to"),
        F.when(second, F.col("_in1")).when(i0, F.col("_in0")).alias("amount_in_unadj"), F.when(o0, F.col("_out0")).when(o1, F.col("_out1")).alias("amount_out_unadj"),
        F.when(second, F.col("token1")).when(i0, F.col("token0")).alias("token_in"), F.when(o0, F.col("token0")).when(o1, F.col("token1")).alias("token_out"), *KIND, "_log_id", STAMP)
    return out.filter(F.col("token_in") != F.col("token_out"))


def swaps_v3(logs: DataFrame, pools: DataFrame) -> DataFrame:
    """Swaps of pools; a positive amount came in, a negative one went out. Newest row per log."""
    p = pools.select(F.col("pool_address").alias("contract_address"), "token0_address", "token1_address", "fee", "tick_spacing", *KIND)
    rows = _logs(logs, D.SWAP_V3).join(p, "contract_address")
    words = {"_a0": 0, "_a1": 1, "_sqrt": 2, "liquidity": 3, "tick": 4}
    rows = rows.withColumns({n: signed_hex_to_number(word("_w", i)).cast("double") for n, i in words.items()})
    a0, a1 = F.col("_a0"), F.col("_a1")
    out = rows.select(
        "block_number", "block_timestamp", "tx_hash", "event_index", F.lit("Swap").alias("event_name"), *ORIGIN, "contract_address", topic_address("topic_1").alias("sender"), topic_address("topic_2").alias("tx_to"),
        F.abs(F.when(a0 > 0, a0).otherwise(a1)).alias("amount_in_unadj"), F.abs(F.when(a0 < 0, a0).otherwise(a1)).alias("amount_out_unadj"),
        F.when(a0 > 0, F.col("token0_address")).otherwise(F.col("token1_address")).alias("token_in"), F.when(a0 < 0, F.col("token0_address")).otherwise(F.col("token1_address")).alias("token_out"),
        *KIND, "_log_id", STAMP, "fee", "tick", "tick_spacing", "liquidity", a0.alias("amount0_unadj"), a1.alias("amount1_unadj"))
    return dedup_latest(out, ["_log_id"], [newest(STAMP), newest("block_number")])


def vault_swaps(logs: DataFrame, pools: DataFrame) -> DataFrame:
    """Swaps of the vault's pools."""
    p = pools.select("pool_address", F.coalesce("pool_name", "pool_symbol").alias("pool_name"), *KIND)
    vault = pools.select("contract_address").distinct()
    rows = _logs(logs, D.VAULT_SWAP).join(vault, "contract_address", "left_semi").withColumn("pool_address", F.substring("topic_1", 1, 42)).join(p, "pool_address")
    return rows.select(
        "block_number", "block_timestamp", "tx_hash", "event_index", F.lit("Swap").alias("event_name"), *ORIGIN, F.col("pool_address").alias("contract_address"), F.col("origin_from_address").alias("sender"),
        F.col("origin_from_address").alias("tx_to"), hex_to_number(word("_w", 0)).alias("amount_in_unadj"), hex_to_number(word("_w", 1)).alias("amount_out_unadj"), topic_address("topic_2").alias("token_in"),
        topic_address("topic_3").alias("token_out"), *KIND, "_log_id", STAMP, F.col("topic_1").alias("vault_pool_id"), "pool_name")


ENRICHED = ["token_in_is_verified", "decimals_in", "symbol_in", "amount_in", "amount_in_usd", "token_out_is_verified", "decimals_out", "symbol_out", "amount_out", "amount_out_usd", "pool_name"]
SWAP = ["block_number", "block_timestamp", "tx_hash", *ORIGIN, "contract_address", "pool_name", "pool_id", "event_name", "amount_in_unadj", "amount_in", "amount_in_usd", "amount_out_unadj", "amount_out", "amount_out_usd",
        "sender", "tx_to", "event_index", *KIND, "token_in", "token_in_is_verified", "token_out", "token_out_is_verified", "symbol_in", "symbol_out", "decimals_in", "decimals_out", "_log_id", "_inserted_timestamp", "complete_dex_swaps_id"]


#: What the lookups read of a swap, and what the choice of the newest row does.
LOOKED_UP = ["block_timestamp", "contract_address", "amount_in_unadj", "amount_out_unadj", "token_in", "token_out"]
CHOICE = ["_log_id", "block_number", STAMP]
#: Rows that are looked up at a time.
PART = 1 << 22


def swap_base(columns: list[str] = SWAP) -> list[str]:
    """Columns of SWAP_BASE that stand behind the given columns of a completed swap."""
    named = ["tx_hash", "event_index"] if "complete_dex_swaps_id" in columns else []
    return [c for c in SWAP_BASE if c in (*columns, *LOOKED_UP, *CHOICE, *named)]


def enrich_swaps(rows: DataFrame, contracts: DataFrame, prices: DataFrame, pools: DataFrame, relay: Relay | None = None) -> DataFrame:
    """Decimals, symbols, hourly USD values and the pool's name. Token and price tables are joined once per
    side; their sizes decide between broadcast and sort-merge at run time.

    Each lookup sends the swaps by another key. They are stored after each, so that the disks hold the shuffles of one
    lookup at a time, and not those of all.
    """
    relay = relay or Relay("swaps")
    tokens, hourly_prices = token_dim(contracts), coin_prices(prices)
    for s in ("in", "out"):
        dim = tokens.select(F.col("contract_address").alias(f"token_{s}"), F.col("token_decimals").alias(f"decimals_{s}"), F.col("token_symbol").alias(f"symbol_{s}"))
        rows = relay.store(rows.join(dim, f"token_{s}", "left"))
        rows = hourly(rows, hourly_prices, f"token_{s}", "block_timestamp", "token_address", "hour", ("price", "is_verified"), f"_{s}_")
        raw = F.col(f"amount_{s}_unadj").cast("double")
        rows = rows.withColumn(f"amount_{s}", F.when(F.col(f"decimals_{s}").isNull(), raw).otherwise(raw / F.pow(F.lit(10.0), F.col(f"decimals_{s}"))))
        rows = rows.withColumn(f"amount_{s}_usd", F.when(F.col(f"decimals_{s}").isNotNull(), F.col(f"amount_{s}") * F.col(f"_{s}_price")))
        rows = rows.withColumn(f"token_{s}_is_verified", F.coalesce(f"_{s}_is_verified", F.lit(False))).drop(f"_{s}_price", f"_{s}_is_verified")
        rows = relay.store(rows)
    names = pools.select(F.col("pool_address").alias("contract_address"), "pool_id", F.col("pool_name").alias("_pool"))
    rows = rows.join(names, ["contract_address", "pool_id"], "left")
    made = pair_name(side_name("symbol_in", "token_in"), side_name("symbol_out", "token_out"))
    return rows.withColumn("pool_name", F.coalesce("_pool", made)).drop("_pool")


def newest_swaps(v2: DataFrame, v3: DataFrame, vault: DataFrame, columns: list[str] = SWAP) -> DataFrame:
    """All protocols in one shape, newest row per log, with what stands behind the given columns of a completed swap."""
    base = swap_base(columns)
    rows = union_all([df.select(*base).withColumns({c: F.col(c).cast("double") for c in ("amount_in_unadj", "amount_out_unadj")}) for df in (vault, v3, v2)])
    rows = rows.withColumn("pool_id", F.lit(D.NO_POOL_ID)).withColumnRenamed(STAMP, "_inserted_timestamp")
    best = dedup_latest(rows, ["_log_id"], [newest("_inserted_timestamp"), newest("block_number")])
    return best.drop(*[c for c in ("_log_id", "_inserted_timestamp", "block_number") if c not in columns])


def prices_during(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """The prices of the hours from the first swap to the last."""
    def micros(c):
        return F.unix_micros(F.col(c).cast("timestamp"))
    hours = rows.select(F.date_trunc("hour", "block_timestamp").alias("h"))
    ends = hours.agg(F.min(micros("h")).alias("lo"), F.max(micros("h")).alias("hi")).first()
    return prices.filter(micros("hour").between(ends["lo"], ends["hi"]) if ends["lo"] is not None else F.lit(False))


def complete_swaps(v2: DataFrame, v3: DataFrame, vault: DataFrame, contracts: DataFrame, prices: DataFrame, pools: DataFrame, columns: list[str] = SWAP, logs: int = 0, spent=None, label: str = "swaps") -> DataFrame:
    """All protocols in one shape, newest row per log. Only the `columns` asked for are carried through the lookups.

    Everything is done in parts, so that the disks hold the shuffles of about PART rows at a time: the logs, whose number the
    caller knows, by their ids, and the newest swaps by time. `spent` is called when nothing reads the three
    tables any more. The result is a stored table.
    """
    base, n = swap_base(columns), max(1, -(-logs // PART))

    def newest_in_parts():
        for k in range(n):
            part = F.pmod(F.xxhash64("_log_id"), F.lit(n)) == k
            sources = [staged(df.filter(part).select(*base), "swaps_of_protocol") for df in (v2, v3, vault)]
            yield newest_swaps(*sources, columns)
            discard(*sources)

    best = staged_parts(newest_in_parts(), "newest_swaps")
    if spent is not None:
        spent()
    relay = Relay("swaps")

    def completed_in_parts():
        for part in inc.ranges(best, "block_timestamp", PART):
            some = best.filter(part)
            near = staged(prices_during(some, prices), "swap_prices")
            out = enrich_swaps(some, contracts, near, pools, relay)
            if "complete_dex_swaps_id" in columns:
                out = keyed(out, "complete_dex_swaps_id", "tx_hash", "event_index")
            yield out.select(*[c for c in SWAP if c in columns])
            discard(near)

    out = staged_parts(completed_in_parts(), label)
    discard(relay.last, best)
    return out


def healable_swap_groups(stored: DataFrame, contracts: DataFrame, prices: DataFrame, verified: DataFrame | None = None) -> DataFrame:
    """(block, platform, version) groups with a swap that new decimals or prices can complete, or whose
    tokens were verified since."""
    known = token_dim(contracts).filter(F.col("token_decimals").isNotNull()).select(F.col("contract_address").alias("_tok"))
    priced = coin_prices(prices).filter(F.col("price").isNotNull()).select(F.col("token_address").alias("_tok"), F.col("hour").alias("_hour"))
    found = []
    for s in ("in", "out"):
        tok = F.col(f"token_{s}").alias("_tok")
        found.append(stored.filter(F.col(f"decimals_{s}").isNull()).select(*GROUP, tok).join(known, "_tok", "left_semi"))
        hour = F.date_trunc("hour", "block_timestamp").cast("timestamp_ntz").alias("_hour")
        found.append(stored.filter(F.col(f"amount_{s}_usd").isNull()).select(*GROUP, tok, hour).join(priced, ["_tok", "_hour"], "left_semi"))
        if verified is not None:
            found.append(stored.select(*GROUP, tok).join(verified.select(F.col("token_address").alias("_tok")), "_tok", "left_semi"))
    return reduce(DataFrame.unionByName, [f.select(*GROUP) for f in found]).distinct()


def heal_swaps(stored: DataFrame, contracts: DataFrame, prices: DataFrame, pools: DataFrame, verified: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """Target with every touched group enriched again; of its columns, those asked for.

    A group lies in one block. Ranges of blocks are healed one after another, so that the disks hold the shuffles of
    about PART swaps at a time. The result is a stored table.
    """
    relay, short = Relay("swaps"), []

    def keep(df):
        short.append(staged(df, "swap_groups"))
        return short[-1]

    def healed_in_parts():
        for part in inc.ranges(stored, "block_number", PART):
            some = stored.filter(part)
            near = keep(prices_during(some, prices))
            groups = healable_swap_groups(some, contracts, near, verified)
            out = inc.heal_groups(some, groups, GROUP, lambda m: enrich_swaps(m.drop(*ENRICHED), contracts, near, pools, relay).select(*stored.columns), keep)
            yield out.select(*(columns or stored.columns))
            discard(*short)
            short.clear()

    out = staged_parts(healed_in_parts(), "swaps")
    discard(relay.last)
    return out


def ez_swaps(swaps: DataFrame) -> DataFrame:
    """Published swaps: USD legs that cannot be right are nulled, unless the leg is the verified wrapped coin."""
    def suspect(side):
        return (F.col(f"token_{side}") != V.WRAPPED_NATIVE) | ~F.col(f"token_{side}_is_verified")
    a = usd_unless_outlier("amount_in_usd", "amount_out_usd", suspect("in"))
    b = usd_unless_outlier("amount_out_usd", "amount_in_usd", suspect("out"))
    return swaps.withColumn("_a", a).withColumn("_b", b).withColumn("amount_in_usd", F.col("_a")).withColumn("amount_out_usd", F.col("_b")).drop("_a", "_b").withColumnsRenamed(
        {"version": "protocol_version", "complete_dex_swaps_id": "ez_dex_swaps_id"}).drop("type", "pool_id", "decimals_in", "decimals_out", "_inserted_timestamp")


def dim_pools(pools: DataFrame) -> DataFrame:
    return pools.select(
        F.col("block_number").alias("creation_block"), F.col("block_timestamp").alias("creation_time"), F.col("tx_hash").alias("creation_tx"), "platform", "protocol", F.col("version").alias("protocol_version"),
        F.col("contract_address").alias("factory_address"), "pool_address", "pool_name", "tokens", "symbols", "decimals", F.col("complete_dex_liquidity_pools_id").alias("dim_dex_liquidity_pools_id"))
