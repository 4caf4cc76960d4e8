"""Contract interfaces: sources by precedence, flattened events, validity intervals.

The hash of a text signature comes from a dictionary table (signature, topic); computing that hash per row
is no job for a query engine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.common import newest
from ...operators.rows import flatten
from ...operators.sets import union_all
from ...operators.windows import OPEN_END, dedup_latest, dedup_priority, lead_interval
from ...session import staged
from ..audit import keyed

STAMP = "_inserted_timestamp"
EARLY = "2000-01-01 00:00:00"
ABI = ["contract_address", "data", STAMP, "abi_source", "discord_username", "abi_hash"]


def type_texts(inputs: Column) -> Column:
    """The canonical types of an interface's parameters, separated by commas; empty where there are none.

    A tuple is spelled out by its components, keeping an array suffix. The parameters are pieces of text in order, of
    which tuples still hold their components; each step opens those in their place, so tuples nest as deep as they
    like. Every opened tuple has a brace of its own, which bounds the steps; all of it happens within the row.
    """
    def pieces(items: Column) -> Column:
        read = F.transform(items, lambda p: F.struct(F.try_variant_get(p, "$.type", "string").alias("text"), p.alias("of")))
        named = F.filter(read, lambda p: p["text"].isNotNull())

        def piece(p: Column, i: Column) -> Column:
            comma = F.when(i > 0, F.lit(",")).otherwise(F.lit(""))
            inside = F.when(p["text"].startswith("tuple"), F.coalesce(F.try_variant_get(p["of"], "$.components", "array<variant>"), none))
            return F.struct(F.concat(comma, p["text"]).alias("text"), inside.alias("inside"))

        return F.transform(named, piece)

    none = F.array().cast("array<variant>")
    kind = "struct<text:string,inside:array<variant>>"
    done = lambda text: F.array(F.struct(text.alias("text"), F.lit(None).cast("array<variant>").alias("inside")))

    def opened(p: Column) -> Column:
        head, tail = F.concat(F.regexp_extract(p["text"], "^,?", 0), F.lit("(")), F.concat(F.lit(")"), F.regexp_replace(p["text"], "^,?tuple", ""))
        return F.when(p["inside"].isNull(), F.array(p)).otherwise(F.concat(done(head), pieces(p["inside"]), done(tail)))

    def closed(x: Column) -> Column:
        return ~F.exists(x, lambda p: p["inside"].isNotNull())

    top = pieces(F.coalesce(F.try_variant_get(F.try_parse_json(inputs), "$", "array<variant>"), none)).cast(f"array<{kind}>")
    steps = F.sequence(F.lit(1), F.greatest(F.regexp_count(inputs, F.lit("[{]")), F.lit(1)))
    flat = F.aggregate(steps, top, lambda x, _: F.when(closed(x), x).otherwise(F.flatten(F.transform(x, opened))).cast(f"array<{kind}>"))
    return F.array_join(F.transform(flat, lambda p: p["text"]), "")


def with_signature(rows: DataFrame, name: str) -> DataFrame:
    """Rows (name, inputs) with a column: name(type,type,…)."""
    types = F.when(F.col("inputs").contains("{"), type_texts(F.col("inputs")))
    return rows.withColumn(name, F.concat("name", F.lit("("), F.coalesce(types, F.lit("")), F.lit(")")))


def input_types(inputs: Column) -> Column:
    return F.transform(F.from_json(inputs, "array<struct<type:string>>"), lambda p: p["type"])


# --- flattening -----------------------------------------------------------------------------------


def _items(abis: DataFrame, kind: str, *more: str) -> DataFrame:
    each = flatten(abis.withColumn("_l", F.try_variant_get(F.try_parse_json("data"), "$", "array<variant>")), "_l", "_i", "_e")
    get = lambda p, t="string": F.try_variant_get("_e", f"$.{p}", t)
    rows = each.filter(get("type") == kind)
    js = lambda p: F.coalesce(F.to_json(get(p, "variant")), F.lit("[]"))
    return rows.select("contract_address", STAMP, get("name").alias("name"), js("inputs").alias("inputs"), get("anonymous", "boolean").alias("anonymous"), *[js(m).alias(m) for m in more])


def flat_event_abis(abis: DataFrame, topics: DataFrame) -> DataFrame:
    """One row per event of each interface (contract_address, data, stamp) with its text signature and topic.

    Events without parameters are not listed, as in the published table.
    """
    events = _items(abis, "event")
    once = dedup_latest(events, ["contract_address", "name", "inputs"], [newest(STAMP)])
    rows = once.withColumn("event_type", input_types(F.col("inputs"))).filter(F.size("event_type") > 0)
    abi = F.to_json(F.struct("anonymous", F.try_parse_json("inputs").alias("inputs"), "name", F.lit("event").alias("type")))
    rows = with_signature(rows, "simple_event_name").withColumn("abi", abi)
    dictionary = topics.select(F.col("signature").alias("simple_event_name"), F.col("topic").alias("event_signature"))
    out = rows.join(dictionary, "simple_event_name", "left")
    return out.select("contract_address", F.col("name").alias("event_name"), "abi", "simple_event_name", "event_signature", "name", "inputs", "event_type", STAMP)


def flat_function_abis(abis: DataFrame, topics: DataFrame) -> DataFrame:
    """One row per function with its text signature and hash, newest per (contract, hash); unnamed
    parameters are called input_<n> and output_<n>."""
    rows = with_signature(_items(abis, "function", "outputs"), "simple_function_name")
    dictionary = topics.select(F.col("signature").alias("simple_function_name"), F.col("topic").alias("function_signature"))
    rows = rows.join(dictionary, "simple_function_name", "left").withColumn("_key", F.coalesce("function_signature", "simple_function_name"))
    best = dedup_latest(rows, ["contract_address", "_key"], [newest(STAMP), newest("outputs")])
    field = "array<struct<internalType:string,name:string,type:string>>"

    def named(col, word):
        return F.transform(F.from_json(col, field), lambda p, i: F.struct(
            p["internalType"].alias("internalType"), F.when(F.coalesce(p["name"], F.lit("")) == "", F.concat(F.lit(f"{word}_"), (i + 1).cast("string"))).otherwise(p["name"]).alias("name"), p["type"].alias("type")))

    return best.select("contract_address", F.col("name").alias("function_name"), "simple_function_name", "function_signature", named("inputs", "input").alias("inputs"), named("outputs", "output").alias("outputs"),
                       input_types(F.col("inputs")).alias("inputs_type"), input_types(F.col("outputs")).alias("outputs_type"), STAMP)


# --- sources --------------------------------------------------------------------------------------


def override_abis(spark) -> DataFrame:
    """Manual overrides; none so far."""
    return spark.createDataFrame([], "contract_address string, data string")


def verified_abis(responses: DataFrame, user: DataFrame) -> DataFrame:
    """Explorer answers and accepted user interfaces, newest per contract."""
    v = F.try_parse_json("data")
    ok = responses.filter(F.try_variant_get(v, "$.message", "string") == "OK")
    body = F.to_json(F.try_parse_json(F.try_variant_get(v, "$.result", "string")))
    a = ok.select("contract_address", body.alias("data"), STAMP, F.lit("etherscan").alias("abi_source"), F.lit(None).cast("string").alias("discord_username"))
    a = a.withColumn("abi_hash", F.sha2("data", 256))
    b = user.select("contract_address", F.to_json(F.try_parse_json("abi")).alias("data"), STAMP, F.lit("user").alias("abi_source"), "discord_username", "abi_hash")
    return dedup_latest(union_all([a.select(*ABI), b.select(*ABI)]), ["contract_address"], [newest(STAMP), "abi_source", "abi_hash"])


def bytecode_abis(created: DataFrame, verified: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Contracts without an interface whose bytecode maps to exactly one interface elsewhere."""
    code = created.select(F.col("created_contract_address").alias("contract_address"), F.sha2("created_contract_input", 256).alias("bytecode"))
    known = code.join(verified.select("contract_address", "data", "abi_hash"), "contract_address")
    one = known.groupBy("bytecode").agg(F.count_distinct("data").alias("_n"), F.min("data").alias("abi"), F.min("abi_hash").alias("abi_hash")).filter("_n = 1").drop("_n")
    open_ = code.join(known.select("contract_address"), "contract_address", "left_anti")
    if stored is not None:
        open_ = open_.join(stored.select("contract_address"), "contract_address", "left_anti")
    return open_.join(one, "bytecode").select("contract_address", "abi", "abi_hash", F.lit(EARLY).cast("timestamp_ntz").alias(STAMP))


def abis(override: DataFrame, verified: DataFrame, by_bytecode: DataFrame, created: DataFrame) -> DataFrame:
    """One interface per contract: override, then explorer or user, then bytecode match."""
    none = F.lit(None)
    a = override.filter(F.col("contract_address").isNotNull()).select(
        "contract_address", "data", F.lit(EARLY).cast("timestamp_ntz").alias(STAMP), F.lit("override").alias("abi_source"), F.lit("override").alias("discord_username"), F.sha2("data", 256).alias("abi_hash"), F.lit(1).alias("priority"))
    b = verified.select(*ABI, F.lit(2).alias("priority"))
    c = by_bytecode.select("contract_address", F.col("abi").alias("data"), STAMP, F.lit("bytecode_matched").alias("abi_source"), none.cast("string").alias("discord_username"), "abi_hash", F.lit(3).alias("priority"))
    best = dedup_priority(union_all([a, b, c]), ["contract_address"], F.col("priority"), [newest(STAMP), "abi_source", "abi_hash"])
    code = created.select(F.col("created_contract_address").alias("contract_address"), F.col("created_contract_input").alias("bytecode"))
    return keyed(best.drop("priority").join(code, "contract_address", "left"), "abis_id", "contract_address")


def dim_contract_abis(rows: DataFrame) -> DataFrame:
    return rows.select("contract_address", F.col("data").alias("abi"), "abi_source", "bytecode", F.col("abis_id").alias("dim_contract_abis_id"))


# --- proxies --------------------------------------------------------------------------------------


def proxies(trace_facts: DataFrame, created: DataFrame, stored: DataFrame | None = None, stamp: str = "block_timestamp") -> DataFrame:
    """First successful delegate call per (proxy, implementation), with both creation blocks.

    The transaction's success flag stands in for a status column the published source does not have.
    """
    calls = trace_facts.filter((F.col("type") == "DELEGATECALL") & (F.col("trace_status") == "SUCCESS") & F.col("tx_succeeded") & (F.col("from_address") != F.col("to_address")))
    pair = ["contract_address", "proxy_address"]
    first = calls.groupBy(F.col("from_address").alias("contract_address"), F.col("to_address").alias("proxy_address")).agg(F.min("block_number").alias("start_block"), F.max(stamp).alias(STAMP))
    if stored is not None:
        both = first.unionByName(stored.select(*pair, "start_block", STAMP).join(first.select(*pair), pair, "left_semi"))
        first = both.groupBy(*pair).agg(F.min("start_block").alias("start_block"), F.max(STAMP).alias(STAMP))
    made = created.select(F.col("created_contract_address").alias("_a"), F.col("block_number").alias("_b"))
    c = made.select(F.col("_a").alias("contract_address"), F.col("_b").alias("created_block"))
    p = made.select(F.col("_a").alias("proxy_address"), F.col("_b").alias("proxy_created_block"))
    return first.withColumn("_id", F.concat("contract_address", F.lit("-"), "proxy_address")).join(c, "contract_address").join(p, "proxy_address")


def complete_event_abis(flat: DataFrame, proxy_rows: DataFrame) -> DataFrame:
    """Event interfaces with the block range in which they hold, proxies included.

    A proxy answers with its implementation's events from the first delegate call on (first), and with its
    own from its creation (second); other contracts with their own from block 0 (third).
    """
    cols = ["event_name", "abi", "simple_event_name", "event_signature", "name", "inputs", "event_type", STAMP]
    p = proxy_rows.select("contract_address", "proxy_address", "start_block", "created_block", "proxy_created_block", F.col(STAMP).alias("proxy_inserted_timestamp"))
    impl = flat.withColumnRenamed("contract_address", "proxy_address").join(p, "proxy_address").select(
        *cols, "proxy_inserted_timestamp", "start_block", "proxy_created_block", F.col("contract_address").alias("parent_contract_address"), F.lit(1).alias("priority"))
    own = flat.join(p.select("contract_address", "created_block", "proxy_created_block", "proxy_inserted_timestamp").distinct(), "contract_address").select(
        *cols, "proxy_inserted_timestamp", F.col("created_block").alias("start_block"), "proxy_created_block", F.col("contract_address").alias("parent_contract_address"), F.lit(2).alias("priority"))
    rest = flat.join(p.select("contract_address"), "contract_address", "left_anti").select(
        *cols, F.lit(None).cast("timestamp_ntz").alias("proxy_inserted_timestamp"), F.lit(0).cast("bigint").alias("start_block"), F.lit(None).cast("bigint").alias("proxy_created_block"),
        F.col("contract_address").alias("parent_contract_address"), F.lit(3).alias("priority"))
    ties = [newest(STAMP), F.col("proxy_created_block").desc_nulls_last(), F.col("proxy_inserted_timestamp").desc_nulls_last(), "abi"]
    # sent once by what the keys of all three steps share
    rows = union_all([impl, own, rest]).repartition("parent_contract_address", "event_signature")
    best = dedup_priority(rows, ["parent_contract_address", "name", "event_type", "event_signature", "start_block"], F.col("priority"), ties)
    once = dedup_latest(best, ["parent_contract_address", "event_name", "event_signature", "start_block"], [newest(STAMP), "abi"])
    # versions of one event are few per contract: a plain window
    ranged = lead_interval(once, ["parent_contract_address", "event_signature"], "start_block", "end_block", OPEN_END)
    out = ranged.select("parent_contract_address", "event_name", "abi", "start_block", "proxy_created_block", "simple_event_name", "event_signature", "end_block", STAMP, "proxy_inserted_timestamp")
    return keyed(out, "complete_event_abis_id", "parent_contract_address", "event_signature", "start_block")


# --- user interfaces ------------------------------------------------------------------------------


def submission_matches(submitted: DataFrame, topics: DataFrame, proxy_rows: DataFrame, trace_facts: DataFrame, logs: DataFrame) -> DataFrame:
    """contract_address, n_signatures, n_seen: how much of a submitted interface occurs on chain.

    Two families of sets meet: the signatures of each submission, and the topics and selectors seen at each address.
    Their index is inverted: every (address, signature) that some submission asks for, with the submissions behind
    it. Logs and calls pass by it once and keep what it holds, so nothing is built from all that was ever seen, and
    no submission is held against an address as a whole.

    An address that delegates, or that no proxy names, is asked itself; an implementation at its proxies.
    """
    address = submitted.select("contract_address").distinct()
    named = address.join(proxy_rows.select(F.col("proxy_address").alias("contract_address"), F.col("contract_address").alias("_parent")).distinct(), "contract_address", "left")
    named = named.join(proxy_rows.select("contract_address").distinct().withColumn("_delegates", F.lit(True)), "contract_address", "left")
    asked = F.when(F.col("_delegates") | F.col("_parent").isNull(), F.col("contract_address")).otherwise(F.col("_parent"))
    asked_at = named.select("contract_address", asked.alias("address")).distinct()
    events = flat_event_abis(submitted, topics).select("contract_address", F.lit("log").alias("kind"), F.col("event_signature").alias("signature"))
    functions = flat_function_abis(submitted, topics).select("contract_address", F.lit("call").alias("kind"), F.left("function_signature", F.lit(10)).alias("signature"))
    wanted = staged(events.unionByName(functions).filter(F.col("signature").isNotNull()).distinct(), "submitted_signatures")
    index = staged(wanted.join(asked_at, "contract_address"), "signature_index")
    keys = index.select("address", "kind", "signature").distinct()
    target = F.when(F.col("type") == "DELEGATECALL", F.col("from_address")).otherwise(F.col("to_address"))
    calls = trace_facts.select(target.alias("address"), F.lit("call").alias("kind"), F.left("input", F.lit(10)).alias("signature"))
    seen = logs.select(F.col("contract_address").alias("address"), F.lit("log").alias("kind"), F.col("topic_0").alias("signature")).unionByName(calls)
    met = seen.join(keys, ["address", "kind", "signature"]).distinct()
    found = index.join(met, ["address", "kind", "signature"]).select("contract_address", "kind", "signature").distinct().groupBy("contract_address").agg(F.count("*").alias("n_seen"))
    total = wanted.groupBy("contract_address").agg(F.count("*").alias("n_signatures"))
    return total.join(found, "contract_address", "left").select("contract_address", "n_signatures", F.coalesce("n_seen", F.lit(0)).alias("n_seen"))


def user_verified_abis(submitted: DataFrame, topics: DataFrame, proxy_rows: DataFrame, trace_facts: DataFrame, logs: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Submitted interfaces of contracts of which some event or call matches one, newest per contract.

    The published job samples matches, which changes nothing as only their existence counts.
    """
    base = submitted.filter(~F.coalesce("duplicate_abi", F.lit(False))).withColumn("data", F.to_json(F.try_parse_json("abi"))).withColumn("abi_hash", F.sha2("data", 256))
    if stored is not None:
        base = base.join(stored.select("contract_address"), "contract_address", "left_anti")
    matches = submission_matches(base, topics, proxy_rows, trace_facts, logs)
    rows = base.join(matches.filter("n_seen > 0"), "contract_address")
    best = dedup_latest(rows, ["contract_address"], [newest(STAMP), "abi_hash"])
    return best.select("contract_address", "abi", "discord_username", STAMP, "abi_hash", F.concat("contract_address", F.lit("-"), "abi_hash").alias("id"), "n_signatures", "n_seen")
