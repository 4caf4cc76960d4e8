"""Contract interfaces from explorer answers to validity intervals.

Parts are contracts. A part's interface has one event, named after its brand, and one function; explorers answer
for most parts and refuse some, and users send interfaces for others, which what was logged and called confirms. Suppliers are proxies that delegate to the parts of their lines. A signature's
topic is looked up in a dictionary, whose hashes stand in for the chain's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import hexwords as h
from ..plans.evm import abis
from .base import VIEWS, query
from .evm import _lines, addr, address

PROXY = 10**9


def _event_name():
    return F.concat(F.lit("Moved"), F.substring("p_brand", 7, 10))


def answers(t) -> DataFrame:
    """What the explorer says of each part; a refusal carries no interface."""
    pair = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("type")) for n, k in (("amount", "uint256"), ("holder", "address"))])
    event = F.struct(F.lit("event").alias("type"), _event_name().alias("name"), F.lit(False).alias("anonymous"), pair.alias("inputs"))
    call = F.struct(F.lit("function").alias("type"), F.lit("move").alias("name"), F.lit(False).alias("anonymous"), pair.alias("inputs"))
    refused = F.col("p_partkey") % 7 == 0
    body = F.to_json(F.struct(F.when(refused, F.lit("NOTOK")).otherwise(F.lit("OK")).alias("message"), F.when(~refused, F.to_json(F.array(event, call))).alias("result")))
    stamp = F.expr("timestamp_ntz '2000-01-01' + make_dt_interval(0, cast(p_partkey % 1000 as int))")
    return t.part.filter("p_partkey % 5 <> 0").select(address("p_partkey").alias("contract_address"), body.alias("data"), stamp.alias(abis.STAMP))


def topics(t) -> DataFrame:
    """Hashes of every signature in use; the long ones are events, calls are known by their first bytes."""
    brand = F.substring("p_brand", 7, 10)
    names = t.part.select(F.explode(F.array(F.concat(F.lit("Moved"), brand), F.concat(F.lit("Bogus"), brand), F.lit("move"), F.lit("shake"))).alias("n")).distinct()
    return names.select(F.concat("n", F.lit("(uint256,address)")).alias("signature")).select("signature", F.concat(F.lit("0x"), F.sha2("signature", 256)).alias("topic"))


def created(t) -> DataFrame:
    """Parts with even sizes share their brand's bytecode, the others that of their kind."""
    code = F.concat(F.lit("0x60"), F.hex(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(F.substring("p_type", 1, 4))))
    parts = t.part.select(address("p_partkey").alias("created_contract_address"), code.alias("created_contract_input"), (F.col("p_partkey") % 100).cast("bigint").alias("block_number"))
    proxies = t.supplier.select(address(F.col("s_suppkey") + PROXY).alias("created_contract_address"), F.lit("0x60ff").alias("created_contract_input"), (F.col("s_suppkey") % 50).cast("bigint").alias("block_number"))
    return parts.unionByName(proxies)


def submitted(t) -> DataFrame:
    """Users send interfaces for parts the explorer is not asked for; some name events or calls that never occur. A
    second version of each came earlier, and some are marked as repeated."""
    pair = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("type")) for n, k in (("amount", "uint256"), ("holder", "address"))])
    event_name = F.concat(F.when(F.col("p_partkey") % 3 == 0, F.lit("Bogus")).otherwise(F.lit("Moved")), F.substring("p_brand", 7, 10))
    event = F.struct(F.lit("event").alias("type"), event_name.alias("name"), F.lit(False).alias("anonymous"), pair.alias("inputs"))
    call = F.struct(F.lit("function").alias("type"), F.when(F.col("p_partkey") % 2 == 0, F.lit("move")).otherwise(F.lit("shake")).alias("name"), F.lit(False).alias("anonymous"), pair.alias("inputs"))
    sent = t.part.filter("p_partkey % 5 = 0").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    stamp = F.expr("timestamp_ntz '2001-01-01' + make_dt_interval(version, 0)")
    return sent.select(
        address("p_partkey").alias("contract_address"), F.to_json(F.array(event, call)).alias("abi"), F.concat(F.lit("user"), F.col("version").cast("string")).alias("discord_username"), stamp.alias(abis.STAMP), (F.col("p_partkey") % 25 == 0).alias("duplicate_abi"))


def lines(t) -> DataFrame:
    """The line items with the columns that calls and logs are made of, hashes left out."""
    return t.table("call_lines", lambda: _lines(t).select("l_partkey", "l_suppkey", "l_linenumber", "qty", "l_returnflag", "block_number", "ts"))


def delegations(t) -> DataFrame:
    """Suppliers delegate to the parts of their lines; large lines call move()."""
    move = F.sha2(F.lit("move(uint256,address)"), 256)
    return lines(t).select(
        F.lit("DELEGATECALL").alias("type"), F.lit("SUCCESS").alias("trace_status"), (F.col("l_returnflag") != "R").alias("tx_succeeded"), address(F.col("l_suppkey") + PROXY).alias("from_address"), address("l_partkey").alias("to_address"),
        F.concat(F.lit("0x"), F.when(F.col("qty") > 45, F.substring(move, 1, 8)).otherwise(F.lit("00000000")), F.lit("00")).alias("input"), "block_number", F.col("ts").alias("block_timestamp"))


def emitted(t) -> DataFrame:
    """Odd lines log at the proxy, even ones at the part, the part's event each."""
    at = F.when(F.col("l_linenumber") % 2 == 1, address(F.col("l_suppkey") + PROXY)).otherwise(address("l_partkey"))
    text = F.concat(_event_name(), F.lit("(uint256,address)"))
    # a hash for each part, not for each line
    topics = t.table("part_topics", lambda: t.part.select("p_partkey", F.concat(F.lit("0x"), F.sha2(text, 256)).alias("topic_0")))
    return lines(t).join(topics, F.col("l_partkey") == F.col("p_partkey")).select(at.alias("contract_address"), "topic_0")


def accepted(t) -> DataFrame:
    return t.table("user_verified", lambda: abis.user_verified_abis(submitted(t), topics(t), t.table("proxies", lambda: proxies(t)), delegations(t), emitted(t)))


def verified(t) -> DataFrame:
    return t.table("verified_abis", lambda: abis.verified_abis(answers(t), accepted(t)))


def final(t) -> DataFrame:
    made = t.table("created", lambda: created(t))
    return t.table("abis", lambda: abis.abis(abis.override_abis(t.spark), verified(t), abis.bytecode_abis(made, verified(t)), made))


def flat_events(t) -> DataFrame:
    return t.table("flat_events", lambda: abis.flat_event_abis(final(t), topics(t)))


def proxies(t) -> DataFrame:
    return abis.proxies(delegations(t), t.table("created", lambda: created(t)))


VIEWS.update({
    "i_asked": f"""select p_partkey, {addr('p_partkey')} as contract_address, 'Moved' || substr(p_brand, 7, 10) as event_name, 'move' as function_name, case when p_size % 2 = 0 then p_brand else substr(p_type, 1, 4) end as code, p_partkey % 5 <> 0 and p_partkey % 7 <> 0 as answered from part""",
    "i_sent": """select p_partkey, contract_address, if(p_partkey % 3 = 0, 'Bogus', 'Moved') || substr(event_name, 6) as sent_event, if(p_partkey % 2 = 0, 'move', 'shake') as sent_function from i_asked where p_partkey % 5 = 0 and p_partkey % 25 <> 0""",
    "i_at": """select s.*, coalesce(p.l_suppkey, -1) as parent from i_sent s left join (select distinct l_partkey, l_suppkey from e_line where l_returnflag <> 'R') p on p.l_partkey = s.p_partkey""",
    "i_hit": """select distinct p_partkey, 'log' as kind from i_at a join (select distinct if(l_linenumber % 2 = 1, l_suppkey, -1) as parent, if(l_linenumber % 2 = 1, -1, l_partkey) as own, event_name from e_line join i_asked on l_partkey = p_partkey) l on l.parent = a.parent and (a.parent >= 0 or l.own = a.p_partkey) and l.event_name = a.sent_event
        union all select distinct p_partkey, 'call' from i_at a join (select distinct l_suppkey from e_line where qty > 45) c on c.l_suppkey = a.parent where a.sent_function = 'move'""",
    "i_user": "select s.*, 2 as n_signatures, n_seen from i_sent s join (select p_partkey, count(*) as n_seen from i_hit group by 1) h on h.p_partkey = s.p_partkey",
    "i_part": """select a.p_partkey, a.contract_address, coalesce(u.sent_event, a.event_name) as event_name, coalesce(u.sent_function, a.function_name) as function_name, '0x' || sha256(coalesce(u.sent_event, a.event_name) || '(uint256,address)') as event_signature, code,
        answered or u.p_partkey is not null as known, if(answered, 'etherscan', 'user') as source from i_asked a left join i_user u on u.p_partkey = a.p_partkey""",
    "i_final": """select contract_address, event_name, event_signature, source as abi_source from i_part where known
        union all select p.contract_address, o.event_name, o.event_signature, 'bytecode_matched' from i_part p join (select code, min(event_name) as event_name, min(event_signature) as event_signature from i_part where known group by 1 having count(distinct event_name || '/' || function_name) = 1) o on p.code = o.code where not p.known""",
    "i_proxy": f"""select distinct {addr(f'l_suppkey + {PROXY}')} as parent, event_name, event_signature, start_block from (select l_suppkey, l_partkey, min(block_number) as start_block from e_line where l_returnflag <> 'R' group by 1, 2)
        join i_final f on f.contract_address = {addr('l_partkey')}""",
})


@query("abi_user_verified", "select contract_address, 'user2' as discord_username, n_signatures, n_seen from i_user")
def q_user(t):
    """Interfaces that users sent, of contracts at which one of their events or calls was seen."""
    return accepted(t).select("contract_address", "discord_username", "n_signatures", "n_seen")


@query("abi_functions", """select contract_address, function_name, function_name || '(uint256,address)' as simple_function_name, '0x' || sha256(function_name || '(uint256,address)') as function_signature, 'uint256,address' as inputs_type from i_part where known
    union all select p.contract_address, o.function_name, o.function_name || '(uint256,address)', '0x' || sha256(o.function_name || '(uint256,address)'), 'uint256,address' from i_part p join (select code, min(function_name) as function_name from i_part where known group by 1 having count(distinct event_name || '/' || function_name) = 1) o on p.code = o.code where not p.known""")
def q_functions(t):
    out = abis.flat_function_abis(final(t), topics(t))
    return out.select("contract_address", "function_name", "simple_function_name", "function_signature", F.array_join("inputs_type", ",").alias("inputs_type"))


@query("abi_final", "select contract_address, abi_source from i_final")
def q_final(t):
    """One interface per contract: the explorer's, else that of the only interface known for its bytecode."""
    return final(t).select("contract_address", "abi_source")


@query("abi_flat_events", "select contract_address, event_name, event_name || '(uint256,address)' as simple_event_name, event_signature from i_final")
def q_flat(t):
    return flat_events(t).select("contract_address", "event_name", "simple_event_name", "event_signature")


@query("abi_complete_events", """select parent as parent_contract_address, event_name, event_signature, start_block, coalesce(lead(start_block) over (partition by parent, event_signature order by start_block) - 1, 1000000000000000000) as end_block from i_proxy
    union all select contract_address, event_name, event_signature, 0, 1000000000000000000 from i_final""")
def q_complete(t):
    """Proxies answer with the events of what they delegate to, from the first call on."""
    out = abis.complete_event_abis(flat_events(t), t.table("proxies", lambda: proxies(t)))
    return out.select("parent_contract_address", "event_name", "event_signature", F.col("start_block").cast("bigint").alias("start_block"), F.col("end_block").cast("bigint").alias("end_block"))


@query("fn_number_to_hex", "select c_custkey, '0x' || lower(to_hex(c_custkey)) as own, '0x' || lower(to_hex(c_custkey * 1000003)) as large, '0x0' as zero from customer")
def number_to_hex(t):
    return t.customer.select("c_custkey", h.number_to_hex("c_custkey").alias("own"), h.number_to_hex(F.col("c_custkey") * 1_000_003).alias("large"), h.number_to_hex(F.col("c_custkey") * 0).alias("zero"))
