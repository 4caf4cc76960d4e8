"""Packets between chains, on payloads built from the event table.

Clicks open groups; views send, acknowledge or time out a packet of their user; purchases move value; signups begin
transfers to another chain or sign; errors take packets in or sign.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.cosmos import core, packets
from ..session import staged
from .base import VIEWS, query
from .chain import blocks, kv, raw_transactions

HALF = 360


def _attributes(t) -> DataFrame:
    e, m = F.col("event_type"), F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id").cast("string")
    kind = (
        F.when(e == "click", "message")
        .when(e == "view", F.when(m % 8 < 4, "send_packet").when(m % 8 < 7, "acknowledge_packet").otherwise("timeout_packet"))
        .when(e == "purchase", "transfer")
        .when(e == "signup", F.when(m % 2 == 0, "ibc_transfer").otherwise("tx"))
        .otherwise(F.when(m % 2 == 0, "write_acknowledgement").otherwise("signer")))
    packet = kv(("packet_sequence", F.floor(k / 25)), ("packet_src_channel", F.concat(F.lit("channel-"), user)), ("packet_dst_channel", F.lit("channel-0")))
    coarse = F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string"))
    came = F.to_json(F.struct(F.concat(F.lit("r"), (k % 3).cast("string")).alias("receiver"), F.concat(F.lit("y"), k.cast("string")).alias("sender")))
    attrs = (
        F.when(e == "click", kv(("action", F.lit("act"))))
        .when(e == "view", packet)
        .when(e == "purchase", kv(("sender", coarse), ("recipient", F.concat(F.lit("r"), (k % 3).cast("string"))), ("amount", F.concat(k.cast("string"), F.lit("usei")))))
        .when(e == "signup", F.when(m % 2 == 0, kv(("sender", coarse), ("receiver", F.concat(F.lit("x"), k.cast("string"))))).otherwise(kv(("acc_seq", F.concat(F.lit("u"), user, F.lit("/1"))))))
        .otherwise(F.when(m % 2 == 0, kv(("packet_data", came))).otherwise(kv(("sei_addr", F.concat(F.lit("s"), user))))))
    txs = core.transactions(raw_transactions(t, kind, attrs), blocks(t))
    return t.table("packet_attributes", lambda: core.msg_attributes(core.messages(txs)))


def _two_runs(t) -> packets.Packets:
    """A run over the first blocks, its tables stored, and a run over the rest."""
    attrs = _attributes(t)
    first = packets.run(attrs.filter(F.col("block_id") < HALF))
    stored = packets.Packets(staged(first.sends, "packet_sends"), staged(first.outcomes, "packet_outcomes"), staged(first.moves, "packet_moves"))
    return packets.run(attrs.filter(F.col("block_id") >= HALF), stored)


VIEWS.update({
    "p_ev": """select *, cast(k as int) as kk, case event_type when 'click' then 'message' when 'view' then case when event_id % 8 < 4 then 'send_packet' when event_id % 8 < 7 then 'acknowledge_packet' else 'timeout_packet' end
        when 'purchase' then 'transfer' when 'signup' then if(event_id % 2 = 0, 'ibc_transfer', 'tx') else if(event_id % 2 = 0, 'write_acknowledgement', 'signer') end as mt from c_grp""",
    "p_grp": "select *, case when msg_group is not null and arg_max(mt, msg_index) over (partition by tx_id) <> 'tx' then 0 end as sub from p_ev",
    "p_sign": "select tx_id, arg_min(if(mt = 'tx', 'u', 's') || user_id, msg_index) as signer from p_ev where mt in ('tx', 'signer') group by 1",
    "p_pack": "select tx_id, msg_group, msg_index, block_id, block_timestamp, tx_succeeded, mt, kk // 25 as seq, 'channel-' || user_id as src, row(block_timestamp, block_id, tx_id, msg_index) as seen from p_ev where mt like '%_packet'",
    "p_good": """select distinct s.tx_id, s.msg_group from p_pack s join (select seq, src, min(seen) filter (where mt = 'acknowledge_packet') as acked, max(seen) filter (where mt = 'timeout_packet') as timed from p_pack group by 1, 2) o on s.seq = o.seq and s.src = o.src
        where s.mt = 'send_packet' and acked is not null and (timed is null or timed < acked)""",
    "p_move": "select g.*, 'u' || (user_id % 3) as src, 'r' || (kk % 3) as dst from p_grp g join p_sign s on g.tx_id = s.tx_id where mt = 'transfer'",
    "p_ibc": """select m.block_id, m.block_timestamp, m.tx_id, m.tx_succeeded, if(g.tx_id is not null and o.far is not null, 'IBC_TRANSFER_OUT', 'IBC_TRANSFER_IN') as transfer_type, m.msg_index, coalesce(i.afar, m.src) as sender,
        if(g.tx_id is not null and o.far is not null, o.far, m.dst) as receiver, m.kk || '' as amount, 'usei' as currency from p_move m left join p_good g on g.tx_id = m.tx_id and g.msg_group = m.msg_group
        left join (select tx_id, msg_group, 'u' || (user_id % 3) as src, arg_min('x' || kk, msg_index) as far from p_ev where mt = 'ibc_transfer' group by 1, 2, 3) o on o.tx_id = m.tx_id and o.msg_group = m.msg_group and o.src = m.src
        left join (select tx_id, msg_group, sub, 'r' || (kk % 3) as dst, arg_min('y' || kk, msg_index) as afar from p_grp where mt = 'write_acknowledgement' group by 1, 2, 3, 4) i on i.tx_id = m.tx_id and i.msg_group = m.msg_group and i.sub = m.sub and i.dst = m.dst
        where (g.tx_id is not null and o.far is not null) or i.afar is not null""",
})

_TS = "strftime(block_timestamp, '%Y-%m-%d %H:%M:%S') as block_timestamp"
_COLS = ["block_id", "block_timestamp", "tx_id", "tx_succeeded", "transfer_type"]


@query("chain_ibc_packets", f"""select block_id, {_TS}, tx_id, tx_succeeded, msg_index, mt as msg_type, seq || '' as packet_sequence, src as packet_src_channel, 'channel-0' as packet_dst_channel, md5(tx_id || '-' || msg_index) as transfers_ibc_packets_id from p_pack""")
def q_packets(t):
    out = packets.packet_events(_attributes(t)).withColumn("msg_index", F.col("msg_index").cast("bigint"))
    return out.select("block_id", "block_timestamp", "tx_id", "tx_succeeded", "msg_index", "msg_type", *packets.PACKET, "transfers_ibc_packets_id")


@query("chain_transfers_ibc", f"select block_id, {_TS}, tx_id, tx_succeeded, transfer_type, msg_index, sender, receiver, amount, currency, md5(tx_id || '-' || msg_index || '-' || transfer_type) as transfers_ibc_id from p_ibc")
def q_ibc(t):
    """Two runs; the acknowledgement or the timeout of many packets comes in the second."""
    out = packets.transfers(_two_runs(t)).withColumn("msg_index", F.col("msg_index").cast("bigint"))
    return out.select(*_COLS, "msg_index", "sender", "receiver", "amount", "currency", "transfers_ibc_id")


@query("chain_fact_transfers", f"""select block_id, {_TS}, tx_id, tx_succeeded, transfer_type, sender, receiver, amount, currency, md5(tx_id || '-' || msg_index || '-' || transfer_type) as fact_transfers_id from p_ibc
    union all select block_id, {_TS}, tx_id, tx_succeeded, 'SEI', src, dst, kk || '', 'usei', md5(tx_id || '-' || msg_index) from p_move""")
def q_fact_transfers(t):
    out = core.fact_transfers(core.transfers(_attributes(t)), packets.transfers(packets.run(_attributes(t))))
    return out.select(*_COLS, "sender", "receiver", "amount", "currency", "fact_transfers_id")
