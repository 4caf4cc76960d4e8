"""Life cycle of packets between chains: sent, acknowledged or timed out, in any later transaction or run.

A send and its outcome share channel and sequence, not the transaction. Three tables are carried between runs: the
groups that sent each packet, each packet's first acknowledgement and last timeout, and the moves of value in groups
that may belong to a packet. Folding a batch into them is idempotent and does not depend on the order of arrival, so
one run over everything and any number of runs over its parts give the same. A run rewrites only the moves of groups
that the batch holds or whose packets it mentions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.coins import coin_amount, coin_denom
from ...operators.windows import dedup_latest
from ..audit import keyed
from .attrs import BLOCK, EVENT, GROUP, STAMP, has, objects, of_type, tx_sender

PACKET = ["packet_sequence", "packet_src_channel", "packet_dst_channel"]
OWNER = ["tx_id", "msg_group"]
ROW = ["tx_id", "msg_index"]


@dataclass(frozen=True)
class Packets:
    """`sends`: PACKET and the group that sent it. `outcomes`: PACKET, acked_at, timed_out_at. `moves`: see moves()."""

    sends: DataFrame
    outcomes: DataFrame
    moves: DataFrame


def packet_events(attrs: DataFrame) -> DataFrame:
    """One row per send, acknowledgement or timeout with the packet's sequence and channels."""
    rel = of_type(attrs, "send_packet", "acknowledge_packet", "timeout_packet").filter(F.col("attribute_key").isin(*PACKET))
    return keyed(objects(rel, [*EVENT, "msg_type"], PACKET), "transfers_ibc_packets_id", "tx_id", "msg_index")


def _sends(events: DataFrame) -> DataFrame:
    return events.filter("msg_type = 'send_packet'").select(*PACKET, *OWNER).distinct()


def _outcomes(events: DataFrame) -> DataFrame:
    at = F.struct("block_timestamp", "block_id", "tx_id", "msg_index")
    ended = events.filter("msg_type <> 'send_packet'")
    return ended.groupBy(*PACKET).agg(
        F.min(F.when(F.col("msg_type") == "acknowledge_packet", at)).alias("acked_at"), F.max(F.when(F.col("msg_type") == "timeout_packet", at)).alias("timed_out_at"))


def delivered() -> Column:
    """Acknowledged, and not timed out after that."""
    return F.col("acked_at").isNotNull() & (F.col("timed_out_at").isNull() | (F.col("timed_out_at") < F.col("acked_at")))


def moves(attrs: DataFrame) -> DataFrame:
    """Transfer events of signed transactions in a group whose sender began a transfer to another chain (out_receiver),
    or whose recipient is named by a packet that came in (in_sender). One row per event: the first name counts."""
    rel = of_type(attrs, "tx", "signer", "transfer", "ibc_transfer", "write_acknowledgement")
    each = objects(of_type(rel, "transfer"), EVENT, {"sender": "_from", "recipient": "_to", "amount": "_raw"}).filter(F.col("_raw").isNotNull())
    out = objects(of_type(rel, "ibc_transfer"), [*GROUP, "msg_index"], {"sender": "_from", "receiver": "out_receiver"}).drop(STAMP)
    out = dedup_latest(out, [*OWNER, "_from"], ["msg_index"]).select(*OWNER, "_from", "out_receiver", F.lit(True).alias("is_out"))
    packet = F.try_parse_json("attribute_value")
    came = of_type(rel, "write_acknowledgement").filter(has(None, "packet_data")).select(
        *GROUP, "msg_index", F.try_variant_get(packet, "$.receiver", "string").alias("_to"), F.try_variant_get(packet, "$.sender", "string").alias("in_sender"))
    came = dedup_latest(came, [*GROUP, "_to"], ["msg_index"]).drop("msg_index").withColumn("is_in", F.lit(True))
    found = each.join(out, [*OWNER, "_from"], "left").join(came, [*GROUP, "_to"], "left").filter(F.col("is_out") | F.col("is_in")).join(tx_sender(rel, "_signer"), "tx_id")
    return found.select(
        *BLOCK, "msg_group", "msg_index", F.coalesce("_from", "_signer").alias("sender"), F.col("_to").alias("receiver"), "out_receiver", "in_sender",
        F.coalesce("is_out", F.lit(False)).alias("is_out"), F.coalesce("is_in", F.lit(False)).alias("is_in"), coin_amount("_raw").alias("amount"), coin_denom("_raw").alias("currency"), STAMP)


def _with_outcome(rows: DataFrame, sends: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Rows with `arrived`: a packet of their group was delivered."""
    groups = sends.join(rows.select(*OWNER).distinct(), OWNER, "left_semi")
    arrived = groups.join(outcomes.filter(delivered()).select(*PACKET), PACKET, "left_semi").select(*OWNER).distinct()
    return rows.join(arrived.withColumn("arrived", F.lit(True)), OWNER, "left").withColumn("arrived", F.coalesce("arrived", F.lit(False)))


def run(attrs: DataFrame, before: Packets | None = None) -> Packets:
    """The tables after a batch of attributes; store them before the next run reads them.

    A batch may repeat what came before, and an outcome may arrive before its send. A later timeout takes back a
    transfer that an acknowledgement had released, in its group alone.
    """
    events = packet_events(attrs)
    sends, outcomes, batch = _sends(events), _outcomes(events), moves(attrs)
    if before is None:
        return Packets(sends, outcomes, _with_outcome(batch, sends, outcomes))
    all_sends = before.sends.unionByName(sends).distinct()
    all_outcomes = before.outcomes.unionByName(outcomes).groupBy(*PACKET).agg(F.min("acked_at").alias("acked_at"), F.max("timed_out_at").alias("timed_out_at"))
    mentioned = all_sends.join(events.select(*PACKET).distinct(), PACKET, "left_semi").select(*OWNER)
    touched = mentioned.unionByName(batch.select(*OWNER)).distinct()
    known = before.moves.drop("arrived").join(touched, OWNER, "left_semi").join(batch.select(*ROW), ROW, "left_anti")
    again = _with_outcome(known.unionByName(batch), all_sends, all_outcomes)
    return Packets(all_sends, all_outcomes, before.moves.join(touched, OWNER, "left_anti").unionByName(again.select(*before.moves.columns)))


def transfers(packets: Packets) -> DataFrame:
    """Transfers that left with a delivered packet, and those that came in."""
    leaves = F.col("is_out") & F.col("arrived")
    rows = packets.moves.filter(leaves | F.col("is_in")).withColumn("_out", F.when(leaves, F.col("out_receiver")))
    kind = F.when(F.col("_out").isNotNull(), F.lit("IBC_TRANSFER_OUT")).when(F.col("in_sender").isNotNull(), F.lit("IBC_TRANSFER_IN"))
    out = rows.select(
        *BLOCK, kind.alias("transfer_type"), "msg_index", F.coalesce("in_sender", "sender").alias("sender"), F.coalesce("_out", "receiver").alias("receiver"), "amount", "currency", STAMP)
    return keyed(out, "transfers_ibc_id", "tx_id", "msg_index", "transfer_type")
