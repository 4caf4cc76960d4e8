"""Governance, staking, rewards and commission."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ...functions.coins import coin_amount, coin_denom, split_coins
from ...functions.common import concat_ws_strict, newest
from ...operators.windows import dedup_latest, row_number_in_group
from ..audit import keyed, published
from . import values as V
from .attrs import BLOCK, EVENT, GROUP, STAMP, has, number, objects, of_type, tx_caller, tx_sender, with_coin


def _single(attrs: DataFrame, msg_type: str, key: str, name: str) -> DataFrame:
    return attrs.filter(has(msg_type, key)).select("tx_id", F.col("attribute_value").alias(name))


def _block_of(attrs: DataFrame, msg_type: str) -> DataFrame:
    return of_type(attrs, msg_type).select(*BLOCK, *([STAMP] if STAMP in attrs.columns else [])).distinct()


def proposal_deposits(attrs: DataFrame) -> DataFrame:
    """One row per coin of a deposit event; the proposal and the amount are those of the same event."""
    ids = attrs.filter(has("proposal_deposit", "proposal_id")).select("tx_id", "msg_index", F.col("attribute_value").alias("proposal_id"))
    value = attrs.filter(has("proposal_deposit", "amount") & F.col("attribute_value").isNotNull())
    value = with_coin(value.select(*BLOCK, "msg_index", "attribute_value", STAMP), "attribute_value").drop("attribute_value")
    rows = value.join(ids, ["tx_id", "msg_index"]).join(tx_sender(attrs, "depositor"), "tx_id")
    out = rows.select(*BLOCK, "msg_index", "depositor", number("proposal_id").cast("bigint").alias("proposal_id"), F.col("amount").cast("double").alias("amount"), "currency", STAMP)
    return keyed(out, "governance_proposal_deposits_id", "tx_id", "msg_index", "currency")


def submitted_proposals(attrs: DataFrame) -> DataFrame:
    ids = attrs.filter(has("submit_proposal", "proposal_id")).select(*BLOCK, F.col("attribute_value").alias("proposal_id"), STAMP)
    kind = _single(attrs, "submit_proposal", "proposal_type", "proposal_type")
    rows = ids.join(kind, "tx_id").join(tx_sender(attrs, "proposer"), "tx_id")
    none = F.lit(None).cast("string")
    out = rows.select(*BLOCK, "proposer", number("proposal_id").cast("bigint").alias("proposal_id"), "proposal_type",
                      none.alias("proposal_title"), none.alias("proposal_description"), STAMP)
    return keyed(out, "governance_submit_proposal_id", "tx_id")


def votes(attrs: DataFrame) -> DataFrame:
    """Votes with option and weight; options written as JSON objects are opened."""
    voting = attrs.filter(has("message", "action", V.GOV_VOTE_ACTION)).select(*GROUP, "block_timestamp").distinct()
    keep = has("proposal_vote", "proposal_id") | has("proposal_vote", "option") | has("message", "sender")
    rel = attrs.filter(keep).join(voting, [*GROUP, "block_timestamp"], "left_semi")
    fields = F.from_json("attribute_value", "map<string,string>")
    opened = rel.select("*", F.explode_outer(F.when(F.col("attribute_value").startswith("{"), fields)).alias("_k", "_v"))
    flat = opened.withColumn("attribute_key", F.coalesce("_k", "attribute_key")).withColumn("attribute_value", F.coalesce("_v", "attribute_value"))
    agg = objects(flat, [*BLOCK, "msg_group", "msg_sub_group"], {"proposal_id": "_p", "sender": "voter", "option": "vote_option", "weight": "_w"})
    out = agg.select(
        *BLOCK, "msg_group", "msg_sub_group", number("_p").cast("bigint").alias("proposal_id"), "voter", "vote_option", F.col("_w").try_cast("double").alias("vote_weight"),
        F.lit(None).cast("string").alias("memo"), STAMP).withColumn("_unique_key", concat_ws_strict("-", *GROUP, "voter"))
    return keyed(out, "governance_votes_id", "_unique_key")


# --- staking --------------------------------------------------------------------------------------


def _rank_back(df: DataFrame, out: str) -> DataFrame:
    """Position from the end of the (transaction, group, sub-group)."""
    neg = df.withColumn("_neg", -F.col("msg_index"))
    return row_number_in_group(neg, GROUP, ["_neg"], out, chunk=F.floor(F.col("_neg") / 10_000)).drop("_neg")


def staking(attrs: DataFrame) -> DataFrame:
    """Delegations, undelegations and redelegations with the account they act for.

    The delegator comes from the first source that knows it: the staking module's sender event, a spender
    of the same delegated-authorisation index, a spender of the same amount at the same position from the
    end, a spender of the same amount, and the caller of the transaction. (A sixth source, reward
    events, is named in the published precedence but its events are never loaded there.)
    """
    rel = of_type(attrs, "delegate", "redelegate", "unbond", "create_validator", "tx", "coin_spent", "message", "signer")
    names = {"validator": "_val", "destination_validator": "_dst", "source_validator": "redelegate_source_validator_address", "amount": "_raw",
             "authz_msg_index": "_authz", "completion_time": "_done"}
    acts = objects(of_type(rel, "delegate", "redelegate", "unbond", "create_validator"), [*EVENT, "msg_type"], names)
    acts = _rank_back(with_coin(acts, "_raw").withColumn("validator_address", F.coalesce("_val", "_dst")), "_rank")

    spent = objects(of_type(rel, "coin_spent"), [*GROUP, "msg_index"], {"spender": "spender", "amount": "_raw", "authz_msg_index": "_authz"})
    spent = _rank_back(with_coin(spent.drop(STAMP), "_raw"), "_rank")
    last = [newest("msg_index")]
    by_authz = dedup_latest(spent.filter(F.col("_authz").isNotNull()), ["tx_id", "_authz"], last)
    by_amount = dedup_latest(spent, [*GROUP, "amount"], last)
    sender = objects(of_type(rel, "message"), [*GROUP, "msg_index"], {"module": "_module", "sender": "_sender"}).filter("_module = 'staking'")
    sender = dedup_latest(sender, GROUP, ["msg_index"]).select(*GROUP, "_sender")

    def role(df, keys, name):
        return df.select(*keys, F.col("spender").alias(name), F.lit(True).alias(f"{name}_hit"))

    rows = acts.join(tx_sender(rel, "tx_caller_address"), "tx_id")
    rows = _join_group(rows, sender, [])
    rows = _join_group(rows, role(by_authz, [*GROUP, "_authz"], "_s1"), ["_authz"])
    ranked = role(spent, [*GROUP, "amount", "_rank"], "_s2")
    unauth = F.col("_authz").isNull()
    rows = _join_group(rows, ranked, ["amount", "_rank"], unauth, ["_s2", "_s2_hit"])
    no_earlier = F.col("_s1_hit").isNull() & F.col("_s2_hit").isNull()
    rows = _join_group(rows, role(by_amount, [*GROUP, "amount"], "_s3"), ["amount"], no_earlier, ["_s3", "_s3_hit"])

    action = F.replace(F.replace(F.col("msg_type"), F.lit("unbond"), F.lit("undelegate")), F.lit("create_validator"), F.lit("delegate"))
    out = rows.select(
        *BLOCK, "tx_caller_address", action.alias("action"), "msg_group", "msg_sub_group", "msg_index",
        F.coalesce("_sender", "_s1", "_s2", "_s3", "tx_caller_address").alias("delegator_address"), "amount", "currency", "validator_address",
        "redelegate_source_validator_address", F.col("_done").try_cast("timestamp_ntz").alias("completion_time"), STAMP)
    return keyed(out, "staking_id", "tx_id", "msg_index").withColumn("_unique_key", F.col("staking_id"))


def _join_group(left: DataFrame, right: DataFrame, more: list[str], when=None, blank: list[str] = ()) -> DataFrame:
    """Left join on transaction and group, NULL sub-groups matching each other; the columns in `blank` are
    emptied where `when` does not hold."""
    names = [*GROUP, *more]
    r = right.select(*[F.col(c).alias(f"_r{c}") if c in names else F.col(c) for c in right.columns])
    on = [F.col(c) == F.col(f"_r{c}") for c in names if c != "msg_sub_group"]
    on.append(F.col("msg_sub_group").eqNullSafe(F.col("_rmsg_sub_group")))
    cond = reduce(lambda a, b: a & b, on)
    out = left.join(r, cond, "left").drop(*[f"_r{c}" for c in names])
    if when is not None:
        out = out.withColumns({c: F.when(when, F.col(c)) for c in blank})
    return out


def staking_rewards(attrs: DataFrame) -> DataFrame:
    """Reward withdrawals per unit: the withdrawal names the validator, the transfer of the same amount in
    the same group the receiver."""
    rel = of_type(attrs, "withdraw_rewards", "transfer", "message", "tx", "signer")
    flat = objects(of_type(rel, "withdraw_rewards", "transfer"), [*GROUP, "msg_type", "msg_index"], {"amount": "amount", "validator": "validator_address", "recipient": "_to"})
    took = flat.filter("msg_type = 'withdraw_rewards'").select(*GROUP, "amount", "validator_address")
    paid = flat.filter("msg_type = 'transfer'").select(*GROUP, "amount", F.col("_to").alias("delegator_address"), F.col("_to").alias("rewards_recipient"))
    combo = took.join(paid, [*GROUP, "amount"])
    coins = split_coins(combo.withColumnRenamed("amount", "_coins"), "_coins")
    about = rel.groupBy(*BLOCK).agg(F.max(STAMP).alias(STAMP))
    joined = coins.join(about, "tx_id").join(tx_caller(rel), "tx_id")
    keys = [*BLOCK, "tx_caller_address", "msg_group", "msg_sub_group", "delegator_address", "rewards_recipient", "currency", "validator_address", STAMP]
    sums = joined.groupBy(*keys).agg(F.sum("amount").cast("decimal(38,0)").alias("amount")).withColumn("action", F.lit("withdraw_rewards"))
    unique = concat_ws_strict("-", *GROUP, "currency", "delegator_address", "validator_address")
    return keyed(sums.withColumn("_unique_key", unique), "staking_rewards_id", "_unique_key")


def validator_commission(attrs: DataFrame) -> DataFrame:
    """Commission withdrawals per coin with the operator and the receiving account."""
    groups = of_type(attrs, "withdraw_commission").select(*GROUP).distinct()
    account_text = 42  # fixed value: length of an account address; operators are longer
    wanted = [("withdraw_commission", "amount"), ("transfer", "recipient"), ("transfer", "amount"), ("message", "sender"), ("tx", "acc_seq"), ("signer", V.NATIVE_ADDRESS_KEY)]
    keep = reduce(lambda a, b: a | b, [has(t, k) for t, k in wanted])
    named = attrs.filter(keep & ~(has("message", "sender") & (F.length("attribute_value") == account_text)))
    in_group = named.join(groups, GROUP, "left_semi")
    heads = named.filter(F.col("msg_group").isNull() & has("tx", "acc_seq")).join(groups.select("tx_id").distinct(), "tx_id", "left_semi")
    base = in_group.unionByName(heads)
    combo = objects(of_type(in_group, "withdraw_commission", "message"), GROUP, {"sender": "validator_address_operator", "amount": "_coins"}).drop(STAMP)
    paid = of_type(in_group, "transfer").join(combo.select(*GROUP, F.col("_coins").alias("attribute_value")), [*GROUP, "attribute_value"], "left_semi").select("tx_id", "msg_index").distinct()
    to = in_group.filter(has(None, "recipient")).join(paid, ["tx_id", "msg_index"], "left_semi").select(*GROUP, F.col("attribute_value").alias("validator_address_reward"))
    about = base.groupBy(*BLOCK).agg(F.max(STAMP).alias(STAMP))
    each = combo.withColumn("_coin", F.explode(F.split("_coins", ",")))
    rows = each.join(about, "tx_id").join(tx_caller(base), "tx_id").join(to, GROUP)
    out = rows.select(*BLOCK, "tx_caller_address", "msg_group", "msg_sub_group", coin_amount("_coin").cast("double").alias("amount"), coin_denom("_coin").alias("currency"),
                      "validator_address_operator", "validator_address_reward", STAMP)
    return keyed(out, "validator_commission_id", "tx_id", "msg_group", "msg_sub_group")


# --- published views ------------------------------------------------------------------------------


def fact_staking(df: DataFrame) -> DataFrame:
    cols = [*BLOCK, "tx_caller_address", "action", "delegator_address", "amount", "currency", "validator_address", "redelegate_source_validator_address", "completion_time"]
    return published(df, cols, "staking_id", "fact_staking_id", "tx_id", "msg_index")


def fact_staking_rewards(df: DataFrame) -> DataFrame:
    cols = [*BLOCK, "tx_caller_address", "action", "delegator_address", "rewards_recipient", "validator_address", "amount", "currency"]
    return published(df, cols, "staking_rewards_id", "fact_staking_rewards_id", "_unique_key")


def fact_votes(df: DataFrame) -> DataFrame:
    cols = [*BLOCK, "voter", "proposal_id", "vote_option", "vote_weight", "memo"]
    return published(df, cols, "governance_votes_id", "fact_governance_votes_id", "_unique_key")


def fact_proposal_deposits(df: DataFrame) -> DataFrame:
    return published(df, [*BLOCK, "depositor", "proposal_id", "amount", "currency"], "governance_proposal_deposits_id", "fact_governance_proposal_deposits_id", "tx_id", "msg_index", "currency")


def fact_submitted_proposals(df: DataFrame) -> DataFrame:
    cols = [*BLOCK, "proposer", "proposal_id", "proposal_type", "proposal_title", "proposal_description"]
    return published(df, cols, "governance_submit_proposal_id", "fact_governance_submit_proposal_id", "tx_id")
