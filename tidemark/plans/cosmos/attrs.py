"""Shared steps over the message-attribute table.

Attribute rows carry: block_id, block_timestamp, tx_id, tx_succeeded, msg_group, msg_sub_group,
msg_index, msg_type, attribute_index, attribute_key, attribute_value, _inserted_timestamp.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.coins import coin_amount, coin_denom
from ...functions.common import part
from ...operators.windows import dedup_latest
from . import values as V

BLOCK = ["block_id", "block_timestamp", "tx_id", "tx_succeeded"]
GROUP = ["tx_id", "msg_group", "msg_sub_group"]
STAMP = "_inserted_timestamp"
EVENT = [*BLOCK, "msg_group", "msg_sub_group", "msg_index"]


def of_type(attrs: DataFrame, *types: str) -> DataFrame:
    return attrs.filter(F.col("msg_type").isin(*types))


def has(msg_type: str | None, key: str, *vals: str) -> Column:
    """Attribute rows of a type with a key and, if given, one of some values."""
    cond = F.col("attribute_key") == key
    if msg_type:
        cond = cond & (F.col("msg_type") == msg_type)
    return cond & F.col("attribute_value").isin(*vals) if vals else cond


def objects(attrs: DataFrame, keys: list[str], names: list[str] | dict[str, str]) -> DataFrame:
    """One row per event with a column per attribute; names may map attribute → column.

    The latest arrival stamp of the rows is carried along.
    """
    cols = names if isinstance(names, dict) else {n: n for n in names}
    extra = [STAMP] if STAMP in attrs.columns and STAMP not in keys else []
    wide = [F.max(F.when(F.col("attribute_key") == k, F.col("attribute_value"))).alias(c) for k, c in cols.items()]
    return attrs.groupBy(*keys).agg(*wide, *[F.max(STAMP).alias(STAMP) for _ in extra])


def number(c: str) -> Column:
    return F.col(c).try_cast("decimal(38,0)")


def with_coin(df: DataFrame, raw: str, amount: str = "amount", currency: str = "currency") -> DataFrame:
    return df.withColumn(amount, coin_amount(raw)).withColumn(currency, coin_denom(raw))


def _first_order(attrs: DataFrame) -> list[str]:
    return [c for c in ("msg_index", "attribute_index", "attribute_value") if c in attrs.columns]


def sender_rows(attrs: DataFrame) -> DataFrame:
    return attrs.filter(reduce(lambda a, b: a | b, [has(t, k) for t, k in V.SENDER_SOURCES]))


def tx_sender(attrs: DataFrame, name: str) -> DataFrame:
    """First signer of each transaction: text before the first '/'."""
    first = dedup_latest(sender_rows(attrs), ["tx_id"], _first_order(attrs))
    return first.select("tx_id", part("attribute_value", "/", 1).alias(name))


def tx_caller(attrs: DataFrame, name: str = "tx_caller_address") -> DataFrame:
    """Alphabetically first signer of each transaction."""
    signers = sender_rows(attrs).select("tx_id", part("attribute_value", "/", 1).alias(name))
    return signers.groupBy("tx_id").agg(F.min(name).alias(name))


def fee_payer(attrs: DataFrame, name: str = "tx_fee_payer") -> DataFrame:
    """First fee payer of each transaction, so that a swap stays one row."""
    first = dedup_latest(attrs.filter(has("tx", "fee_payer")), ["tx_id"], _first_order(attrs))
    return first.select("tx_id", F.col("attribute_value").alias(name))


def groups_calling(attrs: DataFrame, contracts: DataFrame, keys: list[str] = GROUP, msg_type: str = "execute", contract: str = "contract_address") -> DataFrame:
    """Distinct groups in which a message names one of the contracts."""
    calls = attrs.filter(has(msg_type, "_contract_address")).select(*keys, F.col("attribute_value").alias(contract))
    return calls.join(contracts.select(contract), contract, "left_semi").select(*keys).distinct()


def groups_doing(attrs: DataFrame, *actions: str, keys: list[str] = GROUP, msg_type: str = "wasm") -> DataFrame:
    return attrs.filter(has(msg_type, "action", *actions)).select(*keys).distinct()


def both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys in both tables; NULL keys match NULL keys, so messages outside every group count too."""
    return a.intersect(b.select(a.columns))
