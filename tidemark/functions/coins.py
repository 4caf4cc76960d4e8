"""Coin texts such as '123usei' or '5usei,3ibc/27A'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import _col

# Fixed value: the unit of an amount that carries none.
BASE_DENOM = "usei"


def coin_amount_text(c) -> Column:
    """Leading digit run as text, cut to the 38 digits a number can hold; NULL when there is none."""
    digits = F.regexp_extract(_col(c), r"^([0-9]+)", 1)
    return F.when(F.length(digits) > 0, F.substring(digits, 1, 38))


def coin_amount(c) -> Column:
    return coin_amount_text(c).cast("decimal(38,0)")


def coin_denom(c) -> Column:
    """Everything after the leading digit run; a comma list keeps its tail."""
    return F.regexp_extract(_col(c), r"^[0-9]*(?s:(.*))$", 1)


def rate_amount(c) -> Column:
    """Amount with decimals, as exchange-rate votes carry it."""
    return F.regexp_extract(_col(c), r"^([0-9.]+)", 1).try_cast("decimal(38,18)")


def rate_denom(c) -> Column:
    return F.regexp_extract(_col(c), r"^[0-9.]*(?s:(.*))$", 1)


def split_coins(df: DataFrame, col: str, amount: str = "amount", denom: str = "currency") -> DataFrame:
    """One row per coin of a comma list; a bare number is in the base unit.

    Three unit shapes are known: the base unit, pool shares (from the first 'g') and bridged tokens
    (from the first 'i'); any other text counts as a bare number.
    """
    one = F.col("_coin")
    unit = (
        F.when(one.endswith(BASE_DENOM), F.lit(BASE_DENOM))
        .when(one.contains("pool"), F.expr("substring(_coin, instr(_coin, 'g'))"))
        .when(one.contains("ibc"), F.expr("substring(_coin, instr(_coin, 'i'))"))
        .otherwise(F.lit(BASE_DENOM))
    )
    return (
        df.withColumn("_coin", F.explode(F.split(F.col(col), ",")))
        .withColumn(denom, unit)
        .withColumn(amount, F.regexp_extract(one, r"^([0-9]+)", 1).try_cast("decimal(38,0)"))
        .drop("_coin")
    )
