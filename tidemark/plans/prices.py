"""Asset metadata and hourly prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.coins import BASE_DENOM
from ..functions.common import newest, oldest
from ..operators.rows import flatten
from ..operators.sets import union_all
from ..operators.windows import dedup_latest
from .audit import keyed
from .cosmos import values as V

STAMP = "_inserted_timestamp"


def of_chain(shared: DataFrame, col: str = "blockchain", chain: str = V.CHAIN, symbol: str | None = None) -> DataFrame:
    """Rows of a shared multi-chain table that belong to this chain."""
    mine = shared.filter(F.col(col).ilike(f"{chain}%"))
    return mine if symbol is None else mine.filter(F.col("symbol") == symbol)


def native_prices(shared: DataFrame) -> DataFrame:
    return of_chain(shared, symbol=V.NATIVE_SYMBOL)


def by_lower_address(df: DataFrame) -> DataFrame:
    return df.withColumn("token_address", F.lower("token_address"))


def api_prices(raw: DataFrame) -> DataFrame:
    """Price-list payloads to one row per contract, newest arrival."""
    each = flatten(raw.select(F.try_variant_get(F.try_parse_json("data"), "$.data", "array<variant>").alias("_l"), STAMP), "_l", "_i", "_p")
    get = lambda p, t="string": F.try_variant_get("_p", p, t)
    rows = each.select(
        get("$.coingecko").alias("coingecko"), get("$.coinmarketcap").alias("coinmarketcap"), get("$.description").alias("description"), get("$.id").alias("contract_address"),
        get("$.name").alias("name"), get("$.precision", "int").alias("decimals"), get("$.price", "double").alias("price"), F.to_json(get("$.slugs", "variant")).alias("slugs"),
        get("$.symbol").alias("symbol"), get("$.type").alias("type"), STAMP)
    return keyed(dedup_latest(rows, ["contract_address"], [newest(STAMP), newest("price"), newest("name")]), "prices_api_id", "contract_address")


def listed_hourly_prices(shared: DataFrame, api: DataFrame) -> DataFrame:
    """Hourly prices of the ids the price list names."""
    known = api.filter(F.coalesce("coingecko", F.lit("")) != "").select(F.col("coingecko").alias("id")).distinct()
    return shared.join(known, "id", "left_semi")


def provider_prices(prices: DataFrame, metadata: DataFrame) -> DataFrame:
    """Newest price per (asset, hour, provider), for assets known on this chain."""
    known = prices.join(metadata.select("asset_id"), "asset_id", "left_semi")
    return dedup_latest(known, ["asset_id", "recorded_hour", "provider"], [newest("modified_timestamp"), newest("complete_provider_prices_id")])


def prices_ohlc(provider: DataFrame) -> DataFrame:
    return provider.select("asset_id", F.col("recorded_hour").alias("hour"), "open", "high", "low", "close", "provider", "inserted_timestamp", "modified_timestamp",
                           F.col("complete_provider_prices_id").alias("fact_prices_ohlc_hourly_id"))


def dim_asset_metadata(provider: DataFrame, native: DataFrame) -> DataFrame:
    stamps = ["inserted_timestamp", "modified_timestamp"]
    a = provider.select("token_address", "asset_id", "symbol", "name", F.col("platform").alias("blockchain"), F.col("platform_id").alias("blockchain_id"), "provider", *stamps,
                        F.col("complete_provider_asset_metadata_id").alias("dim_asset_metadata_id"))
    b = native.select(F.lit(BASE_DENOM).alias("token_address"), "asset_id", F.lower("symbol").alias("symbol"), "name", F.lit(V.PRICE_ID).alias("blockchain"), F.lit(V.PRICE_ID).alias("blockchain_id"),
                      "provider", *stamps, F.col("complete_native_asset_metadata_id").alias("dim_asset_metadata_id"))
    return union_all([a, b])


def ez_asset_metadata(tokens: DataFrame, native: DataFrame, dim_tokens: DataFrame, dim_contracts: DataFrame) -> DataFrame:
    """One metadata row per token: chain tables know symbol, name and decimals best."""
    stamps = ["inserted_timestamp", "modified_timestamp"]
    best = dedup_latest(tokens, ["token_address"], ["provider", newest("inserted_timestamp"), oldest("asset_id")])
    a = best.select("token_address", "asset_id", "symbol", "name", "decimals", "blockchain", F.lit(False).alias("is_native"), "is_deprecated", "is_verified", "is_verified_modified_timestamp", *stamps,
                    F.col("complete_token_asset_metadata_id").alias("ez_asset_metadata_id"))
    b = native.select(F.lit(BASE_DENOM).alias("token_address"), "asset_id", "symbol", "name", "decimals", "blockchain", F.lit(True).alias("is_native"), "is_deprecated", F.lit(True).alias("is_verified"),
                      F.lit(None).cast("timestamp_ntz").alias("is_verified_modified_timestamp"), *stamps, F.col("complete_native_asset_metadata_id").alias("ez_asset_metadata_id"))
    t = dim_tokens.select(F.col("currency").alias("token_address"), F.col("symbol").alias("_ts"), F.col("token_name").alias("_tn"), F.col("decimals").alias("_td"))
    c = dim_contracts.select(F.col("address").alias("token_address"), F.col("symbol").alias("_cs"), F.col("name").alias("_cn"), F.col("decimals").alias("_cd"))
    rows = union_all([a, b]).join(t, "token_address", "left").join(c, "token_address", "left")
    rows = rows.withColumns({"symbol": F.coalesce("_ts", "_cs", "symbol"), "name": F.coalesce("_tn", "_cn", "name"), "decimals": F.coalesce("_td", "_cd", "decimals")})
    return rows.drop("_ts", "_tn", "_td", "_cs", "_cn", "_cd")


def ez_prices_hourly(tokens: DataFrame, native: DataFrame, metadata: DataFrame) -> DataFrame:
    """One price per (token, hour)."""
    cols = ["hour", "token_address", "price", "blockchain", "is_native", "is_imputed", "is_deprecated", "is_verified", "inserted_timestamp", "modified_timestamp", "ez_prices_hourly_id"]
    a = tokens.withColumn("is_native", F.lit(False)).withColumnRenamed("complete_token_prices_id", "ez_prices_hourly_id").select(*cols)
    b = native.withColumns({"token_address": F.lit(BASE_DENOM), "is_native": F.lit(True), "is_verified": F.lit(True)}).withColumnRenamed("complete_native_prices_id", "ez_prices_hourly_id").select(*cols)
    best = dedup_latest(union_all([a, b]), ["token_address", "hour"], ["blockchain", newest("modified_timestamp"), oldest("ez_prices_hourly_id")])
    return best.join(metadata.select("token_address", "symbol", "name", "decimals"), "token_address", "left")
