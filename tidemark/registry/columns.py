"""Scalar functions and domain column jobs over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coins, common as c, hexwords as h
from ..operators import rows
from .base import query

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
LINE_SQL = ", ".join(LINE)


@query("op_parse_coin", "select event_id, cast(regexp_extract(attribute_value, '^([0-9]+)', 1) as varchar) as amount, regexp_extract(attribute_value, '^[0-9]*(.*)$', 1) as denom from v_attrs")
def parse_coin(t):
    return t.attrs.select("event_id", coins.coin_amount("attribute_value").alias("amount"), coins.coin_denom("attribute_value").alias("denom"))


@query("op_split_coins", """with x as (select user_id, unnest([json_extract_string(props, '$.k') || 'usei', '5gamm/pool/1', event_id || 'ibc/AB', json_extract_string(props, '$.k')]) as coin from events),
    p as (select user_id, cast(regexp_extract(coin, '^([0-9]+)', 1) as bigint) as a, case when coin like '%usei' then 'usei' when coin like '%pool%' then substr(coin, instr(coin, 'g')) when coin like '%ibc%' then substr(coin, instr(coin, 'i')) else 'usei' end as currency from x)
    select user_id, currency, cast(sum(a) as varchar) as amount from p group by 1, 2""")
def split_coins(t):
    k = F.get_json_object("props", "$.k")
    text = F.concat(k, F.lit("usei,5gamm/pool/1,"), F.col("event_id"), F.lit("ibc/AB,"), k)
    return coins.split_coins(t.events.select("user_id", text.alias("coins")), "coins").groupBy("user_id", "currency").agg(F.sum("amount").cast("string").alias("amount"))


@query("op_rate_votes", "select event_id, value as amount, 'uatom' as currency from events")
def rate_votes(t):
    text = F.concat(F.col("value").cast("decimal(18,2)").cast("string"), F.lit("uatom"))
    v = t.events.select("event_id", text.alias("vote"))
    return v.select("event_id", coins.rate_amount("vote").cast("double").alias("amount"), coins.rate_denom("vote").alias("currency"))


@query("op_hex_words", f"select {LINE_SQL}, substr(data, 3, 64) as w0, substr(data, 67, 64) as w1 from v_words")
def hex_words(t):
    w = t.words.withColumn("w", h.hex_words("data"))
    return w.select(*LINE, h.word("w", 0).alias("w0"), h.word("w", 1).alias("w1"))


@query("op_hex_to_int", f"""select {LINE_SQL}, cast(l_partkey as varchar) as part, cast(cast(l_quantity as bigint) as varchar) as qty, cast(-l_partkey - 1 as varchar) as below,
    cast(cast(l_partkey + 1 as hugeint) * 18446744073709551616 as varchar) as shifted from v_words""")
def hex_to_int(t):
    w = t.words.withColumn("w", h.hex_words("data"))
    flipped = F.translate(h.word("w", 0), "0123456789abcdef", "fedcba9876543210")
    high = F.concat(F.lpad(F.lower(F.hex(F.col("l_partkey") + 1)), 48, "0"), F.lit("0" * 16))
    return w.select(*LINE, h.hex_to_number(h.word("w", 0)).alias("part"), h.hex_to_text_number(h.word("w", 1)).alias("qty"),
                    h.signed_hex_to_number(flipped).alias("below"), h.hex_to_text_number(high).alias("shifted"))


@query("op_topic_address", f"select {LINE_SQL}, '0x' || substr(data, 67 + 24, 40) as address from v_words")
def topic_address(t):
    return t.words.select(*LINE, h.topic_address(h.word(h.hex_words("data"), 1)).alias("address"))


@query("op_hex_to_text", "select c_custkey, c_name as name from customer")
def hex_to_text(t):
    return t.customer.select("c_custkey", h.hex_to_text(F.concat(F.lit("0x"), F.hex("c_name"), F.lit("0000"))).alias("name"))


@query("op_decimal_adjust", f"select {LINE_SQL}, cast(round(l_quantity, 0) / 1000 as varchar) as adjusted from lineitem")
def decimal_adjust(t):
    raw = F.col("l_quantity").cast("bigint").cast("string")
    return t.lineitem.select(*LINE, h.decimal_adjust(raw, F.lit(3)).alias("adjusted"))


@query("op_packet_slice", f"select {LINE_SQL}, substr(data, 3, 16) as version, substr(data, 3 + 56, 8) as src, substr(data, 3 + 120, 8) as dst from v_words")
def packet_slice(t):
    f = h.packet_slice("data", {"version": (0, 16), "src": (56, 8), "dst": (120, 8)})
    return t.words.select(*LINE, *[v.alias(k) for k, v in f.items()])


@query("op_dynamic_offset", """with o as (select l_orderkey, count(*) as n from lineitem group by 1) select l_orderkey, i as idx, lpad(lower(to_hex(l_orderkey + i)), 64, '0') as token, lpad(lower(to_hex(i)), 64, '0') as amount
    from o, unnest(range(0, n)) as r(i)""")
def dynamic_offset(t):
    """Per order a payload: head word with the byte offset, count, then (token, amount) pairs."""
    def w(col):
        return F.lpad(F.lower(F.hex(col)), 64, "0")
    o = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    body = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.concat(w(F.col("l_orderkey") + i), w(i))), "")
    payload = F.concat(w(F.lit(7).cast("bigint")), w(F.lit(96).cast("bigint")), w(F.lit(0).cast("bigint")), w(F.col("n")), body)
    words = o.select("l_orderkey", h.hex_words(payload).alias("w"))
    pairs = rows.flatten(words.select("l_orderkey", h.dynamic_array("w", 1, 2).alias("pairs")), "pairs", "idx", "p")
    return pairs.select("l_orderkey", F.col("idx").cast("bigint").alias("idx"), F.col("p")[0].alias("token"), F.col("p")[1].alias("amount"))


@query("op_event_signature", """select l_orderkey, 'Order' || l_orderkey || '(' || string_agg(case when l_returnflag = 'R' then '(uint' || l_linenumber || ',address)[]' else 'bytes' || l_linenumber end, ',' order by l_linenumber, l_suppkey, l_returnflag = 'R') || ')' as signature
    from lineitem group by 1""")
def event_signature(t):
    """Interface JSON of an event per order, an input per line, to its signature; tuples are written out."""
    from ..plans.evm import abis
    pair = F.array(F.struct(F.concat(F.lit("uint"), F.col("l_linenumber")).alias("type")), F.struct(F.lit("address").alias("type")))
    back = F.col("l_returnflag") == "R"
    typ = F.when(back, F.lit("tuple[]")).otherwise(F.concat(F.lit("bytes"), F.col("l_linenumber")))
    part = F.struct(F.col("l_linenumber").alias("n"), F.col("l_suppkey").alias("s"), F.struct(typ.alias("type"), F.when(back, pair).alias("components")).alias("i"))
    events = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    inputs = F.to_json(F.transform("parts", lambda p: p["i"]))
    named = events.select("l_orderkey", F.concat(F.lit("Order"), F.col("l_orderkey")).alias("name"), inputs.alias("inputs"))
    return abis.with_signature(named, "signature").select("l_orderkey", "signature")


@query("op_flatten_decoded", """with a as (select tx_id, case when msg_type = 'view' then 'anonymous_' || msg_index else msg_type end as name, max(attribute_value) as v from v_attrs group by 1, 2)
    select tx_id, string_agg(name || '=' || v, ',' order by name) as decoded_flat from a group by 1""")
def flatten_decoded(t):
    """Decoded parameters as JSON, unnamed ones by position, to one map per log."""
    from ..operators.aggregates import pivot_map
    name = F.when(F.col("msg_type") == "view", F.concat(F.lit("anonymous_"), F.col("msg_index"))).otherwise(F.col("msg_type"))
    return pivot_map(t.attrs.withColumn("name", name), ["tx_id"], "name", "attribute_value", "decoded_flat")


# --- function families ---------------------------------------------------------------------------


@query("fn_string", """select c_custkey, split_part(c_name, '#', 1) as p1, substr(c_name, 3, 4) as sub, left(c_name, 3) as l3, right(c_name, 4) as r4, length(c_name) as len,
    upper(c_mktsegment) as up, replace(c_name, '#', '') as rep, instr(c_name, '#') as pos, c_name || '-' || c_mktsegment as joined, lower(to_hex(c_custkey)) as hx, rpad(c_mktsegment, 12, '.') as rp from customer""")
def strings(t):
    return t.customer.select(
        "c_custkey", c.part("c_name", "#", 0).alias("p1"), F.substring("c_name", 3, 4).alias("sub"), F.left("c_name", F.lit(3)).alias("l3"), F.right("c_name", F.lit(4)).alias("r4"),
        F.length("c_name").cast("bigint").alias("len"), F.upper("c_mktsegment").alias("up"), F.replace("c_name", F.lit("#")).alias("rep"), F.instr("c_name", "#").cast("bigint").alias("pos"),
        c.concat_ws_strict("-", "c_name", "c_mktsegment").alias("joined"), F.lower(F.hex("c_custkey")).alias("hx"), F.rpad("c_mktsegment", 12, ".").alias("rp"))


@query("fn_regex", r"""select p_partkey, regexp_replace(p_brand, '[^0-9]', ' ', 'g') as digits, regexp_full_match(p_name, '[a-z]+ [a-z]+') as two_words, regexp_full_match(p_name, '[a-z]+') as one_word,
    p_type ilike 'eco%' as eco from part""")
def regex(t):
    return t.part.select("p_partkey", F.regexp_replace("p_brand", "[^0-9]", " ").alias("digits"), c.full_match("p_name", "[a-z]+ [a-z]+").alias("two_words"),
                         c.full_match("p_name", "[a-z]+").alias("one_word"), F.col("p_type").ilike("eco%").alias("eco"))


@query("fn_datetime", """select event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as h, strftime(cast(ts as date), '%Y-%m-%d') as d, strftime(ts - interval 90 minutes, '%Y-%m-%d %H:%M:%S') as back,
    cast(floor(epoch(ts)) as bigint) as secs from events""")
def datetimes(t):
    return t.events.select("event_id", F.date_trunc("hour", "ts").alias("h"), F.to_date("ts").alias("d"), (F.col("ts") - F.expr("interval 90 minutes")).alias("back"),
                           F.unix_seconds(F.col("ts").cast("timestamp")).alias("secs"))


@query("fn_math", """select o_orderkey, (o_orderkey + 500) // 1000 * 1000 as bucket, abs(o_orderkey - 7000) as dist, cast(ceil(o_orderkey / 100.0) * 100 as bigint) as up100, o_orderkey % 7 as m,
    o_totalprice / nullif(o_orderkey, 0) as per, cast(trunc(o_orderkey / 2.0) as bigint) as half, power(10, 2) as p, case when o_orderkey > 5 then greatest(o_orderkey, 9) end as g from orders""")
def maths(t):
    k = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", F.round(k, -3).alias("bucket"), F.abs(k - 7000).alias("dist"), (F.ceil(k / 100) * 100).alias("up100"), (k % 7).alias("m"), c.ratio("o_totalprice", k).alias("per"),
        F.expr("o_orderkey div 2").alias("half"), F.pow(F.lit(10.0), F.lit(2)).alias("p"), c.greatest_strict(F.when(k > 5, k), F.lit(9).cast("bigint")).alias("g"))


@query("fn_cast_conditional", """select p_partkey, try_cast(substr(p_brand, 7) as int) as n, try_cast(p_brand as int) as bad, case when p_size > 25 then 'big' else 'small' end as sz, coalesce(nullif(p_type, 'SMALL'), 'tiny') as ty from part""")
def casts(t):
    return t.part.select("p_partkey", F.substring("p_brand", 7, 9).try_cast("int").alias("n"), F.col("p_brand").try_cast("int").alias("bad"),
                         F.when(F.col("p_size") > 25, "big").otherwise("small").alias("sz"), F.coalesce(F.nullif(F.col("p_type"), F.lit("SMALL")), F.lit("tiny")).alias("ty"))


@query("fn_array", """select vec_id, len(embedding) as n, round(cast(embedding[2] as double), 6) as second, embedding[100000] is null as past_end, len(list_distinct(range(0, label + 1))) as span from embeddings""")
def arrays(t):
    return t.embeddings.select("vec_id", F.size("embedding").cast("bigint").alias("n"), F.round(F.get("embedding", F.lit(1)).cast("double"), 6).alias("second"),
                               F.get("embedding", F.lit(99999)).isNull().alias("past_end"), F.size(F.array_distinct(F.sequence(F.lit(0), F.col("label")))).cast("bigint").alias("span"))


@query("fn_map_json", """select event_id, case when event_type = 'error' then 'type=error' else 'k=' || json_extract_string(props, '$.k') || ',type=' || event_type end as m, json_extract_string(props, '$.k') as k,
    json_type(props::json) = 'OBJECT' as is_object from events""")
def maps(t):
    k = F.get_json_object("props", "$.k")
    m = F.create_map(F.lit("type"), F.col("event_type"), F.lit("k"), F.when(F.col("event_type") != "error", k))
    v = F.try_parse_json("props")
    return t.events.select("event_id", c.drop_null_entries(m).alias("m"), F.try_variant_get(v, "$.k", "string").alias("k"), F.schema_of_variant(v).startswith("OBJECT").alias("is_object"))


@query("fn_hash_encoding", "select c_custkey, md5(c_name) as m, sha256(c_name) as s, c_name as round_trip, cast(null as varchar) as bad from customer")
def hashes(t):
    return t.customer.select("c_custkey", F.md5("c_name").alias("m"), F.sha2("c_name", 256).alias("s"), c.base64_text(F.base64("c_name")).alias("round_trip"), c.base64_text(F.lit("%%%")).alias("bad"))
