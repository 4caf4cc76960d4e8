"""Joins that need a rewrite before Spark can run them as hash or sort-merge joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .windows import ffill

#: Characters of a pattern that a substring join matches on before it verifies.
PIECE = 4
#: Characters of patterns, with what they carry, that are sent to every task of a substring join.
MOST_SENT = 4_000_000


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi join in which NULL keys match NULL keys; the right key columns are dropped."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def hourly(facts: DataFrame, prices: DataFrame, token: str, ts: str, price_token: str = "token", hour: str = "hour", cols=("price",), prefix: str = "") -> DataFrame:
    """Left join of the price of the fact's hour; `prefix` names a second role."""
    p = prices.select(F.col(price_token).alias("_pt"), F.col(hour).alias("_ph"), *[F.col(c).alias(prefix + c) for c in cols])
    on = (F.col(token) == F.col("_pt")) & (F.date_trunc("hour", F.col(ts)) == F.col("_ph"))
    return facts.join(p, on, "left").drop("_pt", "_ph")


def in_interval(facts: DataFrame, intervals: DataFrame, keys: dict[str, str], x: str, lo: str, hi: str, width: int) -> DataFrame:
    """Rows whose x lies in an interval of the same key (both ends included).

    `keys` maps fact columns to interval columns. Intervals are cut into buckets of `width` and joined
    on (key, bucket): a key with a third of the facts spreads over its buckets. Open ends are clipped at
    the largest x, one scalar read first.
    """
    top = facts.agg(F.max(x).alias("m")).first()["m"]
    if top is None:
        top = 0
    clipped = F.least(F.col(hi), F.lit(top))
    cut = (
        intervals.filter(F.col(lo) <= top)
        .filter(F.col(hi) >= F.col(lo))
        .withColumn("_b", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(clipped / width))))
    )
    rows = facts.withColumn("_xb", F.floor(F.col(x) / width))
    on = reduce(lambda a, b: a & b, [F.col(f) == F.col(i) for f, i in keys.items()])
    return rows.join(cut, on & (F.col("_xb") == F.col("_b")) & F.col(x).between(F.col(lo), F.col(hi))).drop("_b", "_xb")


#: Blocks of one level that make a block of the next, as a power of two.
FAN = 3


def _blocks(lo: Column, count: Column) -> Column:
    """(level, block) pairs that cover lo … lo+count-1 exactly, at most 2 * (2**FAN - 1) a level.

    A block of level k holds 2**(FAN * k) numbers. Of each level a range takes what is left over on both sides of the
    whole blocks of the next.
    """
    end = lo + count

    def level(k: Column) -> Column:
        up = lambda x, k: -F.call_function("shiftright", -x, (k * FAN).cast("int"))
        down = lambda x, k: F.call_function("shiftright", x, (k * FAN).cast("int"))
        first, last = up(lo, k), down(end, k)
        inner = F.least(up(lo, k + 1) * 2**FAN, last)
        outer = F.greatest(down(end, k + 1) * 2**FAN, inner)

        def numbers(a: Column, b: Column) -> Column:
            each = F.transform(F.sequence(a, F.greatest(a, b - 1)), lambda n: F.struct(k.cast("int").alias("level"), n.alias("block")))
            return F.when(a < b, each).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))

        return F.when(first < last, F.concat(numbers(first, inner), numbers(outer, last))).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))

    levels = F.sequence(F.lit(0), F.floor(F.log2(F.greatest(count, F.lit(1)).cast("double")) / FAN).cast("int") + 1)
    return F.flatten(F.transform(levels, level))


def stabbing(points: DataFrame, ranges: DataFrame, keys: list[str], x: str, lo: str, count: str) -> DataFrame:
    """Points whose whole number x lies in lo … lo+count-1 of the same keys, once for each such range.

    A range becomes the few aligned blocks that cover it, some ten a level however long it is, and a point the one
    block of each level in use that holds it: an equi join, exact without a check, for ranges of any length that may
    overlap. Ranges without a length, and nulls, hold nothing.
    """
    some = ranges.filter((F.col(count) > 0) & F.col(lo).isNotNull())
    cut = some.withColumn("_b", F.explode(_blocks(F.col(lo).cast("bigint"), F.col(count).cast("bigint")))).withColumns({"_level": F.col("_b.level"), "_block": F.col("_b.block")}).drop("_b")
    used = sorted(r[0] for r in cut.select("_level").distinct().collect())  # 21 levels reach every bigint
    if not used:
        used = [0]
    each = points.withColumn("_level", F.explode(F.array(*[F.lit(k) for k in used])))
    each = each.withColumn("_block", F.call_function("shiftright", F.col(x).cast("bigint"), F.col("_level") * FAN))
    return each.join(cut, [*keys, "_level", "_block"]).drop("_level", "_block")


def nearest_preceding(events: DataFrame, part: list[str], order: list[str], is_mark: Column, is_probe: Column, cols: list[str], prefix: str = "prev_", chunk: Column | None = None) -> DataFrame:
    """Each probe row with the columns of the nearest mark before it; probes without one are dropped.

    One ordered pass instead of a range join: the mark's columns are carried forward.
    """
    carried = ffill(events, part, order, F.when(is_mark, F.struct(*cols)), "_mark", chunk)
    hit = carried.filter(is_probe & F.col("_mark").isNotNull())
    return hit.select(*events.columns, *[F.col(f"_mark.{c}").alias(prefix + c) for c in cols])


def either_key(left: DataFrame, right: DataFrame, pairs: list[tuple[Column, Column]], left_id: list[str]) -> DataFrame:
    """Inner join on any of several equalities: one equi join per pair, duplicates removed.

    An OR condition would force a nested loop over both tables.
    """
    parts = [left.join(right, a == b) for a, b in pairs]
    return reduce(DataFrame.unionByName, parts).dropDuplicates(left_id)


def contains_any(df: DataFrame, text: str, patterns: DataFrame, pattern: str, carry: list[str] = ()) -> DataFrame:
    """Case-blind substring join: one row per (row, pattern found in its text). Patterns are plain text, not
    wildcards.

    Each pattern is known by its first piece of at most PIECE characters. Rows are cut into their distinct
    pieces of the lengths in use, joined on the piece, and the candidates verified. An empty pattern has the
    empty piece, which every text holds; NULL texts and patterns match nothing.

    Few patterns are sent to the rows, many are met by a shuffle. Rows are never sent: the size that Spark knows of them
    is that of the texts, not of their pieces.
    """
    cols = list(dict.fromkeys([pattern, *carry]))
    low = F.lower(F.col(text))
    keyed = patterns.select(*cols).filter(F.col(pattern).isNotNull()).distinct()
    keyed = keyed.withColumn("_head", F.substring(F.lower(F.col(pattern)), 1, PIECE))

    def pieces(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length("_low") - n + 1, F.lit(1)))
        whole = F.transform(starts, lambda i: F.substring(F.col("_low"), i, F.lit(n)))
        return F.when(F.length("_low") >= n, F.array_distinct(whole)).otherwise(F.array().cast("array<string>"))

    cut = df.withColumn("_low", low).filter(F.col("_low").isNotNull())
    room = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in cols), F.lit(32))
    lengths = keyed.groupBy(F.length("_head").alias("n")).agg(F.sum(room.cast("bigint")).alias("room")).collect()  # PIECE + 1 rows at most
    used = sorted(r["n"] for r in lengths)
    sent = "broadcast" if sum(r["room"] for r in lengths) <= MOST_SENT else "merge"
    empty = F.array().cast("array<string>")
    cut = cut.withColumn("_piece", F.explode(F.concat(empty, *[pieces(n) if n else F.array(F.lit("")) for n in used])))
    hits = cut.join(keyed.hint(sent), F.col("_piece") == F.col("_head")).filter(F.col("_low").contains(F.lower(F.col(pattern))))
    return hits.drop("_piece", "_head", "_low")


def path_prefixes(address: Column, sep: str = "_", root: str = "ORIGIN") -> Column:
    """A node's own path, every ancestor's path, and the root."""
    steps = F.split(address, sep)
    own = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), sep))
    return F.array_distinct(F.concat(own, F.array(F.lit(root))))


def inside_flagged(nodes: DataFrame, part: list[str], address: str, flagged: Column, out: str, root: str = "ORIGIN") -> DataFrame:
    """Mark nodes that are flagged or lie below a flagged node.

    Each node is matched to the flagged addresses by exploding its own path prefixes, an equi join in
    place of a regex per pair.
    """
    bad = nodes.filter(flagged).select(*part, F.col(address).alias("_bad")).distinct()
    probes = nodes.select(*part, address).distinct().withColumn("_bad", F.explode(path_prefixes(F.col(address), root=root)))
    hit = probes.join(bad, [*part, "_bad"], "left_semi").select(*part, address).distinct().withColumn("_h", F.lit(True))
    return nodes.join(hit, [*part, address], "left").withColumn(out, F.coalesce("_h", F.lit(False))).drop("_h")


def inside_flagged_payload(nodes: DataFrame, part: list[str], address: str, flagged: Column, out: str, root: str = "ORIGIN") -> DataFrame:
    """The same for groups that came out of one payload row each. The group's few flagged addresses are held
    as one list beside its nodes, which are made and sent once: nothing is joined."""
    bad = F.collect_set(F.when(flagged, F.col(address))).over(Window.partitionBy(*part))
    own = F.col(address)
    hit = F.exists("_bad", lambda b: (b == root) | (own == b) | own.startswith(F.concat(b, F.lit("_"))))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in part])
    return nodes.withColumn("_bad", bad).withColumn(out, F.when(~whole | (F.size("_bad") == 0), F.lit(False)).otherwise(hit)).drop("_bad")


def many_roles(rows: DataFrame, keys: list[str], tokens: Column, dim: DataFrame, dim_key: str, attrs: list[str]) -> DataFrame:
    """Look up one dimension for every entry of a short list column and return one map per attribute.

    `tokens` is an array bounded by the row's layout (eight at most in a pool); positions become the
    names token0, token1, … NULL entries and misses stay out of the maps. Keys must be unique.
    """
    flat = rows.select(*keys, F.posexplode(tokens).alias("_pos", "_tok")).filter(F.col("_tok").isNotNull())
    looked = flat.join(dim.select(F.col(dim_key).alias("_tok"), *attrs), "_tok", "left")
    name = F.concat(F.lit("token"), F.col("_pos").cast("string"))

    def as_map(col):
        pairs = F.collect_list(F.when(F.col(col).isNotNull(), F.struct(name.alias("k"), F.col(col).alias("v"))))
        return F.map_from_entries(F.array_sort(pairs))

    return looked.groupBy(*keys).agg(as_map("_tok").alias("tokens"), *[as_map(a).alias(f"{a}_by_token") for a in attrs])


def daily_spine(ranges: DataFrame, lo: str, hi: Column, out: str = "day") -> DataFrame:
    """One row per day from the first day to the last, both included; nothing when they are reversed."""
    days = F.when(F.col(lo) <= hi, F.sequence(F.col(lo), hi, F.expr("interval 1 day")))
    return ranges.withColumn(out, F.explode(days))


def pages(df: DataFrame, count: str, size: int, out: str = "page") -> DataFrame:
    """One row per page needed for `count` items; none for zero items."""
    n = F.ceil(F.col(count) / size).cast("int")
    return df.filter(F.col(count) > 0).withColumn(out, F.explode(F.sequence(F.lit(1), n)))


def int_range(df: DataFrame, lo: Column, n: Column, out: str = "value") -> DataFrame:
    """Rows lo … lo+n-1; none for n = 0, where sequence() would count down."""
    return df.filter(n > 0).withColumn(out, F.explode(F.sequence(lo, lo + n - 1)))


def missing_between(df: DataFrame, prev: str, cur: str, out: str = "missing") -> DataFrame:
    """Ids strictly between two neighbours."""
    return int_range(df.filter(F.col(prev).isNotNull()), F.col(prev) + 1, F.col(cur) - F.col(prev) - 1, out)
