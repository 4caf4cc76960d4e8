"""Per-group order operators.

Top-n forms filter on row_number(): Spark then keeps n rows per group on the map side
(WindowGroupLimit), so a group holding a third of the table sends n rows per task, not all of them.

Running forms need every row in order. A plain window sorts a whole group in one task. They therefore
take a `chunk`: a column that never decreases along the group's order (an hour, a block range). Work
runs inside (group, chunk), one row per chunk carries the state across chunks, and each row gets its
carry by a join. The carry table holds one row per (group, chunk). Without `chunk` a plain window is
used, for groups that are bounded by nature.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.common import oldest
from ..session import staged

UNBOUNDED = Window.unboundedPreceding
CHUNK = "_chunk"


def _order(order) -> list[Column]:
    return [oldest(o) if isinstance(o, str) else o for o in order]


def _with_chunk(df: DataFrame, chunk) -> DataFrame:
    return df.withColumn(CHUNK, F.lit(0) if chunk is None else chunk)


def _join_carry(df: DataFrame, carry: DataFrame, keys: list[str], new: list[str]) -> DataFrame:
    """Bring per-chunk columns onto the rows; NULL keys match NULL keys."""
    small = carry.select(*[F.col(k).alias(f"_c_{k}") for k in keys], *new)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys])
    return df.join(small, on, "left").drop(*[f"_c_{k}" for k in keys])


def _span(chunks: DataFrame) -> Column:
    """Neighbouring chunks under one number: a thousand for numbers, a year for dates."""
    kind = chunks.schema[CHUNK].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.floor(F.col(CHUNK) / 1024)
    return F.year(CHUNK) if kind in ("date", "timestamp", "timestamp_ntz") else F.lit(0)


def _carry(chunks: DataFrame, part: list[str], value: str, out: str, kind: str, wide: bool = False) -> DataFrame:
    """For each chunk of the group what the chunks before it leave (`sum`, `last`), or what the chunks after it
    begin with (`first`); NULL values count for nothing. With `wide`, first among the chunks of a span, then
    among spans."""
    ahead = kind == "first"
    frame = (1, Window.unboundedFollowing) if ahead else (UNBOUNDED, -1)

    def over(col: str, w) -> Column:
        if kind == "sum":
            return F.sum(col).over(w)
        return (F.first if ahead else F.last)(col, ignorenulls=True).over(w)

    if not wide:
        return chunks.withColumn(out, over(value, Window.partitionBy(*part).orderBy(CHUNK).rowsBetween(*frame)))
    rows = chunks.withColumn("_span", _span(chunks))
    rows = rows.withColumn("_near", over(value, Window.partitionBy(*part, "_span").orderBy(CHUNK).rowsBetween(*frame)))
    at = F.when(F.col(value).isNotNull(), F.col(CHUNK))
    whole = F.sum(value) if kind == "sum" else (F.min_by if ahead else F.max_by)(F.col(value), at)
    spans = rows.groupBy(*part, "_span").agg(whole.alias("_whole"))
    spans = spans.withColumn("_far", over("_whole", Window.partitionBy(*part).orderBy("_span").rowsBetween(*frame)))
    joined = _join_carry(rows, spans, [*part, "_span"], ["_far"])
    if kind == "sum":
        state = F.when(F.col("_near").isNull(), F.col("_far")).otherwise(F.col("_near") + F.coalesce("_far", F.lit(0)))
    else:
        state = F.coalesce("_near", "_far")
    return joined.withColumn(out, state).drop("_span", "_near", "_far")


#: Rows of one group that a chunk should hold at most.
CHUNK_ROWS = 1_000_000


def time_chunks(df: DataFrame, part: list[str], ts: str, out: str, size: int = CHUNK_ROWS) -> DataFrame:
    """Add a chunk for the running forms: days, and for a group's day with more than `size` rows its hours, minutes
    or seconds, whichever its fullest hour calls for. The unit is the same all day, so chunks never decrease. Rows
    without a time make the last chunk, as they come last in the order.

    Rows are counted by (group, day) first; only days that are too full are counted by hour and come back to the
    rows, by a join on a table of at most rows / size entries. Without such a day there is no join.
    """
    day, last = F.date_trunc("day", F.col(ts)), F.lit("9999-12-31").cast("timestamp")
    counted = df.groupBy(*part, day.alias("_d")).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > size) & F.col("_d").isNotNull())
    if counted.isEmpty():
        return df.withColumn(out, F.coalesce(day, last))
    counted = staged(counted.drop("_n").withColumn("_full", F.lit(True)), "full_days")
    near = _join_carry(df.select(*part, F.col(ts).alias("_t")).withColumn("_d", F.date_trunc("day", "_t")), counted, [*part, "_d"], ["_full"]).filter("_full")
    hours = near.groupBy(*part, "_d", F.date_trunc("hour", "_t").alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    full = hours.groupBy(*part, "_d").agg(F.max("_n").alias("_top"))
    unit = F.when(F.col("_top") <= size, "hour").when(F.col("_top") <= size * 15, "minute").otherwise("second")
    full = staged(full.withColumn("_unit", unit), "full_days")
    rows = _join_carry(df.withColumn("_d", day), full, [*part, "_d"], ["_unit"])
    cut = F.col("_d")
    for u in ("hour", "minute", "second"):
        cut = F.when(F.col("_unit") == u, F.date_trunc(u, F.col(ts))).otherwise(cut)
    return rows.withColumn(out, F.coalesce(cut, last)).drop("_d", "_unit")


# --- first / latest of a group ---------------------------------------------------------------


def top_per_group(df: DataFrame, keys: list[str], order, n: int = 1) -> DataFrame:
    """First n rows of each group in the given order."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def dedup_latest(df: DataFrame, keys: list[str], order) -> DataFrame:
    """One row per key: the first in `order` (newest(...) / oldest(...) fix the NULL rules)."""
    return top_per_group(df, keys, order, 1)


def dedup_priority(df: DataFrame, keys: list[str], rank: Column, ties=()) -> DataFrame:
    """One row per key: lowest source rank wins, then the tie order."""
    return top_per_group(df, keys, [rank.asc_nulls_last(), *_order(ties)], 1)


def nth_latest(df: DataFrame, value: Column | str, n: int, name: str = "value") -> DataFrame:
    """The n-th newest distinct value as a one-row table; empty when there are fewer."""
    col = F.col(value) if isinstance(value, str) else value
    top = df.select(col.alias(name)).distinct().orderBy(F.col(name).desc_nulls_last()).limit(n)
    return top.agg(F.min(name).alias(name), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == n).drop("_n")


def first_seen(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """Earliest row per key by partial aggregation; order columns must not be NULL."""
    pick = F.min_by(F.struct(*cols), F.struct(*order))
    return df.groupBy(*keys).agg(pick.alias("_first")).select(*keys, "_first.*")


# --- running forms ---------------------------------------------------------------------------


def running_sum(df: DataFrame, part: list[str], order, value: Column, out: str, chunk: Column | None = None) -> DataFrame:
    """Running total including the current row."""
    base = _with_chunk(df, chunk).withColumn("_v", value)
    inner = Window.partitionBy(*part, CHUNK).orderBy(*_order(order)).rowsBetween(UNBOUNDED, 0)
    rows = base.withColumn("_in", F.sum("_v").over(inner))
    if chunk is None:
        return rows.withColumn(out, F.col("_in")).drop("_in", "_v", CHUNK)
    carry = _carry(base.groupBy(*part, CHUNK).agg(F.sum("_v").alias("_t")), part, "_t", "_before", "sum")
    total = F.when(F.col("_in").isNull(), F.col("_before")).otherwise(F.col("_in") + F.coalesce("_before", F.lit(0)))
    return _join_carry(rows, carry, [*part, CHUNK], ["_before"]).withColumn(out, total).drop("_in", "_before", "_v", CHUNK)


def across_chunks(df: DataFrame, totals: DataFrame, part: list[str], chunk: str, local: str, out: str) -> DataFrame:
    """Running total of stored rows that carry the running total `local` inside their (group, chunk). `totals` has
    one row per (group, chunk) with the total of the chunk, also in `local`."""
    carry = _carry(totals.select(*part, F.col(chunk).alias(CHUNK), local), part, local, "_before", "sum", wide=True)
    joined = _join_carry(df.withColumn(CHUNK, F.col(chunk)), carry, [*part, CHUNK], ["_before"])
    return joined.withColumn(out, F.col(local) + F.coalesce("_before", F.lit(0))).drop("_before", CHUNK)


def group_by_marker(df: DataFrame, part: list[str], order, flag: Column, out: str = "group_no", chunk: Column | None = None) -> DataFrame:
    """Number the stretches opened by marker rows from 0; rows before the first marker get NULL."""
    marks = F.when(flag, F.lit(1)).otherwise(F.lit(0))
    counted = running_sum(df, part, order, marks, "_marks", chunk)
    return counted.withColumn(out, F.nullif(F.col("_marks") - 1, F.lit(-1))).drop("_marks")


def ffill(df: DataFrame, part: list[str], order, value: Column, out: str, chunk: Column | None = None) -> DataFrame:
    """Last known value at or before the row; nothing is invented before the first one."""
    base = _with_chunk(df, chunk).withColumn("_v", value)
    inner = Window.partitionBy(*part, CHUNK).orderBy(*_order(order)).rowsBetween(UNBOUNDED, 0)
    rows = base.withColumn("_in", F.last("_v", ignorenulls=True).over(inner))
    if chunk is None:
        return rows.withColumn(out, F.col("_in")).drop("_in", "_v", CHUNK)
    last_of_chunk = dedup_latest(base.filter(F.col("_v").isNotNull()), [*part, CHUNK], _reverse(order))
    spine = base.select(*part, CHUNK).distinct()
    tails = last_of_chunk.select(*[F.col(k).alias(f"_k_{k}") for k in [*part, CHUNK]], F.col("_v").alias("_tail"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in [*part, CHUNK]])
    carry = _carry(spine.join(tails, on, "left").drop(*[f"_k_{k}" for k in [*part, CHUNK]]), part, "_tail", "_before", "last")
    joined = _join_carry(rows, carry, [*part, CHUNK], ["_before"])
    return joined.withColumn(out, F.coalesce("_in", "_before")).drop("_in", "_before", "_v", CHUNK)


def _reverse(order) -> list[Column]:
    """Opposite direction of plain column names (ascending, NULLs last)."""
    for o in order:
        if not isinstance(o, str):
            raise TypeError("chunked forms take plain ascending column names as order")
    return [F.col(o).desc_nulls_first() for o in order]


def bfill(df: DataFrame, part: list[str], order, value: Column, out: str, chunk: Column | None = None) -> DataFrame:
    """Next known value at or after the row."""
    base = _with_chunk(df, chunk).withColumn("_v", value)
    inner = Window.partitionBy(*part, CHUNK).orderBy(*_order(order)).rowsBetween(0, Window.unboundedFollowing)
    rows = base.withColumn("_in", F.first("_v", ignorenulls=True).over(inner))
    if chunk is None:
        return rows.withColumn(out, F.col("_in")).drop("_in", "_v", CHUNK)
    head_rows = dedup_latest(base.filter(F.col("_v").isNotNull()), [*part, CHUNK], order)
    spine = base.select(*part, CHUNK).distinct()
    heads = head_rows.select(*[F.col(k).alias(f"_k_{k}") for k in [*part, CHUNK]], F.col("_v").alias("_head"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in [*part, CHUNK]])
    carry = _carry(spine.join(heads, on, "left").drop(*[f"_k_{k}" for k in [*part, CHUNK]]), part, "_head", "_after", "first")
    joined = _join_carry(rows, carry, [*part, CHUNK], ["_after"])
    return joined.withColumn(out, F.coalesce("_in", "_after")).drop("_in", "_after", "_v", CHUNK)


def subgroup_backfill(df: DataFrame, part: list[str], order, marked: Column, default: Column, out: str, chunk: Column | None = None) -> DataFrame:
    """Number taken from the next marked row of the group, else the default."""
    filled = bfill(df, part, order, marked, "_next", chunk)
    return filled.withColumn(out, F.coalesce(F.col("_next"), default)).drop("_next")


def rank_in_group(df: DataFrame, part: list[str], order: list[str], out: str = "rnk", chunk: Column | None = None) -> DataFrame:
    """RANK from 1. The chunk must be a function of the order columns, so ties share a chunk."""
    base = _with_chunk(df, chunk)
    inner = Window.partitionBy(*part, CHUNK).orderBy(*_order(order))
    rows = base.withColumn("_in", F.rank().over(inner))
    return _add_offsets(base, rows, part, out, chunk)


def row_number_in_group(df: DataFrame, part: list[str], order: list[str], out: str = "rn", chunk: Column | None = None, wide: bool = False) -> DataFrame:
    """ROW_NUMBER from 1 over a total order."""
    base = _with_chunk(df, chunk)
    inner = Window.partitionBy(*part, CHUNK).orderBy(*_order(order))
    return _add_offsets(base, base.withColumn("_in", F.row_number().over(inner)), part, out, chunk, wide)


def _add_offsets(base: DataFrame, rows: DataFrame, part: list[str], out: str, chunk, wide: bool = False) -> DataFrame:
    if chunk is None:
        return rows.withColumn(out, F.col("_in")).drop("_in", CHUNK)
    carry = _carry(base.groupBy(*part, CHUNK).agg(F.count(F.lit(1)).alias("_t")), part, "_t", "_before", "sum", wide)
    joined = _join_carry(rows, carry, [*part, CHUNK], ["_before"])
    return joined.withColumn(out, F.col("_in") + F.coalesce("_before", F.lit(0))).drop("_in", "_before", CHUNK)


def neighbour(df: DataFrame, part: list[str], order: list[str], value: str, out: str, ahead: bool = False, chunk: Column | None = None, wide: bool = False) -> DataFrame:
    """Value of the previous (or next) row. The value must be one of the order columns or depend on them."""
    base = _with_chunk(df, chunk)
    inner = Window.partitionBy(*part, CHUNK).orderBy(*_order(order))
    step = (F.lead if ahead else F.lag)(F.struct(F.col(value).alias("v"))).over(inner)
    rows = base.withColumn("_in", step)
    if chunk is None:
        return rows.withColumn(out, F.col("_in.v")).drop("_in", CHUNK)
    edge = (F.min_by if ahead else F.max_by)(F.struct(F.col(value).alias("v")), F.struct(*order))
    carry = _carry(base.groupBy(*part, CHUNK).agg(edge.alias("_edge")), part, "_edge", "_beside", "first" if ahead else "last", wide)
    joined = _join_carry(rows, carry, [*part, CHUNK], ["_beside"])
    return joined.withColumn(out, F.coalesce("_in", "_beside")["v"]).drop("_in", "_beside", CHUNK)


def lag_gap(df: DataFrame, part: list[str], col: str, chunk: Column | None = None) -> DataFrame:
    """Previous value and the distance to it."""
    with_prev = neighbour(df, part, [col], col, f"prev_{col}", chunk=chunk, wide=True)
    return with_prev.withColumn("gap", F.col(col) - F.col(f"prev_{col}"))


# Fixed value: the end of an interval that is still open.
OPEN_END = 10**18


def lead_interval(df: DataFrame, keys: list[str], start: str, end: str = "end_value", open_end: int = OPEN_END, chunk: Column | None = None) -> DataFrame:
    """Validity interval: up to one before the next start of the key, else open."""
    nxt = neighbour(df, keys, [start], start, "_next", ahead=True, chunk=chunk)
    return nxt.withColumn(end, F.coalesce(F.col("_next") - 1, F.lit(open_end))).drop("_next")


# --- group attributes on rows ----------------------------------------------------------------


def broadcast_agg(df: DataFrame, part: list[str], **aggs: Column) -> DataFrame:
    """Put aggregates of the group on each of its rows.

    Aggregate and join instead of a window: the aggregate combines map-side, and AQE may split the hot
    side of the join or broadcast the small one.
    """
    stats = df.groupBy(*part).agg(*[expr.alias(name) for name, expr in aggs.items()])
    return _join_carry(df, stats, part, list(aggs))


# --- worklists and trees ---------------------------------------------------------------------


def mod_batches(df: DataFrame, order: str, per_range: int, per_call: int) -> DataFrame:
    """Two-level batches of a worklist keyed by a bigint id: every `per_range` ids, every `per_call` ranges.

    The position comes from row_number over id buckets, so no task sees the whole list.
    """
    numbered = row_number_in_group(df.withColumn("_all", F.lit(0)), ["_all"], [order], "_pos", chunk=F.expr(f"`{order}` div 100000"), wide=True)
    range_no = F.expr(f"cast((_pos - 1) div {per_range} as bigint)")
    return numbered.withColumn("range_no", range_no).withColumn("call_no", F.expr(f"range_no div {per_call}")).drop("_pos", "_all")


def consecutive(df: DataFrame, order: list[str], out: str = "row_no") -> DataFrame:
    """Rows numbered 1, 2, … in the order of any columns, dense or sparse, numbers or text.

    Rows are cut into ranges of the order and written sorted; a row's number is its place in its range plus the rows
    of the ranges before it, of which there is one number for each. No task sees more than its range. Give enough
    columns to tell rows apart: rows with equal ones stay in one range, in any order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = staged(cut, "ranges").withColumns({"_range": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(2**33 - 1)})
    sizes = rows.groupBy("_range").agg((F.max("_place") + 1).alias("_n"))
    before = sizes.select(F.col("_range").alias("_r"), (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))  # a row for each range
    joined = rows.join(before, F.col("_range") == F.col("_r"))
    return joined.select(*df.columns, (F.col("_before") + F.col("_place") + 1).alias(out))


def tree_position(df: DataFrame, part: list[str], address: str, out: str = "trace_index", root: str = "ORIGIN", chunk: Column | None = None) -> DataFrame:
    """Depth-first position of nodes named by paths such as 0_1_2; the root comes first."""
    path = F.when(F.col(address) == root, F.array(F.lit(-1))).otherwise(
        F.transform(F.split(F.col(address), "_"), lambda p: p.cast("int"))
    )
    numbered = row_number_in_group(df.withColumn("_path", path), part, ["_path"], out, chunk=chunk)
    return numbered.withColumn(out, F.col(out) - 1).drop("_path")


def word_pairs(df: DataFrame, words: str) -> DataFrame:
    """Consecutive words as (pair_no, first_word, second_word); an odd last word has no partner."""
    pairs = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(words) / 2).cast("int") - 1),
        lambda i: F.struct(i.alias("pair_no"), F.get(F.col(words), i * 2).alias("first_word"), F.get(F.col(words), i * 2 + 1).alias("second_word")),
    )
    return df.filter(F.size(words) > 0).withColumn("_p", F.explode(pairs)).select(*[c for c in df.columns], "_p.*")
