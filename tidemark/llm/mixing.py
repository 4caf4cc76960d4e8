"""Mixing sources to target weights by weighted fair queueing.

Each source queues its documents in shuffled order, as often as its target asks. An entry's virtual finish time
is the source's words up to and with it, divided by the source's target; entries leave in the order of that time
until the total budget is used. Running sums go in two levels (bucket totals, then rows of a bucket), so neither
a hot source nor the global order meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a bucket or slot, on average: one window task holds them.
ROWS = 2000
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """source, source_size → source, source_size, place, weight, target.

    Sources in code point order, null last, weigh `weights`, repeating. The budget is `share` of all sizes, dealt
    by weight; a target stops at `most` times the source's size, and what is above is dealt again to the others.
    That ends at one level L with target = min(most * size, weight * L); L follows from the sources in order of
    size / weight. One row per source is all that this reads.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    t = sizes.withColumn("place", place).withColumn("weight", weight).withColumn("full", F.col("source_size") * most)
    order = W.orderBy(F.col("full") / F.col("weight"), "place")
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    t = t.withColumn("left", F.sum("source_size").over(W.partitionBy()) * share - (F.sum("full").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("full")))
    t = t.withColumn("level", F.col("left") / F.sum("weight").over(rest))
    t = t.withColumn("level", F.first(F.when(F.col("full") / F.col("weight") >= F.col("level"), F.col("level")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.least(F.col("full").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.col("full").cast("double")))
    return t.select("source", "source_size", "place", "weight", target.alias("target"))


def _keyed(df: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """What orders a row: doc_id, source, size, turn (its place in the shuffle) and same (its text)."""
    text = F.col(f"`{text_col}`")
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.concat(F.lit("no id: "), F.coalesce(text, F.lit(""))))
    return {"doc_id": F.col(f"`{id_col}`"), "source": F.col(f"`{source_col}`"), "size": word_count(text), "turn": F.md5(key.cast("binary")), "same": F.xxhash64(text)}


def _sequence(df: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: float, most: int) -> tuple[DataFrame, Column]:
    """All entries, `most` for each row, with `upto_here` (words of all entries up to and with it), and whether an
    entry is taken. No texts are carried: a row is its id, source, size and the hash of its text.

    Rows are read and counted once. Buckets cut a source's shuffled order, slots the global order; both grow in
    number with the rows, and neither changes the order.
    """
    docs = staged(df.select(*[c.alias(name) for name, c in _keyed(df, id_col, text_col, source_col).items()]), "mix_rows")
    parts = max(1, -(-docs.count() // ROWS))
    docs = docs.withColumn("bucket", F.floor(F.conv(F.substring("turn", 1, 8), 16, 10).cast("bigint") * parts / 2**32))
    per_bucket = docs.groupBy("source", "bucket").agg(F.sum("size").alias("here"))
    per_bucket = per_bucket.withColumn("before", F.sum("here").over(W.partitionBy("source").orderBy("bucket")) - F.col("here"))
    goal = targets(per_bucket.groupBy("source").agg(F.sum("here").alias("source_size")), weights, share, most)
    lane = per_bucket.join(goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "here")
    lane = staged(lane.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "before", "source_size", "place", "target"), "mix_lanes")
    rows = docs.join(lane, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))).drop("_source", "_bucket")
    order = W.partitionBy("place", "bucket").orderBy("turn", "size", "same")
    rows = rows.withColumn("at", F.row_number().over(order)).withColumn("upto", F.col("before") + F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))

    def dealt(rows: DataFrame) -> DataFrame:
        entries = rows.withColumn("lap", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        finish = (F.col("upto") + F.col("lap") * F.col("source_size")) / F.when(F.col("target") > 0, F.col("target"))
        entries = entries.withColumn("finish", F.coalesce(finish, F.lit(0.0)))
        fine = parts * most
        slot = F.when(F.col("finish") < 2, F.floor(F.col("finish") * fine)).otherwise(2 * fine + F.floor(F.log2(F.col("finish") / 2) * 64))
        return entries.withColumn("slot", slot.cast("bigint"))

    per_slot = dealt(rows).groupBy("slot").agg(F.sum("size").alias("here"))
    per_slot = per_slot.select(F.col("slot").alias("_slot"), (F.sum("here").over(W.orderBy("slot")) - F.col("here")).alias("earlier"), (F.sum("here").over(W.partitionBy()) / most * share).alias("budget"))
    line = W.partitionBy("slot").orderBy("finish", "place", "lap", "turn", "size", "same", "at").rowsBetween(W.unboundedPreceding, W.currentRow)
    entries = dealt(rows).join(per_slot, F.col("slot") == F.col("_slot"))
    entries = entries.withColumn("upto_here", F.col("earlier") + F.sum("size").over(line))
    return entries, F.col("upto_here") <= F.col("budget")


def mixed(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """The mix itself: a row for each entry taken, repeats included, to be read in the order of `word_end`, then `lap`.

    All columns of `df`, then lap (0 for the first time), size, source_size, target, taken (the entry's words),
    finish (its virtual finish time) and word_end (words of the mix up to and with it). An input column with one of
    these names is left out. Empty documents are entries without words and not taken.
    """
    entries, taken = _sequence(df, id_col, text_col, source_col, weights, share, most)
    names = ["lap", "size", "source_size", "target", "taken", "finish", "word_end"]
    one = F.md5(F.concat_ws("|", F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("is "), F.col("source").cast("string"))), "turn", F.col("same").cast("string")).cast("binary"))
    kept = entries.filter(taken & (F.col("size") > 0)).withColumn("key", one)
    kept = kept.withColumn("copy", F.col("at") - F.min("at").over(W.partitionBy("place", "bucket", "key")))
    kept = kept.select("key", "copy", F.struct(F.col("lap").cast("int").alias("lap"), "size", "source_size", "target", F.col("size").alias("taken"), "finish", F.col("upto_here").cast("bigint").alias("word_end")).alias("entry"))
    # The texts move once: by the key that numbers rows of equal id, source and text, and that entries are joined on.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in _keyed(df, id_col, text_col, source_col).items()])
    rows = rows.filter("size > 0").select("row", one.alias("key"))
    rows = rows.withColumn("copy", F.row_number().over(W.partitionBy("key").orderBy(F.xxhash64(F.to_json("row")))) - 1)
    joined = rows.join(kept, ["key", "copy"])
    return joined.select(*[F.col("row")[c].alias(c) for c in df.columns if c not in names], *[F.col("entry")[n].alias(n) for n in names])


def mix(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """One row for each input row: doc_id, source, size, source_size, target, taken (words, repeats counted).

    An entry is taken whole or not at all, a document `most` times at most, empty ones never (taken 0). Rows that
    repeat are documents of their own. The order is that of md5(id), then size and the text's hash; so reruns
    agree. An empty table gives no row; a row without an id is shuffled by its text.
    """
    entries, taken = _sequence(df, id_col, text_col, source_col, weights, share, most)
    key = ["place", "bucket", "at"]
    return entries.groupBy(*key).agg(
        *[F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target")],
        F.sum(F.when(taken, F.col("size")).otherwise(0)).cast("bigint").alias("taken")).drop(*key)
