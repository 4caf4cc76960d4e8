"""Structured Streaming over the events files, compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import newest
from ..streaming import streams as s
from .base import block_of, query

MARK_DELAY = "10 minutes"


def _landing(t) -> str:
    """Events as files that land one after the other, in event-time order."""
    path, _ = s.scratch(t.spark, "landing")
    ends = t.events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    step = (ends["hi"] - ends["lo"]) / 4
    for i in range(4):
        slice_ = F.col("ts") >= F.lit(ends["lo"] + i * step)
        if i < 3:
            slice_ = slice_ & (F.col("ts") < F.lit(ends["lo"] + (i + 1) * step))
        t.events.filter(slice_).write.mode("append").parquet(path)
    return path


def _stream(t, per_trigger: int = 1):
    """The event time as an instant: watermarks take no zoneless time."""
    raw = s.read_files(t.spark, _landing(t), t.events.schema, per_trigger=per_trigger)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _resent(t):
    """The landing events, then every seventh once more with another value: a fifth file set."""
    path = _landing(t)
    first = t.spark.read.schema(t.events.schema).parquet(path)
    again = first.filter(F.col("event_id") % 7 == 0).withColumn("value", F.col("value") + 1)
    both, _ = s.scratch(t.spark, "resent")
    first.withColumn("version", F.lit(1)).write.parquet(both)
    again.withColumn("version", F.lit(2)).write.mode("append").parquet(both)
    schema = t.spark.read.parquet(both).schema
    return s.read_files(t.spark, both, schema, per_trigger=1).withColumn("ts", F.col("ts").cast("timestamp"))


_RESENT = "select event_id, event_type, user_id, ts, case when event_id % 7 = 0 then value + 1 else value end as value from events"


@query("op_stream_upsert", f"""select event_id, event_type, value, strftime(ts, '%Y-%m-%d') as day from ({_RESENT})""")
def upsert(t):
    """Later files bring some keys again with another value."""
    table, check = s.scratch(t.spark, "upsert")
    rows = _resent(t).withColumn("day", F.to_date("ts"))
    s.stream_upsert(rows, table, ["event_id", "day"], [newest("version")], "day", check)
    return t.spark.read.parquet(table).select("event_id", "event_type", "value", "day")


@query("op_stream_dedup", f"""select user_id, strftime(ts, '%Y-%m-%d %H') as hour, max(event_id) as event_id, arg_max(value, event_id) as value from ({_RESENT}) group by 1, 2""")
def dedup(t):
    """The newest row of a user's hour: the largest event, in its last version, whichever file brings it."""
    table, check = s.scratch(t.spark, "dedup")
    rows = _resent(t).withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH")).withColumn("day", F.to_date("ts"))
    s.stream_latest(rows, table, ["user_id", "hour", "day"], [newest("event_id"), newest("version")], "day", check)
    return t.spark.read.parquet(table).select("user_id", "hour", "event_id", "value")


@query("op_stream_dedup_watermark", "select distinct user_id, strftime(ts, '%Y-%m-%d %H') as hour from events")
def dedup_watermark(t):
    table, check = s.scratch(t.spark, "dedup")
    rows = _stream(t, 100).withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH"))
    s.append_to(s.stream_dedup(rows, ["user_id", "hour"], "ts", "2 hours").select("user_id", "hour"), table, check)
    return t.spark.read.parquet(table)


_CLOSED = "(select date_trunc('millisecond', max(ts)) - interval 10 minutes as m from events)"


@query("op_stream_tumbling_hour", f"""select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour, event_type, count(*) as n from events
    where date_trunc('hour', ts) + interval 1 hour <= (select m from {_CLOSED}) group by 1, 2""")
def tumbling(t):
    table, check = s.scratch(t.spark, "hours")
    hours = s.tumbling_hours(_stream(t), "ts", MARK_DELAY, ["event_type"], n=F.count(F.lit(1)))
    s.append_to(hours, table, check)
    return t.spark.read.parquet(table)


@query("op_stream_sliding_days", f"""with daily as (select event_type, cast(ts as date) as d, count(*) as n from events where date_trunc('day', ts) + interval 1 day <= (select m from {_CLOSED}) group by 1, 2), dates as (select distinct d as score_date from daily)
    select event_type, strftime(score_date, '%Y-%m-%d') as score_date, cast(sum(n) as bigint) as n from daily join dates on d <= score_date and d > score_date - interval 7 days group by 1, 2""")
def sliding(t):
    from ..operators.aggregates import trailing_days
    table, check = s.scratch(t.spark, "days")
    s.append_to(s.daily_cells(_stream(t), "ts", MARK_DELAY, ["event_type"], n=F.count(F.lit(1))), table, check)
    daily = t.spark.read.parquet(table)
    spread = trailing_days(daily, "day", daily.select(F.col("day").alias("score_date")), "score_date", 7)
    return spread.groupBy("event_type", "score_date").agg(F.sum("n").alias("n"))


@query("op_session_marker", """select event_id, cast(nullif(sum(case when event_type = 'signup' then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) - 1, -1) as varchar) as session_no from events""")
def marker(t):
    """Three sets of files: later halves of odd days, the rest of some users, then all else with some rows again."""
    landing, _ = s.scratch(t.spark, "shuffled")
    early = (F.dayofmonth("ts") % 2 == 1) & (F.hour("ts") >= 12)
    for files in (early, ~early & (F.col("user_id") % 3 == 0), ~early & (F.col("user_id") % 3 != 0) | (F.col("event_id") % 7 == 0)):
        t.events.filter(files).coalesce(1).write.mode("append").parquet(landing)
    table, check = s.scratch(t.spark, "marker")
    rows = s.read_files(t.spark, landing, t.events.schema, per_trigger=1)
    s.stream_marker_groups(rows, table, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", F.date_trunc("hour", "ts"), F.to_date("ts"), check)
    return s.marker_groups(t.spark, table, ["user_id"], "session_no").select("event_id", F.col("session_no").cast("string").alias("session_no"))


@query("op_stream_late_parent", """select event_id, strftime(b.block_timestamp, '%Y-%m-%d %H:%M:%S') as block_timestamp from v_msgs m join v_blocks b on m.block_id = b.block_id""")
def late_parent(t):
    """Blocks land in two halves behind the messages; the last batch sees all of them."""
    table, check = s.scratch(t.spark, "late")
    blocks = t.blocks
    def parents(_spark, epoch):
        return blocks if epoch >= 3 else blocks.filter("block_id < 100")
    facts = _stream(t).withColumn("block_id", block_of("ts")).select("event_id", "block_id")
    s.batch_late_parent(facts, parents, table, ["block_id"], ["event_id"], "block_timestamp", check)
    return t.spark.read.parquet(f"{table}/settled").select("event_id", "block_timestamp")


@query("op_stream_join_parent", """with first as (select date_trunc('hour', ts) as h, min(ts) as block_timestamp from events group by 1)
    select event_id, strftime(block_timestamp, '%Y-%m-%d %H:%M:%S') as block_timestamp from events join first on h = date_trunc('hour', ts)""")
def join_parent(t):
    """Stream-stream form: messages wait in state for their block, at most two hours."""
    table, check = s.scratch(t.spark, "join")
    blocks = t.events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.min(F.col("ts").cast("timestamp")).alias("block_timestamp"))
    landed, _ = s.scratch(t.spark, "blocks")
    blocks.write.parquet(landed)
    parents = s.read_files(t.spark, landed, blocks.schema)
    facts = _stream(t, 100).withColumn("hour", F.date_trunc("hour", "ts")).select("event_id", "ts", "hour")
    s.append_to(s.stream_late_parent(facts, parents, ["hour"], "ts", "block_timestamp", "2 hours").select("event_id", "block_timestamp"), table, check)
    return t.spark.read.parquet(table)
