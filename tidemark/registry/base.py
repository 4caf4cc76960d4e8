"""Registry of queries over the given tables, each beside its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import discard, spread, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


class Tables:
    """The parquet tables of one folder and the chain-shaped views derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        #: Columns that the query reads of a stored table; a table that is not named here is stored whole.
        self.read: dict[str, set[str]] = {}

    def needed(self, name: str, made: DataFrame) -> DataFrame:
        """The columns that are read of a table."""
        return made.select(*[c for c in made.columns if c in self.read.get(name, made.columns)])

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table between two jobs of one query, written once: jobs hand over stored tables."""
        if name not in self._tables:
            self._tables[name] = staged(make(), name)
        return self._tables[name]

    def keep(self, name: str, made: DataFrame) -> DataFrame:
        """The same for a table that its maker stored."""
        self._tables[name] = made
        return made

    def view(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Rows made anew by each reader: payloads that are made row by row and read once or twice."""
        if name not in self._tables:
            self._tables[name] = make()
        return self._tables[name]

    def release(self, *names: str) -> None:
        """Remove stored tables that no frame still in use reads. One that is asked for again is made again."""
        for name in names:
            if name in self._tables:
                discard(self._tables.pop(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        raise AttributeError(name)

    @property
    def msgs(self) -> DataFrame:
        return self.events.select(
            F.concat(F.lit("T"), F.expr("cast(event_id div 10 as string)")).alias("tx_id"),
            (F.col("event_id") % 10).alias("msg_index"),
            F.col("event_type").alias("msg_type"),
            (F.col("event_type") == "click").alias("is_action"),
            (F.col("event_type") == "view").alias("is_module"),
            (F.col("event_type") != "error").alias("tx_succeeded"),
            block_of("ts").alias("block_id"),
            "ts", "user_id", "value", "event_id", "props",
        )

    @property
    def attrs(self) -> DataFrame:
        """One attribute per message."""
        coin = F.concat(F.get_json_object("props", "$.k"), F.lit("utok"))
        return self.msgs.select("*", F.col("msg_type").alias("attribute_key"), coin.alias("attribute_value"))

    @property
    def blocks(self) -> DataFrame:
        return self.msgs.groupBy("block_id").agg(
            F.min("ts").alias("block_timestamp"), F.count_distinct("tx_id").alias("tx_count"))

    @property
    def transfers(self) -> DataFrame:
        li, o = self.lineitem, self.orders
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("l_suppkey").alias("sender"), F.col("o_custkey").alias("receiver"),
            F.col("l_quantity").cast("bigint").alias("amount"), F.col("l_returnflag").alias("denom"),
            F.col("l_shipdate").alias("ts"), "l_orderkey", "l_linenumber", "l_partkey")

    @property
    def words(self) -> DataFrame:
        """Two 32-byte words per line: the part key and the quantity."""
        def w(c):
            return F.lpad(F.lower(F.hex(c)), 64, "0")
        return spread(self.lineitem).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            F.concat(F.lit("0x"), w(F.col("l_partkey")), w(F.col("l_quantity").cast("bigint"))).alias("data"))

    @property
    def prices_hourly(self) -> DataFrame:
        first = F.struct("ts", "event_id")
        return self.events.groupBy(F.col("event_type").alias("token"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
            F.min_by("value", first).alias("open"), F.max("value").alias("high"),
            F.min("value").alias("low"), F.max_by("value", first).alias("close"))

    @property
    def arrivals(self) -> DataFrame:
        """Events with an arrival stamp that lags by up to six hours."""
        return self.events.withColumn("_inserted_timestamp", F.expr("ts + make_dt_interval(0, cast(event_id % 7 as int))"))

    @property
    def versions(self) -> DataFrame:
        """Order intervals per customer, by order day number."""
        return self.orders.select("o_custkey", "o_orderkey", day_no("o_orderdate").alias("start_day"))


def block_of(ts: str):
    return F.expr(f"cast((unix_seconds(cast({ts} as timestamp)) - 1704067200) div 3600 as bigint)")


def day_no(ts: str):
    return F.datediff(F.col(ts), F.lit("1992-01-01").cast("date")).cast("bigint")


# The same views for the oracle.
VIEWS = {
    "v_msgs": """select 'T' || (event_id // 10) as tx_id, event_id % 10 as msg_index, event_type as msg_type,
        event_type = 'click' as is_action, event_type = 'view' as is_module, event_type <> 'error' as tx_succeeded,
        cast(floor((epoch(ts) - 1704067200) / 3600) as bigint) as block_id, ts, user_id, value, event_id, props from events""",
    "v_attrs": """select *, msg_type as attribute_key, json_extract_string(props, '$.k') || 'utok' as attribute_value from v_msgs""",
    "v_blocks": """select block_id, min(ts) as block_timestamp, count(distinct tx_id) as tx_count from v_msgs group by 1""",
    "v_transfers": """select l_suppkey as sender, o_custkey as receiver, cast(l_quantity as bigint) as amount, l_returnflag as denom,
        l_shipdate as ts, l_orderkey, l_linenumber, l_partkey from lineitem join orders on l_orderkey = o_orderkey""",
    "v_words": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, '0x' || lpad(lower(to_hex(l_partkey)), 64, '0')
        || lpad(lower(to_hex(cast(l_quantity as bigint))), 64, '0') as data from lineitem""",
    "v_prices": """select event_type as token, date_trunc('hour', ts) as hour, arg_min(value, (ts, event_id)) as open, max(value) as high,
        min(value) as low, arg_max(value, (ts, event_id)) as close from events group by 1, 2""",
    "v_arrival": """select *, ts + to_hours(cast(event_id % 7 as int)) as _inserted_timestamp from events""",
    "v_versions": """select o_custkey, o_orderkey, date_diff('day', date '1992-01-01', cast(o_orderdate as date)) as start_day from orders""",
}


def _needed(sql: str) -> list[str]:
    need: list[str] = []
    def visit(text):
        for v in VIEWS:
            if v in text and v not in need:
                visit(VIEWS[v])
                if v not in need:
                    need.append(v)
    visit(sql)
    return need


def with_views(sql: str) -> str:
    ctes = ",\n".join(f"{v} as ({VIEWS[v]})" for v in _needed(sql))
    if not ctes:
        return sql
    body = sql.strip()
    return f"with {ctes},\n{body[5:]}" if body.lower().startswith("with ") else f"with {ctes}\n{body}"


def plain(df: DataFrame) -> DataFrame:
    """Column types that compare alike in both engines: times, dates, lists and big decimals as text."""
    out = []
    for name, typ in df.dtypes:
        c = F.col(f"`{name}`")
        if typ.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif typ == "date":
            c = c.cast("string")
        elif typ.startswith("array"):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
        elif typ.startswith("map"):
            c = F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
        elif typ.startswith("decimal"):
            c = c.cast("string") if typ.endswith(",0)") else c.cast("double")
        out.append(c.alias(name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register fn(Tables) → DataFrame under a name, with the SQL that must give the same rows."""

    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Tables(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return wrap
