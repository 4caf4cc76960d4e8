"""What the jobs leave on disk while they run."""

import time

from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import increments as inc
from tidemark.plans.evm import core, dex
from tidemark.registry import buses, evm, interfaces, markets, scoring
from tidemark.registry.base import Tables
from tidemark.session import staged


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_staged_leaves_no_shuffle(spark):
    before = shuffle_files(spark)
    out = staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s")), "no_shuffle")
    for _ in range(20):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.5)
    assert shuffle_files(spark) <= before
    assert out.agg(F.sum("s")).first()[0] == 499500
    assert all(f.endswith(".zstd.parquet") for f in out.inputFiles())


def test_chain_keeps_only_what_is_read(spark, folder):
    t = Tables(spark, folder)
    evm.q_created(t)
    stored = {n for n in t._tables if not n.startswith("raw_")}
    assert stored == {"lines", "traces"}


def test_released_tables_are_made_again(spark, folder):
    t = Tables(spark, folder)
    n = evm.receipts(t).count()
    t.release("receipts")
    assert evm.receipts(t).count() == n > 0


def test_calls_meet_only_their_transaction(spark):
    """Calls are sent to their transaction once, and joined with nothing but it."""
    nodes = spark.createDataFrame([(1, "0xa", a, p, "{}") for a, p in (("ORIGIN", None), ("0", "ORIGIN"), ("1", "ORIGIN"), ("0_0", "0"), ("10", "ORIGIN"))], "block_number long, tx_hash string, trace_address string, parent_trace_address string, trace_json string")
    placed = core.order_traces(nodes)
    assert sorted((r["trace_index"], r["trace_address"], r["sub_traces"]) for r in placed.collect()) == [(0, "ORIGIN", 3), (1, "0", 1), (2, "0_0", 0), (3, "1", 0), (4, "10", 0)]
    assert "Join" not in placed._jdf.queryExecution().optimizedPlan().toString()


def test_receipts_lie_by_place_only(spark):
    """Payloads meet the few hashes of several blocks; they are not sent by hash."""
    rows = [(b, 1, '{"transactionHash":"%s","transactionIndex":"0x%d"}' % (h, i), "2024-01-01") for b, i, h in ((7, 0, "0xa"), (8, 0, "0xa"), (7, 1, "0xb"))]
    raw = spark.createDataFrame(rows, "block_number long, partition_key long, data string, _inserted_timestamp string")
    out = core.latest_receipts(raw)
    assert sorted((r["block_number"], r["tx_hash"]) for r in out.collect()) == [(7, "0xb"), (8, "0xa")]
    assert "moved_receipts" in " ".join(out.inputFiles())


def test_riders_are_read_in_steps(spark, folder):
    """Words are cut once a row, however many fields are read from them."""
    plan = buses.q_riders(Tables(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert plan.count("regexp_extract(") <= 6


def test_swaps_are_stored_between_lookups(spark, folder):
    """The last job sends swaps for one lookup only; the logs behind them are gone."""
    t = Tables(spark, folder)
    out = markets.q_complete(t)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 1
    assert not {"swap_logs", "lines"} & set(t._tables)
    assert out.count() > 0


def test_interface_versions_are_sent_once(spark, folder):
    """Both choices and the block ranges find the rows where one exchange put them; lines are stored without hashes."""
    t = Tables(spark, folder)
    out = interfaces.q_complete(t)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    executed = out._jdf.queryExecution().executedPlan().toString()
    last = executed[:executed.index("Union")]
    assert plan.count("Window ") >= 2 and last.count("Exchange") == 1
    assert "tx_hash" not in t._tables["call_lines"].columns


def test_scores_store_what_they_read(spark, folder):
    other = scoring.chain(Tables(spark, folder))
    for name, df in zip(("transactions", "logs", "traces"), scoring.chain_tables(other)):
        assert df.columns == scoring.READ[name] and df.count() > 0
    assert not {"blocks", "receipts", "latest_transactions"} & set(other._tables)


def test_heal_stores_only_what_it_reads(spark, folder):
    """The swaps behind the stored ones are gone, and addresses that healing does not read were never stored."""
    t = Tables(spark, folder)
    before = set(session._written)
    assert markets.q_heal(t).count() > 0
    new = [p.rsplit("/", 1)[-1] for p in session._written if p not in before]
    assert sum(n.startswith("swaps-") for n in new) == 1 and not any(n.startswith("swaps_of_protocol") for n in new)
    assert not {"sender", "tx_to", "origin_from_address", "_log_id"} & set(t._tables["stored_swaps"].columns)


def test_swaps_are_healed_in_parts(spark, folder, monkeypatch):
    """No step of the swaps gets many more rows at a time than a part holds, and the parts give what the whole gives."""
    whole = sorted(map(str, markets.q_heal(Tables(spark, folder)).collect()))
    got = {"newest_swaps": [], "enrich_swaps": []}

    def spy(name):
        real = getattr(dex, name)

        def run(*args, **kw):
            sources = args[:3] if name == "newest_swaps" else args[:1]
            got[name].append(sum(df.count() for df in sources))
            return real(*args, **kw)

        monkeypatch.setattr(dex, name, run)

    for name in got:
        spy(name)
    monkeypatch.setattr(dex, "PART", 4000)
    assert sorted(map(str, markets.q_heal(Tables(spark, folder)).collect())) == whole
    assert all(max(n) < 1.25 * 4000 for n in got.values())
    assert sum(got["newest_swaps"]) == len(whole) < sum(got["enrich_swaps"]) <= 2 * len(whole)


def test_ranges_hold_every_row_once(spark):
    """Nulls and equal values included."""
    rows = [(i, v) for i, v in enumerate([None] * 7 + [5] * 60 + list(range(100)))]
    df = spark.createDataFrame(rows, "id int, v long")
    parts = [[r["id"] for r in df.filter(c).collect()] for c in inc.ranges(df, "v", 40)]
    assert len(parts) > 2 and sorted(sum(parts, [])) == list(range(len(rows)))
    assert all(len({i in p for i in range(7, 67)}) == 1 for p in parts)
    for some, n in ((df.filter("v is null"), 7), (df.filter("false"), 0)):
        assert [some.filter(c).count() for c in inc.ranges(some, "v", 3)] == [n]


def test_payloads_are_made_once_a_row(spark, folder):
    """A filter on a payload, or on what is read from it, does not make and read the payload a second time."""
    t = Tables(spark, folder)
    for raw, col in ((evm.raw_receipts(t), "data"), (evm.raw_transactions(t), "data"), (evm.raw_traces(t), "data")):
        read = core._variant(raw.filter(F.col(col).isNotNull()), col).select(core._text("hash").alias("h")).filter("h is not null")
        plan = read._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("StructsToJsonEvaluator") == 1 and plan.count("parseJson") == 1 and plan.count("sha2(") == 1


def test_chain_stores_what_the_query_reads(spark, folder):
    t = Tables(spark, folder)
    out = evm.q_logs(t)
    assert set(t._tables["logs"].columns) == set(out.columns) and "data" not in out.columns
    assert "tx_hash" not in t._tables["lines"].columns and "tx_hash" in evm.lines(t).columns


def test_bridges_work_in_parts(spark, folder, monkeypatch):
    """In parts of 2500 lines the queries give what they give at once, and no part's tables stay."""
    from tidemark.registry import QUERIES

    names = ("bridge_bus_passengers", "bridge_bus_riders", "bridge_messenger_sends", "bridge_heal_messenger_sends", "bridge_packet_sends", "bridge_activity_all_sources", "bridge_complete_activity", "bridge_ez_activity", "bridge_heal_activity", "dex_swaps_v3")
    whole = {n: sorted(map(str, QUERIES[n](spark, folder).collect())) for n in names}
    monkeypatch.setattr(evm, "PART", 2500)
    for n in names:
        before = set(session._written)
        assert sorted(map(str, QUERIES[n](spark, folder).collect())) == whole[n], n
        left = {p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in set(session._written) - before}
        assert not left & {"lines_of_part", "bus_logs", "bus_packets", "bus_riders", "departures"}, n


def test_decoded_maps_are_built_once(spark, folder):
    """Dropping logs without parameters does not build their maps a second time."""
    out = core.decoded_logs(evm.decoded(Tables(spark, folder)))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert out.count() > 0
