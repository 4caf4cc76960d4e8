"""Windows, joins, merges and late data on small tables, against brute force."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.common import newest
from tidemark.operators import aggregates as agg, increments as inc, joins, quality as q, rows, sets, windows as w


def tuples(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows."""
    rnd = random.Random(7)
    data = [("hot" if i % 3 else f"k{i % 5}", i, rnd.choice(["a", "b", "c"]), rnd.randint(1, 9)) for i in range(400)]
    return spark.createDataFrame(data, "k string, pos int, kind string, v int")


CHUNK = "pos div 17"  # an expression needs a running session


def expr(text):
    return None if text is None else F.expr(text)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("chunk", [None, CHUNK])
def test_running_forms(skewed, chunk):
    data = sorted((r.k, r.pos, r.kind, r.v) for r in skewed.collect())
    total, group, last, prev, want = {}, {}, {}, {}, []
    for k, pos, kind, v in data:
        total[k] = total.get(k, 0) + v
        group[k] = group.get(k, -1) + (kind == "a")
        if kind == "b":
            last[k] = v
        want.append((k, pos, total[k], group[k] if group[k] >= 0 else None, last.get(k), prev.get(k)))
        prev[k] = pos
    out = w.running_sum(skewed, ["k"], ["pos"], F.col("v"), "total", expr(chunk))
    out = w.group_by_marker(out, ["k"], ["pos"], F.col("kind") == "a", "grp", expr(chunk))
    out = w.ffill(out, ["k"], ["pos"], F.when(F.col("kind") == "b", F.col("v")), "lastb", expr(chunk))
    out = w.neighbour(out, ["k"], ["pos"], "pos", "prev", chunk=expr(chunk))
    assert [tuple(r) for r in out.orderBy("k", "pos").select("k", "pos", "total", "grp", "lastb", "prev").collect()] == want


@pytest.mark.parametrize("chunk", [None, CHUNK])
def test_backward_forms(skewed, chunk):
    data = sorted(((r.k, r.pos, r.kind, r.v) for r in skewed.collect()), reverse=True)
    nxt, after, want = {}, {}, []
    for k, pos, kind, v in data:
        if kind == "c":
            nxt[k] = v
        want.append((k, pos, nxt.get(k, -1), after.get(k, 10**18 + 1) - 1))
        after[k] = pos
    out = w.subgroup_backfill(skewed, ["k"], ["pos"], F.when(F.col("kind") == "c", F.col("v")), F.lit(-1), "nxt", expr(chunk))
    out = w.lead_interval(out, ["k"], "pos", "end", chunk=expr(chunk))
    assert tuples(out, "k", "pos", "nxt", "end") == sorted(want)


@pytest.mark.parametrize("chunk", [None, "v div 3"])
def test_rank_with_ties(skewed, chunk):
    data = [(r.k, r.v) for r in skewed.collect()]
    want = sorted((k, v, 1 + sum(1 for k2, v2 in data if k2 == k and v2 < v)) for k, v in data)
    assert tuples(w.rank_in_group(skewed, ["k"], ["v"], "r", expr(chunk)), "k", "v", "r") == want


def test_top_rows_are_limited_before_the_shuffle(skewed):
    out = w.dedup_latest(skewed, ["k"], [newest("pos")])
    assert plan(out).count("WindowGroupLimit") == 2
    assert out.count() == skewed.select("k").distinct().count()


def test_dedup_is_idempotent(skewed):
    once = w.dedup_latest(skewed, ["k"], [newest("pos")])
    assert tuples(w.dedup_latest(once, ["k"], [newest("pos")]), "k", "pos") == tuples(once, "k", "pos")


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 5, 3), ("a", 1, 4)], "k string, pos int, v int")
    out = w.running_sum(df, ["k"], ["pos"], F.col("v"), "t", F.expr("pos div 2"))
    assert sorted((r.k or "", r.pos, r.t) for r in out.collect()) == [("", 1, 2), ("", 5, 5), ("a", 1, 4)]


def test_tree_position(spark):
    df = spark.createDataFrame([("t", a) for a in ["2", "10", "0_1", "ORIGIN", "0"]], "tx string, addr string")
    out = w.tree_position(df, ["tx"], "addr")
    assert [r.addr for r in out.orderBy("trace_index").collect()] == ["ORIGIN", "0", "0_1", "2", "10"]


def test_error_spread(spark):
    nodes = [("t", a, a == "0") for a in ["ORIGIN", "0", "0_1", "2", "10", "0_1_5", "00"]] + [("u", a, a == "ORIGIN") for a in ["ORIGIN", "1"]]
    df = spark.createDataFrame(nodes, "tx string, addr string, bad boolean")
    want = [("t", "0"), ("t", "0_1"), ("t", "0_1_5"), ("u", "1"), ("u", "ORIGIN")]
    for fn in (joins.inside_flagged, joins.inside_flagged_payload):
        out = fn(df, ["tx"], "addr", F.col("bad"), "failed")
        assert tuples(out.filter("failed"), "tx", "addr") == want


def test_flatten_tree_any_depth(spark):
    def deep(n):
        kids = f',"calls":[{deep(n - 1)},{{"type":"L{n}"}}]' if n else ""
        return f'{{"type":"T{n}"{kids}}}'

    df = spark.createDataFrame([("a", deep(7)), ("b", deep(1)), ("c", deep(0))], "tx string, p string")
    full = rows.flatten_tree(df, "p", "calls", {"type": "type"}, node="data", step=20)
    steps = rows.flatten_tree(df, "p", "calls", {"type": "type"}, node="data", step=2)
    assert tuples(full, "tx", "trace_address", "type", "data") == tuples(steps, "tx", "trace_address", "type", "data")
    assert full.count() == 8 + 7 + 3 + 1


def test_nearest_preceding(spark):
    df = spark.createDataFrame([("t", 3, "bus"), ("t", 9, "bus"), ("t", 5, "send"), ("t", 11, "send"), ("t", 1, "send")], "tx string, i int, kind string")
    out = joins.nearest_preceding(df, ["tx"], ["i"], F.col("kind") == "bus", F.col("kind") == "send", ["i"])
    assert tuples(out, "i", "prev_i") == [(5, 3), (11, 9)]


def test_in_interval(spark):
    facts = spark.createDataFrame([("a", x) for x in (1, 10, 19, 20, 500)] + [("b", 3)], "k string, x long")
    iv = spark.createDataFrame([("a", 10, 19, "v1"), ("a", 20, 10**18, "v2"), ("c", 0, 10**18, "v3")], "key string, lo long, hi long, v string")
    for width in (1, 7, 1000):
        out = joins.in_interval(facts, iv, {"k": "key"}, "x", "lo", "hi", width)
        assert tuples(out, "k", "x", "v") == [("a", 10, "v1"), ("a", 19, "v1"), ("a", 20, "v2"), ("a", 500, "v2")]


def test_contains_any(spark):
    df = spark.createDataFrame([("TokenSwapped",), ("swap",), ("Mint",), ("x",)], "n string")
    pats = spark.createDataFrame([("swap", "s"), ("token", "t"), ("mi", "m")], "p string, metric string")
    got = joins.contains_any(df, "n", pats, "p", carry=["metric"])
    assert tuples(got, "n", "metric") == [("Mint", "m"), ("TokenSwapped", "s"), ("TokenSwapped", "t"), ("swap", "s")]


def test_contains_any_odd_texts(spark):
    """An empty pattern, NULLs, and a text that grows when it is lowered."""
    df = spark.createDataFrame([("x\u0130\u0130ab",), ("",), (None,)], "n string")
    pats = spark.createDataFrame([("ab",), ("",), (None,), ("longer than any",)], "p string")
    assert tuples(joins.contains_any(df, "n", pats, "p"), "n", "p") == [("", ""), ("x\u0130\u0130ab", ""), ("x\u0130\u0130ab", "ab")]


def test_contains_any_never_sends_rows(spark, folder, monkeypatch):
    """Pieces of texts look as small as the texts. Few patterns are sent to them, many are met by a shuffle."""
    from tidemark.registry import QUERIES

    texts = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_name")
    words = spark.read.parquet(f"{folder}/orders.parquet").select(F.substring("o_orderpriority", 3, 3).alias("w")).distinct().unionByName(texts.select(F.regexp_extract("p_name", "([^ ]+)$", 1).alias("w")).distinct())
    few = joins.contains_any(texts, "p_name", words, "w")
    assert "BroadcastHashJoin" in plan(few) and "BuildRight" in plan(few)
    want = tuples(few, "p_partkey", "w")
    monkeypatch.setattr(joins, "MOST_SENT", 10)
    many = joins.contains_any(texts, "p_name", words, "w")
    assert "BroadcastHashJoin" not in plan(many)
    assert tuples(many, "p_partkey", "w") == want and want
    assert "BroadcastHashJoin" not in plan(QUERIES["op_join_ilike"](spark, folder))


def test_contains_any_without_patterns(spark):
    df = spark.createDataFrame([("a",)], "n string")
    assert joins.contains_any(df, "n", spark.createDataFrame([], "p string"), "p").count() == 0


def test_ranges_do_not_count_down(spark):
    df = spark.createDataFrame([(5, 0), (5, 2), (1, -3)], "lo long, n long")
    assert tuples(joins.int_range(df, F.col("lo"), F.col("n"), "v"), "v") == [(5,), (6,)]
    assert tuples(joins.pages(df, "n", 2), "page") == [(1,)]


def test_gap_report(spark):
    df = spark.createDataFrame([("c", 1), ("c", 2), ("c", 5)], "k string, id long")
    gaps = q.sequence_gaps(df, ["k"], "id")
    assert tuples(gaps, "prev_id", "id", "gap") == [(2, 5, 3)]
    assert tuples(joins.missing_between(gaps, "prev_id", "id"), "missing") == [(3,), (4,)]
    assert q.sequence_gaps(df.filter("id < 3"), ["k"], "id").count() == 0


def test_object_rules(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (1, "b", None), (2, "c", "z")], "g int, k string, v string")
    got = {r.g: r.j for r in agg.pivot_map(df, ["g"], "k", "v").collect()}
    assert got == {1: {"a": "y"}, 2: {"c": "z"}}


def test_ordered_arrays_in_parts(spark):
    df = spark.createDataFrame([("g", i, None if i == 3 else i * 10) for i in range(7)], "k string, i int, v int")
    out = agg.ordered_arrays(df, ["k"], ["i"], "v", "vs", size=4, chunk=F.expr("i div 2"))
    assert [(r.part_no, list(r.vs)) for r in out.orderBy("part_no").collect()] == [(0, [0, 10, 20, 40]), (1, [50, 60])]


def test_shares(spark):
    i = spark.createDataFrame([("a", 3), ("b", 1)], "u string, n int")
    o = spark.createDataFrame([("b", 3), ("c", 2)], "u string, n int")
    assert tuples(agg.share_in(i, o, ["u"], "n", "s", 1.0), "u", "s") == [("a", 1.0), ("b", 0.25), ("c", 0.0)]
    assert tuples(agg.share_in(i, o, ["u"], "n", "s", None), "u", "s") == [("a", 0.0), ("b", 0.25), ("c", 0.0)]


def test_trailing_days(spark):
    d0 = date(2024, 1, 1)
    daily = spark.createDataFrame([("u", d0 + timedelta(days=i), i) for i in range(10)], "u string, d date, n int")
    dates = spark.createDataFrame([(d0 + timedelta(days=i),) for i in (2, 9)] + [(None,)], "s date")
    daily = daily.union(spark.createDataFrame([("u", None, 5)], daily.schema))
    out = agg.trailing_days(daily, "d", dates, "s", 3).groupBy("s").agg(F.sum("n").alias("n"))
    assert tuples(out, "s", "n") == [(date(2024, 1, 3), 0 + 1 + 2), (date(2024, 1, 10), 7 + 8 + 9)]


def test_running_totals(spark):
    old = spark.createDataFrame([("a", 10, 5)], "k string, n long, b long")
    new = spark.createDataFrame([("a", 4, 3), ("b", 1, 9)], "k string, n long, b long")
    assert tuples(agg.merge_totals(old, new, ["k"], ["n"], ["b"]), "k", "n", "b") == [("a", 14, 5), ("b", 1, 9)]


# --- merges ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "old", "t0"), (2, "old", "t0")], "id long, v string, inserted string")


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame([(2, None, "t1"), (3, "new", "t1")], "id long, v string, inserted string")


def test_merge_keeps_columns_and_takes_nulls(target, batch):
    out = inc.merge_upsert(target, batch, ["id"], keep=["inserted"])
    assert sorted(tuple(r) for r in out.fillna("~").collect()) == [(1, "old", "t0"), (2, "~", "t0"), (3, "new", "t1")]
    again = inc.merge_upsert(out, batch, ["id"], keep=["inserted"])
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_merge_updates_listed_columns_only(target, batch):
    out = inc.merge_update_columns(target, batch, ["id"], ["inserted"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "old", "t0"), (2, "old", "t1"), (3, "new", "t1")]


def test_merge_appends_new_columns(target, spark):
    more = spark.createDataFrame([(2, "x", "extra")], "id long, v string, more string")
    out = {r.id: (r.v, r.inserted, r.more) for r in inc.merge_upsert(target, more, ["id"]).collect()}
    assert out == {1: ("old", "t0", None), 2: ("x", "t0", "extra")}


def test_delete_insert_on_a_coarse_key(spark):
    old = spark.createDataFrame([(5, "a"), (5, "b"), (5, "c"), (6, "d")], "block long, v string")
    new = spark.createDataFrame([(5, "z")], "block long, v string")
    assert tuples(inc.delete_insert(old, new, ["block"]), "block", "v") == [(5, "z"), (6, "d")]


def test_partitioned_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    import os
    import time

    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, "p1", "a"), (2, "p2", "b")], "id long, p string, v string")
    inc.write_partitions(base, path, "p")
    files = {f: os.path.getmtime(os.path.join(path, "p=p2", f)) for f in os.listdir(os.path.join(path, "p=p2"))}
    time.sleep(0.05)
    inc.upsert_partitions(spark, path, spark.createDataFrame([(1, "p1", "z"), (3, "p1", "n")], "id long, p string, v string"), ["id", "p"], "p")
    assert tuples(spark.read.parquet(path), "id", "v") == [(1, "z"), (2, "b"), (3, "n")]
    assert files == {f: os.path.getmtime(os.path.join(path, "p=p2", f)) for f in os.listdir(os.path.join(path, "p=p2"))}


def test_increments_in_any_split_equal_a_full_build(spark):
    t0 = datetime(2024, 1, 1)
    rnd = random.Random(3)
    data = [(i % 40, t0 + timedelta(minutes=i), rnd.random()) for i in range(200)]
    src = spark.createDataFrame(data, "id long, stamp timestamp_ntz, v double")
    full = w.dedup_latest(src, ["id"], [newest("stamp")])
    state = None
    for upto in (70, 71, 150, 200):
        seen = src.filter(F.col("stamp") < F.lit(t0 + timedelta(minutes=upto)))
        new = seen if state is None else inc.increment(seen, state, "stamp", timedelta(minutes=5))
        latest = w.dedup_latest(new, ["id"], [newest("stamp")])
        merged = latest if state is None else inc.merge_upsert(state, latest, ["id"])
        state = spark.createDataFrame(merged.collect(), full.schema)
    assert tuples(state, "id", "stamp", "v") == tuples(full, "id", "stamp", "v")


def test_increment_floor(spark):
    src = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 31)], "s timestamp_ntz")
    tgt = src.filter("s < timestamp_ntz '2024-01-05'")
    assert inc.increment(src, tgt, "s").count() == 27
    assert inc.increment(src, tgt, "s", floor_days=3, as_of=datetime(2024, 1, 30)).count() == 4
    assert inc.increment(src, src.limit(0), "s").count() == 30


def test_late_parent(spark):
    facts = spark.createDataFrame([("t1", 9)], "tx string, block long")
    none = spark.createDataFrame([], "block long, bt timestamp_ntz")
    there = spark.createDataFrame([(9, datetime(2024, 1, 1))], "block long, bt timestamp_ntz")
    run1 = inc.late_parent(None, facts, none, ["block"], ["tx"], "bt")
    assert run1.first()["bt"] == datetime(2099, 12, 31) and inc.settled(run1, "bt").count() == 0
    run2 = inc.merge_upsert(run1, inc.late_parent(run1, facts.limit(0), there, ["block"], ["tx"], "bt"), ["tx"])
    assert inc.settled(run2, "bt").first()["bt"] == datetime(2024, 1, 1)


def test_heal_only_what_improves(spark):
    stored = spark.createDataFrame([(1, "A", None), (2, "B", None), (3, "A", 7.0)], "id long, tok string, usd double")
    dim = spark.createDataFrame([("A", 2.0), ("B", None)], "tok string, price double")
    healed = inc.heal_nulls(stored, dim, ["tok"], {"usd": "price"})
    assert tuples(healed, "id", "usd") == [(1, 2.0)]
    merged = inc.merge_upsert(stored, healed, ["id"])
    assert inc.heal_nulls(merged, dim, ["tok"], {"usd": "price"}).count() == 0


def test_complete_days(spark):
    hours = [datetime(2024, 1, 1) + timedelta(hours=h) for h in range(24 + 23)]
    df = spark.createDataFrame([(x,) for x in hours], "ts timestamp_ntz")
    assert tuples(inc.complete_days(df, "ts"), "block_date") == [(date(2024, 1, 1),)]


def test_symmetric_diff_and_missing(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "x int")
    assert tuples(sets.symmetric_diff(a, b, ["x"]), "which_diff", "x") == [("in_actual_not_in_expected", 1), ("in_expected_not_in_actual", 3)]
    assert tuples(sets.missing(a.dropna(), b), "x") == [(1,)]


def test_quality_profile(spark):
    df = spark.createDataFrame([("0xab", 1), (None, 2), ("zz", 9)], "h string, n int")
    got = {r.check_name: r.failures for r in q.profile(df, ["h"], {"h": "0[xX][0-9a-fA-F]+"}, {"n": [1, 2]}).collect()}
    assert got == {"not_null:h": 1, "regex:h": 1, "in_set:n": 1}


def test_no_cartesian_products(spark, folder):
    from tidemark.registry import QUERIES

    for name in ("op_join_range", "op_join_or", "op_join_ilike_many", "op_join_theta_gap", "op_join_spine", "op_rolling_window_agg"):
        text = plan(QUERIES[name](spark, folder))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_two_levels_of_carry(spark):
    """One group with thousands of chunks, a third of the rows in a single chunk, gaps and a NULL chunk-free start."""
    ids = sorted({i * 37 for i in range(3000)} | set(range(40_000, 41_500)))
    df = spark.createDataFrame([("g", i) for i in ids], "g string, id long").repartition(5)
    chunk = F.expr("id div 10")
    gaps = w.lag_gap(df, ["g"], "id", chunk)
    assert tuples(gaps, "id", "prev_id") == [(b, a) for a, b in zip([None, *ids], ids)]
    ahead = w.neighbour(df, ["g"], ["id"], "id", "nxt", ahead=True, chunk=chunk, wide=True)
    assert tuples(ahead, "id", "nxt") == [(a, b) for a, b in zip(ids, [*ids[1:], None])]
    numbered = w.row_number_in_group(df, ["g"], ["id"], "n", chunk, wide=True)
    assert tuples(numbered, "id", "n") == [(x, k + 1) for k, x in enumerate(ids)]
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lag(") == 1


def test_stabbing_is_brute_force(spark):
    import random

    rnd = random.Random(4)
    ranges = [(k, rnd.choice([rnd.randrange(-600, 600), rnd.randrange(-10**12, 10**12)]), rnd.choice([0, 1, 2, 7, 8, 9, 63, 64, 65, rnd.randrange(2000), 10**rnd.randrange(6, 12)])) for k in ("a", "b") for _ in range(120)]
    ranges += [("a", 5, None), ("b", None, 4), ("a", 5, -3), ("c", 0, 100_000), ("a", -8, 16), ("a", -8, 16)]
    xs = {x for _, lo, n in ranges if lo is not None and n for x in (lo - 1, lo, lo + n - 1, lo + n, lo + n // 2)} | set(range(-70, 70))
    points = [(k, x) for k in ("a", "b", "c") for x in xs] + [("a", None), (None, 3), ("a", 3)]
    got = joins.stabbing(spark.createDataFrame(points, "k string, x long"), spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "i long, k string, lo long, n long"), ["k"], "x", "lo", "n")
    want = sorted((k, x, i) for k, x in points for i, (rk, lo, n) in enumerate(ranges) if k == rk and x is not None and lo is not None and n and lo <= x < lo + n)
    assert sorted((r.k, r.x, r.i) for r in got.collect()) == want
    assert joins.stabbing(spark.createDataFrame(points, "k string, x long"), spark.createDataFrame([], "i long, k string, lo long, n long"), ["k"], "x", "lo", "n").count() == 0


def test_long_ranges_become_few_blocks(spark):
    df = spark.createDataFrame([(3, 100_000), (1, 10**15)], "lo long, n long")
    sizes = [r[0] for r in df.select(F.size(joins._blocks(F.col("lo"), F.col("n")))).collect()]
    assert max(sizes) <= 14 * 18 and sizes[0] <= 14 * 6


def _leaves(v, path=""):
    if isinstance(v, dict) and v:
        for k, x in v.items():
            yield from _leaves(x, f"{path}['{k}']" if not k.replace("_", "").isalnum() else f"{path}.{k}" if path else k)
    elif isinstance(v, list) and v:
        for i, x in enumerate(v):
            yield from _leaves(x, f"{path}[{i}]")
    else:
        yield path, v


def test_json_leaves_at_any_depth(spark):
    import json

    deep = 1
    for k in range(25):
        deep = {f"k{k}": deep} if k % 2 else [deep, k]
    texts = [{"a": 1, "b": [True, None, "x\"y", [], {}], "c.d": {"e": 2.5}}, {"deep": deep}, [1, [2, [3]]], {}, []]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(texts)] + [(9, "no json"), (10, None), (11, "5")], "id long, t string")
    got = sorted((r.id, r.path, r.value) for r in rows.json_leaves(df, "t").collect() if r.value is not None)
    plain = lambda v: {True: "true", False: "false"}.get(v, str(v)) if isinstance(v, bool) else json.dumps(v) if v in ([], {}) else str(v)
    assert got == sorted((i, p, plain(v)) for i, t in enumerate(texts[:3]) for p, v in _leaves(t) if v is not None)
    metas = {"data": [{"result": {"block_metas": [{"h": 1}, {"h": 2}], "other": [{"h": 9}]}}, {"x": {"result": {"block_metas": [{"h": 3}]}}}], "else": {"result": {"block_metas": [{"h": 8}]}}}
    found = rows.json_walk(spark.createDataFrame([(1, json.dumps(metas))], "id long, t string"), "t", "data**.result.block_metas[*]")
    assert sorted((r.path, r["index"]) for r in found.collect()) == [("data[0].result.block_metas[0]", 0), ("data[0].result.block_metas[1]", 1), ("data[1].x.result.block_metas[0]", 0)]
    fields = rows.json_walk(spark.createDataFrame([(1, json.dumps(metas))], "id long, t string"), "t", "data[*].*.other[0].h")
    assert [r.path for r in fields.collect()] == ["data[0].result.other[0].h"]
    with pytest.raises(ValueError):
        rows.json_walk(df, "t", "a b")


def test_consecutive_numbers(spark):
    rnd = random.Random(5)
    keys = [f"{rnd.getrandbits(64):016x}" for _ in range(3000)] + ["same"] * 50 + ["0"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i long").repartition(5)
    got = sorted((r.no, r.k, r.i) for r in w.consecutive(df, ["k", "i"], "no").collect())
    assert got == [(n, k, i) for n, (k, i) in enumerate(sorted((k, i) for i, k in enumerate(keys)), start=1)]
    assert w.consecutive(df.limit(0), ["k"]).count() == 0
    sizes = [len(p) for p in w.consecutive(df, ["k", "i"])._jdf.inputFiles()]
    assert len(sizes) >= 3  # a file for each range


def test_time_chunks_follow_the_number_of_rows(spark):
    """One user holds a third of the rows, most of them in one hour; a null user and rows without a time."""
    df = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 300 = 1 then null else 'u' || id % 40 end as user",
        "case when id % 500 = 7 then null when id % 3 = 0 then timestamp_ntz '2024-01-02 10:00:00' + make_dt_interval(0, 0, 0, id) else timestamp_ntz '2024-01-01' + make_dt_interval(0, id div 30, 0, 0) end as ts", "id % 7 = 0 as mark")
    rows = w.time_chunks(df, ["user"], "ts", "span", size=50)
    assert rows.columns == [*df.columns, "span"]
    largest = {r.user: r.n for r in rows.filter("ts is not null").groupBy("user", "span").count().groupBy("user").agg(F.max("count").alias("n")).collect()}
    assert largest["hot"] <= 50 and max(n for u, n in largest.items() if u != "hot") <= 50
    assert rows.filter("user = 'u1'").select("span").distinct().count() < df.filter("user = 'u1'").count()
    part, order = ["user"], ["ts", "id"]
    got = w.ffill(w.group_by_marker(rows, part, order, F.col("mark"), "no", chunk=F.col("span")), part, order, F.when(F.col("mark"), F.col("id")), "last", chunk=F.col("span"))
    want = w.ffill(w.group_by_marker(df, part, order, F.col("mark"), "no"), part, order, F.when(F.col("mark"), F.col("id")), "last")
    assert tuples(got, "id", "no", "last") == tuples(want, "id", "no", "last")
    assert tuples(w.time_chunks(df, ["user"], "ts", "span", size=10**6).filter("user = 'hot' and ts is not null").select("span").distinct(), "span") == tuples(df.filter("user = 'hot' and ts is not null").selectExpr("date_trunc('day', ts) as span").distinct(), "span")
