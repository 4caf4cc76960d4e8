"""Contract-side jobs on hand-made rows."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import worklists as wl
from tidemark.plans.evm import abis, bridge, bridge_values as B, core, dex, dex_values as D, replaced, scores, scores_values as S, values as V

T0 = datetime(2024, 1, 1, 5)
STAMP = "_inserted_timestamp"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def w(n):
    return "%064x" % (n % 2**256)


def addr(n):
    return "0x%040x" % n


@pytest.fixture(scope="module")
def logs(spark):
    """Event logs from (tx, index, contract, topics, data)."""
    def make(*events, block=10, ok=True):
        out = []
        for tx, i, contract, topics, data in events:
            t = [*topics, None, None, None, None][:4]
            out.append((block, T0, tx, 0, i, contract, [x for x in t if x], *t, data, False, "0xfrom", "0xto", "0xsig", ok, f"{tx}-{i}", T0))
        return spark.createDataFrame(out, """block_number long, block_timestamp timestamp_ntz, tx_hash string, tx_position long, event_index long, contract_address string, topics array<string>, topic_0 string, topic_1 string, topic_2 string,
            topic_3 string, data string, event_removed boolean, origin_from_address string, origin_to_address string, origin_function_signature string, tx_succeeded boolean, fact_event_logs_id string, modified_timestamp timestamp_ntz""")
    return make


@pytest.fixture(scope="module")
def calls(spark):
    """Call facts from dicts with defaults."""
    def make(*dicts):
        base = dict(block_number=10, block_timestamp=T0, tx_hash="0xt", tx_position=0, trace_index=0, trace_address="ORIGIN", type="CALL", from_address="0xa", to_address="0xb", input="0x12345678", value=0.0, value_precise="0", value_precise_raw="0",
                    trace_succeeded=True, tx_succeeded=True, trace_status="SUCCESS", origin_from_address="0xfrom", origin_to_address="0xto", origin_function_signature="0xsig", modified_timestamp=T0)
        schema = """block_number long, block_timestamp timestamp_ntz, tx_hash string, tx_position long, trace_index long, trace_address string, type string, from_address string, to_address string, input string, value double, value_precise string,
            value_precise_raw string, trace_succeeded boolean, tx_succeeded boolean, trace_status string, origin_from_address string, origin_to_address string, origin_function_signature string, modified_timestamp timestamp_ntz"""
        return spark.createDataFrame([tuple({**base, **d}.values()) for d in dicts], schema)
    return make


# --- core -----------------------------------------------------------------------------------------


def test_receipts_must_win_on_both_keys(spark):
    def r(block, tx, pos):
        return (block, block, json.dumps({"transactionHash": tx, "transactionIndex": hex(pos)}), T0)

    raw = spark.createDataFrame([r(7, "0xa", 0), r(8, "0xa", 0), r(7, "0xb", 1)], f"block_number long, partition_key long, data string, {STAMP} timestamp_ntz")
    assert rows(core.latest_receipts(raw), "tx_hash", "block_number") == [("0xa", 8), ("0xb", 7)]


def test_confirmed_blocks(spark):
    raw = spark.createDataFrame([('{"BLOCK_NUMBER": 5}', json.dumps({"result": {"hash": "h", "transactions": ["0xa", "0xb"]}}), T0), ('{"BLOCK_NUMBER": 6}', json.dumps({"result": {"hash": "i", "transactions": ["0xb"]}}), T0)], f"value string, data string, {STAMP} timestamp_ntz")
    assert rows(core.confirmed_blocks(raw), "tx_hash", "block_number", "block_hash") == [("0xa", 5, "h"), ("0xb", 6, "i")]


def test_traces_in_order_with_errors(spark):
    leaf = lambda t, **k: {"type": t, "value": "0x0", "from": "0xf", "to": "0xt", **k}
    kids = [leaf("A", error="bad", calls=[leaf("B"), leaf("C")])] + [leaf(f"K{i}") for i in range(1, 11)]
    tree = leaf("CALL", calls=kids, gas="0x10")
    raw = spark.createDataFrame([(1, 1, '{"array_index": 0}', json.dumps({"txHash": "0xt", "result": tree}), T0)], f"block_number long, partition_key long, value string, data string, {STAMP} timestamp_ntz")
    txs = spark.createDataFrame([(1, "0xt", T0, "0xsig", "0xf", "0xt", 3, True)], "block_number long, tx_hash string, block_timestamp timestamp_ntz, origin_function_signature string, from_address string, to_address string, tx_position long, tx_succeeded boolean")
    out = core.fact_traces(core.traces(raw), txs)
    got = [(r.trace_address, r.type, r.sub_traces, r.trace_succeeded) for r in out.orderBy("trace_index").collect()]
    assert got[:5] == [("ORIGIN", "CALL", 11, True), ("0", "A", 2, False), ("0_0", "B", 0, False), ("0_1", "C", 0, False), ("1", "K1", 0, True)]
    assert got[-1][:2] == ("10", "K10") and len(got) == 14


def test_contract_reads_and_dim(spark, calls):
    def text(s):
        return "0x" + w(32) + w(len(s)) + s.encode().hex().ljust(64, "0")

    reads = spark.createDataFrame([("0xC", V.READ_NAME, text("Coin"), T0), ("0xC", V.READ_SYMBOL, text("CN"), T0), ("0xC", V.READ_DECIMALS, "0x" + w(18), T0), ("0xD", V.READ_DECIMALS, "0x" + w(12345), T0), ("0xD", V.READ_NAME, "0x", T0)],
                                  f"contract_address string, function_sig string, read_result string, {STAMP} timestamp_ntz")
    data = core.contract_reads(reads)
    assert rows(data, "contract_address", "token_name", "token_symbol", "token_decimals") == [("0xC", "Coin", "CN", 18), ("0xD", None, None, None)]
    made = core.created_contracts(calls(dict(type="CREATE2", to_address="0xc"), dict(type="CREATE", to_address="0xe", input="0x"), dict(type="CREATE", to_address="0xf")))
    dim = core.dim_contracts(made, data)
    assert rows(dim, "address", "symbol", "decimals") == [("0xc", "CN", 18), ("0xf", None, None)]
    assert {r.address: r.modified_timestamp for r in dim.collect()}["0xf"] is None  # null-strict


def test_relevant_contracts_add_up(spark, logs, calls):
    first = core.relevant_contracts(logs(("t", 0, "0xc", ["x"], "0x")), calls(dict(to_address="0xc")))
    assert rows(first, "contract_address", "total_event_count", "total_call_count") == [("0xc", 1, 1)]
    later = T0 + timedelta(hours=1)
    new_logs = logs(("t", 1, "0xc", ["x"], "0x"), ("t", 2, "0xc", ["x"], "0x")).withColumn("modified_timestamp", F.lit(later))
    again = core.relevant_contracts(new_logs, calls(dict(to_address="0xz")), first)
    assert rows(again, "contract_address", "total_event_count", "total_call_count", "total_interaction_count") == [("0xc", 3, 1, 4)]


def test_token_transfers_and_heal(spark, logs):
    wrapped = V.WRAPPED_NATIVE
    data = "0x" + w(2500)
    ev = logs(("t", 0, "0xtok", [V.TRANSFER, "0x" + w(1), "0x" + w(2)], data), ("t", 1, wrapped, [V.TRANSFER, "0x" + w(1), "0x" + w(2)], data), ("t", 2, "0xnft", [V.TRANSFER, "0x" + w(1), "0x" + w(2), "0x" + w(3)], "0x"))
    dims = spark.createDataFrame([("0xtok", "T", "Tok", 3), (wrapped, "W", "Wrapped", 2)], "address string, symbol string, name string, decimals int")
    price = spark.createDataFrame([(T0, "coin", 2.0, True, True)], "hour timestamp_ntz, token_address string, price double, is_native boolean, is_verified boolean")
    out = core.token_transfers(ev, dims, price)
    assert rows(out, "event_index", "amount_precise", "amount_usd", "token_is_verified") == [(0, "2.5", None, False), (1, "25", 50.0, True)]
    more = spark.createDataFrame([(T0, "0xtok", 4.0, False, True)], price.schema)
    healed = core.heal_token_transfers(out, dims, price.unionByName(more))
    assert rows(healed, "event_index", "amount_usd", "token_is_verified") == [(0, 10.0, True)]
    assert core.heal_token_transfers(healed, dims, price.unionByName(more)).count() == 0


def test_nft_transfers(logs, spark):
    single = "0x" + w(9) + w(2)
    batch = "0x" + w(64) + w(160) + w(2) + w(7) + w(8) + w(2) + w(70) + w(80)
    ev = logs(("t", 0, "0xn", [V.TRANSFER, "0x" + w(0), "0x" + w(2), "0x" + w(5)], "0x"), ("t", 1, "0xn", [V.TRANSFER_SINGLE, "0x" + w(1), "0x" + w(2), "0x" + w(3)], single), ("t", 2, "0xn", [V.TRANSFER_BATCH, "0x" + w(1), "0x" + w(2), "0x" + w(3)], batch))
    dims = spark.createDataFrame([("0xn", "Name")], "address string, name string")
    out = core.nft_transfers(ev, dims)
    assert rows(out, "event_index", "intra_event_index", "token_id", "quantity", "is_mint", "to_address") == [
        (0, 1, "5", "1", True, addr(2)), (1, 1, "9", "2", False, addr(3)), (2, 1, "7", "70", False, addr(3)), (2, 2, "8", "80", False, addr(3))]
    assert core.heal_nft_names(out.withColumn("name", F.lit(None).cast("string")), dims).count() == 4


def test_decoded_logs(spark):
    body = json.dumps({"name": "E", "address": "0xC", "data": [{"name": "a", "value": "1"}, {"name": "", "value": "2"}, {"name": "n", "value": None}, {"name": "a", "value": "3"}]})
    raw = spark.createDataFrame([(1, "0xt-4", body, T0), (1, "0xt-5", "[]", T0)], f"block_number long, id string, data string, {STAMP} timestamp_ntz")
    got = core.decoded_logs(raw).collect()
    assert [(r.tx_hash, r.event_index, r.contract_address, r.decoded_flat) for r in got] == [("0xt", 4, "0xc", {"a": "3", "anonymous_1": "2"})]


def test_labels_drop_deleted(spark):
    shared = spark.createDataFrame([("0x1", "a", False), ("0x2", "b", True), ("cosmos1", "c", False)], "address string, labels_combined_id string, _is_deleted boolean")
    stored = core.labels(shared.withColumn("_is_deleted", F.lit(False)))
    assert rows(core.labels(shared, stored), "address") == [("0x1",)]


# --- interfaces -----------------------------------------------------------------------------------

ABI = json.dumps([
    {"type": "event", "name": "Swap", "inputs": [{"name": "a", "type": "address"}, {"name": "p", "type": "tuple[]", "components": [{"name": "x", "type": "uint256"}, {"name": "y", "type": "tuple", "components": [{"name": "z", "type": "bool"}]}]}]},
    {"type": "event", "name": "Empty", "inputs": []},
    {"type": "function", "name": "pay", "inputs": [{"name": "", "type": "uint256"}], "outputs": [{"name": "", "type": "bool"}]},
])
SIGNATURE = "Swap(address,(uint256,(bool))[])"


def dictionary(spark):
    return spark.createDataFrame([(SIGNATURE, "0xswap"), ("pay(uint256)", "0xdeadbeef" + "0" * 56)], "signature string, topic string")


def test_signatures(spark):
    abi = spark.createDataFrame([("0xc", ABI, T0)], f"contract_address string, data string, {STAMP} timestamp_ntz")
    flat = abis.flat_event_abis(abi, dictionary(spark))
    assert rows(flat, "event_name", "simple_event_name", "event_signature") == [("Swap", SIGNATURE, "0xswap")]
    fn = abis.flat_function_abis(abi, dictionary(spark)).first()
    assert (fn.simple_function_name, fn.inputs[0].name, fn.outputs[0].name, fn.inputs_type) == ("pay(uint256)", "input_1", "output_1", ["uint256"])


def test_abi_precedence(spark):
    responses = spark.createDataFrame([("0x1", json.dumps({"message": "OK", "result": ABI}), T0), ("0x2", json.dumps({"message": "NOTOK", "result": "x"}), T0)], f"contract_address string, data string, {STAMP} timestamp_ntz")
    user = spark.createDataFrame([("0x1", "[]", "bob", T0 - timedelta(days=1), "h")], f"contract_address string, abi string, discord_username string, {STAMP} timestamp_ntz, abi_hash string")
    verified = abis.verified_abis(responses, user)
    assert rows(verified, "contract_address", "abi_source") == [("0x1", "etherscan")]
    created = spark.createDataFrame([("0x1", "code", 1), ("0x3", "code", 2), ("0x4", "other", 3)], "created_contract_address string, created_contract_input string, block_number long")
    by_code = abis.bytecode_abis(created, verified)
    assert rows(by_code, "contract_address") == [("0x3",)]
    best = abis.abis(abis.override_abis(spark), verified, by_code, created)
    assert rows(best, "contract_address", "abi_source", "bytecode") == [("0x1", "etherscan", "code"), ("0x3", "bytecode_matched", "code")]


def nested(depth):
    """A parameter list whose first tuple nests `depth` deep, with an array suffix here and there."""
    part = {"type": "uint8", "name": "x"}
    text = "uint8"
    for k in range(depth):
        suffix = "[]" if k % 3 == 0 else "[2]" if k % 5 == 0 else ""
        part = {"type": "tuple" + suffix, "name": "t", "components": [part, {"type": "address", "name": "a"}]}
        text = f"({text},address){suffix}"
    return json.dumps([part, {"type": "bytes", "name": "b"}]), f"{text},bytes"


def test_tuples_of_any_depth(spark):
    cases = [nested(d) for d in (0, 1, 2, 7, 20)] + [("[]", ""), (json.dumps([{"type": "tuple", "components": []}, {"type": "tuple[]", "components": [{"type": "bool"}]}]), "(),(bool)[]"), ("not json", "")]
    df = spark.createDataFrame([(f"f{i}", inputs) for i, (inputs, _) in enumerate(cases * 2)] + [("none", None)], "name string, inputs string")
    got = {r.name: r.s for r in abis.with_signature(df, "s").collect()}
    assert got == {**{f"f{i}": f"f{i}({text})" for i, (_, text) in enumerate(cases * 2)}, "none": "none()"}


def test_signatures_are_spelled_in_the_row(spark):
    """Nothing is joined or sent, so nothing can reach the driver, however many interfaces there are."""
    df = spark.createDataFrame([("f", nested(3)[0])], "name string, inputs string")
    plan = abis.with_signature(df, "s")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    odd = [("[{}, 5, null, {\"type\": \"tuple\"}, {\"type\": \"tuple[2]\", \"components\": 7}, {\"type\": \"bool\"}]", "f((),()[2],bool)"), ("{\"type\": \"bool\"}", "f()"), ("", "f()")]
    got = {r.inputs: r.s for r in abis.with_signature(spark.createDataFrame([("f", i) for i, _ in odd], "name string, inputs string"), "s").collect()}
    assert got == dict(odd)


def test_submissions_are_counted_by_signature(spark, calls, logs):
    abi = json.dumps([{"type": "event", "name": n, "inputs": [{"type": "uint256", "name": "x"}]} for n in ("A", "B", "C")] + [{"type": "function", "name": "f", "inputs": [], "outputs": []}])
    words = spark.createDataFrame([("A(uint256)", "0xa"), ("B(uint256)", "0xb"), ("C(uint256)", "0xc"), ("f()", "0x12345678aa")], "signature string, topic string")
    sent = spark.createDataFrame([(c, abi) for c in ("0xme", "0ximpl", "0xidle")], f"contract_address string, data string").withColumn(STAMP, F.lit(T0))
    px = spark.createDataFrame([("0xp1", "0ximpl"), ("0xp2", "0ximpl"), ("0xme", "0xother")], "contract_address string, proxy_address string")
    seen = logs(("t", 0, "0xme", ["0xa"], "0x"), ("t", 1, "0xme", ["0xa"], "0x"), ("t", 2, "0xp1", ["0xb"], "0x"), ("t", 3, "0xp2", ["0xc"], "0x"), ("t", 4, "0ximpl", ["0xa"], "0x"), ("t", 5, "0xidle", ["0xz"], "0x"))
    called = calls(dict(type="DELEGATECALL", from_address="0xp2", to_address="0ximpl", input="0x12345678ffff"), dict(to_address="0xidle", input="0x12"), dict(to_address="0xp1", input="0xffffffff"))
    assert rows(abis.submission_matches(sent, words, px, called, seen), "contract_address", "n_signatures", "n_seen") == [("0xidle", 4, 0), ("0ximpl", 4, 3), ("0xme", 4, 1)]


def test_intervals_and_user_abis(spark, calls, logs):
    created = spark.createDataFrame([("0xp", "c", 5), ("0xi1", "c", 1), ("0xi2", "c", 2)], "created_contract_address string, created_contract_input string, block_number long")
    delegate = dict(type="DELEGATECALL", from_address="0xp")
    t = calls(dict(delegate, to_address="0xi1", block_number=10), dict(delegate, to_address="0xi1", block_number=12), dict(delegate, to_address="0xi2", block_number=20))
    px = abis.proxies(t, created)
    assert rows(px, "contract_address", "proxy_address", "start_block") == [("0xp", "0xi1", 10), ("0xp", "0xi2", 20)]
    abi = spark.createDataFrame([("0xi1", ABI, T0), ("0xi2", ABI, T0), ("0xz", ABI, T0)], f"contract_address string, data string, {STAMP} timestamp_ntz")
    out = abis.complete_event_abis(abis.flat_event_abis(abi, dictionary(spark)), px)
    assert rows(out, "parent_contract_address", "start_block", "end_block") == [("0xi1", 0, 10**18), ("0xi2", 0, 10**18), ("0xp", 10, 19), ("0xp", 20, 10**18), ("0xz", 0, 10**18)]
    sent = spark.createDataFrame([("0xi1", ABI, "u", T0, False), ("0xz", ABI, "u", T0, False), ("0xq", ABI, "u", T0, False)], f"contract_address string, abi string, discord_username string, {STAMP} timestamp_ntz, duplicate_abi boolean")
    ok = abis.user_verified_abis(sent, dictionary(spark), px, calls(dict(to_address="0xz", input="0xdeadbeef00")), logs(("t", 0, "0xp", ["0xswap"], "0x")))
    assert rows(ok, "contract_address") == [("0xi1",), ("0xz",)]
    busy = logs(("t", 0, "0xp", ["0xswap"], "0x"), ("t", 1, "0xp", ["0xother"], "0x"), ("t", 2, "0xz", ["0xswap"], "0x"), block=15)
    done = spark.createDataFrame([(15, "t-2")], "block_number long, _log_id string")
    assert rows(wl.logs_to_decode(busy, out, done, width=7), "_log_id") == [("t-0",)]


def test_replaced_blocks_rewrite_their_ranges_only(spark, tmp_path):
    """After a replacement every table is that of a full rebuild; other ranges keep their files."""
    import glob
    import os

    def table(blocks):
        return spark.createDataFrame([(b, f"{h}-{i}") for b, h, n in blocks for i in range(n)], "block_number long, id string")

    before = [(b, f"h{b}", 3) for b in range(0, 60)] + [(75, "h75", 2), (95, "h95", 1)]
    after = [(b, f"h{b}", 3) if b not in (12, 17, 41, 75) else (b, f"new{b}", {12: 5, 17: 0, 41: 1, 75: 0}[b]) for b, _, _ in before[:-1]] + [(95, "h95", 1)]
    heads = lambda blocks: spark.createDataFrame([(b, h) for b, h, _ in blocks], "block_number long, block_hash string")
    paths = {n: f"{tmp_path}/{n}" for n in ("logs", "blocks")}
    replaced.store(table(before), paths["logs"], 10)
    replaced.store(heads(before), paths["blocks"], 10)
    files = lambda: {p: os.path.getmtime(p) for p in glob.glob(f"{tmp_path}/*/*/*.parquet")}
    old = files()
    told = heads(after).unionByName(heads([(999, "x", 0)]))
    changed = replaced.replaced_blocks(replaced.stored(spark, paths["blocks"]), told)
    assert rows(changed, "block_number") == [(12,), (17,), (41,), (75,)]
    replaced.replace(spark, paths, changed, {"logs": table(after), "blocks": heads(after)}, 10)
    assert rows(replaced.stored(spark, paths["logs"]), "block_number", "id") == rows(table(after), "block_number", "id")
    assert rows(replaced.stored(spark, paths["blocks"]), "block_number", "block_hash") == rows(heads(after), "block_number", "block_hash")
    kept = {p for p, at in files().items() if old.get(p) == at}
    assert {p.split("block_range=")[1].split("/")[0] for p in kept if "/logs/" in p} == {"0", "2", "3", "5", "9"}
    assert not os.path.exists(f"{paths['logs']}/block_range=7")
    assert replaced.replaced_blocks(replaced.stored(spark, paths["blocks"]), told).count() == 0
    again = files()
    replaced.replace(spark, paths, replaced.replaced_blocks(replaced.stored(spark, paths["blocks"]), told), {"logs": table(after), "blocks": heads(after)}, 10)
    assert files() == again


# --- exchanges ------------------------------------------------------------------------------------


def test_v2_direction(logs):
    pairs = logs(("t", 0, D.PAIR_FACTORIES[0][0], [D.PAIR_CREATED, "0x" + w(1), "0x" + w(2)], "0x" + w(99) + w(1)))
    swap = logs(("t", 1, addr(99), [D.SWAP_V2, "0x" + w(5), "0x" + w(6)], "0x" + w(4) + w(1) + w(3) + w(0)))
    out = dex.swaps_v2(swap, dex.pairs_v2(pairs))
    assert rows(out, "amount_in_unadj", "token_in", "amount_out_unadj", "token_out", "platform") == [(1, addr(2), 3, addr(1), "uniswap-v2")]


def test_vault_pools(spark, logs):
    vault = D.VAULTS[0][0]
    pool_id = addr(77) + "0" * 24
    ev = logs(("t", 0, vault, [D.POOL_REGISTERED, pool_id], "0x"), ("t", 5, vault, [D.VAULT_SWAP, pool_id, "0x" + w(1), "0x" + w(2)], "0x" + w(10) + w(20)))
    decoded = logs(("t", 1, vault, [D.TOKENS_REGISTERED, pool_id], "0x")).withColumn("decoded_log", F.create_map(F.lit("poolId"), F.lit(pool_id), F.lit("tokens"), F.lit(json.dumps([addr(1), addr(2), addr(3)])), F.lit("assetManagers"), F.lit("[]")))
    text = lambda s: "0x" + w(32) + w(len(s)) + s.encode().hex().ljust(64, "0")
    reads = spark.createDataFrame([(addr(77), V.READ_SYMBOL, text("BPT"), T0), (addr(77), V.READ_DECIMALS, "0x" + w(18), T0), (addr(78), V.READ_SYMBOL, text("X"), T0)], f"pool_address string, function_sig string, read_result string, {STAMP} timestamp_ntz")
    pools = dex.vault_pools(ev, decoded, reads)
    assert rows(pools, "pool_address", "pool_symbol", "pool_name", "token2", "token3") == [(addr(77), "BPT", None, addr(3), None)]
    assert rows(dex.vault_swaps(ev, pools), "contract_address", "amount_in_unadj", "token_out", "pool_name") == [(addr(77), 10, addr(2), "BPT")]
    none = dex.pairs_v2(ev.limit(0))
    dims = spark.createDataFrame([(addr(1), "A", 6)], "address string, symbol string, decimals int")
    named = dex.complete_pools(none, dex.pools_v3(ev.limit(0)), pools, dims)
    short = lambda n: addr(n)[:5] + "..." + addr(n)[38:]
    assert rows(named, "pool_name") == [(f"A-{short(2)}-{short(3)}",)]
    healed = dex.heal_pools(named, dims.unionByName(spark.createDataFrame([(addr(2), "B", 6)], dims.schema)))
    assert rows(healed, "pool_name") == [(f"A-B-{short(3)}",)]
    assert [r.batch_no for r in dex.pool_read_batches(dex.registered_pools(ev)).collect()] == [1, 1, 1]


# --- bridges --------------------------------------------------------------------------------------


def test_routed_sends(spark, logs, calls):
    chains = spark.createDataFrame([("faraway", "14894068710063348487")], "chain_name string, chain_selector string")
    ramps = bridge.on_ramps(logs(("t", 0, B.ROUTERS[0][0], [B.ON_RAMP_SET, "0x" + w(14894068710063348487)], "0x" + w(0xABC))), chains)
    assert rows(ramps, "on_ramp_address", "chain_name") == [(addr(0xABC), "faraway")]
    # words: selector, offset, fee, sender, then from word 4: receiver at 5 words on, data, tokens at 7 words on
    body = [14894068710063348487, 0, 9, 1, 5 * 32, 0, 7 * 32, 0, 0, 32, 0xBEEF, 2, 0x11, 100, 0x22, 200]
    call = calls(dict(to_address=addr(0xABC), input=B.FORWARD_FROM_ROUTER + "".join(map(w, body)), trace_index=3))
    out = bridge.routed_sends(call, ramps)
    assert rows(out, "grouping", "token_address", "amount_unadj", "receiver", "destination_chain") == [(0, addr(0x11), 100, addr(0xBEEF), "faraway"), (1, addr(0x22), 200, addr(0xBEEF), "faraway")]


def packet(src, sender, dst, receiver, guid, to, kind=""):
    head = "01" + "0" * 16 + "%08x" % src + w(sender) + "%08x" % dst + w(receiver) + guid
    return "0x" + head + (kind + w(to) if kind else w(to))


def test_messenger(spark, logs):
    m = int(B.MESSENGERS[0][0], 16)
    endpoint = B.ENDPOINTS[0][0]
    guid, other = "a" * 64, "b" * 64

    def decoded(*events):
        rows_ = [(tx, i, body) for tx, i, body in events]
        base = logs(*[(tx, i, endpoint, ["x"], "0x") for tx, i, _ in rows_])
        bodies = spark.createDataFrame([(tx, i, b) for tx, i, b in rows_], "tx_hash string, event_index long, body string")
        return base.join(bodies, ["tx_hash", "event_index"]).withColumn("event_name", F.lit("PacketSent")).withColumn("decoded_log", F.create_map(F.lit("encodedPayload"), F.col("body")))

    chains = spark.createDataFrame([("Home", "10"), ("Far", "20")], "chain string, eid string")
    packets = bridge.packets(decoded(("t1", 9, packet(10, m, 20, 5, guid, 0xD1, "000000")), ("t2", 9, packet(10, 77, 20, 5, other, 0xD2)), ("t3", 9, packet(10, m, 20, 5, "c" * 64, 0xD3, "000000"))), chains)
    assert rows(packets, "tx_hash", "src_chain", "dst_chain", "sender_contract_address") == [("t1", "home", "far", addr(m)), ("t2", "home", "far", addr(77)), ("t3", "home", "far", addr(m))]
    asset = spark.createDataFrame([("sei", "USDC", "1", "0xusdc", addr(0x51)), ("other", "X", "1", "0xx", addr(0x51))], "chain string, asset string, id string, address string, oftaddress string")
    sent = lambda tx, i, c, g, amount: (tx, i, c, [B.OFT_SENT, "0x" + g, "0x" + w(0xF)], "0x" + w(20) + w(amount))
    passenger = "%04x" % 1 + w(0xEE) + "0" * 16 + "01"

    def rode(tx, i, ticket):
        data = "0x" + w(20) + w(ticket) + w(96) + w(32) + w(len(passenger) // 2) + passenger
        return (tx, i, B.MESSENGERS[0][0], [B.BUS_RODE], data)

    ev = logs(sent("t1", 5, addr(0x51), guid, 900), sent("t2", 6, addr(0x99), other, 70), rode("t0", 3, 41), sent("t0", 5, addr(0x51), B.NO_GUID, 500), rode("t0", 9, 42), sent("t0", 11, addr(0x51), B.NO_GUID, 600),
              ("t3", 2, B.MESSENGERS[0][0], [B.BUS_DRIVEN], "0x" + w(20) + w(41) + w(2) + "c" * 64))
    direct = bridge.direct_sends(ev, packets, asset)
    assert rows(direct, "tx_hash", "to_address", "asset_name", "amount_sent") == [("t1", addr(0xD1), "USDC", 900)]
    reads = bridge.token_reads(spark.createDataFrame([(addr(0x99), "0x" + w(0))], "contract_address string, result string"))
    other_sends = bridge.packet_sends(ev, packets, reads)
    assert rows(other_sends, "tx_hash", "receiver", "token_address", "amount_unadj") == [("t2", addr(0xD2), V.WRAPPED_NATIVE, 70)]
    riders = bridge.bus_riders(ev, asset)
    assert rows(riders, "oft_sent_index", "bus_rode_index", "ticket_id", "amount_sent", "asset_name", "dst_receiver_address") == [(11, 9, 42, 600, "USDC", addr(0xEE)), (5, 3, 41, 500, "USDC", addr(0xEE))]
    driven = bridge.buses_driven(ev, riders, packets)
    assert rows(driven, "tx_hash", "ticket_id", "amount_sent") == [("t3", 41, 500), ("t3", 42, 600)]
    crowd = spark.createDataFrame([(20, 41 + 7 * k, "0xad", 1, "USDC", "0xusdc", "0xf", "0xe", 1) for k in range(2000)] + [(20, 100_041, "0xad", 1, "USDC", "0xusdc", "0xf", "0xe", 1), (21, 50, "0xad", 1, "USDC", "0xusdc", "0xf", "0xe", 1)],
                                  "dst_id long, ticket_id long, stargate_adapter_address string, asset_id long, asset_name string, asset_address string, from_address string, dst_receiver_address string, amount_sent int")
    big = bridge.buses_driven(logs(("t3", 2, B.MESSENGERS[0][0], [B.BUS_DRIVEN], "0x" + w(20) + w(41) + w(100_000) + "c" * 64)), crowd, packets)
    assert big.count() == 2000 and "sequence(start_ticket_id" not in big._jdf.queryExecution().optimizedPlan().toString()
    both = bridge.messenger_sends(driven, direct, asset)
    assert rows(both, "_log_id", "token_address", "token_symbol", "destination_chain") == [("t1-5", "0xusdc", "USDC", "far"), ("t3-2-41", "0xusdc", "USDC", "far"), ("t3-2-42", "0xusdc", "USDC", "far")]
    broken = both.withColumn("token_address", F.lit(None).cast("string"))
    assert bridge.heal_messenger_sends(broken, asset, chains).count() == 3
    assert bridge.heal_messenger_sends(both, asset, chains).count() == 0
    dims = spark.createDataFrame([("0xusdc", "USDC", 2)], "address string, symbol string, decimals int")
    price = spark.createDataFrame([(T0, "0xusdc", 2.0, True)], "hour timestamp_ntz, token_address string, price double, is_verified boolean")
    names = spark.createDataFrame([("20", "Far")], "chain_id string, chain string")
    full = bridge.complete_activity([both, other_sends], dims, price, names)
    assert rows(full, "_id", "amount", "amount_usd") == [("t1-5", 9.0, 18.0), ("t2-6", 70.0, None), ("t3-2-41", 5.0, 10.0), ("t3-2-42", 6.0, 12.0)]


# --- scores ---------------------------------------------------------------------------------------


def test_transfer_metrics_and_daily_features(spark, logs, calls):
    txs = spark.createDataFrame([(10, "t", "0xfrom", "0xapp", "0xa9059cbb00", True, T0)], "block_number long, tx_hash string, from_address string, to_address string, input_data string, tx_succeeded boolean, block_timestamp timestamp_ntz")
    heads = scores.user_transactions(txs)
    assert rows(heads, "complex_tx", "to_address_is_contract") == [(False, True)]
    ev = logs(("t", 0, "0xtok", [V.TRANSFER, "0x" + w(0xB), "0x" + w(0xC)], "0x" + w(10**18)), ("t", 1, "0xnft", [V.TRANSFER, "0x" + w(0), "0x" + w(0xC), "0x" + w(5)], "0x"), ("t", 2, "0xapp", ["0xs"], "0x"))
    decoded = spark.createDataFrame([(10, "t", 2, "Deposited", T0)], "block_number long, tx_hash string, event_index long, event_name string, block_timestamp timestamp_ntz")
    sigs = spark.createDataFrame([("0xs", "Other")], "event_sig string, event_name string")
    events = scores.named_events(ev, decoded, sigs, heads)
    assert rows(events.filter("event_index = 2"), "event_name") == [("Deposited",)]
    dims = spark.createDataFrame([("0xtok", None)], "address string, decimals int")
    labels = spark.createDataFrame([(addr(0xB), "bridge", "pool")], "address string, label_type string, label_subtype string")
    verified = spark.createDataFrame([("0xtok", True)], "token_address string, is_verified boolean")
    ranks = spark.createDataFrame([(m, i) for i, m in enumerate(S.METRICS)], "metric string, metric_rank int")
    moves = scores.transfer_actions(events, calls(dict(tx_hash="t", value=2.0)), heads, dims, labels, verified, ranks)
    assert rows(moves, "transfer_type", "value", "metric_name") == [("erc20_transfer", 1.0, S.BRIDGE_IN), ("erc721_transfer", None, S.NFT_MINTS), ("native_transfer", 2.0, None)]
    none = spark.createDataFrame([], "event_sig string, metric string")
    names = spark.createDataFrame([("deposit", S.LP_ADDS)], "event_name string, metric string")
    wrapped = spark.createDataFrame([], "wrapped_asset_address string, blockchain string")
    acts = scores.actions(moves, scores.interaction_actions(events, labels, none, names, wrapped, ranks), heads)
    daily = {r.user_address: r for r in scores.daily_features(acts, spark.createDataFrame([("0xnft",)], "address string")).collect()}
    user, receiver = daily["0xfrom"], daily[addr(0xC)]
    assert (user.n_lp_adds, user.n_txn, user.complex_tx, user.contract_addresses) == (1, 1, 0, ["0xapp"])
    assert (receiver.n_bridge_in, receiver.n_nft_mints, receiver.n_txn, receiver.net_token_accumulate, receiver.net_nft_accumulate) == (1, 1, 1, 1.0, 0.0)
    assert receiver.nft_collection_addresses == ["0xnft"] and receiver.gaming_nft_collection_addresses == ["0xnft"]


def test_trailing_counts_leave_no_address_out(spark):
    """A user's day with more addresses of each kind than the daily lists hold; the next day repeats some of them."""
    n, day = S.CAP + 5, date(2024, 1, 1)
    cols = "block_date date, block_timestamp timestamp_ntz, tx_hash string, index long, action_type string, metric_name string, origin_from_address string, origin_to_address string, token_from_address string, token_to_address string, contract_address string, complex_tx boolean, to_address_is_contract boolean"
    acts = []
    for d, count in ((0, n), (1, 10)):
        at = (day + timedelta(days=d), T0 + timedelta(days=d))
        for i in range(count):
            acts.append((*at, f"t{d}-{i}", -1, "tx", None, "0xuser", f"0xc{i}", None, None, None, False, True))
            acts.append((*at, f"t{d}-{i}", 0, "contract_interaction", S.STAKE_TX, "0xuser", f"0xc{i}", None, None, f"0xv{i}", False, False))
            acts.append((*at, f"t{d}-{i}", 1, "erc721_transfer", None, "0xuser", f"0xc{i}", "0xuser", "0xother", f"0xn{i}", False, False))
    acts = spark.createDataFrame(acts, cols)
    daily = scores.daily_counts(acts)
    assert daily.drop("blockchain").columns == [c for c in scores.daily_features(acts).columns if c in daily.columns]
    none = spark.createDataFrame([], "address string")
    dates = spark.createDataFrame([(day + timedelta(days=d),) for d in (0, 1)], "block_date date")
    out = scores.trailing_features(daily, scores.daily_addresses(acts), dates, none, none, "1")
    got = rows(out.withColumn("score_date", F.col("score_date").cast("string")), "user_address", "score_date", "n_txn", "n_validators", "n_contracts", "n_nft_collections")
    assert got == [("0xuser", "2024-01-01", n, n, n, n), ("0xuser", "2024-01-02", n + 10, n, n, n)]


def test_target_days(spark):
    hours = [datetime(2024, 1, 1) + timedelta(hours=h) for h in range(24 + 23)]
    blocks = spark.createDataFrame([(x,) for x in hours], "block_timestamp timestamp_ntz")
    dates = spark.createDataFrame([(date(2024, 1, d), 1) for d in (1, 2, 3)], "date_day date, day_of_week int")
    assert rows(scores.target_days(blocks, dates), "block_date") == [(date(2024, 1, 1),)]
    assert scores.target_days(blocks, dates, full_reload=True).count() == 0


@pytest.fixture(scope="module")
def two_days(spark):
    """Two days with the same transactions: a swap by name, a label against a name, a known signature, a wrapped coin."""
    txs, logs, decoded = [], [], []
    for d in (0, 1):
        ts, block = T0 + timedelta(days=d), 10 + d
        txs.append((block, f"t{d}", "0xfrom", "0xapp", "0xabcdef0100", True, ts))
        txs.append((block, f"f{d}", "0xfrom", "0xapp", "0xabcdef0100", False, ts))
        for i, (contract, sig, data) in enumerate([("0xplain", "0xs1", "0x"), ("0xdex", "0xs1", "0x"), ("0xplain", "0xs2", "0x"), ("0xwrap", S.WRAP_DEPOSIT, "0x"), ("0xbridge", "0xs3", "0x"), ("0xplain", None, "0x"), ("0xplain", V.TRANSFER, "0x")]):
            logs.append((block, f"t{d}", i, ts, "0xfrom", "0xapp", contract, sig, [sig] if sig else [], data))
        logs.append((block, f"f{d}", 9, ts, "0xfrom", "0xapp", "0xdex", "0xs1", ["0xs1"], "0x"))
        decoded.append((block, f"t{d}", 4, "Claimed", ts))
    stamp = "block_timestamp timestamp_ntz"
    make = spark.createDataFrame
    chain = (
        make(txs, f"block_number long, tx_hash string, from_address string, to_address string, input_data string, tx_succeeded boolean, {stamp}"),
        make(logs, f"block_number long, tx_hash string, event_index long, {stamp}, origin_from_address string, origin_to_address string, contract_address string, topic_0 string, topics array<string>, data string"),
        make(decoded, f"block_number long, tx_hash string, event_index long, event_name string, {stamp}"),
        make([], f"block_number long, tx_hash string, trace_index long, value double, trace_succeeded boolean, from_address string, to_address string, {stamp}"))
    look = scores.Lookups(
        event_sigs=make([("0xs1", "ReStaked"), ("0xs1", "Zzz")], "event_sig string, event_name string"), known_sigs=make([("0xs2", S.GOV_VOTES)], "event_sig string, metric string"),
        known_names=make([("stak", S.STAKE_TX), ("restak", S.RESTAKES), ("claim", S.LP_ADDS)], "event_name string, metric string"),
        labels=make([("0xdex", "dex", "pool"), ("0xbridge", "bridge", "pool")], "address string, label_type string, label_subtype string"), verified=make([], "token_address string, is_verified boolean"),
        wrapped=make([("0xwrap", S.CHAIN)], "wrapped_asset_address string, blockchain string"), categories=make([(m, i) for i, m in enumerate(S.METRICS)], "metric string, metric_rank int"),
        contracts=make([], "address string, decimals int"))
    return chain, look


def test_actions_take_the_best_evidence(spark, two_days):
    chain, look = two_days
    out = scores.day_actions(*chain, look)
    # 0: two name patterns, the better rank; 1: label before name; 2: signature; 3: wrapped coin; 4: a bridge's own event; 5: no signature
    day = out.filter("tx_hash = 't0' and action_type = 'contract_interaction'")
    assert rows(day, "index", "metric_name") == [(0, S.STAKE_TX), (1, S.SWAP_TX), (2, S.GOV_VOTES), (3, S.SWAP_TX), (4, S.OTHER_DEFI)]
    assert out.filter("tx_hash like 'f%'").count() == 0
    assert rows(out.filter("action_type = 'tx'"), "tx_hash", "index", "complex_tx") == [("t0", -1, True), ("t1", -1, True)]


def test_actions_of_new_days_only(spark, two_days):
    chain, look = two_days
    every = scores.day_actions(*chain, look)
    days = every.select("block_date").distinct()
    first = scores.new_actions(None, days.filter(F.col("block_date") == F.lit(T0.date())), *chain, look=look)
    second = scores.new_actions(first, days, *chain, look=look)
    assert {r.tx_hash for r in first.collect()} == {"t0"} and {r.tx_hash for r in second.collect()} == {"t1"}
    assert sorted(map(str, first.unionByName(second).collect())) == sorted(map(str, every.collect()))
    assert scores.new_actions(every, days, *chain, look=look).count() == 0
    assert scores.new_actions(None, days.filter("false"), *chain, look=look).count() == 0
