"""Message-side jobs on hand-made rows."""

import base64
import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import prices, worklists as wl
from tidemark.plans.cosmos import core, packets, defi, gov, nft, reports, stats
from tidemark.session import staged

T0 = datetime(2024, 1, 1, 5, 30)
STAMP = "_inserted_timestamp"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def b64(s):
    return base64.b64encode(s.encode()).decode()


@pytest.fixture(scope="module")
def attrs(spark):
    """Attribute rows from (tx, group, sub, index, type, {key: value})."""
    def make(*events):
        out = []
        for tx, g, s, i, kind, kvs in events:
            pairs = kvs.items() if isinstance(kvs, dict) else kvs
            for n, (k, v) in enumerate(pairs):
                out.append((1, T0, tx, True, g, s, i, kind, n, k, v, T0))
        return spark.createDataFrame(out, f"block_id long, block_timestamp timestamp_ntz, tx_id string, tx_succeeded boolean, msg_group int, msg_sub_group int, msg_index int, msg_type string, attribute_index int, attribute_key string, attribute_value string, {STAMP} timestamp_ntz")
    return make


def tx_payload(tx, height, events, code=None):
    ev = [{"type": t, "attributes": [{"key": b64(k), "value": b64(v)} for k, v in a]} for t, a in events]
    return json.dumps({"height": str(height), "hash": tx, "tx_result": {"code": code, "gas_used": "5", "log": "[]", "events": ev}})


@pytest.fixture(scope="module")
def raw_txs(spark):
    def make(*txs):
        return spark.createDataFrame([(d, s) for d, s in txs], f"data string, {STAMP} timestamp_ntz")
    return make


ACTION = ("message", [("action", "go")])
MODULE = ("message", [("module", "bank")])
MOVE = ("transfer", [("amount", "1u")])


@pytest.mark.parametrize("fn", [core.number_messages, core.number_message_rows])
def test_message_groups(spark, raw_txs, fn):
    events = [("tx", [("fee", "1usei")]), ACTION, MODULE, MOVE, MODULE, MOVE, ACTION, MOVE]
    blocks = spark.createDataFrame([(9, T0)], "block_id long, block_timestamp timestamp_ntz")
    txs = core.transactions(raw_txs((tx_payload("a", 9, events), T0), (tx_payload("tail", 9, [ACTION, MOVE, ("tx", [("x", "y")])]), T0)), blocks)
    out = fn(core.split_messages(txs))
    got = [(r.msg_group, r.msg_sub_group) for r in out.filter("tx_id = 'a'").orderBy("msg_index").collect()]
    assert got == [(None, None), (0, 0), (0, 0), (0, 1), (0, 1), (0, 0), (1, 0), (1, 0)]
    assert [r.msg_sub_group for r in out.filter("tx_id = 'tail'").collect()] == [None, None, None]


def test_late_block_and_latest_payload(spark, raw_txs):
    none = spark.createDataFrame([], "block_id long, block_timestamp timestamp_ntz")
    there = spark.createDataFrame([(9, T0)], "block_id long, block_timestamp timestamp_ntz")
    raw = raw_txs((tx_payload("a", 9, [MOVE], 1), T0), (tx_payload("a", 9, [MOVE]), datetime(2024, 1, 2)))
    run1 = core.transactions(raw, none)
    assert rows(run1, "tx_id", "tx_succeeded", "block_timestamp") == [("a", True, datetime(2099, 12, 31))]
    assert core.messages(run1).count() == 0
    run2 = core.transactions(raw_txs((tx_payload("b", 9, [MOVE]), T0)), there, run1)
    assert rows(run2, "tx_id", "block_timestamp") == [("a", T0), ("b", T0)]


def test_landed_payload_shapes(spark):
    block = {"header": {"chain_id": "c", "height": "3", "time": "2024-01-01T00:00:00"}, "data": {"txs": ["x", "y"]}}
    raw = spark.createDataFrame([(3, json.dumps({"result": {"block": block}}), T0), (4, json.dumps({"data": {"result": {"block": block}}}), T0), (5, "{}", T0)], f"block_number long, data string, {STAMP} timestamp_ntz")
    assert rows(core.landed_blocks(raw), "block_id", "tx_count", "chain_id") == [(3, 2, "c"), (4, 2, "c")]
    txs = [json.dumps(d) for d in ({"result": {"txs": [{"hash": "a"}, {"hash": "b"}]}}, {"data": {"result": {"txs": [{"hash": "c"}]}}}, {"result": {"txs": []}}, {"error": {"code": 5}})]
    raw = spark.createDataFrame([(i, d, T0) for i, d in enumerate(txs)], f"block_number long, data string, {STAMP} timestamp_ntz")
    assert rows(core.landed_transactions(raw), "block_id", "tx_id", "tx_block_index") == [(0, "a", 0), (0, "b", 1), (1, "c", 0), (2, None, None)]


def test_block_metas(spark):
    meta = lambda h, n: {"header": {"chain_id": "c", "height": str(h), "time": "2024-01-01T00:00:00Z"}, "num_txs": str(n), "block_size": "7"}
    raw = spark.createDataFrame([(json.dumps({"data": [{"result": {"block_metas": [meta(1, 5), meta(2, 6)]}}]}), T0), (json.dumps({"data": {"result": {"block_metas": [meta(2, 9)]}}}), datetime(2024, 1, 2))], f"data string, {STAMP} timestamp_ntz")
    assert rows(core.block_metas(raw), "block_id", "num_txs") == [(1, 5), (2, 9)]


SENDER = ("t1", None, None, 0, "tx", {"acc_seq": "alice/7", "fee_payer": "alice"})


def test_transfers(attrs):
    a = attrs(SENDER, ("t1", 0, 0, 1, "transfer", {"recipient": "bob", "amount": "12usei"}), ("t1", 0, 0, 2, "transfer", {"sender": "carol", "recipient": "dan", "amount": "3ibc/9"}), ("t2", 0, 0, 1, "transfer", {"recipient": "x", "amount": "1u"}))
    assert rows(core.transfers(a), "sender", "receiver", "amount", "currency") == [("alice", "bob", 12, "usei"), ("carol", "dan", 3, "ibc/9")]


PACKET_1 = {"packet_sequence": "1", "packet_src_channel": "c0", "packet_dst_channel": "c1"}


def _send(tx, seq, group=0):
    return [(tx, None, None, 0, "tx", {"acc_seq": "a/1"}), (tx, group, 0, 1, "transfer", {"sender": "a", "recipient": "escrow", "amount": "5usei"}), (tx, group, 0, 2, "ibc_transfer", {"sender": "a", "receiver": "far"}),
            (tx, group, 0, 3, "send_packet", {**PACKET_1, "packet_sequence": seq})]


def test_ibc_transfers_need_an_acknowledgement(attrs):
    ack = ("t9", 0, 0, 1, "acknowledge_packet", PACKET_1)
    came = [("t3", None, None, 0, "signer", {"sei_addr": "relay"}), ("t3", 0, 0, 1, "transfer", {"sender": "esc", "recipient": "me", "amount": "8ibc/Z"}), ("t3", 0, 0, 2, "write_acknowledgement", {"packet_data": json.dumps({"receiver": "me", "sender": "afar"})})]
    a = attrs(*_send("t1", "1"), *_send("t2", "2"), ack, *came)
    out = packets.transfers(packets.run(a))
    assert rows(out, "tx_id", "transfer_type", "sender", "receiver", "amount") == [("t1", "IBC_TRANSFER_OUT", "a", "far", 5), ("t3", "IBC_TRANSFER_IN", "afar", "me", 8)]
    assert core.fact_transfers(core.transfers(a), out).count() == 5


def test_packets_end_in_any_run_and_any_order(attrs):
    """Every split of the events into two runs, either half first, gives what one run gives."""
    acks = [("t6", 0, 0, 1, "acknowledge_packet", PACKET_1), ("t7", 0, 0, 1, "timeout_packet", PACKET_1), ("t7", 0, 0, 2, "acknowledge_packet", {**PACKET_1, "packet_sequence": "2"}),
            ("t5", 0, 0, 1, "timeout_packet", {**PACKET_1, "packet_sequence": "2"}), ("t8", 0, 0, 1, "acknowledge_packet", {**PACKET_1, "packet_sequence": "3"}), ("t8", 0, 0, 2, "acknowledge_packet", {**PACKET_1, "packet_src_channel": "c9"})]
    parts = [*([r] for r in acks), _send("t1", "1"), _send("t2", "2"), _send("t3", "3"), _send("t4", "4"), [("t4", 1, 0, 4, "send_packet", PACKET_1), ("t4", 1, 0, 5, "transfer", {"sender": "a", "recipient": "x", "amount": "1usei"})]]
    got = lambda run: rows(packets.transfers(run), "tx_id", "msg_index", "transfer_type", "receiver")
    flat = lambda ps: attrs(*[r for p in ps for r in p])
    whole = packets.run(flat(parts))
    assert got(whole) == [("t2", 1, "IBC_TRANSFER_OUT", "far"), ("t3", 1, "IBC_TRANSFER_OUT", "far")]
    for cut in (1, 5, 7, 9):
        for first, second in ((parts[:cut], parts[cut:]), (parts[cut:], parts[:cut]), (parts, parts[cut:])):
            assert got(packets.run(flat(second), packets.run(flat(first)))) == got(whole), cut


def test_a_later_timeout_takes_a_transfer_back(attrs):
    one = packets.run(attrs(*_send("t1", "1"), *_send("t2", "2"), ("t3", 0, 0, 1, "acknowledge_packet", PACKET_1), ("t3", 0, 0, 2, "acknowledge_packet", {**PACKET_1, "packet_sequence": "2"})))
    assert rows(packets.transfers(one), "tx_id") == [("t1",), ("t2",)]
    two = packets.run(attrs(("t9", 0, 0, 1, "timeout_packet", PACKET_1)), one)
    assert rows(packets.transfers(two), "tx_id") == [("t2",)]
    assert rows(packets.transfers(packets.run(attrs(("t9", 0, 0, 1, "timeout_packet", PACKET_1)), two)), "tx_id") == [("t2",)]


def test_addresses(attrs, spark):
    a = attrs(("t1", 0, 0, 1, "address_associated", {"sei_addr": "n1", "evm_addr": "0xAB"}), ("t2", 0, 0, 5, "address_associated", {"sei_addr": "n1", "evm_addr": "0xCD"}))
    on = core.address_mapping_onchain(a)
    assert rows(on, "native_address", "evm_address") == [("n1", "0xab")]
    raw = spark.createDataFrame([('{"EVM_ADDRESS":"0xEE"}', '{"result":"n2"}', T0), ('{"EVM_ADDRESS":"0xAB"}', '{"result":"n1"}', T0)], f"value string, data string, {STAMP} timestamp_ntz")
    seen = spark.createDataFrame([("0xEE", T0, 5), ("0xAB", T0, 6)], "evm_address string, block_timestamp_associated timestamp_ntz, block_id_associated long")
    api = core.address_mapping_api(raw, seen)
    assert rows(core.dim_address_mapping(on, api), "native_address", "evm_address") == [("n1", "0xab"), ("n2", "0xee")]


def test_asset_precedence(spark):
    info = spark.createDataFrame([("c1", '{"decimals":6,"name":"One","symbol":"O"}'), ("c2", '{"exchange_rate_decimals":1,"decimals":2}')], "contract_address string, data string")
    shared = spark.createDataFrame([("ibc/1", 5, "L", "P"), ("other", 1, "x", "y"), ("c1", 9, "z", "z")], "address string, decimal int, label string, project_name string")
    api = spark.createDataFrame([("c1", 1, "a", "b"), ("ibc/1", 1, "a", "b"), ("c3", 3, "n", "s")], "contract_address string, decimals int, name string, symbol string")
    assert rows(core.asset_metadata(info, shared, api), "currency", "decimals", "symbol") == [("c1", 6, "O"), ("c3", 3, "s"), ("ibc/1", 5, "P")]


def test_contracts(spark, attrs):
    created = core.contracts_instantiate(attrs(("t1", 0, 0, 1, "instantiate", {"_contract_address": "c1"}), ("t2", 0, 0, 1, "instantiate", {"_contract_address": "c2"})))
    listed = spark.createDataFrame([("c1", None, "i1", "L1", T0)], f"contract_address string, admin string, init_by_account_address string, label string, {STAMP} timestamp_ntz")
    labels = spark.createDataFrame([("c1", "adm", "i9", "L9", T0), ("c2", None, None, "L2", T0)], listed.schema)
    assert rows(core.contracts(created, listed, labels), "contract_address", "admin", "init_by_account_address", "label") == [("c1", "adm", "i1", "L1"), ("c2", None, None, "L2")]
    raw = spark.createDataFrame([("c1", '{"data":{"data":{"a":1},"code":"x"}}', T0), ("c1", '{"data":{"code":"old"}}', datetime(2023, 1, 1))], f"contract_address string, data string, {STAMP} timestamp_ntz")
    assert rows(core.contract_payload(raw, "id"), "contract_address", "data", "code") == [("c1", '{"a":1}', "x")]


# --- swaps ----------------------------------------------------------------------------------------


def labels(spark, *pairs):
    return spark.createDataFrame(list(pairs), "contract_address string, label string")


def test_fuzio_legs_by_position(attrs, spark):
    a = attrs(
        ("t1", 0, 0, 0, "tx", {"fee_payer": "alice"}), ("t1", 0, 0, 1, "transfer", {"amount": "100usei"}), ("t1", 0, 0, 2, "wasm", {"_contract_address": "p", "action": "swap", "native_sold": "100", "token_bought": "7"}),
        ("t1", 0, 0, 3, "transfer", {"amount": "7ibc/X"}), ("t1", 0, 0, 4, "transfer", {"amount": "100late"}),
        ("t2", 0, 0, 0, "tx", {"fee_payer": "bob"}), ("t2", 0, 0, 1, "wasm", {"_contract_address": "p", "native_transferred": "4", "input_token_amount": "9"}), ("t2", 0, 0, 2, "transfer", {"amount": "4usei"}))
    out = defi.swaps_fuzio(a, labels(spark, ("p", "Fuzio SEI Pool"), ("q", "other")))
    assert rows(out, "tx_id", "swapper", "amount_in", "currency_in", "amount_out", "currency_out") == [("t1", "alice", 100, "usei", 7, "ibc/X"), ("t2", "bob", 9, None, 4, "usei")]


def test_fuzio_swaps_outside_every_group(attrs, spark):
    """A swap without a group counts; its transfers cannot be told apart, so its units stay open."""
    a = attrs(("t1", None, None, 0, "tx", {"fee_payer": "alice"}), ("t1", None, None, 1, "transfer", {"amount": "100usei"}), ("t1", None, None, 2, "wasm", {"_contract_address": "p", "action": "swap", "native_sold": "100", "token_bought": "7"}))
    assert rows(defi.swaps_fuzio(a, labels(spark, ("p", "Fuzio Pool"))), "swapper", "amount_in", "currency_in", "amount_out", "currency_out") == [("alice", 100, None, 7, None)]


def test_seaswap_legs_by_party(attrs, spark):
    listed = spark.createDataFrame([("p", "Pool P")], "pool_address string, pool_name string")
    a = attrs(
        ("t1", 0, 0, 0, "tx", {"fee_payer": "me"}), ("t1", 0, 0, 1, "execute", {"_contract_address": "p"}), ("t1", 0, 0, 2, "transfer", {"sender": "me", "recipient": "p", "amount": "10usei"}),
        ("t1", 0, 0, 3, "wasm", {"_contract_address": "p", "native_sold": "10", "token_bought": "3"}), ("t1", 0, 0, 4, "wasm", {"_contract_address": "tok", "action": "transfer", "amount": "3", "to": "me"}))
    out = defi.swaps_seaswap(a, listed)
    assert rows(out, "amount_in", "currency_in", "amount_out", "currency_out", "pool_name") == [(10, "usei", 3, "tok", "Pool P")]


def test_combined_swaps_and_heal(attrs, spark):
    a = attrs(("t1", 0, 0, 0, "tx", {"fee_payer": "alice"}), ("t1", 0, 0, 1, "transfer", {"amount": "100usei"}), ("t1", 0, 0, 2, "wasm", {"_contract_address": "p", "action": "swap", "native_sold": "100", "token_bought": "7"}), ("t1", 0, 0, 3, "transfer", {"amount": "7ibc/X"}))
    swaps = defi.swaps_fuzio(a, labels(spark, ("p", "Fuzio Pool")))
    price = spark.createDataFrame([("usei", datetime(2024, 1, 1, 5), 2.0)], "token_address string, hour timestamp_ntz, price double")
    tokens = spark.createDataFrame([("usei", 1, "S")], "currency string, decimals int, symbol string")
    who = spark.createDataFrame([], "native_address string, evm_address string")
    stored = defi.swaps_combined({"fuzio": swaps}, price, tokens, who)
    assert rows(stored, "amount_in", "amount_in_usd", "symbol_in", "amount_out", "amount_out_usd") == [(10.0, 20.0, "S", None, None)]
    assert defi.heal_swaps(stored, price, tokens, who).count() == 0
    more = spark.createDataFrame([("ibc/X", 0, "X")], "currency string, decimals int, symbol string")
    known = spark.createDataFrame([("alice", "0xa")], "native_address string, evm_address string")
    healed = defi.heal_swaps(stored, price, more, known)
    assert rows(healed, "amount_in", "amount_out", "amount_out_usd", "symbol_out", "origin_from_address") == [(10.0, 7.0, None, "X", "0xa")]
    assert defi.fact_dex_swaps({"fuzio": swaps}).first()["platform"] == "fuzio"


def test_pair_pools(attrs, spark):
    a = attrs(("t1", 0, 0, 1, "execute", {"_contract_address": "factory"}), ("t1", 0, 0, 2, "wasm", {"pair_contract_addr": "pool", "liquidity_token_addr": "lp"}), ("t1", 0, 0, 3, "wasm", {"action": "deregister", "pair_contract_addr": "dead"}),
              ("t1", 0, 0, 4, "instantiate", {"_contract_address": "pool"}), ("t2", 0, 0, 1, "wasm", {"pair_contract_addr": "no"}))
    out = defi.pair_pools(a, core.contracts_instantiate(a), "factory")
    assert rows(out, "contract_address", "type") == [("lp", "liquidity_token_addr"), ("pool", "pair_contract_addr")]


# --- liquidity ------------------------------------------------------------------------------------


def test_lp_actions(attrs, spark):
    pools = spark.createDataFrame([("p", "pair_contract_addr")], "contract_address string, type string")
    a = attrs(SENDER, ("t1", 0, 0, 1, "execute", {"_contract_address": "p"}), ("t1", 0, 0, 2, "wasm", {"_contract_address": "p", "action": "provide_liquidity", "assets": "10usei, 20ibc/X", "share": "5"}),
              ("t1", 0, 0, 3, "wasm", {"_contract_address": "lp", "action": "mint", "amount": "5"}))
    astro = defi.lp_astroport(a, pools, labels(spark, ("p", "P")))
    assert rows(astro, "liquidity_provider_address", "lp_action", "token1_amount", "token1_currency", "token2_amount", "token2_currency", "lp_token_amount", "lp_token_address") == [("alice", "provide_liquidity", 10, "usei", 20, "ibc/X", 5, "lp")]

    b = attrs(("t1", 0, 0, 1, "execute", {"_contract_address": "f"}), ("t1", 0, 0, 2, "wasm", {"_contract_address": "f", "action": "add_liquidity", "token1_amount": "1", "token2_amount": "2", "liquidity_received": "3"}),
              ("t1", 0, 0, 3, "wasm", {"_contract_address": "lp", "action": "mint", "to": "zed"}))
    info = spark.createDataFrame([("f", '{"lp_token_address":"lp","token1_denom":{"native":"usei"},"token2_denom":{"native":"ux"}}')], "contract_address string, data string")
    fuzio = defi.lp_fuzio(b, labels(spark, ("f", "Fuzio X")), info)
    assert rows(fuzio, "liquidity_provider_address", "lp_action", "token1_amount", "token2_currency", "lp_token_amount") == [("zed", "add_liquidity", 1, "ux", 3)]

    listed = spark.createDataFrame([("f", "N", "usei", "ux", "lp")], "pool_address string, pool_name string, token1_denom string, token2_denom string, lp_token_address string")
    sea = defi.lp_seaswap(b, listed)
    assert rows(sea, "liquidity_provider_address", "lp_action", "lp_token_amount") == [("zed", "add_liquidity", 3)]

    c = attrs(("t1", 0, 0, 1, "wasm-lp-deposit", {"_contract_address": "m", "addr": "q", "kind": "deposit-lp", "collateral": "1.5", "tokens": "2"}), ("t1", 0, 0, 2, "wasm-lp-x", {"_contract_address": "m", "kind": "odd", "collateral": "1"}))
    status = spark.createDataFrame([("m", '{"collateral":{"native":{"denom":"usei"}},"config":{"market_id":"SEI_USD"}}')], "contract_address string, data string")
    lev = defi.lp_levana(c, labels(spark, ("m", "Levana M")), status, {"m": 6})
    assert rows(lev.filter("lp_action = 'deposit-lp'"), "token1_amount", "token1_currency", "pool_name") == [(1.5e6, "usei", "Levana M")]
    facts = defi.fact_lp_actions({"astroport": astro, "fuzio": fuzio, "seaswap": sea, "levana": lev})
    assert rows(facts, "platform", "lp_action") == [("astroport", "add_liquidity"), ("fuzio", "add_liquidity"), ("levana", "add_liquidity"), ("seaswap", "add_liquidity")]


def test_lp_staking(attrs, spark):
    named = labels(spark, ("st", "Fuzio Staking"), ("pool", "Pool"))
    config = spark.createDataFrame([("st", '{"lp_token_contract":"pool"}')], "contract_address string, data string")
    a = attrs(("t1", 0, 0, 1, "execute", {"_contract_address": "st"}), ("t1", 0, 0, 2, "wasm", {"_contract_address": "st", "action": "bond", "owner": "o", "amount": "4"}))
    assert rows(defi.lp_staking_fuzio(a, named, config), "lp_staking_action", "amount", "pool_address", "pool_name") == [("bond", 4, "pool", "Pool")]
    b = attrs(("t1", 0, 0, 1, "execute", {"_contract_address": "st"}), ("t1", 0, 0, 2, "wasm", {"_contract_address": "st", "action": "withdraw", "owner": "o"}), ("t1", 0, 0, 3, "transfer", {"sender": "st", "recipient": "o", "amount": "9usei"}))
    assert rows(defi.lp_staking_rewards_fuzio(b, named, config), "liquidity_provider_address", "reward_amount", "reward_currency") == [("o", 9, "usei")]


# --- bridge and sales -----------------------------------------------------------------------------


def test_wormhole(attrs, spark):
    a = attrs(
        ("t1", 0, 0, 1, "wasm", {"_contract_address": "W", "action": "register_asset", "token_address": "ta", "token_chain": "2"}), ("t2", 0, 0, 1, "wasm", {"_contract_address": "W", "chain_address": "ca", "chain_id": "2"}),
        ("t3", 0, 0, 1, "wasm", [("_contract_address", "W"), ("action", "burn_from"), ("amount", "5"), ("from", "me"), ("transfer.amount", "5"), ("transfer.recipient", "you")]), ("t3", 0, 0, 2, "wasm", {"_contract_address": "A"}),
        ("t4", 0, 0, 1, "wasm", {"_contract_address": "W", "action": "complete_transfer_wrapped", "amount": "7", "recipient": "mid", "fee": "1"}), ("t4", 0, 0, 2, "transfer", {"sender": "mid", "recipient": "end", "amount": "7x"}))
    assert rows(defi.bridge_assets(a, "W"), "token_address", "token_chain") == [("ta", 2)]
    seed = spark.createDataFrame([("ethereum", "2", "0xe")], "chain_name string, wormhole_chain_id string, address string")
    assert rows(defi.bridge_chains(a, seed, "W"), "chain_id", "chain_name", "foreign_address") == [("2", "ethereum", "0xe")]
    assert [(r.contract_address_array, r.action_array, r.amount, r.transfer_amount, r.from_address) for r in defi.bridge_burns(a, "W").collect()] == [(["A", "W"], ["burn_from"], "5", 5, "me")]
    assert rows(defi.bridge_mints(a, "W"), "amount", "recipient_middle", "recipient", "amount_raw") == [(7, "mid", "end", "7x")]


def test_nft_sales(attrs, spark):
    a = attrs(SENDER, ("t1", 0, 0, 1, "wasm-buy_now", [("_contract_address", "M"), ("nft_address", "n"), ("nft_token_id", "9"), ("token_id", "9"), ("nft_seller", "s"), ("sale_price", "native:usei:500"), ("nft_seller", "again")]),
              ("t1", 0, 0, 2, "wasm", {"_contract_address": "n", "sender": "M", "token_id": "9", "recipient": "b"}))
    sales = nft.sales_pallet(a, "M")
    assert rows(sales, "event_type", "nft_address", "token_id", "buyer_address", "seller_address", "amount", "currency") == [("sale", "n", "9", "b", "s", 500, "usei")]
    tokens = spark.createDataFrame([("usei", 2)], "currency string, decimals int")
    price = spark.createDataFrame([("sei-network", datetime(2024, 1, 1, 5), 3.0)], "id string, recorded_hour timestamp_ntz, close double")
    names = spark.createDataFrame([("n", '{"data":{"name":"Cool"}}')], "contract_address string, data string")
    ez = nft.ez_nft_sales(nft.fact_nft_sales(nft.sales_combined({"pallet": sales})), tokens, price, names)
    assert rows(ez, "amount", "amount_usd", "project_name", "platform_name") == [(5.0, 15.0, "Cool", "pallet")]


# --- governance, balances, stats ------------------------------------------------------------------


def test_staking_precedence(attrs):
    a = attrs(
        SENDER, ("t1", 0, 0, 1, "delegate", {"validator": "v", "amount": "5usei"}), ("t1", 0, 0, 2, "coin_spent", {"spender": "s", "amount": "5usei"}),
        ("t1", 1, 0, 3, "unbond", {"validator": "v", "amount": "6usei", "authz_msg_index": "0"}), ("t1", 1, 0, 4, "coin_spent", {"spender": "granter", "amount": "1usei", "authz_msg_index": "0"}),
        ("t1", 2, None, 5, "redelegate", {"destination_validator": "w", "source_validator": "v", "amount": "7usei"}), ("t1", 2, None, 6, "message", {"module": "staking", "sender": "z"}))
    out = gov.staking(a)
    assert rows(out, "action", "delegator_address", "amount", "validator_address") == [("delegate", "s", 5, "v"), ("redelegate", "z", 7, "w"), ("undelegate", "granter", 6, "v")]


def test_daily_balance_fill(spark):
    b = spark.createDataFrame([(1, datetime(2024, 1, 1, 3), "t", 0, 0, "a", 5, "u"), (1, datetime(2024, 1, 3, 3), "t", 0, 1, "a", 2, "u"), (1, datetime(2024, 1, 3, 1), "t", 0, 0, "a", 9, "u")],
                              "block_id long, block_timestamp timestamp_ntz, tx_id string, msg_group int, msg_index int, address string, balance long, currency string")
    out = core.daily_balances(b, datetime(2024, 1, 4))
    assert rows(out, "date", "balance") == [(date(2024, 1, 1), 5), (date(2024, 1, 2), 5), (date(2024, 1, 3), 2), (date(2024, 1, 4), 2)]


def test_completeness_rows(spark):
    b = spark.createDataFrame([(i, T0) for i in (1, 2, 5, 9)], "block_id long, block_timestamp timestamp_ntz")
    summary, lost = stats.blocks_completeness(b, datetime(2024, 2, 1))
    assert rows(summary, "blocks_tested", "blocks_impacted_count") == [(9, 5)]
    assert [tuple(r) for r in stats.impacted_arrays(lost, 3).orderBy("part_no").collect()] == [(0, [3, 4, 6]), (1, [7, 8])]
    assert rows(stats.retest_scope(b, lost, None), "block_id") == [(2,), (5,), (9,)]


def test_prices_api(spark):
    raw = spark.createDataFrame([(json.dumps({"data": [{"id": "c1", "price": 2.5, "precision": 6, "coingecko": "g"}, {"id": "c2", "price": 1}]}), T0)], f"data string, {STAMP} timestamp_ntz")
    api = prices.api_prices(raw)
    assert rows(api, "contract_address", "price", "decimals") == [("c1", 2.5, 6), ("c2", 1.0, None)]
    shared = spark.createDataFrame([("g", 1.0), ("h", 2.0)], "id string, close double")
    assert rows(prices.listed_hourly_prices(shared, api), "id") == [("g",)]


def test_worklists(spark):
    raw = spark.createDataFrame([('{"PAGE_NUMBER": 2}', "{}", '{"height": "7"}', T0), ("{}", '{"request": {"params": ["x", true, "3"]}}', '{"height": "7"}', T0), ("{}", "{}", "[]", T0)], f"value string, metadata string, data string, {STAMP} timestamp_ntz")
    assert rows(wl.fetched_pages(raw), "block_number", "page_number") == [(7, 2), (7, 3)]
    raw = spark.createDataFrame([("{}", '{"request": {"data": {"params": ["tx.height=12"]}}}', '{"result": {"total_count": "5"}}', T0), ('{"BLOCK_NUMBER": 13}', "{}", "4", T0)], f"value string, metadata string, data string, {STAMP} timestamp_ntz")
    done = wl.fetched_counts(raw)
    assert rows(done, "block_number", "tx_count") == [(12, 5), (13, 4)]
    metas = spark.createDataFrame([(12, 5), (13, 9)], "block_id long, num_txs long")
    assert rows(wl.counts_to_fetch(wl.expected_blocks(spark, 14, 11), done, metas), "block_number") == [(11,), (13,), (14,)]
    hours = spark.createDataFrame([(i, datetime(2024, 1, 5, i // 10)) for i in range(100)], "block_number long, block_timestamp timestamp_ntz")
    assert wl.confirm_limit(hours, datetime(2024, 1, 5)) == 39
    assert wl.lookback_block(hours, datetime(2024, 1, 8, 4, 30)) == 40
    answers = spark.createDataFrame([("c1", T0), ("c2", datetime(2023, 1, 1))], f"contract_address string, {STAMP} timestamp_ntz")
    all_c = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "contract_address string")
    assert [r[0] for r in wl.contracts_to_refresh(all_c, answers, datetime(2024, 1, 3), by_age=True).collect()] == ["c3", "c2"]


def _blocks(spark, ids, path=None):
    df = spark.createDataFrame([(i, datetime(2024, 1, 1) + timedelta(hours=i)) for i in ids], "block_id long, block_timestamp timestamp_ntz")
    return df


def _kept(report):
    return reports.Report(*[staged(x, "kept") for x in (report.row, report.lost, report.tested)])


def test_a_report_reads_its_own_past(spark):
    """The second report, which sees blocks of its scope only, has the row of a test of everything."""
    rnd = random.Random(3)
    for lost, later in (({}, {}), ({7, 8, 9, 31}, {31}), (set(range(40, 60)), {45, 46}), (set(rnd.sample(range(1, 200), 40)), set())):
        first_ids, all_ids = [i for i in range(300) if i not in lost], [i for i in range(500) if i not in set(lost) - set(later) and i not in (310, 311, 400)]
        first = _kept(reports.blocks_report(_blocks(spark, first_ids), datetime(2024, 1, 1) + timedelta(hours=300), bucket=10))
        now = datetime(2024, 1, 1) + timedelta(hours=500)
        start = reports.scope_start(_blocks(spark, all_ids), first, 10)
        assert start == min([x - 1 for x in lost if x < 276] + [275 - 96]) // 10 * 10
        whole = reports.blocks_report(_blocks(spark, all_ids), now, bucket=10)
        again = reports.blocks_report(_blocks(spark, [i for i in all_ids if i >= start]), now, first, 10)
        assert rows(again.row, *whole.row.columns) == rows(whole.row, *whole.row.columns) and rows(again.lost, "lost_from", "lost_to") == rows(whole.lost, "lost_from", "lost_to")
        missing = [i for i in range(476) if i not in all_ids]
        assert [r[0] for r in rows(reports.lost_ids(whole.lost), "missing_id")] == sorted(missing, key=str)
        third = reports.blocks_report(_blocks(spark, [i for i in all_ids if i >= start]), now, _kept(again), 10)
        assert rows(third.row, *whole.row.columns) == rows(whole.row, *whole.row.columns)


def test_transactions_reports_carry_over(spark):
    metas = _blocks(spark, range(120)).withColumn("num_txs", F.lit(2).cast("bigint"))
    txs = lambda bad: spark.createDataFrame([(i, f"t{i}-{k}") for i in range(120) for k in range(bad.get(i, 2))], "block_id long, tx_id string")
    first = _kept(reports.transactions_report(txs({20: 1, 21: 0, 30: 3}), metas, datetime(2024, 1, 1) + timedelta(hours=60), bucket=5))
    assert rows(first.row, "blocks_tested", "blocks_impacted_count", "transactions_impacted_count", "lost_ranges") == [(48, 3, 4, 2)]
    now = datetime(2024, 1, 1) + timedelta(hours=120)
    bad = {21: 0, 22: 1, 90: 0}
    scope = F.col("block_id") >= 15
    again = reports.transactions_report(txs(bad).filter(scope), metas.filter(scope), now, first, 5)
    whole = reports.transactions_report(txs(bad), metas, now, bucket=5)
    assert rows(again.row, *whole.row.columns) == rows(whole.row, *whole.row.columns) and rows(again.lost, "lost_from", "lost_to", "transactions") == [(21, 22, 3), (90, 90, 2)]
    empty = reports.transactions_report(txs({}).limit(0), metas.limit(0), now)
    assert rows(empty.row, "blocks_impacted_count") == [(0,)] and reports.scope_start(metas, _kept(empty)) is None
