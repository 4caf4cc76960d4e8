"""Vector codes, byte-level BPE and whitening against brute force, the library and numpy's own solver."""

import base64
import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bytebpe, vectorcodes, whitening
from tidemark.llm.ship import ship

VECTORS = "vec_id long, embedding array<float>, label int, code string, x long, n int, size int"


def table(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, v, c, "x", 1, 2, 3) for i, v, c in rows], VECTORS)


def cloud(seed, n, size, step=0.05):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, size)) * np.linspace(1.5, 0.2, size) + r.standard_normal(size)
    return (np.round(x / step) * step).astype(np.float32)  # a coarse grid: equal distances happen


# vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Every part against every entry in every round, in Python integers."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [int(np.floor(4096 * float(v))) for v in r[1]]))
    x = [[int(np.floor(4096 * float(v))) for v in r[1]] for r in rows]
    width = len(x[0]) // parts
    cells = [[v[p * width : (p + 1) * width] for v in x] for p in range(parts)]
    books = [[list(c) for c in cells[p][:entries]] for p in range(parts)]

    def near(c, book):
        return min((sum((a - b) ** 2 for a, b in zip(c, w)), e) for e, w in enumerate(book))

    for k in range(rounds + 1):
        found = [[near(c, books[p]) for c in cells[p]] for p in range(parts)]
        if k < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    mine = [c for c, (_, at) in zip(cells[p], found[p]) if at == e]
                    if mine:
                        books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    digest = hashlib.sha256(",".join(str(v) for b in books for w in b for v in w).encode()).hexdigest()
    labels = {}
    out = []
    for i, r in enumerate(rows):
        error = sum(found[p][i][0] for p in range(parts))
        labels[r[2]] = labels.get(r[2], 0) + error
        out.append((r[0], "".join(f"{found[p][i][1]:02x}" for p in range(parts)), error, r[2]))
    return sorted((i, c, e, labels[label], digest) for i, c, e, label in out)


def codes(df):
    return sorted(tuple(r) for r in vectorcodes.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


@pytest.mark.parametrize("n, size", [(300, 16), (9, 8), (1, 24)])
def test_codes_are_those_of_a_full_scan(spark, n, size):
    rows = [(3 * i, v.tolist(), [None, 1, 2][i % 3]) for i, v in enumerate(cloud(n, n, size))]
    rows += [(10_000 + i, rows[i % n][1], 7) for i in range(40 if n > 100 else 0)]  # repeated vectors
    assert codes(table(spark, rows).repartition(3)) == plain_codes(rows)


def test_rounds_compare_only_what_moved():
    x = cloud(5, 400, 4, 0.01)
    x = np.floor(x * 4096).astype(np.int64)
    words = x[:16].copy()
    first, stored, work = vectorcodes.reassign(x, words, None, None, np.ones(16, dtype=bool))
    assert work == 400 * 16
    moved = np.zeros(16, dtype=bool)
    moved[[2, 9]] = True
    words[2] += 300
    words[9] = words[1]  # ties with a lower index
    got = vectorcodes.reassign(x, words, first, stored, moved)
    want = vectorcodes.reassign(x, words, None, None, moved)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    mine = int(moved[first].sum())
    assert got[2] == mine * 16 + (400 - mine) * 2


def test_codes_of_odd_rows(spark):
    bad = [(1, None, 1), (2, [1.0, None], 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] * 8, 1)]
    assert codes(table(spark, bad)) == [] and codes(table(spark, [])) == []
    rows = [(5, [float(i)] * 8, 1) for i in (1, 1, 2)] + [(None, [0.5] * 8, None)]
    got = sorted((tuple(r) for r in vectorcodes.compress(table(spark, bad + rows)).collect()), key=lambda r: (r[0] is None, r[1]))
    assert [(r[0], r[1], r[2]) for r in got] == [(5, "00" * 8, 0), (5, "00" * 8, 0), (5, "02" * 8, 0), (None, "03" * 8, 0)]
    mixed = [(1, [0.5] * 8, 1), (2, [], 1), (3, [0.25] * 11, 2), (4, [3e38, -3e38] * 4, 3), (5, [2e38] * 8, 3)]
    got = {r.vec_id: r for r in vectorcodes.compress(table(spark, mixed)).collect()}
    assert [got[i].code for i in (1, 2, 3)] == ["00" * 8] * 3 and got[2].codebooks_sha256 != got[3].codebooks_sha256
    assert got[4].error == 0  # its own entry, however far


def test_codes_of_far_vectors(spark):
    r = np.random.default_rng(3)
    rows = [(i, v.tolist(), 1) for i, v in enumerate((r.standard_normal((60, 8)) * 1e5).astype(np.float32))]
    assert codes(table(spark, rows)) == plain_codes(rows)


# byte-level BPE

@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(bytebpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_the_library_s(library):
    c = bytebpe.Codec()
    rnd = random.Random(1)
    alphabets = ["ab", "aaaaab", "abcdefghij klmno", "éàü ñ", "漢字かな交じり文", "مرحبا بالعالم", "0123456789 .,", " \n\t\r", "\U0001f600‍́x", "<|endoftext|>"]
    texts = ["", "a", " ", "  a", "don't I'll we've", "<|endoftext|>", "\x00\x01", "a" * 3000, "ab" * 2000 + "c", " x y"]
    texts += ["".join(rnd.choice(a) for _ in range(rnd.randrange(1, 400))) for a in alphabets for _ in range(30)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(0x4E00, 0x9FFF), rnd.randrange(0x1F300, 0x1F700)])) for _ in range(200)) for _ in range(60)]
    for t in texts:
        ids = c.encode(t)
        assert ids == library.encode_ordinary(t), t
        assert c.decode(ids) == t.encode()


def test_long_words_cost_n_log_n(library):
    rnd = random.Random(2)
    word = "".join(rnd.choice("etaoinshrdlu") for _ in range(100_000))
    c = bytebpe.Codec()
    start = time.time()
    assert c.encode(word) == library.encode_ordinary(word)
    assert time.time() - start < 20


def test_texts_of_many_words_go_in_pieces(library, monkeypatch):
    monkeypatch.setattr(bytebpe, "PIECES", 7)
    monkeypatch.setattr(bytebpe, "CACHED_CHARS", 40)
    c = bytebpe.Codec()
    text = "The cat's  12 mats \n\n étaient là " * 50
    assert c.encode(text) == library.encode_ordinary(text)


def test_round_trip_table(spark, library):
    ship(spark)
    texts = [None, "", "x" * 5000, "le chat est là", "le chat est là", "日本語 " * 30_000, "ab <|endoftext|> c"]
    df = spark.createDataFrame([(i if i != 3 else None, t, "en", 5, [1]) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_tokens int, ids array<int>")

    def want(t):
        ids = library.encode_ordinary(t or "")
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    got = sorted((tuple(r) for r in bytebpe.round_trip(df).collect()), key=str)
    assert got == sorted(((i if i != 3 else None, *want(t)) for i, t in enumerate(texts)), key=str)
    ids = bytebpe.encode(df)
    assert {(r.doc_id, tuple(r.ids)) for r in ids.collect()} == {(i if i != 3 else None, tuple(library.encode_ordinary(t or ""))) for i, t in enumerate(texts)}
    assert {(r.doc_id, bytes(r.bytes)) for r in bytebpe.decode(ids).collect()} == {(i if i != 3 else None, (t or "").encode()) for i, t in enumerate(texts)}
    odd = spark.createDataFrame([(1, None), (2, [10**6]), (3, [None]), (4, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.bytes for r in bytebpe.decode(odd).collect()} == {1: None, 2: None, 3: None, 4: b""}
    assert bytebpe.round_trip(df.limit(0)).count() == 0


def test_op12_over_documents(spark, folder, library):
    from tidemark.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op12_byte_bpe"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# whitening

def test_counts_are_those_of_the_spectrum():
    r = np.random.default_rng(1)
    for size in (1, 2, 5, 20):
        a = r.standard_normal((size, size))
        a = a + a.T
        np.fill_diagonal(a, 0 if size > 2 else a.diagonal())  # pivots of size two
        e = np.linalg.eigvalsh(a)
        for s in [*(e[:-1] + e[1:]) / 2, e[0] - 1, e[-1] + 1, 0.0]:
            if np.abs(e - s).min() > 1e-9:
                assert whitening.above(a, float(s)) == (e > s).sum()


@pytest.mark.parametrize("spectrum", [np.arange(1, 25.0), np.geomspace(1e-9, 1e3, 24), np.r_[np.ones(10), np.full(6, 5.0), np.zeros(8)], np.r_[1.0, 1 + 1e-13, 1 + 1e-10, 2, 2 + 1e-15, np.linspace(3, 3.0001, 19)]])
def test_eigenvalues_in_order(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(4).standard_normal((24, 24)))
    v = q * spectrum @ q.T
    v = (v + v.T) / 2
    got = whitening.leading(v, 12)
    want = np.sort(spectrum)[::-1][:12]
    norm = spectrum.max()
    assert np.allclose([e for e, _, _ in got], want[: len(got)], rtol=0, atol=1e-13 * norm)
    assert all(w <= 1e-12 * norm for w in want[len(got) :])
    x = np.array([x for _, x, _ in got]).T
    assert np.abs(x.T @ x - np.eye(len(got))).max() < 1e-12
    assert np.abs(v @ x - x * [e for e, _, _ in got]).max() < 1e-12 * norm
    assert max(radius for _, _, radius in got) < 1e-11 * norm


def plain_whitening(vectors, components):
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, size = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    z = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    v = z.T @ z / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return n, deviation, z @ q / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("n, size", [(500, 40), (300, 8)])
def test_whitening_is_that_of_a_plain_solver(spark, n, size):
    vectors = cloud(n, n, size, 0.001)
    got = whitening.whiten(table(spark, [(i, v.tolist(), 1) for i, v in enumerate(vectors)]).repartition(3)).collect()
    k = min(32, size)
    count, deviation, whitened, explained = plain_whitening(vectors, k)
    assert len(got) == n * k and {r.n for r in got} == {count}
    at = np.zeros((n, k))
    for r in got:
        at[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.vec_id] and abs(r.explained - explained[r.component - 1]) < 1e-12 and r.identity_error < 1e-9
    signs = np.sign((at * whitened).sum(0))
    assert np.abs(at - whitened * signs).max() < 1e-7
    assert len({r.identity_error for r in got}) == 1


def test_whitening_of_odd_rows(spark):
    bad = [(1, None, 1), (2, [1.0, None], 1), (3, [float("nan")] * 4, 1), (4, [float("-inf")] * 4, 1)]
    assert whitening.whiten(table(spark, bad)).count() == 0 and whitening.whiten(table(spark, [])).count() == 0
    one = whitening.whiten(table(spark, bad + [(5, [1.0, 2.0, 3.0], 1)])).orderBy("component").collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(c, 1, 0, None, 0.0, 0.0) for c in (1, 2, 3)]
    rows = [(1, [0.0, 0.0, 1.0], 1), (1, [1.0, 0.0, 1.0], 1), (None, [1.0, 0.0, 1.0], 1), (7, [], 1), (8, [3e38], 1), (9, [-3e38], 1)]
    got = whitening.whiten(table(spark, rows)).collect()
    three = [r for r in got if r.n == 3]
    assert len(three) == 9 and all((r.whitened is None) == (r.component > 1) for r in three)
    assert sorted(round(abs(r.whitened), 9) for r in three if r.component == 1) == [round(0.5**0.5, 9)] * 2 + [round(2**0.5, 9)]
    far = [r for r in got if r.n == 2]
    assert [abs(round(r.whitened, 6)) for r in far] == [1.0, 1.0] and {r.deviation for r in far} == {2**63 - 1} and 7 not in {r.vec_id for r in got}


def test_products_are_exact():
    r = np.random.default_rng(2)
    for most in (2**19, 2**40):
        z = r.integers(-most, most, (9000, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(z[:, i], z[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.products(z).tolist() == want
