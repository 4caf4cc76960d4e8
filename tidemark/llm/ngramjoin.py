"""Jaccard self-join of documents on word n-grams, by token-combination prefixes.

A document's tokens are the hashes of its distinct n-grams. Let c(n) = ceil(t * n) for the wanted similarity t, and
l(n) the length by which a prefix is extended. Two similar sets x, y share at least c(|x|) tokens. In any order of
all tokens, an extended prefix (the first |x| - c(|x|) + l(|x|) tokens of x) leaves out c(|x|) - l(|x|) tokens; as
|y| >= t * |x|, both extended prefixes hold the first m(|x|) = min(l(c(|x|)), c(|x|)) common tokens. Hence, without loss:

* In the order of the hash: a document with fewer than m tokens in its prefix that any other prefix holds has no
  partner. This leaves few documents, of which each class of equal sets goes on as one.
* Over their whole sets: a document with fewer than c tokens that any other holds has no partner.
* In the order of frequency, rare tokens first: a pair has a common rare token in the prefixes, or all its common
  tokens there are frequent. Then both documents have m frequent ones, and two neighbours among the common ones stand
  within `reach` places of each other in both, so the pair has a common combination of two frequent tokens.

So rare tokens are indexed alone and frequent ones in combinations. Candidates are verified on whole sets.

Links are only wanted up to connection: first every document is held against one leader of its tokens' lists, which
joins large groups of copies in a linear number of comparisons; all remaining candidates of different groups are
then compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .graph import components
from .text import SLOT, mix, slices, windows, words

#: 64-bit words of a set's parity sketch: bit i is the parity of its tokens in bucket i.
WORDS = 16
SKETCH = [f"k{i}" for i in range(WORDS)]

#: Ids that every executor may hold a copy of (about 50 MB); more are joined by a shuffle.
MOST_BROADCAST = 1_000_000


@dataclass(frozen=True)
class Settings:
    """Similar: 100 * intersection >= percent * union. Tokens of more than `rare` classes are frequent. A prefix is
    extended by `extra` percent of the set, at least by three tokens."""

    n: int = 5
    percent: int = 80
    rare: int = 24
    extra: int = 6
    rounds: int = 2

    def core(self, n):
        return (self.percent * n + 99) // 100

    def extension(self, n):
        return np.maximum(3, (self.extra * n + 99) // 100)

    def prefix(self, n):
        return np.minimum(n, n - self.core(n) + self.extension(n))

    def core_of(self, n: Column) -> Column:
        return F.floor((n * self.percent + 99) / 100)

    def common(self, n: Column) -> Column:
        """m(n) as a column."""
        core = self.core_of(n)
        return F.least(F.greatest(F.lit(3), F.floor((core * self.extra + 99) / 100)), core)

    def longest_prefix(self, n: Column) -> Column:
        return n - self.core_of(n) + F.greatest(F.lit(3), F.floor((n * self.extra + 99) / 100))


def token_sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The ascending distinct hashes of each text's n-grams; a text of fewer words has its whole sequence."""
    word, rows = words(raw, offsets)
    out = []
    gaps = tuple(range(n))
    for a, b in zip(rows[:-1], rows[1:]):
        own = word[a:b]
        if len(own) >= n:
            made = windows(own, gaps, 0)
        elif len(own):
            with np.errstate(over="ignore"):
                made = mix((own * SLOT[: len(own)]).sum(dtype=np.uint64, keepdims=True), 200 + len(own))
        else:
            made = own
        out.append(np.unique(made.view(np.int64)))
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def _each(docs: DataFrame, schema: str, make) -> DataFrame:
    """make(list of token sets) gives the columns beside doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, offsets in slices(batches):
            made = make(raw, offsets)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made.values()], names=["doc_id", *made])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}")


def prefixes(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n (size of the set), hs (the extended prefix in the order of the hash)."""

    def make(raw: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        sets = token_sets(raw, offsets, s.n)
        return {"n": pa.array([len(x) for x in sets], pa.int32()), "hs": _lists([x[: int(s.prefix(len(x)))] for x in sets])}

    return _each(docs, "n int, hs array<bigint>", make)


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n, one, two: two hashes of the whole set."""

    def make(raw: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        sets = [x.view(np.uint64) for x in token_sets(raw, offsets, s.n)]
        with np.errstate(over="ignore"):
            sums = [[int(mix(x, seed).sum(dtype=np.uint64).astype(np.int64)) if len(x) else 0 for x in sets] for seed in (31, 32)]
        return {"n": pa.array([len(x) for x in sets], pa.int32()), "one": pa.array(sums[0], pa.int64()), "two": pa.array(sums[1], pa.int64())}

    return _each(docs, "n int, one bigint, two bigint", make)


def parities(tokens: np.ndarray) -> np.ndarray:
    bucket = (tokens.view(np.uint64) >> np.uint64(20)).astype(np.int64) % (64 * WORDS)
    return np.packbits(np.bincount(bucket, minlength=64 * WORDS).astype(np.uint8) & 1).view(np.int64)


def whole_sets(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n, tokens and the sketch."""

    def make(raw: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        sets = token_sets(raw, offsets, s.n)
        sketch = np.array([parities(x) for x in sets]).reshape(len(sets), WORDS)
        return {"n": pa.array([len(x) for x in sets], pa.int32()), "tokens": _lists(sets)} | {k: pa.array(np.ascontiguousarray(sketch[:, i])) for i, k in enumerate(SKETCH)}

    return _each(docs, "n int, tokens array<bigint>, " + ", ".join(f"{k} bigint" for k in SKETCH), make)


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `docs` whose id is in the stored, distinct `ids`."""
    if ids.count() <= MOST_BROADCAST:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_semi")


def with_company(prefix: DataFrame, s: Settings) -> DataFrame:
    """doc_id: documents with m tokens in their prefix that another document's prefix holds."""
    tokens = prefix.filter(F.col("doc_id").isNotNull()).select("doc_id", "n", F.explode("hs").alias("h"))
    met = tokens.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1").select("h")
    counts = tokens.join(met, "h").groupBy("doc_id", "n").agg(F.count("*").alias("met"))
    return counts.filter(F.col("met") >= s.common(F.col("n"))).select("doc_id").distinct()


def prefix_index(sets: DataFrame, s: Settings) -> DataFrame:
    """node, n, h, df: the tokens of the extended prefixes in the order of (df, h), without those of one node.

    Tokens of one node come first in that order, so the prefix has room for the first shared ones that remain.
    """
    tokens = sets.select(F.col("doc_id").alias("node"), "n", F.explode("tokens").alias("h"))
    df_of = tokens.groupBy("h").agg(F.count("*").cast("int").alias("df")).filter("df > 1")
    lists = tokens.join(df_of, "h").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("ts"))
    lists = lists.filter(F.size("ts") >= s.core_of(F.col("n")))
    room = (s.longest_prefix(F.col("n")) - F.col("n") + F.size("ts")).cast("int")
    return lists.select("node", "n", F.explode(F.slice("ts", F.lit(1), F.greatest(room, F.lit(1)))).alias("t")).select("node", "n", "t.h", "t.df")


def similar(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar; a node with several sets is similar where one is."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    met = F.size(F.array_intersect("ta", "tb")).cast("bigint")
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", met.alias("met"))
    return joined.filter(100 * F.col("met") >= s.percent * (F.col("na") + F.col("nb") - F.col("met"))).select("a", "b").distinct()


def _close(a: str, b: str, s: Settings) -> Column:
    """The sizes allow the similarity."""
    return 100 * F.least(a, b) >= s.percent * F.greatest(a, b)


def _grouped(index: DataFrame, links: DataFrame | None) -> DataFrame:
    """The index with each node's group so far, without the tokens whose nodes all are in one group."""
    if links is None:
        return index.withColumn("part", F.col("node"))
    parts = components(links)
    index = index.join(parts.withColumnRenamed("component", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    apart = index.groupBy("h").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi").select("h")
    return index.join(apart, "h")


def _leader_pairs(index: DataFrame, s: Settings, turn: int) -> DataFrame:
    """For each node the leader that most of its tokens' lists have; another leader each turn."""
    rank = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
    leads = index.groupBy("h").agg(F.min(F.struct(rank.alias("r"), F.col("node").alias("lead"), F.col("n").alias("lead_n"), F.col("part").alias("lead_part"))).alias("x"))
    met = index.join(leads.select("h", "x.lead", "x.lead_n", "x.lead_part"), "h").filter((F.col("part") != F.col("lead_part")) & _close("n", "lead_n", s))
    best = met.groupBy("node", "lead").agg(F.count("*").alias("c")).groupBy("node").agg(F.max(F.struct("c", (-F.col("lead")).alias("x"), "lead")).alias("best"))
    return best.select(F.greatest("node", "best.lead").alias("a"), F.least("node", "best.lead").alias("b")).distinct()


def _combinations(index: DataFrame, s: Settings) -> DataFrame:
    """node, n, part, h: combinations of two frequent tokens within reach, for nodes with enough frequent tokens."""
    lists = index.filter(F.col("df") > s.rare).groupBy("node", "n", "part").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "h"))), lambda t: t["h"]).alias("hs"))
    m = s.common(F.col("n"))
    lists = lists.filter(F.size("hs") >= m)
    most = F.size("hs") + s.longest_prefix(F.floor(F.col("n") * 100 / s.percent) + 1)
    lists = lists.withColumn("reach", F.ceil(most / F.greatest(m - 1, F.lit(1))).cast("int"))
    made = F.flatten(F.transform("hs", lambda h, i: F.transform(F.slice("hs", i + 2, F.col("reach")), lambda g: F.xxhash64(h, g))))
    return lists.select("node", "n", "part", F.explode(made).alias("h"))


def _other_pairs(index: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Candidates of different groups: a common rare token or a common combination of frequent ones, and sketches
    that allow the similarity. Parities differ in as many places as the sets have different tokens, at most."""
    keys = index.filter(F.col("df") <= s.rare).select("node", "n", "part", "h").union(_combinations(index, s))
    keys = keys.join(sets.select(F.col("doc_id").alias("node"), *SKETCH), "node")
    left = keys.select("h", F.col("node").alias("a"), F.col("n").alias("na"), F.col("part").alias("pa"), *[F.col(k).alias(f"a{k}") for k in SKETCH])
    right = keys.select("h", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("part").alias("pb"), *[F.col(k).alias(f"b{k}") for k in SKETCH])
    apart = sum((F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))) for k in SKETCH[1:]), F.bit_count(F.col(f"a{SKETCH[0]}").bitwiseXOR(F.col(f"b{SKETCH[0]}"))))
    near = (100 + s.percent) * apart <= (100 - s.percent) * (F.col("na") + F.col("nb"))
    on = (left["h"] == right["h"]) & (F.col("a") > F.col("b")) & (F.col("pa") != F.col("pb")) & _close("na", "nb", s) & near
    return left.join(right, on).select("a", "b").distinct()


def near_duplicates(df: DataFrame, s: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id that links reach): a row for each input row.

    Words are what stands between blanks, A-Z lower-cased. A null, empty or blank text has an empty set and no
    link. Rows of one id are one node that links where any of its texts does. A null id has a null component.
    Ids must be whole numbers. An empty table gives no row.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    known = docs.filter(F.col("doc_id").isNotNull())
    prefix = staged(prefixes(docs, s), "prefixes")
    first = staged(with_company(prefix, s), "with_company")

    members = signatures(only(known, first), s)
    reps = members.groupBy("n", "one", "two").agg(F.min("doc_id").alias("node"))
    members = staged(members.join(reps, ["n", "one", "two"]).select("doc_id", "node").distinct(), "classes")
    nodes = staged(members.select(F.col("node").alias("doc_id")).distinct(), "nodes")
    sets = staged(whole_sets(only(known, nodes), s), "sets")
    index = staged(prefix_index(sets, s), "index")
    sets = sets.join(index.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")

    links = None
    for turn in range(s.rounds):
        found = similar(_leader_pairs(_grouped(index, links), s, turn), sets, s)
        links = staged(found if links is None else found.union(links), "similar")
    rest = similar(_other_pairs(_grouped(index, links), sets, s), sets, s)
    links = staged(rest if links is None else rest.union(links), "similar")

    # Members of a class are linked with their node.
    links = links.union(members.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    reached = components(links)
    out = prefix.select("doc_id", F.col("n").cast("bigint").alias("n_shingles")).join(reached.withColumnRenamed("node", "_node"), F.col("doc_id") == F.col("_node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
