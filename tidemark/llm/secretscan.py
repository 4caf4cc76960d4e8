"""Secret scanning over a trigram index, in DataFrame operations only.

Each rule's regex gives a Boolean query over the trigrams that a match must hold. Postings (trigram, document) of
the trigrams that the queries name are intersected per document; a rule is tried on its candidates alone. A rule
without mandatory trigrams is tried on every text.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as op, _parser

from pyspark.sql import Column, DataFrame, functions as F

#: A disjunction of trigram sets, each of which a text must hold whole. [frozenset()] holds always.
Query = list[frozenset[str]]
ALWAYS: Query = [frozenset()]
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A match counts if its `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: From BEGIN to END; where END is missing, to the end of the run: over blanks if it begins with a long word, else over
#: line breaks. Only classes repeat, none of which holds a hyphen, so a text is read once for each way.
KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    r"(?:[\\nr\x20\t\r\n]*Proc-Type:\x20*[0-9],ENCRYPTED[\\nr\x20\t\r\n]*DEK-Info:\x20*[A-Za-z0-9-]+,[0-9A-Fa-f]+)?"
    r"(?:[A-Za-z0-9+/=\\\x20\t\r\n]*-----END [A-Z ]*PRIVATE KEY-----|[\x20\t\r\n]*[A-Za-z0-9+/=\\]{16,}[A-Za-z0-9+/=\\\x20\t\r\n]*|[A-Za-z0-9+/=\\\r\n]*)"
)

BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs of [0-9a-f]+ that have 24 characters
)
ADDED = (
    Rule("private_key", KEY),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("address_login", r"://[^\s/:@]+:[^\s/:@]+@"),
)
RULES = BASE + ADDED


def least(query: Query) -> Query:
    """The same query without sets that hold another of its sets."""
    sets = list(dict.fromkeys(query))
    return [x for x in sets if not any(y < x for y in sets)]


def both(a: Query, b: Query) -> Query:
    """Both hold. When that takes too many sets, `a` alone: a weaker query only adds candidates."""
    made = least([x | y for x in a for y in b])
    return made if len(made) <= MOST_STRINGS else a


def trigrams_of(strings: set[str]) -> Query:
    """One of the strings occurs."""
    sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]
    return ALWAYS if any(not s for s in sets) else least(sets)


def _walk(items) -> tuple[set[str] | None, Query]:
    """All strings the items can match if those are few, else None; a query that each match fulfils."""
    run, query, whole = {""}, ALWAYS, True
    for item in items:
        strings, need = _item(item)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a, b in itertools.product(run, strings)}
            continue
        query = both(both(query, trigrams_of(run)), need if strings is None else trigrams_of(strings))
        run, whole = {""}, False
    return (run, ALWAYS) if whole else (None, both(query, trigrams_of(run)))


def _item(item) -> tuple[set[str] | None, Query]:
    kind, arg = item
    if kind is op.LITERAL:
        return {chr(arg).lower()}, ALWAYS
    if kind is op.IN and all(k is op.LITERAL for k, _ in arg) and len(arg) <= 6:
        return {chr(c).lower() for _, c in arg}, ALWAYS
    if kind is op.SUBPATTERN:
        return _walk(arg[-1])
    if kind is op.BRANCH:
        ways = [_walk(way) for way in arg[1]]
        if all(s is not None for s, _ in ways):
            return set().union(*(s for s, _ in ways)), ALWAYS
        return None, least([x for s, q in ways for x in (q if s is None else trigrams_of(s))])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, inner = arg
        strings, need = _walk(inner)
        if strings is not None and high == 1:
            return strings | ({""} if low == 0 else set()), ALWAYS
        if low == 0:
            return None, ALWAYS
        return None, need if strings is None else trigrams_of(strings)
    if kind is op.AT:
        return {""}, ALWAYS
    return None, ALWAYS


def trigram_query(pattern: str) -> Query:
    """The trigrams, in lower case, that every match of the pattern must hold."""
    strings, query = _walk(_parser.parse(pattern))
    return query if strings is None else trigrams_of(strings)


def plan(rules: tuple[Rule, ...] = RULES) -> tuple[dict[str, Query], list[str]]:
    """The query of each rule that has one, and the trigrams that these name."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != ALWAYS and frozenset() not in q}
    return queries, sorted(set().union(*(s for q in queries.values() for s in q)))


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(gram number, doc_id) for the given trigrams: the part of the inverted index that the queries can ask for."""
    low = F.lower("text")
    held = F.array_compact(F.array(*[F.when(low.contains(g), F.lit(i)) for i, g in enumerate(grams)]))
    return docs.select("doc_id", F.explode(held).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, Query], grams: list[str]) -> DataFrame:
    """doc_id and a truth for each rule: the postings of one of the rule's trigram sets meet in the document.

    A document's set has as many members as the queries name trigrams, at most.
    """
    number = {g: i for i, g in enumerate(grams)}
    met = index.groupBy("doc_id").agg(F.collect_set("gram").alias("met"))
    flags = []
    for kind, query in queries.items():
        ways = [F.size(F.array_intersect("met", F.array(*[F.lit(number[g]) for g in sorted(way)]))) == len(way) for way in query]
        any_way = ways[0]
        for way in ways[1:]:
            any_way = any_way | way
        flags.append(any_way.alias(f"try_{kind}"))
    rows = met.select("doc_id", *flags)
    some = F.lit(False)
    for kind in queries:
        some = some | F.col(f"try_{kind}")
    return rows.filter(some)


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """array of (start, order, end): leftmost matches without overlap, code points, end exclusive.

    The pieces between matches give the places. Matches that fail are dropped after that, so nothing is tried
    again inside them.
    """
    rx = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, rx, F.lit(0))
    value = F.regexp_extract_all(text, rx, F.lit(rule.group))
    steps = F.arrays_zip(F.split(text, rule.pattern, -1).alias("piece"), found.alias("found"), value.alias("value"))
    span = "struct<start:int,order:int,end:int>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["piece"])
        end = begin + F.coalesce(F.length(x["found"]), F.lit(0))
        new = F.struct(begin.cast("int").alias("start"), F.lit(order).alias("order"), end.cast("int").alias("end"))
        ok = F.coalesce(F.length(x["value"]) >= rule.least, F.lit(False))
        return F.struct(end.cast("int").alias("at"), F.when(ok, F.array_append(acc["out"], new)).otherwise(acc["out"]).alias("out"))

    spans = F.aggregate(steps, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.array().cast(f"array<{span}>"))


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `df` and `secret_spans`: array of (start, order, end) by start, then rule.

    A null text is empty. Rows that share an id or have none are each looked at with their own text; ids only
    serve to find candidates, and more candidates change no result. A column `secret_spans` of the input is
    replaced.
    """
    queries, grams = plan(rules)
    docs = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if queries:
        found = candidates(postings(docs.select("doc_id", "text"), grams), queries, grams).withColumnRenamed("doc_id", "_id")
        docs = docs.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    spans = []
    for order, rule in enumerate(rules):
        one = rule_spans(F.col("text"), rule, order)
        spans.append(F.when(F.col(f"try_{rule.kind}"), one).otherwise(F.array().cast("array<struct<start:int,order:int,end:int>>")) if rule.kind in queries else one)
    out = docs.select("row", F.array_sort(F.concat(*spans)).alias("secret_spans"))
    return out.select(*[F.col("row")[c].alias(c) for c in df.columns if c != "secret_spans"], "secret_spans")


def digest(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """The text with each run of overlapping spans replaced by the mark; null stays null."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        more = F.when(s["start"] >= acc["at"], F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], more).alias("out"))

    whole = F.aggregate(spans, state, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
