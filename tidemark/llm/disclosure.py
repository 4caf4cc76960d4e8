"""Information-theoretic sanitisation of personal data.

Patterns find the entities to protect. A term near an entity discloses it as far as seeing the term makes the
entity likely: with counts over the corpus, P(entity | term) = 2 ** (PMI(entity, term) - information(entity)), the
share of the term's occurrences that stand near the entity, copies of one surrounding counted once and the estimate
smoothed for few occurrences. Terms over one threshold are generalised, over a second removed, in every document that
holds the entity.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..session import staged
from .text import slices

KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its start only: from later in it, the outcome would be the same.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W\d_]{3,}")

#: Rows (id, terms) that every executor may hold a copy of; more are joined by a shuffle.
MOST_BROADCAST = 200_000
#: Rows of mentions that a task holds before it hands them on, however many one text has.
HELD_ROWS = 4096


@dataclass(frozen=True)
class Settings:
    """Terms count up to `reach` words away. `support` is how many further occurrences, elsewhere, smoothing supposes:
    one surrounding of a term that is nowhere else gives 1 / (1 + support), two give 2 / (2 + support)."""

    reach: int = 8
    support: int = 3
    generalise: float = 0.25
    remove: float = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        x = int(d) * (1 + place % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, from one @ to the next; linear in the text."""
    pos, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            pos = domain.end()
            yield start, pos
        at = text.find("@", max(at + 1, pos))


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive. Failing matches are dropped."""
    out = [(0, a, b) for a, b in emails(text)]
    if "." in text:
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m.groups())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def entity(text: str, kind: int, start: int, end: int) -> str:
    """One spelling for each entity."""
    found = text[start:end]
    return f"{KINDS[kind]}:{found.lower() if kind < 2 else digits_of(found)}"


def _texts(raw: np.ndarray, offsets: np.ndarray) -> list[str]:
    data = raw.tobytes()
    return [data[a:b].decode("utf-8") for a, b in zip(offsets[:-1], offsets[1:])]


def _near(text: str, words: list[tuple[int, int]], start: int, end: int, reach: int) -> tuple[list[str], list[str]]:
    """Up to `reach` whole words before and after a span, however far away. `words` are the places of all."""
    first = bisect_right(words, start, key=lambda w: w[1])
    then = bisect_left(words, end, key=lambda w: w[0])
    return [text[a:b].lower() for a, b in words[max(0, first - reach) : first]], [text[a:b].lower() for a, b in words[then : then + reach]]


def mentions(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, entity, term, place: a row for each distinct word near each entity found. `place` is a hash of the
    surroundings, equal for copies."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, offsets in slices(batches):
            rows: dict[str, list] = {n: [] for n in ("row", "entity", "term", "place")}

            def out() -> pa.RecordBatch:
                ids = part.column("doc_id").take(pa.array(rows["row"], pa.int64()))
                columns = [pa.array(rows["entity"], pa.string()), pa.array(rows["term"], pa.string()), pa.array(rows["place"], pa.int64())]
                for kept in rows.values():
                    kept.clear()
                return pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "entity", "term", "place"])

            for r, text in enumerate(_texts(raw, offsets)):
                spans = base_spans(text)
                words = [m.span() for m in WORD.finditer(text)] if spans else []
                for kind, a, b in spans:
                    before, after = _near(text, words, a, b, s.reach)
                    place = int.from_bytes(hashlib.blake2b(" ".join([*before, "|", *after]).encode(), digest_size=8).digest(), "big", signed=True)
                    for term in {*before, *after} or {""}:
                        rows["row"].append(r)
                        rows["entity"].append(entity(text, kind, a, b))
                        rows["term"].append(term)
                        rows["place"].append(place)
                    if len(rows["row"]) >= HELD_ROWS:
                        yield out()
            yield out()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, entity string, term string, place bigint")


def occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n_term: how often each of `terms` occurs in all texts."""
    if terms.count() <= MOST_BROADCAST:
        terms = F.broadcast(terms)
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("term"))
    return words.join(terms, "term").groupBy("term").agg(F.count("*").alias("n_term"))


def disclosing(docs: DataFrame, found: DataFrame, s: Settings) -> DataFrame:
    """entity, term, likely, removed: the terms that disclose each entity. `found` are the mentions."""
    pairs = found.filter("term <> ''").groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.count_distinct("place").alias("places"))
    most = F.col("places") / (F.col("places") + s.support)  # without occurrences elsewhere
    pairs = staged(pairs.filter(most > s.generalise), "entity_terms")
    elsewhere = F.greatest(F.col("n_term") - F.col("n_both"), F.lit(0))
    likely = F.col("places") / (F.col("places") + elsewhere + s.support)
    out = pairs.join(occurrences(docs, pairs.select("term").distinct()), "term").withColumn("likely", likely)
    return out.filter(F.col("likely") > s.generalise).select("entity", "term", "likely", (F.col("likely") > s.remove).alias("removed"))


def sanitise(df: DataFrame, s: Settings = Settings(), *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, spans (kind number, start, end; by kind, then start) and the sanitised text, for each input row.

    Entities become [EMAIL], [IP], [CARD] and [PHONE]; of the terms that disclose an entity of the document, some
    become [TERM] and the others go. A null text is empty. A row without an id keeps its entities' spans but has
    no terms. Rows of one id share the terms of all of them.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = staged(mentions(docs, s), "mentions")
    terms = staged(disclosing(docs, found, s), "disclosing")
    held = found.select("doc_id", "entity").distinct().join(terms, "entity")
    per_doc = staged(held.groupBy("doc_id", "term").agg(F.max("removed").alias("removed")).groupBy("doc_id").agg(F.collect_list(F.struct("term", "removed")).alias("terms")), "document_terms")
    if per_doc.count() <= MOST_BROADCAST // 10:
        per_doc = F.broadcast(per_doc)
    joined = docs.join(per_doc, "doc_id", "left").select("doc_id", "text", "terms")
    span = StructType([StructField("kind", IntegerType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
    schema = StructType([docs.schema["doc_id"], StructField("spans", ArrayType(span)), *([StructField("text", StringType())] if with_text else [])])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, offsets in slices(batches):
            lists, cleaned = [], []
            for text, flagged in zip(_texts(raw, offsets), part.column("terms").to_pylist()):
                spans = base_spans(text)
                marks = [(a, b, f"[{KINDS[k].upper()}]") for k, a, b in spans]
                if flagged:
                    action = {t["term"]: t["removed"] for t in flagged}
                    taken = sorted((a, b) for _, a, b in spans)
                    starts = np.array([a for a, _ in taken] or [0])
                    reach = np.maximum.accumulate([b for _, b in taken] or [0])
                    for m in WORD.finditer(text):
                        if m[0].lower() in action:
                            k = int(np.searchsorted(starts, m.end(), side="left")) - 1
                            if k < 0 or reach[k] <= m.start():
                                spans.append((4, m.start(), m.end()))
                                marks.append((m.start(), m.end(), "" if action[m[0].lower()] else "[TERM]"))
                lists.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                if with_text:
                    out, at = [], 0
                    for a, b, mark in sorted(marks):
                        if a >= at:
                            out += [text[at:a], mark]
                        at = max(at, b)
                    cleaned.append("".join([*out, text[at:]]))
            columns = [part.column("doc_id"), pa.array(lists, arrow.field("spans").type)]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(cleaned, pa.string())] if with_text else [])], schema=arrow)

    return joined.mapInArrow(run, schema)
