"""Benchmark decontamination by template windows, in DataFrame operations only.

Numbers, names and units become typed placeholders, so a question with other parameters keeps its template. The
hashes of all template windows of all texts meet those of the benchmark; what the placeholders stood for must then
agree. Numbers are parameters, each by itself: equal ones may differ elsewhere and different ones become equal. Units
(dollar and dollars are one) and names have, along one alignment, one value in the document, that of most mentions;
windows that hold another mention drop out.

Items without a window of enough plain words are looked for word for word, by the hash of their first words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged

WINDOW = 8
LITERALS = 5
ENOUGH = 6
#: Items that are looked for word for word meet the documents by the hash of so many first words: the most they have.
EXACT = (8, 4, 2, 1)
#: An item of fewer words is anybody's words: it must be the whole text, or a line of its own.
SHORT = 4

#: Letters of scripts written without blanks: Thai, Lao, Burmese, Khmer, kana, Han.
SINGLE = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
#: Words, single letters of those scripts, numbers with their inner marks, and what ends a sentence.
TOKEN = rf"[0-9]+(?:[.,:/][0-9]+)*|[\p{{L}}&&[^{SINGLE}]][[\p{{L}}\p{{M}}\p{{N}}]&&[^{SINGLE}]]*|[\p{{L}}&&[{SINGLE}]]\p{{M}}*|[.!?:\n]"
ENDS = (".", "!", "?", ":", "\n")
NUMBER, UNIT, NAME = "#", "%", "@"

UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces lb lbs pound pounds ml l liter liters litre litres "
    "gallon gallons second seconds sec minute minutes min hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent degree degrees "
    "mph kph watt watts volt volts joule joules newton newtons byte bytes kb mb gb"
).split()

#: One form for the spellings of a unit; any other unit is its own.
SAME_UNIT = {
    "inches": "inch", "foot": "ft", "feet": "ft", "yards": "yard", "miles": "mile", "gram": "g", "grams": "g", "kilogram": "kg", "kilograms": "kg", "tons": "ton", "ounce": "oz",
    "ounces": "oz", "lbs": "lb", "pound": "lb", "pounds": "lb", "liter": "l", "liters": "l", "litre": "l", "litres": "l", "gallons": "gallon", "seconds": "second", "sec": "second",
    "minutes": "minute", "min": "minute", "hours": "hour", "days": "day", "weeks": "week", "months": "month", "years": "year", "dollars": "dollar", "euros": "euro", "cents": "cent",
    "degrees": "degree", "watts": "watt", "volts": "volt", "joules": "joule", "newtons": "newton", "bytes": "byte",
}

#: Distinct window hashes (16 bytes each and the table around them) that every executor may hold a copy of.
MOST_BROADCAST = 400_000


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


#: How an item may be read, since a copy may begin inside a sentence or be in small letters or capitals throughout:
#: every capital makes a name (and so does the first word), the first word is none, no first word of a sentence is one,
#: there are no names.
READINGS = ("names", "first", "sentences", "none")


def template(found: Column, reading: str | None = None) -> Column:
    """The placeholder or the lower-case word for each token; null for a sentence end.

    A name is a word with a capital, then small letters, wherever it stands, or as `reading` says. Words all in
    capitals are literals, so a text in capitals has the template of one in small letters.
    """

    def one(w: Column, i: Column) -> Column:
        head, rest = F.substring(w, 1, 1), F.substring(w, 2, 1 << 30)
        first = F.ascii(w)
        name = (head != F.lower(head)) & (rest != F.upper(rest))
        if reading == "names":
            name = name | (i == 0)
        elif reading == "first":
            name = name & (i > 0)
        elif reading == "sentences":
            name = name & (i > 0) & ~F.element_at(found, F.greatest(i, F.lit(1))).isin(*ENDS)
        elif reading == "none":
            name = F.lit(False)
        return (
            F.when(w.isin(*ENDS), F.lit(None).cast("string"))
            .when((first >= 48) & (first <= 57), F.lit(NUMBER))
            .when(F.lower(w).isin(*UNITS), F.lit(UNIT))
            .when(name, F.lit(NAME))
            .otherwise(F.lower(w)))

    return F.transform(found, one)


def _hashes(words: Column, size: int = WINDOW) -> Column:
    """xxhash64 of each window of `size` words; none for a text with fewer."""
    last = F.size(words) - size + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, size)))).otherwise(F.array().cast("array<bigint>"))


def windows(df: DataFrame, exact: tuple[int, ...] = ()) -> DataFrame:
    """doc_id, size, pos (from 0), h: every template window of `text` (size 0), and each run of `exact` words as they are."""
    found = df.select("doc_id", tokens(F.col("text")).alias("found"))
    words = found.select("doc_id", F.array_compact(template(F.col("found"))).alias("words"), *([_plain(F.col("found")).alias("values")] if exact else []))
    if not exact:
        return words.select("doc_id", F.lit(0).alias("size"), F.posexplode(_hashes(F.col("words"))).alias("pos", "h"))

    def placed(hashes: Column, size: int) -> Column:
        return F.transform(hashes, lambda h, i: F.struct(F.lit(size).alias("size"), i.alias("pos"), h.alias("h")))

    each = [placed(_hashes(F.col("words")), 0), *[placed(_hashes(F.col("values"), n), n) for n in exact]]
    return words.select("doc_id", F.explode(F.concat(*each)).alias("w")).select("doc_id", "w.size", "w.pos", "w.h")


def _plain(found: Column) -> Column:
    return F.transform(F.filter(found, lambda w: ~w.isin(*ENDS)), lambda w: F.lower(w))


def slotted(df: DataFrame, *keep: str, reading: str | None = None) -> DataFrame:
    """`keep`, words and values: the template and, beside it, the lower-case token that each place held."""
    found = df.select(*keep, tokens(F.col("text")).alias("found"))
    typed = found.select(*keep, "found", template(F.col("found"), reading).alias("typed"))
    held = F.filter(F.arrays_zip("typed", "found"), lambda x: x["typed"].isNotNull())
    return typed.select(*keep, held.alias("held")).select(*keep, F.transform("held", lambda x: x["typed"]).alias("words"), F.transform("held", lambda x: F.lower(x["found"])).alias("values"))


def slots(words: Column, values: Column, pos: Column) -> Column:
    """The (kind, value, offset) of the placeholders in the window at `pos`, in order; units in one form."""
    one_form = F.create_map(*[F.lit(x) for pair in SAME_UNIT.items() for x in pair])
    both = F.arrays_zip(F.slice(words, pos + 1, WINDOW).alias("kind"), F.slice(values, pos + 1, WINDOW).alias("value"))

    def one(x: Column, i: Column) -> Column:
        value = F.when(x["kind"] == UNIT, F.coalesce(one_form[x["value"]], x["value"])).otherwise(x["value"])
        return F.struct(x["kind"].alias("kind"), value.alias("value"), i.alias("offset"))

    return F.filter(F.transform(both, one), lambda x: x["kind"].isin(NUMBER, UNIT, NAME))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value worked out once, however often `then` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _stray(bound: Column) -> Column:
    """The places of units and names that do not have the value of most mentions (of as many: the item's own).

    `bound` has (kind, place, want, have) for each place of an alignment. Two names of the item may not become one.
    Mentions are counted once for each (kind, want, have), and the most frequent found once for each value.
    """
    def counted(rows: Column) -> Column:
        ways = F.array_distinct(F.transform(rows, lambda b: F.struct(b["kind"].alias("kind"), b["want"].alias("want"), b["have"].alias("have"))))
        return F.transform(ways, lambda w: F.struct(
            w["kind"].alias("kind"), w["want"].alias("want"), w["have"].alias("have"),
            F.size(F.filter(rows, lambda x: (x["kind"] == w["kind"]) & (x["want"] == w["want"]) & (x["have"] == w["have"]))).alias("n")))

    def most(ways: Column, by: str, other: str) -> Column:
        """(kind, by, top) for each value of `by`: the value of `other` that it has most often."""
        values = F.array_distinct(F.transform(ways, lambda w: F.struct(w["kind"].alias("kind"), w[by].alias("by"))))
        return F.transform(values, lambda v: F.struct(v["kind"].alias("kind"), v["by"].alias("by"), F.array_max(F.transform(
            F.filter(ways, lambda w: (w["kind"] == v["kind"]) & (w[by] == v["by"])),
            lambda w: F.struct(w["n"].alias("n"), (w["want"] == w["have"]).alias("kept"), w[other].alias("value"))))["value"].alias("top")))

    def strays(rows: Column, tops: Column) -> Column:
        def breaks(b: Column, side: str, by: str, other: str) -> Column:
            return F.exists(tops[side], lambda t: (t["kind"] == b["kind"]) & (t["by"] == b[by]) & (t["top"] != b[other]))

        wrong = F.filter(rows, lambda b: (b["kind"] != NUMBER) & (breaks(b, "of_want", "want", "have") | ((b["kind"] == NAME) & breaks(b, "of_have", "have", "want"))))
        return F.transform(wrong, lambda b: b["place"])

    def tops(ways: Column) -> Column:
        return F.struct(most(ways, "want", "have").alias("of_want"), most(ways, "have", "want").alias("of_have"))

    return _let(bound, lambda rows: _let(counted(rows), lambda ways: _let(tops(ways), lambda t: strays(rows, t))))


def _unlike(bound: Column) -> Column:
    """Names and numbers both lose their one value, and so do most of the values that recur: another text."""
    values = F.array_distinct(F.transform(bound, lambda b: F.struct(b["kind"].alias("kind"), b["want"].alias("want"))))
    places = F.transform(values, lambda v: F.struct(v["kind"].alias("kind"), F.transform(F.filter(bound, lambda b: (b["kind"] == v["kind"]) & (b["want"] == v["want"])), lambda b: b["have"]).alias("have")))
    recur = F.filter(places, lambda p: F.size(p["have"]) > 1)
    broken = F.filter(recur, lambda p: F.size(F.array_distinct(p["have"])) > 1)
    return F.exists(broken, lambda p: p["kind"] == NAME) & F.exists(broken, lambda p: p["kind"] == NUMBER) & (F.size(broken) * 2 > F.size(recur))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """item_id, at, h, want, n_item: the windows with LITERALS words or more that are no placeholder, in each reading.

    A word that begins a sentence counts as a word there. The tokens of an item are read once; all readings have
    their windows at the same places.

    Items with fewer than WINDOW words, or without such a window, have none: see exact_items.
    """
    found = items.select("item_id", tokens(F.col("text")).alias("found"))
    typed = found.select("item_id", "found", F.struct(*[template(F.col("found"), r).alias(r) for r in READINGS]).alias("as"))
    places = F.filter(F.sequence(F.lit(0), F.size("found") - 1), lambda i: F.get(F.col("as.none"), i).isNotNull())
    kept = typed.filter(F.size("found") > 0).select("item_id", "as", "found", places.alias("places"))

    def held(what: Column) -> Column:
        return F.transform("places", lambda i: F.get(what, i))

    each = kept.select("item_id", F.transform(held(F.col("found")), lambda w: F.lower(w)).alias("values"), held(F.col("as.sentences")).alias("plain"), F.explode(F.array(*[held(F.col(f"as.{r}")) for r in READINGS])).alias("words"))
    placed = each.select("item_id", "values", "plain", "words", F.posexplode(_hashes(F.col("words"))).alias("at", "h"))
    literal = F.size(F.filter(F.slice("plain", F.col("at") + 1, WINDOW), lambda w: ~w.isin(NUMBER, UNIT, NAME)))
    marks = placed.filter(literal >= LITERALS).select("item_id", "at", "h", slots(F.col("words"), F.col("values"), F.col("at")).alias("want"))
    marks = staged(marks.distinct(), "benchmark_windows")
    total = marks.groupBy(F.col("item_id").alias("_item")).agg(F.count_distinct("at").alias("n_item"))
    return marks.join(total, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item")


def exact_items(items: DataFrame, marks: DataFrame) -> DataFrame:
    """item_id, exact (all its words), size, h: the items without a window in `marks`, their first `size` words hashed."""
    has = marks.select(F.col("item_id").alias("_item")).distinct()
    rest = items.join(has, F.col("item_id").eqNullSafe(F.col("_item")), "left_anti").select("item_id", _plain(tokens(F.col("text"))).alias("exact"))
    sized = rest.withColumn("size", F.coalesce(*[F.when(F.size("exact") >= n, F.lit(n)) for n in EXACT])).filter("size is not null")
    return sized.withColumn("h", F.xxhash64(F.slice("exact", F.lit(1), F.col("size"))))


def leaks(df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_windows, item_windows, reparameterised: a row for each item that a document holds.

    A pair is reported when the document holds ENOUGH distinct windows of the item (all, if it has fewer) whose
    placeholders are consistent along their alignment. `reparameterised`: some value differs. Null and empty texts
    hold nothing; rows with one id are one document, and rows without an id are one for each different text; an empty
    table on either side gives no row. An item without windows is reported where all its words stand as they are, as
    one window; with fewer than SHORT words only as a whole text or line.

    What several branches read is written once: the items' windows and first words, and where documents meet them.
    """
    own = F.when(F.col(id_col).isNull(), F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    docs = df.select(F.struct(F.col(id_col).alias("id"), own.alias("text")).alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    marks = staged(benchmark_windows(items), "benchmark_marks")
    exact = staged(exact_items(items, marks), "benchmark_exact")
    sizes = tuple(sorted(r["size"] for r in exact.select("size").distinct().collect()))
    wanted = marks.select(F.lit(0).alias("_size"), F.col("h").alias("_h")).unionByName(exact.select(F.col("size").alias("_size"), F.col("h").alias("_h"))).distinct()
    wanted = staged(wanted, "benchmark_wanted")
    if wanted.count() <= MOST_BROADCAST:
        wanted = F.broadcast(wanted)
    met = staged(windows(docs, sizes).join(wanted, (F.col("h") == F.col("_h")) & (F.col("size") == F.col("_size"))).select("doc_id", "size", "pos", "h"), "benchmark_met")
    per_doc = met.groupBy("doc_id").agg(F.collect_set(F.struct("size", "pos", "h")).alias("met")).withColumnRenamed("doc_id", "_id")
    again = docs.join(per_doc, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "met")

    hits = slotted(again, "doc_id", "met").select("doc_id", "words", "values", F.explode(F.filter("met", lambda m: m["size"] == 0)).alias("m")).select(
        "doc_id", F.col("m")["pos"].alias("pos"), F.col("m")["h"].alias("_h"), F.xxhash64(F.slice("words", F.col("m")["pos"] + 1, WINDOW)).alias("own"), slots(F.col("words"), F.col("values"), F.col("m")["pos"]).alias("have"))
    hits = hits.filter(F.col("own") == F.col("_h"))  # another row of the same id may have been meant
    pairs = hits.join(marks, (F.col("_h") == F.col("h")) & (F.transform("have", lambda x: x["kind"]) == F.transform("want", lambda x: x["kind"])))
    bound = F.transform(F.arrays_zip("want", "have"), lambda x: F.struct(
        x["want"]["kind"].alias("kind"), (F.col("at") + x["want"]["offset"]).alias("place"), x["want"]["value"].alias("want"), x["have"]["value"].alias("have")))
    # An alignment has as many windows and bindings as the item has words, at most.
    lines = pairs.groupBy("doc_id", "item_id", "n_item", (F.col("pos") - F.col("at")).alias("shift")).agg(
        F.collect_set("at").alias("ats"), F.array_distinct(F.flatten(F.collect_set(bound))).alias("bound"))
    lines = lines.filter(~_unlike(F.col("bound"))).withColumn("stray", _stray(F.col("bound"))).withColumn("changed", F.exists("bound", lambda x: x["want"] != x["have"]))

    def inside(place: Column, at: Column) -> Column:
        return (place >= at) & (place < at + WINDOW)

    each = lines.select("doc_id", "item_id", "n_item", "changed", "stray", F.explode("ats").alias("at")).filter(~F.exists("stray", lambda p: inside(p, F.col("at"))))
    found = each.groupBy("doc_id", "item_id", "n_item").agg(F.count_distinct("at").alias("n_windows"), F.max("changed").alias("reparameterised"))
    found = found.filter(F.col("n_windows") >= F.least("n_item", F.lit(ENOUGH))).select("doc_id", "item_id", "n_windows", F.col("n_item").alias("item_windows"), "reparameterised")
    if sizes:
        rows = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: _plain(tokens(x)))
        starts = again.select("doc_id", _plain(tokens(F.col("text"))).alias("values"), rows.alias("rows"), F.explode(F.filter("met", lambda m: m["size"] > 0)).alias("m"))
        starts = starts.select("doc_id", "values", "rows", F.col("m")["pos"].alias("pos"), F.col("m")["h"].alias("_h"))
        here = F.slice(F.col("values"), F.col("pos") + 1, F.size("exact")) == F.col("exact")
        alone = (F.size("exact") >= SHORT) | (F.col("values") == F.col("exact")) | F.exists("rows", lambda r: r == F.col("exact"))
        whole = starts.join(exact, (F.col("_h") == F.col("h")) & here & alone)
        one = F.lit(1).cast("bigint")
        found = found.unionByName(whole.select("doc_id", "item_id", one.alias("n_windows"), one.alias("item_windows"), F.lit(False).alias("reparameterised")).distinct())
    return found.withColumn("doc_id", F.col("doc_id.id"))
