"""Projection of JSON payloads and flattening of nested values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import _col


def json_project(df: DataFrame, col: str, fields: dict[str, tuple[list[str], str]], keep: list[str] | None = None) -> DataFrame:
    """Typed columns from a JSON text: name → (alternative paths, type); missing or unfit values are NULL.

    The text is parsed once per row into a variant and read by path from there.
    """
    parsed = df.withColumn("_json", F.try_parse_json(F.col(col)))
    out = []
    for name, (paths, typ) in fields.items():
        reads = [F.try_variant_get("_json", p, typ) for p in paths]
        out.append((F.coalesce(*reads) if len(reads) > 1 else reads[0]).alias(name))
    return parsed.select(*(keep if keep is not None else df.columns), *out)


def without_errors(df: DataFrame, payload: str, denied: list[str] | None = None) -> DataFrame:
    """Drop payloads that carry an error; with `denied`, only those whose error code is on the list."""
    v = F.try_parse_json(F.col(payload))
    if denied is None:
        return df.filter(F.try_variant_get(v, "$.error", "string").isNull())
    code = F.try_variant_get(v, "$.error.code", "string")
    return df.filter(code.isNull() | ~code.isin(denied))


def flatten(df: DataFrame, arr, index: str = "index", value: str = "value", outer: bool = False) -> DataFrame:
    """Array to rows with the element's position; `outer` keeps rows with no elements."""
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select("*", gen(_col(arr)).alias(index, value))


def flatten_map(df: DataFrame, m, key: str = "key", value: str = "value", outer: bool = False) -> DataFrame:
    gen = F.explode_outer if outer else F.explode
    return df.select("*", gen(_col(m)).alias(key, value))


def split_rows(df: DataFrame, col: str, sep: str, out: str) -> DataFrame:
    """Delimited text to one row per piece; `sep` is a regular expression."""
    return df.withColumn(out, F.explode(F.split(F.col(col), sep)))


def once(df: DataFrame, col: str) -> DataFrame:
    """The same rows with a costly column worked out once in each. A filter on it, or on what is read from it, is carried
    below the column otherwise, and works it out again for itself, as often as it is named."""
    rest = [F.col(c) for c in df.columns if c != col]
    return df.select(*rest, F.explode(F.array(col)).alias(col)).select(*df.columns)


def _path_patterns(pattern: str) -> tuple[str, str]:
    """(regex of the whole path, regex of all that may lead to one). [*] is any place of an array, * any field, ** any
    number of steps."""
    import re

    steps = re.findall(r"\*\*|\[\*\]|\[[0-9]+\]|\.?(?:\*|[A-Za-z0-9_]+)", pattern)
    if "".join(steps) != pattern:
        raise ValueError(f"not a path pattern: {pattern}")
    parts = []
    for x in steps:
        dot = r"\." if x.startswith(".") else ""
        parts.append(".*" if x == "**" else r"\[[0-9]+\]" if x == "[*]" else dot + r"[^.\[]+" if x.endswith("*") else re.escape(x))
    lead = ""
    for p in reversed(parts[:-1]):
        lead = p if p == ".*" else f"{p}(?:{lead})?" if lead else p
    return "^" + "".join(parts) + "$", f"^(?:{lead})?$"


def json_walk(df: DataFrame, col: str, pattern: str | None = None) -> DataFrame:
    """Every node below the root of a JSON text of any shape and depth: path, index and value (variant).

    `path` is like data[0].result.height, with fields that are no plain names as ['a.b']; `index` the place in its
    array, or null. With a `pattern` only the nodes it names are given; what cannot lead to one is not opened. Levels
    are opened one after the other, and only nodes with something below them go on, so each node is met once. The
    other columns of `df` come along; an unreadable text has no nodes.
    """
    from ..session import staged

    spark = df.sparkSession
    keep = [c for c in df.columns if c != col]
    whole, leading = _path_patterns(pattern) if pattern else (None, None)
    level = df.select(*keep, F.lit("").alias("path"), F.lit(None).cast("int").alias("index"), F.try_parse_json(col).alias("value")).filter(F.col("value").isNotNull())
    out: DataFrame | None = None
    while True:
        nested = level.filter(F.schema_of_variant("value").rlike("^(OBJECT|ARRAY)<"))
        up = nested.select(*keep, F.col("path").alias("_path"), F.col("value").alias("_value"))
        each = up.lateralJoin(spark.tvf.variant_explode(F.col("_value").outer()).toDF("_pos", "_key", "value"))
        plain = F.when(F.col("_path") == "", F.col("_key")).otherwise(F.concat("_path", F.lit("."), "_key"))
        field = F.when(F.col("_key").rlike("^[A-Za-z0-9_]+$"), plain).otherwise(F.concat("_path", F.lit("['"), "_key", F.lit("']")))
        at = F.when(F.col("_key").isNull(), F.concat("_path", F.lit("["), F.col("_pos").cast("string"), F.lit("]"))).otherwise(field)
        below = each.select(*keep, at.alias("path"), F.when(F.col("_key").isNull(), F.col("_pos")).alias("index"), "value")
        if pattern:
            below = below.filter(F.col("path").rlike(whole) | F.col("path").rlike(leading))
        below = staged(below, "json_level")
        found = below.filter(F.col("path").rlike(whole)) if pattern else below
        out = found if out is None else out.unionByName(found)
        level = below.filter(F.col("path").rlike(leading)) if pattern else below
        if level.isEmpty():
            return out


def json_leaves(df: DataFrame, col: str) -> DataFrame:
    """path and value (text) of every number, text, truth value or null of a JSON, and of empty objects and arrays."""
    kind = F.schema_of_variant("value")
    inner = kind.rlike("^(OBJECT|ARRAY)<") & ~F.to_json("value").isin("{}", "[]")
    rows = json_walk(df, col).filter(~inner)
    text = F.when(kind.rlike("^(OBJECT|ARRAY)<"), F.to_json("value")).otherwise(F.try_variant_get("value", "$", "string"))
    return rows.withColumn("value", text).drop("index")


def flatten_tree(df: DataFrame, payload: str, children: str, node_fields: dict[str, str], root: str = "ORIGIN", node: str | None = None, step: int = 8) -> DataFrame:
    """Nested nodes of a JSON tree to one row per node with its path and its parent's path.

    The levels are built as array columns next to each other and exploded once: one parse, no shuffle, and
    the working set is the one payload already in the row. Each round unrolls `step` levels; the few nodes
    with children below them are written as the next round's input, until none are left. `df` should be a
    table on storage, as it is read twice.

    node_fields: output column → field of the node (read as text). `node` names a column for the node
    itself without its children.
    """
    from ..session import staged

    base = [c for c in df.columns if c != payload]
    work, out = df, None
    while True:
        nodes, levels = _tree_levels(work, payload, children, step, root)
        rows = _tree_rows(df, nodes.withColumn("_n", F.explode(levels)), payload, children, node_fields, node)
        if work is not df:
            # the first node of each round was emitted by the round before
            rows = rows.join(work.select(*base, F.col("_path").alias("trace_address")), [*base, "trace_address"], "left_anti")
        out = rows if out is None else out.unionByName(rows)
        bottom = nodes.select(*base, F.explode(f"_l{step}").alias("_n")).filter(_has_kids(F.col("_n"), children))
        rest = bottom.select(*base, F.to_json("_n.node").alias(payload), F.col("_n.path").alias("_path"), F.col("_n.parent").alias("_parent"))
        work = staged(rest, "tree")
        if work.isEmpty():
            return out


def _has_kids(n, children: str) -> Column:
    return F.try_variant_get(n["node"], f"$.{children}[0]", "variant").isNotNull()


def _tree_levels(df: DataFrame, payload: str, children: str, depth: int, root: str) -> tuple[DataFrame, Column]:
    """Array columns _l0 … _l<depth> of struct(path, parent, node), and all of them as one array."""
    base = [c for c in df.columns if c not in (payload, "_path", "_parent")]
    resumed = "_path" in df.columns
    no_kids = F.array().cast("array<variant>")

    def kids_of(n):
        prefix = F.when(n["path"] == root, F.lit("")).otherwise(F.concat(n["path"], F.lit("_")))
        kids = F.coalesce(F.try_variant_get(n["node"], f"$.{children}", "array<variant>"), no_kids)
        return F.transform(kids, lambda k, i: F.struct(F.concat(prefix, i.cast("string")).alias("path"), n["path"].alias("parent"), k.alias("node")))

    path = F.col("_path") if resumed else F.lit(root)
    parent = F.col("_parent") if resumed else F.lit(None).cast("string")
    top = F.struct(path.alias("path"), parent.alias("parent"), F.col("_node").alias("node"))
    out = df.withColumn("_node", F.try_parse_json(F.col(payload))).filter(F.col("_node").isNotNull())
    out = out.select(*base, F.array(top).alias("_l0"))
    for d in range(depth):
        out = out.withColumn(f"_l{d + 1}", F.flatten(F.transform(f"_l{d}", kids_of)))
    return out, F.concat(*[F.col(f"_l{d}") for d in range(depth + 1)])


def _tree_rows(df: DataFrame, exploded: DataFrame, payload: str, children: str, node_fields: dict[str, str], node: str | None) -> DataFrame:
    base = [c for c in df.columns if c != payload]
    fields = [F.try_variant_get("_n.node", f"$.{f}", "string").alias(n) for n, f in node_fields.items()]
    if node:
        plain = F.map_filter(F.try_variant_get("_n.node", "$", "map<string,variant>"), lambda k, _v: k != children)
        fields.append(F.to_json(plain).alias(node))
    return exploded.select(*base, F.col("_n.path").alias("trace_address"), F.col("_n.parent").alias("parent_address"), *fields)
