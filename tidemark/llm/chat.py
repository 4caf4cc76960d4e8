"""Chat formatting with typed content parts.

A visitor flattens the parts of a turn (text, image, audio, document) into one body: text is escaped, every other
part becomes a placeholder numbered by its place in the turn, with an attachment reference and the count of tokens
it expands to. A turn is formatted on its own, so a conversation of any length is only ever a run of rows; the
reader walks that run with a constant amount of memory.

    <|im_start|>role
    body<|im_end|>

Inside roles and texts a backslash is written \\s and `<|` is written \\b (in roles also a line end as \\r), so
control strings of the template stand nowhere but where the template put them, and reading back is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"

#: Tokens that a part expands to.
IMAGE_BASE, IMAGE_TILE, TILE_SIDE = 85, 170, 512
AUDIO_PER_SECOND = 25
DOCUMENT_PER_PAGE = 1024

TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("\\b"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\r"))


def unescaped(text: str) -> str:
    return text.replace("\\b", "<|").replace("\\r", "\n").replace("\\s", "\\")


def text_tokens(text: Column) -> Column:
    """Words and single marks: a stand-in where no tokenizer is given."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("bigint")


def text_part(text: Column) -> Column:
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in (("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))


def _at_least_one(x: Column) -> Column:
    return F.greatest(F.coalesce(F.ceil(x), F.lit(1)), F.lit(1)).cast("bigint")


def _placeholder(p: Column, i: Column) -> Column:
    return F.concat(F.lit("<|"), p["kind"], F.lit("_"), (i + 1).cast("string"), F.lit("|>"))


#: For each kind what stands in the body and how many tokens it expands to.
VISITOR: dict[str, tuple[Callable[[Column, Column], Column], Callable[[Column], Column]]] = {
    "image": (_placeholder, lambda p: (IMAGE_BASE + IMAGE_TILE * _at_least_one(p["width"] / TILE_SIDE) * _at_least_one(p["height"] / TILE_SIDE)).cast("bigint")),
    "audio": (_placeholder, lambda p: _at_least_one(p["seconds"] * AUDIO_PER_SECOND)),
    "document": (_placeholder, lambda p: _at_least_one(p["pages"].cast("double")) * DOCUMENT_PER_PAGE),
}


def visit(parts: Column, tokens: Callable[[Column], Column] = text_tokens) -> Column:
    """array of (body, kind, uri, ordinal, tokens); a part of any other or no kind is text."""

    def one(p: Column, i: Column) -> Column:
        body, cost = escaped(p["text"]), tokens(p["text"])
        for kind, (draw, count) in VISITOR.items():
            body = F.when(p["kind"] == kind, draw(p, i)).otherwise(body)
            cost = F.when(p["kind"] == kind, count(p)).otherwise(cost)
        kind = F.when(p["kind"].isin(*VISITOR), p["kind"]).otherwise(F.lit("text"))
        return F.struct(body.alias("body"), kind.alias("kind"), p["uri"].alias("uri"), (i + 1).alias("ordinal"), cost.cast("bigint").alias("tokens"))

    return F.transform(F.coalesce(parts, F.array().cast(f"array<{PART}>")), one)


def format_turns(df: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str | None = None, text_col: str = "text", loss_role: str = "assistant", tokens: Callable[[Column], Column] = text_tokens) -> DataFrame:
    """conv_id, turn, formatted, loss_start, loss_end, attachments, n_tokens: a row for each input row.

    Content is the array in `parts_col`, else the text as a single part. A null text, role or array is empty.
    The loss covers the body of `loss_role` turns, in code points of `formatted`; elsewhere it is null.
    attachments: (ordinal, kind, uri, placeholder, tokens) in the order of the placeholders.
    """
    parts = F.col(parts_col) if parts_col else text_part(F.col(text_col))
    role = escaped_role(F.col(role_col))
    rows = df.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), visit(parts, tokens).alias("seen"))
    body = F.array_join(F.transform("seen", lambda p: p["body"]), "")
    rows = rows.withColumn("body", body)
    start = F.length("role") + len(START) + 1
    loss = F.col("role") == loss_role
    attachments = F.transform(F.filter("seen", lambda p: p["kind"] != "text"), lambda p: F.struct(p["ordinal"].alias("ordinal"), p["kind"].alias("kind"), p["uri"].alias("uri"), p["body"].alias("placeholder"), p["tokens"].alias("tokens")))
    return rows.select(
        "conv_id", "turn", F.concat(F.lit(START), "role", F.lit("\n"), "body", F.lit(END + "\n")).alias("formatted"),
        F.when(loss, start).alias("loss_start"), F.when(loss, start + F.length("body")).alias("loss_end"),
        attachments.alias("attachments"), F.aggregate("seen", F.lit(0).cast("bigint"), lambda a, p: a + p["tokens"]).alias("n_tokens"))


def conversations(turns: DataFrame) -> DataFrame:
    """Formatted turns dealt by conversation and in order: (turn, formatted). Written as text, a partition's
    `formatted` column joined is the training file."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")


def read_back(ordered: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted strings and the loss offsets alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars. Null ids are one conversation."""
    cols = ordered.select("conv_id", "formatted", "loss_start", "loss_end")
    names = cols.columns
    longs = ("n_turns", "loss_chars", "formatted_chars")
    schema = StructType([cols.schema["conv_id"], *[StructField(n, LongType() if n in longs else StringType()) for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")]])

    arrow = to_arrow_schema(schema)

    def batch_of(done: list) -> pa.RecordBatch:
        cells = [[c.hexdigest() if hasattr(c, "hexdigest") else c for c in row] for row in done]
        return pa.RecordBatch.from_pylist([dict(zip(arrow.names, row)) for row in cells], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None  # [id, turns, hash, loss characters, hash, characters]
        for batch in batches:
            done = []
            for conv, formatted, start, end in zip(*(batch.column(n).to_pylist() for n in names)):
                if open_ is None or open_[0] != conv:
                    if open_ is not None:
                        done.append(open_)
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in TURN.findall(formatted):
                    open_[1] += 1
                    open_[2].update(f"{unescaped(role)}\n{unescaped(body)}\n".encode())
                if start is not None:
                    lost = unescaped(formatted[start:end])
                    open_[3] += len(lost)
                    open_[4].update(lost.encode())
                open_[5] += len(formatted)
            yield batch_of(done)
        if open_ is not None:
            yield batch_of([open_])

    return cols.mapInArrow(run, schema)
