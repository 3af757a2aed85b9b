"""Chat formatting with typed content parts.

A turn is a list of parts: text, image, audio or document. Visiting the parts in order
gives one string: text is escaped, every other part becomes a placeholder, and its
reference and token count are recorded. Turns are then framed by control strings, which no
escaped text can contain, so the formatted string reads back to the very turns. DataFrame
functions only. A conversation is one string and so is put together in one place; what is
gathered for it is that string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>\n"
KINDS = ("image", "audio", "document")
PART = "struct<kind:string,text:string,ref:string,tokens:long>"


def escape(text: Column) -> Column:
    """No control string is left: ``<|`` and the escape mark itself are rewritten."""
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(text, F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("&lt;|"), F.lit("<|"))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """A turn of one text part; null is empty."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("long").alias("tokens"),
        )
    ).cast(f"array<{PART}>")


def visit(parts: Column) -> tuple[Column, Column]:
    """The string of a turn's parts, and its attachments (kind, ref, tokens) in order.

    A part that is not text stands as ``<|kind|>``; an unknown or null kind counts as
    document. Null parts, and a null list, give nothing.
    """
    parts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    kind = lambda p: F.when(p["kind"].isin("text", *KINDS), p["kind"]).otherwise("document")
    string = F.array_join(
        F.transform(
            parts,
            lambda p: F.when(
                kind(p) == "text", escape(F.coalesce(p["text"], F.lit("")))
            ).otherwise(F.concat(F.lit("<|"), kind(p), F.lit("|>"))),
        ),
        "",
    )
    attached = F.transform(
        F.filter(parts, lambda p: kind(p) != "text"),
        lambda p: F.struct(
            kind(p).alias("kind"), p["ref"].alias("ref"),
            F.coalesce(p["tokens"], F.lit(1)).alias("tokens"),
        ),
    )
    return string, attached


def format_turns(
    turns: DataFrame, keys: list[str], turn_col: str = "turn", role_col: str = "role",
    parts_col: str = "parts", learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: keys, formatted, mask, attachments, n_tokens_attached.

    Turns stand in the order of ``turn_col``, nulls first, ties by role and content; equal
    rows are turns of their own. mask lists for each turn of the role ``learn`` its number,
    the start of its content in the whole string, and the length, in code points. An
    attachment carries its turn. Null keys are a conversation; an empty table gives none.
    """
    content, attached = visit(F.col(parts_col))
    order = Window.partitionBy(*keys).orderBy("turn", "role", "content")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        turns.select(
            *keys, F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            content.alias("content"), attached.alias("attached"),
        )
        .withColumn("head", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")))
        .withColumn("length", F.length("head") + F.length("content") + len(END))
        .withColumn("number", F.row_number().over(order))
        .withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)))
    )
    every = F.array_sort(
        F.collect_list(
            F.struct(
                "number",
                F.concat("head", "content", F.lit(END)).alias("piece"),
                (F.col("role") == learn).alias("learn"),
                (F.col("start") + F.length("head")).alias("start"),
                F.length("content").alias("length"),
                "attached",
            )
        )
    )
    packed = rows.groupBy(*keys).agg(every.alias("t"))
    return packed.select(
        *keys,
        F.array_join(F.col("t.piece"), "").alias("formatted"),
        F.transform(
            F.filter("t", lambda t: t["learn"]),
            lambda t: F.struct(t["number"].alias("turn"), t["start"].alias("start"), t["length"].alias("length")),
        ).alias("mask"),
        F.flatten(
            F.transform(
                "t",
                lambda t: F.transform(
                    t["attached"],
                    lambda a: F.struct(
                        t["number"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"),
                        a["tokens"].alias("tokens"),
                    ),
                ),
            )
        ).alias("attachments"),
    ).withColumn(
        "n_tokens_attached",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]),
    )


def read_back(formatted: DataFrame, keys: list[str]) -> DataFrame:
    """keys, turns (role, text) and learnt (texts under the mask), out of the string."""
    pieces = F.split("formatted", r"<\|im_start\|>")
    role = lambda p: F.substring_index(p, "\n", 1)
    body = lambda p: F.substring(p, F.length(role(p)) + 2, F.length(p) - F.length(role(p)) - 1 - len(END))
    return formatted.withColumn("p", F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))).select(
        *keys,
        "formatted",
        F.transform(
            "p",
            lambda p: F.struct(
                unescape_role(role(p)).alias("role"), unescape(body(p)).alias("text")
            ),
        ).alias("turns"),
        # A mask entry is cut out of its own turn's piece, so the work is one pass.
        F.transform(
            "mask",
            lambda m: unescape(
                F.substring(
                    F.element_at("p", m["turn"]),
                    F.length(role(F.element_at("p", m["turn"]))) + 2,
                    m["length"],
                )
            ),
        ).alias("learnt"),
    )
