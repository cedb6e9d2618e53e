"""Chat formatting: typed content parts become one marked string per conversation.

A turn is written as ``### role: body</turn>`` and a line break. A visitor, one
expression per part type, flattens the parts of a message into the body: text is
escaped, an image, audio or document part becomes a numbered placeholder. The
output carries what a trainer needs beside the string: runs of characters with
their loss flag, attachment references in order, and how many tokens the
placeholders stand for.

Escapes replace the first character of every control string, so ``<``, ``#`` and
(in roles) ``:`` occur in the template only and the string can be cut safely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLOSE = "</turn>\n"
# Fixed escapes; the backslash is escaped first and unescaped last.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))
# A part: type is text, image, audio or document; size is what its tokens follow
# from: pixels, seconds or pages.
PART = "struct<type:string,text:string,ref:string,size:bigint>"
# Tokens of an attachment: (units per step, tokens per step), rounded up, at least one step.
EXPANSION = {"image": (28 * 28, 1), "audio": (1, 25), "document": (1, 512)}


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    return F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(0).cast("bigint").alias("size"),
    )


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment takes in place of its placeholder; 0 for text."""
    count = F.lit(0).cast("bigint")
    for kind, (units, tokens) in EXPANSION.items():
        steps = F.greatest(
            F.ceil(F.coalesce(part["size"], F.lit(0)) / F.lit(units)), F.lit(1)
        )
        count = F.when(part["type"] == kind, steps * tokens).otherwise(count)
    return count


def visited(part: Column) -> Column:
    """The body text of one part. An unknown type counts as text."""
    is_attachment = F.coalesce(part["type"].isin(*EXPANSION), F.lit(False))
    return F.when(
        is_attachment, F.concat(F.lit("<"), part["type"], F.lit(">"))
    ).otherwise(escaped(F.coalesce(part["text"], F.lit(""))))


def format_conversations(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation from rows of (conv, turn, role, ``array<PART>``).

    Columns: ``conv``, ``n_turns``, ``formatted``, ``runs`` (per turn the characters
    of its head, body and close, and whether the body is learned), ``attachments``
    (type and reference in the order of their placeholders) and
    ``expanded_tokens``.

    Turns are ordered by ``turn`` (NULL first), equal ones by role, then content,
    so repeated rows stay and any input order gives the same output. A NULL role is an
    empty role, NULL parts an empty body. A NULL conversation id is a
    conversation of its own. Other columns are ignored. A conversation becomes one
    string, so its length is what bounds a task, as in the result itself.
    """
    items = messages.select(
        F.col(conv).alias("_conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.col(parts).alias("parts"),
        ).alias("_message"),
    )

    def attached_to(m: Column) -> Column:
        kept = F.filter(m["parts"], lambda p: F.coalesce(p["type"].isin(*EXPANSION), F.lit(False)))
        made = F.transform(
            kept,
            lambda p: F.struct(
                p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")
            ),
        )
        none = F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>")
        return F.coalesce(made, none)

    # sorted by what the parts say, then written down
    written = F.transform(
        F.array_sort(F.collect_list("_message")),
        lambda m: F.struct(
            m["role"].alias("role"),
            F.coalesce(F.array_join(F.transform(m["parts"], visited), ""), F.lit("")).alias("body"),
            attached_to(m).alias("attached"),
        ),
    )
    head = lambda m: F.concat(F.lit("### "), escaped(m["role"]), F.lit(": "))
    ordered = items.groupBy("_conv").agg(written.alias("_turns"))
    attached = F.flatten(F.transform("_turns", lambda m: m["attached"]))
    return ordered.select(
        F.col("_conv").alias(conv),
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.array_join(
            F.transform("_turns", lambda m: F.concat(head(m), m["body"], F.lit(CLOSE))), ""
        ).alias("formatted"),
        F.transform(
            "_turns",
            lambda m: F.struct(
                F.length(head(m)).alias("head"),
                F.length(m["body"]).alias("body"),
                F.lit(len(CLOSE)).alias("close"),
                (m["role"] == learn).alias("learned"),
            ),
        ).alias("runs"),
        F.transform(
            attached, lambda a: F.struct(a["type"].alias("type"), a["ref"].alias("ref"))
        ).alias("attachments"),
        F.aggregate(
            attached, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]
        ).alias("expanded_tokens"),
    )


def read_back(formatted: str = "formatted", runs: str = "runs") -> Column:
    """The turns of an output string: array of (role, text, learned).

    The string is cut at the close marks and each piece by its run; placeholders
    stay in the text as they were written.
    """
    pieces = F.split(F.col(formatted), CLOSE, -1)
    return F.zip_with(
        F.slice(pieces, 1, F.size(runs)),
        F.col(runs),
        lambda piece, run: F.struct(
            unescaped(F.substring(piece, F.lit(5), run["head"] - 6)).alias("role"),
            unescaped(F.substring(piece, run["head"] + 1, run["body"])).alias("text"),
            run["learned"].alias("learned"),
        ),
    )
