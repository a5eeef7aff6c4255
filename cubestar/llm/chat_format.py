"""Chat formatting: turns become one training text with a loss mask.

Turns are collected as structs and sorted; adjacent turns of one role share a
header, and their texts are parts of one turn. Control strings inside texts and
roles get a backslash behind their first character and can be read back. Spark
expressions only.

A conversation is one training record and one row. Its turns are formatted in
blocks of ``BLOCK`` turn numbers first, so that a very long conversation is
sorted and joined by many tasks; only the finished blocks meet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 8

#: What may follow the first character of a control string.
_RESERVED = r"(\|[A-Za-z0-9_]{1,64}\|>|/?s>|/?INST\])"
_ESCAPE = r"([<\[])(\\*)" + _RESERVED
_UNESCAPE = r"([<\[])(\\*)\\" + _RESERVED


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings, each of the form ``<|name|>``."""

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    part: str = "<|part|>"
    end: str = "<|end|>"
    loss_roles: tuple[str, ...] = ("assistant",)


def escape(c) -> F.Column:
    return F.regexp_replace(c, _ESCAPE, r"$1$2\\$3")


def unescape(c) -> F.Column:
    return F.regexp_replace(c, _UNESCAPE, "$1$2$3")


def _starts(lengths) -> F.Column:
    """Running sums before each element of an array of longs."""
    return F.aggregate(
        lengths,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("all")),
        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
    )["all"]


def format_conversations(
    turns: DataFrame,
    template: ChatTemplate = ChatTemplate(),
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: conv, ``formatted``, ``loss_spans``.

    ``loss_spans`` lists (start, length) in code points of ``formatted``, one
    per text of a loss role, empty texts included. Rows are ordered by turn, null turns first, ties by
    role and text; repeated rows are kept. A null role or text is empty. Rows
    with a null conversation id form one conversation. Other columns are ignored,
    and an empty table gives no rows.
    """
    t = template
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.shiftright(F.col(turn).cast("long"), BLOCK_BITS).alias("block"),
        F.struct(
            F.col(turn).cast("long").alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    )
    blocks = rows.groupBy("conv", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    header = lambda r: F.concat(F.lit(t.turn), escape(r), F.lit(t.text))
    opening = lambda before, r: F.when(before == r, F.lit(t.part)).otherwise(
        F.concat(F.lit(t.end), header(r))
    )
    # The opening of a block's first turn depends on the block before it.
    blocks = blocks.withColumn(
        "pieces",
        F.transform(
            "rows",
            lambda x, i: F.struct(
                F.when(i == 0, F.lit("")).otherwise(
                    opening(F.get("rows", i - 1)["role"], x["role"])
                ).alias("opening"),
                escape(x["text"]).alias("body"),
                x["role"].isin(*t.loss_roles).alias("loss"),
            ),
        ),
    )
    at = _starts(
        F.transform("pieces", lambda p: (F.length(p["opening"]) + F.length(p["body"])).cast("long"))
    )
    blocks = blocks.select(
        "conv",
        F.struct(
            "block",
            F.get("rows", F.lit(0))["role"].alias("first"),
            F.element_at("rows", -1)["role"].alias("last"),
            F.array_join(F.transform("pieces", lambda p: F.concat(p["opening"], p["body"])), "").alias("body"),
            F.filter(
                F.transform(
                    F.arrays_zip("pieces", at.alias("at")),
                    lambda z: F.struct(
                        (z["at"] + F.length(z["pieces"]["opening"])).alias("start"),
                        F.length(z["pieces"]["body"]).cast("long").alias("length"),
                        z["pieces"]["loss"].alias("loss"),
                    ),
                ),
                lambda z: z["loss"],
            ).alias("spans"),
        ).alias("block"),
    )
    whole = blocks.groupBy("conv").agg(F.sort_array(F.collect_list("block")).alias("blocks"))
    whole = whole.withColumn(
        "openings",
        F.transform(
            "blocks",
            lambda b, i: F.when(i == 0, header(b["first"])).otherwise(
                opening(F.get("blocks", i - 1)["last"], b["first"])
            ),
        ),
    )
    zipped = F.arrays_zip("blocks", "openings")
    at = _starts(
        F.transform(zipped, lambda z: (F.length(z["openings"]) + F.length(z["blocks"]["body"])).cast("long"))
    )
    return whole.withColumn("at", at).select(
        F.col("conv").alias(conv),
        F.concat(
            F.array_join(F.transform(zipped, lambda z: F.concat(z["openings"], z["blocks"]["body"])), ""),
            F.lit(t.end),
        ).alias("formatted"),
        F.flatten(
            F.transform(
                F.arrays_zip("blocks", "openings", "at"),
                lambda z: F.transform(
                    z["blocks"]["spans"],
                    lambda s: F.struct(
                        (z["at"] + F.length(z["openings"]) + s["start"]).alias("start"),
                        s["length"].alias("length"),
                    ),
                ),
            )
        ).alias("loss_spans"),
    )


def _literal(control: str) -> str:
    return control.replace("|", r"\|")


def read_turns(formatted, template: ChatTemplate = ChatTemplate()) -> F.Column:
    """The (role, text) structs of a formatted text, unescaped, in order."""
    t = template
    runs = F.filter(F.split(formatted, _literal(t.turn), -1), lambda r, i: i > 0)

    def turns(run):
        body = F.substring(run, F.lit(1), F.length(run) - len(t.end))
        role = F.substring_index(body, t.text, 1)
        texts = F.substring(body, F.length(role) + len(t.text) + 1, F.length(body))
        return F.transform(
            F.split(texts, _literal(t.part), -1),
            lambda p: F.struct(unescape(role).alias("role"), unescape(p).alias("text")),
        )

    return F.flatten(F.transform(runs, turns))


def masked_text(formatted, spans) -> F.Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
            ),
        ),
        "",
    )
