"""Chat formatting by relational means: collected turns, runs of one role merged, text joined.

Native: every step is a DataFrame expression.

The template::

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n

Adjacent turns of one role become one block; ``<|im_sep|>`` keeps their borders, so that the turns
can be read back. In texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``; an escaped text holds no
``<|``, so no text can imitate a mark, and the escape is undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: the key, ``formatted`` and ``loss_spans``.

    ``loss_spans`` are (start, length) in code points of ``formatted``: the texts of the assistant.

    * Null text or role: empty. Null turn: sorts first. Rows with a null conversation id form one
      conversation. Repeated turns stay, ordered by role and text. No rows: no rows.
    * Other columns, whatever their names, are not read.
    * A conversation is one value of the result, so its turns meet in one row; everything else is
      dealt out by conversation.
    """
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    # A run starts where the role changes; every run becomes one block.
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    turns = turns.withColumn("starts", starts)
    blocks = F.transform(
        "starts",
        lambda s, j: F.struct(
            F.get("turns", s)["role"].alias("role"),
            F.transform(
                F.slice("turns", s + 1, F.coalesce(F.get("starts", j + 1), F.size("turns")) - s),
                lambda t: t["text"],
            ).alias("texts"),
        ),
    )
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["texts"],
                lambda t, k: F.struct(
                    F.when(k == 0, F.concat(F.lit(START), F.url_encode(b["role"]), F.lit("\n")))
                    .otherwise(F.lit(SEP))
                    .alias("before"),
                    escape(t).alias("body"),
                    F.when(k == F.size(b["texts"]) - 1, F.lit(END + "\n")).otherwise(F.lit("")).alias("after"),
                    (b["role"] == LEARNED_ROLE).alias("learned"),
                ),
            ),
        )
    )
    pieces = turns.withColumn("blocks", blocks).select("conv", F.posexplode(pieces).alias("pos", "p"))
    # Where each text stands: a running sum over the conversation; the rows are already dealt by it.
    piece = F.concat("p.before", "p.body", "p.after")
    before = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("at", F.coalesce(F.sum(F.length(piece)).over(before), F.lit(0)))
    span = F.when(
        F.col("p.learned"),
        F.struct((F.col("at") + F.length("p.before")).cast("int").alias("start"), F.length("p.body").alias("length")),
    )
    joined = placed.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("pos", piece.alias("piece"), span.alias("span")))).alias("all")
    )
    return joined.select(
        F.col("conv").alias(conv),
        F.array_join(F.col("all.piece"), "").alias("formatted"),
        F.filter(F.col("all.span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as they were: array of (role, text)."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda _, i: i > 0)

    def turns(block: Column) -> Column:
        role = F.url_decode(F.substring_index(block, "\n", 1))
        body = F.substring_index(F.substr(block, F.instr(block, "\n") + 1), END + "\n", 1)
        return F.transform(
            F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined in order."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), ""
    )
