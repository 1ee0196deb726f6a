r"""Chat formatting by prefix-target expansion, by DataFrame functions only.

Each assistant turn becomes an example of its own: all turns before it as context, and only its own
text under the loss mask. What follows the last assistant turn, or a conversation without one, becomes
an example without target, so that no turn is lost.

A turn is written `<|turn|>role<|text|>text<|end|>`. Inside roles and texts a backslash is put behind
the first character of every control string, of this template and of common others (`<s>`, `</s>`,
`[INST]`, `[/INST]`, `<<SYS>>`, `<</SYS>>`, and anything that begins `<|`), also where backslashes
stand there already; taking one away again gives the text back exactly.

Defined cases: null roles and texts are empty; turns are ordered by number, then role, then text, so
ties and repeated rows have one order; a null id is a conversation like others; an empty table gives
none. The output is as large as the method asks for: it grows with the square of a conversation's
turns, and an example holds its whole context, so a conversation stays in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ASSISTANT = "assistant"

# What follows the first character of a control string, after backslashes.
_CONTROL = r"<(?=\\*(?:\||/?s>|</?SYS>>))|\[(?=\\*/?INST\])"
_ESCAPED = r"(<(?=\\+(?:\||/?s>|</?SYS>>))|\[(?=\\+/?INST\]))\\"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, f"({_CONTROL})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def formatted(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per example: the conversation's id, `place` of its last turn (from 1), the
    `formatted` text, and loss_start and loss_length of the trainable stretch in code points (null
    and 0 without target)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(
        F.col(id_col),
        F.col(turn_col).alias("_turn"),
        role.alias("_role"),
        text.alias("_text"),
        F.concat(F.lit(TURN), escaped(role), F.lit(TEXT)).alias("_head"),
        escaped(text).alias("_body"),
    )
    order = Window.partitionBy(id_col).orderBy("_turn", "_role", "_text")
    written = F.concat("_head", "_body", F.lit(END))
    rows = rows.select(
        id_col,
        "_role",
        "_head",
        "_body",
        F.row_number().over(order).alias("place"),
        F.lead("_role").over(order).isNull().alias("_last"),
        F.collect_list(written).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
    ).where(F.col("_last") | (F.col("_role") == ASSISTANT))
    target = F.col("_role") == ASSISTANT
    context = F.concat(F.array_join("_before", ""), F.col("_head"))
    return rows.select(
        id_col,
        "place",
        F.concat(context, F.col("_body"), F.lit(END)).alias("formatted"),
        F.when(target, F.char_length(context)).cast("bigint").alias("loss_start"),
        F.when(target, F.char_length("_body")).otherwise(0).cast("bigint").alias("loss_length"),
    )


def turns_of(text: Column) -> Column:
    """The turns of a formatted text, as an array of role and text."""
    pieces = F.slice(F.split(text, r"<\|turn\|>"), 2, 2_000_000_000)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, TEXT, 1)
        body = F.substring_index(F.substring_index(piece, TEXT, -1), END, 1)
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def target_of() -> Column:
    """The text under the loss mask of an example, as it was before formatting."""
    start = (F.coalesce("loss_start", F.lit(0)) + 1).cast("int")
    return unescaped(F.col("formatted").substr(start, F.col("loss_length").cast("int")))
