"""Chat formatting whose output reads back as the same conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|n|>"
#: The role whose text is under the loss mask.
TRAINED = "assistant"
_CONTROL = r"<(\\*)\|"


def escape(text: Column) -> Column:
    """One backslash more in each ``<|``, ``<\\|``, ``<\\\\|`` ...: no control string is left."""
    return F.regexp_replace(text, _CONTROL, r"<\\$1|")


def unescape(text: Column) -> Column:
    """Takes the backslash away that escape() added; other text stays."""
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Like escape(); a line break, which would end the role, gets a control string."""
    return F.replace(escape(role), F.lit("\n"), F.lit(BREAK))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(BREAK), F.lit("\n")))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(rendered: Column) -> Column:
    """The turns of rendered text, as escaped: array of (role, text).

    The grammar: text = turn*; turn = START role newline text END newline. A turn ends
    at the first END newline; a null turn marks what the grammar does not allow.
    """
    pieces = F.split(rendered, r"<\|im_end\|>\n", -1)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)
    closed = F.element_at(pieces, -1) == ""

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        at = F.instr(body, "\n")
        text = F.substring(body, at + 1, F.length(body))
        fits = piece.startswith(START) & (at > 0) & ~body.contains(START) & ~body.contains(END)
        return F.when(fits, F.struct(F.substring(body, F.lit(1), at - 1).alias("role"), text.alias("text")))

    return F.when(closed, F.transform(turns, turn))


def _read_back(turn: Column) -> Column:
    return F.struct(unescape_role(turn["role"]).alias("role"), unescape(turn["text"]).alias("text"))


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, mask per conversation of rows (conv_id, turn, role, text).

    Turns stand in order of turn, then role and text; null text and role are empty, a
    null turn comes first, repeated rows are turns of their own, a null conv_id is one
    conversation. mask holds the trained spans of the output: (start, length) in code
    points from 0, in order.

    Every turn is rendered as it is and reparsed; where that does not give back the
    source, the turn is escaped. The whole output is then parsed again, and a
    conversation that still differs raises, so output always reads back identically.
    A conversation is one text, so its turns meet in one row; there is no other
    grouping. Empty input gives an empty result; other columns are ignored.
    """
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    source = F.struct(role.alias("role"), text.alias("text"))
    plain = parse(render(role, text))
    same = F.coalesce((F.size(plain) == 1) & (_read_back(F.get(plain, F.lit(0))) == source), F.lit(False))
    turns = conversations.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.when(same, render(role, text)).otherwise(render(escape_role(role), escape(text))).alias("rendered"),
    )
    whole = (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("turns"))
        .withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["rendered"]), ""))
        .withColumn("parsed", parse(F.col("formatted")))
    )
    identical = F.transform("parsed", _read_back) == F.transform(
        "turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    )
    spans = F.aggregate(
        "parsed",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("mask")),
        lambda state, t: F.struct(
            (state["at"] + len(START) + F.length(t["role"]) + 1 + F.length(t["text"]) + len(END) + 1).alias("at"),
            F.when(
                unescape_role(t["role"]) == TRAINED,
                F.concat(
                    state["mask"],
                    F.array(
                        F.struct(
                            (state["at"] + len(START) + F.length(t["role"]) + 1).cast("long").alias("start"),
                            F.length(t["text"]).cast("long").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(state["mask"])
            .alias("mask"),
        ),
    )
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.when(F.coalesce(identical, F.lit(False)), F.col("formatted"))
        .otherwise(F.raise_error(F.concat(F.lit("does not read back: conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
        .alias("formatted"),
        spans["mask"].alias("mask"),
    )


def turns_of(text: Column) -> Column:
    """The turns that a formatted text holds, unescaped: array of (role, text)."""
    return F.transform(parse(text), _read_back)


def trained_texts(text: Column, mask: Column) -> Column:
    """The texts under the mask, unescaped."""
    return F.transform(mask, lambda s: unescape(F.substring(text, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
