"""Conversations as training text, in DataFrame expressions only.

Template: a run of turns with the same role is one message::

    <|role|>user<|body|>first text<|turn|>second text<|end|>

Adjacent turns of a role merge; ``<|turn|>`` keeps them apart, so the turns can be read back.
Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a mark, and
undoing both gives the text again whatever it was.

Turns are ordered by turn number, ties by role and text; null texts are empty, null roles are
the empty role, a null turn number comes first. Conversations are formatted in segments of at
most ``SEGMENT`` turn numbers, each gathered and sorted by itself, so a very long conversation is
spread over tasks and only its finished segments meet. Where a segment starts with the role that
the one before ended with, its message goes on there.

The loss mask covers the texts of the trained role: for each segment the places (from 1) and
lengths, in code points, of the texts as formatted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isobar.llm.common import col, text_of

SEGMENT = 256
ROLE, BODY, TURN, END = "<|role|>", "<|body|>", "<|turn|>", "<|end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _segments(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, part, turns): sorted turns of each segment."""
    return turns.select(
        col(conv_col).alias("conv"),
        F.floor(col(turn_col) / SEGMENT).alias("part"),
        F.struct(col(turn_col).alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text")).alias("one"),
    ).groupBy("conv", "part").agg(F.sort_array(F.collect_list("one")).alias("turns"))


def _runs(turns: Column) -> Column:
    """Adjacent turns of a role as struct(role, texts)."""
    empty = F.expr("CAST(array() AS ARRAY<STRUCT<role: STRING, texts: ARRAY<STRING>>>)")

    def merge(done: Column, turn: Column) -> Column:
        last = F.element_at(done, -1)
        opened = F.array(F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts")))
        grown = F.array(F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts")))
        return (
            F.when(F.size(done) == 0, opened)
            .when(last["role"] == turn["role"], F.concat(F.slice(done, 1, F.size(done) - 1), grown))
            .otherwise(F.concat(done, opened))
        )

    return F.aggregate(turns, empty, merge)


def _pieces(runs: Column, trained: str) -> Column:
    """The segment as an array of struct(text, loss); the first message without its opening, the
    last without its end, so that the segment before or after may go on with it."""

    def message(run: Column, k: Column) -> Column:
        loss = run["role"] == F.lit(trained)
        opening = F.when(
            k > 0, F.array(_piece(F.concat(F.lit(END + ROLE), escaped(run["role"]), F.lit(BODY)), F.lit(False)))
        ).otherwise(F.expr("CAST(array() AS ARRAY<STRUCT<text: STRING, loss: BOOLEAN>>)"))
        texts = F.transform(
            run["texts"],
            lambda t, j: F.array(_piece(F.when(j > 0, F.lit(TURN)).otherwise(F.lit("")), F.lit(False)), _piece(escaped(t), loss)),
        )
        return F.concat(opening, F.flatten(texts))

    return F.filter(F.flatten(F.transform(runs, message)), lambda p: F.length(p["text"]) > 0)


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _spans(pieces: Column) -> Column:
    """Place and length of each piece under the loss mask."""
    start = F.struct(
        F.lit(1).cast("long").alias("next"),
        F.expr("CAST(array() AS ARRAY<STRUCT<start: BIGINT, length: BIGINT>>)").alias("spans"),
    )

    def step(done: Column, piece: Column) -> Column:
        n = F.length(piece["text"]).cast("long")
        span = F.array(F.struct(done["next"].alias("start"), n.alias("length")))
        spans = F.when(piece["loss"], F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct((done["next"] + n).alias("next"), spans.alias("spans"))

    return F.aggregate(pieces, start, step)["spans"]


def format_conversations(
    turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", trained: str = "assistant",
) -> DataFrame:
    """Per conversation (conv, segments): ``segments`` are struct(text, spans) in order. The
    formatted text is that of all segments, one after the other."""
    parts = _segments(turns, conv_col, turn_col, role_col, text_col).withColumn("runs", _runs(F.col("turns")))
    parts = parts.select(
        "conv", "part",
        F.col("runs")[0]["role"].alias("first"),
        F.element_at("runs", -1)["role"].alias("last"),
        _pieces(F.col("runs"), trained).alias("pieces"),
    )
    parts = parts.select(
        "conv",
        F.struct(
            "part", "first", "last", F.array_join("pieces.text", "").alias("text"), _spans(F.col("pieces")).alias("spans")
        ).alias("segment"),
    )
    whole = parts.groupBy("conv").agg(F.sort_array(F.collect_list("segment")).alias("s"))

    def close(s: Column, k: Column) -> Column:
        """Put before a segment what lies between it and the one before, and end the last."""
        before = F.get(F.col("s"), k - 1)
        opening = (
            F.when((k > 0) & (before["last"] == s["first"]), F.lit(TURN))
            .otherwise(F.concat(F.when(k > 0, F.lit(END)).otherwise(F.lit("")), F.lit(ROLE), escaped(s["first"]), F.lit(BODY)))
        )
        shift = F.length(opening).cast("long")
        spans = F.transform(
            s["spans"], lambda p: F.struct((p["start"] + shift).alias("start"), p["length"].alias("length"))
        )
        ending = F.when(k == F.size("s") - 1, F.lit(END)).otherwise(F.lit(""))
        return F.struct(F.concat(opening, s["text"], ending).alias("text"), spans.alias("spans"))

    return whole.select(F.col("conv").alias(conv_col), F.transform("s", close).alias("segments"))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """What the mask covers, in order, as it was before it was formatted."""
    covered = F.flatten(
        F.transform(
            segments,
            lambda s: F.transform(
                s["spans"], lambda p: F.substring(s["text"], p["start"].cast("int"), p["length"].cast("int"))
            ),
        )
    )
    return F.array_join(F.transform(covered, unescaped), "")


def parsed(text: Column) -> Column:
    """The turns of a formatted text as an array of struct(role, text)."""
    messages = F.slice(F.split(text, r"<\|role\|>"), 2, 1 << 30)

    def turns(message: Column) -> Column:
        halves = F.split(message, r"<\|body\|>", 2)
        body = F.substring(halves[1], F.lit(1), F.length(halves[1]) - len(END))
        return F.transform(
            F.split(body, r"<\|turn\|>"),
            lambda t: F.struct(unescaped(halves[0]).alias("role"), unescaped(t).alias("text")),
        )

    return F.flatten(F.transform(messages, turns))
