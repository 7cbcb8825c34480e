"""Chat formatting: conversations rebuilt from their event log, then rendered.

A log has one row per event: conversation, sequence number, message number, role,
kind and text.  Events of a message are folded in order of their sequence: a
``delta`` is appended, an ``edit`` replaces what stands, a ``regenerate`` starts
anew with its text, and a ``delete`` takes the message away.  Final messages stand
in order of message number and are rendered as turns:

    <turn role>\\n text </turn>\\n

Backslashes and the characters that begin control strings are escaped in roles and
texts (``\\`` as ``\\s``, ``<`` as ``\\l``, ``>`` as ``\\g``, ``#`` as ``\\h``), so no text can look like
a marker, and the escape is undone exactly.  Assistant texts are under the loss
mask, given as spans (start and length in code points) of the rendered text.

Events are shuffled once by conversation and message and folded there, then the
messages once by conversation: a task holds whole conversations, since one string
has to hold each.  DataFrame functions only.

Defined results: a null text is empty, a null role is the empty role, a null kind is
a delta; equal sequence numbers follow each other by kind, text and role; a message has the role of
its last event; a deleted one does not come back; rows without a conversation are one conversation; repeated
rows are events of their own; an empty log gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

OPEN, BETWEEN, CLOSE = "<turn ", ">\n", "</turn>\n"
ESCAPES = [("\\", "\\s"), ("<", "\\l"), (">", "\\g"), ("#", "\\h")]
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def log_of_turns(turns: DataFrame) -> DataFrame:
    """An event log of rows that are whole turns: (conv_id, turn, role, text), one delta each.

    Rows of a conversation are messages in order of turn, role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select(
        "conv_id", F.row_number().over(order).alias("message"), F.lit(1).alias("seq"), F.lit("delta").alias("kind"),
        "role", "text",
    )


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final messages of an event log."""
    log = events.select(
        "conv_id", "message",
        F.struct(
            F.col("seq").alias("seq"), F.coalesce("kind", F.lit("delta")).alias("kind"),
            F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"),
        ).alias("_event"),
    )
    grouped = log.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list("_event")).alias("_events"))
    last_from = F.coalesce(
        F.array_max(F.transform("_events", lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i))), F.lit(0)
    )
    deleted = F.array_max(F.transform("_events", lambda e, i: F.when(e["kind"] == "delete", i)))
    standing = F.slice("_events", F.col("_from") + 1, F.size("_events"))
    return (
        grouped.withColumn("_from", last_from)
        .where(deleted.isNull())
        .select(
            "conv_id", "message", F.element_at("_events", -1)["role"].alias("role"),
            F.array_join(F.transform(standing, lambda e: e["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame, loss_role: str = LEARNED_ROLE) -> DataFrame:
    """(conv_id, formatted, loss_spans): one row per conversation; messages in order of their number."""
    turn = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(BETWEEN), escaped(F.col("text")), F.lit(CLOSE))
    made = messages.select(
        "conv_id",
        F.struct(
            F.col("message").alias("message"), turn.alias("turn"), F.length(turn).alias("size"),
            F.length(escaped(F.col("text"))).alias("text_size"), (F.col("role") == loss_role).alias("loss"),
        ).alias("_turn"),
    )
    rows = made.groupBy("conv_id").agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))
    empty = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )
    spans = F.aggregate(
        "_turns", empty,
        lambda acc, t: F.struct(
            (acc["at"] + t["size"]).alias("at"),
            F.when(
                t["loss"],
                F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + t["size"] - t["text_size"] - len(CLOSE)).alias("start"), t["text_size"].alias("length"),
                ))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    return rows.select(
        "conv_id", F.array_join(F.transform("_turns", lambda t: t["turn"]), "").alias("formatted"),
        spans["spans"].alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a rendered conversation, as an array of role and text."""
    pieces = F.slice(F.split(formatted, OPEN), 2, 1 << 30)  # no text can hold the marker
    parted = lambda t: F.instr(t, BETWEEN)
    return F.transform(
        pieces,
        lambda t: F.struct(
            unescaped(F.substr(t, F.lit(1), parted(t) - 1)).alias("role"),
            unescaped(
                F.substr(t, parted(t) + len(BETWEEN), F.length(t) - parted(t) - len(BETWEEN) + 1 - len(CLOSE))
            ).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, read from the rendered text."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["length"]))), "")
