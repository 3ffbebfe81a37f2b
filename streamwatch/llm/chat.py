"""Chat logs to formatted conversations, by replaying their events.

A log has one row per event: conversation, message, sequence, operation, role, text.

* ``delta`` adds text to the message (a streamed piece, or all of it),
* ``edit`` replaces what the message says,
* ``regenerate`` throws away what the message says; its text, if any, starts the new answer.

Events are partitioned by conversation and message, sorted by sequence and folded: a message
says what came since its last edit or regeneration. Messages, in their order, are rendered
into one string per conversation:

    <turn>ROLE#TEXT</turn>

Inside a role or text the control characters are written with letters: ``\\`` as ``\\s``, ``<``
as ``\\l``, ``#`` as ``\\h``. So ``<`` and ``#`` stand only where the template puts them, and every
text can be read back exactly. The output keeps the string in segments, each with its place in the loss
mask: the texts of the trained role are under it, what the template adds is not.

All of it is built-in functions. A conversation is one string of the output and so is put together
by one task; its events before are folded in groups of their own, one per message.

Rules: a null text or role is empty, a null operation is a delta. Events of equal sequence go by operation
and text. Repeated events count as often as they occur. A null conversation or message is a key like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<turn>", "#", "</turn>"


def escaped(text: Column) -> Column:
    for plain, written in (("\\", "\\s"), ("<", "\\l"), ("#", "\\h")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in (("#", "\\h"), ("<", "\\l"), ("\\", "\\s")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text: what each message says in the end. Its role is that of its first event
    with a role."""
    event = F.struct("sequence", F.coalesce("operation", F.lit("delta")).alias("operation"), F.coalesce("text", F.lit("")).alias("text"), "role")
    messages = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("events"))
    log = F.col("events")
    resets = F.transform(log, lambda e, k: F.when(e["operation"].isin("edit", "regenerate"), k).otherwise(-1))
    messages = messages.withColumn("last", F.greatest(F.array_max(resets), F.lit(0)))
    live = F.slice(log, F.col("last") + 1, F.size(log))
    roles = F.filter(F.transform(log, lambda e: e["role"]), lambda role: role.isNotNull())
    return messages.select(
        "conv_id",
        "message",
        F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"),
        F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
    )


def format_conversations(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, segments (text, loss). ``messages``: conv_id, message (their order), role, text."""
    turn = F.struct("message", "role", "text")
    rows = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def segments(turn: Column) -> Column:
        template = lambda text: F.struct(text.alias("text"), F.lit(False).alias("loss"))
        text = F.struct(escaped(turn["text"]).alias("text"), (turn["role"] == trained_role).alias("loss"))
        return F.array(template(F.concat(F.lit(OPEN), escaped(turn["role"]), F.lit(MIDDLE))), text, template(F.lit(CLOSE)))

    return rows.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text) and loss_text: what the output says, parsed back from it."""
    said = F.filter("segments", lambda segment: segment["loss"])
    rows = formatted.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda segment: segment["text"]), "").alias("formatted"),
        unescaped(F.array_join(F.transform(said, lambda segment: segment["text"]), "")).alias("loss_text"),
    )
    # the last piece is what stands behind the last turn: nothing
    pieces = rows.select("*", F.split("formatted", CLOSE, -1).alias("pieces"))
    turns = F.transform(
        F.slice("pieces", F.lit(1), F.size("pieces") - 1),
        lambda turn: F.struct(
            unescaped(F.replace(F.substring_index(turn, MIDDLE, 1), F.lit(OPEN), F.lit(""))).alias("role"),
            unescaped(F.substring_index(turn, MIDDLE, -1)).alias("text"),
        ),
    )
    return pieces.select("conv_id", "formatted", turns.alias("turns"), "loss_text")
