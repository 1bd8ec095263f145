"""Chat formatting from an event log (operator 1).  DataFrame functions only.

A log row is (conv_id, block, message, seq, event, role, text), where ``message``
orders the conversation's messages and ``block``, a coarser key that rises with
it, keeps a hot conversation from meeting in one place early:

    open        the message exists; role is its speaker
    delta       text streamed onto the message
    edit        the message's text becomes this text
    regenerate  the message's text so far is dropped

Events are folded per message by seq: everything before the last edit or
regenerate is superseded, what follows is joined.  Messages are then rendered
and joined per block, and blocks per conversation, so a conversation with very
many messages reaches its one output row as few large pieces.  A log that is
partitioned by (conv_id, block) is shuffled once more only, for the last step.

The template is <|im_start|>role, newline, text, <|im_end|>, newline.  Inside
texts a backslash goes in after every "<" that is followed by "|" or a
backslash, so no control string can appear and taking out the backslash after
"<" restores the text.

Defined results: null text is empty; null role is an empty role; null conv_id
is a conversation of its own; events with equal seq apply in the order
regenerate, edit, delta, then by text; an event without an open still makes
its message (role empty); an empty log gives an empty table; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
BLOCK = 256
EVENTS = ("open", "regenerate", "edit", "delta")  # order of events with equal seq


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(?=[|\\])", r"<\\")


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<\\"), F.lit("<"))


def escape_role(role: Column) -> Column:
    """Roles must also keep out of line ends."""
    out = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("\n"), F.lit("\\n"))
    return F.replace(out, F.lit("<"), F.lit("\\l"))


def unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\"), lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<")))
    return F.array_join(parts, "\\")


def folded(log: DataFrame) -> DataFrame:
    """conv_id, block, message, role, text: the final messages."""
    kind = F.array_position(F.array(*[F.lit(e) for e in EVENTS]), F.col("event"))
    event = F.struct(F.col("seq").alias("seq"), kind.alias("kind"),
                     F.coalesce("text", F.lit("")).alias("text"))
    opened = F.max(F.when(F.col("event") == "open", F.col("role")))
    grouped = log.groupBy("conv_id", "block", "message").agg(
        opened.alias("role"),
        F.array_sort(F.collect_list(F.when(F.col("event") != "open", event))).alias("events"))
    resets = F.transform("events", lambda e, i: F.when(e["kind"] < 4, i + 1).otherwise(0))
    last = F.coalesce(F.array_max(resets), F.lit(0))
    live = F.slice("events", F.greatest(last, F.lit(1)), F.greatest(F.size("events"), F.lit(1)))
    text = F.array_join(F.transform(live, lambda e: F.when(e["kind"] > 2, e["text"]).otherwise("")), "")
    return grouped.select("conv_id", "block", "message", F.coalesce("role", F.lit("")).alias("role"),
                          text.alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss_runs per conversation.

    ``loss_runs`` is the loss mask, one entry per turn: ``head`` code points
    outside the loss, ``body`` code points under it if ``loss``, ``tail``
    outside."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body, tail = escape(F.col("text")), F.lit(END + "\n")
    turn = F.struct(F.length(head).alias("head"), F.length(body).alias("body"),
                    F.length(tail).alias("tail"), (F.col("role") == LOSS_ROLE).alias("loss"))
    rows = messages.select("conv_id", F.col("message").alias("at"), "block",
                           F.concat(head, body, tail).alias("shown"), turn.alias("turn"))
    # Sorted by place and then by content, so ties give one result.
    parts = rows.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("at", "shown", "turn"))).alias("m"))
    parts = parts.select("conv_id", "block", F.struct(
        F.col("block").alias("block"),
        F.array_join(F.transform("m", lambda x: x["shown"]), "").alias("shown"),
        F.transform("m", lambda x: x["turn"]).alias("turns")).alias("p"))
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    turns = F.flatten(F.transform("ps", lambda p: p["turns"]))
    return whole.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        F.array_join(F.transform("ps", lambda p: p["shown"]), "").alias("formatted"),
        turns.alias("loss_runs"))


def formatted(log: DataFrame) -> DataFrame:
    """The log's conversations, folded and rendered."""
    return rendered(folded(log))


def block_of(turn: Column) -> Column:
    """Blocks of ``BLOCK`` consecutive turns."""
    return F.floor(turn / BLOCK)


def parsed(formatted: Column) -> Column:
    """array<struct<role, text>> read back from the output alone."""
    shown = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.slice(shown, F.lit(2), F.size(shown)), lambda t: F.struct(
        unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substring(t, F.locate("\n", t) + 1, F.length(t) - F.locate("\n", t)
                             - len(END) - 1)).alias("text")))


def under_loss(formatted: Column, loss_runs: Column) -> Column:
    """array<string>: per turn the unescaped text under the loss mask, ``body``
    code points after ``head`` of the turn's part of the output; "" outside."""
    shown = F.split(formatted, r"<\|im_start\|>")
    return F.zip_with(F.slice(shown, F.lit(2), F.size(shown)), loss_runs, lambda t, r: F.when(
        r["loss"], unescape(F.substring(t, r["head"] - len(START) + 1, r["body"]))).otherwise(""))


def turn_log(turns: DataFrame, chunk: int = 200) -> DataFrame:
    """An event log that replays a table of finished turns (conv_id, turn,
    role, text): every message is opened and streamed in deltas of ``chunk``
    code points; assistant messages get a draft first that is regenerated,
    other messages a draft that is edited away.  Rows with the same conv_id
    and turn are messages of their own, ordered by role and text."""
    text = F.coalesce("text", F.lit(""))
    key = Window.partitionBy("conv_id", "block", "turn").orderBy("role", "text")
    rows = (turns.select("conv_id", block_of(F.col("turn")).alias("block"), "turn", "role", text.alias("text"))
            .repartition("conv_id", "block").withColumn("nth", F.row_number().over(key)))
    n = F.greatest(F.ceil(F.length("text") / chunk).cast("int"), F.lit(1))
    deltas = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        (i + 3).alias("seq"), F.lit("delta").alias("event"),
        F.substring("text", i * chunk + 1, F.lit(chunk)).alias("text")))
    draft = F.reverse(F.substring("text", 1, 40))

    def event(seq: int, kind: str, value: Column) -> Column:
        return F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("event"), value.alias("text"))

    spoken = F.col("role") == LOSS_ROLE
    events = F.concat(
        F.array(event(0, "open", F.lit("")), event(1, "delta", draft),
                F.when(spoken, event(2, "regenerate", F.lit(""))).otherwise(event(2, "edit", F.lit("")))),
        deltas)
    return rows.select("conv_id", "block", F.struct("turn", "nth").alias("message"), "role",
                       F.explode(events).alias("e")).select("conv_id", "block", "message", "role", "e.*")
