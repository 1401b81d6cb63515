"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events in a sequence. ``message`` opens a message with a role
and a text, ``delta`` appends streamed text to it, ``edit`` replaces its text from there
on, and ``regenerate`` discards what it has so that deltas start anew. Logs are partitioned
by conversation and message, sorted by sequence and folded into final messages; messages
are folded into a conversation, which is rendered with a template. The folds are
aggregations of sorted arrays: a message's events come together first, so a conversation's
events never meet in one place, only its final messages do, as one formatted text.

Template: ``<|role|>``, a line feed, the text, ``<|end|>``, a line feed. In texts and roles
``&``, ``<`` and ``[`` are written as ``&amp;``, ``&lt;`` and ``&#91;``, so neither the marks
of this template nor control strings of others occur in them, and reading restores them.
The loss mask has a run for each turn: code points to skip from the turn's start, and code
points that count, which are the assistant's text.

Defined cases: a null text is empty, a null role is an empty role; rows without a
conversation form one; events of one sequence number are ordered by kind and text; events of
a message that was never opened belong to a message with an empty role, which stands where
its first event does; repeated conversation rows are turns of their own; an empty table
gives an empty result; further columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&#91;"))


def unescaped(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("&#91;"), F.lit("[")), F.lit("&lt;"), F.lit("<"))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def _role_escaped(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("|"), F.lit("&#124;")), F.lit("\n"), F.lit("&#10;"))


def _role_unescaped(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("&#10;"), F.lit("\n")), F.lit("&#124;"), F.lit("|")))


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, at, role, text) of (conv_id, seq, message, kind, role, text)."""
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))
    logs = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    opened = F.filter("log", lambda e: e["kind"] == "message")
    # What a message says is said from its last opening, edit or regeneration on.
    last = F.array_max(
        F.transform(F.filter("log", lambda e: e["kind"] != "delta"), lambda e: F.struct(e["seq"], e["kind"], e["text"]))
    )
    held = F.filter(
        "log", lambda e: F.col("last").isNull() | (F.struct(e["seq"], e["kind"], e["text"]) >= F.col("last"))
    )
    said = F.array_join(F.transform(held, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(e["text"])), "")
    return logs.withColumn("last", last).select(
        "conv_id",
        F.coalesce(F.get(opened, F.lit(0))["seq"], F.get("log", F.lit(0))["seq"]).alias("at"),
        F.coalesce(F.get(opened, F.lit(0))["role"], F.lit("")).alias("role"),
        said.alias("text"),
    )


def formatted(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask): the rendered text and its loss mask of every conversation."""
    head = F.concat(F.lit("<|"), _role_escaped(F.col("role")), F.lit("|>\n"))
    body = escaped(F.col("text"))
    turns = messages(events).select(
        "conv_id",
        "at",
        F.concat(head, body, F.lit("<|end|>\n")).alias("turn"),
        F.length(head).alias("skip"),
        F.when(F.col("role") == ASSISTANT, F.length(body)).otherwise(0).alias("count"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "turn", "skip", "count"))).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(
            "turns", lambda t: F.struct(t["skip"].alias("skip"), t["count"].alias("count"))
        ).alias("mask"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, turns, loss) from (conv_id, formatted, mask): the turns' roles and texts,
    and all text under the mask, unescaped."""
    index = lambda p: F.call_function("substring_index", p, F.lit("|>\n"), F.lit(1))

    def turn(piece: Column) -> Column:
        head = index(piece)
        role = _role_unescaped(F.substr(head, F.lit(3)))
        text = unescaped(F.substr(piece, F.length(head) + 4))
        return F.struct(role.alias("role"), text.alias("text"))

    split = F.split("formatted", r"<\|end\|>\n")
    pieces = F.slice(split, 1, F.size(split) - 1)
    under = F.zip_with("pieces", "mask", lambda p, m: F.substr(p, m["skip"] + 1, m["count"]))
    return rendered.withColumn("pieces", pieces).select(
        "conv_id",
        F.transform("pieces", turn).alias("turns"),
        unescaped(F.array_join(under, "")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def log_of_turns(conversations: DataFrame) -> DataFrame:
    """Events of stored turns (conv_id, turn, role, text): each text streamed line by line."""
    alike = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    turns = conversations.select(
        "conv_id", "turn", F.row_number().over(alike).alias("nth"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    parts = F.posexplode(F.split("text", r"(?<=\n)")).alias("part", "piece")
    parts = turns.select("conv_id", "turn", "nth", "role", parts)
    return parts.select(
        "conv_id",
        F.struct("turn", "nth", "part").alias("seq"),
        F.struct("turn", "nth").alias("message"),
        F.when(F.col("part") == 0, "message").otherwise("delta").alias("kind"),
        F.when(F.col("part") == 0, F.col("role")).alias("role"),
        F.col("piece").alias("text"),
    )


def digest(rendered: DataFrame) -> DataFrame:
    """Counts and checksums of what is read back."""
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read_back(rendered).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
