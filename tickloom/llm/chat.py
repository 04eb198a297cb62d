"""Chat formatting from an event log.

A conversation is a log of events: ``message`` opens a message with a role, ``delta``
appends text to it, ``edit`` replaces its text, ``regenerate`` empties it and takes back
every message opened after it so far. ``fold`` replays the log into final messages,
``render`` writes them with turn markers and a loss mask over assistant texts, ``parse``
reads them back.

Texts and roles are escaped so that no control string of this or other templates can
appear inside one: ``&``, ``<`` and ``[`` become entities, in roles line ends too.
Unescaping in the reverse order gives every text back.

Replaying is grouped by message, not by conversation. Only ``render`` gathers a
conversation, since its output is one value; what was taken back is found in the same
partitioning.

Defined cases: null texts and roles are empty, events of messages that were never opened
are dropped, events at one sequence number are ordered by kind and text, a conversation
without messages gives no row, an empty log gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn markers.
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: Escapes, applied in this order and undone in the reverse order.
ENTITIES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;")]
ROLE_ENTITIES = [*ENTITIES, ("\n", "&nl;")]

EVENT_KINDS = ("message", "delta", "edit", "regenerate")


def escape(c: Column, entities: list[tuple[str, str]] = ENTITIES) -> Column:
    for plain, entity in entities:
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def unescape(c: Column, entities: list[tuple[str, str]] = ENTITIES) -> Column:
    for plain, entity in reversed(entities):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return c


def fold(events: DataFrame) -> DataFrame:
    """conv_id, position, role, text of all final messages.

    ``events`` has conv_id, seq (any type with an order), kind, message (its key within
    the conversation), role and text. ``position`` orders the messages of a conversation.
    """
    opens = F.col("kind") == "message"
    resets = F.col("kind").isin("message", "edit", "regenerate")
    e = events.filter(F.col("kind").isin(*EVENT_KINDS)).select(
        "conv_id",
        "message",
        "kind",
        F.struct(F.col("seq").alias("s"), F.col("kind").alias("k"), F.col("text").alias("t")).alias("at"),
        F.when(opens, F.coalesce("role", F.lit(""))).alias("role"),
        F.when(F.col("kind") != "regenerate", F.coalesce("text", F.lit(""))).otherwise("").alias("text"),
    )
    per = e.groupBy("conv_id", "message").agg(
        F.min(F.when(opens, F.struct("at", "role"))).alias("opened"),
        F.max(F.when(resets, F.col("at"))).alias("reset"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("at"))).alias("again"),
        F.collect_list(F.struct("at", "text")).alias("parts"),
    )
    live = F.filter(F.array_sort("parts"), lambda p: p["at"] >= F.col("reset"))
    messages = per.filter(F.col("opened").isNotNull()).select(
        "conv_id",
        F.col("opened.at").alias("position"),
        F.col("opened.role").alias("role"),
        F.array_join(F.transform(live, lambda p: p["text"]), "").alias("text"),
        "again",
    )
    return _without_taken_back(messages)


def _without_taken_back(messages: DataFrame) -> DataFrame:
    """Drop messages after which an earlier message of the conversation was regenerated:
    the running maximum of regenerations before them lies after their own opening.

    ``render`` gathers a conversation anyway and reuses this shuffle.
    """
    before = Window.partitionBy("conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.max("again").over(before) > F.col("position"), F.lit(False))
    return messages.withColumn("_taken", taken).filter("not _taken").select("conv_id", "position", "role", "text")


def render(messages: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """conv_id, turns: the formatted turns in order, each with its span under the loss mask.

    The formatted conversation is the concatenation of ``turns.rendered``; ``loss_start``
    (from 0) and ``loss_length`` are code points within the turn, -1 and 0 without loss.
    """
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ENTITIES), F.lit("\n"))
    body = escape(F.col("text"))
    learned = F.col("role") == learn_from
    turn = F.struct(
        F.col("position").alias("position"),
        F.concat(head, body, F.lit(CLOSE)).alias("rendered"),
        F.when(learned, F.length(head)).otherwise(-1).alias("loss_start"),
        F.when(learned, F.length(body)).otherwise(0).alias("loss_length"),
    )
    turns = F.transform(F.array_sort(F.collect_list(turn)), lambda t: t.dropFields("position"))
    return messages.groupBy("conv_id").agg(turns.alias("turns"))


def parse(rendered: DataFrame) -> DataFrame:
    """conv_id, formatted_chars, turns (role, text) and losses (texts under the mask), read
    from the rendered turns alone."""

    def turn(t: Column) -> Column:
        inner = F.substring(t["rendered"], F.lit(len(OPEN) + 1), F.length(t["rendered"]) - len(OPEN) - len(CLOSE))
        role = F.substring_index(inner, "\n", 1)
        text = F.substring(inner, F.length(role) + 2, F.length(inner))
        return F.struct(unescape(role, ROLE_ENTITIES).alias("role"), unescape(text).alias("text"))

    masked = F.filter("turns", lambda t: t["loss_start"] >= 0)
    return rendered.select(
        "conv_id",
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda n, t: n + F.length(t["rendered"])).alias("formatted_chars"),
        F.transform("turns", turn).alias("turns"),
        F.transform(
            masked, lambda t: unescape(F.substring(t["rendered"], t["loss_start"] + 1, t["loss_length"]))
        ).alias("losses"),
    )
