"""Chat logs to training text: fold events into final messages, render them by a template, and read them back.

DataFrame functions only.  An event has a conversation, a place in its sequence, a turn, a role, a text and a kind:

- ``message`` sets the turn's text, and a later one replaces it (a regeneration: kind ``regenerate`` does the same);
- ``delta`` appends to what the turn holds so far;
- ``edit`` replaces the turn's text and drops all later turns that are there by then, as a chat does when a user
  changes an earlier message.

A conversation's output is one row, so its turns have to meet in one task; its events need not: they are first folded
by turn with aggregates that combine before the shuffle where they can, and windows over a conversation stream and spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: Fixed values of the template: every control string begins with ``<``, which no escaped text holds.
OPEN, CLOSE, END = "<turn ", ">", "</turn>"
#: Escapes: a backslash and a letter for each character that has a meaning.
_ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
LOSS_ROLE = "assistant"

EVENTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()),
])


def escape(text: Column) -> Column:
    for plain, coded in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, role, text.

    Events of a conversation are taken in order of seq (ties by turn, kind, text, role).  Null kinds count as ``message``,
    null texts as empty, a null turn as a turn before all others; the role is the last one given that is not null.
    """
    e = events.select(
        "conv_id", "turn", "role", "seq", F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = ["seq", "turn", "kind", "text", "role"]
    conv = Window.partitionBy("conv_id").orderBy(*order)
    # An event is dropped by a later edit of an earlier turn: the lowest turn edited after it is below its own.
    later = conv.rowsBetween(1, Window.unboundedFollowing)
    e = e.withColumn("cut", F.min(F.when(F.col("kind") == "edit", F.coalesce("turn", F.lit(-(1 << 63))))).over(later))
    e = e.where(F.col("cut").isNull() | (F.coalesce("turn", F.lit(-(1 << 63))) <= F.col("cut")))
    turn = Window.partitionBy("conv_id", "turn").orderBy(*order)
    # A turn's text begins anew at each event that is not a delta; what came before the last such event is gone.
    e = e.withColumn("start", F.sum((F.col("kind") != "delta").cast("long")).over(
        turn.rowsBetween(Window.unboundedPreceding, 0)))
    last = e.withColumn("last", F.max("start").over(Window.partitionBy("conv_id", "turn")))
    last = last.withColumn("role", F.last("role", True).over(turn.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))
    kept = last.where("start = last")
    return kept.groupBy("conv_id", "turn", "role").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order[:4]))), lambda x: x["text"]), "")
        .alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (one flag per turn, true where the loss counts).

    A turn is ``<turn role>text</turn>``; role and text are escaped, so no text can look like a control string, and
    a null role or text is empty.  Turns of equal number come in order of role and text.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    shown = F.transform("turns", lambda t: F.concat(
        F.lit(OPEN), escape(t["role"]), F.lit(CLOSE), escape(t["text"]), F.lit(END)))
    return turns.select("conv_id", F.array_join(shown, "").alias("formatted"),
                        F.transform("turns", lambda t: t["role"] == LOSS_ROLE).alias("loss"))


def parse(formatted: DataFrame) -> DataFrame:
    """Read :func:`render`'s output back: conv_id, formatted, turns (role, text, loss), from the string alone and the flags."""
    pieces = F.split("formatted", END)
    split = formatted.select("conv_id", "formatted", "loss", F.slice(pieces, 1, F.size("loss")).alias("pieces"))
    turns = F.transform("pieces", lambda p, i: F.struct(
        unescape(F.substring_index(F.substring(p, len(OPEN) + 1, 1 << 30), CLOSE, 1)).alias("role"),
        unescape(F.substring_index(p, CLOSE, -1)).alias("text"), F.get("loss", i).alias("loss")))
    return split.select("conv_id", "formatted", turns.alias("turns"))


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold_events(events))


def events_of(conversations: DataFrame) -> DataFrame:
    """A table of whole messages as events: one message each, in order of turn.

    Rows that share a conversation and turn are messages of their own, so each gets a turn number of its own.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.row_number().over(order).cast("long").alias("seq"),
        F.row_number().over(order).cast("long").alias("turn"), "role", F.lit("message").alias("kind"), "text")


def query(spark, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = parse(format_chats(events_of(rows)))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    back = back.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"), text.alias("t"),
                       learnt.alias("l"))
    return back.select(
        "conv_id", "n_turns", F.sha2("t", 256).alias("turns_sha256"), F.length("l").cast("long").alias("loss_chars"),
        F.sha2("l", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
with c as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t as (
  select conv_id, count(*) as n_turns,
         string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' order by turn, role, text) as t,
         coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as l,
         sum(14 + length(coalesce(role, '')) + length(text)
             + length(regexp_replace(text || coalesce(role, ''), '[^\\<>]', '', 'g'))) as f
  from c group by conv_id
)
select conv_id, n_turns, sha256(t) as turns_sha256, length(l) as loss_chars, sha256(l) as loss_sha256,
       f::bigint as formatted_chars from t
"""
