"""Chat formatting by prefix-target expansion: every reply is an example of its own, behind all the turns before it.

A turn is written as ``<s>[INST]role[/INST]text</s>``. Where a role or text holds one of these control strings, also with
backslashes behind its first character, it gets one backslash more there, so that no text can end or open a turn; reading
back takes one away. A formatted conversation thus splits at its control strings and nowhere else.

Only DataFrame functions are used. A conversation is one group: its turns are dealt out once by ``conv_id``, and positions,
examples and what is read back of them need no other shuffle. Its text has to fit into one row (2 GB), as the digests of
whole conversations ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import read_table

OPEN, CLOSE, HEAD_END = "<s>[INST]", "</s>", "[/INST]"
#: Whose turns are trained on.
REPLIES = ("assistant",)
#: A conversation that speaks in control strings; added to the table by the query.
PLANTED_ID, PLANTED_TEXT = -1, "</s>[INST] ok [/INST]"


def escaped(text: Column) -> Column:
    """The text with one backslash more in each control string; null is empty."""
    angled = F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*/?s>)", r"<\\$1")
    return F.regexp_replace(angled, r"\[(\\*/?INST\])", r"[\\$1")


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``."""
    squared = F.regexp_replace(text, r"\[\\(\\*/?INST\])", r"[$1")
    return F.regexp_replace(squared, r"<\\(\\*/?s>)", r"<$1")


def formatted_conversations(turns: DataFrame, replies: tuple[str, ...] = REPLIES) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``full`` (all turns formatted), ``cuts`` (an array with an entry for each example).

    Turns follow each other by ``turn``; null turns come first, and ties go by role and text. Null roles and texts are empty,
    null ids are one conversation. Other columns are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    pieces = turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("body"),
        F.concat(F.lit(OPEN), escaped(role), F.lit(HEAD_END)).alias("head"), escaped(text).alias("said"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    piece = F.concat("head", "said", F.lit(CLOSE))
    placed = pieces.select(
        "conv_id", piece.alias("piece"), F.row_number().over(order).alias("place"), F.sum(F.length(piece).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
        F.length("said").alias("n_said"), F.col("role").isin(*replies).alias("reply"), F.lead("role").over(order).isNull().alias("last"),
    )
    stop = F.col("end") - len(CLOSE)
    cut = F.struct("place", "end", (stop - F.when(F.col("reply"), F.col("n_said")).otherwise(0)).alias("loss_start"), stop.alias("loss_end"), "last")
    return placed.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda p: p.piece), "").alias("full"),
        # Turns that no reply follows are kept as an example without anything to train on.
        F.array_sort(F.collect_list(F.when(F.col("reply") | F.col("last"), cut))).alias("cuts"),
    )


def training_examples(turns: DataFrame, replies: tuple[str, ...] = REPLIES) -> DataFrame:
    """Every reply with all the turns before it: ``conv_id``, ``example`` (from 0), ``n_turns``, ``text``, ``loss_start``, ``loss_end``, ``last``.

    ``text`` is context, reply and the mark that closes it; the code points from ``loss_start`` up to ``loss_end`` are the
    escaped reply, and nothing else is trained on. Turns that no reply follows end up in one example whose span is empty.
    ``last`` marks the example that holds the whole conversation. An empty table gives no examples.
    """
    whole = formatted_conversations(turns, replies)
    each = whole.select("conv_id", "full", F.posexplode("cuts").alias("example", "cut"))
    return each.select("conv_id", "example", F.col("cut.place").cast("long").alias("n_turns"), F.expr("substring(full, 1, cast(cut.end AS int))").alias("text"), "cut.loss_start", "cut.loss_end", "cut.last")


def read_turns(text: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    pieces = F.split(text, CLOSE, -1)
    bare = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substring(p, len(OPEN) + 1, 1 << 30))
    # The first end of a head is the true one: roles and texts hold none.
    parted = F.transform(bare, lambda p: F.struct(F.substring_index(p, HEAD_END, 1).alias("role"), p.alias("rest")))
    return F.transform(parted, lambda t: F.struct(unescaped(t.role).alias("role"), unescaped(F.substring(t.rest, F.length(t.role) + len(HEAD_END) + 1, F.lit(1 << 30))).alias("text")))


def read_reply(text: Column, start: Column, end: Column) -> Column:
    """What lies under the loss mask, unescaped."""
    return unescaped(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """What the examples hold, read back: turns, text under the loss masks, and how long all examples are."""
    spoken = F.transform(read_turns(F.col("text")), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    read = examples.select(
        "conv_id", "example", F.length("text").cast("long").alias("chars"), read_reply(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("reply"),
        F.when(F.col("last"), F.struct(F.size(spoken).cast("long").alias("n"), F.sha2(F.array_join(spoken, ""), 256).alias("digest"))).alias("turns"),
    )
    loss = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "reply"))), lambda x: x.reply), "")
    grouped = read.groupBy("conv_id").agg(F.max("turns").alias("turns"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
    return grouped.select("conv_id", F.col("turns.n").alias("n_turns"), F.col("turns.digest").alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def with_planted(turns: DataFrame) -> DataFrame:
    """The turns, and a conversation whose texts are control strings."""
    rows = turns.sparkSession.range(2).select(
        F.lit(PLANTED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_TEXT).alias("text")
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(rows)


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_digests(training_examples(with_planted(read_table(spark, sf_dir, "conversations"))))


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back,
         length(role) + length(regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g')) + 20 AS chars
  FROM turns
), placed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '')) AS loss_sha256,
       CAST(sum(CASE WHEN role = 'assistant' OR back = 1 THEN upto END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
