r"""Chat formatting whose output is proved by reading it back (operator 13).

Grammar of a formatted conversation, over the control strings ``<s>``, ``</s>``,
``[INST]`` and ``[/INST]``::

    conversation := <s> turn*
    turn         := [INST] role [/INST] text </s>        (one space inside each header gap)

``reparsed`` is its deterministic parser: it splits at ``</s>``, takes role and
text of each turn and undoes the escapes; a string that holds a control string
anywhere else is not in the grammar and gives null.

A turn is first rendered as it is and parsed back. Where that does not give the
source's role and text again (the text holds a control string, or something that
looks like an escape), its content is escaped and the turn parsed again: a
backslash goes between the bracket and the rest of each control string, and one
more where there are some already, so reading back takes one away. The whole
conversation is then parsed once more and held against its source rows; a
difference is an error, never a wrong row.

Only DataFrame and SQL functions are used. One shuffle, by conversation, serves
the running offsets, the grouping and the proof. A conversation is one output
row, so one task holds it whole; turns are rendered and checked before that.

Cases: a null text or role is the empty one; rows of a conversation go by
(turn, role, text), so ties have one order and repeated rows are repeated turns;
rows without a ``conv_id`` are one conversation of a null id, those without a
``turn`` come first; no row gives no conversation; any role is allowed, and only
``LOSS_ROLE`` is under the loss mask; very long texts are rendered whole (one
string of Spark bounds a conversation); columns beyond the four are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"
START, END = "<s>", "</s>"
CONTROL = r"<s>|</s>|\[INST\]|\[/INST\]"
TURN = r"(?s)^\[INST\] (.*?) \[/INST\] (.*)$"


def escaped(text: Column) -> Column:
    """One backslash more inside everything that is a control string but for backslashes."""
    return F.regexp_replace(text, r"\[(?=\\*/?INST\])|<(?=\\*/?s>)", r"$0\\")


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given."""
    return F.regexp_replace(text, r"(?<=\[)\\(?=\\*/?INST\])|(?<=<)\\(?=\\*/?s>)", "")


def turn_segments(formatted: Column) -> Column:
    """The turns of a formatted conversation without their end marks, and the empty string behind the last."""
    return F.split(F.substr(formatted, F.lit(len(START) + 1)), END)


def reparsed(formatted: Column) -> Column:
    """``array<struct<role,text>>`` of a formatted conversation; null where it is not in the grammar."""
    segments = turn_segments(formatted)
    turns = F.slice(segments, F.lit(1), F.size(segments) - 1)
    well_formed = lambda s: F.regexp_like(s, F.lit(TURN)) & (F.regexp_count(s, F.lit(CONTROL)) == 2)
    read = lambda s: F.struct(
        unescaped(F.regexp_extract(s, TURN, 1)).alias("role"), unescaped(F.regexp_extract(s, TURN, 2)).alias("text")
    )
    whole = F.startswith(formatted, F.lit(START)) & (F.element_at(segments, -1) == "") & F.forall(turns, well_formed)
    return F.when(whole, F.transform(turns, read))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("[INST] "), role, F.lit(" [/INST] "), text, F.lit(END))


def reads_back(turn: Column, role: Column, text: Column) -> Column:
    """Whether a rendered turn alone parses to the role and text it came from."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    return F.coalesce(reparsed(F.concat(F.lit(START), turn)) == source, F.lit(False))


def rendered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, rendered, body``: each row as it goes into its conversation.

    ``body`` is the text as it stands in ``rendered``, escaped or not.
    """
    role, text = F.col("role"), F.col("text")
    rows = conversations.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    clear = rows.withColumn("clear", reads_back(rendered(role, text), role, text))
    safe = clear.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.when(F.col("clear"), role).otherwise(escaped(role)).alias("head"),
        F.when(F.col("clear"), text).otherwise(escaped(text)).alias("body"),
        "clear",
    ).withColumn("rendered", rendered(F.col("head"), F.col("body")))
    proved = F.col("clear") | reads_back(F.col("rendered"), role, text)
    failed = F.raise_error(F.lit("an escaped turn does not read back as its source"))
    return safe.select(
        "conv_id", "turn", "role", "text", F.when(proved, F.col("rendered")).otherwise(failed).alias("rendered"), "body"
    )


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, formatted, text_spans`` of each conversation.

    ``text_spans`` has the place of each turn's text in ``formatted`` (code
    points, end exclusive, in order) with ``loss``: whether the loss mask covers
    it.
    """
    width = F.length("rendered")
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rendered_turns(conversations)
        .withColumn("at", F.coalesce(F.sum(width).over(before), F.lit(0)) + len(START))
        .withColumn("end", F.col("at") + width - len(END))
    )
    turn = F.struct("at", "role", "text", "end", "rendered", F.length("body").alias("chars"))
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.transform(
        "turns",
        lambda t: F.struct(
            (t["end"] - t["chars"]).alias("start"), t["end"].alias("end"), (t["role"] == LOSS_ROLE).alias("loss")
        ),
    )
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    out = grouped.select(
        "conv_id",
        F.concat(F.lit(START), F.array_join(F.transform("turns", lambda t: t["rendered"]), "")).alias("formatted"),
        spans.alias("text_spans"),
        source.alias("source"),
    )
    same = F.coalesce(reparsed(F.col("formatted")) == F.col("source"), F.lit(False))
    failed = F.raise_error(F.lit("a formatted conversation does not read back as its source"))
    return out.select("conv_id", F.when(same, F.col("formatted")).otherwise(failed).alias("formatted"), "text_spans")


def loss_text(formatted: Column, text_spans: Column) -> Column:
    """All text under the loss mask, unescaped.

    Each span is cut from its own turn, so the work is linear in the length.
    """

    def cut(segment: Column, i: Column) -> Column:
        span = F.get(text_spans, i)
        begins = F.coalesce(F.get(text_spans, i - 1)["end"] + len(END), F.lit(len(START)))
        place, chars = (span["start"] - begins + 1).cast("int"), (span["end"] - span["start"]).cast("int")
        return F.when(span["loss"], unescaped(F.substr(segment, place, chars))).otherwise("")

    return F.array_join(F.transform(turn_segments(formatted), cut), "")


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, taken from them alone."""
    lines = F.transform(
        reparsed(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    read = formatted.select(
        "conv_id",
        lines.alias("lines"),
        loss_text(F.col("formatted"), F.col("text_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return read.select(
        "conv_id",
        F.size("lines").cast("long").alias("n_turns"),
        F.sha2(F.array_join("lines", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
