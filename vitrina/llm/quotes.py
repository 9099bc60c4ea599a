"""Quotation linking: replies found by the passages they quote, conversations without quotes.

A line's quote level is the number of ``>`` marks that lead it.  A passage is a
line without its marks, lower-cased, with runs of anything but letters and digits as one blank.  The
original of a quoted passage is the last message before the quotation, in its folder, that has
it as a line of its own (level 0).  A message replies to the original that most of the
quoted words at its lowest linked level come from, the latest of them on equal counts, so a long line says more
about whom it answers than a "yes" does.

Hashed passages are made once and stored.  They are not joined: writers and quotations of a passage are laid in
order over range partitions, and each quotation takes the last writer before it, carried on from earlier
partitions where needed, so a phrase that everybody writes is no hot key.  Threads are found by doubling the reach
of reply links, so the number of steps grows with the logarithm of the longest thread, and no thread is gathered into one
task: the result is ordered by a range sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.common import checkpointed, kept, null_safe_join

_MARKS = r"^[\x20\t]*>(?:[\x20\t]*>)*"


def parsed_lines(text: Column) -> Column:
    """Array of (level, content) for the lines of a text; empty for null."""
    def line(x: Column) -> Column:
        return F.struct(F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 0), "[^>]", "")).alias("level"),
                        F.regexp_replace(x, _MARKS + r"\x20?", "").alias("content"))
    return F.when(F.coalesce(text, F.lit("")) != "", F.transform(F.split(text, "\r?\n"), line)).otherwise(F.array().cast("array<struct<level:int,content:string>>"))


def passage(content: Column) -> Column:
    """Normalised text of a line; null if it has no words."""
    norm = F.trim(F.regexp_replace(F.lower(content), r"[^\p{L}\p{N}]+", " "))
    return F.when(norm != "", norm)


def own_text(lines: Column) -> Column:
    """What the message itself says: its unquoted lines, without blank ones at either end."""
    text = F.array_join(F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["content"]), "\n")
    return F.regexp_replace(text, r"\A\s+|\s+\z", "")


def _last_writers(lines: DataFrame) -> DataFrame:
    """``(message_id, level, words, first)`` of each quoted line that has a writer before its quotation."""
    key, order = ["folder", "h1", "h2"], ["sent", "message_id", "writes"]
    events = lines.withColumn("writes", F.col("level") == 0)
    events = checkpointed(events.repartitionByRange(*key, *order).withColumn("part", F.spark_partition_id()))
    writer = F.when(F.col("writes"), F.struct("sent", "message_id"))
    so_far = Window.partitionBy("part", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = events.withColumn("here", F.last(writer, ignorenulls=True).over(so_far)).where("NOT writes")
    # only a passage that goes over the end of a partition has a writer to carry on; one row for each partition that it is in
    spans = events.groupBy(*key).agg(F.min("part").alias("one"), F.max("part").alias("end")).where("one < end").drop("one", "end")
    earlier = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = null_safe_join(events, spans, key).groupBy("part", *key).agg(F.max(writer).alias("end"))
    carried = kept(ends.select("part", *key, F.max("end").over(earlier).alias("carried")).where("carried IS NOT NULL"))
    return null_safe_join(seen, carried, ["part", *key], "left").select("message_id", "level", "words", F.coalesce("here", "carried").alias("first")).where("first IS NOT NULL")


def link_quotes(messages: DataFrame) -> DataFrame:
    """Reply links of ``messages`` (``message_id`` long, ``folder``, ``sent``, ``text``).

    Returns ``message_id, parent_id, level, passages``: the message replied to,
    the quote level that shows it, and how many lines are quoted from it there.  A message links only to earlier ones of its folder, by
    (sent, message_id).  Lines without a letter or digit link nothing.
    """
    lines = messages.select("message_id", "folder", "sent", F.explode(parsed_lines(F.col("text"))).alias("line")).select(
        "message_id", "folder", "sent", "line.level", passage(F.col("line.content")).alias("passage")).where("passage IS NOT NULL AND message_id IS NOT NULL")
    keyed = checkpointed(lines.select("message_id", "folder", "sent", "level", F.xxhash64("passage").alias("h1"), F.crc32(F.col("passage").cast("binary")).alias("h2"),
                                      F.size(F.split("passage", " ")).alias("words")))
    votes = _last_writers(keyed).groupBy("message_id", "level", "first").agg(F.sum("words").alias("words"), F.count("*").alias("passages"))
    # the lowest level first, then most words, then the latest message
    best = votes.groupBy("message_id").agg(F.max(F.struct((-F.col("level")).alias("up"), "words", "first", "passages")).alias("b"))
    return best.select("message_id", F.col("b.first.message_id").alias("parent_id"), (-F.col("b.up")).alias("level"), F.col("b.passages").alias("passages"))


def threads(links: DataFrame) -> DataFrame:
    """``(message_id, root_id, depth)`` of every message that has a parent, from ``(message_id, parent_id)``.

    Links lead to earlier messages, so there are no cycles.  Each step doubles
    the reach of the messages that have not met their root; the others rest.
    """
    active = kept(links.select("message_id", F.col("parent_id").alias("root_id"), F.lit(1).cast("long").alias("depth")))
    at_rest = None
    while True:
        known = active if at_rest is None else at_rest.unionByName(active)
        up = known.select(F.col("message_id").alias("u_id"), F.col("root_id").alias("u_root"), F.col("depth").alias("u_depth"))
        step = kept(active.join(up, F.col("root_id") == F.col("u_id"), "left").select(
            "message_id", F.coalesce("u_root", "root_id").alias("root_id"), (F.col("depth") + F.coalesce("u_depth", F.lit(0))).alias("depth"), F.col("u_id").isNotNull().alias("moved")))
        done = step.where("NOT moved").drop("moved")
        at_rest = done if at_rest is None else at_rest.unionByName(done)
        active = step.where("moved").drop("moved")
        if not active.limit(1).count():
            return at_rest


def conversations_from_quotes(messages: DataFrame) -> DataFrame:
    """Conversations in reply order: every message after the one it replies to.

    Returns, ordered by ``conversation_id`` (the first message's id), ``depth``
    (replies from there), ``sent``, ``message_id``: these and ``parent_id, folder, author, text``
    (without quotes) and ``n_quoted`` (quoted lines left out).  Null text is
    empty; a message without quotes that can be placed starts a conversation;
    a null id can't be linked and has a null conversation; rows that share an id
    have one parent; other columns are ignored; no rows give no rows.
    """
    m = messages.select(F.col("message_id").cast("long").alias("message_id"), "folder", "sent", "author", "text")
    links = kept(link_quotes(m))
    tree = threads(links)
    lines = m.withColumn("lines", parsed_lines(F.col("text"))).select(
        "message_id", "folder", "sent", "author", own_text(F.col("lines")).alias("text"), F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted"))
    placed = (lines.join(links.select(F.col("message_id").alias("l_id"), "parent_id"), F.col("message_id") == F.col("l_id"), "left")
              .join(tree.select(F.col("message_id").alias("t_id"), "root_id", F.col("depth").alias("t_depth")), F.col("message_id") == F.col("t_id"), "left"))
    return placed.select(F.coalesce("root_id", "message_id").alias("conversation_id"), F.coalesce("t_depth", F.lit(0)).cast("long").alias("depth"), "sent", "message_id", "parent_id",
                         "folder", "author", "text", "n_quoted").orderBy("conversation_id", "depth", "sent", "message_id")


def quoting_messages(turns: DataFrame) -> DataFrame:
    """Stand-in mail from ``(conv_id, turn, role, text)``: each turn quotes the whole turn before it, with that turn's own quote of the one before one level deeper."""
    t = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    back = lambda n: t.select(F.col("conv_id"), (F.col("turn") + n).alias("turn"), F.split("text", "\n").alias(f"back{n}"))
    both = t.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left")
    marked = lambda c, mark: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.concat(F.lit(mark), x))
    body = F.array_join(F.concat(marked("back2", "> > "), marked("back1", "> "), F.array("text")), "\n")
    return both.select((F.col("conv_id") * (1 << 20) + F.col("turn")).alias("message_id"), F.col("conv_id").alias("folder"), F.col("turn").alias("sent"), F.col("role").alias("author"), body.alias("text"))
