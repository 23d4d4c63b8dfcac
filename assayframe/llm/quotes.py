"""Conversations linked by their quotations, in reply order and without the quotes.

A line that starts with one or more ``>`` (blanks between and after them allowed) is quoted,
as many levels deep as it has marks; the other lines are the message's own.  Consecutive
lines of one level form a passage, ended by a blank line too.  Passages are compared by a
hash of their text in lower case with white space reduced to single blanks.  A quoted
passage belongs to the message that has an equal passage of its own, or an equal single
line, and that stands earlier: by preference the latest one of the same conversation, else
the first of all conversations.  A passage without such a message (a trimmed quote, or
paragraphs run together) is looked up line by line in the same way, and belongs to the
message that has most of its text; only that text counts for the reply target.  Lines that
were wrapped anew match nothing.  The reply target is the message most of whose words are
quoted at the lowest quote level; without one it is the message before.

All work is joins on hashes.  Each side is reduced to one row per (conversation, hash) or
per hash before it is joined, so a very frequent line is one row, and long texts are not
shuffled for it.

Defined results: null text is empty; a null conversation id, turn or role is kept (nulls
are a conversation of their own, null turns come last); equal (conversation, turn) rows are
told apart by a hash of role and text, equal rows are merged for linking and all returned;
an empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.session import materialise

_MARKS = r"^\s{0,3}((?:>[ \t]?)++)"  # possessive: no recursion on long runs of marks
_BLANKS = " \t\n\x0b\f\r"
_NO_TURN = 1 << 62
_STRETCH = 4096


def parsed_lines(text: Column) -> Column:
    """array<struct<level, body>>: the lines of a text without quote marks; a blank line has level -1."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")

    def parsed(line: Column) -> Column:
        level = F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))
        body = F.regexp_replace(line, _MARKS, "")
        return F.struct(F.when(F.trim(body) == "", -1).otherwise(level).alias("level"), body.alias("body"))

    return F.transform(lines, parsed)


def passages(lines: Column) -> Column:
    """array<struct<level, body>>: the passages of a column of parsed lines, in order.

    A passage starts and ends where the level of the neighbouring line differs, so its lines
    are found by place and joined once, however many lines a text has.
    """
    def level(i: Column) -> Column:
        return F.get(lines, i)["level"]

    places = F.sequence(F.lit(0), F.size(lines) - 1)
    begin = F.filter(places, lambda i: (level(i) >= 0) & ~level(i).eqNullSafe(level(i - 1)))
    end = F.filter(places, lambda i: (level(i) >= 0) & ~level(i).eqNullSafe(level(i + 1)))
    return F.zip_with(begin, end, lambda b, e: F.struct(
        level(b).alias("level"),
        F.array_join(F.transform(F.slice(lines, b + 1, e - b + 1), lambda x: x["body"]), "\n").alias("body")))


def own_text(text: Column) -> Column:
    """The text without its quoted lines; their surroundings keep their line breaks."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")
    return F.btrim(F.array_join(F.filter(lines, lambda x: ~x.rlike(_MARKS)), "\n"), F.lit(_BLANKS))


def _normal(body: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(body), r"\s+", " "))


def _hash(body: Column) -> Column:
    return F.sha2(_normal(body), 256)


def linked(messages: DataFrame) -> DataFrame:
    """Per message: its quotes, its reply target and its place, as narrow columns.

    Input: conv_id, turn, role, text.  Output, one row per input row: conv_id, turn, role,
    own_text, quote_levels, n_quoted, n_linked, reply_conv, reply_turn, thread_id and
    position (the place in its thread, from 1; replies stand after what they answer).
    """
    rows = messages.select("conv_id", "turn", "role", "text").withColumns({
        "c": F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_TURN)),
        "t": F.coalesce(F.col("turn").cast("long"), F.lit(_NO_TURN)),
        "m": F.xxhash64(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))),
    })
    lines = rows.select("c", "t", "m", parsed_lines(F.col("text")).alias("lines"))
    parts = lines.select("c", "t", "m", F.posexplode(passages(F.col("lines"))).alias("n", "p")).select(
        "c", "t", "m", "n", "p.level", "p.body")
    # A passage as a whole (line -1), and each of its lines if it has several.
    pieces = F.when(F.contains("body", F.lit("\n")), F.concat(F.array("body"), F.split("body", "\n"))).otherwise(F.array("body"))
    quoted = parts.where("level > 0").select("c", "t", "m", "n", "level", F.posexplode(pieces).alias("line", "body"))
    quoted = materialise(quoted.select("c", "t", "m", "n", "level", (F.col("line") - 1).alias("line"), _hash(F.col("body")).alias("h"),
                                       F.length(_normal(F.col("body"))).alias("weight")), "quotes")
    asked = quoted.select("h").distinct()
    own = parts.where("level = 0").select("c", "t", F.explode(F.array_distinct(F.concat(
        F.array("body"), F.split("body", "\n")))).alias("body")).where(F.trim("body") != "") \
        .select("c", "t", _hash(F.col("body")).alias("h"))
    own = own.distinct().join(asked, "h", "left_semi")
    # The same conversation first: quotes and originals in one order, the latest one before.
    both = quoted.select("c", "h", "t", F.lit(1).alias("asks")).distinct().unionByName(
        own.select("c", "h", "t", F.lit(0).alias("asks")))
    seen = Window.partitionBy("c", "h").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max(F.when(F.col("asks") == 0, F.col("t"))).over(seen)) \
        .where("asks = 1").select("c", "h", "t", "near")
    first = own.groupBy("h").agg(F.min(F.struct("c", "t")).alias("first"))
    hits = quoted.join(near, ["c", "h", "t"], "left").join(first, "h", "left").withColumn(
        "to", F.when(F.col("near").isNotNull(), F.struct(F.col("c").alias("c"), F.col("near").alias("t")))
        .when(F.struct(F.col("first.c"), F.col("first.t")) < F.struct("c", "t"), F.col("first")))
    passage = ["c", "t", "m", "n"]
    owners = hits.where("line >= 0 AND to IS NOT NULL").groupBy(*passage, "to").agg(F.sum("weight").alias("owned"))
    owners = owners.groupBy(*passage).agg(F.min(F.struct(
        -F.col("owned"), (-F.col("to.c")).alias("nc"), (-F.col("to.t")).alias("nt"), "to", "owned")).alias("b")) \
        .select(*passage, F.col("b.to").alias("owner"), F.col("b.owned").alias("owned"))
    hits = hits.where("line = -1").join(owners, passage, "left").withColumns({
        "to": F.coalesce("to", "owner"), "weight": F.when(F.col("to").isNull(), F.col("owned")).otherwise(F.col("weight"))})
    votes = hits.where("to IS NOT NULL").groupBy("c", "t", "m", "level", "to").agg(
        F.sum("weight").alias("weight"))
    target = votes.groupBy("c", "t", "m").agg(F.min(F.struct(
        "level", -F.col("weight"), (-F.col("to.c")).alias("nc"), (-F.col("to.t")).alias("nt"), "to")).alias("b")) \
        .select("c", "t", "m", F.col("b.to").alias("to"))
    per = hits.groupBy("c", "t", "m").agg(
        F.max("level").alias("quote_levels"), F.count("*").alias("n_quoted"),
        F.count("to").alias("n_linked")).join(target, ["c", "t", "m"], "left")
    narrow = _numbered(rows.select("c", "t", "m").distinct(), "c").join(per, ["c", "t", "m"], "left")
    narrow = materialise(narrow.select(
        "c", "t", "m", F.coalesce("quote_levels", F.lit(0)).alias("quote_levels"),
        F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.coalesce(F.col("to.c"), F.when(F.col("prev").isNotNull(), F.col("c"))).alias("reply_c"),
        F.coalesce(F.col("to.t"), F.col("prev")).alias("reply_t")), "replies")
    roots = _roots(narrow)
    placed = narrow.join(roots, "c", "left").withColumn("thread", F.coalesce("root", "c"))
    placed = _numbered(placed.drop("root"), "thread").drop("prev")

    def shown(column: str) -> Column:
        return F.when(F.col(column) != _NO_TURN, F.col(column))

    return rows.join(placed, ["c", "t", "m"]).select(
        "conv_id", "turn", "role", own_text(F.col("text")).alias("own_text"),
        "quote_levels", "n_quoted", "n_linked", shown("reply_c").alias("reply_conv"),
        shown("reply_t").alias("reply_turn"), shown("thread").alias("thread_id"), "position")


def _numbered(rows: DataFrame, group: str) -> DataFrame:
    """Adds position (from 1, by c, t, m) and prev (the turn before) inside each group.

    A group is cut into stretches of one conversation and ``_STRETCH`` turns, which are
    numbered on their own and shifted by the sizes of earlier stretches, so that a very
    long conversation is not one task.  Shifts are summed inside ``_STRETCH`` conversation
    numbers first, so that a thread of very many conversations is not one task either.
    """
    rows = rows.withColumn("s", F.floor(F.col("t") / _STRETCH))
    parts = rows.groupBy(group, *[x for x in ("c", "s") if x != group]).agg(
        F.count("*").alias("n"), F.max("t").alias("end")).select(
        F.col(group).alias("g"), F.floor(F.col("c") / _STRETCH).alias("cs"), F.col("c").alias("gc"),
        F.col("s").alias("gs"), "n", "end")

    def before(window: Window) -> Column:
        return F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    wide = parts.groupBy("g", "cs").agg(F.sum("n").alias("n")).select(
        "g", "cs", before(Window.partitionBy("g").orderBy("cs")).alias("base"))
    near = Window.partitionBy("g", "cs").orderBy("gc", "gs")
    parts = parts.select("g", "cs", "gc", "gs", before(near).alias("shift"), F.lag("end").over(near).alias("end")) \
        .join(wide, ["g", "cs"]).withColumn("shift", F.col("shift") + F.col("base")).drop("cs", "base")
    inside = Window.partitionBy(*dict.fromkeys([group, "c", "s"])).orderBy("t", "m")
    found = rows.withColumns({"i": F.row_number().over(inside), "p": F.lag("t").over(inside)}).join(
        parts, F.expr(f"{group} = g AND c = gc AND s = gs"))
    return found.withColumns({
        "position": F.col("i") + F.col("shift"), "prev": F.coalesce("p", "end"),
    }).drop("s", "i", "p", "g", "gc", "gs", "shift", "end")


def _roots(replies: DataFrame) -> DataFrame:
    """The first conversation of the thread of each conversation that answers another.

    A conversation hangs on the smallest one that it answers.  Targets are always earlier,
    so pointers only fall, and doubling them ends after log2 of the longest chain.
    """
    up = replies.where("reply_c < c").groupBy("c").agg(F.min("reply_c").alias("root"))
    up = materialise(up, "threads")
    while True:
        higher = up.select(F.col("c").alias("root"), F.col("root").alias("above"))
        step = materialise(up.join(higher, "root", "left").select(
            "c", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "threads")
        up = step.drop("moved")
        if step.where("moved").isEmpty():
            return up
