"""Chat formatting by quotation linking, in DataFrame functions only.

A line's quote level is the number of ``>`` marks before its text. Quoted lines
are normalised (marks and outer white space off, inner white space to one
space, lower case) and hashed; so are the unquoted lines of every message. A
quoted line is linked to the latest earlier message of its conversation that has
it as a line of its own, else to the first message anywhere that has it.

A message's parent is the message of its own conversation that most of its
level-1 lines are linked to (ties: the latest). Following parents leads to a
message's root. The reply-ordered conversation lists messages by (turn of the
root, turn), each without its quotes: a reply to an old message stands with the
thread it replies to, and a message without quotes is a thread's beginning.

The latest earlier message is found by a running maximum over (conversation,
line, turn), not by pairing quoting and quoted messages, and only lines that are
quoted somewhere take part. Messages come back one per row in conversation
order, so no conversation is gathered in one task; ``position`` is the sort key.

Defined results: null and empty texts have no lines. Lines that are blank after
normalisation link to nothing, and neither do quotes of later or equal turns of
the same conversation unless another conversation has the line. Rows that share
(conv_id, turn) are separate messages; a link to such a turn names the turn.
Rows without conv_id or turn are kept and never linked. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm import common

MARKS = r"^[\x20\t]*((?:>[\x20\t]*+)++)"
SPACE = r"[\x20\x09-\x0D]+"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def _normal(line: Column) -> Column:
    """The form of a line that is compared: no marks, one space between words, lower case."""
    return F.lower(F.btrim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), SPACE, " "), F.lit(" ")))


def _lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, h) of every line that is not blank."""
    return (messages.select("conv_id", "turn", F.explode(F.split("text", r"\r?\n", -1)).alias("line"))
            .select("conv_id", "turn", _level(F.col("line")).alias("level"), _normal(F.col("line")).alias("normal"))
            .where("normal != ''").select("conv_id", "turn", "level", F.xxhash64("normal").alias("h"), F.hash("normal").alias("h2")))


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, h, h2, from_conv, from_turn) of every distinct quoted line; null where it is nobody's."""
    lines = _lines(messages.where("conv_id is not null and turn is not null"))
    quoted = lines.where("level > 0").distinct()
    wanted = quoted.select("h", "h2").distinct()
    own = lines.where("level = 0").select("conv_id", "turn", "h", "h2").distinct().join(wanted, ["h", "h2"], "left_semi")
    # a quoting turn sees the latest own turn before it: running maximum, quotes of a turn first
    both = (quoted.select("conv_id", "h", "h2", "turn", "level", F.lit(None).cast("long").alias("own"))
            .unionAll(own.select("conv_id", "h", "h2", "turn", F.lit(0).alias("level"), F.col("turn").alias("own"))))
    before = Window.partitionBy("conv_id", "h", "h2").orderBy("turn", F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    here = both.withColumn("from_turn", F.max("own").over(before)).where("level > 0").drop("own")
    first = own.groupBy("h", "h2").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    elsewhere = (F.col("first.conv_id") != F.col("conv_id"))
    return (here.join(first, ["h", "h2"], "left")
            .select("conv_id", "turn", "level", "h", "h2",
                    F.when(F.col("from_turn").isNotNull(), F.col("conv_id")).when(elsewhere, F.col("first.conv_id")).alias("from_conv"),
                    F.when(F.col("from_turn").isNotNull(), F.col("from_turn")).when(elsewhere, F.col("first.turn")).alias("from_turn")))


def _roots(parents: DataFrame, folder: str) -> DataFrame:
    """(conv_id, turn, root): the end of each chain of parents, by pointer doubling."""
    now = common.written(parents.select("conv_id", "turn", F.col("parent").alias("root")), f"{folder}/roots-0")
    for k in range(1, 64):   # 2 ** 63 links
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("above"))
        later = now.join(up, ["conv_id", "root"], "left")
        later = common.written(later.select("conv_id", "turn", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), f"{folder}/roots-{k}")
        now = later.select("conv_id", "turn", "root")
        if not later.where("moved").take(1):
            break
    return now


def reply_order(messages: DataFrame, folder: str) -> DataFrame:
    """One row per message, in reply order, without quotes.

    Columns: conv_id, turn, role, text (the lines at level 0), levels (deepest
    quote level), n_quoted (distinct quoted lines), n_linked, parent_turn,
    root_turn, from_conv (another conversation most quotes come from, if the
    message has no parent), position.
    """
    whole = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = common.written(links(whole), f"{folder}/links")
    per = found.groupBy("conv_id", "turn").agg(F.max("level").alias("levels"), F.count_distinct("h", "h2").alias("n_quoted"),
                                               F.count_distinct(F.when(F.col("from_turn").isNotNull(), F.struct("h", "h2"))).alias("n_linked"))
    votes = found.where("level = 1 and from_turn is not null").groupBy("conv_id", "turn", "from_conv", "from_turn").agg(F.count("*").alias("k"))
    inside = votes.where("from_conv = conv_id").groupBy("conv_id", "turn").agg(F.max(F.struct("k", "from_turn")).alias("best")).select("conv_id", "turn", F.col("best.from_turn").alias("parent"))
    outside = votes.where("from_conv != conv_id").groupBy("conv_id", "turn").agg(F.max(F.struct("k", F.col("from_conv"))).alias("best")).select("conv_id", "turn", F.col("best.from_conv").alias("from_conv"))
    roots = _roots(inside, folder).withColumnRenamed("root", "found_root")
    lines = F.split("text", r"\r?\n", -1)
    body = F.btrim(F.array_join(F.filter(lines, lambda x: _level(x) == 0), "\n"), F.lit(" \t\n\r"))
    key = ["conv_id", "turn"]
    return (whole.withColumn("text", body).join(per, key, "left").join(inside, key, "left").join(outside, key, "left").join(roots, key, "left")
            .select("conv_id", "turn", "role", "text", F.coalesce("levels", F.lit(0)).alias("levels"), F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
                    F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("parent").alias("parent_turn"), F.coalesce("found_root", "turn").alias("root_turn"),
                    F.when(F.col("parent").isNull(), F.col("from_conv")).alias("from_conv"))
            .withColumn("position", F.struct("root_turn", "turn"))
            .orderBy("conv_id", "root_turn", "turn", F.xxhash64("role", "text"))
            .withColumn("position", F.concat_ws("/", F.col("root_turn").cast("string"), F.col("turn").cast("string"))))
