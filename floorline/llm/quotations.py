"""Conversations in reply order, without quotes.

Lines that begin with ``>`` quote, and their number is the level.  Neighbouring
lines of one level form a passage.  A passage, and each line of it, is normalised
and hashed; the same is done with what messages say themselves.  Joined by
conversation and hash, a quoted key belongs to the latest earlier message that
said it, and a message replies to the one from which it quotes most at the first
level, or, where deeper levels are joined too, at the shallowest one that was said
before.  Messages without such a link start threads of their own.

All of it is DataFrame operations.  Keys are matched by a running maximum over
(conversation, hash), so no pairs are formed, and positions are counted within
ranges of the sorted rows, so a conversation may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorline.llm.common import shuffle_partitions, stored

MARKS = r"^(?:[ \t]*>)+"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parsed(text: Column) -> tuple[Column, Column]:
    """Each line's quote level and what it says."""
    lines = F.split(F.coalesce(text, F.lit("")), "\r?\n", -1)
    levels = F.transform(lines, lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")))
    return levels, F.transform(lines, lambda x: F.regexp_replace(x, MARKS + " ?", ""))


def passages(levels: Column, says: Column) -> Column:
    """Runs of lines of one level: ``level``, ``lines``."""
    size = F.size(levels)
    before = lambda i: F.get(levels, i - 2)
    starts = F.filter(F.sequence(F.lit(1), size), lambda i: (i == 1) | (before(i) != F.get(levels, i - 1)))
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(size + 1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(
        F.get(levels, a - 1).alias("level"), F.slice(says, a, b - a).alias("lines")))


def keys_of(level: Column, lines: Column) -> Column:
    """Normalised keys of a passage: the whole and each line, with their lengths."""
    whole = normalised(F.array_join(lines, " "))
    every = F.array_distinct(F.filter(F.concat(F.array(whole), F.transform(lines, normalised)), lambda x: x != ""))
    return F.transform(every, lambda x: F.struct(level.alias("level"), F.sha2(x.cast("binary"), 256).alias("key"), F.length(x).alias("size")))


def split_quotes(messages: DataFrame, text_column: str = "text") -> DataFrame:
    """``messages`` with ``own_text`` (without quotes), ``quotes`` (passages: level and text) and their ``keys``, level 0 for own ones."""
    work = messages.withColumn("levels__", parsed(F.col(text_column))[0]).withColumn("says__", parsed(F.col(text_column))[1])
    work = work.withColumn("runs__", passages(F.col("levels__"), F.col("says__")))
    own = F.filter("runs__", lambda r: r["level"] == 0)
    quoted = F.filter("runs__", lambda r: r["level"] > 0)
    own_lines = F.flatten(F.transform(own, lambda r: r["lines"]))
    return work.withColumn("own_text", F.trim(F.array_join(own_lines, "\n"))).withColumn(
        "quotes", F.transform(quoted, lambda r: F.struct(r["level"].alias("level"), F.array_join(r["lines"], "\n").alias("text")))
    ).withColumn("keys", F.concat(
        keys_of(F.lit(0), own_lines), F.flatten(F.transform(own, lambda r: keys_of(F.lit(0), r["lines"]))),
        F.flatten(F.transform(quoted, lambda r: keys_of(r["level"], r["lines"]))),
    )).drop("levels__", "says__", "runs__")


def reply_links(keys: DataFrame, deepest: int | None = None) -> DataFrame:
    """``conv``, ``turn`` and ``reply_to``, the turn it quotes most at the shallowest level with a link; turns without one have no row.

    All levels are joined unless the caller gives the ``deepest`` that is.
    """
    spread = keys.select("conv", "turn", F.explode("keys").alias("k")).select("conv", "turn", "k.level", "k.key", "k.size")
    joined = F.lit(True) if deepest is None else F.col("level") <= deepest
    # Own keys count once per turn, quoted ones once per turn and level as well.
    once = spread.filter(F.col("turn").isNotNull() & joined).distinct()
    earlier = Window.partitionBy("conv", "key").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    said = once.withColumn("origin", F.max(F.when(F.col("level") == 0, F.col("turn"))).over(earlier))
    weight = said.filter("level > 0 AND origin IS NOT NULL").groupBy("conv", "turn", "level", "origin").agg(F.sum("size").alias("weight"))
    best = weight.groupBy("conv", "turn").agg(F.max(F.struct(-F.col("level"), "weight", "origin")).alias("best"))
    return best.select("conv", "turn", F.col("best.origin").alias("reply_to"))


def thread_paths(turns: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``reply_to`` with ``path``, the turns from the thread's first message on; lengths double each round."""
    paths = stored(turns.select("conv", "turn", "reply_to", F.array("turn").alias("path"), F.col("reply_to").alias("above")), "paths")
    while not paths.filter("above IS NOT NULL").isEmpty():
        upper = paths.select(F.col("conv").alias("upper_conv"), F.col("turn").alias("upper_turn"),
                             F.col("path").alias("upper_path"), F.col("above").alias("upper_above"))
        joined = paths.join(upper, F.col("conv").eqNullSafe(F.col("upper_conv")) & (F.col("above") == F.col("upper_turn")), "left")
        paths = stored(joined.select(
            "conv", "turn", "reply_to",
            F.when(F.col("upper_path").isNull(), F.col("path")).otherwise(F.concat("upper_path", "path")).alias("path"),
            F.col("upper_above").alias("above")), "paths")
    return paths.drop("above")


def reply_ordered(messages: DataFrame, conversation_column: str = "conv_id", turn_column: str = "turn",
                  role_column: str = "role", text_column: str = "text", deepest: int | None = None) -> DataFrame:
    """Per message: conversation, turn, role, ``own_text``, ``n_quotes``, ``reply_to``, ``depth``, ``position``, ``formatted``.

    ``position`` (from 1) is the message's place in its conversation, each message
    followed by its replies, siblings by their turns; rows that repeat a turn lie
    together, ordered by role and text, and link as one.  A null text says
    nothing; a null role is written ``unknown``; messages with a null turn are
    linked with nothing and come first; those with a null conversation form one.
    Of all levels the shallowest with a quote that was said before counts.  Quotes
    nowhere said before link to nothing and are dropped all the same; so are those
    of a level beyond ``deepest``, where a caller sets one.
    """
    plain = messages.select(F.col(conversation_column).alias("conv"), F.col(turn_column).cast("long").alias("turn"),
                            F.col(role_column).alias("role"), F.col(text_column).alias("text"))
    split = stored(split_quotes(plain), "quotes")
    links = reply_links(split, deepest)
    turns = split.filter("turn IS NOT NULL").select("conv", "turn").distinct()
    named = links.select(F.col("conv").alias("link_conv"), F.col("turn").alias("link_turn"), "reply_to")
    turns = turns.join(named, F.col("conv").eqNullSafe(F.col("link_conv")) & (F.col("turn") == F.col("link_turn")), "left")
    paths = thread_paths(turns).select(F.col("conv").alias("path_conv"), F.col("turn").alias("path_turn"), "reply_to", "path")
    rows = split.join(paths, F.col("conv").eqNullSafe(F.col("path_conv")) & (F.col("turn") == F.col("path_turn")), "left").select(
        "conv", "turn", "role", "text", "own_text", F.size("quotes").alias("n_quotes"), "reply_to",
        F.coalesce("path", F.array().cast("array<bigint>")).alias("path"))

    # Sorted ranges, numbered; a row's place is its place in its range plus the rows of its conversation before.
    order = ["path", "role", "text"]
    ranged = stored(rows.repartitionByRange(shuffle_partitions(messages.sparkSession), "conv", *order).withColumn(
        "part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(F.col("conv").alias("before_conv"), F.col("part").alias("before_part"), "before")
    inside = ranged.withColumn("inside", F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order)))
    placed = inside.join(before, F.col("conv").eqNullSafe(F.col("before_conv")) & (F.col("part") == F.col("before_part")))
    return placed.select(
        F.col("conv").alias(conversation_column), F.col("turn").alias(turn_column), F.col("role").alias(role_column), "own_text",
        F.col("n_quotes").cast("long").alias("n_quotes"), "reply_to",
        F.greatest(F.size("path") - 1, F.lit(0)).cast("long").alias("depth"),
        (F.col("before") + F.col("inside")).alias("position"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("own_text")).alias("formatted"))
