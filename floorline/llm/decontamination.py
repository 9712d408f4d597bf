"""Documents that contain passages of a benchmark.

A window is ``window`` consecutive words of an item, or a shorter item whole.
It occurs in a document only if all its shingles (runs of three words) do, so
one of them, the rarest over all documents, is enough to find the places worth a
look: the prefix of a set join whose overlap must be complete.  The shingle's
offset in the window gives the place, bounded by the document's length, and
there every shingle of the window is compared, as words, not as hashes.

All of it is DataFrame operations.  Documents are split into words once; what
remains of them is the places of benchmark shingles and one row with the length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorline.llm.common import stored

WINDOW, SHINGLE, PERCENT = 13, 3, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Digits, letters a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Stands after a document's last word; no word contains it.
END = "\u0001"
# A side of a join is sent to every task up to this many rows of at most 13 words; beyond, both sides are shuffled.
BROADCAST_ROWS = 100_000


def words_of(text: Column) -> Column:
    """Words in lower case A-Z; the built-in ``lower`` does the same on plain ASCII and is quicker."""
    text = F.coalesce(text, F.lit(""))
    lower = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def small(frame: DataFrame) -> DataFrame:
    """A written table with a broadcast hint if its row count allows one."""
    return F.broadcast(frame) if frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else frame


def benchmark_windows(items: DataFrame, item_column: str, text_column: str, window: int, shingle: int) -> DataFrame:
    """Per item and window: ``item``, ``win`` (its words), ``len`` and ``size`` of its shingles."""
    words = items.filter(F.col(item_column).isNotNull()).select(
        F.col(item_column).alias("item"), words_of(F.col(text_column)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    return words.select("item", "w", F.explode(starts).alias("s")).select(
        "item", F.slice("w", F.col("s"), F.lit(window)).alias("win")).distinct().withColumn(
        "len", F.size("win")).withColumn("size", F.least("len", F.lit(shingle)))


def shingles_of(words: Column, size: int) -> Column:
    """At each word the words from there, ``size`` of them, null beyond the end."""
    return F.arrays_zip(*(F.slice(words, F.lit(k + 1), F.size(words)).alias(f"p{k}") for k in range(size)))


def places(docs: DataFrame, grams: DataFrame, size: int) -> DataFrame:
    """Where the documents hold one of the ``grams``: ``id``, ``tag``, ``at`` and the gram."""
    # A column of its own: the generator names it several times and would split the text as often.
    split = docs.select("id", F.xxhash64("text").alias("tag"), F.concat(words_of(F.col("text")), F.array(F.lit(END))).alias("w"))
    each = split.select("id", "tag", F.posexplode(shingles_of(F.col("w"), size)).alias("at", "g"))
    named = each.select("id", "tag", "at", "g.*")
    own = F.concat_ws(" ", *(F.col(f"p{k}") for k in range(size)))
    keyed = named.withColumn("key", F.xxhash64(*(F.col(f"p{k}") for k in range(size))))
    return keyed.join(grams, (keyed["key"] == grams["gram_key"]) & (own == grams["gram"])).select("id", "tag", "at", "gram")


def benchmark_hits(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   item_column: str = "item_id", item_text_column: str = "text",
                   window: int = WINDOW, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: id, ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``items`` found, ``contaminated``.

    Words are lower-cased in A-Z.  A row is contaminated if it has hits that are
    at least ``percent`` hundredths of its words.  Null and empty texts have no
    words.  Rows are told apart by id and text, so repeated or null ids do no
    harm and each row gets one.  Items with a null id, or without words, take no
    part.  Other columns are not read.
    """
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    windows = stored(benchmark_windows(items, item_column, item_text_column, window, shingle), "windows")
    wins = windows.select("win", "len", "size").distinct()
    offsets = stored(wins.select("win", "len", "size", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("len") - F.col("size") + 1),
        lambda s: F.concat_ws(" ", F.slice("win", s, F.col("size"))))).alias("off", "gram")), "offsets")

    sizes = sorted({row[0] for row in wins.select("size").distinct().collect()} | {shingle})  # at most ``shingle`` numbers
    found = []
    for size in sizes:
        grams = offsets.filter(F.col("size") == size).select("gram").distinct()
        if size == shingle:
            grams = grams.union(grams.sparkSession.createDataFrame([(END,)], "gram string"))
        keyed = stored(grams.select("gram", F.xxhash64(*(
            F.get(F.split("gram", " "), F.lit(k)) for k in range(size))).alias("gram_key")), "grams")
        found.append(places(plain, small(keyed), size))
    at = stored(reduce(DataFrame.union, found), "places")
    rows = at.filter(F.col("gram") == END).select("id", "tag", F.col("at").cast("long").alias("n_words"))
    at = at.filter(F.col("gram") != END).distinct()

    rarity = at.groupBy("gram").agg(F.count("*").alias("held"))
    needed = stored(
        offsets.join(rarity, "gram").groupBy("win", "len", "size").agg(
            F.count("*").alias("known"), F.min(F.struct("held", "gram", "off")).alias("rarest"))
        .filter("known = len - size + 1").select("win", "len", "size", "rarest.gram", "rarest.off"), "needed")
    lengths = rows.distinct()
    looks = at.join(small(needed), "gram").withColumn("begin", F.col("at") - F.col("off")).filter("begin >= 0").select(
        "id", "tag", "begin", "win", "len", "size")
    same_row = lambda x, y: x["id"].eqNullSafe(y["id"]) & (x["tag"] == y["tag"])
    fitting = looks.join(lengths, same_row(looks, lengths)).filter("begin + len <= n_words").select(
        looks["id"], looks["tag"], "begin", "win", "len", "size")
    expected = fitting.join(small(offsets.select("win", "off", "gram")), "win").withColumn("at", F.col("begin") + F.col("off"))
    met = expected.join(at, same_row(expected, at) & (expected["at"] == at["at"]) & (expected["gram"] == at["gram"])).select(
        expected["id"], expected["tag"], "begin", "win", "len", "size")
    hits = stored(met.groupBy("id", "tag", "begin", "win", "len", "size").count().filter(
        "count = len - size + 1").select("id", "tag", "begin", "win", "len"), "hits")

    covered = hits.select("id", "tag", F.explode(F.sequence("begin", F.col("begin") + F.col("len") - 1)).alias("at")).distinct()
    n_hit = covered.groupBy("id", "tag").agg(F.count("*").alias("n_hit"))
    named = hits.select("id", "tag", "win").distinct().join(small(windows.select("win", "item")), "win").select(
        "id", "tag", "item").distinct().groupBy("id", "tag").agg(F.collect_list("item").alias("items"))
    both = n_hit.join(named, same_row(n_hit, named)).select(n_hit["id"], n_hit["tag"], "n_hit", "items")
    out = rows.join(both, same_row(rows, both), "left").select(
        rows["id"], rows["tag"], "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<" + items.schema[item_column].dataType.simpleString() + ">")).alias("items"))
    return out.select(
        F.col("id").alias(id_column), "n_words", "n_hit", "items",
        ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))).alias("contaminated"),
        F.col("tag").alias("text_hash"))
