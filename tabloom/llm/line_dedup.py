"""Line deduplication: suffix ranks over line sequences by distributed prefix doubling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import saved, whole
from tabloom.llm.mixing import word_count

#: A repeated run of lines is deleted from this many words on.
MIN_WORDS = 50
NO_ID = (1 << 63) - 1
DOC = ["id", "th"]


def line_table(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """One row per line with words: its document, place, hashes, and the shortest long runs that start and end at it.

    ``seq`` numbers the lines with words. A run from the line has ``ahead`` lines and reaches
    line ``to``, one that ends at it has ``back`` lines from line ``since``; both are the shortest
    of at least ``min_words`` words, and null where the document has none. They depend on the
    lines of the run alone, so copies of a run agree on them.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), whole(text).alias("text"))
    lines = rows.select("id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    hashed = lines.select(*DOC, "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), word_count(F.col("line")).alias("words")).where("words > 0")
    doc = Window.partitionBy(*DOC)
    placed = doc.orderBy("pos")
    once = hashed.withColumn("before", F.lag("pos").over(placed)).where("before IS NULL OR before <> pos")  # equal rows are one document
    summed = once.withColumns({"seq": F.row_number().over(placed) - 1, "upto": F.sum("words").over(placed.rowsBetween(Window.unboundedPreceding, 0))})
    summed = summed.withColumn("start", F.col("upto") - F.col("words"))
    onward, until = doc.orderBy("start").rangeBetween(0, min_words - 1), doc.orderBy("upto").rangeBetween(1 - min_words, 0)
    long_on, long_back = F.sum("words").over(onward) >= min_words, F.sum("words").over(until) >= min_words
    return summed.select(*DOC, "pos", "seq", "h1", "h2",
                         F.when(long_on, F.count("*").over(onward)).cast("int").alias("ahead"), F.when(long_on, F.max("pos").over(onward)).alias("to"),
                         F.when(long_back, F.count("*").over(until)).cast("int").alias("back"), F.when(long_back, F.min("pos").over(until)).alias("since"))


def ranked(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``keys`` that occur more than once, with ``rank``: increasing in the order of the keys.

    Only one row per repeated key is sorted, in ranges; the id that grows over sorted partitions
    is the rank (ranks may have gaps). Keys that occur once need none: their suffix is unique.
    """
    repeated = rows.groupBy(*keys).count().where("count > 1").select(*keys)
    return saved(repeated.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id()), "line-ranks")


def suffix_ranks(lines: DataFrame, depth: int, n: int) -> tuple[DataFrame, DataFrame]:
    """Repeated lines with ``rank``, and the ranks of all levels: (level, id, th, seq, rank).

    At level k suffixes have the same rank if their first 2**k lines are equal, and ranks follow
    the order of those lines' ids: the suffix array to that depth, without its unique entries.
    Each level pairs the rank of a suffix with that of the suffix 2**k lines on and ranks the
    pairs; a suffix that becomes unique leaves.
    """
    first = saved(lines.join(ranked(lines, ["h1", "h2"], n), ["h1", "h2"]).drop("h1", "h2"), "line-level")
    state = first.select(*DOC, "seq", "rank")
    levels = state.withColumn("level", F.lit(0))
    for k in range(depth):
        later = state.select(*DOC, (F.col("seq") - (1 << k)).alias("seq"), F.col("rank").alias("right"))
        pairs = saved(state.withColumnRenamed("rank", "left").join(later, [*DOC, "seq"]), "line-pairs")
        state = saved(pairs.join(ranked(pairs, ["left", "right"], n), ["left", "right"]).select(*DOC, "seq", "rank"), "line-level")
        levels = levels.unionByName(state.withColumn("level", F.lit(k + 1)))
    return first, levels


def _level(m: Column) -> Column:
    return F.floor(F.log2(m)).cast("int")


def copied_runs(lines: DataFrame, n: int) -> DataFrame:
    """(id, th, seq, m, first line, last line) of every shortest long run that has an earlier copy.

    A run of m lines is named by the ranks of its first and its last 2**k lines, 2**k <= m: equal
    names are one interval of the suffix array with a common prefix of m lines. The copy with the
    smallest key and place is the first; the others are returned.
    """
    depth = lines.agg(F.max(F.greatest("ahead", "back"))).first()[0] or 1
    first, levels = suffix_ranks(lines, depth.bit_length() - 1, n)
    runs = first.where("ahead IS NOT NULL").select(*DOC, "seq", F.col("ahead").alias("m"), F.col("pos").alias("a"), F.col("to").alias("b")).unionByName(
        first.where("back > 1").select(*DOC, (F.col("seq") - F.col("back") + 1).alias("seq"), F.col("back").alias("m"), F.col("since").alias("a"), F.col("pos").alias("b"))
    ).withColumn("level", _level(F.col("m")))
    head = runs.join(levels.withColumnRenamed("rank", "head"), [*DOC, "level", "seq"])
    tail = levels.select(*DOC, "level", F.col("seq").alias("last"), F.col("rank").alias("tail"))
    named = saved(head.withColumn("last", (F.col("seq") + F.col("m") - F.expr("shiftleft(1, level)")).cast("int")).join(tail, [*DOC, "level", "last"])
                  .select(*DOC, "seq", "m", "head", "tail", "a", "b"), "line-runs")
    firsts = saved(named.groupBy("m", "head", "tail").agg(F.min(F.struct(*DOC, "seq")).alias("first")), "line-firsts")  # saved, so that the join can split a popular run
    return named.join(firsts, ["m", "head", "tail"]).where(F.struct(*DOC, "seq") != F.col("first")).select(*DOC, "seq", "m", "a", "b")


def merged_spans(runs: DataFrame) -> DataFrame:
    """(id, th, spans): the runs of a document as disjoint, sorted spans; runs that touch are one span."""
    order = Window.partitionBy(*DOC).orderBy("seq", "m")
    opens = F.coalesce(F.col("seq") > F.max(F.col("seq") + F.col("m")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    islands = runs.withColumn("opens", opens.cast("int")).withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy(*DOC, "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return spans.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``key``, n_lines, n_deleted, spans (first and last line, from 0), text without them.

    Deleted are exactly the lines that lie in a run of lines with at least ``min_words`` words
    which stands earlier too (smaller key, or further up in the same document; null keys come
    last, documents of one key in order of the hash of their text). Lines are compared whole, by
    128 bits of hash; lines without a word do not count, and go where the lines with words before
    and after them both go. The
    copies of a run may overlap. Null counts as empty; rows with equal key and text are treated as
    one document, and each is returned. Other columns are not looked at.

    A run is covered by the shortest long runs that start or end at its lines, so only those are
    looked up. All steps are joins, aggregates, windows inside a document and range sorts.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = saved(line_table(docs, key, text, min_words), "lines")
    spans = saved(merged_spans(copied_runs(lines, n)), "line-spans")
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), whole(text).alias("text")).withColumn("th", F.xxhash64("text"))
    # The texts are shuffled to their spans at every size: the spans grow with the data, so they are not broadcast.
    joined = rows.join(spans.hint("shuffle_hash"), DOC, "left").withColumn("spans", F.coalesce("spans", F.expr("CAST(array() AS array<struct<a:int,b:int>>)"))).withColumn("lines", F.split("text", "\n"))
    kept = F.expr("filter(lines, (line, i) -> NOT exists(spans, s -> s.a <= i AND i <= s.b))")
    clean = F.when(F.size("spans") > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    deleted = F.expr("aggregate(spans, 0, (acc, s) -> acc + s.b - s.a + 1)")
    shown = F.expr("transform(spans, s -> concat(s.a, '-', s.b))")
    return joined.select(F.when(F.col("id") != NO_ID, F.col("id")).alias(key), F.size("lines").cast("long").alias("n_lines"), deleted.cast("long").alias("n_deleted"),
                         shown.alias("spans"), clean.alias("text"))
