"""Line dedup: runs of lines that occurred before are removed, by distributed prefix doubling.

Every line gets an id (its MD5); suffixes are the line sequences from each line
to the end of its document. Doubling step h holds, for each suffix whose first
h lines occur again, the rank of those lines among all h-line prefixes: ranks
are handed out in sorted order to the distinct pairs of the ranks of the two
halves, so they keep the order of a suffix array, and the suffixes of one
rank are its interval of longest common prefix h or more. Suffixes whose
prefix is unique are settled and leave, and the doubling ends when none is
left. In each interval of at least ``min_run`` lines the smallest (id,
place) stays and all others are later copies; the union of the copies'
stretches over all steps is the union of the maximal repeated runs.

With ``passage_words`` a single line is enough where it is a passage of its own:
a line of at least that many words, or the only line of its document (not a
blank one), is a later copy wherever the line stands before, whatever
``min_run`` is. The first doubling step holds the ranks for it.

Everything is DataFrame work. Ranks need no running count: equal pairs are
aggregated first, range-partitioned and sorted, and numbered in place, so a line
in a third of all documents is one row there, and its suffixes are spread by
what follows them. Each step is a written table of numbers only; the texts are
split once and cut once.

Cases: null texts have no lines, an empty text has one; a run may overlap
its own copy; null ids come first; rows equal in id and text are one document
and are returned alike; documents of any length; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrarank.llm.common import materialize, word_count

MIN_RUN = 2
PASSAGE_WORDS = 50  # a line of this many words is a passage
PLACE = ["id", "tie", "pos"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _ranked(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Numbers the rows in the order of ``keys``; the numbers have gaps between partitions."""
    ordered = groups.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialize(ordered.withColumn("rank", F.monotonically_increasing_id()), "line-ranks")


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Values of ``keys`` that occur again, with the first place of each."""
    return (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*PLACE)).alias("first"))
            .where("n > 1").drop("n"))


def _first_step(docs: DataFrame, min_run: int, passage_words: int | None = None) -> DataFrame:
    """(id, tie, pos, left, rank, first, alone, run): lines that occur again and stand in a stretch of enough such
    lines (``run``) or are a passage of their own (``alone``).

    ``left``: lines from here to the end of the stretch; a line that occurs once ends every repeated run.
    """
    lines = docs.select("id", "tie", F.size(_lines(F.col("text"))).alias("of"),
                        F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    alone = F.lit(False)
    if passage_words is not None:
        words = word_count(F.col("line"))
        alone = (words >= passage_words) | (F.col("of") == 1) & (words > 0)
    lines = lines.select(*PLACE, F.unhex(F.md5(F.col("line").cast("binary"))).alias("line"), alone.alias("alone"))
    lines = materialize(lines, "lines")
    ranks = _ranked(_repeated(lines, ["line"]), ["line"])
    rows = lines.join(ranks, "line").select(*PLACE, "rank", "first", "alone").distinct()
    doc = Window.partitionBy("id", "tie")
    stretch = Window.partitionBy("id", "tie", "stretch")
    rows = rows.withColumn("stretch", F.col("pos") - F.row_number().over(doc.orderBy("pos")))
    rows = rows.withColumn("left", F.max("pos").over(stretch) - F.col("pos") + 1)
    rows = rows.withColumn("run", F.max("left").over(stretch) >= min_run).where("run or alone")
    return materialize(rows.select(*PLACE, "left", "rank", "first", "alone", "run"), "line-step")


def _step(rows: DataFrame, size: int, shift: int) -> DataFrame:
    """From suffixes ranked by ``size`` lines to those ranked by ``size + shift`` lines that occur again."""
    ahead = rows.select("id", "tie", (F.col("pos") - shift).alias("pos"), F.col("rank").alias("after"))
    whole = rows.where(F.col("left") >= size + shift).drop("first")
    same = (whole["id"].eqNullSafe(ahead["id"]) & (whole["tie"] == ahead["tie"]) & (whole["pos"] == ahead["pos"]))
    pairs = whole.join(ahead, same).select(
        *(whole[c] for c in PLACE), "left", whole["rank"].alias("before"), ahead["after"])
    pairs = materialize(pairs, "line-pairs")
    ranks = _ranked(_repeated(pairs, ["before", "after"]), ["before", "after"])
    return materialize(pairs.join(ranks, ["before", "after"]).select(*PLACE, "left", "rank", "first"), "line-step")


def _copies(rows: DataFrame, size: int) -> DataFrame:
    """Stretches of ``size`` lines that are a later copy."""
    here = F.struct(*PLACE)
    return rows.where(here != F.col("first")).select(*PLACE, (F.col("pos") + size).alias("end"))


def later_copies(docs: DataFrame, min_run: int, passage_words: int | None = None) -> DataFrame:
    """(id, tie, cuts): per document the disjoint stretches (start, end) of lines that later copies cover, in order."""
    rows, size, found = _first_step(docs, min_run, passage_words), 1, []
    if passage_words is not None:
        found.append(_copies(rows.where("alone"), 1))
    rows = rows.where("run").drop("alone", "run")
    while not rows.isEmpty():
        if size >= min_run:
            found.append(_copies(rows, size))
        elif 2 * size > min_run:  # min_run lines from two overlapping halves
            found.append(_copies(_step(rows, size, min_run - size), min_run))
        rows, size = _step(rows, size, size), 2 * size
    if not found:
        found.append(rows.select(*PLACE, F.col("pos").alias("end")))
    copies = found[0]
    for more in found[1:]:
        copies = copies.unionByName(more)
    longest = copies.groupBy(*PLACE).agg(F.max("end").alias("end"))
    w = Window.partitionBy("id", "tie").orderBy("pos")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.coalesce(F.col("pos") > reach, F.lit(True)).cast("int")
    joined = longest.withColumn("opened", opened).withColumn("cut", F.sum("opened").over(w))
    cuts = joined.groupBy("id", "tie", "cut").agg(F.min("pos").alias("start"), F.max("end").alias("end"))
    return cuts.groupBy("id", "tie").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          min_run: int = MIN_RUN, passage_words: int | None = None) -> DataFrame:
    """(id, n_lines, n_removed, text): every document without the lines of its later copies.

    Single lines are removed only with ``passage_words``.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    cuts = later_copies(keyed, min_run, passage_words)
    both = keyed.join(cuts, keyed["id"].eqNullSafe(cuts["id"]) & (keyed["tie"] == cuts["tie"]), "left").select(
        keyed["id"], "text", "cuts")
    lines = F.coalesce(_lines(F.col("text")), F.array().cast("array<string>"))
    both = both.select("id", lines.alias("lines"), F.coalesce("cuts", F.array().cast("array<struct<start:int,end:int>>")).alias("cuts"))
    begins = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c["end"]))
    ends = F.concat(F.transform("cuts", lambda c: c["start"]), F.array(F.size("lines")))
    pieces = F.transform(F.arrays_zip(begins.alias("b"), ends.alias("e")),
                         lambda p: F.slice(F.col("lines"), p["b"] + 1, p["e"] - p["b"]))
    removed = F.aggregate("cuts", F.lit(0), lambda n, c: n + c["end"] - c["start"])
    return both.select(F.col("id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
                       removed.cast("long").alias("n_removed"), F.array_join(F.flatten(pieces), "\n").alias("text"))
