"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of all words by weight, capped at ``MOST_COPIES`` times
its size; what a cap leaves over goes to the others by weight, until none is
above. Every document of a source is taken floor(target / size) whole times.
The rest of the target is a sample with unequal probabilities: a document's
inclusion probability is proportional to its size, p = c * size, and those that
would reach 1 are certain, a whole copy more (``certainty``: c is set so that
the expected words are the rest, given which sizes are certain). A document's
uniform number u (a hash of its id and text) gives the odds u / (1 - u), which are divided by
the odds of its inclusion probability, and documents are taken in that order
as long as their words fit. Two more rounds do the same with the documents
that fit what is then left, and the one document nearest to the last gap is
added where it more than halves it or closes it, so long documents at the cut
leave little of a gap: never more than half the longest document's size.

A source's order is never brought into one task: the cut is found by summing
words over 4096 stretches of the order, then of the one the cut falls into,
and so on down to single places of it (``LEVELS`` turns). A decision depends on
a document's source, size and place in the order alone, through a few numbers
a source, so no documents are joined. Sums over sources in an order are taken
within sorted ranges of sources; over a source's distinct sizes in one task, at
most as many as its longest document has words.

Cases: null and empty texts have size 0 and take no words; null is a source of
its own, the last; equal rows share their place in the order and are taken or
left together; an empty table gives no rows; a source without words has
target 0; other columns are kept by ``mix`` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrarank.llm.common import materialize, word_count

WEIGHTS = (1, 2, 3)  # by the sources' order, repeating
MOST_COPIES = 3
ROUNDS = 3
STRETCH_BITS = 12
ORDER_BITS = 48
LEVELS = ORDER_BITS // STRETCH_BITS


def _small(by_source: DataFrame) -> DataFrame:
    """A table of one row a source, written and read back.

    Spark then knows its size: it broadcasts it to the rows where it is small
    enough, so that a source's rows stay where they are, and joins by sorting otherwise.
    """
    return materialize(by_source, "mix-sources")


def _running(rows: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``rows`` with, for each entry of ``sums``, the sum of that column over the rows before in the order.

    Rows are summed up within sorted ranges; a range's sums start behind those of the ranges before.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # the upper bits number the range, the lower 33 the row in it
    numbered = _small(ordered.withColumn("at", F.monotonically_increasing_id())).withColumn("part", F.shiftright("at", 33))
    totals = {r.part: r for r in numbered.groupBy("part").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).collect()}  # one row a range
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    for name, column in sums.items():
        offsets, total = [], 0
        for p in range(max(totals, default=0) + 1):
            offsets.append(total)
            total += totals[p][name] if p in totals else 0
        before = F.element_at(F.array(*(F.lit(k).cast("long") for k in offsets)), (F.col("part") + 1).cast("int"))
        numbered = numbered.withColumn(name, before + F.coalesce(F.sum(column).over(within), F.lit(0)))
    return numbered.drop("at", "part")


def _places(by_source: DataFrame) -> DataFrame:
    """``by_source`` with ``place``, the number from 0 of its source in ascending order, null last."""
    return _running(by_source.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"place": "one"}).drop("one")


def source_targets(rows: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows (source, size); one row a source throughout.

    Sources in the order of size over weight are capped up to the first that the level of all behind it leaves
    below its cap; sums before it give that level.
    """
    by = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*map(F.lit, WEIGHTS))
    nth = (F.col("place") % len(WEIGHTS) + 1).cast("int")
    sources = _places(by).withColumn("weight", F.element_at(weights, nth)).drop("place")
    sources = sources.withColumn("cap", MOST_COPIES * F.col("source_size"))
    order = [(F.col("source_size") / F.col("weight").cast("double")).asc(), F.col("source").asc_nulls_last()]
    summed = _small(_running(sources, order, {"caps": "cap", "weights": "weight"}))
    total, all_weights = summed.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(total or 0) - F.col("caps")).cast("double") / (F.lit(all_weights or 0) - F.col("weights")).cast("double")
    first = summed.select("caps", "weights", "weight", "cap", level.alias("level")).where(F.col("level") * F.col("weight") <= F.col("cap"))
    found = first.agg(F.min_by("level", F.struct("weights", "caps"))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(float(found or 0.0)) * F.col("weight"))
    return summed.select("source", "source_size", target.alias("target"))


def certainty(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (source, rest, ...) with ``scale``, the c of the inclusion probabilities min(1, c * size).

    From the largest size down, sizes are certain as long as c, set by what they leave, makes them so.
    """
    sizes = rows.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs"))
    here = plan.select(F.col("source").alias("p_source"), "rest").where("rest > 0")
    sizes = sizes.join(here, F.col("source").eqNullSafe(F.col("p_source"))).withColumn("words", F.col("docs") * F.col("size"))
    larger = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.partitionBy("source").orderBy(F.col("size").asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    square = F.col("words").cast("double") * F.col("size")
    summed = sizes.withColumn("certain", F.coalesce(F.sum("words").over(larger), F.lit(0))).withColumn("squares", F.sum(square).over(smaller))
    c = (F.col("rest") - F.col("certain")) / F.col("squares")
    scale = summed.withColumn("c", c).where(F.col("c") * F.col("size") < 1).groupBy("source").agg(F.max_by("c", "size").alias("scale"))
    return _small(plan.join(scale.withColumnRenamed("source", "c_source"), F.col("source").eqNullSafe(F.col("c_source")), "left")
                  .drop("c_source").withColumn("scale", F.coalesce("scale", F.lit(0.0))))


def uniform(id_col: Column, text: Column) -> Column:
    """A number strictly between 0 and 1 from the MD5 of id and text."""
    both = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(" "), F.coalesce(text, F.lit("")))
    head = F.conv(F.substring(F.md5(both.cast("binary")), 1, 13), 16, 10)
    return (head.cast("double") + 0.5) / float(1 << 52)


def inclusion(size: Column, scale: Column) -> Column:
    return F.least(F.lit(1.0), scale * size)


def order_key(u: Column, p: Column, share: Column) -> Column:
    """Pareto order: odds of u over odds of the inclusion probability p, mapped monotonically to integers.

    Times the odds of the source's share, so that the integers of a source are spread evenly however small the share.
    """
    a, b = u * (1 - p) * share, (1 - u) * p * (1 - share)
    return F.when((share > 0) & (p > 0), F.floor(a / (a + b) * float(1 << ORDER_BITS)).cast("long"))


def _cut(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut): the largest order key up to which the rows' words fit the source's budget.

    ``rows`` (source, size, key); ``budgets`` (source, budget). Sources whose rows all fit get the largest key there is.
    """
    open_rows = rows.join(budgets, F.col("source").eqNullSafe(F.col("b_source"))).drop("b_source")
    found = None
    for level in range(LEVELS):
        shift = ORDER_BITS - STRETCH_BITS * (level + 1)
        stretches = open_rows.withColumn("stretch", F.shiftright("key", shift)).groupBy("source", "stretch").agg(
            F.sum("size").alias("words"), F.first("budget").alias("budget"))
        w = Window.partitionBy("source").orderBy("stretch")  # at most 4096 rows a source
        run = stretches.withColumn("sum", F.sum("words").over(w))
        hit = _small(run.groupBy("source").agg(
            F.min(F.when(F.col("sum") > F.col("budget"), F.col("stretch"))).alias("hit"),
            F.coalesce(F.max(F.when(F.col("sum") <= F.col("budget"), F.col("sum"))), F.lit(0)).alias("used")).where("hit IS NOT NULL"))
        found = hit.select(F.col("source").alias("f_source"), "hit") if found is None else _small(
            found.drop("hit").join(hit.withColumnRenamed("source", "h_source"), F.col("f_source").eqNullSafe(F.col("h_source"))).select("f_source", "hit"))
        if level + 1 < LEVELS:
            here = hit.select(F.col("source").alias("h_source"), "hit", "used")
            open_rows = open_rows.join(here, F.col("source").eqNullSafe(F.col("h_source")) & (F.shiftright("key", shift) == F.col("hit")))
            open_rows = materialize(open_rows.select("source", "size", "key", (F.col("budget") - F.col("used")).alias("budget")), "mix-stretch")
    joined = budgets.join(found, F.col("b_source").eqNullSafe(F.col("f_source")), "left")
    return joined.select(F.col("b_source").alias("source"), F.coalesce(F.col("hit") - 1, F.lit((1 << ORDER_BITS) + 1)).alias("cut"))


def _chosen(rounds: int) -> Column:
    """Whether the order sample takes a row, from its source's limits and cuts of the rounds so far."""
    out = F.lit(False)
    for k in range(rounds):
        out = out | F.coalesce((F.col("size") <= F.col(f"limit{k}")) & (F.col("key") <= F.col(f"cut{k}")), F.lit(False))
    return out


def sampling_plan(rows: DataFrame) -> DataFrame:
    """One row a source: its size, target, whole copies, share sampled, scale of inclusion, and the rounds' limits and cuts.

    ``rows``: (source, size, u). The rows are read a few times, columns of numbers only.
    """
    plan = source_targets(rows)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = (plan.withColumn("whole", F.floor(ratio).cast("int")).withColumn("share", ratio - F.col("whole"))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    plan = certainty(rows, plan).withColumn("limit0", F.lit((1 << 62)))
    for k in range(ROUNDS):
        plan = _with_budget(rows, plan, k)
        if k:
            plan = plan.withColumn(f"limit{k}", F.floor("budget").cast("long"))
        open_rows = (_keyed(rows, plan).where(~_chosen(k) & (F.col("size") <= F.col(f"limit{k}")))
                     .select("source", "size", "key"))
        cuts = _cut(open_rows, plan.select(F.col("source").alias("b_source"), "budget"))
        cuts = cuts.select(F.col("source").alias("c_source"), F.col("cut").alias(f"cut{k}"))
        plan = _small(plan.drop("budget").join(cuts, F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source"))
    plan = _with_budget(rows, plan, ROUNDS)
    nearest = (_keyed(rows, plan).where(~_chosen(ROUNDS) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("budget")))
               .groupBy("source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("budget")), "key")).alias("near"))
               .select(F.col("source").alias("c_source"), F.col("near.key").alias("added")))
    return _small(plan.drop("budget").join(nearest, F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source"))


def _key() -> Column:
    return order_key(F.col("u"), inclusion(F.col("size"), F.col("scale")), F.col("share"))


def _keyed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of sources that sample, with their source's plan and their order key."""
    here = plan.withColumnRenamed("source", "p_source")
    return (rows.join(here, F.col("source").eqNullSafe(F.col("p_source"))).where(F.col("share") > 0)
            .withColumn("key", _key()).where("key IS NOT NULL"))


def _with_budget(rows: DataFrame, plan: DataFrame, rounds: int) -> DataFrame:
    """The plan with the words each source has left after its rounds so far."""
    spent = _keyed(rows, plan).where(_chosen(rounds)).groupBy(F.col("source").alias("s_source")).agg(
        F.sum("size").alias("spent"))
    return _small(plan.join(spent, F.col("source").eqNullSafe(F.col("s_source")), "left").drop("s_source")
                  .withColumn("budget", F.greatest(F.col("rest") - F.coalesce("spent", F.lit(0)), F.lit(0.0))).drop("spent"))


def _with_copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (source, size, u, ...) with their source's plan and ``copies``."""
    joined = sized.join(plan.withColumnRenamed("source", "p_source"), F.col("source").eqNullSafe(F.col("p_source")))
    joined = joined.withColumn("key", _key())
    return joined.withColumn("copies", F.col("whole") + (_chosen(ROUNDS) | F.coalesce(F.col("key") == F.col("added"), F.lit(False))).cast("int"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken, copies) of every document."""
    rows = materialize(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                    word_count(F.col(text_col)).alias("size"), uniform(F.col(id_col), F.col(text_col)).alias("u")), "mix")
    out = _with_copies(rows, sampling_plan(rows.select("source", "size", "u")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents: each with its own columns, as often as it is taken."""
    cols = docs.columns
    sized = docs.select(F.struct(*[docs[c] for c in cols]).alias("row"), F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size"), uniform(F.col(id_col), F.col(text_col)).alias("u"))
    rows = materialize(sized.select("source", "size", "u"), "mix")
    out = _with_copies(sized, sampling_plan(rows)).where("copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[F.col("row").getField(c).alias(c) for c in cols])
