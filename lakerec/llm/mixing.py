"""Mixing sources to target weights by Pareto order sampling. DataFrame and SQL functions only.

Targets. Sources in code-point order, null last, weigh 5, 2, 1 and so on; they share ``SHARE`` of all words by weight,
each up to ``MOST`` times its own words, and what is above goes to the others by weight until none is above. That is
``target = least(2 * size, c * weight)`` for the one c that spends the budget, found on one row per source.

Copies. Inside a source a document's expected copies are ``least(2, c * appeal)``, with c such that the expected words
are the source's target. The appeal is the number of binary digits of the document's size, so longer documents are
likelier and a source has few classes. The whole part are certain copies. The rest, p, is the probability of one more:
each document draws odds ``u / (1 - u)``, divides them by its inclusion odds ``p / (1 - p)``, and documents are taken
in rising order of the ratio. The sample's size is fixed in words: it ends at the document that brings the source
nearest to its target, so a source misses its target by half a document at most.

The end of the sample is found without ordering a source: words are summed by ``CELLS`` cells of the rank variable,
then by as many cells of the one cell in which the target lies, and only what is in that small cell is put in order. A
source that holds a third of all rows is a few rows per task in every shuffle but the last, which reads about
one in ``CELLS ** 2`` of its documents.

u comes from a digest of id and text, so reruns agree. Defined cases: a null text has size 0 and nothing is taken; a null
source is the last source; repeated rows (same id, text and source) are taken or left together; with no words at all
every target is 0. Extra columns pass through; columns with the name of a new one are replaced. An empty table gives
an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakerec.session import stored

SHARE = 1.5
MOST = 2
WEIGHTS = (5, 2, 1)
CELLS = 4096
WORD = r"[^\x20\x09-\x0D]+"
NEW = ["size", "source_size", "target", "copies", "taken"]


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` (words), ``draw`` (u, strictly between 0 and 1) and ``ticket`` (breaks ties)."""
    text = F.coalesce("text", F.lit(""))
    ticket = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text))
    number = F.conv(F.substring("ticket", 1, 13), 16, 10).cast("bigint")
    return (
        docs.drop(*NEW, "draw", "ticket")
        .withColumn("size", F.regexp_count(text, F.lit(WORD)).cast("bigint"))
        .withColumn("ticket", ticket)
        .withColumn("draw", (number + F.lit(0.5)) / F.lit(float(1 << 52)))
    )


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1)
    rows = sizes.withColumn("weight", weights.cast("bigint")).withColumn(
        "room", F.lit(MOST) * F.col("source_size")
    )
    # From the source that is full first: what is left when those before it are full, and the weights it is shared by.
    by_fill = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("room").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sharing = F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("left", SHARE * F.sum("source_size").over(everything) - before).withColumn("sharing", sharing)
    fits = F.col("left") * F.col("weight") <= F.col("room") * F.col("sharing")
    rows = rows.withColumn("level", F.when(fits, F.struct("left", "sharing")))
    level = F.first("level", ignorenulls=True).over(
        by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    rows = rows.withColumn("level", level)
    shared = F.col("level.left") * F.col("weight") / F.col("level.sharing")
    target = F.least(F.col("room").cast("double"), F.coalesce(shared, F.col("room").cast("double")))
    return rows.select("source", "source_size", target.alias("target"))


def expected_copies(classes: DataFrame) -> DataFrame:
    """``(source, appeal, expected)`` from ``(source, appeal, words, target)``, one row per source and appeal."""
    order = Window.partitionBy("source").orderBy(F.desc("appeal"))
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sharing = F.sum(F.col("words") * F.col("appeal")).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = classes.withColumn("left", F.col("target") - MOST * before).withColumn("sharing", sharing)
    fits = F.col("left") * F.col("appeal") <= MOST * F.col("sharing")
    rows = rows.withColumn("level", F.when(fits, F.struct("left", "sharing")))
    level = F.first("level", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    rows = rows.withColumn("level", level)
    some = F.nullif(F.col("level.sharing"), F.lit(0))
    share = F.greatest(F.lit(0.0), F.col("level.left") * F.col("appeal") / some)
    share = F.when(F.col("level.sharing") == 0, F.lit(0.0)).otherwise(share)  # no words
    return rows.select("source", "appeal", F.least(F.lit(float(MOST)), F.coalesce(share, F.lit(float(MOST)))).alias("expected"))


def _with_rank(rows: DataFrame) -> DataFrame:
    """``whole`` certain copies and the rank variable ``ratio`` (null: no chance of one more)."""
    whole = F.floor("expected")
    rest = F.col("expected") - whole
    ratio = F.try_divide(F.col("draw") * (1 - F.col("rest")), (1 - F.col("draw")) * F.col("rest"))
    return rows.withColumn("whole", whole).withColumn("rest", rest).withColumn(
        "ratio", F.when((F.col("rest") > 0) & (F.col("size") > 0), ratio)
    )


def _cell(level: int):
    place = F.col("ratio") / (1 + F.col("ratio"))
    return F.floor(place * (CELLS**level)).cast("bigint")


def _open_cell(cells: DataFrame) -> DataFrame:
    """Of ``(source, wanted, cell, words)`` the cell in which a source's sample ends, with the words before it."""
    order = Window.partitionBy("source").orderBy("cell")
    upto = F.sum("words").over(order)
    rows = cells.withColumn("before", upto - F.col("words"))
    inside = (F.col("before") <= F.col("wanted")) & (F.col("before") + F.col("words") > F.col("wanted"))
    return rows.where(inside).select("source", "wanted", "cell", "before")


def mixed(rows: DataFrame) -> DataFrame:
    """Rows of ``sized`` with ``source_size``, ``target``, ``copies`` and ``taken`` instead of ``draw`` and ``ticket``.

    A document with ``copies`` c is in the mix c times.
    """
    rows = rows.withColumn("appeal", F.length(F.bin("size")).cast("bigint"))
    narrow = stored(rows.select("source", "size", "appeal", "draw", "ticket"), "sizes")
    classes = stored(narrow.groupBy("source", "appeal").agg(F.sum("size").alias("words")), "classes")
    goals = stored(targets(classes.groupBy("source").agg(F.sum("words").alias("source_size"))), "targets")

    def by_source(left: DataFrame, right: DataFrame, how: str = "inner", *more: str) -> DataFrame:
        """Join on source (null equals null) and the columns ``more``."""
        other = right.withColumnsRenamed({c: f"__{c}" for c in ("source", *more)})
        match = F.col("source").eqNullSafe(F.col("__source"))
        for c in more:
            match = match & (F.col(c) == F.col(f"__{c}"))
        return left.join(other, match, how).drop(*[f"__{c}" for c in ("source", *more)])

    expected = stored(expected_copies(by_source(classes, goals)), "expected")
    ranked = _with_rank(by_source(narrow, expected, "inner", "appeal"))
    certain = by_source(classes, expected, "inner", "appeal").groupBy("source").agg(
        F.sum(F.floor("expected") * F.col("words")).alias("certain")
    )
    wanted = by_source(goals, certain).select("source", (F.col("target") - F.col("certain")).alias("wanted"))
    chance = ranked.where("ratio is not null").select("source", "size", "ratio", "ticket")
    cells = chance.groupBy("source", _cell(1).alias("cell")).agg(F.sum("size").alias("words"))
    first = stored(_open_cell(by_source(cells, wanted)), "cells")
    inside = by_source(chance.withColumn("cell", _cell(1)), first, "inner", "cell")
    finer = inside.groupBy("source", "wanted", "before", _cell(2).alias("cell")).agg(F.sum("size").alias("words"))
    finer = finer.withColumn("wanted", F.col("wanted") - F.col("before")).withColumnRenamed("before", "offset")
    second = stored(_open_cell(finer.drop("offset")), "finer-cells")
    last = by_source(chance.withColumn("cell", _cell(2)), second, "inner", "cell")
    tied = last.groupBy("source", "ratio", "ticket", "wanted", "before").agg(F.sum("size").alias("size"))
    order = Window.partitionBy("source").orderBy("ratio", "ticket")
    ahead = F.col("before") + F.sum("size").over(order) - F.col("size")
    taken = tied.withColumn("ahead", ahead).where(F.col("ahead") + F.col("size") / 2 <= F.col("wanted"))
    ends = taken.groupBy("source").agg(F.max(F.struct("ratio", "ticket")).alias("end"))
    # A source with an open cell takes what is in earlier cells, or up to its end; one without takes all or nothing.
    limits = by_source(by_source(by_source(wanted, first.select("source", F.col("cell").alias("cell1")), "left"),
                                 second.select("source", F.col("cell").alias("cell2")), "left"), ends, "left")
    limits = stored(limits, "limits")

    plan = by_source(by_source(rows, expected, "inner", "appeal"), by_source(goals, limits))
    plan = _with_rank(plan)
    more = (
        F.when(F.col("ratio").isNull() | (F.col("wanted") <= 0), False)
        .when(F.col("cell1").isNull(), True)
        .when(_cell(1) != F.col("cell1"), _cell(1) < F.col("cell1"))
        .when(F.col("cell2").isNull(), True)
        .when(_cell(2) != F.col("cell2"), _cell(2) < F.col("cell2"))
        .otherwise(F.coalesce(F.struct("ratio", "ticket") <= F.col("end"), F.lit(False)))
    )
    copies = F.col("whole") + more.cast("bigint")
    plan = plan.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    keep = [c for c in rows.columns if c not in ("draw", "ticket", "appeal")]
    return plan.select(*keep, "source_size", "target", "copies", "taken")
