"""Mixing of sources to target weights by iterative proportional fitting."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from math import exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import stored

#: Rounds at most, and the largest deviation from a target share that ends them.
ROUNDS, CLOSE = 24, 1e-5
#: Rounds of one written step.
STRIDE = 3
#: Share of a sample, in words, that cells may hold which are kept whole.
WHOLE = 0.01
log = logging.getLogger(__name__)


def _aimed(cells: DataFrame, margins: Sequence[str], targets: Mapping[str, DataFrame]) -> DataFrame:
    """cells with weight and, per margin, the mass that the cell's value shall have: null
    without a target. Shares are scaled to 1 over the values that have mass."""
    start = F.col("weight") if "weight" in cells.columns else F.lit(1.0).alias("weight")
    now = cells.select(*margins, "mass", start)
    for i, margin in enumerate(margins):
        aim = targets[margin].where("share > 0").select(margin, F.col("share").alias(f"share{i}"))
        now = now.join(aim, margin, "left").withColumn(f"part{i}", F.try_divide(F.col("mass"), F.sum("mass").over(Window.partitionBy(margin))))
    now = stored(now, "cells")
    # A value's cells hold parts of it that add up to 1, so this adds each share once.
    sums = now.where("mass > 0").agg(F.sum("mass"), *[F.sum(F.col(f"share{i}") * F.col(f"part{i}")) for i in range(len(margins))]).first()
    total = sums[0] or 0.0
    goals = [(F.col(f"share{i}") * (total / (sums[i + 1] or 1.0))).alias(f"goal{i}") for i in range(len(margins))]
    return now.select(*margins, "mass", "weight", *goals)


def rake(cells: DataFrame, margins: Sequence[str], targets: Mapping[str, DataFrame], rounds: int = ROUNDS, most: float | None = None) -> DataFrame:
    """Weights of cells (margins..., mass) that meet the targets' shares: cells with weight.

    targets: for each margin a frame (margin, share). In every round each margin in
    turn gets a factor per value: its target mass by its present mass. A cell's weight
    is the product of its factors. Values without a target or with share 0 get weight
    0; target values that no cell has are left out, and shares are scaled to 1. Null is
    no value: give it a name.

    most: no weight passes it; the cells below it then make up for those at it, as far
    as they can, and rounds end when weights stay. Weights that cells bring are the start.
    Rounds end after so many all the same: deviations tells what is met.

    Cells are aggregates, so a value's cells fit a window partition, which spills.
    Present masses are sums over windows: no join, no broadcast, nothing on the driver
    but one row. STRIDE rounds are written at once, so that lineage does not grow.
    """
    now = _aimed(cells, margins, targets)
    for done in range(0, rounds, STRIDE):
        for _ in range(min(STRIDE, rounds - done)):
            now = now.withColumn("before", F.col("weight")).withColumn("step", F.lit(0.0))
            for i, margin in enumerate(margins):
                present = F.sum(F.col("mass") * F.col("weight")).over(Window.partitionBy(margin))
                now = now.withColumn("present", present)
                factor = F.when(F.col("present") > 0, F.coalesce(F.col(f"goal{i}"), F.lit(0.0)) / F.col("present")).otherwise(0.0)
                weight = F.col("weight") * F.col("factor")
                now = now.withColumn("factor", factor).select(
                    *[c for c in now.columns if c not in ("weight", "step", "present")],
                    (weight if most is None else F.least(weight, F.lit(most))).alias("weight"),
                    F.greatest("step", F.when(F.col("present") > 0, F.abs(F.col("factor") - 1)).otherwise(0.0)).alias("step"),
                )
        if most is not None:
            now = now.withColumn("step", F.when(F.col("before") > 0, F.abs(F.col("weight") / F.col("before") - 1)).otherwise(0.0))
        now = stored(now.drop("before"), "weights")
        if (now.agg(F.max("step")).first()[0] or 0.0) < CLOSE:
            break
    return now.select(*margins, "mass", "weight")


def deviations(raked: DataFrame, margins: Sequence[str], targets: Mapping[str, DataFrame]) -> DataFrame:
    """margin, value, target, share, deviation: for every value of a margin with mass or
    with a target its target share, the share of the weighted mass and their difference."""
    out = None
    for margin in margins:
        there = raked.where("mass > 0").groupBy(margin).agg(F.sum(F.col("mass") * F.col("weight")).alias("mass"))
        both = targets[margin].select(margin, "share").join(there, margin, "full")
        wanted = F.when(F.col("mass").isNotNull(), F.coalesce("share", F.lit(0.0)))
        # One margin's values are few beside its cells; their sums are one row each.
        sums = both.agg(F.sum(wanted), F.sum("mass")).first()
        target, share = F.coalesce(wanted, F.lit(0.0)) / (sums[0] or 1.0), F.coalesce("mass", F.lit(0.0)) / (sums[1] or 1.0)
        rows = both.select(F.lit(margin).alias("margin"), F.col(margin).cast("string").alias("value"), target.alias("target"), share.alias("share"))
        out = rows if out is None else out.union(rows)
    return out.withColumn("deviation", F.col("share") - F.col("target"))


def token_mass(text: Column) -> Column:
    """Words of a text, the mass that is mixed; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("double")


def topic(text: Column) -> Column:
    """A coarse kind of text by its form: table, list of short lines, long or short prose."""
    lines = F.regexp_count(text, F.lit("\n")) + 1
    return (
        F.when(text.isNull() | (F.length(text) == 0), "empty")
        .when(F.regexp_count(text, F.lit(r"\|")) > 2 * lines, "table")
        .when(F.length(text) < 60 * lines, "list")
        .when(F.length(text) > 6000, "long")
        .otherwise("prose")
    )


def tempered(docs: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares of a margin: its shares of the mass to a power, so that the large
    shrink and the small grow (0: all equal, 1: as they are)."""
    sums = docs.groupBy(margin).agg(F.sum("mass").alias("mass")).where("mass > 0")
    return sums.select(margin, F.pow("mass", F.lit(power)).alias("share"))


def largest_weight(raked: DataFrame, whole: float = WHOLE) -> tuple[float, bool]:
    """The least weight that all cells but those with a share of whole of the weighted
    mass stay below, to 1 part in 100, and whether any cell passes it.

    Weights are added up by steps of their logarithm, so few rows come to the driver.
    """
    weighted = raked.where("mass > 0 and weight > 0").withColumn("step", F.ceil(F.log("weight") * 100))
    steps = weighted.groupBy("step").agg(F.sum(F.col("mass") * F.col("weight")).alias("mass"), F.max("weight").alias("most")).collect()
    left = whole * sum(r["mass"] for r in steps)
    for at, r in enumerate(sorted(steps, key=lambda r: -r["step"])):
        left -= r["mass"]
        if left < 0:
            return min(r["most"], exp(r["step"] / 100)), at > 0
    return 1.0, False


def sampled(docs: DataFrame, power: float = 0.8, budget: float = 1.0) -> DataFrame:
    """The documents that a mixture keeps: docs with topic, n_words, weight, keep_chance.

    Token mass is raked to tempered shares of source, language and topic (null is a
    value of its own). A document's chance to stay is its cell's weight times a rate,
    times budget. The rate is the largest at which the cells that would pass a chance of
    1 hold WHOLE of the sample at most: they are kept whole, and the others are raked
    again to make up for them. So rare values, which no sample can raise above what
    there is, do not set the rate, and the shares that stay equal the targets in
    expectation but for WHOLE. The share of words kept is logged. Whether it stays hangs on a hash of doc_id and
    text alone: same input, same sample. Documents without words have chance 0 and
    go. Columns of docs named like the new ones are replaced. Empty docs give an empty
    result; repeated rows stay or go together.

    Mass is added up to cells in each task before anything moves, and only cells and
    factors meet again, so a source with a third of all rows is no hot key.
    """
    # The row travels as one column, so no name of it can clash.
    added = ("topic", "n_words", "weight", "keep_chance")
    named = docs.select(
        F.struct("*").alias("row"),
        topic(F.col("text")).alias("topic"),
        token_mass(F.col("text")).alias("n_words"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source"),
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("lang"),
    )
    margins = ("source", "lang", "topic")
    cells = stored(named.groupBy(*margins).agg(F.sum("n_words").alias("mass")), "mass")
    targets = {m: tempered(cells, m, power) for m in margins}
    raked = rake(cells, margins, targets)
    most, passed = largest_weight(raked)
    if passed:
        raked = rake(raked, margins, targets, most=most)
    sums = raked.agg(F.sum("mass"), F.sum(F.col("mass") * F.col("weight"))).first()
    log.info("a share of %.4f of the words is kept", (sums[1] or 0.0) / most * budget / (sums[0] or 1.0))
    if log.isEnabledFor(logging.INFO):
        for r in deviations(raked, margins, targets).groupBy("margin").agg(F.max(F.abs("deviation")).alias("d")).collect():
            log.info("shares of %s are within %.6f of their targets", r["margin"], r["d"])
    raked = raked.select(*margins, "weight")
    chance = F.when(F.col("n_words") > 0, F.least(F.lit(1.0), F.coalesce("weight", F.lit(0.0)) * F.lit(budget / most)))
    draw = (F.pmod(F.xxhash64("row.doc_id", "row.text"), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    return (
        named.join(raked, list(margins), "left")
        .withColumn("keep_chance", F.round(F.coalesce(chance, F.lit(0.0)), 9))
        .where(draw < F.col("keep_chance"))
        .select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)
    )
