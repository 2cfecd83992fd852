"""Contract checks, duplicate and completeness profiles, step audit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions import moscow_now, text_message
from daybook.operators.bloom import bloom_filter, maybe_in
from daybook.schemas import MONEY, Table

# The titles of the two-row duplicate profile.
TOTAL_TITLE = "всего записей"
UNIQUE_TITLE = "уникальных записей"


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _report(df: DataFrame, table: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Aggregate each rule's count in one pass and list them as rows."""
    counts = df.agg(*[count.alias(f"_{i}") for i, (_, _, count) in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.lit(columns).alias("columns"),
                F.coalesce(F.col(f"_{i}"), F.lit(0)).cast("long").alias("violations"),
            )
            for i, (rule, columns, _) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))


def violations(df: DataFrame, table: Table) -> DataFrame:
    """How often ``df`` breaks its contract: one row per rule, zero when kept.

    ``not null`` and ``max length`` count rows, ``unique key`` counts keys that
    occur more than once, ``no overlap`` counts versions that begin before an
    earlier version of the same entity has ended. Rows are merged per key before
    versions are compared, so an entity is at most one row per start date there.
    """
    parts = []
    simple = [("not null", c, _count_if(F.col(c).isNull())) for c in table.required] + [
        ("max length", c, _count_if(F.length(c) > n)) for c, n in table.max_length.items()
    ]
    if simple:
        parts.append(_report(df, table.name, simple))
    if table.key:
        key = ", ".join(table.key)
        rules = [("unique key", key, _count_if(F.col("_rows") > 1))]
        sizes = [F.count(F.lit(1)).alias("_rows")]
        if table.interval is None:
            keyed = df.groupBy(*table.key).agg(*sizes)
        else:
            start, end = table.interval
            entity = [c for c in table.key if c != start]
            sizes.append(F.max(F.when(F.col(end) >= F.col(start), F.col(end))).alias("_end"))
            earlier = (
                Window.partitionBy(*entity)
                .orderBy(start)
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            keyed = df.groupBy(*table.key).agg(*sizes)
            keyed = keyed.withColumn("_earlier_end", F.max("_end").over(earlier))
            overlap = F.col("_end").isNotNull() & (F.col("_earlier_end") >= F.col(start))
            rules.append(("no overlap", f"{start}, {end}", _count_if(overlap)))
        parts.append(_report(keyed, table.name, rules))
    return reduce(DataFrame.unionByName, parts)


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Count of all rows and of distinct rows, as two titled rows.

    Rows meet as 64-bit hashes of all columns, counted within each map task first. A
    hash that occurs once is a distinct row; only rows whose hash occurs again are
    compared whole. So what is shuffled does not follow the width of the rows but of
    those repeated, and rows with equal hashes are not taken for equal.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    counts = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = counts.where(F.col("_rows") > 1).select("_hash")
    near = maybe_in(hashed, "_hash", bloom_filter(repeated, "_hash"))
    # Copies are merged within each task before they move.
    whole = near.distinct().join(repeated, "_hash", "left_semi")
    alone = F.count(F.when(F.col("_rows") == 1, 1))
    sums = counts.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"), alone.alias("unique")
    ).unionByName(whole.agg(F.lit(0).cast("long").alias("total"), F.count(F.lit(1)).alias("unique")))
    found = sums.agg(F.sum("total").alias("total"), F.sum("unique").alias("unique"))
    rows = [
        F.struct(F.lit(title).alias("title"), F.col(name).cast("long").alias("count"))
        for title, name in ((TOTAL_TITLE, "total"), (UNIQUE_TITLE, "unique"))
    ]
    return found.select(F.inline(F.array(*rows)))


def duplicate_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once, key columns first. Rows with a
    NULL in the key are not listed.

    Keys are counted first; a Bloom filter of the repeated ones, of bounded size, then
    drops the rows of other keys where they are read. What is left moves once, by
    key, and adaptive execution splits a key that fills too much.
    """
    keys = list(keys)
    given = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counted = df.where(given).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = counted.where(F.col("_rows") > 1).select(*keys, F.xxhash64(*keys).alias("_hash"))
    hashed = df.where(given).withColumn("_hash", F.xxhash64(*keys))
    near = maybe_in(hashed, "_hash", bloom_filter(repeated, "_hash"))
    listed = near.join(repeated.select(keys), keys, "left_semi")
    return listed.select(*keys, *[c for c in df.columns if c not in keys])


def nonnull_profile(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Count of filled values per column and group; NULL groups are kept. The
    grouping columns' own counts are named with ``_c``."""
    return df.groupBy(*by).agg(
        *[F.count(c).alias(f"{c}_c") for c in by],
        *[F.count(c).alias(c) for c in df.columns if c not in by],
    )


def step_audit(
    step: str, df: DataFrame, day: str = "on_date", amount: str | None = None
) -> DataFrame:
    """What a step produced: per day its rows and the sum of one amount."""
    total = F.sum(amount).cast("decimal(38,8)") if amount else F.lit(None).cast("decimal(38,8)")
    return (
        df.groupBy(F.col(day).alias("on_date"))
        .agg(F.count(F.lit(1)).alias("row_count"), total.alias("amount"))
        .select(F.lit(step).alias("step"), "on_date", "row_count", "amount")
    )


def run_log(audit: DataFrame, log_type: str = "info") -> DataFrame:
    """Audit rows as run-log entries with the Moscow time of writing."""
    message = text_message(
        F.col("step"), " ", F.col("on_date"), ": ", F.col("row_count"), " rows"
    )
    return audit.select(
        moscow_now().alias("date_time"),
        F.lit(log_type).alias("log_type"),
        message.alias("log_message"),
    )
