"""Joins to reference data whose keys are unevenly used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one part in so many of the rows is a heavy one, and the keys that a
#: sketch keeps apart. So heavy keys are fewer than SHARES.
SHARES, TRACKED = 200, 10_000
#: A key of fewer rows is never heavy: it fits a task.
LEAST_ROWS = 100_000


def heavy_keys(
    df: DataFrame, keys: Sequence[str], shares: int = SHARES, least: int = LEAST_ROWS
) -> DataFrame:
    """``keys`` and ``parts``: keys with more than one part in ``shares`` of the rows, and
    into how many parts of that size their rows fall.

    A frequent-items sketch of the keys' hashes, of bounded size and one pass, proposes
    candidates; it misses no key of such a share. Only candidates are counted exactly.
    Rows with a NULL in the key are of no key.
    """
    keys = list(keys)
    given = df.select(keys).dropna()
    by_hash = F.xxhash64(*keys)
    top = given.agg(
        F.call_function("approx_top_k", by_hash, F.lit(shares), F.lit(TRACKED)).alias("top"),
        F.count(F.lit(1)).alias("_total"),
    )
    likely = top.select(F.inline("top"), "_total").select(F.col("item").alias("_hash"), "_total")
    counted = (
        given.withColumn("_hash", by_hash)
        # At most as many rows as shares, one per candidate.
        .join(F.broadcast(likely), "_hash")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.any_value("_total").alias("_total"))
    )
    share = F.greatest(F.col("_total") / shares, F.lit(float(least)))
    return counted.where(F.col("_rows") > share).select(
        *keys, F.ceil(F.col("_rows") / share).cast("int").alias("parts")
    )


def left_join_skewed(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    shares: int = SHARES,
    least: int = LEAST_ROWS,
) -> DataFrame:
    """Left join of two large tables either of which may hold one key very often.

    Adaptive execution splits an overfull key of the left side of a left join, not of
    the right one. So the few heavy keys of ``right`` are found by a sketch and
    their rows dealt over parts; left rows of these keys meet every part. All others
    take the same join as part 0, and ``left`` is read and shuffled once. A left row
    of a heavy key has a match for sure, so its copies without one are dropped.
    """
    keys = list(keys)
    heavy = heavy_keys(right, keys, shares, least)
    heavy = F.broadcast(heavy.select(*keys, F.col("parts").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = right.join(heavy, keys, "left").withColumn(
        "_part", F.pmod(F.monotonically_increasing_id(), parts).cast("int")
    )
    met = left.join(heavy.withColumnRenamed("_parts", "_copies"), keys, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))
    )
    joined = met.join(dealt.drop("_parts").withColumn("_matched", F.lit(True)), [*keys, "_part"], "left")
    kept = F.col("_copies").isNull() | F.col("_matched").isNotNull()
    return joined.where(kept).drop("_part", "_copies", "_matched")
