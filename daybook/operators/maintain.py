"""Changes to stored tables, as functions from old to new contents.

A result must be written to another place than the one its inputs are read from,
or per partition with ``sources.replace_days``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.bloom import WORDS, bloom_filter, maybe_in
from daybook.operators.parts import in_parts, row_part


def _one_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``, raising when it is read if a key is repeated or NULL.

    Counting per key keeps a key repeated very often from being gathered in one place.
    """
    rest = [F.any_value(c).alias(c) for c in source.columns if c not in keys]
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *rest)
    given = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    check = F.assert_true(
        (F.col("_rows") == 1) & given, F.lit(f"upsert needs one row per key {list(keys)}")
    )
    return counted.where(check.isNull()).drop("_rows")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``: matched rows are updated, new
    ones inserted, the rest stays. Repeated or NULL source keys raise.

    ``columns`` are those the source supplies, by default all. Others keep their
    value in updated rows and are NULL in inserted ones. With all columns the target
    loses the source's keys and gains its rows, and a source small enough to be
    broadcast leaves it unshuffled; with some, both are read once and meet in one join.
    """
    keys = list(keys)
    supplied = list(columns) if columns is not None else target.columns
    missing = set(keys) - set(supplied)
    if missing:
        raise ValueError(f"the source must supply its keys, lacks {sorted(missing)}")
    kept = [c for c in target.columns if c not in supplied]
    source = _one_per_key(source.select(supplied), keys)
    if not kept:
        stays = target.join(source.select(keys), keys, "left_anti")
        return stays.unionByName(source.select(target.columns))

    fresh = source.select(
        *keys,
        F.lit(True).alias("_matched"),
        *[F.col(c).alias(f"_new_{c}") for c in supplied if c not in keys],
    )
    return target.join(fresh, keys, "full_outer").select(
        *[
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in supplied and c not in keys
            else F.col(c)
            for c in target.columns
        ]
    )


def replace_slice(target: DataFrame, in_slice: Column, new: DataFrame) -> DataFrame:
    """Delete the rows of ``target`` where ``in_slice`` is true, then add ``new``.
    Rows for which the condition is NULL stay, as with SQL ``delete``."""
    return target.where(~F.coalesce(in_slice, F.lit(False))).unionByName(new)


def append_new(target: DataFrame, source: DataFrame) -> DataFrame:
    """Add the rows of ``source`` that ``target`` does not hold yet.

    Repeated new rows are added once; rows already in ``target`` stay as they are,
    repeated or not. NULLs compare as equal.

    Rows meet by a 64-bit hash of all columns. A Bloom filter of the source's hashes, of
    bounded size, is sent to the target first: hashes that the source cannot hold are
    dropped where they are read, so what is shuffled follows the delivery and not
    the table. The target's rows whose hash the source has are then compared
    whole, so that an equal hash of other rows drops nothing.
    """
    return _append_new(target, source, F.xxhash64(*target.columns))


def _append_new(
    target: DataFrame, source: DataFrame, row_hash: Column, words: int = WORDS
) -> DataFrame:
    columns = target.columns
    fresh = source.select(columns).distinct().withColumn("_hash", row_hash)
    bloom = bloom_filter(source.select(row_hash.alias("_hash")), "_hash", words)
    near = maybe_in(target.withColumn("_hash", row_hash), "_hash", bloom, words)
    # A row that the target repeats often is one hash here.
    hashes = near.select("_hash").distinct()
    absent = fresh.join(hashes, "_hash", "left_anti")
    doubtful = fresh.join(hashes, "_hash", "left_semi")
    held = near.join(doubtful.select("_hash"), "_hash", "left_semi").distinct()
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"fresh.{c}").eqNullSafe(F.col(f"held.{c}")) for c in ["_hash", *columns]],
    )
    other = doubtful.alias("fresh").join(held.alias("held"), same, "left_anti")
    return target.unionByName(absent.select(columns)).unionByName(other.select(columns))


def dedupe(df: DataFrame) -> DataFrame:
    """Keep one of each fully identical row; NULLs compare as equal.

    Rows are dealt over parts first, and copies within a part merged before they move
    again: a file that gives more rows than a task holds is spread, and so is a row that
    fills the table.
    """
    return in_parts(df, row_part(df)).dropDuplicates()
