"""The version of a key that is valid on a fact's day, without days in between."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daybook.operators.lookup import LEAST_ROWS, SHARES, heavy_keys


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    day: str,
    interval: tuple[str, str],
    values: Sequence[str],
    shares: int = SHARES,
    least: int = LEAST_ROWS,
) -> DataFrame:
    """``facts`` with the ``values`` of the version of their key that is valid on ``day``,
    NULL if none is.

    Facts and versions of a key are one stream in order of days, in which the last
    version that has begun is carried along and counts until its end. So rows are
    facts plus versions, however long the intervals are. Versions of a key must not
    overlap (``violations`` finds them); of several, the one that began last counts, the
    longer of two that begin together. Reversed intervals and those without an end
    cover no day. Facts with a NULL key or day have no version.

    A key with more than one part in ``shares`` of the facts is dealt over parts, each
    with the key's versions, so no stream is long.
    """
    keys, (start, end) = list(keys), interval
    heavy = F.broadcast(heavy_keys(facts, keys, shares, least).select(*keys, F.col("parts").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    held = F.struct(F.col(end).alias("_end"), *values)
    fact = facts.select(*keys, F.col(day).alias("_at"), F.struct("*").alias("_fact"))
    part = F.pmod(F.monotonically_increasing_id(), parts).cast("int").alias("_part")
    stream = fact.join(heavy, keys, "left").select(
        *keys, part, "_at", "_fact", F.lit(None).cast(_type(versions, held)).alias("_version")
    )
    dated = versions.where(F.col(start) <= F.col(end)).select(
        *keys, F.col(start).alias("_at"), held.alias("_version")
    )
    dealt = dated.join(heavy, keys, "left").select(
        *keys,
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"),
        "_at",
        F.lit(None).cast(fact.schema["_fact"].dataType).alias("_fact"),
        "_version",
    )
    # A version that begins on a fact's day comes before the fact.
    in_order = Window.partitionBy(*keys, "_part").orderBy(
        "_at", F.col("_fact").isNotNull(), F.col("_version._end")
    )
    known = F.last("_version", ignorenulls=True).over(in_order)
    met = stream.unionByName(dealt).withColumn("_known", known).where(F.col("_fact").isNotNull())
    valid = F.col("_at").isNotNull() & (F.col("_known._end") >= F.col("_at"))
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    return met.select("_fact.*", *[F.when(valid, F.col("_known")[v]).alias(v) for v in values])


def _type(df: DataFrame, column: Column) -> T.DataType:
    return df.select(column.alias("x")).schema["x"].dataType
