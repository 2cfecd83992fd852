"""Rows dealt over as many parts as the session is set to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def part_count(df: DataFrame) -> int:
    """``spark.sql.shuffle.partitions``, which is set for the size of the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_parts(df: DataFrame, *by: str | Column) -> DataFrame:
    """``df`` in ``part_count`` parts by a hash of ``by``.

    Adaptive execution merges the parts of its own shuffles up to 64 MB of compressed
    rows. A task that adds up, joins and sorts rows of wide decimals holds many times as
    much, in every one of these steps. Parts dealt by number are not merged, and all that
    is done by ``by`` afterwards stays in them.
    """
    return df.repartition(part_count(df), *by)


def row_part(df: DataFrame) -> Column:
    """The part of a row by all it holds and, for rows that are equal, by the task that
    reads it: keys and copies that fill a table are spread, a task that is run again deals
    its rows as before."""
    return F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(part_count(df)))
