"""Tables and delimited files written from DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import Period
from daybook.operators.maintain import upsert
from daybook.session import scratch_path

#: Days of a period at most whose rows are counted while they are written.
COUNTED_DAYS = 62


def overwrite_table(
    df: DataFrame, path: str | None = None, fmt: str = "parquet", **options: str
) -> None:
    """Replace a whole stored table. ``df`` must not read from the same place."""
    writer = df.write.mode("overwrite").format(fmt).options(**options)
    if path is not None:
        writer.save(path)
    else:
        writer.save()


def write_delimited(
    df: DataFrame, path: str, *, sep: str = ";", encoding: str = "utf-8"
) -> None:
    """Replace a folder of delimited files, each with a header line."""
    df.write.mode("overwrite").options(header=True, sep=sep, encoding=encoding).csv(path)


def replace_days(
    df: DataFrame,
    path: str,
    period: Period,
    day: str = "on_date",
    compact: bool = True,
    counted: bool = False,
) -> dict[date, int] | None:
    """Replace the days of ``period`` in a parquet table partitioned by ``day``.

    The new days are written beside the old ones and take their place when the job
    has succeeded; if it fails, the stored days stay as they were. Then the period's
    days that ``df`` does not hold are emptied. Other days are not read or rewritten.
    A row outside the period or without a day raises. ``df`` must not read the
    period's days from ``path``. Running it again after a failure is safe.

    ``compact`` brings each day's rows together before writing, so that a day has
    as many files as its size asks for; adaptive execution cuts large days into
    several parts. It moves all rows once. Without it each task writes a file per day.

    ``counted`` returns the rows of each day of the period, counted by the tasks that
    write them: nothing is read again. It is for periods of up to ``COUNTED_DAYS``,
    as each day is a counter in every task.
    """
    if counted and period.days > COUNTED_DAYS:
        raise ValueError(f"only {COUNTED_DAYS} days are counted while writing, not {period.days}")
    inside = F.coalesce(period.contains(day), F.lit(False))
    stray = F.raise_error(F.lit(f"a row to store has no {day} in {period.start} to {period.end}"))
    rows = df.withColumn(day, F.when(inside, F.col(day)).otherwise(stray.cast("date")))
    spark = df.sparkSession
    before = _files_by_day(spark, path, df.schema, period, day)
    found = _write_days(rows, path, day, compact, period.all_days() if counted else None)
    # A day that was overwritten has none of its old files left.
    for value, names in _files_by_day(spark, path, df.schema, period, day).items():
        if names & before.get(value, set()):
            _empty_day(spark, df, path, day, value)
    return found


def merge_days(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    day: str = "on_date",
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
) -> list[date]:
    """Merge ``source`` by ``keys`` into a parquet table partitioned by ``day``, and
    return the days it named.

    As ``upsert``, but only the days that ``source`` names are read and rewritten: a key
    holds its day, so a row never changes it, and the files of all other days stay
    untouched. The delivery and the merged days are written to the scratch folder
    first; what can fail has failed before a stored day is replaced, and running it again
    is safe. A delivery without rows changes nothing. The days come to the driver:
    as many as a calendar has.

    ``schema`` is the table's, needed while it has no files, with ``day`` in it.
    """
    if day not in keys:
        raise ValueError(f"the key {list(keys)} must hold {day}, or rows could change their day")
    spark = source.sparkSession
    given = _staged(source, "delivery")
    days = sorted(r[0] for r in given.select(day).distinct().collect() if r[0] is not None)
    if not days and given.isEmpty():
        return days
    schema = schema or spark.read.parquet(path).schema
    stored = _stored_days(spark, path, schema, day, days)
    merged = _staged(upsert(stored, given, keys, columns), "merged")
    _write_days(merged, path, day, compact=True)
    return days


def write_by_day(df: DataFrame, path: str, day: str) -> None:
    """Replace a whole stored table by one partitioned by ``day``."""
    df.hint("rebalance", day).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(day).parquet(path)


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write_days(
    rows: DataFrame, path: str, day: str, compact: bool, counted: Sequence[date] | None = None
) -> dict[date, int] | None:
    """Replace the days that ``rows`` hold; how many rows each of ``counted`` got."""
    rows = rows.hint("rebalance", day) if compact else rows
    observed = Observation()
    if counted is not None:
        # Nothing is shuffled after this, so no task that counts is run for nothing.
        counts = [F.count(F.when(F.col(day) == F.lit(d), 1)).alias(d.isoformat()) for d in counted]
        rows = rows.observe(observed, *counts)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    if counted is None:
        return None
    return {date.fromisoformat(d): n for d, n in observed.get.items()}


def _stored_days(
    spark: SparkSession, path: str, schema: T.StructType, day: str, days: Sequence[date]
) -> DataFrame:
    """The rows of some days of a stored table: other days' files are not opened."""
    if not _data_files(spark, path, schema, day):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).parquet(path).select(schema.names)
    return table.where(F.col(day).isin(list(days)))


def _data_files(spark: SparkSession, path: str, schema: T.StructType, day: str) -> list[str]:
    """The data files of a table stored by day, whose folder is made if it is not there."""
    spark.createDataFrame([], schema).write.mode("append").partitionBy(day).parquet(path)
    return spark.read.schema(schema).parquet(path).inputFiles()


def _files_by_day(
    spark: SparkSession, path: str, schema: T.StructType, period: Period, day: str
) -> dict[str, set[str]]:
    """The data files of each stored day of the period."""
    found: dict[str, set[str]] = {}
    for file in _data_files(spark, path, schema, day):
        folder, _, name = file.rpartition("/")
        column, _, value = folder.rpartition("/")[2].partition("=")
        if column == day and period.start.isoformat() <= value <= period.end.isoformat():
            found.setdefault(value, set()).add(name)
    return found


def _empty_day(spark: SparkSession, df: DataFrame, path: str, day: str, value: str) -> None:
    """Replace a stored day by one file without rows."""
    rest = T.StructType([f for f in df.schema if f.name != day])
    spark.createDataFrame([], rest).coalesce(1).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/{day}={value}"
    )
