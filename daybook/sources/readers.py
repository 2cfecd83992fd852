"""Delimited files and tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import code_page_text
from daybook.schemas import DM_FORM101

# The encodings Spark's CSV reader accepts by name.
SPARK_ENCODINGS = {
    "utf-8",
    "us-ascii",
    "iso-8859-1",
    "utf-16",
    "utf-16be",
    "utf-16le",
    "utf-32",
}


def read_delimited(
    spark: SparkSession,
    path: str,
    *,
    sep: str = ";",
    schema: T.StructType | None = None,
    encoding: str = "utf-8",
    dedupe: bool = False,
    mode: str | None = None,
) -> DataFrame:
    """Files with a header line. Without ``schema`` every column is text.

    ``dedupe`` keeps one of each fully identical row. For a table without a key
    it also merges genuinely repeated records, so it is the caller's choice.
    ``mode`` says what a malformed line does. With ``schema`` it raises by default
    (``FAILFAST``), also for a missing or surplus field; without, short lines are
    filled up with NULLs (``PERMISSIVE``), and typing raises later.

    Windows code pages, which Spark does not read by name, are read byte for
    byte and translated afterwards; that needs a single-byte encoding.
    """
    known = encoding.lower() in SPARK_ENCODINGS
    reader = spark.read.options(
        sep=sep,
        header=True,
        encoding=encoding if known else "iso-8859-1",
        mode=mode or ("PERMISSIVE" if schema is None else "FAILFAST"),
        # A line is read whole, or its number of fields would go unchecked.
        columnPruning=False,
    )
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    if not known:
        df = df.select(
            [
                code_page_text(f.name, encoding).alias(f.name)
                if isinstance(f.dataType, T.StringType)
                else F.col(f.name)
                for f in df.schema
            ]
        )
    return df.distinct() if dedupe else df


def read_form101_csv(spark: SparkSession, path: str) -> DataFrame:
    """A form 101 export read back with its fixed column types."""
    return read_delimited(spark, path, schema=DM_FORM101.schema)


def read_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """A whole stored table, in any format Spark knows. With ``schema`` nothing is
    read to find the columns, and a table still without files is empty.

    For a database pass ``fmt="jdbc"`` with its options; give ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` too, or Spark fetches the
    table through a single task.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()
