"""Delimited files against a table's contract: good rows, and lines that break it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import code_page_text
from daybook.schemas import Table
from daybook.session import scratch_path
from daybook.sources.readers import SPARK_ENCODINGS

#: Digits of a surrogate key, as the contract's tables have them.
KEY_DIGITS = 10


@dataclass(frozen=True)
class Loaded:
    """rows: the typed rows of lines that keep the contract. rejects: file, line and
    rules (what each other line breaks)."""

    rows: DataFrame
    rejects: DataFrame


def _typed(text: Column, kind: T.DataType, pattern: str | None) -> tuple[Column, Column, str]:
    """The value of a text, NULL if it is none; whether it is one; what it should be."""
    if isinstance(kind, T.DateType):
        shape = pattern or "yyyy-MM-dd"
        value = F.try_to_timestamp(text, F.lit(shape)).cast("date")
        return value, value.isNotNull(), f"not a date as {shape}"
    value = text.try_cast(kind) if not isinstance(kind, T.StringType) else text
    if isinstance(kind, T.LongType):
        fits = F.coalesce(F.abs(value) < F.lit(10**KEY_DIGITS), F.lit(False))
        return value, fits, f"not a number of {KEY_DIGITS} digits"
    return value, value.isNotNull(), "not a number"


def read_checked(
    spark: SparkSession,
    path: str,
    table: Table,
    *,
    sep: str = ";",
    encoding: str = "utf-8",
    patterns: Mapping[str, str] | None = None,
) -> Loaded:
    """Files of a table's columns in order, with a header line, typed and checked.

    A line is rejected for a wrong number of fields, a text that is not of its column's
    type, a missing required value or a text that is too long; all rules that it
    breaks are named. Good lines load all the same: rows and rejects together are the
    files' lines, less empty ones and headers (lines equal to the header, by name).
    ``patterns`` are the date patterns of columns. A line is one record: quoted line
    ends are not supported.

    The files are read once. Typed lines are written to the scratch folder, and both
    results read from there, so they cannot differ if files change or tasks run again.
    """
    known = encoding.lower() in SPARK_ENCODINGS
    lines = spark.read.option("encoding", encoding if known else "iso-8859-1").text(path)
    value = F.col("value") if known else code_page_text("value", encoding)
    lines = lines.select(F.col("_metadata.file_name").alias("_file"), value.alias("_line"))
    header = sep.join(table.columns)
    lines = lines.where((F.trim("_line") != "") & (F.lower("_line") != F.lit(header.lower())))

    # One column more than the table has, for lines that are too long or too short.
    fields = T.StructType(
        [T.StructField(f"c{i}", T.StringType()) for i in range(len(table.columns))]
        + [T.StructField("_bad", T.StringType())]
    )
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    split = lines.withColumn("_f", F.from_csv("_line", fields.simpleString(), options))
    whole = F.col("_f").isNotNull() & F.col("_f._bad").isNull()
    rules = [F.when(~whole, F.lit("not as many fields as columns"))]
    typed = []
    for i, column in enumerate(table.schema):
        name, text = column.name, F.col(f"_f.c{i}")
        cast, fits, problem = _typed(text, column.dataType, (patterns or {}).get(name))
        typed.append(cast.alias(name))
        rules.append(F.when(whole & text.isNotNull() & ~fits, F.lit(f"{name}: {problem}")))
        if name in table.required:
            rules.append(F.when(whole & text.isNull(), F.lit(f"{name}: missing")))
        if name in table.max_length:
            most = table.max_length[name]
            rules.append(
                F.when(whole & (F.length(text) > most), F.lit(f"{name}: over {most} letters"))
            )
    broken = F.array_compact(F.array(*rules))
    checked = split.select(F.struct(*typed).alias("_row"), "_file", "_line", broken.alias("_rules"))
    place = scratch_path(spark, "checked")
    checked.write.parquet(place)
    stored = spark.read.schema(checked.schema).parquet(place)
    return Loaded(
        stored.where(F.size("_rules") == 0).select("_row.*"),
        stored.where(F.size("_rules") > 0).select(
            F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_rules").alias("rules")
        ),
    )
