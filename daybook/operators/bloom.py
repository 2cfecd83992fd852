"""A Bloom filter of row hashes as a small table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words of a filter: 4 MB of bits, at most some 20 MB as a broadcast table. Up to a few
#: million hashes it passes about one hash in twenty that it was not given; beyond, more.
WORDS = 1 << 19


def _word(row_hash: Column, words: int) -> Column:
    return F.pmod(row_hash, F.lit(words))


def _bits(row_hash: Column) -> Column:
    """Three bits of a word, from parts of the hash that do not choose the word."""
    one = F.lit(1).cast("long")

    def bit(shift: int) -> Column:
        place = F.shiftrightunsigned(row_hash, shift).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", one, place)

    return bit(44).bitwiseOR(bit(50)).bitwiseOR(bit(56))


def bloom_filter(hashes: DataFrame, column: str, words: int = WORDS) -> DataFrame:
    """``word``, ``bits``: at most ``words`` rows, whatever is put in. Hashes are merged
    in each task before they move."""
    row_hash = F.col(column)
    return hashes.groupBy(_word(row_hash, words).alias("word")).agg(
        F.bit_or(_bits(row_hash)).alias("bits")
    )


def maybe_in(
    df: DataFrame, column: str, bloom: DataFrame, words: int = WORDS
) -> DataFrame:
    """The rows of ``df`` whose hash the filter may have been given: none that it was
    given is lost. Rows stay where they are; the filter, bounded by ``words``, is sent."""
    small = bloom.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    met = df.withColumn("_word", _word(F.col(column), words)).join(F.broadcast(small), "_word")
    wanted = _bits(F.col(column))
    return met.where(F.col("_bits").bitwiseAND(wanted) == wanted).select(df.columns)
