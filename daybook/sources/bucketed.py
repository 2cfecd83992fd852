"""Tables stored in buckets of one key, so that joins on it move nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_bucketed(
    df: DataFrame, table: str, path: str, buckets: int, by: str = "account_rk"
) -> DataFrame:
    """Replace a table stored in ``buckets`` files by a hash of ``by``, sorted by it, and
    return it as read back.

    Tables of the same key and number of buckets meet on the key without a shuffle: the
    one shuffle is paid here, once per load, not by every query. Choose the number so
    that a bucket of the largest table fits a task; a key that alone fills more
    than that (a join on a currency) does not belong here.

    ``table`` is a name in the session's catalog, which is what carries the buckets; the
    files lie in ``path``. ``df`` must not read from there.
    """
    (
        df.repartition(buckets, by)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, by)
        .sortBy(by)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)
