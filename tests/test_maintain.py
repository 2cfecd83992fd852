import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from daybook.operators import append_new, dedupe, replace_slice, upsert
from daybook.operators.maintain import _append_new
from daybook.operators.parts import row_part
from helpers import BROADCAST, rows


def table(spark, *data):
    return spark.createDataFrame(list(data), "k long, a string, b string")


def test_upsert_updates_inserts_and_keeps(spark):
    target = table(spark, (1, "old", "x"), (2, "old", "y"))
    source = table(spark, (2, "new", None), (3, "new", "z"))
    result = upsert(target, source, ["k"])
    assert rows(result) == [(1, "old", "x"), (2, "new", None), (3, "new", "z")]
    assert rows(upsert(result, source, ["k"])) == rows(result)


def test_partial_upsert_keeps_unlisted_columns(spark):
    target = table(spark, (1, "old", "x"), (2, "old", "y"))
    source = spark.createDataFrame([(2, None), (3, "new")], "k long, a string")
    result = upsert(target, source, ["k"], ["k", "a"])
    assert rows(result) == [(1, "old", "x"), (2, None, "y"), (3, "new", None)]
    assert rows(upsert(result, source, ["k"], ["k", "a"])) == rows(result)


@pytest.mark.parametrize("columns", [None, ["k", "a"]])
@pytest.mark.parametrize("bad", [[(1, "a", "b"), (1, "c", "d")], [(None, "a", "b")]])
@pytest.mark.parametrize("held", [[], [(1, "old", "x")]])
def test_upsert_rejects_repeated_and_missing_keys(spark, columns, bad, held):
    result = upsert(table(spark, *held), table(spark, *bad), ["k"], columns)
    for action in (result.count, result.collect):
        with pytest.raises(PySparkException, match="one row per key"):
            action()


@pytest.mark.parametrize("columns, scans", [(["k", "a"], 2), (None, 3)])
def test_upsert_reads_the_target_once(spark, tmp_path, capsys, columns, scans):
    for name in ("target", "source"):
        table(spark, (1, "a", "b")).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "source"))
    # Plans shorten long paths unless told otherwise.
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        upsert(target, source, ["k"], columns).explain()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == scans
    assert plan.count(f"{tmp_path}/target") == 1


def test_upsert_needs_its_keys_among_the_columns(spark):
    with pytest.raises(ValueError):
        upsert(table(spark), table(spark), ["k"], ["a"])


def test_replace_slice_keeps_rows_with_unknown_condition(spark):
    target = table(spark, (1, "in", None), (2, None, None), (3, "out", None))
    new = table(spark, (9, "in", "n"))
    result = replace_slice(target, F.col("a") == "in", new)
    assert rows(result) == [(2, None, None), (3, "out", None), (9, "in", "n")]
    assert rows(replace_slice(target, F.col("a") == "in", table(spark))) == [
        (2, None, None),
        (3, "out", None),
    ]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_append_new_compares_nulls_and_adds_copies_once(spark, threshold):
    spark.conf.set(BROADCAST, threshold)
    target = table(spark, (1, None, "x"), (1, None, "x"), (2, "a", "b"))
    source = table(spark, (1, None, "x"), (3, None, None), (3, None, None), (2, "a", None))
    result = append_new(target, source)
    assert rows(result) == sorted(
        [(1, None, "x"), (1, None, "x"), (2, "a", "b"), (3, None, None), (2, "a", None)], key=repr
    )
    assert rows(append_new(result, source)) == rows(result)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_append_new_with_many_copies(spark, threshold):
    spark.conf.set(BROADCAST, threshold)
    held = [(i % 50, "a", None) for i in range(300)] + [(7, "a", None)] * 200
    source = [(i, "a", None) for i in range(100)] * 2 + [(777, "b", None)] * 200
    result = append_new(table(spark, *held), table(spark, *source))
    assert result.count() == 500 + 50 + 1


def test_append_new_tells_rows_of_equal_hash_apart(spark):
    target = table(spark, (1, "a", "x"), (2, "a", None))
    source = table(spark, (1, "a", "y"), (2, "a", None), (3, None, None))
    result = _append_new(target, source, F.lit(7).cast("long"))
    assert rows(result) == rows(append_new(target, source))
    assert result.count() == 4


def test_dedupe_keeps_one_of_identical_rows(spark):
    df = table(spark, (1, None, "x"), (1, None, "x"), (1, None, "y"))
    assert rows(dedupe(df)) == [(1, None, "x"), (1, None, "y")]


def test_dedupe_deals_rows_over_parts_before_they_are_merged(spark):
    df = spark.range(0, 20_000, 1, 1).selectExpr("id % 5000 AS k", "if(id % 3 = 0, null, 'x') AS v")
    assert sorted(map(tuple, dedupe(df).collect()), key=str) == sorted(map(tuple, set(df.collect())), key=str)
    # One task reads all rows; none of them merges all.
    plan = dedupe(df)._jdf.queryExecution().executedPlan().toString()
    first = plan[: plan.rindex("HashAggregate")].count("Exchange")
    assert first == 1 and "REPARTITION_BY_NUM" in plan[plan.rindex("HashAggregate") :]
    # Copies of one row are spread over the tasks that read them.
    copies = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        sizes = copies.groupBy(row_part(copies)).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(sizes) > 2 and dedupe(copies).count() == 1
