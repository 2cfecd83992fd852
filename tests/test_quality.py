from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import (
    duplicate_key_rows,
    duplicate_profile,
    nonnull_profile,
    run_log,
    step_audit,
    violations,
)
from daybook.operators import quality
from daybook.operators.bloom import bloom_filter, maybe_in
from daybook.schemas import MD_ACCOUNT, Table
from helpers import A, accounts, day, num, rows

TEXT = Table("t", T.StructType(), key=("k",), required=("k", "a"), max_length={"a": 2})


def found(df, table):
    return {(r.rule, r["columns"]): r.violations for r in violations(df, table).collect()}


def test_contract_counts_each_rule(spark):
    df = spark.createDataFrame(
        [(1, "ab"), (1, "abc"), (2, None), (None, "a"), (3, "ok")], "k long, a string"
    )
    assert found(df, TEXT) == {
        ("not null", "k"): 1,
        ("not null", "a"): 1,
        ("max length", "a"): 1,
        ("unique key", "k"): 1,
    }


def test_contract_of_an_empty_table_is_kept(spark):
    df = spark.createDataFrame([], "k long, a string")
    assert set(found(df, TEXT).values()) == {0}


def test_overlapping_versions_are_reported(spark):
    df = accounts(
        spark,
        (1, A, day(1), day(20)),
        (1, A, day(5), day(6)),
        # Begins after the second, but inside the first.
        (1, A, day(10), day(12)),
        (1, A, day(21), day(22)),
        (2, A, day(1), day(5)),
        (2, A, day(6), day(9)),
        # Reversed, so it covers no day.
        (3, A, day(9), day(2)),
        (3, A, day(3), day(4)),
        (4, A, day(1), day(5)),
        (4, A, day(1), day(5)),
    )
    result = found(df, MD_ACCOUNT)
    assert result["no overlap", "data_actual_date, data_actual_end_date"] == 2
    assert result["unique key", "data_actual_date, account_rk"] == 1


def test_duplicate_profile(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k long, a string")
    assert rows(duplicate_profile(df)) == [("всего записей", 3), ("уникальных записей", 2)]
    assert {r[1] for r in duplicate_profile(df.limit(0)).collect()} == {0}


def test_duplicate_profile_compares_rows_of_equal_hash(spark, monkeypatch):
    data = [(i % 70, None if i % 3 else "a") for i in range(200)]
    df = spark.createDataFrame(data, "k long, a string")
    for words in (1, 1 << 10):
        # Equal hashes of other rows, and a filter that lets much pass.
        monkeypatch.setattr(quality, "bloom_filter", lambda x, c, w=words: bloom_filter(x, c, w))
        monkeypatch.setattr(quality, "maybe_in", lambda x, c, b, w=words: maybe_in(x, c, b, w))
        monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.col("k") % 40)
        assert rows(duplicate_profile(df)) == [("всего записей", 200), ("уникальных записей", len(set(data)))]
        monkeypatch.undo()


def test_rows_of_repeated_keys(spark):
    data = [(7, "d", i) for i in range(60)] + [(i, "d", i) for i in range(20, 60)]
    data += [(i, "d", -i) for i in range(20, 30)]
    data += [(None, "d", 1), (None, "d", 2), (5, None, 1), (5, None, 1)]
    df = spark.createDataFrame(data, "k long, d string, v long")
    result = duplicate_key_rows(df.select("v", "k", "d"), ["k", "d"])
    assert result.columns == ["k", "d", "v"]
    counts = {}
    for k, d, _ in data:
        counts[k, d] = counts.get((k, d), 0) + 1
    expected = [r for r in data if counts[r[0], r[1]] > 1 and None not in r[:2]]
    assert rows(result) == sorted(expected, key=repr)


def test_nonnull_profile_keeps_null_groups(spark):
    df = spark.createDataFrame(
        [(day(1), None, 1, "x"), (day(1), None, None, "y"), (None, None, 2, None)],
        "f date, t date, a long, b string",
    )
    result = nonnull_profile(df, ["f", "t"])
    assert result.columns == ["f", "t", "f_c", "t_c", "a", "b"]
    assert rows(result) == sorted(
        [(day(1), None, 2, 0, 1, 2), (None, None, 0, 0, 1, 0)], key=repr
    )


def test_audit_and_log(spark):
    df = spark.createDataFrame([(day(1), num(2)), (day(1), num(3))], "on_date date, x decimal(23,8)")
    audit = step_audit("turnover", df, amount="x")
    assert rows(audit) == [("turnover", day(1), 2, num(5))]
    entry = run_log(audit).first()
    assert (entry.log_type, entry.log_message) == ("info", "turnover 2018-01-01: 2 rows")
    assert dict(run_log(audit).dtypes)["date_time"] == "timestamp_ntz"
