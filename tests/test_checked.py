"""Rejected lines, and the filter that keeps a large table from moving."""

import random

import pytest
from pyspark.sql import functions as F

from daybook.operators.bloom import bloom_filter, maybe_in
from daybook.operators.maintain import _append_new, append_new
from daybook.schemas import FT_BALANCE, PRODUCT
from daybook.session import scratch_path
from daybook.sources import read_checked
from helpers import day, num, rows


def text_file(spark, lines, encoding="utf-8"):
    path = scratch_path(spark, "text")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.option("encoding", encoding).text(path)
    return path


def test_good_lines_load_and_others_are_named(spark):
    head = "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT"
    good = ["05.01.2018;1;34;1.5", "06.01.2018;2;;", '"07.01.2018";3;34;-2']
    bad = {
        "31.02.2018;1;34;1": ["on_date: not a date as dd.MM.yyyy"],
        ";1;34;1": ["on_date: missing"],
        "05.01.2018;1x;34;1": ["account_rk: not a number of 10 digits"],
        "05.01.2018;12345678901;34;1,5": ["account_rk: not a number of 10 digits", "balance_out: not a number"],
        "05.01.2018;1;34": ["not as many fields as columns"],
        "05.01.2018;1;34;1;9": ["not as many fields as columns"],
        "word": ["not as many fields as columns"],
    }
    paths = text_file(spark, [head, *good, "", *bad]), text_file(spark, [head.lower(), good[0]])
    loaded = read_checked(spark, paths[0], FT_BALANCE, patterns={"on_date": "dd.MM.yyyy"})
    assert loaded.rows.dtypes == spark.createDataFrame([], FT_BALANCE.schema).dtypes
    assert rows(loaded.rows) == sorted([(day(5), 1, 34, num(1.5)), (day(6), 2, None, None), (day(7), 3, 34, num(-2))])
    assert {r.line: r.rules for r in loaded.rejects.collect()} == bad
    assert all(r.file.startswith("part-") for r in loaded.rejects.collect())
    assert read_checked(spark, paths[1], FT_BALANCE, patterns={"on_date": "dd.MM.yyyy"}).rows.count() == 1
    nothing = read_checked(spark, text_file(spark, [head]), FT_BALANCE)
    assert nothing.rows.count() == nothing.rejects.count() == 0


def test_lines_in_a_code_page(spark):
    lines = [",".join(PRODUCT.columns), "1,Кредит №1,2018-01-01,2050-12-31"]
    path = scratch_path(spark, "text")
    raw = spark.createDataFrame([(x.encode("windows-1251").decode("latin-1"),) for x in lines], "value string")
    raw.coalesce(1).write.option("encoding", "iso-8859-1").text(path)
    loaded = read_checked(spark, path, PRODUCT, sep=",", encoding="windows-1251")
    assert [r.product_name for r in loaded.rows.collect()] == ["Кредит №1"]


@pytest.mark.parametrize("words", [1, 64, 1 << 12])
def test_a_filter_loses_nothing_it_was_given(spark, words):
    rng = random.Random(words)
    given = [rng.getrandbits(64) - (1 << 63) for _ in range(200)]
    other = [rng.getrandbits(64) - (1 << 63) for _ in range(5000)]
    bloom = bloom_filter(spark.createDataFrame([(x,) for x in given], "h long"), "h", words)
    assert bloom.count() <= words
    passed = {r.h for r in maybe_in(spark.createDataFrame([(x,) for x in given + other], "h long"), "h", bloom, words).collect()}
    assert passed >= set(given)
    assert len(passed - set(given)) < (5001 if words == 1 else 4500 if words == 64 else 60)


@pytest.mark.parametrize("words", [1, 1 << 10])
def test_append_with_false_positives_and_equal_hashes(spark, words):
    rng = random.Random(3)
    made = lambda n: [(rng.randrange(60), rng.choice(["a", None, "b"])) for _ in range(n)]
    target, source = (spark.createDataFrame(made(n), "k long, v string") for n in (300, 80))
    new = sorted(set(map(tuple, source.collect())) - set(map(tuple, target.collect())), key=repr)
    expected = sorted([*map(tuple, target.collect()), *new], key=repr)
    for row_hash in (F.xxhash64("k", "v"), F.col("k") % 3):
        found = _append_new(target, source, row_hash, words)
        assert sorted(map(tuple, found.collect()), key=repr) == expected
    assert sorted(map(tuple, append_new(target, source).collect()), key=repr) == expected


def test_what_moves_follows_the_delivery(spark):
    target = spark.range(200_000).select(F.xxhash64("id").alias("_hash"))
    bloom = bloom_filter(spark.range(100).select(F.xxhash64("id").alias("_hash")), "_hash")
    assert 100 <= maybe_in(target, "_hash", bloom).count() < 150
