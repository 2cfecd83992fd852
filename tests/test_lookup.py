import random
from datetime import timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from daybook.functions import Period
from daybook.operators import (
    append_new,
    asof_join,
    balances,
    form101,
    loan_holiday_mart,
    opening_balances,
    turnover,
)
from daybook.operators.lookup import heavy_keys, left_join_skewed
from daybook.schemas import (
    DEAL,
    FT_BALANCE,
    LOAN_HOLIDAY,
    MD_EXCHANGE_RATE,
    MD_LEDGER_ACCOUNT,
    PRODUCT,
)
from daybook.session import scratch_path
from helpers import JAN, A, accounts, day, postings, rows

PERIOD = Period(day(1), day(31))


def facts(spark):
    # A third of the rows share one key, a few have none, some are copies.
    data = [(i, 1 if i % 3 == 0 else i % 40) for i in range(300)]
    data += [(i, None) for i in range(10)] + [(5, 1)] * 20
    return spark.createDataFrame(data, "id long, k long")


def test_building_operators_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "nothing runs yet")
    post, acc = postings(spark, (day(5), 1, 2, 1, 1)), accounts(spark, (1, A, *JAN))
    rate = spark.createDataFrame([], MD_EXCHANGE_RATE.schema)
    moves = turnover(post, acc, rate, PERIOD)
    seeds = opening_balances(spark.createDataFrame([], FT_BALANCE.schema), acc, rate, PERIOD)
    marts = balances(acc, moves, seeds, PERIOD)
    form101(acc, spark.createDataFrame([], MD_LEDGER_ACCOUNT.schema), moves, marts, PERIOD)
    append_new(facts(spark), facts(spark))
    deal, holiday, product = (spark.createDataFrame([], t.schema) for t in (DEAL, LOAN_HOLIDAY, PRODUCT))
    loan_holiday_mart(deal, holiday, product)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("tests", "")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
@pytest.mark.parametrize("least", [3, 1000])
def test_skewed_left_join_gives_the_plain_left_join(spark, threshold, least):
    left = facts(spark).unionByName(spark.createDataFrame([(7, 999)], "id long, k long"))
    right = spark.createDataFrame(
        [(1 if i % 3 else i, i) for i in range(60)] + [(None, 7)] + [(2, 5)] * 30, "k long, v long"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joined = left_join_skewed(left, right, ["k"], least=least)
    assert rows(joined) == rows(left.join(right, "k", "left"))
    heavy = {r.k: r.parts for r in heavy_keys(right, ["k"], least=least).collect()}
    assert heavy == ({1: 14, 2: 10} if least == 3 else {})
    none = right.limit(0)
    assert rows(left_join_skewed(left, none, ["k"])) == rows(left.join(none, "k", "left"))


def test_scratch_folder_is_the_clusters_shared_one():
    def session(master, folder):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder),
            sparkContext=SimpleNamespace(master=master),
        )

    assert scratch_path(session("yarn", "s3a://shared/"), "x").startswith("s3a://shared/x-")
    assert scratch_path(session("local[2]", None), "x") != scratch_path(session("local[2]", None), "x")
    with pytest.raises(ValueError):
        scratch_path(session("yarn", None), "x")


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_overfull_key_of_a_left_join_is_split_on_either_side(spark, hot_side):
    def keyed(rows, hot, name):
        ids = spark.range(0, rows, 1, 8)
        key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")) if hot else F.col("id")
        return ids.select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias(name))

    left = keyed(60_000, hot_side == "left", "a")
    right = keyed(60_000, hot_side == "right", "b")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = left_join_skewed(left, right, ["k"], least=1000)
        assert len(joined.collect()) == (60_000 if hot_side == "left" else 80_000)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # Of the left side Spark splits the key, of the right one it is dealt over parts.
        assert ("SortMergeJoin(skew=true)" in plan) == (hot_side == "left")
        found = heavy_keys(right, ["k"], least=1000).collect()
        assert [(r.k, r.parts) for r in found] == ([(1, 21)] if hot_side == "right" else [])
        final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
        assert final.count("SortMergeJoin") == 1
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("least", [5, 10_000])
def test_asof_join_gives_the_join_on_the_interval(spark, least):
    rng = random.Random(least)
    versions = []
    for k in range(6):
        at = rng.randrange(20)
        while at < 300:
            end = at + rng.randrange(1, 40)
            versions.append((k, day(1) + timedelta(days=at), day(1) + timedelta(days=end), at))
            at = end + rng.choice([1, 1, 15])
    versions += [(7, day(5), day(2), 1), (7, day(5), None, 2), (None, day(1), day(31), 3)]
    made = [(n, 1 if n % 3 == 0 else rng.choice([None, *range(9)]), rng.choice([None, day(1) + timedelta(days=rng.randrange(330))])) for n in range(400)]
    held = spark.createDataFrame(versions, "k long, a date, b date, rate int")
    left = spark.createDataFrame(made + made[:9], "n long, k long, on_date date")
    found = asof_join(left, held, ["k"], "on_date", ("a", "b"), ["rate"], least=least)
    plain = left.alias("l").join(held.alias("v"), (F.col("l.k") == F.col("v.k")) & F.col("on_date").between(F.col("a"), F.col("b")), "left")
    assert rows(found) == rows(plain.select("l.*", "rate"))
    assert rows(asof_join(left, held.limit(0), ["k"], "on_date", ("a", "b"), ["rate"])) == rows(left.withColumn("rate", F.lit(None)))
    assert asof_join(left.limit(0), held, ["k"], "on_date", ("a", "b"), ["rate"]).count() == 0
