"""Duplicates and hot keys, against brute force on small tables with a key that holds most rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tandem.operators.dedup import REPEAT, keep_first, mark_merged, mark_repeats, merge_sources, split_duplicates
from tandem.operators.joins import attach, hot_keys
from tandem.plans.fuse import offset_claim_numbers, union_sources


def hot_table(n: int = 3000, seed: int = 1) -> list[tuple]:
    """A third of the rows share one key, half of those are copies of one row; some keys are null."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        draw = rng.random()
        if draw < 0.17:
            out.append(("HOT", 1, "same"))
        elif draw < 0.34:
            out.append((rng.choice(["HOT", "hot", "Hot"]), rng.randint(0, 9), rng.choice("abcdef")))
        elif draw < 0.4:
            out.append((None, rng.randint(0, 3), rng.choice("ab")))
        else:
            out.append((f"k{rng.randint(0, 600)}", rng.randint(0, 3), rng.choice("ab")))
    return out


def first_by_hand(data, fold, order):
    best = {}
    for row in data:
        key = row[0].lower() if fold and row[0] is not None else row[0]
        if key not in best or order(row) < order(best[key]):
            best[key] = row
    return list(best.values())


def null_first(row):
    return (row[1], row[0] is not None, row[0] or "", row[2])


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("fold", [False, True])
def test_first_row_and_repeats_are_those_found_by_hand(spark, fold, partitions):
    data = hot_table()
    df = spark.createDataFrame(data, "k string, n int, v string").repartition(partitions)
    expected = Counter(first_by_hand(data, fold, null_first))
    kept, repeats = split_duplicates(df, ["k"], ["n"], ignore_case=fold)
    assert Counter(map(tuple, kept.collect())) == expected
    assert Counter(map(tuple, repeats.collect())) == Counter(data) - expected


def test_marks_agree_with_the_split_in_one_pass(spark):
    data = hot_table(seed=2)
    df = spark.createDataFrame(data, "k string, n int, v string").repartition(5)
    marked = mark_repeats(df, ["k"], ["n"])
    kept = Counter(tuple(r)[:3] for r in marked.filter(~F.col(REPEAT)).collect())
    assert kept == Counter(first_by_hand(data, True, null_first))
    assert marked.count() == len(data)


def test_order_of_input_does_not_matter(spark):
    data = hot_table(seed=3)
    shuffled = random.Random(9).sample(data, len(data))
    a = keep_first(spark.createDataFrame(data, "k string, n int, v string").repartition(3), ["k"])
    b = keep_first(spark.createDataFrame(shuffled, "k string, n int, v string").repartition(8), ["k"])
    assert rows(a) == rows(b)


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.createDataFrame(hot_table(), "k string, n int, v string")
    plan = keep_first(df, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_a_hot_key_is_dealt_over_tasks(spark):
    """One shuffle of the rows, and no task gets more than a small part of a key that holds most of them."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 < 7, "HOT").otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") % 1500).alias("n")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = mark_repeats(df.repartition(8), ["k"], ["n"])
        plan = marked._jdf.queryExecution().executedPlan().toString()
        sizes = marked.filter("k = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
        kept = marked.filter(~F.col(REPEAT))
        assert kept.filter("k = 'HOT'").collect()[0]["n"] == 0 and kept.count() == 1201
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 0.5 * 2800
    # One exchange carries all rows, by key and salt; the others are of hashes, sketches and rows of hot keys.
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*_salt#", plan)) == 1


def test_rows_without_a_key_are_not_shuffled(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [("a@b", 1), ("A@B", 2)], "email string, n int")
    marked = mark_repeats(df, ["email"], ["n"], nulls_differ=True)
    assert marked.filter(F.col(REPEAT)).select("n").collect()[0]["n"] == 2
    assert marked.filter("email is null and not doublon").count() == 50


def test_a_source_that_no_list_names_comes_last(table):
    df = table("source string, email string, client_id string", ("C", "x@y", "1"), ("B", "X@y", "2"), ("D", "x@y", "0"))
    kept, dropped = merge_sources(df, "email", ["A", "B"], ["client_id"])
    assert rows(kept) == [("B", "X@y", "2")] and dropped.count() == 2


def test_composite_key_with_equal_nulls(table):
    df = table("sinistre_id int, contrat_id string", (1, "a"), (1, "b"), (1, None), (1, None), (1, "a"))
    assert rows(keep_first(df, ["sinistre_id", "contrat_id"])) == [(1, None), (1, "a"), (1, "b")]


def test_first_source_wins_and_rows_without_address_all_stay(table):
    df = table(
        "source string, client_id string, email string",
        ("B", "AP-1", "x@y.fr"), ("A", "AB-9", "X@Y.FR"), ("A", "AB-10", "x@y.fr"), ("B", "AP-2", None),
        ("B", "AP-3", None), ("A", "AB-3", None), ("B", "AP-4", "z@y.fr"),
    )
    kept, dropped = merge_sources(df, "email", ["A", "B"], ["client_id"])
    assert {r["client_id"] for r in kept.collect()} == {"AB-10", "AP-2", "AP-3", "AB-3", "AP-4"}
    assert {r["client_id"] for r in dropped.collect()} == {"AP-1", "AB-9"}
    assert mark_merged(df, "email", ["B", "A"]).filter("doublon and source = 'B'").count() == 0


def test_union_is_by_name(table):
    a, b = table("x int, y string", (1, "a")), table("y string, x int", ("b", 2))
    assert rows(union_sources(a, b)) == [(1, "a", "A"), (2, "b", "B")]


def test_second_source_continues_the_claim_numbers(table):
    df = table("sinistre_id long, source string", (1, "A"), (61, "A"), (1, "B"), (37, "B"))
    assert rows(offset_claim_numbers(df)) == [(1, "A"), (61, "A"), (62, "B"), (98, "B")]
    assert rows(offset_claim_numbers(df.filter("source = 'B'"))) == [(1, "B"), (37, "B")]


# --- Joins with hot keys --------------------------------------------------------------------------------
def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("k"), "id")).alias("k"))
    assert rows(hot_keys(df, "k", 0.01, 1)) == [("HOT",)]
    assert rows(hot_keys(df, "k", 0.01, 1_000_000)) == []
    many = spark.range(40_000).select((F.col("id") % 20).cast("string").alias("k"))
    assert hot_keys(many, "k", 0.001, 1).count() == 20
    assert hot_keys(spark.range(1000).select(F.col("id").cast("string").alias("k")), "k", 0.001, 1).count() <= 1000


@pytest.mark.parametrize("at_least", [1, 10**9])
def test_spread_join_equals_plain_left_joins(spark, at_least):
    rng = random.Random(4)
    left = [(i, rng.choice(["HOT"] * 6 + [None, None] + [f"k{j}" for j in range(10)])) for i in range(600)]
    right1 = [("HOT", "a"), ("HOT", "b"), (None, "n"), ("k1", "c"), ("zzz", "d")]
    right2 = [("HOT", 7), ("k2", 8), ("k2", 9)]
    df = spark.createDataFrame(left, "id int, k string")
    r1, r2 = spark.createDataFrame(right1, "k string, x string"), spark.createDataFrame(right2, "k string, y int")
    got = attach(df, [r1, r2], "k", ["id"], share=0.05, at_least=at_least, spread=8)
    assert rows(got.select("k", "id", "x", "y")) == rows(
        df.join(r1, "k", "left").join(r2, "k", "left").select("k", "id", "x", "y")
    )


def test_hot_rows_and_rows_without_key_are_spread(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, "HOT").alias("k"))
    right = spark.createDataFrame([("HOT", 1)], "k string, x int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach(df, [right], "k", ["id"], share=0.1, at_least=1, spread=64)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p"), "k").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 2000
    assert joined.filter("k = 'HOT' and x = 1").count() == 1000


def test_both_joins_share_one_shuffle_of_the_left_side(spark):
    df = spark.range(2000).select("id", F.concat(F.lit("k"), F.col("id")).alias("k"))
    rights = [spark.createDataFrame([("k1", i)], f"k string, x{i} int") for i in (1, 2)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = attach(df, rights, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange for the left side and one for each right side
    assert plan.count("Exchange hashpartitioning(k#") == 3
