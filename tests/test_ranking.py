from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from factlab.operators import preview, ranking, top_k, top_ranked
from factlab.plans.inspect import plan_text


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(
        [
            (1, 0.9, 5, "a"),
            (1, 0.9, 5, "b"),
            (1, 0.9, None, "c"),
            (1, 0.8, 9, "d"),
            (2, 0.5, None, "e"),
            (2, 0.5, None, "f"),
            (3, None, 1, "g"),
            (3, None, 2, "h"),
            (None, 0.1, 1, "i"),
            (None, 0.2, 1, "j"),
            (4, float("nan"), 1, "k"),
            (4, 5.0, 9, "l"),
        ],
        "key int, score double, votes int, id string",
    )


def test_all_ties_are_kept_and_null_comes_last(scores):
    winners = top_ranked(scores, ["key"], ["score", "votes"])
    assert [row["id"] for row in winners.orderBy("id").collect()] == list("abefhjk")
    assert {row["rank"] for row in winners.collect()} == {1}


def test_one_order_column(scores):
    winners = top_ranked(scores, ["key"], ["score"])
    assert [row["id"] for row in winners.orderBy("id").collect()] == list("abcefghjk")


def test_single_winner_by_tie_break(scores):
    winners = top_ranked(scores, ["key"], ["score", "votes"], ties="one", tie_break=["id"])
    assert [row["id"] for row in winners.orderBy("id").collect()] == list("bfhjk")


def test_unknown_ties_are_refused(scores):
    with pytest.raises(ValueError):
        top_ranked(scores, ["key"], ["score"], ties="none")


@pytest.mark.parametrize("slots", [1, 4, 65_536])
@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_rank_window(spark, monkeypatch, slots, seed):
    monkeypatch.setattr(ranking, "SLOTS", slots)
    rng = random.Random(seed)
    pick = lambda top: None if rng.random() < 0.1 else rng.randrange(top)
    data = [(pick(40), pick(30), pick(4), pick(3), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k1 int, k2 int, a int, b int, id int").repartition(5)
    window = Window.partitionBy("k1", "k2").orderBy(F.desc("a"), F.desc("b"))
    expected = df.withColumn("rank", F.rank().over(window)).filter("rank = 1")
    assert rows(top_ranked(df, ["k1", "k2"], ["a", "b"])) == rows(expected)
    one = top_ranked(df, ["k1", "k2"], ["a", "b"], ties="one", tie_break=["id"])
    assert set(rows(one)) <= set(rows(expected))
    assert one.count() == df.select("k1", "k2").distinct().count()


def test_hot_ties_are_split_and_best_values_computed_once(skewed_session, hot_table):
    # All rows of a key tie, so rank 1 is the whole table.
    winners = top_ranked(hot_table.withColumn("same", F.col("score") * 0), ["key"], ["same"])
    assert len(winners.collect()) == 100_000
    final = plan_text(winners, "simple")
    assert "SortMergeJoin(skew=true)" in final
    assert "ReusedExchange" in final
    assert "Window" not in final


def test_pruning_table_is_bounded_and_losers_stay_out_of_the_shuffle(spark, hot_table):
    winners = top_ranked(hot_table, ["key"], ["score", "row_id"])
    winners.collect()
    final = plan_text(winners, "simple")
    assert "_bound" in final and "BroadcastHashJoin" in final


def test_single_winner_is_chosen_before_the_shuffle(hot_table):
    text = plan_text(top_ranked(hot_table, ["key"], ["score"], ties="one"), "simple")
    assert "partial_max" in text[text.index("Exchange hashpartitioning"):]
    assert "Window" not in text


def test_single_winner_keeps_column_order_and_needs_no_tie_break(spark):
    df = spark.createDataFrame([(5, "a", 1), (7, "a", 1), (6, "b", None)], "x int, k string, v int")
    one = top_ranked(df, ["k"], ["v"], ties="one")
    assert one.columns == ["x", "k", "v", "rank"]
    assert rows(one) == [(6, "b", None, 1), (7, "a", 1, 1)]


def test_top_k_breaks_ties_and_takes_no_full_sort(spark):
    df = spark.createDataFrame([(i, float(i // 4)) for i in range(20)], "id int, score double")
    best = top_k(df, F.col("score") * 2, "doubled", 6, tie_break=["id"])
    assert [row["id"] for row in best.collect()] == [16, 17, 18, 19, 12, 13]
    assert "TakeOrderedAndProject" in plan_text(best, "simple")
    everything = df.withColumn("doubled", F.col("score") * 2).orderBy(F.desc("doubled"), "id")
    assert best.collect() == everything.collect()[:6]


def test_preview(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, third int")
    first = preview(df, 4, [F.desc("third"), "id"])
    assert [row["id"] for row in first.collect()] == [2, 5, 8, 1]
    assert "TakeOrderedAndProject" in plan_text(first, "simple")
