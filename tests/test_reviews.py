"""The ten reports on a small review table, as DataFrames and as SQL."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from factlab import schemas
from factlab.operators import shared
from factlab.plans import review_sql, reviews
from factlab.plans.inspect import plan_text
from factlab.sources import register, write_csv_raw, write_table

DAY = 86_400
NEW_YEAR_2019 = 1_546_300_800
PROFILED = 76561198107294407


def _review(steamid, appid, voted, votes, score, minutes, text, seconds):
    return (steamid, appid, voted, votes, 0, score, minutes, minutes, 1, 1, text, seconds, seconds)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(5)
    maybe = lambda value: None if rng.random() < 0.08 else value
    data = [
        _review(
            rng.choice([PROFILED, 76561198000000004, 1, 2, 3]),
            maybe(rng.choice([10, 10, 10, 570, 730, 42])),
            maybe(rng.random() < 0.7),
            maybe(rng.randrange(6)),
            maybe(rng.choice([0.0, 0.25, 0.5, 0.75, 1.0])),
            maybe(rng.randrange(1000, 6000)),
            maybe("word " * (1 + rng.randrange(40))),
            maybe(NEW_YEAR_2019 - 20 * DAY + rng.randrange(60 * DAY)),
        )
        for _ in range(1200)
    ]
    data.append(_review(1, 42, True, 1, 0.1, 5, "far off", 1 << 60))
    path = str(tmp_path_factory.mktemp("reviews") / "table")
    write_table(spark.createDataFrame(data, schemas.REVIEWS), path)
    return path


@pytest.fixture(scope="module")
def table(spark, stored):
    loaded = reviews.load(spark, stored)
    register(loaded, "reviews")
    register(reviews.app_metadata(spark), "app_metadata")
    register(reviews.user_profiles(spark), "user_profiles")
    return loaded


REPORTS = {
    "q1": lambda spark, t: reviews.elite_reviews(t),
    "q2": lambda spark, t: reviews.game_stats(t),
    "q3": lambda spark, t: reviews.verdict_stats(t, ddof=0),
    "q4": lambda spark, t: reviews.top_games(t),
    "q5": lambda spark, t: reviews.top_reviews(t),
    "q6": lambda spark, t: reviews.review_trend(t, frame="rows"),
    "q7": lambda spark, t: reviews.elite_in_good_games(t),
    "q8": lambda spark, t: reviews.named_reviews(t, reviews.app_metadata(spark)),
    "q9": lambda spark, t: reviews.monthly_summary(t),
    "q10": lambda spark, t: reviews.profiled_reviews(t, reviews.user_profiles(spark)),
}


@pytest.mark.parametrize("name", REPORTS)
def test_sql_and_dataframe_agree(spark, table, name):
    ours, sql = REPORTS[name](spark, table), review_sql.run(spark, name)
    assert ours.columns == sql.columns
    assert rows(ours) == rows(sql)
    assert ours.count() > 0


def test_sql_takes_thresholds(spark, table):
    assert review_sql.run(spark, "q2", min_rows=300).count() < review_sql.run(spark, "q2").count()
    years = {row["review_year"] for row in review_sql.run(spark, "q9", years=[2018]).collect()}
    assert years == {2018}


def test_options_change_results(table):
    differ = [
        (reviews.game_stats(table), reviews.game_stats(table, nulls="zero")),
        (reviews.verdict_stats(table), reviews.verdict_stats(table, ddof=0)),
        (reviews.top_reviews(table), reviews.top_reviews(table, ties="one")),
        (reviews.review_trend(table), reviews.review_trend(table, frame="rows")),
        (reviews.monthly_summary(table), reviews.monthly_summary(table, nulls="zero")),
    ]
    for one, other in differ:
        assert one.columns == other.columns
        assert rows(one) != rows(other)


def test_single_winner_is_one_of_the_tied(table):
    one = reviews.top_reviews(table, ties="one")
    assert set(rows(one)) <= set(rows(reviews.top_reviews(table)))
    assert one.count() == one.select("appid").distinct().count() == 5


def test_trend_by_number(table):
    found = reviews.review_trend_by_number(table)
    assert found.columns == ["appid", "day_epoch", "avg_7d"]
    assert found.count() == reviews.review_trend(table).count()


def test_report_reads_kept_elite_rows(table):
    plain = reviews.elite_in_good_games(table)
    with shared(reviews.elite_reviews(table)) as elite:
        reused = reviews.elite_in_good_games(table, elite)
        assert "InMemoryTableScan" in plan_text(reused)
        assert rows(reused) == rows(plain)


def test_plans(spark, table):
    elite = plan_text(reviews.elite_reviews(table))
    assert "GreaterThanOrEqual(playtime_forever,3000)" in elite
    assert "EqualTo(voted_up,true)" in elite
    assert "TakeOrderedAndProject" in plan_text(reviews.top_games(table))
    assert "BroadcastHashJoin" in plan_text(REPORTS["q8"](spark, table))
    assert "SortMergeJoin" in plan_text(REPORTS["q10"](spark, table))
    summary = plan_text(reviews.monthly_summary(table))
    assert "GreaterThanOrEqual(unix_timestamp_created,1546300800)" in summary


def test_ingested_table_prunes_directories(spark, table, tmp_path):
    raw, typed = str(tmp_path / "raw"), str(tmp_path / "typed")
    write_csv_raw(table.drop("review_year", "review_month"), raw)
    reviews.ingest(spark, raw, typed, partition_by=["review_year", "review_month"])
    loaded = reviews.load(spark, typed)
    assert sorted(loaded.columns) == sorted(table.columns)
    assert rows(loaded.select(table.columns)) == rows(table)
    summary = reviews.monthly_summary(loaded, partitioned=True)
    text = plan_text(summary)
    assert "PartitionFilters: [isnotnull(review_year" in text
    assert "ReadSchema: struct<weighted_vote_score:float>" in text
    assert rows(summary) == rows(reviews.monthly_summary(table))


def test_partition_count_of_the_profile_join(spark, table):
    joined = reviews.profiled_reviews(table, reviews.user_profiles(spark), partitions=6)
    assert rows(joined) == rows(REPORTS["q10"](spark, table))
