"""The ten reports on a table of reviews, built from the general operators.

The defaults give the results of the DataFrame form of each report. Options give
those of its SQL form (``ddof=0``, ``frame="rows"``) and of its row-at-a-time
form (``nulls="zero"``, ``ddof=0``, ``ties="one"``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlab import schemas
from factlab.functions import (
    add_period,
    at_least,
    day_number,
    is_true,
    long_text,
    not_null,
    within_years,
)
from factlab.operators import (
    Stat,
    above_global_mean,
    daily_counts,
    filter_all,
    grouped_stats,
    join_to_groups,
    lookup_join,
    merge_join,
    moving_average,
    period_summary,
    top_k,
    top_ranked,
)
from factlab.sources import dim_table, ingest_csv, read_table

# Thresholds and output columns of the reports.
ELITE_MINUTES = 3_000
ELITE_SCORE = 0.7
ELITE_CHARACTERS = 100
ELITE_COLUMNS = (
    "steamid",
    "appid",
    "voted_up",
    "votes_up",
    "weighted_vote_score",
    "playtime_forever",
    "review",
    "unix_timestamp_created",
    "review_year",
)
STATS_MIN_REVIEWS = 50
MEAN_MIN_REVIEWS = 20
TOP_GAMES = 10
SUMMARY_YEARS = (2019,)
VETERAN_DAYS = 365

_HELPFULNESS = Stat("avg_helpfulness", "mean", "weighted_vote_score", 4)
_PLAYTIME = Stat("avg_playtime_mins", "mean", "playtime_forever", 2)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The review table with review_year and review_month.

    A table written by ``ingest`` with ``partition_by`` has both as partition
    columns; otherwise they are derived from the creation time.
    """
    table = read_table(spark, path, schemas.REVIEWS)
    return table if "review_year" in table.columns else with_period(table)


def with_period(table: DataFrame) -> DataFrame:
    return add_period(table, "unix_timestamp_created", "review_year", "review_month")


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str] = (),
    tasks: str = "files",
) -> None:
    """Raw review CSV to the typed table that ``load`` reads."""
    ingest_csv(
        spark,
        source,
        target,
        schemas.column_types(schemas.REVIEWS),
        epoch="unix_timestamp_created",
        partition_by=partition_by,
        tasks=tasks,
    )


def app_metadata(spark: SparkSession) -> DataFrame:
    return dim_table(spark, schemas.APP_METADATA_ROWS, schemas.APP_METADATA)


def user_profiles(spark: SparkSession) -> DataFrame:
    return dim_table(spark, schemas.USER_PROFILES_ROWS, schemas.USER_PROFILES)


def elite_reviews(reviews: DataFrame) -> DataFrame:
    """Q1: positive, helpful, long reviews by players with many hours."""
    tests = [
        at_least("playtime_forever", ELITE_MINUTES),
        at_least("weighted_vote_score", ELITE_SCORE),
        is_true("voted_up"),
        long_text("review", ELITE_CHARACTERS),
    ]
    return filter_all(reviews, tests, ELITE_COLUMNS)


def game_stats(reviews: DataFrame, nulls: str = "skip") -> DataFrame:
    """Q2: helpfulness, playtime and votes of games with enough reviews."""
    stats = [_HELPFULNESS, _PLAYTIME, Stat("total_votes_up", "sum", "votes_up")]
    groups = grouped_stats(
        reviews, ["appid"], stats, "total_reviews", STATS_MIN_REVIEWS, nulls=nulls
    )
    return groups.select(
        "appid", "avg_helpfulness", "total_reviews", "avg_playtime_mins", "total_votes_up"
    )


def verdict_stats(reviews: DataFrame, nulls: str = "skip", ddof: int = 1) -> DataFrame:
    """Q3: the same by game and verdict, with the spread of the score, largest groups first."""
    stats = [_HELPFULNESS, _PLAYTIME, Stat("score_std_dev", "std", "weighted_vote_score", 4)]
    judged = reviews.filter(not_null("voted_up", "appid"))
    groups = grouped_stats(
        judged, ["appid", "voted_up"], stats, "review_count", nulls=nulls, ddof=ddof
    )
    return groups.orderBy(F.desc("review_count"))


def top_games(reviews: DataFrame, nulls: str = "skip") -> DataFrame:
    """Q4: the games of highest engagement, from the rounded columns of Q2."""
    engagement = F.round(
        F.col("total_reviews") * F.col("avg_helpfulness") * F.log1p("avg_playtime_mins"), 2
    )
    return top_k(
        game_stats(reviews, nulls), engagement, "engagement_score", TOP_GAMES, tie_break=["appid"]
    )


def top_reviews(reviews: DataFrame, ties: str = "all") -> DataFrame:
    """Q5: the most influential review of each game, with all that tie or a single one."""
    columns = [
        "appid", "steamid", "voted_up", "weighted_vote_score", "votes_up", "playtime_forever"
    ]
    scored = reviews.filter(not_null("weighted_vote_score"))
    order = ["weighted_vote_score", "votes_up"]
    if ties == "one":
        # In this reading an unknown vote count is 0, also where it ties with a known 0.
        scored = scored.withColumn("_votes", F.coalesce("votes_up", F.lit(0)))
        order = ["weighted_vote_score", "_votes"]
    winners = top_ranked(
        scored.select(*columns, *(name for name in order if name not in columns)),
        ["appid"],
        order,
        "influence_rank",
        ties,
        tie_break=["steamid", "playtime_forever", "voted_up"],
    )
    return winners.select(*columns, "influence_rank")


def review_trend(reviews: DataFrame, frame: str = "range") -> DataFrame:
    """Q6: reviews per game and day with their 7-day moving average."""
    daily = daily_counts(
        reviews, "appid", "unix_timestamp_created", "review_date", "daily_review_count"
    )
    return moving_average(
        daily,
        "appid",
        "review_date",
        "daily_review_count",
        "avg_7d_reviews",
        frame=frame,
        ordered=True,
    )


def review_trend_by_number(reviews: DataFrame) -> DataFrame:
    """Q6 with days as numbers since 1970 and no daily count."""
    trend = review_trend(reviews)
    day = day_number(trend, "review_date").alias("day_epoch")
    return trend.select("appid", day, F.col("avg_7d_reviews").alias("avg_7d"))


def elite_in_good_games(reviews: DataFrame, elite: DataFrame | None = None) -> DataFrame:
    """Q7: elite reviews of games whose mean score exceeds that of all reviews.

    ``elite`` takes a kept result of Q1 to read instead of the table.
    """
    games = above_global_mean(
        reviews,
        "appid",
        "weighted_vote_score",
        "game_avg_score",
        "game_review_count",
        MEAN_MIN_REVIEWS,
    )
    columns = ["steamid", "appid", "weighted_vote_score", "game_avg_score", "playtime_forever"]
    return join_to_groups(elite_reviews(reviews) if elite is None else elite, games, "appid", columns)


def named_reviews(reviews: DataFrame, apps: DataFrame, fixed_size: bool = False) -> DataFrame:
    """Q8: reviews with the name and genre of their game; see ``lookup_join``."""
    columns = [
        "appid", "app_name", "genre", "voted_up", "weighted_vote_score", "playtime_forever"
    ]
    return lookup_join(reviews, apps, "appid", columns, fixed_size)


def monthly_summary(
    reviews: DataFrame,
    years: Sequence[int] = SUMMARY_YEARS,
    nulls: str = "skip",
    partitioned: bool = False,
) -> DataFrame:
    """Q9: reviews and mean score per month of the given years.

    On a table ``partitioned`` by review_year the year test opens the
    directories of these years only. On others the range of the creation time
    that it implies is tested as well, to skip row groups.
    """
    if not partitioned:
        reviews = within_years(reviews, "unix_timestamp_created", years)
    return period_summary(
        reviews,
        ["review_year", "review_month"],
        [Stat("avg_score", "mean", "weighted_vote_score", 4)],
        years,
        "monthly_reviews",
        nulls,
    )


def profiled_reviews(
    reviews: DataFrame, profiles: DataFrame, partitions: int | None = None
) -> DataFrame:
    """Q10: reviews with the account of their author."""
    columns = [
        "steamid",
        "username",
        "account_age_days",
        "total_reviews",
        "appid",
        "voted_up",
        "weighted_vote_score",
        "playtime_forever",
    ]
    joined = merge_join(reviews, profiles, "steamid", columns, partitions)
    return joined.withColumn("is_veteran", at_least("account_age_days", VETERAN_DAYS))
