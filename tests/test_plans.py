"""Plans of the dearer queries: what they must not do at scale."""

from __future__ import annotations

import gzip
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from factlab.plans import review_sql, reviews
from factlab.plans.inspect import plan_text

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored_reviews(spark, tmp_path_factory):
    """The review table as Parquet, so that filters can reach the scan."""
    csv, parquet = spark_entry.review_formats(spark, SF_DIR)
    return parquet


@pytest.mark.parametrize("name", ["q05_rank", "reviews_q05", "reviews_sql_q5"])
def test_rank_sorts_nothing_before_a_shuffle(spark, name):
    text = plan_text(spark_entry.queries()[name](spark, SF_DIR))
    assert "HashAggregate" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["q05_one", "reviews_q05_one"])
def test_single_winner_sorts_survivors_only(spark, name):
    """The struct of all columns is built above the joins that leave the best rows."""
    text = plan_text(spark_entry.queries()[name](spark, SF_DIR))
    tree = text.split("(1) Scan")[0]
    assert tree.index("SortAggregate") < tree.index("Join")
    assert "SortAggregate" not in tree[tree.index("Join") :]


def test_a_table_of_any_size_is_not_broadcast(skewed_session, stored_reviews):
    apps = skewed_session.range(1000).select(
        F.col("id").cast("int").alias("appid"),
        F.col("id").cast("string").alias("app_name"),
        F.lit("g").alias("genre"),
    )
    assert "BroadcastHashJoin" not in plan_text(reviews.named_reviews(stored_reviews, apps))
    fixed = reviews.named_reviews(stored_reviews, apps, fixed_size=True)
    assert "BroadcastHashJoin" in plan_text(fixed)


def test_sql_months_skip_row_groups(spark, stored_reviews):
    def plan(**options):
        return plan_text(review_sql.run(spark, "q9", views={"reviews": stored_reviews}, **options))

    pushed = [line for line in plan().splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual(unix_timestamp_created" in line for line in pushed)
    assert "GreaterThanOrEqual(unix_timestamp_created" not in plan(partitioned=True)


def test_sql_trend_shuffles_twice(spark, stored_reviews):
    text = plan_text(review_sql.run(spark, "q6", views={"reviews": stored_reviews}))
    tree = text.split("(1) Scan")[0]
    assert tree.count("Exchange") == 2


def test_unknown_parameters_are_refused(spark, stored_reviews):
    with pytest.raises(ValueError, match="min_row"):
        review_sql.run(spark, "q2", views={"reviews": stored_reviews}, min_row=1)


def test_views_of_the_session_stay(spark, stored_reviews):
    spark.range(1).createOrReplaceTempView("reviews")
    review_sql.run(spark, "q2", views={"reviews": stored_reviews}).collect()
    assert spark.table("reviews").columns == ["id"]
    spark.catalog.dropTempView("reviews")


def test_kept_rows_have_two_readers_and_are_released(spark):
    seen = []
    original = spark_entry.write_table

    def spy(df, *args, **options):
        seen.append(plan_text(df))
        return original(df, *args, **options)

    spark_entry.write_table = spy
    try:
        result = spark_entry.queries()["q20_cached"](spark, SF_DIR)
    finally:
        spark_entry.write_table = original
    # One in the join, one in the subquery that counts.
    assert len(re.findall(r"- InMemoryTableScan \(\d+\)", seen[0])) == 2
    assert result.count() > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


@pytest.mark.parametrize("name", ["reviews_ingest", "b1_formats", "q11_ingest"])
def test_raw_csv_is_stored_in_a_fraction_of_its_text(spark, name):
    paths = []
    original = spark_entry.write_csv_raw

    def spy(df, path, *args, **options):
        paths.append(path)
        original(df, path, *args, **options)

    spark_entry.write_csv_raw = spy
    try:
        spark_entry.queries()[name](spark, SF_DIR)
    finally:
        spark_entry.write_csv_raw = original
    (stored,) = (Path(path) for path in paths)
    files = list(stored.glob("part-*"))
    text = sum(len(gzip.open(file).read()) for file in files if file.suffix == ".gz")
    assert 2 * sum(file.stat().st_size for file in files) < text
