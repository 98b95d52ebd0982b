"""The ten reports on a stored review table, each computed whole and timed.

python -m factlab.jobs.reports PATH [--report q1 q5 ...] [--sql] [--explain] [--target FOLDER]

Without ``--report`` all ten run, in order. ``--sql`` takes their SQL texts in place of the
DataFrame plans, ``--explain`` prints each plan before it runs. ``--target`` writes each result
as Parquet to a folder of its name below FOLDER; by default all rows are computed and dropped.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factlab import benchmarks
from factlab.plans import review_sql, reviews
from factlab.plans.inspect import plan_text
from factlab.session import make_session
from factlab.sources import write_table

Report = Callable[[SparkSession, DataFrame], DataFrame]

REPORTS: dict[str, Report] = {
    "q1": lambda spark, table: reviews.elite_reviews(table),
    "q2": lambda spark, table: reviews.game_stats(table),
    "q3": lambda spark, table: reviews.verdict_stats(table),
    "q4": lambda spark, table: reviews.top_games(table),
    "q5": lambda spark, table: reviews.top_reviews(table),
    "q6": lambda spark, table: reviews.review_trend(table),
    "q7": lambda spark, table: reviews.elite_in_good_games(table),
    "q8": lambda spark, table: reviews.named_reviews(
        table, reviews.app_metadata(spark), fixed_size=True
    ),
    "q9": lambda spark, table: reviews.monthly_summary(table),
    "q10": lambda spark, table: reviews.profiled_reviews(table, reviews.user_profiles(spark)),
}


def sql_report(name: str) -> Report:
    def report(spark: SparkSession, table: DataFrame) -> DataFrame:
        views = {
            "reviews": table,
            "app_metadata": reviews.app_metadata(spark),
            "user_profiles": reviews.user_profiles(spark),
        }
        used = {view: df for view, df in views.items() if view in review_sql.TEXTS[name]}
        return review_sql.run(spark, name, views=used)

    return report


def main(args: list[str] | None = None) -> list[dict]:
    """Prints one line for each report (name, rows, seconds), and gives them back."""
    parser = argparse.ArgumentParser(description="The ten reports on a stored review table.")
    parser.add_argument("path")
    parser.add_argument("--report", nargs="+", choices=[*REPORTS], default=[*REPORTS])
    parser.add_argument("--sql", action="store_true")
    parser.add_argument("--explain", action="store_true")
    parser.add_argument("--target")
    chosen = parser.parse_args(args)
    spark = make_session("factlab-reports")
    table = reviews.load(spark, chosen.path)
    results = []
    for name in chosen.report:
        report = sql_report(name) if chosen.sql else REPORTS[name]
        result = report(spark, table)
        if chosen.explain:
            print(f"== {name} ==\n{plan_text(result)}")
        seconds: list[float] = []
        if chosen.target:
            folder = f"{chosen.target}/{name}"
            with benchmarks.timer(seconds):
                write_table(result, folder)
            rows = spark.read.parquet(folder).count()
        else:
            rows = benchmarks.run_once(result, seconds)
        results.append({"report": name, "rows": rows, "seconds": round(seconds[0], 3)})
        print(results[-1])
    return results


if __name__ == "__main__":
    main()
