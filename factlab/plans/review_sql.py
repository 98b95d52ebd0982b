"""The ten reports as SQL text over named views.

``run(spark, "q2")`` works on the views ``reviews``, ``app_metadata`` and
``user_profiles``; ``register`` in ``factlab.sources`` names them. Thresholds are
parameters with the reports' values as defaults, so ``run(spark, "q2",
min_rows=20)`` changes one without touching the text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from factlab.functions.calendar import FIRST_EPOCH, LAST_EPOCH
from factlab.plans import reviews as plan

ELITE = """
  select steamid, appid, voted_up, votes_up, weighted_vote_score, playtime_forever,
         review, unix_timestamp_created, review_year
  from reviews
  where voted_up and length(review) >= :characters
    and playtime_forever >= :minutes and weighted_vote_score >= :score
"""

# Means are rounded twice, as in operators.aggregates: the last bits of a sum depend on the
# order of its parts.

# Epoch seconds to a UTC date without help of the session time zone.
DAY = "date_from_unix_date(cast(floor(unix_timestamp_created / 86400) as int))"

GAMES = """
  select appid,
         round(round(avg(weighted_vote_score), 12), 4) as avg_helpfulness,
         count(*) as total_reviews,
         round(round(avg(playtime_forever), 10), 2) as avg_playtime_mins,
         sum(votes_up) as total_votes_up
  from reviews group by appid having total_reviews >= :min_rows
"""

TEXTS = {
    "q1": ELITE,
    "q2": GAMES,
    "q3": """
  select appid, voted_up,
         count(*) as review_count,
         round(round(avg(weighted_vote_score), 12), 4) as avg_helpfulness,
         round(round(avg(playtime_forever), 10), 2) as avg_playtime_mins,
         round(round(stddev_pop(weighted_vote_score), 12), 4) as score_std_dev
  from reviews where isnotnull(voted_up) and isnotnull(appid)
  group by all order by review_count desc
""",
    "q4": f"""
  with games as ({GAMES})
  select *, round(total_reviews * avg_helpfulness * ln(1 + avg_playtime_mins), 2)
              as engagement_score
  from games order by engagement_score desc, appid limit :k
""",
    # Best values per game joined back, as in operators.ranking: a plain rank()
    # window would bring all rows that tie in a game into one task, and the maximum
    # of a struct would sort every row before the shuffle. The broadcast
    # table has one row per slot, 65,536 at most.
    "q5": """
  with scored as (
    select appid, steamid, voted_up, weighted_vote_score, votes_up, playtime_forever
    from reviews where isnotnull(weighted_vote_score)),
  best as (
    select appid as best_appid, max(weighted_vote_score) as score from scored group by appid),
  bounds as (
    select xxhash64(best_appid) & 65535 as slot, min(score) as bound from best group by slot),
  near as (
    select /*+ broadcast(bounds) */ scored.* from scored
    join bounds on xxhash64(appid) & 65535 = slot and weighted_vote_score >= bound
    join best on appid <=> best_appid and weighted_vote_score = score),
  votes as (select appid as votes_appid, max(votes_up) as votes from near group by appid)
  select near.*, 1 as influence_rank
  from near join votes on appid <=> votes_appid and votes_up <=> votes
""",
    "q6": f"""
  with days as (
    select appid, {DAY} as review_date from reviews
    where unix_timestamp_created between :first_epoch and :last_epoch),
  daily as (
    select appid, review_date, count(*) as daily_review_count from days group by all)
  select *, round(avg(daily_review_count) over (
              partition by appid order by review_date
              rows between 6 preceding and current row), 2) as avg_7d_reviews
  from (select /*+ repartition_by_range(appid) */ * from daily) as daily
  order by appid, review_date
""",
    # As operators.aggregates and operators.joins do it: one scan serves the group
    # means and the overall mean, and the join has a shuffle of its own.
    "q7": f"""
  with elite as ({ELITE}),
  sums as (
    select appid, sum(double(weighted_vote_score)) as total, count(*) as n
    from reviews where isnotnull(weighted_vote_score) group by appid),
  games as (
    select appid, round(round(total / n, 12), 4) as game_avg_score from sums
    where n >= :mean_min_rows
      and round(round(total / n, 12), 4) > (select sum(total) / sum(n) from sums))
  select steamid, e.appid, weighted_vote_score, game_avg_score, playtime_forever
  from elite as e join games as g
    on xxhash64(e.appid) = xxhash64(g.appid) and e.appid <=> g.appid
  where isnotnull(e.appid)
""",
    # No broadcast hint: a view may name a table of any size, and Spark broadcasts
    # those below spark.sql.autoBroadcastJoinThreshold by itself.
    "q8": """
  select appid, app_name, genre, voted_up, weighted_vote_score, playtime_forever
  from reviews join app_metadata using (appid)
""",
    "q9": """
  select review_year, review_month, count(*) as monthly_reviews,
         round(round(avg(weighted_vote_score), 12), 4) as avg_score
  from reviews where review_year in (:years)
    and unix_timestamp_created >= :since and unix_timestamp_created < :until
  group by all order by review_year, review_month
""",
    "q10": """
  select /*+ merge(profiles) */
         steamid, username, account_age_days, total_reviews,
         appid, voted_up, weighted_vote_score, playtime_forever,
         account_age_days >= :veteran_days as is_veteran
  from reviews join user_profiles as profiles using (steamid)
""",
}

DEFAULTS = {
    "characters": plan.ELITE_CHARACTERS,
    "minutes": plan.ELITE_MINUTES,
    "score": plan.ELITE_SCORE,
    "min_rows": plan.STATS_MIN_REVIEWS,
    "mean_min_rows": plan.MEAN_MIN_REVIEWS,
    "k": plan.TOP_GAMES,
    "veteran_days": plan.VETERAN_DAYS,
    "first_epoch": FIRST_EPOCH,
    "last_epoch": LAST_EPOCH,
}


def run(
    spark: SparkSession,
    name: str,
    years=plan.SUMMARY_YEARS,
    partitioned: bool = False,
    views: Mapping[str, DataFrame] | None = None,
    **values,
) -> DataFrame:
    """The report ``name`` (q1 to q10), with ``values`` in place of the default thresholds.

    The years of q9 imply a range of the creation time that skips row groups; a table
    ``partitioned`` by review_year is pruned without it. ``views`` gives the tables
    themselves, in place of views of the session.
    """
    text = TEXTS[name].replace(":years", ", ".join(str(int(year)) for year in years))
    if partitioned:
        text = text.replace(_RANGE, "")
    bounds = {
        "since": _epoch(min(years, default=1970)),
        "until": _epoch(max(years, default=1969) + 1),
    }
    names = set(re.findall(r":([a-z_]+)", text))
    if unknown := values.keys() - names:
        raise ValueError(f"{name} has no parameter {', '.join(sorted(unknown))}")
    known = {**DEFAULTS, **bounds, **values}
    if views:
        # Braces name tables given with the text; the reports have no others.
        for view in views:
            text = re.sub(rf"\b(from|join) {view}\b", rf"\1 {{{view}}}", text)
    args = {key: known[key] for key in names}
    return spark.sql(text, args=args, **(views or {}))


_RANGE = """
    and unix_timestamp_created >= :since and unix_timestamp_created < :until"""


def _epoch(year: int) -> int:
    """First second of the year, UTC."""
    return int(datetime(year, 1, 1, tzinfo=UTC).timestamp())
