"""

Queries named q.. run one operator on the given tables. Those named reviews_..
and reviews_sql_.. run the ten reports of ``factlab.plans`` on a review table
that Spark derives from lineitem, NULLs included; their oracles derive the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlab import benchmarks, schemas
from factlab.functions import (
    add_period,
    at_least,
    day_number,
    day_of,
    json_columns,
    long_text,
    month_of,
    text_to_boolean,
    text_to_flag,
    within_years,
    year_of,
)
from factlab.operators import (
    Stat,
    above_global_mean,
    asof_join,
    by_days,
    daily_counts,
    distinct_bitmaps,
    distinct_sketches,
    error_bound,
    exists_in,
    filter_all,
    global_mean,
    grouped_levels,
    grouped_stats,
    interval_join,
    join_to_groups,
    key_changes,
    lookup_join,
    merge_join,
    merged_distinct,
    merged_distinct_estimate,
    merged_quantiles,
    moving_average,
    not_exists_in,
    not_in,
    outer_join,
    period_summary,
    preview,
    quantile_sketches,
    ranked,
    row_changes,
    sessions,
    shared,
    top_k,
    top_ranked,
)
from factlab.plans import review_sql, reviews
from factlab.sources import (
    cast_columns,
    dim_table,
    fresh_path,
    ingest_csv,
    read_csv_typed,
    read_table,
    register,
    write_csv_raw,
    write_table,
)
from factlab.streaming import file_stream, run_available, stream_sessions, stream_windows

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        _QUERIES[name] = function
        _ORACLES[name] = oracle
        return function

    return add


# Declared, so that building a query reads no file.
_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", _SCHEMAS[name])


# ---- filters and projections -------------------------------------------------

_ELITE_ITEMS = """select l_orderkey, l_partkey, l_quantity, l_discount from lineitem
  where l_quantity >= 30 and l_discount >= 0.07 and l_returnflag = 'R'
    and l_extendedprice >= 20000"""


def _elite(items: DataFrame) -> DataFrame:
    tests = [
        at_least("l_quantity", 30),
        at_least("l_discount", 0.07),
        F.col("l_returnflag") == "R",
        at_least("l_extendedprice", 20000),
    ]
    return filter_all(items, tests, ["l_orderkey", "l_partkey", "l_quantity", "l_discount"])


def _elite_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _elite(_table(spark, sf_dir, "lineitem"))


_query("q01_filter", _ELITE_ITEMS)(_elite_items)


@_query(
    "q01_text",
    """select doc_id, lang, source, n_chars from documents
       where n_chars >= 3000 and lang = 'en' and length(text) >= 100""",
)
def q01_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_all(
        _table(spark, sf_dir, "documents"),
        [at_least("n_chars", 3000), F.col("lang") == "en", long_text("text", 100)],
        ["doc_id", "lang", "source", "n_chars"],
    )


@_query(
    "q12_try_cast",
    """select doc_id, try_cast(source as int) as whole,
              try_cast(substr(source, 4) as int) as tail, lower(upper(source)) as lowered
       from documents""",
)
def q12_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("whole"),
        F.expr("substring(source, 4)").alias("tail"),
        F.lower(F.upper("source")).alias("lowered"),
    )
    return cast_columns(texts, {"whole": "int", "tail": "int"})


@_query(
    "q12_boolean",
    """select doc_id, quality = 1 as parsed, quality = 1 as flag,
              case when toxic = 0 then false end as unknown
       from labels""",
)
def q12_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    answer = F.when(F.col("quality") == 1, " TRUE").otherwise("maybe")
    return labels.select(
        "doc_id",
        text_to_boolean(F.col("quality").cast("string")).alias("parsed"),
        text_to_flag(answer).alias("flag"),
        text_to_boolean(F.when(F.col("toxic") == 0, "No").otherwise("maybe")).alias("unknown"),
    )


def _epoch(column: str) -> F.Column:
    """Epoch seconds of a zone-free timestamp, whatever the session time zone."""
    since = f"{column} - timestamp_ntz'1970-01-01'"
    return F.expr(f"cast(cast({since} as interval second) as bigint)")


@_query(
    "q13_time",
    """select o_orderkey, cast(o_orderdate as date) as order_date,
              cast(year(o_orderdate) as int) as order_year,
              cast(month(o_orderdate) as int) as order_month,
              cast(floor(epoch(o_orderdate) / 86400) as int) as day
       from orders""",
)
def q13_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", _epoch("o_orderdate").alias("seconds")
    )
    return orders.select(
        "o_orderkey",
        day_of(orders, "seconds").alias("order_date"),
        year_of(orders, "seconds").alias("order_year"),
        month_of(orders, "seconds").alias("order_month"),
        day_number(orders, "seconds").alias("day"),
    )


@_query("q17_column_scan", "select l_partkey, l_discount, l_quantity from lineitem")
def q17_column_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select("l_partkey", "l_discount", "l_quantity")


@_query(
    "q19_in_list",
    """select o_orderkey, o_totalprice, o_orderdate from orders
       where year(o_orderdate) in (1996, 1998)""",
)
def q19_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return within_years(orders, "o_orderdate", [1996, 1998])


@_query("q22_footer_scan", _ELITE_ITEMS)
def q22_footer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q01 with the schema taken from the file; the other queries declare it."""
    return _elite(read_table(spark, f"{sf_dir}/lineitem.parquet"))


# ---- aggregates --------------------------------------------------------------

_PART_STATS = """select l_partkey, round(avg(l_discount)::decimal(38, 12), 4)::double as avg_discount, count(*) as n,
         round(avg(l_quantity)::decimal(38, 12), 2)::double as avg_quantity,
         cast(sum(l_linenumber) as bigint) as sum_lines
  from lineitem group by l_partkey having count(*) >= {min_rows}"""


def _part_stats(spark: SparkSession, sf_dir: str, min_rows: int) -> DataFrame:
    stats = [
        Stat("avg_discount", "mean", "l_discount", 4),
        Stat("avg_quantity", "mean", "l_quantity", 2),
        Stat("sum_lines", "sum", "l_linenumber"),
    ]
    return grouped_stats(
        _table(spark, sf_dir, "lineitem"), ["l_partkey"], stats, min_rows=min_rows
    )


@_query("q02_grouped_stats", _PART_STATS.format(min_rows=35))
def q02_grouped_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_stats(spark, sf_dir, 35)


@_query(
    "q02_zero",
    """select l_partkey, count(*) as n,
              round(avg(coalesce(nullif(l_discount, 0), 0))::decimal(38, 12), 4)::double as avg_discount,
              round(sum(coalesce(nullif(l_discount, 0), 0))::decimal(38, 12), 2)::double as sum_discount
       from lineitem group by l_partkey""",
)
def q02_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nullable_stats(spark, sf_dir, "zero")


@_query(
    "q02_skip",
    """select l_partkey, count(*) as n, round(avg(nullif(l_discount, 0))::decimal(38, 12), 4)::double as avg_discount,
              round(sum(nullif(l_discount, 0))::decimal(38, 12), 2)::double as sum_discount
       from lineitem group by l_partkey""",
)
def q02_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nullable_stats(spark, sf_dir, "skip")


def _nullable_stats(spark: SparkSession, sf_dir: str, nulls: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.nullif("l_discount", F.lit(0.0)).alias("discount")
    )
    stats = [
        Stat("avg_discount", "mean", "discount", 4),
        Stat("sum_discount", "sum", "discount", 2),
    ]
    return grouped_stats(items, ["l_partkey"], stats, nulls=nulls)


_FLAG_STATS = """select l_suppkey, l_returnflag, count(*) as n,
         round(avg(l_discount)::decimal(38, 12), 4)::double as avg_discount,
         round({std}(l_discount)::decimal(38, 12), 4)::double as std_discount
  from lineitem group by l_suppkey, l_returnflag"""


def _flag_stats(spark: SparkSession, sf_dir: str, ddof: int) -> DataFrame:
    stats = [
        Stat("avg_discount", "mean", "l_discount", 4),
        Stat("std_discount", "std", "l_discount", 4),
    ]
    items = _table(spark, sf_dir, "lineitem")
    groups = grouped_stats(items, ["l_suppkey", "l_returnflag"], stats, ddof=ddof)
    return groups.orderBy(F.desc("n"))


@_query("q03_multi_key", _FLAG_STATS.format(std="stddev_samp"))
def q03_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag_stats(spark, sf_dir, 1)


@_query("q03_population", _FLAG_STATS.format(std="stddev_pop"))
def q03_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag_stats(spark, sf_dir, 0)


_MEANS = """select round(avg(l_discount), 8) as mean, count(*) as n from lineitem"""


@_query("q14_global_mean", _MEANS)
def q14_global_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem")
    return grouped_stats(items, [], [Stat("mean", "mean", "l_discount", 8)])


@_query("q14_mean_of_valued", "select round(avg(nullif(l_discount, 0)), 8) as mean from lineitem")
def q14_mean_of_valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("discount")
    )
    return global_mean(items, "discount").select(F.round("mean", 8).alias("mean"))


@_query(
    "q16_daily",
    """select event_type, cast(ts as date) as day, count(*) as n
       from events group by event_type, cast(ts as date)""",
)
def q16_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_counts(_table(spark, sf_dir, "events"), "event_type", "ts", "day", "n")


_ORDERS_1997 = """select cast(year(o_orderdate) as int) as order_year,
         cast(month(o_orderdate) as int) as order_month,
         count(*) as n, round(avg(o_totalprice)::decimal(38, 12), 4)::double as avg_price
  from orders where year(o_orderdate) = 1997
  group by year(o_orderdate), month(o_orderdate)"""
_PERIOD = ["order_year", "order_month"]
_AVG_PRICE = [Stat("avg_price", "mean", "o_totalprice", 4)]


@_query("q09_period", _ORDERS_1997)
def q09_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = within_years(_table(spark, sf_dir, "orders"), "o_orderdate", [1997])
    return period_summary(add_period(orders, "o_orderdate", *_PERIOD), _PERIOD, _AVG_PRICE, [1997])


@_query("q15_partitioned", _ORDERS_1997)
def q15_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q09 on a copy of orders stored by year and month, of which it opens one year."""
    path = fresh_path(spark, "orders")
    orders = _table(spark, sf_dir, "orders")
    write_table(add_period(orders, "o_orderdate", *_PERIOD), path, partition_by=_PERIOD)
    return period_summary(read_table(spark, path), _PERIOD, _AVG_PRICE, [1997])


# ---- top-k, ranks and moving averages -------------------------------------------


@_query(
    "q04_top_k",
    """select l_partkey, n, round(n * avg_discount * ln(avg_quantity + 1), 2) as engagement
       from (select l_partkey, count(*) as n, round(avg(l_discount)::decimal(38, 12), 4)::double as avg_discount,
                    round(avg(l_quantity)::decimal(38, 12), 2)::double as avg_quantity
             from lineitem group by l_partkey having count(*) >= 20) as parts
       order by engagement desc, l_partkey limit 10""",
)
def q04_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    engagement = F.round(F.col("n") * F.col("avg_discount") * F.log1p("avg_quantity"), 2)
    parts = _part_stats(spark, sf_dir, 20)
    best = top_k(parts, engagement, "engagement", 10, tie_break=["l_partkey"])
    return best.select("l_partkey", "n", "engagement")


@_query(
    "q05_rank",
    """select l_partkey, l_orderkey, l_linenumber, l_discount, l_quantity, cast(r as int) as r
       from (select *, rank() over (partition by l_partkey
                                    order by l_discount desc, l_quantity desc) as r
             from lineitem) as ranked where r = 1""",
)
def q05_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_discount", "l_quantity"
    )
    return top_ranked(items, ["l_partkey"], ["l_discount", "l_quantity"], "r")


@_query(
    "q05_one",
    """select l_partkey, l_orderkey, l_linenumber, l_extendedprice, l_discount, l_quantity,
              cast(r as int) as r
       from (select *, row_number() over (
                 partition by l_partkey
                 order by l_discount desc, l_quantity desc, l_orderkey desc,
                          l_linenumber desc, l_extendedprice desc) as r
             from lineitem) as ranked where r = 1""",
)
def q05_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity"
    )
    return top_ranked(
        items,
        ["l_partkey"],
        ["l_discount", "l_quantity"],
        "r",
        ties="one",
        tie_break=["l_orderkey", "l_linenumber", "l_extendedprice"],
    )


@_query(
    "q21_rank_one_key",
    """select l_partkey, l_orderkey, l_linenumber, l_discount, cast(r as int) as r
       from (select *, rank() over (partition by l_partkey order by l_discount desc) as r
             from lineitem) as ranked where r = 1""",
)
def q21_rank_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_discount"
    )
    return top_ranked(items, ["l_partkey"], ["l_discount"], "r")


_TREND = """select l_suppkey, day, n,
         round(avg(n) over (partition by l_suppkey order by day {frame}), 2) as avg_7d
  from (select l_suppkey, cast(l_shipdate as date) as day, count(*) as n
        from lineitem group by l_suppkey, cast(l_shipdate as date)) as daily"""


def _trend(spark: SparkSession, sf_dir: str, frame: str) -> DataFrame:
    daily = daily_counts(_table(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate", "day", "n")
    return moving_average(daily, "l_suppkey", "day", "n", "avg_7d", frame=frame, ordered=True)


@_query(
    "q06_range",
    _TREND.format(frame="range between interval 6 day preceding and current row"),
)
def q06_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(spark, sf_dir, "range")


@_query("q06_rows", _TREND.format(frame="rows between 6 preceding and current row"))
def q06_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend(spark, sf_dir, "rows")


@_query(
    "q24_preview",
    """select l_suppkey, l_returnflag, count(*) as n,
              round(avg(l_discount)::decimal(38, 12), 4)::double as avg_discount,
              round(stddev_samp(l_discount)::decimal(38, 12), 4)::double as std_discount
       from lineitem group by l_suppkey, l_returnflag
       order by n desc, l_suppkey, l_returnflag limit 20""",
)
def q24_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = [
        Stat("avg_discount", "mean", "l_discount", 4),
        Stat("std_discount", "std", "l_discount", 4),
    ]
    keys = ["l_suppkey", "l_returnflag"]
    groups = grouped_stats(_table(spark, sf_dir, "lineitem"), keys, stats)
    return preview(groups, 20, [F.desc("n"), *keys])


# ---- joins ---------------------------------------------------------------------

_ABOVE_MEAN = f"""with elite as ({_ELITE_ITEMS}),
  parts as (
    select l_partkey, round(avg(l_discount)::decimal(38, 12), 4)::double as avg_discount from lineitem
    group by l_partkey having count(*) >= 20
       and round(avg(l_discount)::decimal(38, 12), 4)::double > (select avg(l_discount) from lineitem))
  select e.*, p.avg_discount from elite as e join parts as p on e.l_partkey = p.l_partkey"""


def _above_mean(spark: SparkSession, sf_dir: str, elite: DataFrame) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem")
    parts = above_global_mean(items, "l_partkey", "l_discount", "avg_discount", min_rows=20)
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_discount", "avg_discount"]
    return join_to_groups(elite, parts, "l_partkey", columns)


@_query("q07_above_mean", _ABOVE_MEAN)
def q07_above_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _above_mean(spark, sf_dir, _elite_items(spark, sf_dir))


@_query(
    "q20_cached",
    f"select *, cast((select count(*) from ({_ELITE_ITEMS})) as bigint) as n_elite from ({_ABOVE_MEAN})",
)
def q20_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q07 and the count of q01 on elite rows that are kept while both read them."""
    path = fresh_path(spark, "elite")
    with shared(_elite_items(spark, sf_dir)) as elite:
        n = elite.agg(F.count(F.lit(1)).alias("n")).scalar()
        write_table(_above_mean(spark, sf_dir, elite).withColumn("n_elite", n), path)
    return read_table(spark, path)


@_query(
    "q08_lookup_join",
    """select s_name, n_name, l_orderkey, l_quantity from lineitem
       join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""",
)
def q08_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    nations = _table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    # There are 25 nations at any scale; suppliers grow with the data.
    suppliers = lookup_join(
        _table(spark, sf_dir, "supplier"),
        nations,
        "s_nationkey",
        ["s_suppkey", "s_name", "n_name"],
        fixed_size=True,
    )
    columns = ["s_name", "n_name", "l_orderkey", "l_quantity"]
    return lookup_join(items, suppliers, "s_suppkey", columns)


@_query(
    "q23_inline_dim",
    """select l_orderkey, l_returnflag, meaning from lineitem
       join (values ('A', 'accepted'), ('R', 'returned'), ('X', 'unused'))
         as flags(flag, meaning) on l_returnflag = flag""",
)
def q23_inline_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("A", "accepted"), ("R", "returned"), ("X", "unused")]
    flags = dim_table(spark, rows, "l_returnflag string, meaning string")
    columns = ["l_orderkey", "l_returnflag", "meaning"]
    items = _table(spark, sf_dir, "lineitem")
    return lookup_join(items, flags, "l_returnflag", columns, fixed_size=True)


_MERGED = """select o_orderkey, c_custkey, c_name, o_totalprice, c_acctbal >= 5000 as wealthy
  from orders join customer on o_custkey = c_custkey"""


def _merged(spark: SparkSession, sf_dir: str, partitions: int | None) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    columns = ["o_orderkey", "c_custkey", "c_name", "o_totalprice", "c_acctbal"]
    joined = merge_join(
        orders, _table(spark, sf_dir, "customer"), "c_custkey", columns, partitions
    )
    return joined.withColumn("wealthy", at_least("c_acctbal", 5000)).drop("c_acctbal")


@_query("q10_merge_join", _MERGED)
def q10_merge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, None)


@_query("q10_aligned", _MERGED)
def q10_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, 16)


# ---- ingest and views ------------------------------------------------------------


_DOCUMENTS = "select doc_id, text, lang, source, n_chars from documents"


def _ingested(spark: SparkSession, sf_dir: str, tasks: str) -> DataFrame:
    """documents through raw CSV and back: quotes, commas and newlines survive."""
    documents = _table(spark, sf_dir, "documents")
    raw, typed = fresh_path(spark, "documents-csv"), fresh_path(spark, "documents")
    # Compressed files cannot be read by blocks.
    compression = "gzip" if tasks == "files" else "none"
    write_csv_raw(documents, raw, records_per_file=20_000, compression=compression)
    ingest_csv(spark, raw, typed, {"doc_id": "bigint", "n_chars": "bigint"}, tasks=tasks)
    return read_table(spark, typed)


@_query("q11_ingest", _DOCUMENTS)
def q11_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, "files")


@_query("q11_ingest_blocks", _DOCUMENTS)
def q11_ingest_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, "blocks")


@_query("q18_views", _PART_STATS.format(min_rows=35))
def q18_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(_table(spark, sf_dir, "lineitem"), "factlab_lineitem")
    return spark.sql(
        """select l_partkey, round(round(avg(l_discount), 12), 4) as avg_discount,
                  count(*) as n, round(round(avg(l_quantity), 10), 2) as avg_quantity,
                  sum(l_linenumber) as sum_lines
           from factlab_lineitem group by l_partkey having n >= :min_rows""",
        args={"min_rows": 35},
    )


# ---- the ten reports on a review table ------------------------------------------

_REVIEWS = """reviews as (
  select l_orderkey as steamid, cast(l_suppkey as int) as appid,
         case l_returnflag when 'R' then true when 'A' then false end as voted_up,
         nullif(l_linenumber, 7) as votes_up,
         cast(nullif(l_discount, 0) * 10 as float) as weighted_vote_score,
         cast(l_quantity * 100 as bigint) as playtime_forever,
         repeat(l_linestatus, cast(l_quantity * 4 as int)) as review,
         cast(floor(epoch(l_shipdate)) as bigint) as unix_timestamp_created,
         cast(year(l_shipdate) as int) as review_year,
         cast(month(l_shipdate) as int) as review_month
  from lineitem)"""


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, lines = F.col("l_returnflag"), F.col("l_linenumber")
    minutes = (F.col("l_quantity") * 100).cast("bigint")
    score = (F.nullif("l_discount", F.lit(0.0)) * 10).cast("float")
    table = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("steamid"),
        F.col("l_suppkey").cast("int").alias("appid"),
        F.when(flag == "R", True).when(flag == "A", False).alias("voted_up"),
        F.nullif(lines, F.lit(7)).alias("votes_up"),
        F.col("l_orderkey").alias("votes_funny"),
        score.alias("weighted_vote_score"),
        minutes.alias("playtime_forever"),
        minutes.alias("playtime_at_review"),
        lines.alias("num_games_owned"),
        lines.alias("num_reviews"),
        F.repeat("l_linestatus", (F.col("l_quantity") * 4).cast("int")).alias("review"),
        _epoch("l_shipdate").alias("unix_timestamp_created"),
        _epoch("l_shipdate").alias("unix_timestamp_updated"),
    )
    return reviews.with_period(table)


def _apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    named = lookup_join(_table(spark, sf_dir, "supplier"), nations, "s_nationkey", fixed_size=True)
    return named.select(
        F.col("s_suppkey").cast("int").alias("appid"),
        F.col("s_name").alias("app_name"),
        F.col("n_name").alias("genre"),
    )


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("steamid"),
        F.col("o_orderpriority").alias("username"),
        F.col("o_custkey").cast("int").alias("account_age_days"),
        F.col("o_custkey").cast("int").alias("total_reviews"),
    )


# A FLOAT is compared as DOUBLE in Spark, hence the casts.
_ELITE_REVIEWS = """elite as (
  select steamid, appid, voted_up, votes_up, weighted_vote_score, playtime_forever, review,
         unix_timestamp_created, review_year
  from reviews where playtime_forever >= 3000 and voted_up and length(review) >= 100
    and cast(weighted_vote_score as double) >= cast(0.7 as double))"""
_GAMES = """games as (
  select appid, round(avg({score})::decimal(38, 12), 4)::double as avg_helpfulness, count(*) as total_reviews,
         round(avg(playtime_forever)::decimal(38, 12), 2)::double as avg_playtime_mins,
         cast(sum({votes}) as bigint) as total_votes_up
  from reviews group by appid having count(*) >= 50)"""
_GAMES_SKIP = _GAMES.format(score="weighted_vote_score", votes="votes_up")
_GAMES_ZERO = _GAMES.format(score="coalesce(weighted_vote_score, 0)", votes="coalesce(votes_up, 0)")
_ENGAGED = """select *, round(total_reviews * avg_helpfulness * ln(avg_playtime_mins + 1), 2)
         as engagement_score
  from games order by engagement_score desc, appid limit 10"""
_VERDICTS = """select appid, voted_up, count(*) as review_count,
         round(avg({score})::decimal(38, 12), 4)::double as avg_helpfulness,
         round(avg(playtime_forever)::decimal(38, 12), 2)::double as avg_playtime_mins,
         round({std}({score})::decimal(38, 12), 4)::double as score_std_dev
  from reviews where voted_up is not null and appid is not null group by appid, voted_up"""
_TOP = """select appid, steamid, voted_up, weighted_vote_score, votes_up, playtime_forever,
         cast(r as int) as influence_rank
  from (select *, {function} over (partition by appid order by {order}) as r
        from reviews where weighted_vote_score is not null) as ranked where r = 1"""
_TOP_ALL = _TOP.format(
    function="rank()",
    order="weighted_vote_score desc nulls last, votes_up desc nulls last",
)
_TOP_ONE = _TOP.format(
    function="row_number()",
    order="""weighted_vote_score desc nulls last, coalesce(votes_up, 0) desc,
             steamid desc, playtime_forever desc, voted_up desc nulls last""",
)
_REVIEW_TREND = """select appid, review_date, daily_review_count,
         round(avg(daily_review_count) over (partition by appid order by review_date {frame}), 2)
           as avg_7d_reviews
  from (select appid, date '1970-01-01' + cast(floor(unix_timestamp_created / 86400) as int) as review_date,
               count(*) as daily_review_count
        from reviews group by 1, 2) as daily"""
_BY_RANGE = _REVIEW_TREND.format(frame="range between interval 6 day preceding and current row")
_BY_ROWS = _REVIEW_TREND.format(frame="rows between 6 preceding and current row")
_GOOD_GAMES = """select e.steamid, e.appid, e.weighted_vote_score, g.game_avg_score,
         e.playtime_forever
  from elite as e join (
    select appid, round(avg(weighted_vote_score)::decimal(38, 12), 4)::double as game_avg_score from reviews
    where weighted_vote_score is not null group by appid
    having count(*) >= 20 and round(avg(weighted_vote_score)::decimal(38, 12), 4)::double >
      (select avg(weighted_vote_score) from reviews)) as g on e.appid = g.appid"""
_NAMED = """select appid, s_name as app_name, n_name as genre, voted_up, weighted_vote_score,
         playtime_forever
  from reviews join supplier on appid = s_suppkey join nation on s_nationkey = n_nationkey"""
_MONTHLY = """select review_year, review_month, count(*) as monthly_reviews,
         round(avg({score})::decimal(38, 12), 4)::double as avg_score
  from reviews where review_year in (1996, 1997) group by review_year, review_month"""
_PROFILED = """select steamid, o_orderpriority as username,
         cast(o_custkey as int) as account_age_days, cast(o_custkey as int) as total_reviews,
         appid, voted_up, weighted_vote_score, playtime_forever, o_custkey >= 365 as is_veteran
  from reviews join orders on steamid = o_orderkey"""
_YEARS = (1996, 1997)


def _report(
    name: str, body: str, report: Callable[[DataFrame, SparkSession, str], DataFrame], *ctes: str
) -> None:
    oracle = f"with {', '.join([_REVIEWS, *ctes])} {body}"
    _query(name, oracle)(
        lambda spark, sf_dir: report(_reviews(spark, sf_dir), spark, sf_dir)
    )


_report("reviews_q01", "select * from elite", lambda t, *_: reviews.elite_reviews(t), _ELITE_REVIEWS)
_report("reviews_q02", "select * from games", lambda t, *_: reviews.game_stats(t), _GAMES_SKIP)
_report(
    "reviews_q02_zero",
    "select * from games",
    lambda t, *_: reviews.game_stats(t, nulls="zero"),
    _GAMES_ZERO,
)
_report(
    "reviews_q03",
    _VERDICTS.format(score="weighted_vote_score", std="stddev_samp"),
    lambda t, *_: reviews.verdict_stats(t),
)
_report(
    "reviews_q03_zero",
    _VERDICTS.format(score="coalesce(weighted_vote_score, 0)", std="stddev_pop"),
    lambda t, *_: reviews.verdict_stats(t, nulls="zero", ddof=0),
)
_report("reviews_q04", _ENGAGED, lambda t, *_: reviews.top_games(t), _GAMES_SKIP)
_report("reviews_q04_zero", _ENGAGED, lambda t, *_: reviews.top_games(t, "zero"), _GAMES_ZERO)
_report("reviews_q05", _TOP_ALL, lambda t, *_: reviews.top_reviews(t))
_report("reviews_q05_one", _TOP_ONE, lambda t, *_: reviews.top_reviews(t, ties="one"))
_report("reviews_q06", _BY_RANGE, lambda t, *_: reviews.review_trend(t))
_report(
    "reviews_q06_numbers",
    f"""select appid, cast(date_diff('day', date '1970-01-01', review_date) as int) as day_epoch,
               avg_7d_reviews as avg_7d from ({_BY_RANGE}) as trend""",
    lambda t, *_: reviews.review_trend_by_number(t),
)
_report("reviews_q07", _GOOD_GAMES, lambda t, *_: reviews.elite_in_good_games(t), _ELITE_REVIEWS)
_report(
    "reviews_q08",
    _NAMED,
    lambda t, spark, sf_dir: reviews.named_reviews(t, _apps(spark, sf_dir), fixed_size=False),
)
_report(
    "reviews_q09",
    _MONTHLY.format(score="weighted_vote_score"),
    lambda t, *_: reviews.monthly_summary(t, _YEARS),
)
_report(
    "reviews_q09_zero",
    _MONTHLY.format(score="coalesce(weighted_vote_score, 0)"),
    lambda t, *_: reviews.monthly_summary(t, _YEARS, nulls="zero"),
)
_report(
    "reviews_q10",
    _PROFILED,
    lambda t, spark, sf_dir: reviews.profiled_reviews(t, _profiles(spark, sf_dir)),
)


def _stored_reviews(table: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, typed = fresh_path(spark, "reviews-csv"), fresh_path(spark, "reviews")
    write_csv_raw(table.drop("review_year", "review_month"), raw, compression="gzip")
    reviews.ingest(spark, raw, typed, partition_by=["review_year", "review_month"])
    return reviews.monthly_summary(reviews.load(spark, typed), _YEARS, partitioned=True)


_report("reviews_ingest", _MONTHLY.format(score="weighted_vote_score"), _stored_reviews)


def _sql_report(name: str, body: str, *ctes: str) -> None:
    def run(table: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
        views = {
            "reviews": table,
            "app_metadata": _apps(spark, sf_dir),
            "user_profiles": _profiles(spark, sf_dir),
        }
        used = {view: df for view, df in views.items() if view in review_sql.TEXTS[name]}
        return review_sql.run(spark, name, years=_YEARS, views=used)

    _report(f"reviews_sql_{name}", body, run, *ctes)


_sql_report("q1", "select * from elite", _ELITE_REVIEWS)
_sql_report("q2", "select * from games", _GAMES_SKIP)
_sql_report("q3", _VERDICTS.format(score="weighted_vote_score", std="stddev_pop"))
_sql_report("q4", _ENGAGED, _GAMES_SKIP)
_sql_report("q5", _TOP_ALL)
_sql_report("q6", _BY_ROWS)
_sql_report("q7", _GOOD_GAMES, _ELITE_REVIEWS)
_sql_report("q8", _NAMED)
_sql_report("q9", _MONTHLY.format(score="weighted_vote_score"))
_sql_report("q10", _PROFILED)


# ---- benchmark jobs ----------------------------------------------------------------
# Their timings differ from run to run; what is compared is the rows each workload gave.

_ELITE_ROWS = "(select count(*) from elite)"
_GAME_ROWS = "(select count(*) from games)"
_VERDICT_ROWS = "(select count(*) from (select distinct appid, voted_up from reviews) as v)"
_TOP_SCORE_ROWS = """(select count(*) from (
    select rank() over (partition by appid order by weighted_vote_score desc) as r
    from reviews where weighted_vote_score is not null) as ranked where r = 1)"""
_ALL_ROWS = "(select count(*) from reviews)"


def review_formats(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The review table stored as raw CSV and as Parquet, both read back."""
    raw, typed = fresh_path(spark, "reviews-csv"), fresh_path(spark, "reviews")
    stored = _reviews(spark, sf_dir).drop("review_year", "review_month")
    write_csv_raw(stored, raw, compression="gzip")
    write_table(stored, typed)
    csv = reviews.with_period(read_csv_typed(spark, raw, schemas.REVIEWS))
    return csv, reviews.load(spark, typed)


def _formats(table: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    csv, parquet = review_formats(spark, sf_dir)
    result = benchmarks.compare_formats(csv, parquet, repeats=1, warm_up=False)
    return result.select("workload", "csv_rows", "parquet_rows")


_report(
    "b1_formats",
    f"""select workload, cast(n as bigint) as csv_rows, cast(n as bigint) as parquet_rows
        from (select 'count' as workload, {_ALL_ROWS} as n
              union all select 'aggregation', {_GAME_ROWS}
              union all select 'complex_filter', {_ELITE_ROWS}
              union all select 'column_scan', {_ALL_ROWS}) as results""",
    _formats,
    _ELITE_REVIEWS,
    _GAMES_SKIP,
)
_report(
    "b2_partitions",
    f"""select workload, cast(partitions as int) as partitions, cast(n as bigint) as rows
        from (select 'q2' as workload, {_GAME_ROWS} as n
              union all select 'q3', {_VERDICT_ROWS}
              union all select 'q5', {_TOP_SCORE_ROWS}) as results
        cross join (values (50), (100), (200), (400)) as widths(partitions)""",
    lambda t, *_: benchmarks.sweep_partitions(t, repeats=1, warm_up=False).select(
        "workload", "partitions", "rows"
    ),
    _GAMES_SKIP,
)
_report(
    "b3_profiles",
    f"""select profile, workload, cast(n as bigint) as rows
        from (select 'count' as workload, {_ALL_ROWS} as n
              union all select 'aggregation', {_GAME_ROWS}) as results
        cross join (values ('default'), ('low'), ('high')) as profiles(profile)""",
    lambda t, *_: benchmarks.time_profiles(t, repeats=1, warm_up=False).select(
        "profile", "workload", "rows"
    ),
    _GAMES_SKIP,
)


# ---- time joins, numbering, grouping sets ---------------------------------------------


@_query(
    "q25_asof",
    """with last as (select o_custkey, o_orderdate, max(o_orderkey) as o_orderkey
         from orders group by all)
       select e.event_id, e.user_id, e.ts, o.o_orderdate as order_date, o.o_orderkey as order_key
       from events as e asof left join last as o
         on e.user_id = o.o_custkey and e.ts >= o.o_orderdate""",
)
def q25_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's last order before it."""
    return asof_join(
        _table(spark, sf_dir, "events").select("event_id", "user_id", "ts"),
        _table(spark, sf_dir, "orders"),
        [("user_id", "o_custkey")],
        "ts",
        "o_orderdate",
        {"o_orderdate": "order_date", "o_orderkey": "order_key"},
        by_days(365),
    )


@_query(
    "q25_asof_ships",
    """with shipped as (select l_suppkey, l_shipdate, max(l_orderkey) as l_orderkey
         from lineitem where l_returnflag = 'R' group by all)
       select i.l_orderkey, i.l_linenumber, i.l_suppkey, i.l_shipdate,
              r.l_shipdate as last_return, r.l_orderkey as returned_order
       from (select * from lineitem where l_returnflag = 'A') as i asof left join shipped as r
         on i.l_suppkey = r.l_suppkey and i.l_shipdate >= r.l_shipdate""",
)
def q25_asof_ships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each accepted item with its supplier's last returned one up to its day."""
    items = _table(spark, sf_dir, "lineitem")
    return asof_join(
        items.where("l_returnflag = 'A'").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"),
        items.where("l_returnflag = 'R'"),
        [("l_suppkey", "l_suppkey")],
        "l_shipdate",
        "l_shipdate",
        {"l_shipdate": "last_return", "l_orderkey": "returned_order"},
        by_days(90),
    )


@_query(
    "q26_interval_points",
    """select c.event_id as click_id, c.ts as clicked_at, e.event_id as error_id, e.ts as failed_at
       from events as c join events as e on c.user_id = e.user_id
        and c.ts between e.ts and e.ts + interval 6 hours
       where c.event_type = 'click' and e.event_type = 'error'""",
)
def q26_interval_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks within six hours after an error of the same user."""
    events = _table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("clicked_at")
    )
    errors = events.where("event_type = 'error'").select(
        F.col("event_id").alias("error_id"),
        F.col("user_id").alias("failed_user"),
        F.col("ts").alias("failed_at"),
        F.expr("ts + interval 6 hours").alias("until"),
    )
    pairs = interval_join(
        clicks, errors, [("user_id", "failed_user")], ("clicked_at", "clicked_at"), ("failed_at", "until")
    )
    return pairs.drop("user_id", "failed_user", "until")


@_query(
    "q26_interval_overlaps",
    """select a.o_orderkey as one, b.o_orderkey as other, a.o_custkey as customer
       from orders as a join orders as b on a.o_custkey = b.o_custkey
        and a.o_orderdate <= b.o_orderdate + interval 30 days
        and b.o_orderdate <= a.o_orderdate + interval 30 days
       where a.o_orderkey < b.o_orderkey""",
)
def q26_interval_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of orders of a customer whose windows of 30 days overlap."""

    def windows(name: str) -> DataFrame:
        return _table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias(name),
            F.col("o_custkey").alias(f"{name}_customer"),
            F.col("o_orderdate").alias(f"{name}_from"),
            F.expr("o_orderdate + interval 30 days").alias(f"{name}_to"),
        )

    pairs = interval_join(
        windows("one"),
        windows("other"),
        [("one_customer", "other_customer")],
        ("one_from", "one_to"),
        ("other_from", "other_to"),
        by_days(30),
    )
    return pairs.where("one < other").select("one", "other", F.col("one_customer").alias("customer"))


@_query(
    "q27_ranked",
    """select o_orderkey, o_totalprice, o_orderpriority,
              row_number() over (order by o_totalprice desc, o_orderkey) as place,
              ntile(100) over (order by o_totalprice desc, o_orderkey) as part
       from orders""",
)
def q27_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders numbered and cut into hundredths by price."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return ranked(orders, ["-o_totalprice", "o_orderkey"], "place", ntile=("part", 100))


@_query(
    "q27_ranked_ties",
    """select o_orderkey, o_orderdate, rank() over w as rank, dense_rank() over w as dense,
              round(percent_rank() over w, 9) as share, round(cume_dist() over w, 9) as upto
       from orders window w as (order by o_orderdate)""",
)
def q27_ranked_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of orders by day, with many ties."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    days = ranked(
        orders, ["o_orderdate"], rank="rank", dense_rank="dense", percent_rank="share", cume_dist="upto"
    )
    return days.drop("row_number").withColumns({c: F.round(c, 9) for c in ("share", "upto")})


@_query(
    "q28_cube",
    """select l_returnflag, l_linestatus, grouping_id(l_returnflag, l_linestatus)::bigint as level,
              count(*) as n, round(avg(l_quantity::decimal(18, 2)), 4) as avg_quantity
       from lineitem group by cube (l_returnflag, l_linestatus)""",
)
def q28_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = [Stat("avg_quantity", "mean", "l_quantity", 4)]
    items = _table(spark, sf_dir, "lineitem")
    return grouped_levels(items, ["l_returnflag", "l_linestatus"], "cube", stats)


@_query(
    "q28_rollup",
    """select order_year, o_orderpriority, o_orderstatus,
              grouping_id(order_year, o_orderpriority, o_orderstatus)::bigint as level, count(*) as n
       from (select *, year(o_orderdate)::int as order_year from orders)
       group by rollup (order_year, o_orderpriority, o_orderstatus)""",
)
def q28_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    return grouped_levels(orders, ["order_year", "o_orderpriority", "o_orderstatus"], "rollup", [])


# ---- streams and sessions ------------------------------------------------------------


def _streamed(spark: SparkSession, result: DataFrame) -> DataFrame:
    """What a stream gives for all files there are."""
    folder = fresh_path(spark, "stream")
    run_available(result, f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.schema(result.schema).parquet(f"{folder}/rows")


@_query(
    "q29_windows",
    """with hours as (
         select time_bucket(interval 1 hour, ts) as window_start, event_type,
                count(*) as n,
                sum(round(value * 100)::bigint)::bigint as cents, max(value) as top
         from events where ts is not null group by all),
       ends as (select max(ts) - interval 2 hours as mark from events)
       select window_start, window_start + interval 1 hour as window_end, event_type, n, cents, top
       from hours, ends where window_start + interval 1 hour <= date_trunc('milliseconds', mark)""",
)
def q29_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of events by type that a watermark of two hours has closed, from a stream."""
    stats = [
        F.count("*").alias("n"),
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"),
        F.max("value").alias("top"),
    ]
    stream = file_stream(spark, f"{sf_dir}/events.parquet", _SCHEMAS["events"])
    return _streamed(spark, stream_windows(stream, "ts", "1 hour", "2 hours", ["event_type"], stats))


#: Sessions of users by gaps and islands: rows over half an hour after the row before start one.
_SESSIONS = """with gaps as (
    select *, coalesce(ts > lag(ts) over w + interval 30 minutes, true) as new
    from events where ts is not null window w as (partition by user_id order by ts)),
  numbered as (
    select *, sum(new::int) over (partition by user_id order by ts)::bigint as session from gaps),
  sessions as (
    select user_id, session, min(ts) as first_at, max(ts) as last_at, count(*) as n
    from numbered group by all)
"""


@_query("q30_sessions", _SESSIONS + "select * from sessions")
def q30_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, with gaps of up to half an hour."""
    return sessions(_table(spark, sf_dir, "events"), ["user_id"], "ts", 1800)


@_query(
    "q30_sessions_stream",
    _SESSIONS
    + """select user_id, first_at as session_start, last_at + interval 30 minutes as session_end, n
      from sessions where last_at + interval 30 minutes
        <= date_trunc('milliseconds', (select max(ts) - interval 2 hours from events))""",
)
def q30_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions that a watermark of two hours has closed, from a stream."""
    stream = file_stream(spark, f"{sf_dir}/events.parquet", _SCHEMAS["events"])
    found = stream_sessions(
        stream, "ts", "30 minutes", "2 hours", ["user_id"], [F.count("*").alias("n")]
    )
    return _streamed(spark, found)


# ---- stored distinct counts, differences of snapshots ------------------------------------


@_query(
    "q31_distinct_suppliers",
    """select l_returnflag, year(l_shipdate)::int as ship_year,
              count(distinct l_suppkey) as suppliers, count(distinct l_orderkey) as orders
       from lineitem group by all""",
)
def q31_distinct_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and orders of a year, merged from bitmaps that are stored by month."""
    items = _table(spark, sf_dir, "lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    keys = ["l_returnflag", "ship_year"]

    def counted(column: str, name: str) -> DataFrame:
        path = fresh_path(spark, "bitmaps")
        distinct_bitmaps(items, ["l_returnflag", "month"], column).write.parquet(path)
        stored = spark.read.parquet(path).withColumn("ship_year", F.year("month"))
        return merged_distinct(stored, keys, name)

    return counted("l_suppkey", "suppliers").join(counted("l_orderkey", "orders"), keys)


_ITEM_BAGS = """with old as (select l_suppkey, l_quantity, l_linestatus from lineitem where l_returnflag = 'A'),
  new as (select l_suppkey, l_quantity, l_linestatus from lineitem where l_returnflag = 'R')
"""


def _item_bags(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = _table(spark, sf_dir, "lineitem")
    columns = ["l_suppkey", "l_quantity", "l_linestatus"]
    return tuple(items.where(F.col("l_returnflag") == flag).select(columns) for flag in ("A", "R"))


@_query(
    "q32_row_changes",
    _ITEM_BAGS
    + """select l_suppkey, l_quantity, l_linestatus, sum(up)::bigint as added, sum(1 - up)::bigint as removed
      from (select *, 1 as up from (select * from new except all select * from old)
            union all select *, 0 from (select * from old except all select * from new))
      group by all""",
)
def q32_row_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted against returned items as bags of rows."""
    return row_changes(*_item_bags(spark, sf_dir))


@_query(
    "q32_key_changes",
    _ITEM_BAGS
    + """, more as (select * from new except all select * from old),
      less as (select * from old except all select * from new)
      select l_suppkey, l_quantity,
             case when (l_suppkey, l_quantity) not in (select l_suppkey, l_quantity from old) then 'added'
                  when (l_suppkey, l_quantity) not in (select l_suppkey, l_quantity from new) then 'removed'
                  else 'changed' end as change
      from (select l_suppkey, l_quantity from more union select l_suppkey, l_quantity from less)""",
)
def q32_key_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and quantities whose accepted and returned items differ."""
    return key_changes(*_item_bags(spark, sf_dir), ["l_suppkey", "l_quantity"])


# ---- rows with and without partners ----------------------------------------------------

_SOME_CUSTOMER = "case when o_custkey % 10 <> 0 then o_custkey end"


def _loose_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, a tenth of them of no known customer."""
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.expr(_SOME_CUSTOMER).alias("custkey")
    )


def _rich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").where("c_acctbal > 5000")


@_query(
    "q33_exists",
    f"""select o_orderkey, o_totalprice, {_SOME_CUSTOMER} as custkey from orders
        where {_SOME_CUSTOMER} in (select c_custkey from customer where c_acctbal > 5000)""",
)
def q33_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of rich customers."""
    return exists_in(_loose_orders(spark, sf_dir), _rich(spark, sf_dir), [("custkey", "c_custkey")])


@_query(
    "q33_not_exists",
    f"""select o_orderkey, o_totalprice, {_SOME_CUSTOMER} as custkey from orders
        where not exists (select 1 from customer
                          where c_custkey = {_SOME_CUSTOMER} and c_acctbal > 5000)""",
)
def q33_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of no rich customer, those of no customer included."""
    rich = _rich(spark, sf_dir)
    return not_exists_in(_loose_orders(spark, sf_dir), rich, [("custkey", "c_custkey")])


@_query(
    "q33_not_in",
    f"""select o_orderkey, o_totalprice, {_SOME_CUSTOMER} as custkey from orders
        where {_SOME_CUSTOMER} not in (select c_custkey from customer where c_acctbal > 5000)""",
)
def q33_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers known not to be rich."""
    return not_in(_loose_orders(spark, sf_dir), _rich(spark, sf_dir), "custkey", "c_custkey")


@_query(
    "q33_full_join",
    f"""select o.o_orderkey, o.o_totalprice, o.custkey, c.c_custkey, c.c_name
        from (select o_orderkey, o_totalprice, {_SOME_CUSTOMER} as custkey from orders) as o
        full join (select c_custkey, c_name from customer where c_acctbal > 5000) as c
          on o.custkey = c.c_custkey""",
)
def q33_full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and rich customers, each with or without the other."""
    rich = _rich(spark, sf_dir).select("c_custkey", "c_name")
    return outer_join(_loose_orders(spark, sf_dir), rich, [("custkey", "c_custkey")], "full")


# ---- semi-structured columns, sketches -------------------------------------------------

_LOOSE_PROPS = """case event_id % 11 when 0 then substr(props, 1, 5) when 1 then '{"k": "some"}'
    when 2 then '{"k": null}' when 3 then null when 4 then '{}' else props end"""


@_query(
    "q34_json",
    f"""with e as (select event_id, event_type, {_LOOSE_PROPS} as props from events),
          r as (select *, case when json_valid(props) then props::json ->> '$.k' end as k from e)
        select event_id, event_type, try_cast(k as bigint) as k,
               case when props is not null and not json_valid(props) then 'not json'
                    when k is not null and try_cast(k as bigint) is null then 'k'
                    else '' end as problems
        from r""",
)
def q34_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed field of each event's properties, and what is wrong with them."""
    events = _table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.expr(_LOOSE_PROPS).alias("props")
    )
    typed = json_columns(events, "props", {"k": ("$.k", "bigint")})
    return typed.drop("props").withColumn("problems", F.array_join("problems", ","))


@_query(
    "q35_distinct_estimates",
    """select l_returnflag, year(l_shipdate)::int as ship_year, count(l_orderkey) as n,
              true as close
       from lineitem group by all""",
)
def q35_distinct_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a year from sketches stored by month, held against the exact count."""
    items = _table(spark, sf_dir, "lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    keys, path = ["l_returnflag", "ship_year"], fresh_path(spark, "sketches")
    distinct_sketches(items, ["l_returnflag", "month"], "l_orderkey").write.parquet(path)
    stored = spark.read.parquet(path).withColumn("ship_year", F.year("month"))
    found = merged_distinct_estimate(stored, keys, "estimate")
    items = items.withColumn("ship_year", F.year("l_shipdate"))
    exact = items.groupBy(*keys).agg(F.count_distinct("l_orderkey").alias("exact"))
    # Five standard errors, so that no group of many falls out by chance.
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * error_bound(deviations=5)
    return found.join(exact, keys).select(*keys, "n", near.alias("close"))


@_query(
    "q35_quantiles",
    """select l_returnflag, count(l_extendedprice) as n, true as median_close, true as tail_close
       from lineitem group by all""",
)
def q35_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and 95th percentile of prices from sketches stored by month, with true ranks."""
    items = _table(spark, sf_dir, "lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    path, shares = fresh_path(spark, "sketches"), {"median": 0.5, "tail": 0.95}
    quantile_sketches(items, ["l_returnflag", "month"], "l_extendedprice").write.parquet(path)
    found = merged_quantiles(spark.read.parquet(path), ["l_returnflag"], shares)
    prices = items.select("l_returnflag", "l_extendedprice")
    upto = {
        name: F.avg((F.col("l_extendedprice") <= F.col(name)).cast("int")) for name in shares
    }
    ranks = prices.join(F.broadcast(found), "l_returnflag").groupBy("l_returnflag", "n")
    near = {f"{name}_close": F.abs(upto[name] - share) <= 0.02 for name, share in shares.items()}
    return ranks.agg(*[value.alias(name) for name, value in near.items()])


# ---- training-data operators ---------------------------------------------------------
# They and the pipeline live in a subpackage that may be absent.

try:
    from factlab.llm.queries import ORACLES, QUERIES
except ImportError:
    QUERIES, ORACLES = {}, {}
_QUERIES.update(QUERIES)
_ORACLES.update(ORACLES)
try:
    import corpus_pipeline
except ImportError:
    pass
else:
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


# ---- contract --------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: grouped statistics of lineitem by part at sf0.001."""
    return q02_grouped_stats(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator: (spark, sf_dir) to DataFrame."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """The same results as DuckDB SQL."""
    return dict(_ORACLES)
