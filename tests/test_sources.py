from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factlab.benchmarks import sql_settings
from factlab.operators import Stat, period_summary
from factlab.plans.inspect import plan_text
from factlab.sources import (
    cast_columns,
    dim_table,
    fresh_path,
    ingest_csv,
    read_csv_raw,
    read_csv_typed,
    read_table,
    register,
    write_csv_raw,
    write_table,
)

MESSY = '''id,flag,count,note,seconds
1,TRUE,4294967295,"said ""hi"", then
left",1546300800
2,false,abc,"a,b",-1
3,maybe,7,,
x,yes,8,plain,99999999999999999999
'''
TYPES = {"id": "int", "flag": "boolean", "count": "bigint", "seconds": "bigint"}


@pytest.fixture
def messy(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "one.csv").write_text(MESSY)
    return str(tmp_path / "raw")


def test_raw_csv_is_text(spark, messy):
    raw = read_csv_raw(spark, messy)
    assert {kind for _, kind in raw.dtypes} == {"string"}
    assert rows(raw)[0] == ("1", "TRUE", "4294967295", 'said "hi", then\nleft', "1546300800")
    assert raw.count() == 4


def test_cast_gives_null_for_what_does_not_parse(spark, messy):
    table = cast_columns(read_csv_raw(spark, messy), TYPES)
    assert dict(table.dtypes) == {**TYPES, "note": "string"}
    assert rows(table) == [
        (None, True, 8, "plain", None),
        (1, True, 4294967295, 'said "hi", then\nleft', 1546300800),
        (2, False, None, "a,b", -1),
        (3, None, 7, None, None),
    ]
    small = cast_columns(read_csv_raw(spark, messy), {"count": "int"})
    assert [row[0] for row in small.orderBy("id").select("count").collect()] == [None, None, 7, 8]


def test_files_with_columns_in_another_order_are_refused(spark, messy):
    (Path(messy) / "two.csv").write_text("flag,id,count,note,seconds\ntrue,9,1,n,0\n")
    schema = "id int, flag boolean, count bigint, note string, seconds bigint"
    for table in (read_csv_raw(spark, messy), read_csv_typed(spark, messy, schema)):
        with pytest.raises(Exception, match="header does not conform to the schema"):
            table.collect()
        with pytest.raises(Exception, match="header does not conform to the schema"):
            table.select("flag").collect()


AWKWARD = [
    ' padded ', 'say "x"', "a,b\n\nc", "back\\slash", "tab\t", "é ", "", None, "cr\rx",
    "crlf\r\ny", "\n", '"', '\\"', "#c", "'", "NULL", "end\\", ",", '""', 'a"b,c\\"d',
    "end\r", "\r\n", "long\n" * 30,
]


@pytest.mark.parametrize("quote_all", [True, False])
@pytest.mark.parametrize("block", [7, 64, 1_000_000])
def test_blocks_give_the_records_of_whole_files(spark, tmp_path, quote_all, block):
    path = str(tmp_path / "raw")
    data = [(str(i), text, str(i + 1)) for i, text in enumerate(AWKWARD * 3)]
    df = spark.createDataFrame(data, "id string, text string, z string")
    df.repartition(2).write.options(
        header=True, quoteAll=quote_all, escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
    settings = {
        "spark.sql.files.maxPartitionBytes": str(block),
        "spark.sql.files.openCostInBytes": "0",
    }
    with sql_settings(spark, settings):
        blocks = read_csv_raw(spark, path, tasks="blocks")
        whole = read_csv_raw(spark, path)
        assert blocks.columns == whole.columns
        assert rows(blocks) == rows(whole)
        assert blocks.count() == len(data)


STRAY = {
    "one stray quote": {1500: '1500,2,5" disk'},
    "two stray quotes": {500: '500,2,5" disk', 1850: '1850,x,say "hi" now'},
    "text after a closing quote": {700: '700,x,"a"b'},
    "doubled quotes and newlines": {9: '9,"q ""x"", y","a\n""b""\n,c"', 10: '10,"","""\n"'},
    "stray quote next to a quoted newline": {3: '3,5" x,"a\nb"', 4: '4,x,"c"""'},
}


@pytest.mark.parametrize("case", STRAY)
@pytest.mark.parametrize("block", [7, 64, 1_000_000])
def test_blocks_lose_nothing_to_stray_quotes(spark, tmp_path, case, block):
    n = {7: 40, 64: 200, 1_000_000: 3000}[block]
    odd = {min(k, n - 9 + k % 7): line for k, line in STRAY[case].items()}
    lines = [odd.get(i, f"{i},plain,text {i}") for i in range(n)]
    (tmp_path / "raw.csv").write_text("\n".join(["id,kind,note", *lines, ""]))
    path = str(tmp_path / "raw.csv")
    with sql_settings(spark, {"spark.sql.files.maxPartitionBytes": str(block)}):
        whole = rows(read_csv_raw(spark, path))
        assert rows(read_csv_raw(spark, path, tasks="blocks")) == whole


@pytest.mark.parametrize("block", [7, 1_000_000])
def test_blocks_refuse_a_field_that_is_never_closed(spark, tmp_path, block):
    (tmp_path / "raw.csv").write_text('id,note\n1,a\n2,"open\n3,b\n')
    with sql_settings(spark, {"spark.sql.files.maxPartitionBytes": str(block)}):
        with pytest.raises(Exception, match="never closed"):
            read_csv_raw(spark, str(tmp_path / "raw.csv"), tasks="blocks").collect()


def test_blocks_of_a_file_with_crlf_and_no_last_newline(spark, tmp_path):
    text = 'id,note\r\n1,"a\r\nb"\r\n\r\n2,plain\r\n"3","x""y"'
    (tmp_path / "raw.csv").write_bytes(text.encode())
    with sql_settings(spark, {"spark.sql.files.maxPartitionBytes": "9"}):
        table = read_csv_raw(spark, str(tmp_path / "raw.csv"), tasks="blocks")
        assert rows(table) == [("1", "a\r\nb"), ("2", "plain"), ("3", 'x"y')]


def test_blocks_refuse_another_header(spark, messy):
    (Path(messy) / "two.csv").write_text("flag,id,count,note,seconds\ntrue,9,1,n,0\n")
    with pytest.raises(Exception, match="unexpected CSV header"):
        read_csv_raw(spark, messy, tasks="blocks").collect()


def test_unknown_tasks_are_refused(spark, messy):
    with pytest.raises(ValueError):
        read_csv_raw(spark, messy, tasks="rows")


def test_without_multi_line_files_are_split(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_csv_raw(spark.range(20_000).coalesce(1).selectExpr("id", "id * 2 as v"), path)
    with sql_settings(spark, {"spark.sql.files.maxPartitionBytes": "65536"}):
        whole = read_csv_raw(spark, path)
        split = read_csv_raw(spark, path, tasks="lines")
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert rows(whole) == rows(split)


def test_written_csv_comes_back_whole(spark, tmp_path):
    texts = [' padded ', 'say "x"', "a,b\n\nc", "back\\slash", "tab\t", "é ", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    path = str(tmp_path / "raw")
    write_csv_raw(df.coalesce(1), path, records_per_file=3)
    assert len(list(Path(path).glob("*.csv"))) == 3
    back = cast_columns(read_csv_raw(spark, path), {"id": "int"})
    # CSV does not tell an empty text from a missing one.
    expected = [text or None for text in texts]
    assert [row["text"] for row in back.orderBy("id").collect()] == expected


@pytest.mark.parametrize("tasks", ["files", "blocks"])
def test_compressed_csv_comes_back_whole(spark, tmp_path, tasks):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(AWKWARD)], "id string, text string")
    write_csv_raw(df.coalesce(1), path, records_per_file=8, compression="gzip")
    assert len(list(Path(path).glob("*.csv.gz"))) == 3 and not list(Path(path).glob("*.csv"))
    plain = str(tmp_path / "plain")
    write_csv_raw(df, plain)
    assert rows(read_csv_raw(spark, path, tasks=tasks)) == rows(read_csv_raw(spark, plain))
    typed = read_csv_typed(spark, path, "id int, text string")
    assert [row["id"] for row in typed.orderBy("id").collect()] == list(range(len(AWKWARD)))


def test_compressed_csv_in_another_order_is_refused(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([("1", "x")], "id string, text string")
    write_csv_raw(df, path, compression="gzip")
    with pytest.raises(Exception, match="header does not conform to the schema"):
        read_csv_typed(spark, path, "text string, id string").collect()


def test_ingest_partitioned_and_pruned(spark, messy, tmp_path):
    target = str(tmp_path / "typed")
    ingest_csv(spark, messy, target, TYPES, epoch="seconds", partition_by=["review_year"])
    names = sorted(path.name for path in Path(target).glob("review_year=*"))
    assert names == [
        "review_year=1969", "review_year=2019", "review_year=__HIVE_DEFAULT_PARTITION__"
    ]
    table = read_table(spark, target)
    assert table.count() == 4
    summary = period_summary(table, ["review_year", "review_month"], [], [2019])
    assert rows(summary) == [(2019, 1, 1)]
    assert "PartitionFilters: [isnotnull(review_year" in plan_text(summary)
    summary.collect()
    scanned = table.filter(F.col("review_year").isin(2019)).select(F.input_file_name())
    assert {"review_year=2019" in row[0] for row in scanned.collect()} == {True}


def test_ingest_without_epoch(spark, messy, tmp_path):
    ingest_csv(spark, messy, str(tmp_path / "typed"), TYPES)
    assert dict(read_table(spark, str(tmp_path / "typed")).dtypes) == {**TYPES, "note": "string"}


def test_partitioned_write_makes_few_files_and_splits_a_hot_directory(spark, tmp_path):
    # 16 tasks hold rows of all 12 months; month 1 has most of them.
    df = spark.range(0, 60_000, 1, 16).selectExpr(
        "case when id % 3 > 0 then 1 else id % 12 + 1 end as month", "id", "uuid() as text"
    )
    few, split = str(tmp_path / "few"), str(tmp_path / "split")
    write_table(df, few, partition_by=["month"])
    assert len(list(Path(few).glob("month=*/*.parquet"))) <= 16
    with sql_settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB"}):
        write_table(df, split, partition_by=["month"])
    files = {p.name: len(list(p.glob("*.parquet"))) for p in Path(split).glob("month=*")}
    assert files["month=1"] > 3
    assert read_table(spark, split).count() == 60_000


def test_declared_schema_reads_only_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3).selectExpr("id", "id as other"), path)
    write_table(spark.range(4).selectExpr("id", "id as other"), path)
    assert read_table(spark, path).columns == ["id", "other"]
    assert rows(read_table(spark, path, "id bigint")) == [(0,), (1,), (2,), (3,)]


def test_view_is_a_name_for_a_plan(spark):
    register(dim_table(spark, [(1, "a"), (2, "b")], "id int, name string"), "letters")
    assert rows(spark.sql("select name from letters where id = 2")) == [("b",)]


def test_fresh_path_is_in_the_shared_folder(spark):
    first, second = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_fresh_path_needs_the_setting_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        fresh_path(Session(), "x")
    Session.sparkContext.master = "local[2]"
    assert "factlab-x-" in fresh_path(Session(), "x")
