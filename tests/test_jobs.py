"""The jobs on a small table, through files."""

from __future__ import annotations

import __spark_entry__ as spark_entry
from factlab.jobs import benchmark, ingest, reports
from factlab.sources import write_csv_raw

SF_DIR = "/root/testdata/sf0.001"


def test_ingest_then_benchmark(spark, tmp_path):
    csv, parquet = spark_entry.review_formats(spark, SF_DIR)
    raw, typed = str(tmp_path / "raw"), str(tmp_path / "typed")
    write_csv_raw(csv.drop("review_year", "review_month"), raw)
    ingest.main([raw, typed, "--partition-by", "review_year", "review_month"])
    assert spark.read.parquet(typed).count() == parquet.count()
    widths = benchmark.main(["widths", typed, "--repeats", "1"])
    assert sum(row["best"] for row in widths) >= 3
    profiles = benchmark.main(["profiles", typed, "--repeats", "1"])
    assert {row["workload"] for row in profiles} == {"count", "aggregation"}


def test_reports(spark, tmp_path, capsys):
    _, parquet = spark_entry.review_formats(spark, SF_DIR)
    path = str(tmp_path / "reviews")
    parquet.drop("review_year", "review_month").write.parquet(path)
    plans = reports.main([path, "--explain"])
    assert [row["report"] for row in plans] == [f"q{i}" for i in range(1, 11)]
    assert capsys.readouterr().out.count("Physical Plan") == 10
    texts = reports.main([path, "--sql", "--report", "q1", "q2", "q8"])
    assert [row["rows"] for row in texts] == [plans[i]["rows"] for i in (0, 1, 7)]
    written = reports.main([path, "--report", "q2", "--target", str(tmp_path / "out")])
    assert written[0]["rows"] == plans[1]["rows"] == spark.read.parquet(str(tmp_path / "out" / "q2")).count()
