"""Times a stored review table: formats, shuffle widths or session profiles.

python -m factlab.jobs.benchmark formats CSV PARQUET
python -m factlab.jobs.benchmark widths PARQUET
python -m factlab.jobs.benchmark profiles PARQUET
"""

from __future__ import annotations

import argparse

from factlab import benchmarks, schemas
from factlab.plans import reviews
from factlab.session import make_session
from factlab.sources import read_csv_typed


def main(args: list[str] | None = None) -> list[dict]:
    """Prints one line for each result, and gives them back."""
    parser = argparse.ArgumentParser(description="Times a stored review table.")
    parser.add_argument("what", choices=["formats", "widths", "profiles"])
    parser.add_argument("paths", nargs="+")
    parser.add_argument("--repeats", type=int, default=3)
    chosen = parser.parse_args(args)
    spark = make_session("factlab-benchmark")
    table = reviews.load(spark, chosen.paths[-1])
    if chosen.what == "formats":
        csv = reviews.with_period(read_csv_typed(spark, chosen.paths[0], schemas.REVIEWS))
        found = benchmarks.compare_formats(csv, table, repeats=chosen.repeats)
        rows = found.collect() + benchmarks.mean_ratio(found).collect()
    elif chosen.what == "widths":
        rows = benchmarks.sweep_partitions(table, repeats=chosen.repeats).collect()
    else:
        rows = benchmarks.time_profiles(table, repeats=chosen.repeats).collect()
    results = [row.asDict() for row in rows]
    for result in results:
        print(result)
    return results


if __name__ == "__main__":
    main()
