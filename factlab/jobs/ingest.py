"""Raw review CSV to typed Parquet.

python -m factlab.jobs.ingest SOURCE TARGET [--partition-by review_year review_month]
"""

from __future__ import annotations

import argparse

from factlab.plans import reviews
from factlab.session import make_session


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Raw review CSV to typed Parquet.")
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--partition-by", nargs="*", default=[])
    chosen = parser.parse_args(args)
    spark = make_session("factlab-ingest")
    reviews.ingest(spark, chosen.source, chosen.target, partition_by=chosen.partition_by)


if __name__ == "__main__":
    main()
