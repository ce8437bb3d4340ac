"""Clean bronze tables into silver: spark-submit rosterlake/jobs/silver.py [TABLE [--keys KEY ...]]"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from rosterlake.session import DEFAULT_CONFIG, get_session, load_layout
from rosterlake.sources.lake import SILVER_JOBS, run_silver_job, run_silver_jobs


def main(arguments: Sequence[str] | None = None) -> dict[str, str]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("table", nargs="?", help="one table; all declared ones if none is given")
    parser.add_argument("--keys", nargs="+", help="key columns of a table that is not declared")
    parser.add_argument("--config", default=str(DEFAULT_CONFIG))
    given = parser.parse_args(arguments)
    layout = load_layout(given.config)
    if given.table and not given.keys and given.table not in SILVER_JOBS:
        parser.error(f"{given.table} is not declared: name its keys")
    spark = get_session("silver", layout)
    if given.table is None:
        return run_silver_jobs(spark, layout)
    return {given.table: run_silver_job(spark, layout, given.table, given.keys)}


if __name__ == "__main__":
    for name, path in main().items():
        print(name, path)
