"""Land tables in bronze: spark-submit rosterlake/jobs/land.py [--source FOLDER] [TABLE ...]"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from rosterlake.session import DEFAULT_CONFIG, get_session, load_layout
from rosterlake.sources.lake import land_bronze


def main(arguments: Sequence[str] | None = None) -> list[str]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("tables", nargs="*", help="names; all tables of the folder if none is given")
    parser.add_argument("--source", help="folder of *.parquet tables; else local_source of the config")
    parser.add_argument("--config", default=str(DEFAULT_CONFIG))
    given = parser.parse_args(arguments)
    layout = load_layout(given.config)
    source = given.source or layout.local_source
    if source is None:
        parser.error("neither --source nor local_source of the config names a folder")
    return land_bronze(get_session("land", layout), source, layout, given.tables or None)


if __name__ == "__main__":
    print("landed:", ", ".join(main()))
