"""Build gold from silver: spark-submit rosterlake/jobs/gold.py FIRST_DAY LAST_DAY"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from rosterlake.plans.workforce import build_gold
from rosterlake.session import DEFAULT_CONFIG, get_session, load_layout


def main(arguments: Sequence[str] | None = None) -> list[str]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("first_day", type=date.fromisoformat, help="of the calendar, as 2024-01-01")
    parser.add_argument("last_day", type=date.fromisoformat)
    parser.add_argument("--config", default=str(DEFAULT_CONFIG))
    given = parser.parse_args(arguments)
    layout = load_layout(given.config)
    return build_gold(get_session("gold", layout), layout, given.first_day, given.last_day)


if __name__ == "__main__":
    print("built:", ", ".join(main()))
