from __future__ import annotations

from pathlib import Path

import pytest


@pytest.fixture(scope="session", autouse=True)
def _package_for_workers(spark):
    """Python workers find the package wherever the tests were started."""
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])
