"""Session and storage layout. No credentials are kept in files: S3A reads them from its own
credential providers (environment, instance profile or a Hadoop credential store)."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONFIG = Path(__file__).resolve().parent.parent / "config" / "lake.json"

# What the library relies on; set on any session that it is handed.
RUNTIME_SETTINGS = {
    # timestamps are naive; dates and hours must not move with the machine's zone
    "spark.sql.session.timeZone": "UTC",
    # pandas writes nanosecond timestamps, which Spark reads as whole numbers only
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}
SESSION_SETTINGS = {
    # no Python stack trace per column expression: plans are built several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


@dataclass(frozen=True)
class LakeLayout:
    """Where the layers are. ``root`` is any Hadoop URI: file:, hdfs: or s3a:."""

    root: str
    layers: dict[str, str] = field(
        default_factory=lambda: {"bronze": "bronze", "silver": "silver", "gold": "gold"}
    )
    endpoint: str | None = None
    secure: bool = True
    local_source: str | None = None
    # format of silver and gold: parquet, or delta where its package is on the classpath
    table_format: str = "parquet"

    def path(self, layer: str, table: str | None = None) -> str:
        folder = f"{self.root.rstrip('/')}/{self.layers[layer]}"
        return folder if table is None else f"{folder}/{table}"

    def bronze(self, table: str) -> str:
        return self.path("bronze", f"{table}.parquet")

    def silver(self, table: str) -> str:
        return self.path("silver", table)

    def gold(self, table: str) -> str:
        return self.path("gold", table)


def load_layout(path: str | Path = DEFAULT_CONFIG) -> LakeLayout:
    config = json.loads(Path(path).read_text(encoding="utf-8"))
    storage = config["storage"]
    return LakeLayout(
        root=storage["root"],
        layers=config["layers"],
        endpoint=storage.get("endpoint"),
        secure=storage.get("secure", True),
        local_source=config.get("local_source"),
        table_format=storage.get("table_format", "parquet"),
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Give an existing session the settings the library relies on."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def get_session(app_name: str = "rosterlake", layout: LakeLayout | None = None) -> SparkSession:
    """A session with adaptive execution and, if the layout asks for it, S3A and Delta.

    Master, memory and shuffle partitions are left to the cluster's own configuration.
    """
    builder = SparkSession.builder.appName(app_name).config(
        map={**SESSION_SETTINGS, **RUNTIME_SETTINGS}
    )
    if layout is not None and layout.root.startswith("s3a:"):
        builder = builder.config("spark.hadoop.fs.s3a.path.style.access", "true")
        if layout.endpoint:
            scheme = "https" if layout.secure else "http"
            builder = builder.config(
                "spark.hadoop.fs.s3a.endpoint", f"{scheme}://{layout.endpoint}"
            )
    if layout is not None and layout.table_format == "delta":
        builder = builder.config(
            map={
                "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
                "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
            }
        )
    return prepare(builder.getOrCreate())
