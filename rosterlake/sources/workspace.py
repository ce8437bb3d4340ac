"""A shared folder for tables that a job writes on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none uses a folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        # local[4] or local, one machine; not local-cluster, whose executors are processes
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="rosterlake-")
    return f"{root.rstrip('/')}/rosterlake-{uuid.uuid4().hex}"
