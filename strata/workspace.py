"""Shared scratch location for lineage cuts and file round trips.

The folder comes from ``spark.checkpoint.dir`` (a shared file system). Only where that is unset, as
in tests, a folder below the warehouse is used, which all machines of a session share as well;
a machine-local temporary folder never is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, or one below its warehouse if none is set."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (conf_dir or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_strata").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder (never reused between runs)."""
    return f"{shared_dir(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
