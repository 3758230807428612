"""Catalog sources: tables by name or path, layer databases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.operators.schema import select_columns


def scan_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, optionally projected (names resolve case-insensitively)."""
    df = spark.read.table(name)
    return select_columns(df, columns) if columns else df


def scan_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table stored at a path in the given format."""
    return spark.read.format(fmt).load(path)


def layer_names(project: str, layers: Sequence[str] = ("bronze", "silver", "gold")) -> list[str]:
    """Database names for a project's layers (``<project>_<layer>``); open-source Spark has no
    ``CREATE CATALOG``, so a catalog level becomes a name prefix."""
    return [f"{project}_{layer}" if project else layer for layer in layers]


def ensure_layers(spark: SparkSession, databases: Sequence[str]) -> list[str]:
    """``CREATE DATABASE IF NOT EXISTS`` for each name."""
    for db in databases:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    return list(databases)


def table_exists(spark: SparkSession, name: str) -> bool:
    """True for a table (not a temporary view) of that name."""
    parts = name.replace("`", "").split(".")
    database = ".".join(parts[:-1]) or spark.catalog.currentDatabase()
    return spark.catalog.tableExists(f"{database}.`{parts[-1]}`")
