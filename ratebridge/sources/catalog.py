"""Named relations: namespaces per environment, sources, views, tables, descriptions."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

ENVIRONMENTS = ("dev", "ci", "prod")


@dataclass(frozen=True)
class Namespace:
    """Database names for one environment; CI runs get their own isolated database."""

    env: str = "dev"
    run_id: str = "local"
    base: str = "rates"

    def database(self, layer: str) -> str:
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {self.env}")
        suffix = f"ci_{re.sub(r'[^0-9A-Za-z_]', '_', self.run_id)}" if self.env == "ci" else self.env
        return f"{self.base}_{suffix}_{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"`{self.database(layer)}`.`{name}`"

    def create(self, spark: SparkSession, layers=("raw", "staging", "intermediate", "marts")) -> None:
        for layer in layers:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database(layer)}`")


def source(spark: SparkSession, ns: Namespace, name: str) -> DataFrame:
    """A raw source table by name."""
    return spark.table(ns.table("raw", name))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a model lazily under ``name`` (session temp view); returns ``df``."""
    df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, ns: Namespace, layer: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Full rebuild of a table, then read it back, so downstream models start
    from the stored table (cut lineage) instead of recomputing it."""
    full = ns.table(layer, name)
    df.write.mode("overwrite").format(fmt).saveAsTable(full)
    return df.sparkSession.table(full)


def sql_text(text: str) -> str:
    """The text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def persist_docs(
    spark: SparkSession, table: str, description: str | None = None, columns: Mapping[str, str] | None = None
) -> None:
    """Store table and column descriptions in the catalog."""
    if description:
        spark.sql(f"COMMENT ON TABLE {table} IS {sql_text(description)}")
    for col, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{col}` COMMENT {sql_text(text)}")
