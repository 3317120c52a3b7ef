"""Stored tables: reading by name and exporting a mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LAYERS = ["stage", "bronze", "silver", "gold"]
MART = "publishing_analysis"
MART_PARTS = ["dim_orientador", "dim_publish_calendar", "fact"]


def layer_schema(custom: str | None, default: str) -> str:
    """Schema a model is built in: its own name without outer blanks, else the default."""
    return default if custom is None else custom.strip()


def create_layers(spark: SparkSession) -> None:
    """The four layer schemas, where missing."""
    for layer in LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")


def table_path(warehouse: str, layer: str, name: str) -> str:
    return f"{warehouse}/{layer}/{name}"


def read_table(spark: SparkSession, warehouse: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(warehouse, layer, name))


def mart_tables(mart: str = MART, layer: str = "gold") -> list[str]:
    return [f"{layer}_datamart_{mart}_{part}" for part in MART_PARTS]


def export_mart(tables: dict[str, DataFrame], target: str, one_file: tuple[str, ...] = ()) -> dict[str, str]:
    """Each table as ``<target>/<name>.parquet``, written by the executors with its own types.

    Those named in ``one_file``, small by construction, are written as one file.
    """
    written = {}
    for name, df in tables.items():
        out = df.coalesce(1) if name in one_file else df
        written[name] = f"{target}/{name}.parquet"
        out.write.mode("overwrite").parquet(written[name])
    return written
