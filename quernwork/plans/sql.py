"""Tables of a folder, for queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read_table(spark, sf_dir, table)
