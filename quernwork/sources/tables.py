"""Tables of a folder of Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Smaller tables stay in as few tasks as their files give, and larger ones are never moved.
LEAST_BYTES, MOST_BYTES = 1 << 20, 1 << 28


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``folder/name.parquet``. A small table of so few row groups that most cores would stand idle is dealt out to all
    of them; one of more than ``MOST_BYTES`` is read where it lies, however many cores there are."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 >= cores:
        return df
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(cores) if LEAST_BYTES <= int(str(size)) <= MOST_BYTES else df
