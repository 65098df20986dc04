"""Incremental ingestion and windowed counts over files as a stream."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder; on one machine, where none is named, a temporary one that goes
    when Python ends."""
    context = spark.sparkContext
    if base := context.getConf().get("spark.checkpoint.dir"):
        return f"{base}/{uuid.uuid4()}"
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    folder = tempfile.mkdtemp(prefix="quern-work-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def file_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table as a stream of its files, whether it is one file or a folder of files."""
    path = f"{sf_dir}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if os.path.isfile(path.removeprefix("file://")):
        return reader.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def ingest(stream: DataFrame, out: str, state: str, clean: Callable[[DataFrame], DataFrame]) -> int:
    """Appends what is new in the stream, cleaned, to ``out``, ends, and gives how many rows were new. Files seen before
    (``state``) are not read again, and a batch that is run twice after a failure overwrites its own folder only."""

    def write(batch: DataFrame, number: int) -> None:
        clean(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sum(p.numInputRows for p in query.recentProgress)


def rounds(take: Callable[[], int], least_new: int, most: int) -> list[int]:
    """Takes in what is new, round by round, until a round brings fewer than ``least_new`` rows or ``most`` are there."""
    out = [take()]
    while out[-1] >= least_new and sum(out) < most:
        out.append(take())
    return out


def daily_counts(stream: DataFrame, out: str, state: str, late: str = "2 days") -> None:
    """Counts and sums by day and kind, with rows up to ``late`` behind the newest; later ones are not counted and days
    that far back leave the state. Each batch adds the days that it changed; ``newest_counts`` reads their last state."""
    counted = (
        stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
        .groupBy(F.window("at", "1 day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    )

    def write(batch: DataFrame, number: int) -> None:
        day = F.date_format("window.start", "yyyy-MM-dd").alias("day")
        batch.select(day, "event_type", "n", "total").write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        counted.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def newest_counts(spark: SparkSession, out: str) -> DataFrame:
    """(day, event_type, n, total) as the last batch that changed them left them."""
    rows = spark.read.schema("day string, event_type string, n bigint, total double, batch int").parquet(out)
    last = F.max_by(F.struct("n", "total"), "batch").alias("s")
    return rows.groupBy("day", "event_type").agg(last).select("day", "event_type", "s.n", "s.total")
