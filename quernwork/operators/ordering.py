"""Places, running sums and splits in a seeded order, without sorting all rows in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Hex digits of the order key that cut the order into parts: 4096 parts, each sorted by itself.
PART_DIGITS = 3


def order_key(seed: int, *cols: str) -> Column:
    """md5 of the seed and the columns, joined by colons; the same text in any engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def placed(df: DataFrame, seed: int, cols: list[str], weight: Column | None = None) -> DataFrame:
    """``df`` with ``place`` (from 1), ``total`` rows and, with ``weight``, ``running`` (the sum up to and with the
    row) in the order of ``order_key``. What is sent to all executors is one row a part."""
    keyed = df.withColumn("_key", order_key(seed, *cols)).withColumn("_part", F.left("_key", F.lit(PART_DIGITS)))
    size = F.coalesce(weight if weight is not None else F.lit(0), F.lit(0))
    keyed = keyed.withColumn("_size", size.cast("bigint"))
    upto = W.Window.orderBy("_part").rowsBetween(W.Window.unboundedPreceding, -1)
    parts = keyed.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("_size").alias("_w"))
    parts = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_w").over(upto), F.lit(0)).alias("_w0"),
        F.sum("_n").over(W.Window.partitionBy()).alias("total"),
    )
    inside = W.Window.partitionBy("_part").orderBy("_key", *cols)
    out = keyed.withColumns(
        {
            "_i": F.row_number().over(inside),
            "_r": F.sum("_size").over(inside.rowsBetween(W.Window.unboundedPreceding, 0)),
        }
    ).join(F.broadcast(parts), "_part")
    return out.withColumns({"place": F.col("_n0") + F.col("_i"), "running": F.col("_w0") + F.col("_r")}).drop(
        "_key", "_part", "_size", "_n0", "_w0", "_i", "_r"
    )


def split_held_out(df: DataFrame, seed: int, cols: list[str], share: float = 0.01) -> DataFrame:
    """``df`` with ``place`` and ``split``: the first rows of the order, at least one, are ``val``."""
    held = F.greatest(F.lit(1), F.floor(F.col("total") * F.lit(share)))
    rows = placed(df, seed, cols)
    return rows.withColumn("split", F.when(F.col("place") <= held, "val").otherwise("train")).drop("total", "running")


def assign_shards(df: DataFrame, seed: int, cols: list[str], chars: Column, block: int, least_chars: int) -> DataFrame:
    """``df`` with ``place`` and ``shard``: a shard closes at the first block of rows that brings it to ``least_chars``.

    As shards begin at blocks, rows are summed by block and only the block sums, one row for ``block`` rows, are gone
    through in order: sorted (on disk where they are many) and streamed through one task, which holds a batch at a time.
    """
    rows = placed(df, seed, cols, chars).withColumn("block", F.floor((F.col("place") - 1) / block))
    sums = rows.groupBy("block").agg(F.sum(F.coalesce(chars, F.lit(0)).cast("bigint")).alias("chars"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = 0, 0
        for batch in batches:
            out = []
            for c in batch.column(1).to_pylist():
                out.append(shard)
                held += int(c or 0)
                if held >= least_chars:
                    shard, held = shard + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int32())], names=["block", "shard"])

    shards = sums.repartition(1).sortWithinPartitions("block").mapInArrow(fold, "block bigint, shard int")
    return rows.join(shards, "block").drop("total", "running")


def shards_with_held_out(
    df: DataFrame, seed: int, cols: list[str], chars: Column, block: int, least_chars: int, share: float = 0.01
) -> DataFrame:
    """``df`` with ``split``, ``place`` and ``shard``: the held-out rows make one shard, which is numbered last."""
    split = split_held_out(df, seed, cols, share).drop("place")
    train = assign_shards(split.filter("split = 'train'"), seed, cols, chars, block, least_chars).drop("block")
    held = placed(split.filter("split = 'val'"), seed, cols).drop("total", "running")
    after = train.agg(F.coalesce(F.max("shard") + 1, F.lit(0)).cast("int").alias("shard"))
    return train.unionByName(held.join(F.broadcast(after)))  # one row
