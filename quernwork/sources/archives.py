"""Readers and writers of the corpus's files."""

from __future__ import annotations

import tarfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions import text as T

CATALOG = "ebook_id int, title string, author string, author_death int, year_reason string, language string, url string"
MESSAGES = "array<struct<role:string,content:string>>"


def decode_bytes(data: Column) -> Column:
    """UTF-8, or Latin-1 where the whole is no UTF-8."""
    return F.when(F.is_valid_utf8(data.cast("string")), F.decode(data, "UTF-8")).otherwise(F.decode(data, "ISO-8859-1"))


#: Bytes of members that are handed on at once.
BATCH_BYTES = 8 << 20


def read_tar(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(archive, member, body) of the members that end with ``suffix``; one task an archive, which is opened where it
    lies and read as a stream, so that no more than a batch of members is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held: list[tuple[str, bytes]] = []
                system, at = pafs.FileSystem.from_uri(_uri(name))
                with system.open_input_stream(at, compression=None) as data, tarfile.open(fileobj=data, mode="r|*") as tar:
                    for member in tar:
                        if member.isfile() and member.name.endswith(suffix):
                            held.append((member.name, tar.extractfile(member).read()))
                            if sum(len(b) for _, b in held) >= BATCH_BYTES:
                                yield _members(name, held)
                                held = []
                if held:
                    yield _members(name, held)

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInArrow(run, "archive string, member string, body binary")


def _uri(path: str) -> str:
    """``file:/x`` as ``file:///x``."""
    return f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path


def _members(archive: str, held: list[tuple[str, bytes]]) -> pa.RecordBatch:
    names, bodies = zip(*held)
    return pa.RecordBatch.from_pydict({"archive": [archive] * len(held), "member": list(names), "body": list(bodies)})


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of text files with an article a line, blank lines left out."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line")).filter(
        T.strip(F.col("line")) != ""
    )


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of the .txt files of a folder."""
    rows = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    return rows.select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    r"""The manifest of a CSV file; ``\N`` and a bare empty field are null, a quoted empty one is an empty text."""
    return spark.read.csv(path, schema=CATALOG, header=True, escape='"', multiLine=True, nullValue=r"\N", emptyValue="")


def write_catalog(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(
        path, header=True, escape='"', nullValue=r"\N", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(name, url, size) of a JSON index of batches."""
    schema = "ocr array<struct<name:string,url:string,size:bigint>>"
    return spark.read.json(path, schema=schema, multiLine=True).select(F.explode("ocr").alias("o")).select("o.*")


def read_conversations(spark: SparkSession, path: str) -> DataFrame:
    """(messages) of files with a JSON array a line; blank lines are left out, lines that are no such array give null."""
    lines = spark.read.text(path).filter(T.strip(F.col("value")) != "")
    return lines.select(F.from_json("value", MESSAGES).alias("messages"))


def append_conversations(df: DataFrame, path: str) -> None:
    """Adds (messages) as JSON lines."""
    df.select(F.to_json("messages").alias("value")).write.mode("append").text(path)


def write_shards(df: DataFrame, path: str, rows_per_group: int = 1024) -> None:
    """Parquet shards of one text column, a folder a shard: zstd, row groups of ``rows_per_group``, no dictionary, no
    statistics. ``df`` is (shard, place, text)."""
    (
        df.repartition("shard").sortWithinPartitions("shard", "place").select("shard", "text")
        .write.mode("overwrite").partitionBy("shard").option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", "3")
        .option("parquet.block.row.count.limit", str(rows_per_group))
        .option("parquet.enable.dictionary", "false").option("parquet.column.statistics.enabled", "false").parquet(path)
    )


def list_parquet(spark: SparkSession, path: str) -> DataFrame:
    """(path, size) of the Parquet files below a folder, for reading in the order of their names; only names and sizes
    are read. A folder that is not there is an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", F.col("length").alias("size"))


def fenced_json(text: Column) -> Column:
    """What stands in the first JSON fence, else in the first fence, else the whole."""
    named, plain = F.split(text, "```json", 2), F.split(text, "```", 3)
    inner = F.when(F.size(named) == 2, F.split(named[1], "```", 2)[0]).when(F.size(plain) >= 2, plain[1]).otherwise(text)
    return T.strip(inner)


def write_new(df: DataFrame, path: str, key: str) -> int:
    """Adds the rows of ``df`` whose ``key`` does not stand in ``path`` yet, one of each key; gives how many. Rows
    without a key are left out."""
    spark, fresh = df.sparkSession, df.filter(F.col(key).isNotNull()).dropDuplicates([key])
    try:
        there = spark.read.parquet(path).select(key)
    except AnalysisException:  # nothing was written yet
        there = None
    if there is not None:
        fresh = fresh.join(there, key, "left_anti")
    seen = Observation()
    fresh.observe(seen, F.count("*").alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def results_lines(results: DataFrame) -> DataFrame:
    """(place, line) of a results file of (task, accuracy, centered): padded columns, and the mean of the centred
    accuracies last. Tasks are in the order of their names; the table holds a row a task."""
    number = lambda c: F.rpad(F.format_string("%.6f", c), 10, " ")
    line = lambda a, b, c: F.concat(F.rpad(a, 35, " "), F.lit(", "), b, F.lit(", "), c)
    head = results.sparkSession.range(1).select(F.lit(0).alias("place"), line(F.lit("Task"), F.rpad(F.lit("Accuracy"), 10, " "), F.rpad(F.lit("Centered"), 10, " ")).alias("line"))
    order = W.Window.orderBy("task")  # one row a task
    rows = results.select(F.row_number().over(order).alias("place"), line(F.col("task"), number(F.col("accuracy")), number(F.col("centered"))).alias("line"))
    last = results.agg(F.count("*").alias("n"), F.avg("centered").alias("core")).select(
        (F.col("n") + 1).cast("int").alias("place"), line(F.lit("CORE"), F.rpad(F.lit(""), 10, " "), number(F.col("core"))).alias("line")
    )
    return head.unionByName(rows).unionByName(last)


def write_lines(lines: DataFrame, path: str) -> None:
    """(place, line) as one text file in order; for reports, which are small."""
    lines.repartition(1).sortWithinPartitions("place").select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def read_baselines(spark: SparkSession, path: str) -> DataFrame:
    """(task, baseline) of a CSV table of random baselines in percent."""
    return spark.read.csv(path, schema="task string, baseline double", header=True)


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """(task, kind, shots, uri) of a JSON array of tasks."""
    return spark.read.json(path, schema="task string, kind string, shots int, uri string", multiLine=True)


def save_vocabulary(vocabulary: DataFrame, path: str, pattern: str) -> None:
    """(token_id, token, n) as Parquet beside a JSON description; nothing is pickled."""
    vocabulary.write.mode("overwrite").parquet(f"{path}/tokens")
    note = vocabulary.agg(F.lit(pattern).alias("pattern"), F.count("*").alias("size"))
    note.coalesce(1).write.mode("overwrite").json(f"{path}/about")


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """The vocabulary, refused where it has not as many tokens as its description says."""
    size = spark.read.schema("pattern string, size bigint").json(f"{path}/about").first().size
    vocabulary = spark.read.parquet(f"{path}/tokens")
    if vocabulary.count() != size:
        raise ValueError(f"not {size} tokens in {path}")
    return vocabulary
