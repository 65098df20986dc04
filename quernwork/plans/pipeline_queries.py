"""Queries on whole steps of the pipeline: shards written and read, learned tokens, counters, estimates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..operators import ordering as O
from ..operators import tokens as K
from ..sources import archives as A
from ..streaming.ingest import work_folder
from .corpus_queries import _SQL_SHARDS, BLOCK, SEED, SHARD_CHARS
from .sql import read

#: Tokens of a vocabulary; fewer where no pair is left to join.
LEARNED = 32_768


def _write_shards(spark: SparkSession, d: str) -> DataFrame:
    """Shards as files, the held-out ones last, read again and counted."""
    docs = read(spark, d, "documents").select("doc_id", "text")
    rows = O.assign_shards(docs, SEED, ["doc_id"], F.length("text"), BLOCK, SHARD_CHARS)
    folder = f"{work_folder(spark)}/shards"
    A.write_shards(rows, folder)
    back = spark.read.schema("text string, shard int").parquet(folder)
    return back.groupBy("shard").agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars"))


def _list_shards(spark: SparkSession, d: str) -> DataFrame:
    """Files of shards as written, by the folder of each shard, in the order of their names."""
    folder = f"{work_folder(spark)}/listed"
    rows = O.assign_shards(read(spark, d, "documents").select("doc_id", "text"), SEED, ["doc_id"], F.length("text"), BLOCK, SHARD_CHARS)
    A.write_shards(rows, folder)
    shard = F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("int")
    return A.list_parquet(spark, folder).groupBy(shard.alias("shard")).agg(F.count("*").alias("n_files"), (F.min("size") > 0).alias("filled"))


def _vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return K.train_bpe(read(spark, d, "documents"), "text", LEARNED)


def _encode(spark: SparkSession, d: str) -> DataFrame:
    docs = K.encode(read(spark, d, "documents").select("doc_id", "text"), "text", _vocabulary(spark, d))
    return docs.select("doc_id", "ids")


def _round_trip(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = _vocabulary(spark, d)
    docs = read(spark, d, "documents").filter("text is not null").select("text")
    back = K.decode(K.encode(docs, "text", vocabulary), "ids", vocabulary)
    return back.agg(F.count("*").alias("n_docs"), F.count_if(F.col("decoded") == F.col("text")).alias("n_equal"))


def _tokenizer_report(spark: SparkSession, d: str) -> DataFrame:
    """Bytes a token, by source, of the learned vocabulary against one of bytes alone, and which is better."""
    docs = K.encode(read(spark, d, "documents").select("source", "text"), "text", _vocabulary(spark, d)).filter("length(text) > 0")
    n_bytes = F.octet_length("text")
    return K.compression(docs.select("source", n_bytes.alias("n_bytes"), F.size("ids").alias("n_tokens"), n_bytes.alias("n_base")), ["source"])


def _token_stats(spark: SparkSession, d: str) -> DataFrame:
    sizes = K.token_bytes(_vocabulary(spark, d)).filter("n_bytes > 0")
    return sizes.agg(F.count("*").alias("n"), F.min("n_bytes").alias("lo"), F.max("n_bytes").alias("hi"), F.avg("n_bytes").alias("mean"), F.stddev_samp("n_bytes").alias("sd"))


def _eta(spark: SparkSession, d: str) -> DataFrame:
    """Seconds left of each user's run of 5,000 steps: the mean time of a step, after the first ten, times what is left."""
    order = W.Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = read(spark, d, "events").select("user_id", "ts", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    steps = rows.withColumns({"step": F.row_number().over(order), "took": F.col("us") - F.lag("us").over(order)})
    mean = F.sum(F.when(F.col("step") > 10, F.col("took"))) / F.count_if(F.col("step") > 10)
    return steps.groupBy("user_id").agg(F.max("step").cast("bigint").alias("steps"), F.round(mean / 1e6 * (5000 - F.max("step")), 3).alias("eta"))


_SQL_ETA = """WITH s AS (SELECT user_id, row_number() OVER w AS step, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS took FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, max(step) AS steps, round(sum(took) FILTER (step > 10)::DOUBLE / nullif(count(*) FILTER (step > 10), 0) / 1e6 * (5000 - max(step)), 3) AS eta FROM s GROUP BY user_id"""


def _baselines(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy of each task with its baseline, from a CSV table; a task without one is an error."""
    path = f"{work_folder(spark)}/baselines"
    task = F.coalesce("source", F.lit("none")).alias("task")
    shards = read(spark, d, "shards")
    shards.select(task).distinct().withColumn("baseline", F.length("task") * 1.5).write.csv(path, header=True)
    tasks = shards.groupBy(task).agg(F.avg((F.col("rec_id") % 3 == 0).cast("double")).alias("accuracy"))
    joined = tasks.join(A.read_baselines(spark, path), "task", "left")
    known = F.when(F.col("baseline").isNull(), F.raise_error(F.concat(F.lit("no baseline of "), F.col("task"))).cast("double"))
    return joined.select("task", "accuracy", known.otherwise(F.col("baseline")).alias("baseline"))


def _results(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the results file, written and read again."""
    path, part = f"{work_folder(spark)}/results", F.col("baseline") / 100
    centered = _baselines(spark, d).select("task", "accuracy", ((F.col("accuracy") - part) / (1 - part)).alias("centered"))
    A.write_lines(A.results_lines(centered), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _configs(spark: SparkSession, d: str) -> DataFrame:
    """Tasks of a JSON list, each with the rows that its file name leads to."""
    path = f"{work_folder(spark)}/tasks"
    uri = F.concat("split", F.lit(".jsonl"))
    one = F.struct(F.concat("split", F.lit("_task")).alias("task"), F.lit("choices").alias("kind"), F.length("split").alias("shots"), uri.alias("uri"))
    splits = read(spark, d, "shards").filter("split is not null").select("split").distinct()
    splits.agg(F.to_json(F.collect_list(one)).alias("value")).coalesce(1).write.text(path)  # one row a task
    rows = read(spark, d, "shards").groupBy(uri.alias("uri")).agg(F.count("*").alias("n"))
    return A.read_tasks(spark, path).join(rows, "uri").select("task", "kind", "shots", "n")


def _write_twice(spark: SparkSession, d: str) -> DataFrame:
    """Items of earlier years written first, then all, twice: those that stand there are passed over."""
    path = f"{work_folder(spark)}/items"
    items = read(spark, d, "internetarchive").select("identifier", "pub_year")
    new = [A.write_new(rows, path, "identifier") for rows in (items.filter("pub_year < '1850'"), items, items)]
    told = [F.lit(n).cast("bigint").alias(k) for k, n in zip(("first", "second", "third"), new)]
    return spark.read.parquet(path).agg(F.count("*").alias("n"), F.count_distinct("identifier").alias("n_ids"), *told)


def _word_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """A vocabulary of the specials and the lexicon's words, by length and name."""
    words = read(spark, d, "lexicon").select(F.lower("word").alias("w")).distinct()
    place = F.row_number().over(W.Window.orderBy(F.length("w"), "w")) + len(K.SPECIALS) - 1  # a small fixed table
    specials = K.special_tokens(spark, first=0).select("token_id", F.col("name").cast("binary").alias("token"))
    return specials.unionByName(words.select(place.alias("token_id"), F.col("w").cast("binary").alias("token")))


def _token_sizes(spark: SparkSession, d: str) -> DataFrame:
    sizes = K.token_bytes(_word_vocabulary(spark, d)).filter("n_bytes > 0")
    mean, sd = F.round(F.avg("n_bytes"), 9), F.round(F.stddev_samp("n_bytes"), 9)
    return sizes.agg(F.count("*").alias("n"), F.min("n_bytes").cast("bigint").alias("lo"), F.max("n_bytes").cast("bigint").alias("hi"), mean.alias("mean"), sd.alias("sd"))


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """A vocabulary saved, loaded, and shown."""
    path = f"{work_folder(spark)}/vocabulary"
    A.save_vocabulary(_word_vocabulary(spark, d), path, K.SPLIT)
    return A.load_vocabulary(spark, path).select("token_id", F.col("token").cast("string").alias("token"))


def _compression(spark: SparkSession, d: str) -> DataFrame:
    """Bytes a token, by source, of words, figures in twos and other signs, against those of single signs."""
    text = F.col("text")
    n_tokens = F.regexp_count(text, F.lit("[a-zA-Z]+|[0-9]{1,2}|[^a-zA-Z0-9]"))
    rows = read(spark, d, "documents").filter(F.length(text) > 0)
    return K.compression(rows.select("source", F.octet_length(text).alias("n_bytes"), n_tokens.alias("n_tokens"), F.length(text).alias("n_base")), ["source"])


def _settings(spark: SparkSession, d: str) -> DataFrame:
    """Settings of a run: what was asked for, else what the model was saved with, else the default."""
    asked = F.when(F.col("doc_id") % 5 == 0, F.col("doc_id") % 64)
    saved = F.when(F.col("doc_id") % 3 == 0, F.length("text"))
    return read(spark, d, "documents").select("doc_id", K.first_given(asked, saved, F.lit(2048)).cast("bigint").alias("length"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "write_shards": _write_shards, "list_shards": _list_shards, "encode": _encode, "decode_roundtrip": _round_trip, "tokenizer_report": _tokenizer_report,
    "token_bytes_stats": _token_stats, "eta": _eta, "baseline_join": _baselines, "results_csv": _results, "eval_configs": _configs,
    "write_new": _write_twice, "token_sizes": _token_sizes, "vocabulary_store": _stored, "compression_ratio": _compression,
    "config_fallback": _settings, "special_tokens": lambda s, d: K.special_tokens(s),
}

_SQL_BASE = "SELECT coalesce(source, 'none') AS task, count(*) FILTER (rec_id % 3 = 0) / count(*) AS accuracy, length(coalesce(source, 'none')) * 1.5::DOUBLE AS baseline FROM shards GROUP BY ALL"
_NAMED = "(0, '<|bos|>'), (1, '<|user_start|>'), (2, '<|user_end|>'), (3, '<|assistant_start|>'), (4, '<|assistant_end|>'), (5, '<|python_start|>'), (6, '<|python_end|>'), (7, '<|output_start|>'), (8, '<|output_end|>')"

ORACLES: dict[str, str] = {
    "write_shards": f"SELECT shard, count(*) AS n_rows, coalesce(sum(length(text)), 0)::BIGINT AS n_chars FROM ({_SQL_SHARDS}) JOIN documents USING (doc_id) GROUP BY shard",
    "list_shards": f"SELECT shard, 1::BIGINT AS n_files, true AS filled FROM ({_SQL_SHARDS}) GROUP BY shard",
    "decode_roundtrip": "SELECT count(*) AS n_docs, count(*) AS n_equal FROM documents WHERE text IS NOT NULL",
    "eta": _SQL_ETA,
    "baseline_join": _SQL_BASE,
    "results_csv": f"""WITH b AS ({_SQL_BASE}), c AS (SELECT *, (accuracy - baseline / 100) / (1 - baseline / 100) AS centered FROM b)
        SELECT rpad('Task', 35, ' ') || ', ' || rpad('Accuracy', 10, ' ') || ', ' || rpad('Centered', 10, ' ') AS line
        UNION ALL SELECT format('{{:<35}}, {{:<10.6f}}, {{:<10.6f}}', task, accuracy, centered) FROM c
        UNION ALL SELECT format('{{:<35}}, {{:<10}}, {{:<10.6f}}', 'CORE', '', avg(centered)) FROM c""",
    "eval_configs": "SELECT split || '_task' AS task, 'choices' AS kind, length(split)::INT AS shots, count(*) AS n FROM shards WHERE split IS NOT NULL GROUP BY split",
    "write_new": """WITH i AS (SELECT count(DISTINCT identifier) AS n, count(DISTINCT identifier) FILTER (pub_year < '1850') AS a FROM internetarchive)
        SELECT n, n AS n_ids, a AS first, n - a AS second, 0::BIGINT AS third FROM i""",
    "token_sizes": "SELECT count(*) AS n, min(b) AS lo, max(b) AS hi, round(avg(b), 9) AS mean, round(stddev_samp(b), 9) AS sd FROM (SELECT strlen(w) AS b FROM (SELECT DISTINCT lower(word) AS w FROM lexicon)) WHERE b > 0",
    "vocabulary_store": f"SELECT (row_number() OVER (ORDER BY length(w), w) + {len(K.SPECIALS) - 1})::INT AS token_id, w AS token FROM (SELECT DISTINCT lower(word) AS w FROM lexicon) UNION ALL SELECT i::INT, n FROM (VALUES {_NAMED}) s(i, n)",
    "compression_ratio": """WITH d AS (SELECT source, strlen(text) AS b, len(regexp_extract_all(text, '[a-zA-Z]+|[0-9]{1,2}|[^a-zA-Z0-9]')) AS t, length(text) AS s FROM documents WHERE text <> ''),
        g AS (SELECT source, sum(b)::BIGINT AS n_bytes, sum(t)::BIGINT AS n_tokens, sum(s)::BIGINT AS n_base FROM d GROUP BY source)
        SELECT source, n_bytes, n_tokens, n_base, round(n_bytes / n_tokens, 9) AS ratio, round(n_bytes / n_base, 9) AS base_ratio, round((n_base - n_tokens) / n_tokens * 100, 6) AS difference,
          CASE WHEN n_tokens < n_base THEN 'better' WHEN n_tokens > n_base THEN 'worse' ELSE 'tie' END AS verdict FROM g""",
    "config_fallback": "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN doc_id % 64 WHEN doc_id % 3 = 0 AND text IS NOT NULL THEN length(text) ELSE 2048 END::BIGINT AS length FROM documents",
    "special_tokens": f"SELECT (256 + i)::INT AS token_id, n AS name FROM (VALUES {_NAMED}) s(i, n)",
}
