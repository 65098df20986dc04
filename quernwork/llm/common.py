"""Reading tables, cutting lineage, and names shared by the operators of this package."""

from __future__ import annotations

import atexit
import importlib
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

#: Folder of the public vocabulary files; the environment or a caller may name another.
TOKENIZER_DIR = "/opt/tokenizers"

#: Language names and codes -> one code (fixed values).
LANGUAGE_CODES = {
    "en": "en", "eng": "en", "english": "en",
    "fr": "fr", "fra": "fr", "fre": "fr", "french": "fr",
    "de": "de", "deu": "de", "ger": "de", "german": "de",
    "es": "es", "spa": "es", "spanish": "es",
    "it": "it", "ita": "it", "italian": "it",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def vocabulary_path(file_name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file: ``folder``, else QUERN_TOKENIZERS, else the default, else the installed package."""
    for base in (folder, os.environ.get("QUERN_TOKENIZERS"), TOKENIZER_DIR):
        if base and os.path.exists(os.path.join(base, file_name)):
            return os.path.join(base, file_name)
    return importlib.import_module("public_tokenizers").path(file_name)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    The cluster names the folder in ``spark.checkpoint.dir``; only where that is unset and the session runs on one
    machine (tests) a temporary folder is taken, which goes when Python ends. Checkpoints themselves are removed by the
    engine once nothing refers to them, where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = df.sparkSession.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        folder = tempfile.mkdtemp(prefix="quern-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def language_code(name: Column) -> Column:
    """One code per language; null for null, blank or unknown names stay as they are in lower case."""
    key = F.lower(F.trim(name))
    out = F.when(F.length(key) == 0, F.lit(None).cast("string"))
    for spelling, code in LANGUAGE_CODES.items():
        if spelling != code:
            out = out.when(key == spelling, F.lit(code))
    return out.otherwise(key)


def key_hash(*cols: Column) -> Column:
    """A 128-bit key of any columns, kept as a string; nulls differ from empty strings."""
    return F.md5(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)])))


def join_equal(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, null equal to null; the keys stay once, from the left."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(right, on, how).drop(*[f"_right_{k}" for k in keys])
