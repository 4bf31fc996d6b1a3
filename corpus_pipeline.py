"""A training corpus from ``documents``: language, exact and near copies, source mix, token ids.

Every stage takes ``(spark, docs, sf_dir)``, works on all that the stage before kept, and returns the rows it keeps
with the columns of ``documents``; the last returns the ids of the texts. ``run`` writes each stage's
result to the shared folder and reads it again for the next.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlake.llm import bpe, exact, langid, mixing, simhash
from medlake.llm.common import bounded_hint, cut, row_key, small_batches, spare
from medlake.llm.queries import PATTERN, RANKS

# Functions sent to Python workers travel by value, wherever the driver was started.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Corrected share of n-grams below which a text is in none of the languages learned.
LEAST_SCORE = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, and texts that fit none of the languages in ``lang``."""
    small_batches(spark)
    model = langid.learn(docs)
    judged = langid.identify(docs.select(row_key("doc_id", "text").alias("key"), "text"), model, keep=["key"])
    rejected = judged.where((F.col("lang_pred") == langid.UNKNOWN) | (F.col("score") < LEAST_SCORE))
    verdicts = cut(rejected.select("key").distinct(), "rejected")
    key = spare(docs, "__llm_key")
    marked = docs.withColumn(key, row_key("doc_id", "text"))
    dropped = bounded_hint(verdicts.withColumnRenamed("key", key), 64)
    return marked.join(dropped, key, "left_anti").drop(key)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row with the largest id stays."""
    return exact.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by SimHash, the row with the smallest id stays."""
    small_batches(spark)
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows as often as the balanced sample takes them."""
    return mixing.take_mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text (packed, with their number), and whether they decode to its bytes."""
    small_batches(spark)
    ranks = bpe.share_ranks(spark, RANKS)
    both = bpe.decode(bpe.encode(docs, ranks, PATTERN), ranks)
    return both.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("mix", mix),
    ("token ids", token_ids),
]

#: The stages learn a classifier, link fingerprints and draw a sample: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
