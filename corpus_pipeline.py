"""A training-data pipeline over ``documents``: clean, deduplicate, pack.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir).  Each stage but the last
returns documents with the columns it was given; each result is written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewh.llm import line_dedup, ngram_join, packing, toxicity
from pricewh.llm.common import stored
from pricewh.sources.tables import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Pieces that the encoder of a worker remembers: less than by default, as the worker has done three stages before.
REMEMBERED = 150_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger's score does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score_documents(docs, model).filter("predicted = 0").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return kept.select(*[changed[c].alias(c) if c in changed else F.col(f"row.{c}").alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by similar word shingles."""
    return ngram_join.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, VOCABULARY, remembered=REMEMBERED).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("ngram_join", drop_near_copies),
          ("packing", pack)]

#: SQL cannot say what a trained tagger rejects; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
