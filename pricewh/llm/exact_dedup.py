"""Exact deduplication by full content, safe under hot groups of copies.

DataFrame operations only.  Texts are compared whole at every stage; a digest only decides
where a text goes, so two texts that share a digest are still told apart:

1. locally: each scan task folds its copies of a text (the partial side of the aggregation);
2. by salt: copies of a text go to ``salts`` tasks by (digest, salt) and are folded there;
3. globally: at most ``salts`` winners of a text meet by digest and are folded again.

What is joined back to the documents is one narrow row for each digest, without texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import lower_az, stored

SALTS = 16


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                digest=lambda norm: F.sha2(norm.cast("binary"), 256)) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z.  A null text counts as the empty
    text.  Of equal texts the largest id stays.  Rows that repeat an id and its text are one
    document told several times: each counts in ``group_size`` and each is marked kept.  A null
    id never wins over another id; a group of null ids only has a null keep_id and stays.  An
    empty table gives no rows; further columns of ``docs`` are not read.
    """
    base = _normalised(docs, id_col, text_col, digest)
    winners = _winners(base, salts)
    # One narrow row a digest.  texts > 1 only if different texts share a digest.
    narrow = stored(winners.groupBy("_digest").agg(F.count(F.lit(1)).alias("_texts"), F.max("_best").alias("keep_id"),
                                                   F.sum("_n").alias("group_size")), "exact-dedup")
    collided = narrow.filter("_texts > 1").select("_digest")
    rows = base.select("_id", "_digest", "_sha")
    if collided.isEmpty():
        return _result(rows.join(narrow.drop("_texts"), "_digest"))
    alone = rows.join(narrow.filter("_texts = 1").drop("_texts"), "_digest")
    texts = (winners.join(collided, "_digest", "left_semi")
             .select("_digest", "_norm", F.col("_best").alias("keep_id"), F.col("_n").alias("group_size")))
    shared = base.join(collided, "_digest", "left_semi").join(texts, ["_digest", "_norm"])
    return _result(alone.unionByName(shared.select(alone.columns)))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    kept = (exact_dedup(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias("_keep")).distinct())
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_keep"]), "left_semi")


def _normalised(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    norm: Column = lower_az(F.coalesce(F.col(text_col), F.lit("")))
    return (docs.select(F.col(id_col).alias("_id"), norm.alias("_norm"))
            .select("_id", "_norm", digest(F.col("_norm")).alias("_digest"),
                    F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha")))


def _winners(base: DataFrame, salts: int) -> DataFrame:
    """(_digest, _norm, _best, _n): one row for each different text."""
    by_salt = (base.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
               .groupBy("_digest", "_salt", "_norm")
               .agg(F.max("_id").alias("_best"), F.count(F.lit(1)).alias("_n")))
    return by_salt.groupBy("_digest", "_norm").agg(F.max("_best").alias("_best"), F.sum("_n").alias("_n"))


def _result(joined: DataFrame) -> DataFrame:
    return joined.select(F.col("_id").alias("doc_id"), "keep_id", F.col("group_size").cast("bigint"),
                         F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_sha").alias("text_sha256"))
