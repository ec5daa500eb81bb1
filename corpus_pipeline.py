"""Corpus pipeline over ``documents``: toxic texts go, one document of each group of near
duplicates stays, personal data is redacted, sources are mixed to target weights, and the mix is
encoded and decoded.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last
return the columns of ``documents``.  ``run`` writes each stage's result into the shared folder
and reads it back, so a lost executor repeats one stage at most.

Defined results: a null text is scored as empty and stays null until it is encoded (no tokens);
repeated rows are one group of near duplicates; texts of any length take part whole; an empty table
gives no rows; further columns of ``documents``, whatever their names, are kept up to the last
stage, which returns digests.  Ties are settled by the operators (least id, then row hash).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlens.llm import byte_bpe, common, mixing, near_dups, pii, toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scoring below the threshold; trained on the labels of the learnable ids."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_one(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stands once for each time the mix takes it."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(docs)


STAGES = [("toxicity", without_toxic), ("near duplicates", without_near_duplicates), ("personal data", redacted),
          ("mixing", mixed), ("byte-level BPE", tokens)]
#: No stage but the word counts of the mix can be said in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.written(docs, f"stage{i}")
    return docs
