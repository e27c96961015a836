"""A training corpus from raw documents.

Five stages over the whole table: documents that the quality classifier
rejects go; of each SimHash group one document stays; documents that hold a
benchmark window go; sources are mixed to their target weights, so that a
document comes no, one or two times; what is left is written as token ids and
read back.  ``run`` writes each stage's rows to the shared folder and gives
them to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from allelic.llm import decontaminate, mixing, quality, simhash, token_store
from allelic.llm.common import ship_package, stored, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the smallest id."""
    ship_package(spark)
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    ship_package(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the written ids, in order."""
    ship_package(spark)
    return token_store.token_round_trip(docs)


STAGES = [("quality classifier", good), ("simhash near-dedup", distinct), ("benchmark decontamination", clean),
          ("source mixing", mixed), ("token ids", tokens)]
#: The classifier and the tokenizer have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
