"""The training-data pipeline: language ID, near-duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs. All but the last return the columns of the documents that they got, extra ones included (names that
begin with ``__ng_`` are the stages' own). Texts count whole, however long; an empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notegraph.llm import langid, mixing, neardup, packing
from notegraph.llm.common import shared_dir

#: A text goes if no language has so large a posterior.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those that no language explains better than the rest taken together.

    Null and empty texts have no letter and go. Very long texts are judged by all their words. Repeated rows are judged alike. Null ids and languages change nothing but
    which rows are learned from; if no row has a language, nothing is known and all rows go.
    """
    model = langid.train(docs.select("doc_id", "text", "lang"))
    found = docs.withColumn("__ng_language", langid.identify(docs, model))
    ok = (F.col("__ng_language.lang_pred") != langid.UND) & (F.col("__ng_language.score") >= LEAST_SCORE)
    return found.where(ok).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates, once if its row is repeated.

    Shingles of five words, similarity 0.8 or more, over whole texts, very long ones included. Texts that are null or without words are linked with nothing and stay,
    and so do rows with a null id. Of rows that share an id and a text one stays; ids that repeat with other texts count
    as one document, so all of them go if a smaller id is in their group.
    """
    found = neardup.near_duplicates(docs).where(F.col("id").isNotNull())
    gone = found.where(F.col("id") != F.col("component_id")).select(F.col("id").alias("__ng_id")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["__ng_id"], "left_anti")
    if found.groupBy("id").count().where("count > 1").isEmpty():
        return left
    # rows with a null id differ in this column, so only equal rows of one id are dropped
    own = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(-1)
    return left.withColumn("__ng_own", own).dropDuplicates(["doc_id", "text", "__ng_own"]).drop("__ng_own")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 1, 2, 3 in turn; a document comes as often as the mix takes it, 3 times at most.

    Rows with a null source are a source of their own. A very long text is taken whole or not at all. Null texts have no words but may be taken. Equal rows share out
    the copies that they get together.
    """
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 2048. Null and empty texts are one end token; very long ones fill
    whole sequences; repeated rows are packed each for itself."""
    p = packing.pack(docs)
    return p.select(F.col("id").alias("doc_id"), "start", "length", "sequence_id", "offset", "doc_tokens", F.crc32("ids").alias("ids_crc32"), "ids")


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("mixing", mix_sources), ("packing", pack_sequences)]

#: SQL has neither the language model nor the tokenizer; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
