"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the
last return the columns of ``docs``, further ones with any name included;
``run`` writes each stage's rows to the shared folder and rereads them as the
next one's input.  An empty table gives an empty result at every stage, texts of
any length are handled whole, and rows with a null id go through all stages as
documents of their own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.packing import best_fit_pack
from tidemark.llm.pairwise import keep_good
from tidemark.llm.repetition import keep_varied
from tidemark.llm.rlz import without_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep; null and empty texts are rejected, equal texts share a verdict."""
    return keep_varied(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled among them, predicts to be good.

    A score of exactly a half is good.  Null and empty texts are scored like
    any other; without labels of both classes all documents stay.
    """
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates.

    Rows without an id are kept.  Rows that agree on id and text are one, the
    least by the other columns.  Of an id with several texts, that with the
    least hash stands at its id; each other is a document of its own, after
    all others in the order of ids.  Null and empty texts are near nothing and
    stay.
    """
    columns = docs.columns
    named = docs.filter("doc_id is not null")
    texts = named.select("doc_id", F.xxhash64("text").alias("_hash")).groupBy("doc_id").agg(F.min("_hash").alias("_least"), F.max("_hash").alias("_most"))
    several = materialise(texts.filter("_least < _most").select("doc_id", "_least"), "several")
    if several.isEmpty():
        named = named.withColumn("_id", F.col("doc_id").cast("long"))
    else:
        late = F.xxhash64("doc_id", "text").bitwiseAND((1 << 62) - 1) + (1 << 62)
        other = F.xxhash64("text") != F.col("_least")
        named = materialise(named.join(several, "doc_id", "left").withColumn("_id", F.when(other, late).otherwise(F.col("doc_id").cast("long"))).select("_id", *columns), "named")
    kept = near_duplicates(named.select("_id", "text"), id_col="_id").filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    least = F.min(F.struct(*[c for c in columns if c != "text"], "text")).alias("row")
    found = named.join(kept, "_id", "left_semi").groupBy("_id").agg(least).select("row.*").select(*columns)
    return found.unionByName(docs.filter("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand in a document with a smaller id.

    Rows stay also if they lose all words or have a null text; rows with a null
    id lose nothing and take nothing from others.
    """
    return without_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens; null and empty texts are one piece with the end token alone, repeated rows are packed each."""
    return best_fit_pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]

#: SQL can't express a trained classifier or a packing plan; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
