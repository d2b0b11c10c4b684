"""Documents to packed training sequences, in stages that each call one operator of `streamloader.llm`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamloader.llm import disclosure, nnls_packing, nnpu_toxicity, ppm_language, shingle_join
from streamloader.llm.common import cut, discard, scratch_path, table, temporary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A document whose best language has less than this share of the probability is rejected.
LANGUAGE_SHARE = 0.5


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier predicts toxic go; it learns from the labels of the documents given."""
    model = nnpu_toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return nnpu_toxicity.reject(docs.select(*COLUMNS), model)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those that no learned language explains better than all others together, go."""
    trees = ppm_language.fit(docs.where(~ppm_language.held_out()))
    return ppm_language.reject(docs.select(*COLUMNS), trees, LANGUAGE_SHARE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest id.  Links are five-word shingle sets at 0.8 or more.

    The fingerprints and BK-trees of operator 7, over five-word shingles, propose the copies with hardly an edit; two sets at
    similarity 0.8 differ in some ten of 64 bits, beyond any radius that shards or a tree could search, so MinHash bands
    propose those as well, and the sets decide on both (`shingle_join`).  Rows that repeat an id and its text leave one
    row, different texts of one id are judged each on its own; rows with a null id have no place in the order and stay.
    """
    chosen = docs.select(*COLUMNS)
    found = shingle_join.near_duplicates(chosen).where("kept and doc_id is not null")
    kept = cut(found.select(F.col("doc_id").alias("kept_id"), F.col("h").alias("kept_h")).distinct())
    texts = chosen.withColumn("h", shingle_join.text_hash(F.col("text")))
    # Rows of an id and text meet in the join, so dropping repeated ones needs no exchange of its own.
    named = texts.join(kept, (texts["doc_id"] == kept["kept_id"]) & (texts["h"] == kept["kept_h"]))
    return named.dropDuplicates(["doc_id", "h"]).select(*COLUMNS).unionByName(chosen.where("doc_id is null"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become the name of their kind; terms that reveal them are generalised or removed."""
    redacted = disclosure.sanitised_text(disclosure.sanitise(docs.select(*COLUMNS)), COLUMNS)
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return nnls_packing.pack(docs)


STAGES = [
    ("toxicity", clean),
    ("language_id", known_language),
    ("simhash_near_dedup", near_dedup),
    ("pii", private),
    ("packing", packed),
]

# Learned models and graph components have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
