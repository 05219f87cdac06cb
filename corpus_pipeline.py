"""Corpus preparation: toxicity, quality rules, near-dedup, personal data, packing.

``STAGES`` lists (name, function) in order.  A function takes (spark, docs, sf_dir)
and returns the documents it leaves, with their columns; the last one returns the
packed pieces.  ``run`` applies them to ``documents``; what a stage returns is
written as Parquet and read again as the next one's input, so a lost executor
costs part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm import near_dedup, packing, pii, quality, toxicity
from monthwise.llm.common import materialize, release, table

SHINGLE_WORDS = 5
PERCENT = 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold, by a model fitted on labelled ones."""
    return toxicity.filter_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, the base rules included."""
    return quality.quality_filter(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document of the smallest id.  Rows that
    repeat an id and its text become one; rows without an id stay.  If one id has several
    texts, these are decided on apart, by numbers in the order of the ids."""
    doc = [F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text")]
    known = docs.where("doc_id is not null").select(*doc)
    if known.groupBy("_id").agg(F.min("_text").alias("a"), F.max("_text").alias("b")).where("a != b").isEmpty():
        return _one_of_each(docs, "doc_id").select(*docs.columns)
    numbers = materialize(known.distinct().repartitionByRange("_id", "_text").sortWithinPartitions("_id", "_text")
                          .withColumn("_number", F.monotonically_increasing_id()), "pipeline-numbers")
    numbered = docs.select("*", *doc).join(numbers, ["_id", "_text"], "left")
    return _one_of_each(numbered, "_number").select(*docs.columns)


def _one_of_each(docs: DataFrame, id_col: str) -> DataFrame:
    """Of each component the row of the smallest ``id_col``, which goes with one text."""
    classes = near_dedup.near_duplicates(docs, id_col, shingle_words=SHINGLE_WORDS, percent=PERCENT)
    dropped = classes.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    again = classes.where(F.col(id_col) == F.col("component_id")).groupBy(id_col).count() \
        .where("count > 1").select(id_col)
    once = docs.join(dropped.unionAll(again), id_col, "left_anti")
    repeated = docs.join(again, id_col, "left_semi").dropDuplicates([id_col, "text"])
    return once.unionByName(repeated)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and n_chars brought up to date."""
    out = pii.mask_documents(docs)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences that hold the corpus's own mixture of sources."""
    return packing.pack(docs)[0]


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# A trained classifier and a tokenizer are not SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace('_', '-')}")
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
