"""The corpus pipeline: five stages from documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
``documents``. Toxic documents go; of near-duplicates the one with the smallest id stays; passages that an earlier document
holds are cut out; documents with benchmark passages go; the rest is packed.

Null and empty texts are kept by every stage and packed as the end id alone; so are rows without an id. Extra columns travel along up to the last
stage, whatever their names; texts are worked on whole; empty tables give no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm import decontamination, near_dup, packing, queries, substring_dedup, toxicity
from docloom.llm._common import shared_dir, table, written

#: Learned scores, shingle links and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without an id stay; of rows that repeat an id, the one with the least text by hash stays."""
    kept = near_dup.near_duplicates(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row"))  # columns of any name
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("row.text"), "row.text")
    named = rows.where("doc_id is not null").join(kept, F.col("doc_id") == F.col("id"), "left_semi").withColumn("nth", F.row_number().over(one)).where("nth = 1")
    return named.select("row.*").unionByName(docs.where("doc_id is null"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_matches(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries._tokenizer(), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs, at = table(spark, sf_dir, "documents"), shared_dir(spark)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"{at}/{name}")
    return docs
