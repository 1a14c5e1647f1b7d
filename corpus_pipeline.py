"""From raw documents to packed sequences: grade, drop near copies, cut repeated passages, mix languages, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows and reads them again for the next.
All but the last return the columns of docs, whatever others there are. Null and empty texts are graded and go there as no evidence of quality, unless nothing is
rated; rows without doc_id are graded, and linked with nothing. Of rows with one doc_id and text, one stays; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metalake.llm import jaccard, mixing, packing, quality, suffix_dedup
from metalake.llm.common import materialize, read_table


def grade(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted grade reaches both limits of the ordinal model."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.kept(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the smallest id of each group of linked ones, rows equal in id and text once; documents without id stay."""
    first = jaccard.link_documents(docs).where("doc_id = component_id").select("doc_id")
    return docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns).union(docs.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that start earlier too; what is left without text goes."""
    return suffix_dedup.strip(docs).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages nearer to each other (the square roots of their shares) in as many words: rates below 1 leave documents out, others repeat them."""
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).join(read_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return mixing.mixture(docs, labelled, "root")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids in full sequences; copies that the mixture made go to different ones."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", grade),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("mixing to target weights", mixture),
    ("lexical retrieval packing", sequences),
]

#: Hashed features, suffix arrays and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage{i + 1}")
    return docs
