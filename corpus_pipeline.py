"""From raw documents to packed training sequences: five stages, each one operator of ``listingflow.llm``.

Every stage takes all rows its predecessor kept and returns the columns of ``documents``; the last returns pieces of sequences.
For all stages a null text counts as the empty text; an empty table gives an empty result; further columns pass through
unchanged, whatever their names and nulls, and are not read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.llm import exact_dedup, jaccard_join, packing, personal_data, quality
from listingflow.llm.common import documents, new_folder, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones, finds good with a probability of 0.3 or more.

    Empty and very long texts are scored like all others; rows that repeat are scored alike; without labels every row stays.
    """
    trees = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, trees, "__quality__").where("__quality__ >= 0.3").drop("__quality__")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id; a null id is smaller than all others.

    Of rows that agree in id and text one stays; empty texts are equal to each other.
    """
    return exact_dedup.keep_first_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, directly or through others, the smallest id.

    Texts without words are linked with nothing and stay, as do rows with null ids; rows that share an id are taken as one document.
    """
    return jaccard_join.keep_one_of_each(docs, n=5, percent=80)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts replaced by its kind; a null text stays null, a text without any as it is."""
    return personal_data.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, packed into sequences of 4096.

    An empty text is its end id alone; a text longer than a sequence is cut; rows that repeat are packed each.
    """
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_texts),
    ("n-gram Jaccard join", without_near_copies),
    ("PII", without_personal_data),
    ("packing", packed),
]
# no SQL: the classifier, the connected components, the redaction and the packing are beyond it
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again by the next stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        folder = new_folder(spark, "stage-" + name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
