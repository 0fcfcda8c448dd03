"""A corpus pipeline of five operators; each stage is written and read again before the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import line_dedup, mixing, near, pieces, quality
from corpusloom.llm.common import table
from corpusloom.storage import shared_dir


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on this corpus's labels, does not reject.

    Null texts score as empty ones; repeated rows are kept or rejected alike;
    without labels every document scores 0.5 and stays.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.boxed_scores(docs, model).where(F.col("__score") >= quality.THRESHOLD).select("__row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a document of a smaller id holds already.

    Null and empty texts stay as they are; rows with one id count as one
    document, those with a null id as the last; rows are neither lost nor added.
    """
    return line_dedup.dedup_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group whose links are 5-word Jaccard similarities of 0.8 or more.

    Operator 4 finds the pairs with close SimHash fingerprints; those of 0.8
    that its blocks can't reach come from operator 11's bands; all are verified.
    Null texts count as empty, and texts without words are equal to each other;
    of repeated rows one stays; a null id is chosen only if there is no other.
    """
    return near.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each repetition that the sources' targets ask for, texts whole.

    Null sources are one source, the last; texts without words are sampled by
    their place; rows with one id share a place, and repeated rows are dealt
    out one by one. A source without words gives no rows.
    """
    return mixing.mixed_documents(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, pieces, n_pieces, text_sha256, lossless): a sampled segmentation of each text, and whether it decodes to the text.

    Null texts count as empty, which have one piece; repeated rows get one
    segmentation, each its own row.
    """
    rows = pieces.encoded(docs)
    lossless = (F.col("__back_sha") == F.col("__text_sha")).alias("lossless")
    return rows.select(F.col("__id").alias("doc_id"), F.col("__ids").alias("pieces"), F.size("__ids").alias("n_pieces"), F.col("__back_sha").alias("text_sha256"), lossless)


#: By operators 9, 7, 4 (with 11 for what its blocks can't reach), 6 and 8.
STAGES = [
    ("quality classifier", reject_low_quality),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", keep_one_of_near_copies),
    ("source mixing", mix_sources),
    ("sentencepiece encoding", to_pieces),
]

#: Rules, fingerprints and sampled segmentations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again.

    Nulls in any column, empty and very long texts, repeated rows and further
    columns of any name pass as the stages say; an empty table gives no rows.
    The stages' folder, ``pipeline-`` and a number, stays: what is returned
    reads its last part; ``corpusloom.storage.clear`` removes it.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
