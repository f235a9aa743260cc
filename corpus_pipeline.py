"""From raw documents to packed sequences: five corpus operators in a row.

Each stage takes what its predecessor kept; all but the last return the columns of
documents.  ``run`` writes each stage's result to the shared folder before the
next one reads it, so a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.jaccard_join import without_near_copies
from placeweave.llm.language_id import UNKNOWN, held_out, identify, learn
from placeweave.llm.line_dedup import dedup_lines
from placeweave.llm.mixing import calibrated_sample
from placeweave.llm.packing import pack_documents
from placeweave.llm.queries import table, tokenizer_path
from placeweave.llm.shared import staged
from placeweave.session import ship_package, with_settings

#: The least share of a document that its main language must have.
MAIN_LANGUAGE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; those without a letter or without one go.

    A null ``lang`` is filled with the prediction.  The model is learned from the
    stage's own labelled documents; without any, nothing is known and all go.
    Repeated rows are judged alike; further columns pass through.
    """
    ship_package(with_settings(spark))
    judged = identify(docs, learn(docs.where(~held_out("doc_id"))))
    accepted = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MAIN_LANGUAGE))
    return accepted.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those that had nothing else go.

    Null and empty texts and rows with a null id stay as they are; further columns pass through.
    """
    ship_package(with_settings(spark))
    cleaned = dedup_lines(docs)
    left = cleaned.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Null and empty texts are near nothing and stay, as do rows with a null id; all rows
    of the id that stays do so; further columns pass through.
    """
    ship_package(with_settings(spark))
    return without_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by their calibrated probabilities, each once or not at all.

    Languages and sources are evened out (POWERS), topics keep their share.  A null
    source or language is a value of its own; rows of one id and cell stay together.
    """
    ship_package(with_settings(spark))
    return calibrated_sample(docs).where("kept").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens.

    A null or empty text is its end token alone; repeated rows are packed each time.
    """
    ship_package(with_settings(spark))
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing", mixture),
    ("packing", packed),
]

#: Fuzzy lines, trigram mixtures and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs)
    return docs
