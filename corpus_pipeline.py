"""The corpus pipeline: stages over documents, each on what its predecessor kept.

Every stage but the last returns the columns it was given, whatever else they are called.
Defined cases: rows without a text, or without a letter, have no language and go in the
first stage; rows without an id are rows like others; rows equal in id and text are one
document from the second stage on; ties go to the smaller id, then to the text hash; an
empty table passes through all stages as an empty one.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarjuman.llm import decontaminate, jaccard, language, mixing, tokens
from tarjuman.workspace import materialize, new_folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones have; those without one go."""
    found = language.identify(docs, language.learn(docs))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") > 0)).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_one(docs).select(docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark's text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, benchmark)
    return found.where(~F.col("contaminated")).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    return mixing.training_order(mixing.mix(docs)).select(docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and what reading them back gives."""
    folder = new_folder(spark, "token-files")
    tokens.write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_tokens(spark, folder)


STAGES = [
    ("language", known_language), ("near_duplicates", one_of_each), ("decontamination", uncontaminated),
    ("mixing", mixed), ("tokens", token_files),
]

#: Learned filters and token ids are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
