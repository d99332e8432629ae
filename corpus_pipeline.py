"""The corpus pipeline: stages over documents, each written as Parquet and read back for the next.

Trusted text sets what a good document reads like; then documents without a recognisable
language go, then all but one of every group of near copies, and what is left is packed
into training sequences. Every stage sees only what the one before it kept.

Defined results: every stage takes an empty table, null texts and extra columns; null and
blank texts are rejected by the first; rows that repeat a doc_id count as copies, rows without a doc_id are no copies of any.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from epiframe.llm import jaccard, kneser_ney, language, packing
from epiframe.storage import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents whose best language is less likely than this are rejected.
LEAST_SCORE = 0.5
#: Near copies are told by shingles of so many words, similar in so many hundredths.
COPY_WORDS, COPY_SIMILARITY = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's threshold."""
    return kneser_ney.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled ones."""
    model = language.fit(language.training_rows(docs))
    return language.accepted(docs, model, LEAST_SCORE)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies."""
    return jaccard.one_of_each(docs, COPY_WORDS, COPY_SIMILARITY)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of the kept texts stands in the training sequences."""
    return packing.pack(packing.cut(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("best_fit_packing", best_fit_packing),
]

#: Language models and tokenizers are beyond SQL: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{scratch_dir(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
