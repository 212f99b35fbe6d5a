"""The corpus pipeline: five stages, each written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm import decontaminate, langid, ngram_join, packing, quality
from tickerlake.llm.common import stored, table


# Mean probability of the best label below which a language is in doubt.
LEAST_SCORE = 0.4


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tokeniser fertility rules keep."""
    return quality.kept_documents(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that the model knows and is not in doubt about.

    The model learns from the labelled documents of the stage's input that are not held out.
    """
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    judged = langid.annotate_language(docs.select("text", own), model)
    if model is None:
        return judged.select("own.*")  # nothing to learn from: nothing to reject
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("own.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return ngram_join.one_per_class(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pack_sequences", pack_sequences),
]

# Token ids, trained models and sampled signatures are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
