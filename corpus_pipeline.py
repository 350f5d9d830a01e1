"""From raw documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.llm import dartminhash, divergence, fmindex, packing, quality
from tidalframe.llm.queries import tokenizer
from tidalframe.llm.store import written
from tidalframe.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _others(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c != "doc_id")


def _kept(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents again, after an operator carried them along."""
    return found.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_c_{c}").alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Documents that the classifier takes for good ones.

    A null or empty text has the score of no words; repeated rows stay or go together.
    """
    found = quality.quality_scores(docs, table(spark, root, "labels"), carried=_others(docs))
    return _kept(found.filter("predicted = 1"), docs)


def quality_rules(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Documents that pass the base rules and resemble their language.

    Null and empty texts fail; a null language is one of its own; repeated rows stay or go together.
    """
    return _kept(divergence.quality_rules(docs, carried=_others(docs)).filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """One document of each class of near duplicates: that with the smallest id.

    Of repeated rows one stays; a null id comes last; a null text is a class of its own.
    """
    return dartminhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """All documents, without the benchmark passages in their texts; n_chars follows the text.

    A null text stays null, and a text that was all passage stays as an empty one.
    """
    found = fmindex.contamination(docs, table(spark, root, "benchmark"), carried=tuple(c for c in _others(docs) if c != "text"))
    if "n_chars" in docs.columns:
        found = found.withColumn("_c_n_chars", F.when(F.col("n_hit") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_c_n_chars")))
    return _kept(found.withColumnRenamed("text", "_c_text"), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; a null text is one end mark."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# A network, histograms against a corpus, signatures and a packing search have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, root: str) -> DataFrame:
    """All stages over the table of documents, each written down and read again by the next."""
    docs = table(spark, root, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, root)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
