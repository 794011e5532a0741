"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before has written and returns documents
with the same columns; the last one says which words go into which sequence.
"""

from __future__ import annotations

from collections.abc import Callable
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.decontaminate import decontaminate
from tallyframe.llm.packing import pack
from tallyframe.llm.pii import redact
from tallyframe.llm.simhash import drop_near_duplicates
from tallyframe.llm.toxicity import drop_toxic
from tallyframe.plans import Scratch
from tallyframe.sources import read_table

Stage = Callable[..., DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"), threshold=0.7)


def near_duplicate_stage(
    spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None
) -> DataFrame:
    """Of documents whose fingerprints of four-word shingles are linked by 4 differing
    bits or fewer, the one with the least id stays."""
    return drop_near_duplicates(docs, shingle=4, max_bits=4, scratch=scratch)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 10 words of a benchmark item are cut out."""
    return _counted(decontaminate(docs, read_table(spark, sf_dir, "benchmark"), window=10))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _counted(redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All words of what is left, in sequences of 1024."""
    return pack(docs, capacity=1024)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text that a stage has changed."""
    length = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return docs.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("simhash_near_duplicates", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("best_fit_packing", packing_stage),
]

#: Trained models and graph components are beyond SQL; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written before the next one reads it.

    A written table goes once the next one is there, with all that a stage has written
    on the way; the last but one stays, as the result reads it.
    """
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        owner = {"scratch": scratch} if "scratch" in signature(stage).parameters else {}
        docs = scratch.keep(stage(spark, docs, sf_dir, **owner))
        scratch.remove(but_last=1)
    return STAGES[-1][1](spark, docs, sf_dir)


def registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    return {"pipeline": (run, ORACLE_SQL)}
