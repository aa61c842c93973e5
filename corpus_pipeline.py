"""Corpus pipeline: raw documents in, a clean and weighted mix out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in
the shared checkpoint folder and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from coverlens.llm import decontaminate, language_id, line_dedup, mixing, ngram_join
from coverlens.llm.common import remove, shuffles_removed
from coverlens.session import work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the others go."""
    return language_id.accepted(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines go, and documents of which nothing is left."""
    return line_dedup.dedup_lines(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.first_of_class(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns with ``epoch`` and ``words``: one row per pass that the mix takes."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("source_mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again; what a stage has read goes when its own rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = work_dir(spark, "pipeline")
    before = None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}_{name}"
        with shuffles_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs


#: The language model is trained, which SQL cannot state; tests/llm holds run() against a brute-force version.
ORACLE_SQL: str | None = None

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
