"""The documents of a corpus, from raw text to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of the documents.

A stage's intermediate tables are needed until its result is written. They are dropped when the next stage
in the order begins, whose documents are that written result; they stay while its documents read them.

The stages run one after another in the same executors, whose heaps keep what the largest stage took. So the session
bounds what a task holds of texts at once, which differ in length by several orders of magnitude: batches for Python workers
and row groups by bytes, and the rows that are decoded together by their number.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tablespan.llm.decontamination import clean
from tablespan.llm.jaccard import first_of_each
from tablespan.llm.language import in_known_languages
from tablespan.llm.packing import packed
from tablespan.llm.personal import masked
from tablespan.sources.shared import drop_folders, kept, recorded

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: What a task holds of texts: sent to a Python worker together, gathered before they are written, and decoded together.
HELD = {
    "spark.sql.execution.arrow.maxBytesPerBatch": 1 << 20,
    "parquet.block.size": 8 << 20,
    "spark.sql.parquet.columnarReaderBatchSize": 512,
}

#: Folders with intermediate tables of each stage; those of the last stage belong to its reader.
_made: dict[str, list[str]] = {}


def _stage(after: str | None, last: bool = False) -> Callable[[Stage], Stage]:
    """A stage that drops the intermediate tables of the one before it, and has its own recorded."""

    def wrap(work: Stage) -> Stage:
        @wraps(work)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            for name, most in HELD.items():
                spark.conf.set(name, str(most))
            before = _made.get(after or "", [])
            if before and not _reads(docs, before):
                drop_folders(spark, before)
                before.clear()
            with recorded() as folders:
                result = work(spark, docs, sf_dir)
            if not last:
                _made.setdefault(work.__name__, []).extend(folders)
            return result

        return run_stage

    return wrap


def _reads(docs: DataFrame, folders: list[str]) -> bool:
    names = {folder.rsplit("/", 1)[-1] for folder in folders}
    return any(name in file for file in docs.inputFiles() for name in names)


@_stage(after=None)
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with an unsure one, go."""
    return in_known_languages(spark, docs)


@_stage(after="language")
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return first_of_each(spark, docs)


@_stage(after="near_duplicates")
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too many words of the benchmark's passages go."""
    return clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage(after="decontamination")
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is masked."""
    return masked(spark, docs)


@_stage(after="personal_data", last=True)
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences, with their token ids."""
    return packed(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: No SQL expresses the stages; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = kept(spark, docs)
    return docs
