"""A corpus pipeline of the operators in ``evenkeel.llm``: from raw documents to packed token sequences.

Each stage takes all that the one before it kept; all but the last return the columns of ``documents``, whatever further
columns there are and whatever they are called. Rows are judged as rows: repeated ids, null ids and repeated rows
are no error. Null and empty texts go in the first stage. Empty tables give no rows.
"""

from collections.abc import Iterator
from contextlib import contextmanager

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm import language_id, ngram_join, packing, quality_rules, suffix_dedup
from evenkeel.plans.staging import delete_path, scratch_area, stage
from evenkeel.session import BATCH_ROWS

LEAST_LANGUAGE_SCORE = 0.2


def _small_batches(spark: SparkSession) -> None:
    """Stages hand back frames that are run later: that whole texts go to Python few at a time is set for the session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


_scratch: list[str] = []  # folders of tables that stages have staged


@contextmanager
def _stage(spark: SparkSession, docs: DataFrame, name: str) -> Iterator[None]:
    """One stage: its staged tables go when the next begins, as its result has been written by then.

    A folder that ``docs`` still reads, as it was handed on unwritten, stays.
    """
    _small_batches(spark)
    read = docs.inputFiles() if _scratch else []
    for path in list(_scratch):
        if not any(f"/{path.rsplit('/', 1)[1]}/" in file for file in read):
            delete_path(spark, path)
            _scratch.remove(path)
    with scratch_area(spark, name) as path:
        _scratch.append(path)
        yield


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learned from ``labels`` keep; null and empty texts go, equal texts have one fate."""
    with _stage(spark, docs, "quality"):
        return quality_rules.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter and those like no profile go.

    Where no document has a ``lang`` to learn from, only those without a letter go.
    """
    with _stage(spark, docs, "language"):
        return language_id.in_known_language(docs, LEAST_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of every group linked by five-word shingles at 0.8 or more.

    A null id comes after all others, of equal ids the first row stays; texts without words link with nothing.
    """
    with _stage(spark, docs, "duplicates"):
        return ngram_join.one_of_each_group(docs, shingle=5, least=80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that an earlier place has too; what has no word left goes."""
    with _stage(spark, docs, "strings"):
        return suffix_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 1024; a null or empty text is its end id."""
    with _stage(spark, docs, "packed"):
        return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", good_quality), ("language_id", known_language), ("ngram_jaccard_join", near_duplicates),
          ("suffix_array_dedup", repeated_strings), ("best_fit_packing", packed)]

# Tokens, learned rules and profiles are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole ``documents`` table, each written and read again: a row per packed piece."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
