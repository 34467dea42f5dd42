"""Question-answer pairs in XML files.

A file counts as a whole: one that does not parse yields nothing, also not the pairs before the damage.
Spark's XML reader works row tag by row tag and cannot tell, so each file is parsed in a task, one row
per file; everything after the parse is built-in expressions.
"""

import sys
from collections.abc import Iterator
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.text import fence, strip
from evenkeel.operators.numbering import file_starts, number_in_files
from evenkeel.operators.records import make_records
from evenkeel.operators.sampling import first_rows
from evenkeel.plans.notes import note
from evenkeel.plans.staging import stage

# Parsing functions travel with their tasks: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIR_SCHEMA = "path string, pos int, q string, a string, pairs int"
VERDICT = -1  # the place of a file's own row, which has the number of its pairs, null if the file was rejected
AT_ONCE = 1 << 12  # pairs


def scan_xml(spark: SparkSession, root: str) -> DataFrame:
    """Every ``*.xml`` below ``root``, one row per file: path, content."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.xml").load(root).select("path", "content"))


def _child_text(element: ElementTree.Element, tag: str) -> str | None:
    child = element.find(tag)
    return None if child is None else child.text


def _file_rows(path: str, content: bytes | None) -> Iterator[tuple]:
    """The verdict on a file, then its pairs."""
    try:
        root = ElementTree.fromstring(content)
    except (ElementTree.ParseError, LookupError, ValueError, TypeError):
        # damaged, in an unknown or unusable encoding, or absent: the file has no pairs
        yield path, VERDICT, None, None, None
        return
    found = list(root.iter("QAPair"))
    yield path, VERDICT, None, None, len(found)
    for i, pair in enumerate(found):
        yield path, i, _child_text(pair, "Question"), _child_text(pair, "Answer"), None


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = (row for path, content in zip(batch["path"], batch["content"]) for row in _file_rows(path, content))
        while part := list(islice(rows, AT_ONCE)):
            frame = pd.DataFrame(part, columns=["path", "pos", "q", "a", "pairs"])
            yield frame.astype({"pairs": "Int32"})


def parsed_files(files: DataFrame) -> DataFrame:
    """path, pos, q, a of every pair, and a row per file: see ``VERDICT``."""
    return files.select("path", F.col("content").cast("binary").alias("content")).mapInPandas(_parse, PAIR_SCHEMA)


def file_counts() -> dict[str, Column]:
    """How many files were read and rejected, and how many pairs they hold, for ``observe`` on ``parsed_files``."""
    of_file = F.col("pos") == VERDICT
    return {"files_read": F.count_if(of_file & F.col("pairs").isNotNull()),
            "files_rejected": F.count_if(of_file & F.col("pairs").isNull()), "pairs_found": F.count_if(~of_file)}


def pair_texts(parsed: DataFrame) -> DataFrame:
    """path, pos, text: question and answer, or the answer alone; no answer, no row."""
    empty = F.lit("")
    pairs = fence(parsed.filter(F.col("pos") != VERDICT).select("path", "pos", "q", "a"),
                  q=F.coalesce(strip(F.col("q")), empty), a=F.coalesce(strip(F.col("a")), empty))
    text = F.when(F.col("q") != "", F.concat("q", F.lit(" "), "a")).otherwise(F.col("a"))
    return pairs.filter(F.col("a") != "").select("path", "pos", text.alias("text"))


def extract_pairs(files: DataFrame) -> DataFrame:
    """path, pos, text of the pairs of all files that parse."""
    return pair_texts(parsed_files(files))


def qa_records(files: DataFrame, quota: int, label: int, source: str,
               subtopic: str | None = None) -> DataFrame:
    """The first ``quota`` pairs by path and position.

    Files are parsed once, into a staged table; the counts of ``file_counts`` are observed in that write and noted. The
    cut is found on paths and places, and only texts before it are read again.
    """
    counts = file_counts()
    seen = Observation(f"{source} files")
    parsed = parsed_files(files).observe(seen, *[c.alias(name) for name, c in counts.items()])
    pairs = stage(pair_texts(parsed), "pairs")
    note(seen)
    sizes = pairs.groupBy("path").agg((F.max("pos") + 1).cast("bigint").alias("rows"))
    numbered = number_in_files(pairs, file_starts(sizes, "path"), "path", "pos")
    return make_records(first_rows(numbered, quota, "row_id"), "text", label, source, subtopic)
