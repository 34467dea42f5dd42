"""The full build: sources to raw zone, raw zone to split files and counts."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from evenkeel.config import SEED
from evenkeel.operators.dedup import dedup_counters
from evenkeel.operators.metrics import source_breakdown
from evenkeel.plans.corpus import build
from evenkeel.plans.raw_zone import SourceStatus, combine, run_sources, source_path
from evenkeel.plans.registry import Source
from evenkeel.plans.staging import staging_area
from evenkeel.plans.versions import current, current_bytes, new_version
from evenkeel.schema import RECORD_COLUMNS, RECORD_SCHEMA
from evenkeel.session import sized_shuffles
from evenkeel.sources.tables import read_csv


@dataclass
class BuildReport:
    """What the build did. ``counts`` has rows per stage, source and label."""

    sources: list[SourceStatus]
    empty_sources: list[str]
    counts: list = field(default_factory=list)
    dedup: dict = field(default_factory=dict)
    breakdown: list = field(default_factory=list)
    one_class: bool = False

    def rows(self, stage: str) -> int:
        return sum(r["rows"] for r in self.counts if r["stage"] == stage)


def save_splits(corpus_rows: DataFrame, folder: str) -> None:
    """One write of a new version of ``folder``, one sub-folder of CSV files with header per split.

    Quotes are doubled, as other CSV readers expect; leading and trailing spaces are kept.
    """
    with new_version(corpus_rows.sparkSession, folder) as new:
        (corpus_rows.select(*RECORD_COLUMNS, "split").write.partitionBy("split")
         .option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(new))


def load_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The saved corpus, with ``split``; ``splits_path`` has the files."""
    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField("split", T.StringType())])
    return read_csv(spark, splits_path(spark, folder), schema)


def splits_path(spark: SparkSession, folder: str) -> str:
    """Where the newest complete splits lie: one folder of CSV files each."""
    path = current(spark, folder)
    if path is None:
        raise FileNotFoundError(f"no splits have been saved in {folder}")
    return path


def build_corpus(spark: SparkSession, sources: list[Source], raw_root: str, out_folder: str,
                 force: bool = False, only: list[str] | None = None, skip_collect: bool = False,
                 seed: int = SEED) -> BuildReport:
    """Collect, combine, clean, deduplicate, balance, split and save.

    ``skip_collect`` works on what the raw zone holds; ``only`` and ``force`` choose the sources to
    build. The staged tables of the run are removed at the end.
    """
    with staging_area(spark):
        statuses = [] if skip_collect else run_sources(spark, sources, raw_root, force, only)
        records = combine(spark, sources, raw_root)
        with sized_shuffles(spark, current_bytes(
                spark, [source_path(raw_root, s.name) for s in sources])):
            corpus = build(records, seed)
            save_splits(corpus.rows(), out_folder)
            counts = corpus.counts().collect()  # sources x labels x stages
            present = {r["source"] for r in counts if r["stage"] == "combined"}
            return BuildReport(
                statuses, [s.name for s in sources if s.name not in present], counts,
                dedup_counters(corpus.kept).first().asDict(),
                source_breakdown(corpus.balanced()).collect(),
                len({r["label"] for r in counts if r["stage"] == "deduplicated"}) < 2)
