"""From combined records to the split corpus.

Records are read once. Texts are cleaned and written to shared storage with their keys. Every decision after that -
which rows survive dedup, balance and split - is taken on narrow columns, and so are all counts: a record whose text
the length gate rejects is kept in that table without it. Balance and split come out as
cuts, which decide any row map-side; so the texts outside the class cuts are dropped where they are
read, and only the rest is shuffled, once, to be joined with the dedup survivors.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.config import SEED
from evenkeel.functions.text import clean_and_mark, with_dedup_keys
from evenkeel.operators.balance import (
    SPLITS, SplitPlan, balance_cuts, in_balance, split_plan, with_split, within_balance)
from evenkeel.operators.dedup import dedup_groups, keep_rows
from evenkeel.operators.ranking import Cuts
from evenkeel.plans.staging import stage
from evenkeel.schema import RECORD_COLUMNS

NARROW = ["ord", "label", "source"]


@dataclass
class Corpus:
    """The result of one build. ``records`` and ``kept`` are staged tables; the rest is lazy."""

    records: DataFrame  # of all: record columns, ord, passed (the length gate), exact_key, prefix_key
    kept: DataFrame     # ord, label, source, exact_dropped, near_dropped
    class_cuts: Cuts | None
    splits: SplitPlan
    seed: int

    @property
    def cleaned(self) -> DataFrame:
        """Records that passed the gate."""
        return self.records.filter("passed").drop("passed")

    def counts(self) -> DataFrame:
        """``stage, source, label, rows``: combined, cleaned, deduplicated, balanced and each split.

        Two scans of narrow columns: one of all records, one of the survivors with what became of them.
        """
        groups = ["source", "label"]
        every = self.records.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("combined"), F.count_if("passed").alias("cleaned"))
        marked = in_balance(self.kept.select(*NARROW), self.class_cuts, seed=self.seed)
        split = with_split(marked, self.splits, seed=self.seed, how="left").withColumn(
            "split", F.when(F.col("balanced"), F.col("split")))
        left = split.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("deduplicated"), F.count_if("balanced").alias("balanced"),
            *[F.count_if(F.col("split") == name).alias(name) for name in SPLITS])
        return _per_stage(every, ["combined", "cleaned"]).unionByName(
            _per_stage(left, ["deduplicated", "balanced", *SPLITS]))

    def balanced(self) -> DataFrame:
        """Narrow rows after balancing."""
        return within_balance(self.kept.select(*NARROW), self.class_cuts, seed=self.seed)

    def assigned(self) -> DataFrame:
        """Narrow rows of the final corpus with their split."""
        return with_split(self.balanced(), self.splits, seed=self.seed)

    def rows(self) -> DataFrame:
        """The final corpus: record columns, ord and split."""
        texts = within_balance(self.cleaned.select(*RECORD_COLUMNS, "ord"), self.class_cuts,
                               seed=self.seed)
        return with_split(keep_rows(texts, self.balanced()), self.splits, seed=self.seed)


def _per_stage(counted: DataFrame, stages: list[str]) -> DataFrame:
    """One row per stage that has rows, from one column per stage."""
    listed = F.inline(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("rows")) for s in stages]))
    return counted.select("source", "label", listed).filter("rows > 0").select("stage", "source", "label", "rows")


def build(records: DataFrame, seed: int = SEED) -> Corpus:
    """Clean, deduplicate, balance and split records that carry ``ord``."""
    keyed = with_dedup_keys(clean_and_mark(records), cleaned=True)
    staged = stage(keyed.withColumn("passed", F.col("text").isNotNull()), "cleaned")
    cleaned = staged.filter("passed")
    kept = stage(cleaned.select(*NARROW).join(dedup_groups(cleaned), "ord"), "kept")
    narrow = kept.select(*NARROW)
    class_cuts = balance_cuts(narrow, seed=seed)
    splits = split_plan(within_balance(narrow, class_cuts, seed=seed), seed=seed)
    return Corpus(staged, kept, class_cuts, splits, seed)
