"""First-wins deduplication on an exact and a prefix key.

Rows are taken in ``ord`` order; a row is dropped as *exact* when its normalised text equals that of
a kept row and as *near* when only the prefix does. Equal texts have equal prefixes and both keys of
a kept row count as seen from then on, so the survivors are exactly the first row of every prefix
key, and a dropped row is exact if and only if it has the survivor's exact key.

Only ``ord`` and the two keys are aggregated. Counting first by (prefix, exact) and then by prefix
keeps a prefix that covers a third of all rows - boilerplate with ever different tails - from meeting
in one task: the second aggregation combines map-side to one row per task. All buffers are longs, so
both steps are hash aggregates without a sort. Texts move once, in the join on the unique ``ord``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.text import with_dedup_keys
from evenkeel.plans.staging import stage

KEYS = ["exact_key", "prefix_key"]


def dedup_groups(keyed: DataFrame, order: str = "ord") -> DataFrame:
    """One row per prefix key: the survivor's ``ord`` and the exact and near rows it displaces."""
    by_text = (keyed.select(F.unhex("prefix_key").alias("p"), F.unhex("exact_key").alias("e"), order)
               .groupBy("p", "e")
               .agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("c")))
    by_prefix = by_text.groupBy("p").agg(
        F.min("o").alias(order), F.min_by("c", "o").alias("same"), F.sum("c").alias("total"))
    return by_prefix.select(order, (F.col("same") - 1).alias("exact_dropped"),
                            (F.col("total") - F.col("same")).alias("near_dropped"))


def dedup_counters(groups: DataFrame) -> DataFrame:
    """One row: rows before, exact and near duplicates removed, rows kept."""
    exact, near = F.sum("exact_dropped"), F.sum("near_dropped")
    kept = F.count(F.lit(1))
    zero = F.lit(0).cast("bigint")
    return groups.agg((kept + F.coalesce(exact, zero) + F.coalesce(near, zero)).alias("before"),
                      F.coalesce(exact, zero).alias("exact"),
                      F.coalesce(near, zero).alias("near"), kept.alias("kept"))


def keep_rows(df: DataFrame, kept: DataFrame, order: str = "ord") -> DataFrame:
    """The rows of ``df`` whose ``ord`` is in ``kept``; unique on both sides, hence never skewed."""
    return df.join(kept.select(order), order, "left_semi")


def deduplicate(df: DataFrame, order: str = "ord", cleaned: bool = False) -> DataFrame:
    """Keep the first row of every prefix key.

    The keyed rows are staged: the decision reads three narrow columns of the table and the semi
    join the rest, instead of running the cleaning above it twice.
    """
    keyed = stage(with_dedup_keys(df, cleaned=cleaned), "keyed")
    return keep_rows(keyed, dedup_groups(keyed, order), order).select(*df.columns)
