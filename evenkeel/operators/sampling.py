"""Exact-size samples without replacement."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.config import SEED
from evenkeel.functions.draws import order_key
from evenkeel.operators.ranking import HASH_RANGE, first_n


def sample_exact(df: DataFrame, n: int, row_id: str, purpose: str = "sample",
                 groups: list[str] = (), seed: int = SEED) -> DataFrame:
    """Seeded shuffle, then the first ``min(n, size)`` rows - of the table or of every group.

    ``df.sample`` is approximate, so it does not qualify.
    """
    key = order_key(purpose, F.col(row_id), seed)
    return first_n(df, n, key, row_id, groups, HASH_RANGE)


def first_rows(df: DataFrame, n: int, row_id: str, groups: list[str] = ()) -> DataFrame:
    """The first ``n`` rows in source order, of the table or of every group."""
    return first_n(df, n, F.col(row_id), row_id, groups)


def topic_quota(target: int, topics: int) -> int:
    """Rows each topic may contribute."""
    return max(1, target // topics)


def halves(target: int) -> tuple[int, int]:
    """Quotas of the first and second table of a two-table source."""
    return target // 2, target - target // 2
