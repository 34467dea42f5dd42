"""Counts that the build reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_breakdown(df: DataFrame) -> DataFrame:
    """Rows per source, largest first."""
    return (df.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), "source"))
