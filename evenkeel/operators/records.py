"""Wrapping raw texts as records, and putting sources together."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.text import fence, strip
from evenkeel.schema import RECORD_COLUMNS, pack_ord, to_source_rows


def make_records(df: DataFrame, text: Column | str, label: int, source: str,
                 subtopic: str | None = None, row_id: Column | str = "row_id") -> DataFrame:
    """Strip, drop null and blank texts, attach the constants of the source."""
    raw = F.col(text) if isinstance(text, str) else text
    place = F.col(row_id) if isinstance(row_id, str) else row_id
    texts = fence(df.select(raw.alias("_raw"), place.alias("row_id")), text=strip(F.col("_raw")))
    return to_source_rows(
        texts.filter(F.col("text") != "")
        .withColumns({"label": F.lit(label), "source": F.lit(source),
                      "subtopic": F.lit(subtopic).cast("string")}))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def combine_sources(frames: list[DataFrame]) -> DataFrame:
    """Union record frames in priority order, the position in the list giving the priority."""
    if not frames:
        raise ValueError("no source produced any data, nothing to combine")
    return union_all([
        df.select(*RECORD_COLUMNS, pack_ord(F.lit(i), F.col("row_id")).alias("ord"))
        for i, df in enumerate(frames)])


def first_seen(df: DataFrame, value: str, place: str) -> DataFrame:
    """Distinct values with the place of their first occurrence (partial aggregation, no window)."""
    return df.groupBy(value).agg(F.min(place).alias(place))
