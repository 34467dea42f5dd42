"""Record schema and the explicit row order.

A record is ``text, label, source, subtopic``. Dedup keeps the first record, and Spark rows have
no order, so every record also carries ``row_id`` (its order inside the source) and, once sources
are combined, ``ord``: source priority and row id packed into one BIGINT. One fixed-width key keeps
every min/min_by in hash aggregation and makes the late text join a plain long equi-join.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_COLUMNS = ["text", "label", "source", "subtopic"]

RECORD_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("label", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("subtopic", T.StringType()),
])

# What a source hands over: the record and its place inside the source.
SOURCE_SCHEMA = T.StructType(RECORD_SCHEMA.fields + [T.StructField("row_id", T.LongType())])

ROW_ID_BITS = 55  # 2**55 rows per source, 256 sources
PRIORITY_BITS = 8


def pack(*fields: tuple[Column, int]) -> Column:
    """Pack (non-negative integer, bits) fields into one BIGINT that sorts like the tuple.

    A value that does not fit fails the job rather than changing the order silently.
    """
    packed, fits = F.lit(0).cast("bigint"), F.lit(True)
    for value, bits in fields:
        long = value.cast("bigint")
        packed = F.shiftleft(packed, bits).bitwiseOR(long)
        fits = fits & long.between(0, (1 << bits) - 1)
    error = F.raise_error(F.lit("an order field is null or does not fit its bits")).cast("bigint")
    return F.when(fits, packed).otherwise(error)


def pack_ord(priority: Column, row_id: Column) -> Column:
    """Source priority, then row id."""
    return pack((priority, PRIORITY_BITS), (row_id, ROW_ID_BITS))


def to_source_rows(df: DataFrame) -> DataFrame:
    """Project to the source schema, in order and with its types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in SOURCE_SCHEMA.fields])
