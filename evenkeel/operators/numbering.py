"""Row numbers and running sums in a given order, without moving the rows that are numbered.

A row's number is where its file begins plus its place in the file. Places are counted while a file is read, in the
one task that reads it; where files begin is a running sum over one narrow row per file. So a text is
never shuffled to be numbered, and a cut at the n-th row leaves the files behind it unread.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.plans.staging import Pinned, local_table, look_up, pin, stage

BASE_SCHEMA = T.StructType([T.StructField("_base_part", T.IntegerType()), T.StructField("_base", T.LongType())])


def running_sums(rows: DataFrame, order: list[str], amount: str, name: str = "before") -> DataFrame:
    """Add the sum of ``amount`` over all rows before each in ``order``, a strict total order of narrow rows.

    Ranges of the order are summed by themselves, and each is offset by the sums of the ranges before it: one
    number per shuffle partition is all that the driver sees.
    """
    ranged = stage(stage(rows, "unranged").repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_part").agg(F.sum(amount).alias("total")).orderBy("_part").collect()
    bases = np.cumsum([0, *[r["total"] or 0 for r in totals]])[:-1].tolist()
    base = local_table(rows.sparkSession, [(r["_part"], b) for r, b in zip(totals, bases)], BASE_SCHEMA)
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn(name, F.coalesce(F.sum(amount).over(before), F.lit(0)))
    return summed.join(F.broadcast(base), F.col("_part") == F.col("_base_part")).select(
        *rows.columns, (F.col(name) + F.col("_base")).cast("bigint").alias(name))


def with_place(rows: DataFrame, file: str = "_file", place: str = "_nth") -> DataFrame:
    """Add the place of every row among those of its file.

    ``rows`` is a scan of files that are not split, with nothing above it but projections and filters: one task
    meets all rows of a file, in order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            runs = batch[file].dictionary_encode() if not pa.types.is_dictionary(batch[file].type) else batch[file]
            codes, names = runs.indices.to_numpy(), runs.dictionary.to_pylist()
            nth = np.zeros(len(codes), np.int64)
            cuts = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1, [len(codes)]]).tolist()
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    name = names[codes[a]]
                    last, seen = name, seen if name == last else 0
                    nth[a:b] = np.arange(seen, seen + b - a)
                    seen += b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], [*batch.schema.names, place])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(place, T.LongType())]))


def file_starts(sizes: DataFrame, file: str, most: int | None = None) -> Pinned:
    """``file, before``: how many rows come before each file, in the order of their names.

    ``sizes`` has one row per file with ``rows``. With ``most``, only the files that hold the first so many rows.
    """
    starts = running_sums(sizes, [file], "rows").select(file, "before")
    return pin(starts if most is None else starts.filter(F.col("before") < most), "file-starts")


def number_in_files(rows: DataFrame, starts: Pinned, file: str, place: str, most: int | None = None) -> DataFrame:
    """Replace file and place by ``row_id``, and keep the first ``most`` rows if given. Map-side for few files."""
    numbered = look_up(rows, starts, [file]).withColumn("row_id", F.col("before") + F.col(place))
    if most is not None:
        numbered = numbered.filter(F.col("row_id") < most)
    return numbered.drop("before", file, place)
