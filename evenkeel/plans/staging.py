"""Shared-storage staging and size-checked small tables.

``stage`` cuts lineage with a written parquet table in the cluster's checkpoint folder: a lost
executor re-reads it instead of recomputing, and later steps read only the columns they need.
``pin`` turns a result that is expected to be small into driver-known rows - after checking - so
that broadcasting it has a proven bound; larger results are staged instead.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# A pinned table holds group keys and a few longs.
PIN_ROWS = 20_000
PIN_BYTES = 8 << 20
SALTS = 64
NARROW = ("bigint", "int", "smallint", "tinyint", "date", "timestamp", "double", "float")


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder named by the session; a temporary one only in local mode."""
    try:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    except PySparkException:
        configured = None
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="evenkeel-")
    spark.sparkContext.setCheckpointDir(own)
    return own


_area: ContextVar[str | None] = ContextVar("staging area", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in shared storage, inside the current staging area if there is one."""
    return f"{_area.get() or shared_dir(spark) + '/evenkeel'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_area(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder that everything staged inside lies in; whoever asked for it removes it with ``delete_path``."""
    path = scratch_path(spark, name)
    token = _area.set(path)
    try:
        yield path
    finally:
        _area.reset(token)


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end; nothing lazy may outlive it."""
    with scratch_area(spark, "run") as path:
        try:
            yield
        finally:
            delete_path(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and return the table read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Tables:
    """Staged tables by name; one that is put under a name again, or dropped, is removed from storage.

    For steps that write much and need little of it for long: the tables of a round, or of a stage before the next.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """``stage``, then remove the table that had the name. ``df`` may still read that one."""
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables; frames that read them are of no use any more."""
        for name in names:
            if name in self.paths:
                delete_path(self.spark, self.paths.pop(name))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote, through the file system that holds it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def copy_beginning(spark: SparkSession, path: str, to: str, share: float) -> None:
    """Copy the first part of one file, as an interrupted copy would leave it."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    size = int(files.getFileStatus(source).getLen() * share)
    begun, ended = files.open(source), files.create(target)
    try:
        spark._jvm.org.apache.commons.io.IOUtils.copyLarge(begun, ended, 0, size)
    finally:
        begun.close()
        ended.close()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of everything below a folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.getContentSummary(hadoop_path).getLength()


@dataclass
class Pinned:
    """A small-table candidate: ``small`` says that its size was checked and it may be broadcast.

    ``rows`` are the table's rows where they are known to the driver.
    """

    df: DataFrame
    small: bool
    rows: list | None = None

    def extent(self, column: str) -> tuple:
        """Smallest and largest value of a column; nulls for an empty table."""
        if self.rows is None:
            return tuple(self.df.agg(F.min(column), F.max(column)).first())
        values = [r[column] for r in self.rows]
        return (min(values), max(values)) if values else (None, None)


def local_table(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """A literal table; through Arrow, so that the plan holds the rows and needs no Python worker."""
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema=schema)


def pin(df: DataFrame, name: str, max_rows: int | None = None) -> Pinned:
    """Compute ``df`` now. Up to ``max_rows`` rows come back as a literal table, more are staged."""
    max_rows = PIN_ROWS if max_rows is None else max_rows
    rows = df.take(max_rows + 1)
    width = sum(len(v) if isinstance(v, str) else 8 for row in rows for v in row)
    if len(rows) <= max_rows and width <= PIN_BYTES:
        return Pinned(local_table(df.sparkSession, rows, df.schema), True, rows)
    return Pinned(stage(df, name), False)


def look_up(big: DataFrame, table: Pinned, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join ``big`` with a per-key table; keys are unique in the table, null matches null.

    A checked small table is broadcast. Any other is replicated over salts, so that the rows of one
    hot key spread over ``SALTS`` tasks instead of meeting in one, and is never broadcast: Spark takes the
    copies for one row.
    """
    side = table.df.select(*[F.col(c).alias(f"_k_{c}") if c in on else F.col(c)
                             for c in table.df.columns])
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    keys = [f"_k_{c}" for c in on]
    if table.small:
        return big.join(F.broadcast(side), condition, how).drop(*keys)
    # Narrow columns spread the rows; texts are hashed only where a table has nothing else.
    narrow = [c for c, kind in big.dtypes if c not in on and kind in NARROW] or [
        c for c, kind in big.dtypes if not kind.startswith("map")]
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*narrow), F.lit(SALTS)).cast("int"))
    spread = side.withColumn("_k_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = salted.join(spread.hint("merge"), condition & (F.col("_salt") == F.col("_k_salt")), how)
    return joined.drop(*keys, "_salt", "_k_salt")
