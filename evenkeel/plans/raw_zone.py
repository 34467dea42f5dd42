"""The stored records of every source, one folder per source.

Each source is written on its own, so that one that fails costs only itself, and a later run builds
only what is missing. A folder holds versions (``versions``): a rebuild that dies keeps the rows it was to replace.
Reading prunes to the newest versions of the wanted sources.
"""

import time
import uuid
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from contextvars import copy_context
from dataclasses import dataclass, field
from math import inf

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.plans.notes import noting, numbers
from evenkeel.plans.registry import Source
from evenkeel.plans.staging import stored_bytes
from evenkeel.plans.versions import current, new_version
from evenkeel.schema import (
    RECORD_COLUMNS, RECORD_SCHEMA, SOURCE_SCHEMA, pack_ord, to_source_rows)
from evenkeel.session import own_session, sized_shuffles, spread
from evenkeel.sources.tables import file_name, number_lines, read_csv

AT_ONCE = 4  # sources that are built side by side
LOOK_SECONDS = 0.2  # between two looks for late ones
STORED_SCHEMA = T.StructType([f for f in SOURCE_SCHEMA.fields if f.name != "source"])


def source_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/source={name}"


def save_partial(records: DataFrame, root: str, name: str) -> str:
    """Replace the stored records of one source once the new ones are written. Others are not touched."""
    path = source_path(root, name)
    with new_version(records.sparkSession, path) as new:
        to_source_rows(records).drop("source").write.parquet(new)
    return path


def load_partial(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The stored records of a source; an empty table when there are none."""
    path = current(spark, source_path(root, name))
    if path is None:
        return spark.createDataFrame([], SOURCE_SCHEMA)
    stored = spark.read.schema(STORED_SCHEMA).parquet(path)
    return to_source_rows(stored.withColumn("source", F.lit(name)))


def import_csv(spark: SparkSession, path: str, root: str, name: str) -> str:
    """Store a source's records from a CSV with header and the record columns, in file order."""
    numbered = number_lines(read_csv(spark, path, RECORD_SCHEMA).select(*RECORD_COLUMNS, file_name()))
    return save_partial(numbered.withColumn("source", F.lit(name)), root, name)


def has_rows(spark: SparkSession, root: str, name: str) -> bool:
    return not load_partial(spark, root, name).select("row_id").isEmpty()


@dataclass
class SourceStatus:
    """What a run did with a source: ``built``, ``reused``, ``empty`` or ``failed``.

    ``notes`` has what the source counted on the way, such as the files it read and rejected.
    """

    name: str
    status: str
    error: str | None = None
    notes: dict[str, int] = field(default_factory=dict)


def _build(spark: SparkSession, source: Source, root: str, group: str) -> SourceStatus:
    """Collect and store one source in a session and a job group of its own."""
    session = own_session(spark)
    session.sparkContext.setJobGroup(group, f"source {source.name}", interruptOnCancel=True)
    try:
        size = sum(stored_bytes(session, path) for path in source.inputs)
        with noting() as heard, sized_shuffles(session, size):
            save_partial(source.collect(session), root, source.name)
        status = "built" if has_rows(session, root, source.name) else "empty"
        return SourceStatus(source.name, status, notes=numbers(heard))
    except Exception as error:  # whatever it is, it costs this source only
        return SourceStatus(source.name, "failed", str(error))


def run_sources(spark: SparkSession, sources: list[Source], root: str, force: bool = False,
                only: list[str] | None = None, at_once: int = AT_ONCE,
                patience: float | None = None) -> list[SourceStatus]:
    """Build the sources that have no stored rows, or all when forced, a few at a time.

    A failing source is reported and the rest goes on; one that takes longer than ``patience`` seconds from its start
    has its jobs cancelled, and only its own. A source that stored no rows counts as missing, so the next
    run tries it again. The report is in the order of ``sources``.
    """
    report: dict[str, SourceStatus] = {}
    wanted = [s for s in sources if not only or s.name in only]
    missing = []
    for source in wanted:
        if not force and has_rows(spark, root, source.name):
            report[source.name] = SourceStatus(source.name, "reused")
        else:
            missing.append(source)
    run, started = uuid.uuid4().hex, {}

    def build(source: Source) -> SourceStatus:
        started[source.name] = time.monotonic()
        return _build(spark, source, root, f"{run}-{source.name}")

    with ThreadPoolExecutor(max(1, min(at_once, len(missing))), thread_name_prefix="source") as pool:
        going = {pool.submit(copy_context().run, build, s): s for s in missing}
        late = set()
        while going:
            done, _ = wait(going, timeout=None if patience is None else LOOK_SECONDS, return_when=FIRST_COMPLETED)
            for future in done:
                source = going.pop(future)
                status = future.result()
                if source.name in late and status.status == "failed":
                    status.error = f"cancelled after {patience} seconds: {status.error}"
                report[source.name] = status
            for source in going.values():
                if patience is not None and time.monotonic() - started.get(source.name, inf) > patience:
                    late.add(source.name)
                    spark.sparkContext.cancelJobGroup(f"{run}-{source.name}")
    return [report[s.name] for s in wanted]


def combine(spark: SparkSession, sources: list[Source], root: str) -> DataFrame:
    """All stored records with ``ord``; the list of sources gives the priority.

    One scan over the source folders, the priority looked up from the folder name.
    """
    stored = [i for i, s in enumerate(sources) if has_rows(spark, root, s.name)]
    if not stored:
        raise RuntimeError("no source produced any data, nothing to combine")
    scan = (spark.read.schema(SOURCE_SCHEMA).option("basePath", root)
            .parquet(*[current(spark, source_path(root, sources[i].name)) for i in stored]))
    priority = F.create_map(*[F.lit(v) for i in stored for v in (sources[i].name, i)])
    return spread(scan).select(*RECORD_COLUMNS,
                               pack_ord(priority[F.col("source")], F.col("row_id")).alias("ord"))
