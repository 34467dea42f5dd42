"""Folders whose content is replaced in one step that cannot be seen half done.

    folder/v000000007-<unique>/...      the files of a version
    folder/_versions/v000000007-<unique>    an empty file: this version is complete

A new version is written into a folder of its own while readers go on with the last complete one. Creating its
empty file is the only step that changes what readers find, and a create either happens or does not, on
object stores too, where a folder's rename is neither one step nor cheap. Wherever a driver dies, readers have the old
rows or the new ones. What it leaves behind is swept by a later save.
"""

import time
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from evenkeel.plans.staging import stored_bytes

COMMITS = "_versions"
KEPT = 2  # the newest, and the one before, which a reader may still be in the middle of
LEFTOVER_SECONDS = 24 * 3600  # a version without its file may still be being written for so long


class Folder:
    """The few file operations that versions need, in the file system that holds the folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> dict[str, float]:
        """What lies in the folder, with the time of its last change in seconds; nothing if there is no folder."""
        at = self._at(name)
        if not self._files.exists(at):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self._files.listStatus(at)}

    def make(self, name: str) -> None:
        self._files.mkdirs(self._at(name))

    def create(self, name: str) -> None:
        """An empty file; an error if it is there already."""
        self._files.create(self._at(name), False).close()

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)


def _complete(folder: Folder) -> list[str]:
    return sorted(folder.names(COMMITS))


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete version, None if there is none."""
    folder = Folder(spark, path)
    versions = _complete(folder)
    return f"{folder.path}/{versions[-1]}" if versions else None


def current_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Size of the newest versions of some folders."""
    return sum(stored_bytes(spark, at) for at in (current(spark, p) for p in paths) if at)


@contextmanager
def new_version(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to, which becomes the content of ``path`` when the block has succeeded.

    Of two writers that finish at the same time one wins, the same for every reader.
    """
    folder = Folder(spark, path)
    folder.make(COMMITS)
    last = _complete(folder)[-1:]
    number = int(last[0][1:].split("-")[0]) + 1 if last else 1
    name = f"v{number:09d}-{uuid.uuid4().hex}"
    try:
        yield f"{folder.path}/{name}"
        folder.create(f"{COMMITS}/{name}")
    except Exception:
        _try(folder.delete, name)
        raise
    _try(sweep, spark, path)


def sweep(spark: SparkSession, path: str, kept: int = KEPT, leftover_seconds: float = LEFTOVER_SECONDS) -> None:
    """Remove versions before the newest ``kept``, and those that were given up before they were complete.

    The file that says complete goes first: a sweep that dies leaves folders that nobody reads.
    """
    folder = Folder(spark, path)
    versions = _complete(folder)
    for name in versions[:-kept]:
        folder.delete(f"{COMMITS}/{name}")
        folder.delete(name)
    for name, changed in folder.names().items():
        if name.startswith("v") and name not in versions and time.time() - changed >= leftover_seconds:
            folder.delete(name)


def _try(step, *args) -> None:
    """Housekeeping: if it fails, it costs space and nothing else."""
    try:
        step(*args)
    except Exception as error:
        warnings.warn(f"left for a later sweep: {error}", stacklevel=3)
