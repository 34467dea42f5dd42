"""Replacement of stored folders: whatever dies, wherever, readers have the old rows or the new ones."""

import threading

import pytest
from pyspark.sql import functions as F

from evenkeel.plans import raw_zone, versions
from evenkeel.plans.build import load_splits, save_splits, splits_path
from evenkeel.plans.registry import Source
from evenkeel.schema import SOURCE_SCHEMA


def records(spark, text, n=4):
    return spark.createDataFrame([(f"{text} {i}", 1, "s", None, i) for i in range(n)], SOURCE_SCHEMA)


def stored(spark, root):
    return {r["text"].split()[0] for r in raw_zone.load_partial(spark, root, "s").collect()}


class Killed(BaseException):
    """The driver is gone: nothing after this runs, no clean-up either."""


class Dying:
    """Lets so many file operations through and none after."""

    def __init__(self, monkeypatch, lives):
        self.lives, self.done = lives, []
        for name in ("names", "make", "create", "delete"):
            monkeypatch.setattr(versions.Folder, name, self.counted(name, getattr(versions.Folder, name)))

    def counted(self, name, step):
        def run(folder, *args):
            if len(self.done) >= self.lives:
                raise Killed
            self.done.append(name)
            return step(folder, *args)
        return run


def test_killed_between_any_two_file_operations(spark, tmp_path):
    lives, seen = 0, []
    while True:
        root = str(tmp_path / f"zone{lives}")
        for text in ("oldest", "older", "old"):  # so that the next save has something to sweep
            raw_zone.save_partial(records(spark, text), root, "s")
        with pytest.MonkeyPatch.context() as patch:
            dying = Dying(patch, lives)
            try:
                raw_zone.save_partial(records(spark, "new"), root, "s")
                finished = True
            except Killed:
                finished = False
        found = stored(spark, root)
        assert found == ({"new"} if "create" in dying.done else {"old"}), (lives, dying.done)
        seen.append(found)
        raw_zone.save_partial(records(spark, "next"), root, "s")
        assert stored(spark, root) == {"next"}
        if finished:
            break
        lives += 1
    assert {"old"} in seen and {"new"} in seen and lives > 5
    assert {"create", "delete", "names", "make"} == set(dying.done)


def test_killed_while_writing(spark, tmp_path):
    """Files of a version without its commit are nothing to a reader, also before the first version."""
    root = str(tmp_path / "zone")
    for before in (set(), {"old"}):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(versions.Folder, "create", lambda *_: (_ for _ in ()).throw(Killed()))
            with pytest.raises(Killed):
                raw_zone.save_partial(records(spark, "new"), root, "s")
        assert stored(spark, root) == before
        if not before:
            raw_zone.save_partial(records(spark, "old"), root, "s")
    folder = tmp_path / "zone" / "source=s"
    left = [p for p in folder.iterdir() if p.name.startswith("v")]
    assert len(left) == 3
    versions.sweep(spark, str(folder))
    assert len([p for p in folder.iterdir() if p.name.startswith("v")]) == 3  # they may still be being written
    versions.sweep(spark, str(folder), leftover_seconds=0)
    assert len([p for p in folder.iterdir() if p.name.startswith("v")]) == 1 and stored(spark, root) == {"old"}


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    root = str(tmp_path)
    raw_zone.save_partial(records(spark, "first"), root, "s")
    reading = raw_zone.load_partial(spark, root, "s")
    raw_zone.save_partial(records(spark, "second"), root, "s")
    assert {r["text"].split()[0] for r in reading.collect()} == {"first"}
    for text in ("third", "fourth"):
        raw_zone.save_partial(records(spark, text), root, "s")
    kept = [p.name for p in (tmp_path / "source=s").iterdir() if p.name.startswith("v")]
    assert len(kept) == versions.KEPT and stored(spark, root) == {"fourth"}
    one = [Source("s", 1, 4, None)]
    assert {r["source"] for r in raw_zone.combine(spark, one, root).collect()} == {"s"}


def test_a_sweep_that_fails_costs_space_only(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for text in ("a", "b"):
        raw_zone.save_partial(records(spark, text), root, "s")
    monkeypatch.setattr(versions.Folder, "delete", lambda *_: (_ for _ in ()).throw(OSError("no")))
    with pytest.warns(UserWarning, match="later sweep"):
        raw_zone.save_partial(records(spark, "c"), root, "s")
    assert stored(spark, root) == {"c"}


def test_two_writers(spark, tmp_path):
    root, errors = str(tmp_path), []

    def save(text):
        try:
            raw_zone.save_partial(records(spark, text), root, "s")
        except Exception as error:
            errors.append(error)

    writers = [threading.Thread(target=save, args=(t,)) for t in ("x", "y")]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not errors and stored(spark, root) in ({"x"}, {"y"})


def test_splits_are_versions_too(spark, tmp_path):
    folder = f"{tmp_path}/final"
    with pytest.raises(FileNotFoundError):
        load_splits(spark, folder)
    rows = records(spark, "a").withColumn("split", F.lit("train"))
    save_splits(rows, folder)
    first = splits_path(spark, folder)
    save_splits(rows.filter("row_id < 3"), folder)
    assert load_splits(spark, folder).count() == 3 and splits_path(spark, folder) > first
    assert spark.read.option("header", True).csv(first).count() == 4


def test_tables_are_removed_when_they_are_replaced(spark):
    from pathlib import Path

    from evenkeel.plans.staging import Tables
    tables = Tables(spark)
    first = tables.put(spark.range(3), "t")
    where = Path(tables.paths["t"].removeprefix("file:"))
    second = tables.put(first.selectExpr("id + 1 as id"), "t")
    assert sorted(r["id"] for r in second.collect()) == [1, 2, 3] and not where.exists()
    where = Path(tables.paths["t"].removeprefix("file:"))
    tables.drop("t", "none")
    assert not where.exists()
