"""Row numbers, seats, counts and attempts that are found without moving or repeating the rows themselves."""

import random
import re
import time
from collections import Counter
from functools import partial

import pytest
from pyspark.sql import functions as F
from test_balance_split import frame_of, seats
from test_build import fixed
from test_sources import write_xml

from evenkeel.operators import balance, numbering, ranking
from evenkeel.plans import corpus, raw_zone, staging
from evenkeel.plans.notes import noting, numbers
from evenkeel.plans.registry import Inputs, Source, default_sources
from evenkeel.session import own_session
from evenkeel.sources import qa_xml, tables, templates


@pytest.fixture
def shuffled(monkeypatch):
    """The columns of every exchange below a staged or pinned table, and of the frames given."""
    seen = []

    def look(frame):
        plan = frame._jdf.queryExecution().optimizedPlan().toString() + frame._jdf.queryExecution().sparkPlan().toString()
        physical = frame._jdf.queryExecution().executedPlan()
        seen.extend(_exchanged(physical))
        return plan

    original = staging.stage

    def stage(df, name):
        look(df)
        return original(df, name)

    for module in (staging, qa_xml, numbering):
        monkeypatch.setattr(module, "stage", stage)
    return look, seen


def _exchanged(plan):
    out = []
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.inputPlan()
    if "ShuffleExchange" in plan.getClass().getSimpleName():
        out.append(plan.output().mkString(","))
    children = plan.children()
    for i in range(children.size()):
        out += _exchanged(children.apply(i))
    return out


def test_running_sums(spark):
    draw = random.Random(4)
    rows = [(f"k{i:04d}", draw.randrange(0, 9)) for i in range(500)]
    frame = spark.createDataFrame(draw.sample(rows, 500), "k string, n bigint").repartition(7)
    total, want = 0, {}
    for k, n in rows:
        want[k], total = total, total + n
    got = {r["k"]: r["before"] for r in numbering.running_sums(frame, ["k"], "n").collect()}
    assert got == want
    assert numbering.running_sums(frame.filter("false"), ["k"], "n").isEmpty()


@pytest.mark.parametrize("batch", ["3", "1000"])
def test_csv_rows_are_numbered_without_a_shuffle_of_text(spark, tmp_path, shuffled, batch):
    look, exchanged = shuffled
    for f in range(4):
        lines = [f'"file {f}\nrow {i}"' if i % 4 else "" for i in range(11)]
        (tmp_path / f"{f}.csv").write_text("id,description\n" + "".join(f"{i},{t}\n" for i, t in enumerate(lines)))
    want = [f"file {f}\nrow {i}" for f in range(4) for i in range(11) if i % 4]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        for most in (None, 0, 1, 8, 20, 500):
            found = tables.read_csv_texts(spark, str(tmp_path), ["transcription", "description"], most)
            look(found)
            rows = found.orderBy("row_id").collect()
            assert [r["text"] for r in rows] == want[:most] and [r["row_id"] for r in rows] == list(range(len(rows)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert exchanged and not any(re.search(r"\btext#", e) for e in exchanged), exchanged


def test_files_behind_the_cut_are_not_read(spark, tmp_path):
    for f in range(3):
        (tmp_path / f"{f}.csv").write_text("description\n" + "".join(f"text {f} {i}\n" for i in range(5)))
    found = tables.read_csv_texts(spark, str(tmp_path), ["description"], 7)
    touched = found.select(F.col("text")).collect()
    assert len(touched) == 7
    scan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"file_path.*<=", scan)


def test_xml_files_are_counted_in_the_pass_that_reads_them(spark, tmp_path, shuffled):
    look, exchanged = shuffled
    write_xml(tmp_path)
    for i in range(3):
        (tmp_path / f"cut{i}.xml").write_text("<QAPairs><QAPair><Question>q</Question><Answer>lost</Answer></QAPair>")
    files = qa_xml.scan_xml(spark, str(tmp_path))
    with noting() as heard:
        found = qa_xml.qa_records(files, 3, 1, "qa")
        look(found)
        rows = found.orderBy("row_id").collect()
    every = qa_xml.extract_pairs(files).orderBy("path", "pos").collect()
    assert [r["text"] for r in rows] == [r["text"] for r in every[:3]] and "lost" not in {r["text"] for r in every}
    said, paths = numbers(heard), list(tmp_path.rglob("*.xml"))
    assert said["files_read"] + said["files_rejected"] == len(paths) and said["files_rejected"] >= 3
    assert said["pairs_found"] >= len(every)
    assert not any(re.search(r"\b(text|q|a)#", e) for e in exchanged), exchanged
    source = Source("qa", 1, 3, lambda s: qa_xml.qa_records(qa_xml.scan_xml(s, str(tmp_path)), 3, 1, "qa"))
    report, = raw_zone.run_sources(spark, [source], str(tmp_path / "zone"))
    assert report.status == "built" and report.notes == said


def test_file_with_more_pairs_than_a_batch(spark, monkeypatch):
    monkeypatch.setattr(qa_xml, "AT_ONCE", 3)
    pairs = "".join(f"<QAPair><Question>q{i}</Question><Answer>a{i}</Answer></QAPair>" for i in range(10))
    files = spark.createDataFrame([("f", f"<x>{pairs}</x>".encode())], "path string, content binary")
    assert [r["pos"] for r in qa_xml.extract_pairs(files).orderBy("pos").collect()] == list(range(10))


# --- seats --------------------------------------------------------------------------------------

def test_seats_of_very_many_strata(spark, monkeypatch):
    """More strata than are sorted at once: the last seat is found by narrowing."""
    monkeypatch.setattr(balance, "locate_cuts", partial(ranking.locate_cuts, rank_at_most=20, buckets=8))
    draw = random.Random(8)
    sizes = {f"{i % 2}_s{i}": draw.choice([1, 1, 2, 3, 40, 900]) for i in range(400)}
    frame = spark.createDataFrame(list(sizes.items()), "stratum string, rows bigint")
    got = {r["stratum"]: r for r in balance.split_targets(frame).collect()}
    total = sum(sizes.values())
    train = seats(sizes, total * 4 // 5)
    val = seats({s: n - train[s] for s, n in sizes.items()}, (total - total * 4 // 5) // 2)
    assert {s: r["train"] for s, r in got.items()} == train and {s: r["val"] for s, r in got.items()} == val
    assert balance.split_targets(frame.filter("false")).isEmpty()
    windows = re.findall(r"Window.*", balance.split_targets(frame)._jdf.queryExecution().optimizedPlan().toString())
    assert not windows


@pytest.mark.parametrize("drawn", [0, 1, 7, 59, 60])
def test_seats_add_up(spark, drawn):
    sizes = {"a": 20, "b": 20, "c": 19, "d": 1, "e": 0}
    frame = spark.createDataFrame(list(sizes.items()), "stratum string, n bigint")
    got = {r["stratum"]: r["k"] for r in balance.with_seats(frame, "n", drawn, "k").collect()}
    assert got == seats(sizes, drawn)


def test_repeated_ids_at_a_cut_are_an_error(spark):
    rows = spark.createDataFrame([(i // 2,) for i in range(40)], "id bigint")
    with pytest.raises(Exception, match="repeated"):
        ranking.first_n(rows, 7, F.col("id"), "id").collect()
    assert ranking.first_n(rows, 8, F.col("id"), "id").count() == 8


# --- counts -------------------------------------------------------------------------------------

def test_counts_read_the_records_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    rows = [(f"text {i % 30} " + "x" * (i % 3 * 20), i % 2, f"s{i % 5}", None, i) for i in range(200)]
    raw = spark.createDataFrame(rows, "text string, label bigint, source string, subtopic string, ord bigint")
    built = corpus.build(raw.mapInPandas(count, raw.schema))
    counted = Counter()
    for r in built.counts().collect():
        counted[r["stage"]] += r["rows"]
    assert reads.value == 200 and counted["combined"] == 200
    assert counted["cleaned"] == built.cleaned.count() < 200 and counted["deduplicated"] == built.kept.count()
    assert counted["balanced"] == built.balanced().count() == sum(counted[s] for s in balance.SPLITS)
    want = Counter((r["split"], r["source"], r["label"]) for r in built.rows().collect())
    got = {(r["stage"], r["source"], r["label"]): r["rows"] for r in built.counts().collect() if r["stage"] in balance.SPLITS}
    assert got == dict(want)


# --- sources side by side -----------------------------------------------------------------------

def test_sources_do_not_share_settings(spark, tmp_path):
    name, seen = "spark.sql.shuffle.partitions", {}

    def collect(session, mine):
        session.conf.set(name, str(mine))
        time.sleep(0.5)
        seen[mine] = session.conf.get(name)
        return fixed(f"s{mine}", 1, 3).collect(session)

    before = spark.conf.get(name)
    sources = [Source(f"s{n}", 1, 3, lambda s, n=n: collect(s, n)) for n in (11, 12, 13)]
    start = time.monotonic()
    report = raw_zone.run_sources(spark, sources, str(tmp_path))
    assert [r.status for r in report] == ["built"] * 3 and [r.name for r in report] == ["s11", "s12", "s13"]
    assert seen == {11: "11", 12: "12", 13: "13"} and spark.conf.get(name) == before
    assert time.monotonic() - start < 60
    mine = own_session(spark)
    assert mine.conf.get(name) == before and mine.sparkContext is spark.sparkContext


def test_a_stuck_source_is_cancelled_alone(spark, tmp_path):
    def slow(session):
        def wait(batches):
            for batch in batches:
                time.sleep(60)
                yield batch
        return fixed("stuck", 1, 3).collect(session).mapInPandas(wait, "text string, label bigint, source string, subtopic string, row_id bigint")

    sources = [Source("stuck", 1, 3, slow), fixed("fine", 0, 4), fixed("also", 0, 2)]
    start = time.monotonic()
    report = raw_zone.run_sources(spark, sources, str(tmp_path), patience=8, at_once=2)
    assert [r.status for r in report] == ["failed", "built", "built"] and "cancelled after 8" in report[0].error
    assert time.monotonic() - start < 50
    assert raw_zone.load_partial(spark, str(tmp_path), "fine").count() == 4


def test_shuffles_of_a_source_fit_its_inputs(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr("evenkeel.session.SHUFFLE_BYTES", 1000)
    (tmp_path / "in").write_bytes(b"x" * 64_000)

    def collect(session):
        seen.append(int(session.conf.get("spark.sql.shuffle.partitions")))
        return fixed("s", 1, 2).collect(session)

    raw_zone.run_sources(spark, [Source("s", 1, 2, collect, [str(tmp_path / "in")])], str(tmp_path / "zone"))
    assert seen == [64]


def test_unknown_quotas_are_an_error():
    paths = Inputs(*["x"] * 10)
    with pytest.raises(ValueError, match="news"):
        default_sources(paths, {"news": 3})
    assert [s.quota for s in default_sources(paths, {"agnews": 3}) if s.name == "agnews"] == [3]


# --- templates ----------------------------------------------------------------------------------

@pytest.mark.parametrize("quota", [1, 40, 700])
def test_rounds_of_attempts_give_the_rows_of_all_attempts(spark, quota):
    words = templates.Vocabulary()
    whole = templates.generate(spark.range(quota * 20).withColumnRenamed("id", "attempt"), words)
    want = sorted((r["a"], r["text"]) for r in whole.groupBy("text").agg(F.min("attempt").alias("a")).collect())[:quota]
    got = templates.template_records(spark, quota, 1, "t", words=words).collect()
    assert sorted((r["row_id"], r["text"]) for r in got) == want
    texts, attempts = templates.distinct_texts(quota, words, spark)
    assert attempts < quota * 20 and texts.count() >= quota


def test_attempts_end_where_texts_run_out(spark):
    words = templates.Vocabulary(templates=["{symptom} {duration}"], questions=["q"], symptoms=["a", "b"], durations=["c"])
    texts, attempts = templates.distinct_texts(50, words, spark)
    assert attempts == 1000 and texts.count() == 3
    assert templates.template_records(spark, 50, 1, "t", words=words).count() == 3
