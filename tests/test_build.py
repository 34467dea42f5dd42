import random
from collections import Counter
from pathlib import Path

import pytest
from test_sources import write_xml

from evenkeel.config import MEDICAL_SEEDS, NON_MEDICAL_SEEDS, SOURCE_QUOTAS
from evenkeel.plans import raw_zone, run_queries
from evenkeel.plans.build import build_corpus, load_splits, splits_path
from evenkeel.plans.registry import Inputs, Source, default_sources
from evenkeel.plans.staging import shared_dir
from evenkeel.schema import RECORD_COLUMNS, SOURCE_SCHEMA


def sentence(rng, words=30):
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(words))


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """A small raw material for all ten sources."""
    root, rng = tmp_path_factory.mktemp("inputs"), random.Random(0)
    (root / "xml").mkdir()
    write_xml(root / "xml")
    quoted = [f'"{sentence(rng)}, ""said"" ' + "\n" + f'{i}"' for i in range(25)]
    (root / "notes.csv").write_text("id,transcription\n" + "".join(
        f"{i},{t}\n" for i, t in enumerate(quoted)))

    def save(name, rows, schema):
        path = str(root / name)
        spark.createDataFrame(rows, schema).write.parquet(path)
        return path

    shared = sentence(rng)
    edges = [(seed, f"title {seed} {i}", 0, i) for seed in MEDICAL_SEEDS + NON_MEDICAL_SEEDS
             for i in range(4)]
    return Inputs(
        abstracts=save("abstracts", [(t, p, "\n\n\n".join(sentence(rng) for _ in range(3)))
                                     for t in range(25) for p in range(2)],
                       "topic_no int, page_no int, raw string"),
        qa_folder=str(root / "xml"), notes_csv=str(root / "notes.csv"),
        edges=save("edges", edges, "category string, title string, ns int, pos bigint"),
        articles=save("articles", [(e[1], sentence(rng)) for e in edges], "title string, extract string"),
        question_pairs=save("pairs", [(i, sentence(rng, 8), shared) for i in range(20)],
                            "row_id bigint, question_1 string, question_2 string"),
        news=save("news", [(i, sentence(rng)) for i in range(120)] + [(120, shared.upper())],
                  "row_id bigint, text string"),
        forum=save("forum", [(i, sentence(rng), "sci.med" if i % 3 == 0 else "rec.autos")
                             for i in range(60)], "row_id bigint, text string, category string"),
        product_reviews=save("amazon", [(i, "title", sentence(rng)) for i in range(50)],
                             "row_id bigint, title string, content string"),
        business_reviews=save("yelp", [(i, sentence(rng)) for i in range(50)],
                              "row_id bigint, text string"))


QUOTAS = {"pubmed": 100, "synthetic_casual": 40, "amazon_yelp": 61}


@pytest.fixture(scope="module")
def built(spark, inputs, tmp_path_factory):
    root = tmp_path_factory.mktemp("build")
    sources = default_sources(inputs, QUOTAS)
    report = build_corpus(spark, sources, str(root / "raw"), str(root / "final"))
    return sources, root, report


def test_full_build(spark, built):
    sources, root, report = built
    assert [s.name for s in sources] == [name for name, _, _ in SOURCE_QUOTAS]
    assert {s.status for s in report.sources} == {"built"}, report.sources
    assert report.empty_sources == [] and not report.one_class
    by_source = Counter()
    for r in report.counts:
        if r["stage"] == "combined":
            by_source[r["source"]] += r["rows"]
    assert by_source == {"pubmed": 100, "medquad": 5, "mtsamples": 25, "wikipedia_medical": 28,
                         "medquestionpairs": 21, "synthetic_casual": 40, "agnews": 121,
                         "newsgroups20": 40, "amazon_yelp": 61, "wikipedia_nonmedical": 28}
    assert report.dedup["before"] == report.rows("cleaned")
    assert report.dedup["kept"] == report.rows("deduplicated")
    assert report.dedup["exact"] >= 1
    balanced = Counter()
    for r in report.counts:
        if r["stage"] == "balanced":
            balanced[r["label"]] += r["rows"]
    assert balanced[0] == balanced[1]
    n = report.rows("balanced")
    assert report.rows("train") == n * 4 // 5
    assert report.rows("val") == (n - n * 4 // 5) // 2
    assert sum(r["rows"] for r in report.breakdown) == n
    assert [r["rows"] for r in report.breakdown] == sorted((r["rows"] for r in report.breakdown),
                                                           reverse=True)


def test_saved_splits(spark, built):
    _, root, report = built
    saved = load_splits(spark, str(root / "final"))
    assert saved.columns == [*RECORD_COLUMNS, "split"]
    counts = {r["split"]: r["count"] for r in saved.groupBy("split").count().collect()}
    assert counts == {s: report.rows(s) for s in ("train", "val", "test")}
    final = Path(splits_path(spark, str(root / "final")))
    train = next((final / "split=train").glob("*.csv")).read_text()
    assert train.splitlines()[0] == "text,label,source,subtopic"
    import pandas as pd
    files = list((final / "split=train").glob("*.csv"))
    assert sum(len(pd.read_csv(f)) for f in files) == counts["train"]


def test_text_in_two_sources_keeps_the_first_label(spark, built):
    sources, root, _ = built
    shared = raw_zone.load_partial(spark, str(root / "raw"), "medquestionpairs").orderBy("row_id").collect()
    news = {r["text"].lower() for r in raw_zone.load_partial(spark, str(root / "raw"), "agnews").collect()}
    text = next(r["text"] for r in shared if r["text"] in news)
    saved = [r for r in load_splits(spark, str(root / "final")).collect() if r["text"].lower() == text]
    assert all(r["label"] == 1 for r in saved)


def test_reprocessing_gives_the_same_corpus(spark, built, tmp_path):
    sources, root, report = built
    again = build_corpus(spark, sources, str(root / "raw"), str(tmp_path / "final"), skip_collect=True)
    assert again.sources == []
    assert sorted(map(tuple, again.counts)) == sorted(map(tuple, report.counts))
    assert (sorted(map(tuple, load_splits(spark, str(root / "final")).fillna("").collect()))
            == sorted(map(tuple, load_splits(spark, str(tmp_path / "final")).fillna("").collect())))


def test_staged_tables_are_removed(spark, built):
    from pathlib import Path
    folder = Path(shared_dir(spark).removeprefix("file:")) / "evenkeel"
    assert not list(folder.glob("run-*"))


# --- raw zone -----------------------------------------------------------------------------------

def fixed(name, label, rows, fail=False):
    def collect(spark):
        if fail:
            raise RuntimeError(f"{name} is down")
        calls[name] += 1
        return spark.createDataFrame([(f"{name} {i} {'x' * 30}", label, name, None, i)
                                      for i in range(rows)], SOURCE_SCHEMA)
    return Source(name, label, rows, collect)


calls = Counter()


def test_incremental_runs(spark, tmp_path):
    root = str(tmp_path / "raw")
    sources = [fixed("up", 1, 3), fixed("down", 0, 2, fail=True), fixed("none", 0, 0)]

    def run(**options):
        return {s.name: s.status for s in raw_zone.run_sources(spark, sources, root, **options)}

    assert run() == {"up": "built", "down": "failed", "none": "empty"}
    assert run() == {"up": "reused", "down": "failed", "none": "empty"}
    assert calls["up"] == 1 and calls["none"] == 2
    assert run(only=["up"]) == {"up": "reused"}
    assert run(force=True, only=["up"]) == {"up": "built"} and calls["up"] == 2
    sources[1] = fixed("down", 0, 2)
    assert run() == {"up": "reused", "down": "built", "none": "empty"}
    combined = raw_zone.combine(spark, sources, root).orderBy("ord").collect()
    assert [r["source"] for r in combined] == ["up"] * 3 + ["down"] * 2
    shorter = fixed("up", 1, 1)
    raw_zone.run_sources(spark, [shorter], root, force=True)
    assert raw_zone.load_partial(spark, root, "up").count() == 1
    assert raw_zone.load_partial(spark, root, "down").count() == 2


def test_nothing_stored_is_an_error(spark, tmp_path):
    with pytest.raises(RuntimeError, match="nothing to combine"):
        raw_zone.combine(spark, [fixed("up", 1, 3)], str(tmp_path / "raw"))
    empty = raw_zone.load_partial(spark, str(tmp_path), "up")
    assert empty.count() == 0 and empty.columns == [*RECORD_COLUMNS, "row_id"]


def test_partial_round_trip(spark, tmp_path):
    rows = [('a "b"\nc', 1, "s", None, 0), (" d ", 0, "s", "t", 1 << 50)]
    raw_zone.save_partial(spark.createDataFrame(rows, SOURCE_SCHEMA), str(tmp_path), "s")
    assert sorted(map(tuple, raw_zone.load_partial(spark, str(tmp_path), "s").collect())) == sorted(rows)


def test_csv_partials_can_be_imported(spark, tmp_path):
    import pandas as pd
    rows = pd.DataFrame([(f'text "{i}",\nmore', 1, "old", None if i % 2 else "t") for i in range(50)],
                        columns=RECORD_COLUMNS)
    rows.to_csv(tmp_path / "old.csv", index=False)
    raw_zone.import_csv(spark, str(tmp_path / "old.csv"), str(tmp_path / "raw"), "old")
    got = raw_zone.load_partial(spark, str(tmp_path / "raw"), "old").orderBy("row_id").collect()
    assert [(r["text"], r["label"], r["source"], r["subtopic"]) for r in got] == [
        (t, 1, "old", None if i % 2 else "t") for i, t in enumerate(rows["text"])]


def test_inputs_of_ten_sources_hold_each_text_once_per_form(spark):
    inputs = run_queries._ten_inputs(spark, "/root/testdata/sf0.001")
    assert inputs.news == inputs.forum == inputs.business_reviews
    assert spark.read.parquet(inputs.news).columns == ["row_id", "text", "category"]
