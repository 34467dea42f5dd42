import pytest
from compare import differences, duck

import __spark_entry__ as entry_point
from evenkeel.plans.oracle import SQL
from evenkeel.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, connection, name):
    frame = entry_point.queries()[name](spark, FOLDER)
    assert differences(frame, connection, entry_point.oracle_sql()[name]) is None


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["ord", "text", "label", "source", "split"] and frame.count() > 0


def test_article_text_on_pages(spark):
    from evenkeel.sources.webpages import _article
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html").collect()
    want = {r["page_id"]: t for r in pages if (t := _article(r["html"])) and len(t) > 100}
    got = {r["row_id"]: r["text"] for r in entry_point.queries()["article_text"](spark, FOLDER).collect()}
    assert got == want and len(got) > 40
