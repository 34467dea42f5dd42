"""The registry of sources: name, quota, label and the function that collects records."""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from evenkeel import config
from evenkeel.sources import categories, qa_xml, responses, tables, templates


@dataclass
class Source:
    """A source of the corpus. Its place in the registry list is its priority in dedup.

    ``inputs`` are the paths that it reads, whose size decides the number of its shuffle partitions.
    """

    name: str
    label: int
    quota: int
    collect: Callable[[SparkSession], DataFrame]
    inputs: list[str] = field(default_factory=list)


@dataclass
class Inputs:
    """Where the raw material of the default sources lies: folders, files, or parquet tables.

    Tables carry a BIGINT ``row_id``, the row order, except the ones with an order of their own:
    responses ``topic_no, page_no, raw``, edges ``category, title, ns, pos``, articles
    ``title, extract``.
    """

    abstracts: str           # responses
    qa_folder: str           # XML files
    notes_csv: str           # CSV with a transcription or description column
    edges: str
    articles: str
    question_pairs: str      # question_1, question_2
    news: str                # text
    forum: str               # text, category
    product_reviews: str     # title, content
    business_reviews: str    # text


def default_sources(inputs: Inputs, quotas: dict[str, int] | None = None) -> list[Source]:
    """The ten sources in priority order: medical first. ``quotas`` replaces the quotas of the sources it names."""
    unknown = set(quotas or {}) - {name for name, _, _ in config.SOURCE_QUOTAS}
    if unknown:
        raise ValueError(f"quotas for sources that do not exist: {sorted(unknown)}")

    def read(spark: SparkSession, path: str) -> DataFrame:
        return spark.read.parquet(path)

    def abstracts(spark, quota, label, name):
        return responses.paged_topics(read(spark, inputs.abstracts), quota,
                                      len(config.SEARCH_TOPICS), label, name, "abstract")

    def qa_pairs(spark, quota, label, name):
        return qa_xml.qa_records(qa_xml.scan_xml(spark, inputs.qa_folder), quota, label, name,
                                 "qa_pair")

    def notes(spark, quota, label, name):
        texts = tables.read_csv_texts(spark, inputs.notes_csv, ["transcription", "description"], quota)
        return tables.first_texts(texts, quota, label, name, "clinical_note")

    def encyclopedia(seeds):
        def collect(spark, quota, label, name):
            return categories.category_articles(read(spark, inputs.edges), read(spark, inputs.articles),
                                                seeds, quota, label, name, "article")
        return collect

    def questions(spark, quota, label, name):
        return tables.question_pairs(read(spark, inputs.question_pairs), quota, label, name,
                                     "patient_question")

    def casual(spark, quota, label, name):
        return templates.template_records(spark, quota, label, name, "templated_query")

    def news(spark, quota, label, name):
        return tables.corpus_sample(read(spark, inputs.news), quota, label, name, "news")

    def forum(spark, quota, label, name):
        return tables.category_sample(read(spark, inputs.forum), quota, label, name, "forum_post")

    def reviews(spark, quota, label, name):
        return tables.two_table_sample(
            read(spark, inputs.product_reviews), read(spark, inputs.business_reviews), quota, label,
            name, ("amazon_review", "yelp_review"))

    collectors = [abstracts, qa_pairs, notes, encyclopedia(config.MEDICAL_SEEDS), questions, casual,
                  news, forum, reviews, encyclopedia(config.NON_MEDICAL_SEEDS)]
    paths = [[inputs.abstracts], [inputs.qa_folder], [inputs.notes_csv], [inputs.edges, inputs.articles],
             [inputs.question_pairs], [], [inputs.news], [inputs.forum],
             [inputs.product_reviews, inputs.business_reviews], [inputs.edges, inputs.articles]]
    sources = []
    for (name, label, quota), collect, reads in zip(config.SOURCE_QUOTAS, collectors, paths, strict=True):
        rows = (quotas or {}).get(name, quota)
        sources.append(Source(name, label, rows, lambda spark, c=collect, q=rows, y=label, n=name:
                              c(spark, q, y, n), reads))
    return sources
