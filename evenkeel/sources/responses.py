"""Stored API responses: paged text, and JSON with defaults for whatever is missing."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.text import fence, strip
from evenkeel.operators.records import make_records
from evenkeel.operators.sampling import first_rows, topic_quota
from evenkeel.plans.staging import look_up, pin, stage
from evenkeel.schema import pack

# Record separator of a fetch response and the response shapes.
SEPARATOR = "\n\n\n"
ID_LIST = "esearchresult struct<idlist: array<string>>"
MEMBERS = "query struct<categorymembers: array<struct<ns: int, title: string>>>"
EXTRACTS = "query struct<pages: map<string, struct<extract: string>>>"

TOPIC_BITS, PAGE_BITS, POSITION_BITS = 12, 23, 20


def split_chunks(df: DataFrame, raw: str = "raw", separator: str = SEPARATOR) -> DataFrame:
    """One row per record of a response: ``pos`` and stripped ``text``, empty ones dropped."""
    keep = [c for c in df.columns if c != raw]
    chunks = df.select(*keep, F.posexplode(F.split(raw, separator)).alias("pos", "_chunk"))
    return fence(chunks, text=strip(F.col("_chunk"))).filter(F.col("text") != "").drop("_chunk")


def id_list(json: Column) -> Column:
    return F.coalesce(F.from_json(json, ID_LIST)["esearchresult"]["idlist"],
                      F.array().cast("array<string>"))


def category_members(json: Column) -> Column:
    return F.coalesce(F.from_json(json, MEMBERS)["query"]["categorymembers"],
                      F.array().cast("array<struct<ns: int, title: string>>"))


def page_extracts(json: Column) -> Column:
    """Texts of all pages of an extract response, empty where missing."""
    pages = F.from_json(json, EXTRACTS)["query"]["pages"]
    texts = F.transform(F.map_values(pages), lambda p: F.coalesce(p["extract"], F.lit("")))
    return F.coalesce(texts, F.array().cast("array<string>"))


def edges_from_members(df: DataFrame, json: str = "json") -> DataFrame:
    """Category edges from stored member responses (``category``, JSON)."""
    return df.select("category", F.posexplode(category_members(F.col(json))).alias("pos", "m")).select(
        "category", F.col("m.title").alias("title"), F.col("m.ns").alias("ns"), "pos")


def topic_rows(chunks: DataFrame, quota: int, topics: int) -> DataFrame:
    """The topic's share of the quota from every topic, then the first ``quota`` rows overall.

    ``chunks`` has ``topic_no, page_no, pos, text``. A topic without responses adds nothing.
    """
    placed = chunks.withColumn("row_id", pack(
        (F.col("topic_no"), TOPIC_BITS), (F.col("page_no"), PAGE_BITS), (F.col("pos"), POSITION_BITS)))
    shares = first_rows(placed, topic_quota(quota, topics), "row_id", ["topic_no"])
    return first_rows(shares, quota, "row_id")


def paged_topics(responses: DataFrame, quota: int, topics: int, label: int, source: str,
                 subtopic: str | None = None) -> DataFrame:
    """Records from stored fetch responses (``topic_no, page_no, raw``).

    The places of all records are staged and cut, not their texts; of the responses that are left these are split again.
    """
    told = responses.filter(F.col("raw").isNotNull())
    places = stage(split_chunks(told).select("topic_no", "page_no", "pos"), "places")
    wanted = pin(topic_rows(places, quota, topics).distinct(), "wanted")
    page = ["topic_no", "page_no"]
    pages = pin(wanted.df.select(*page).distinct(), "pages")
    texts = look_up(split_chunks(look_up(told, pages, page, "left_semi")), wanted, [*page, "pos"])
    return make_records(texts, "text", label, source, subtopic)
