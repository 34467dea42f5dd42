"""Articles reached from seed categories.

Edges are ``category, title, ns, pos``; namespace 0 is an article, 14 a subcategory. The walk takes a level
at a time, each an equi-join of the frontier with the edges; a frontier is what a level has found, less the categories
visited before, and is broadcast where its size is checked.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.config import MEMBERS_PER_CATEGORY, WALK_DEPTH
from evenkeel.operators.numbering import running_sums
from evenkeel.operators.records import first_seen, make_records
from evenkeel.plans.staging import Pinned, local_table, look_up, pin

ARTICLE, SUBCATEGORY = 0, 14
SEED_SCHEMA = T.StructType([T.StructField("category", T.StringType()),
                            T.StructField("place", T.LongType())])


def seed_frontier(spark: SparkSession, seeds: list[str]) -> Pinned:
    rows = [(name, place) for place, name in enumerate(dict.fromkeys(seeds))]
    return Pinned(local_table(spark, rows, SEED_SCHEMA), True, rows)


def _members(edges: DataFrame, frontier: Pinned, cap: int, base: int) -> DataFrame:
    """The first ``cap`` members of every frontier category, in walk order.

    The rank is bounded by ``cap``, so Spark limits each category map-side before the shuffle: a
    category with a third of all edges sends ``cap`` rows per task.
    """
    reached = look_up(edges.select("category", "title", "ns", "pos"), frontier, ["category"])
    w = Window.partitionBy("category").orderBy("pos", "title")
    capped = reached.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= cap)
    return capped.select("title", "ns", (F.lit(base) + F.col("place") * cap + F.col("_n") - 1)
                         .cast("bigint").alias("place"))


def _unseen(found: DataFrame, visited: DataFrame) -> DataFrame:
    """``category, place``: subcategories met for the first time, where they were met first."""
    subcategories = first_seen(found.filter(F.col("ns") == SUBCATEGORY), "title", "place")
    return subcategories.withColumnRenamed("title", "category").join(visited, "category", "left_anti")


def _enough(articles: DataFrame, target: int) -> bool:
    return articles.select("title").distinct().count() >= target


def walk(edges: DataFrame, seeds: list[str], target: int, cap: int = MEMBERS_PER_CATEGORY,
         depth: int = WALK_DEPTH) -> DataFrame:
    """Titles of the first ``target`` distinct articles in breadth-first order, with their place.

    Level 0 are the members of the seeds, level ``depth`` the last that is read. A category that an earlier level
    has opened is not opened again, so cycles end. A walk stops at the level that completes the target:
    later levels only have later places.
    """
    spark = edges.sparkSession
    frontier = seed_frontier(spark, seeds)
    visited = frontier.df.select("category")
    places, base, articles = len(frontier.rows), 0, None
    for level in range(depth + 1):
        found = pin(_members(edges, frontier, cap, base), f"walk-{level}")
        here = found.df.filter(F.col("ns") == ARTICLE).select("title", "place")
        articles = here if articles is None else articles.unionByName(here)
        if level == depth or level > 0 and _enough(articles, target):
            break
        opened = _unseen(found.df, visited)
        base += places * cap
        if level:  # places would grow by the cap with every level
            opened = running_sums(opened.withColumn("_one", F.lit(1)), ["place", "category"], "_one", "_nth").select(
                "category", F.col("_nth").alias("place"))
        frontier = pin(opened, f"frontier-{level}")
        if frontier.rows == []:
            break
        visited = visited.unionByName(frontier.df.select("category"))
        places = places * cap if not level else frontier.df.count()
    return first_seen(articles, "title", "place").orderBy("place").limit(target)


def article_texts(titles: DataFrame, pages: DataFrame, target: int) -> DataFrame:
    """Texts of the titles; a title without text is dropped. At most ``target``, in walk order."""
    wanted = pin(titles, "titles")
    found = look_up(pages.select("title", "extract"), wanted, ["title"])
    # At most one row per title, and the walk is bounded: the ordered limit sees a small table.
    return found.filter(F.length("extract") > 0).orderBy("place").limit(target)


def category_articles(edges: DataFrame, pages: DataFrame, seeds: list[str], quota: int, label: int,
                      source: str, subtopic: str | None = None,
                      cap: int = MEMBERS_PER_CATEGORY, depth: int = WALK_DEPTH) -> DataFrame:
    """Records of the articles reached from the seeds."""
    texts = article_texts(walk(edges, seeds, quota, cap, depth), pages, quota)
    return make_records(texts, "extract", label, source, subtopic, "place")
