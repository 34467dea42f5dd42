"""Stored web pages: links, article text, crawl permission."""

import sys
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.config import LINK_FRAGMENT, MIN_ARTICLE_CHARS
from evenkeel.functions.charrefs import decoded
from evenkeel.functions.text import fence
from evenkeel.functions.urls import canonical, host, path_and_query, percent_decoded, resolve
from evenkeel.operators.records import make_records
from evenkeel.operators.sampling import first_rows
from evenkeel.plans.staging import Pinned, look_up, pin, stage

# Parsing functions travel with their tasks: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Markup that holds no links, and anchors with their three ways to quote. The attributes
# before href repeat possessively: Java matches that in a loop, any other repeated group by recursion.
NO_LINKS = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)"""
OTHER = rf"""[\s/]*+(?!href\s*=)[^\s=>"'/]++(?:\s*+=\s*+{VALUE})?+"""
ANCHOR = rf"(?i)<a(?=[\s/])(?:{OTHER})*+[\s/]*+href\s*+=\s*+({VALUE})"


def link_targets(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per anchor of a page: ``href``, unquoted and with character references decoded."""
    markup = F.regexp_replace(html, NO_LINKS, "")
    raw = F.explode(F.regexp_extract_all(markup, F.lit(ANCHOR), F.lit(1)))
    keep = [c for c in pages.columns if c != html]
    found = pages.select(*keep, raw.alias("href"))
    return fence(found, href=decoded(F.regexp_replace("href", "^[\"']|[\"']$", "")))


def page_links(pages: DataFrame, fragment: str = LINK_FRAGMENT, base: Column | None = None) -> DataFrame:
    """Distinct absolute links whose target contains ``fragment``, from ``pages(url, html)``."""
    base = F.col("url") if base is None else base
    found = link_targets(pages.select(base.alias("_base"), "html"))
    wanted = found.filter(F.contains("href", F.lit(fragment)))
    return fence(wanted, link=resolve(F.col("_base"), F.col("href"))).select("link").distinct()


class _Article(HTMLParser):
    """Paragraph texts of the main region and of the first article.

    An end tag closes everything opened since its start tag, and a new paragraph closes the last one,
    so that every text belongs to one paragraph.
    """

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
            "track", "wbr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.count: Counter[str] = Counter()  # of the tags in open
        self.paragraph = -1  # number of elements open around the open paragraph
        self.start: dict[str, int] = {}  # region -> number of elements open around it
        self.closed: set[str] = set()
        self.texts: dict[str, list[str]] = {"main": [], "article": []}
        self.data: list[str] = []

    def _end_text(self) -> None:
        text = "".join(self.data).strip()
        self.data.clear()
        if text and self.count["p"] and not self.count["script"] + self.count["style"]:
            for region, depth in self.start.items():
                if region not in self.closed and self.paragraph > depth:
                    self.texts[region].append(text)

    def _close(self, tag: str) -> None:
        if self.count[tag]:
            last = None
            while last != tag:
                last = self.open.pop()
                self.count[last] -= 1
            self.closed |= {r for r, depth in self.start.items() if len(self.open) <= depth}

    def handle_starttag(self, tag, attrs):
        self._end_text()
        if tag in self.VOID:
            return
        if tag == "p":
            self._close("p")
            self.paragraph = len(self.open)
        if tag == "div" and dict(attrs).get("id") == "main-content":
            self.start.setdefault("main", len(self.open))
        elif tag == "article":
            self.start.setdefault("article", len(self.open))
        self.open.append(tag)
        self.count[tag] += 1

    def handle_endtag(self, tag):
        self._end_text()
        self._close(tag)

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)  # an unknown <![...]> is skipped up to its end

    def handle_comment(self, data):
        self._end_text()

    def handle_data(self, data):
        self.data.append(data)

    def result(self) -> str | None:
        self._end_text()
        for region in ("main", "article"):
            if region in self.start:
                return " ".join(self.texts[region])
        return None


def _article(html: str | None) -> str | None:
    parser = _Article()
    parser.feed(html or "")
    parser.close()
    return parser.result()


def article_text(pages: DataFrame, row_id: str = "page_id", html: str = "html",
                 min_chars: int = MIN_ARTICLE_CHARS) -> DataFrame:
    """``row_id, text`` of pages with an article of more than ``min_chars`` characters."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"row_id": batch["row_id"], "text": batch["html"].map(_article)})

    read = pages.select(F.col(row_id).cast("bigint").alias("row_id"), F.col(html).alias("html"))
    return read.mapInPandas(parse, "row_id bigint, text string").filter(F.length("text") > min_chars)


def crawl_allowed(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The rows of ``urls`` whose crawling the rules permit.

    ``rules`` is ``host, rule_no, path_prefix, allow``, one row per rule, or one with null prefix for a
    host whose rules are known to be empty. The first matching rule decides, a host with rules but no
    match is open, an empty disallow prefix forbids nothing, a host without rules is closed.

    A path meets a rule by equality: only its prefixes of the lengths that its host has rules of are looked up, each
    different path once. The least rule number of those found is a partial minimum, so neither a host with very many
    rules nor one with very many pages is ever together in one place.
    """
    empty = F.col("path_prefix") == ""
    listed = rules.select(F.lower("host").alias("_host"), "rule_no", percent_decoded(F.col("path_prefix")).alias("_prefix"),
                          (F.col("allow") | empty).alias("allow"))
    known = pin(listed.groupBy("_host", "_prefix").agg(F.min(F.struct("rule_no", "allow")).alias("_rule")), "rules")
    first = Pinned(known.df.filter(F.col("_prefix").isNotNull()), known.small)
    hosts = Pinned(known.df.select("_host").distinct(), known.small)
    lengths = Pinned(first.df.select("_host", F.length("_prefix").alias("_length")).distinct(), known.small)
    named = look_up(urls.withColumns({"_host": host(F.col(url)), "_path": path_and_query(F.col(url))}), hosts, ["_host"])
    prefixes = look_up(named.select("_host", "_path").distinct(), lengths, ["_host"]).filter(
        F.length("_path") >= F.col("_length")).withColumn("_prefix", F.left("_path", F.col("_length")))
    decided = look_up(prefixes, first, ["_host", "_prefix"]).groupBy("_host", "_path").agg(
        F.min(F.struct("_rule.rule_no", "_prefix", "_rule.allow")).alias("_first"))
    denied = decided.filter(~F.col("_first.allow")).select("_host", "_path")
    return named.join(denied, ["_host", "_path"], "left_anti").select(*urls.columns)


def page_records(pages: DataFrame, rules: DataFrame, quota: int, label: int, source: str,
                 subtopic: str | None = None, row_id: str = "page_id") -> DataFrame:
    """Records of the first ``quota`` permitted pages with an article."""
    texts = stage(article_text(crawl_allowed(pages, rules), row_id), "articles")
    return make_records(first_rows(texts, quota, "row_id"), "text", label, source, subtopic)


def linked_pages(index: DataFrame, pages: DataFrame, rules: DataFrame, fragment: str = LINK_FRAGMENT,
                 row_id: str = "page_id") -> DataFrame:
    """``row_id`` of the stored pages that the index pages link to and the rules permit.

    Links and pages meet by their canonical URL. Of pages stored twice under one, the first counts. All of this is
    on URLs; no page is read for it.
    """
    links = fence(page_links(index, fragment), _key=canonical(F.col("link"))).select("_key").distinct()
    stored = fence(pages.select(F.col(row_id).cast("bigint").alias("row_id"), "url"),
                   _key=canonical(F.col("url"))).groupBy("_key").agg(F.min(F.struct("row_id", "url")).alias("_page"))
    met = stored.join(links, "_key", "left_semi").select("_page.row_id", "_page.url")
    return crawl_allowed(met, rules).select("row_id")


def crawl_records(index: DataFrame, pages: DataFrame, rules: DataFrame, quota: int, label: int, source: str,
                  subtopic: str | None = None, fragment: str = LINK_FRAGMENT, row_id: str = "page_id") -> DataFrame:
    """The page source as a whole: links of index pages, rules, stored pages, articles, the first ``quota`` records.

    ``index`` and ``pages`` have ``url, html``. A page is parsed only if it is linked and permitted.
    """
    wanted = pin(linked_pages(index, pages, rules, fragment, row_id), "linked")
    read = pages.select(F.col(row_id).cast("bigint").alias("row_id"), "html")
    texts = stage(article_text(look_up(read, wanted, ["row_id"]), "row_id"), "articles")
    return make_records(first_rows(texts, quota, "row_id"), "text", label, source, subtopic)
