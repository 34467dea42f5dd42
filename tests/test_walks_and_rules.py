"""Walks over tangled graphs, crawl rules, character references, the composed page source."""

import html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from evenkeel.functions.charrefs import decoded
from evenkeel.functions.urls import canonical
from evenkeel.sources import categories, webpages


def breadth_first(edges, seeds, target, cap, depth):
    """Titles in the order in which a plain walk with a set of visited categories meets them."""
    members = {}
    for category, title, ns, pos in sorted(edges, key=lambda e: (e[3], e[1])):
        members.setdefault(category, []).append((title, ns))
    titles, visited, frontier = [], set(seeds), list(dict.fromkeys(seeds))
    for level in range(depth + 1):
        opened = []
        for category in frontier:
            for title, ns in members.get(category, [])[:cap]:
                if ns == 0:
                    titles.append(title)
                elif ns == 14 and title not in visited:
                    visited.add(title)
                    opened.append(title)
        frontier = opened
    return list(dict.fromkeys(titles))[:target]


@pytest.mark.parametrize("depth,target", [(0, 50), (1, 50), (2, 10), (4, 500), (9, 40)])
def test_walk(spark, depth, target):
    draw = random.Random(depth)
    edges = [(f"c{draw.randrange(25)}", f"c{draw.randrange(25)}", 14, i) for i in range(60)]
    edges += [(f"c{draw.randrange(25)}", f"page {draw.randrange(70)}", 0, draw.randrange(100)) for _ in range(160)]
    edges = list({(e[0], e[3], e[1]): e for e in edges}.values()) + [("c1", "a file", 6, 0)]
    frame = spark.createDataFrame(edges, "category string, title string, ns int, pos bigint").repartition(5)
    for seeds in (["c1", "c2"], ["c3"], ["absent"]):
        rows = categories.walk(frame, seeds, target, cap=6, depth=depth).collect()
        assert [r["title"] for r in rows] == breadth_first(edges, seeds, target, 6, depth)
        assert sorted({r["place"] for r in rows}) == [r["place"] for r in rows]


def test_walk_with_a_large_frontier(spark, many_groups):
    test_walk(spark, 4, 500)


def test_walk_reads_no_level_it_does_not_need(spark, monkeypatch):
    edges = [(f"c{i}", f"c{i + 1}", 14, 0) for i in range(9)] + [(f"c{i}", f"p{i}{j}", 0, j + 1) for i in range(9) for j in range(5)]
    levels, members = [], categories._members
    monkeypatch.setattr(categories, "_members", lambda *a: levels.append(1) or members(*a))
    frame = spark.createDataFrame(edges, "category string, title string, ns int, pos bigint")
    assert categories.walk(frame, ["c0"], 8, depth=8).count() == 8 and len(levels) == 2


# --- crawl rules --------------------------------------------------------------------------------

def permitted(host, path, rules):
    mine = sorted((no, p, a) for h, no, p, a in rules if h.lower() == host and p is not None)
    if not any(h.lower() == host for h, *_ in rules):
        return False
    return next((a or p == "" for no, p, a in mine if path.startswith(p)), True)


def test_rules_meet_paths_by_their_prefixes(spark):
    draw = random.Random(5)
    rules = [(draw.choice(["a.org", "B.org", "c.org"]), i, "/" + "".join(draw.choices("xy/", k=draw.randrange(5))), draw.random() < 0.5)
             for i in range(60)] + [("c.org", 60, "", False), ("empty.org", 0, None, None), ("a.org", 61, "/", False)]
    urls = [(i, f"http://{draw.choice(['a.org', 'b.org', 'c.org', 'empty.org', 'none.org'])}/"
             + "".join(draw.choices("xy/", k=draw.randrange(7)))) for i in range(400)]
    urls += [(400 + i, "http://a.org/hot") for i in range(300)]
    got = webpages.crawl_allowed(spark.createDataFrame(urls, "page_id bigint, url string"), spark.createDataFrame(
        rules, "host string, rule_no int, path_prefix string, allow boolean"))
    want = {i for i, u in urls if permitted(u.split("/")[2], "/" + u.split("/", 3)[3], rules)}
    assert {r["page_id"] for r in got.collect()} == want and 50 < len(want)


def test_rules_do_not_depend_on_broadcasting(spark, many_groups):
    test_rules_meet_paths_by_their_prefixes(spark)


def test_host_with_very_many_rules(spark):
    rules = spark.range(100_000).select(F.lit("big.org").alias("host"), F.col("id").cast("int").alias("rule_no"),
                                        F.concat(F.lit("/"), "id", F.lit("/")).alias("path_prefix"),
                                        (F.col("id") % 2 == 0).alias("allow"))
    urls = spark.range(2000).select(F.col("id").alias("page_id"),
                                    F.concat(F.lit("http://big.org/"), F.col("id") * 60, F.lit("/x")).alias("url"))
    odd = urls.union(spark.range(3000, 3100).select("id", F.concat(F.lit("http://big.org/"), F.col("id") * 2 + 1, F.lit("/y"))))
    allowed = webpages.crawl_allowed(odd, rules)
    assert {r["page_id"] for r in allowed.collect()} == set(range(2000))
    plan = allowed._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan


# --- character references -----------------------------------------------------------------------

def test_references_as_the_runtime_decodes_them(spark):
    draw = random.Random(2)
    names = [n.rstrip(";") for n in html5]
    numbers = [0, 1, 8, 9, 10, 11, 13, 14, 31, 32, 38, 127, 128, 129, 150, 159, 160, 255, 0xD7FF, 0xD800, 0xDFFF, 0xE000,
               0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x1FFFF, 0x10FFFD, 0x10FFFF, 0x110000, 10 ** 12]

    def reference():
        kind = draw.randrange(5)
        if kind == 0:
            return f"&#{'0' * draw.randrange(3)}{draw.choice(numbers)}{draw.choice([';', '', 'x'])}"
        if kind == 1:
            return f"&#{draw.choice('xX')}{draw.choice(numbers):{draw.choice('xX')}}{draw.choice([';', '', 'g'])}"
        if kind == 2:
            return draw.choice(["&", "&;", "&#;", "&#x;", "&&amp;", "&notit;", "&amp=1", "&ampx", "&é;", "& amp;", "&" + "z" * 40 + ";"])
        return f"&{draw.choice(names)}{draw.choice([';', ';', '', 'x', '=', '&'])}"

    texts = ["".join(draw.choice([reference(), reference(), "a b", "é\n", "?x=1"]) for _ in range(draw.randrange(7)))
             for _ in range(3000)] + [f"&{n};" for n in names] + [f"&{n}" for n in names] + [f"&#{n};" for n in numbers] + ["", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for r in frame.select("id", decoded(F.col("t")).alias("d")).collect():
        want = None if texts[r["id"]] is None else html.unescape(texts[r["id"]])
        assert r["d"] == want, texts[r["id"]]


def test_links_with_references(spark):
    pages = spark.createDataFrame([("http://h.org/x", '<a href="/d?a=1&amp;b=&eacute;&#x2F;&nbsp;&copyz">t</a>')], "url string, html string")
    assert [r["link"] for r in webpages.page_links(pages, "/d").collect()] == ["http://h.org/d?a=1&b=é/\xa0©z"]


# --- page source --------------------------------------------------------------------------------

@pytest.mark.parametrize("url,form", [
    ("HTTP://Www.X.org:80/A/b?Q=1#f", "http://www.x.org/A/b?Q=1"), ("https://x.org:443", "https://x.org/"),
    ("https://x.org:80/", "https://x.org:80/"), ("http://x.org?q", "http://x.org/?q"), ("x/y#z", "x/y"), ("ftp://h/a", "ftp://h/a")])
def test_canonical_urls(spark, url, form):
    assert spark.range(1).select(canonical(F.lit(url))).first()[0] == form


def test_crawl_source(spark):
    long = "word " * 30
    index = spark.createDataFrame([("http://i.org/", "<a href='http://H.org:80/c/1#x'>1</a><a href=/c/9>9</a>"
                                    "<a href='http://h.org/c/2?a&amp;b'>2</a><a href=http://h.org/no/3>3</a>"
                                    "<a href=http://h.org/c/4>4</a><a href=http://shut.org/c/5>5</a>"
                                    "<a href=http://h.org/c/6>6</a>")], "url string, html string")
    article = f"<article><p>{long}</p></article>"
    pages = spark.createDataFrame(
        [(1, "http://h.org/c/1", article), (2, "http://h.org/c/2?a&b", article), (3, "http://h.org/no/3", article),
         (4, "http://h.org/c/4", article), (5, "http://shut.org/c/5", article), (6, "http://h.org/c/6", "<article><p>short</p></article>"),
         (7, "http://H.org/c/1", article), (8, "http://h.org/c/unlinked", article)], "page_id bigint, url string, html string")
    rules = spark.createDataFrame([("h.org", 0, "/c/4", False)], "host string, rule_no int, path_prefix string, allow boolean")
    got = webpages.crawl_records(index, pages, rules, 10, 1, "crawl", fragment="/c/")
    assert sorted(r["row_id"] for r in got.collect()) == [1, 2]
    assert webpages.crawl_records(index, pages, rules, 1, 1, "crawl", fragment="/c/").first()["row_id"] == 1
