import random
import time
from urllib import robotparser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from evenkeel.functions.urls import resolve
from evenkeel.operators import records
from evenkeel.plans.staging import stage
from evenkeel.sources import categories, qa_xml, responses, tables, templates, webpages


def texts(frame, column="text"):
    return [r[column] for r in frame.orderBy("row_id").collect()]


def test_make_records_strips_and_drops_blank(spark):
    frame = spark.createDataFrame([(0, " \na "), (1, None), (2, " "), (3, "b c")],
                                  "row_id bigint, t string")
    rows = records.make_records(frame, "t", 1, "src", "sub").orderBy("row_id").collect()
    assert [tuple(r) for r in rows] == [("a", 1, "src", "sub", 0), ("b c", 1, "src", "sub", 3)]
    assert records.make_records(frame, "t", 1, "src").first()["subtopic"] is None


def test_first_source_wins_over_later_ones(spark):
    a = records.make_records(spark.createDataFrame([(9, "same")], "row_id bigint, t string"), "t", 1, "a")
    b = records.make_records(spark.createDataFrame([(0, "same")], "row_id bigint, t string"), "t", 0, "b")
    rows = records.combine_sources([a, b]).orderBy("ord").collect()
    assert [r["source"] for r in rows] == ["a", "b"]
    with pytest.raises(ValueError):
        records.combine_sources([])


def test_order_fields_out_of_range_fail(spark):
    frame = records.make_records(spark.createDataFrame([(-1, "x")], "row_id bigint, t string"), "t", 1, "a")
    with pytest.raises(Exception, match="does not fit"):
        records.combine_sources([frame]).collect()


# --- tables -------------------------------------------------------------------------------------

def test_two_tables_get_their_halves(spark):
    first = spark.createDataFrame([(i, None if i == 0 else "T", f"c{i} ") for i in range(20)],
                                  "row_id bigint, title string, content string")
    second = spark.createDataFrame([(i, f"s{i}") for i in range(3)], "row_id bigint, text string")
    rows = tables.two_table_sample(first, second, 15, 0, "src", ("x", "y")).collect()
    by_topic = {t: [r["text"] for r in rows if r["subtopic"] == t] for t in "xy"}
    assert len(by_topic["x"]) == 7 and len(by_topic["y"]) == 3
    assert all(t == "c0" or t.startswith("T c") for t in by_topic["x"])
    assert len({r["row_id"] for r in rows}) == 10


def test_excluded_categories(spark):
    frame = spark.createDataFrame([(0, "sci.med", "m"), (1, "rec.autos", "a"), (2, None, "n")],
                                  "row_id bigint, category string, text string")
    assert texts(tables.category_sample(frame, 9, 0, "src")) == ["a", "n"]


def test_questions_are_distinct_and_first_come(spark):
    frame = spark.createDataFrame(
        [(0, " a", "b"), (1, "b ", None), (2, None, " "), (3, "c", "a"), (4, "d", "e")],
        "row_id bigint, question_1 string, question_2 string")
    assert texts(tables.question_pairs(frame, 4, 1, "src")) == ["a", "b", "c", "d"]


def test_csv_column_fallback_and_order(spark, tmp_path):
    body = 'id,description\n1,"one ""quoted"", yes"\n2,\n3,"line\nbreak"\n4, lead\\\n5,last\n'
    (tmp_path / "a.csv").write_text(body)
    rows = tables.read_csv_texts(spark, str(tmp_path / "a.csv"), ["transcription", "description"])
    assert texts(rows) == ['one "quoted", yes', "line\nbreak", " lead\\", "last"]
    (tmp_path / "b.csv").write_text("transcription,description\nfirst,second\n")
    rows = tables.read_csv_texts(spark, str(tmp_path / "b.csv"), ["transcription", "description"])
    assert texts(tables.first_texts(rows, 5, 1, "src")) == ["first"]
    both = tables.read_csv_texts(spark, str(tmp_path / "*.csv"), ["description"])
    assert texts(both)[0] == 'one "quoted", yes' and texts(both)[-1] == "second"
    with pytest.raises(ValueError):
        tables.read_csv_texts(spark, str(tmp_path / "b.csv"), ["nothing"])


# --- XML ----------------------------------------------------------------------------------------

def write_xml(folder):
    pair = "<QAPair><Question>{}</Question><Answer>{}</Answer></QAPair>"
    deep = folder / "sub" / "deeper"
    deep.mkdir(parents=True)
    (folder / "a.xml").write_text("<D>" + pair.format(" q1 ", "\na1 ") + pair.format("", "only answer")
                                  + pair.format("no answer", "  ") + "</D>")
    (deep / "b.xml").write_text("<D><X><Y>" + pair.format("q2", "X is <b>bold</b> y")
                                + "<QAPair><Answer>bare</Answer></QAPair></Y></X></D>")
    (folder / "c.xml").write_text("<D>" + pair.format("lost", "cut off") + "<QAPair><Ques")
    (folder / "d.xml").write_text("<D>" + pair.format("lost", "damaged") + "</E></D>")
    (folder / "e.txt").write_text("<D>" + pair.format("not", "xml") + "</D>")
    (folder / "f.xml").write_bytes('<?xml version="1.0" encoding="iso-8859-1"?><D>'.encode()
                                   + pair.format("é", "ü").encode("latin-1") + b"</D>")


def test_xml_files_count_as_a_whole(spark, tmp_path):
    write_xml(tmp_path)
    files = qa_xml.scan_xml(spark, str(tmp_path))
    want = ["q1 a1", "only answer", "é ü", "q2 X is", "bare"]
    assert texts(qa_xml.qa_records(files, 99, 1, "src", "qa_pair")) == want
    assert texts(qa_xml.qa_records(files, 2, 1, "src")) == want[:2]


# --- responses ----------------------------------------------------------------------------------

def test_topics_share_the_quota(spark):
    pages = [(t, p, "\n\n\n".join(f" t{t}p{p}r{r}\n" for r in range(4)) + "\n\n\n\n\n\n")
             for t in (0, 2) for p in range(3)] + [(1, 0, None)]
    frame = spark.createDataFrame(pages, "topic_no int, page_no int, raw string").repartition(5)
    rows = texts(responses.paged_topics(frame, 21, 3, 1, "src"))
    flat = {t: [f"t{t}p{p}r{r}" for p in range(3) for r in range(4)] for t in (0, 2)}
    assert rows == flat[0][:7] + flat[2][:7]
    assert texts(responses.paged_topics(frame, 8, 1, 1, "src")) == flat[0][:8]


def _repeated_pages(spark):
    pages = [(t, p, "\n\n\n".join(f" {t}/{p}/{r}/{n} " for r in range(4))) for t in (0, 1) for p in range(3) for n in (0, 1)]
    frame = spark.createDataFrame(pages, "topic_no int, page_no int, raw string").repartition(4)
    return texts(responses.paged_topics(frame, 16, 2, 1, "src")), [f"{t}/0/{r}/{n}" for t in (0, 1) for r in range(4) for n in (0, 1)]


def test_repeated_pages_keep_their_texts(spark):
    got, want = _repeated_pages(spark)
    assert sorted(got) == sorted(want)


def test_repeated_pages_keep_their_texts_beyond_broadcast(spark, many_groups):
    got, want = _repeated_pages(spark)
    assert sorted(got) == sorted(want)


def test_topics_are_cut_without_staging_texts(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(responses, "stage", lambda df, name: staged.append(df.columns) or stage(df, name))
    frame = spark.createDataFrame([(0, 0, "a\n\n\nb")], "topic_no int, page_no int, raw string")
    assert texts(responses.paged_topics(frame, 1, 1, 1, "src")) == ["a"]
    assert staged == [["topic_no", "page_no", "pos"]]


def test_split_on_three_newlines_matches_python(spark):
    raws = ["a\n\n\nb", "a\n\n\n\nb", "\n\n\n\n\n\n", "a\n\nb\n\n\n\n\n c ", ""]
    frame = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    got = {}
    for r in responses.split_chunks(frame).orderBy("i", "pos").collect():
        got.setdefault(r["i"], []).append(r["text"])
    assert got == {i: [c.strip() for c in raw.split("\n\n\n") if c.strip()]
                   for i, raw in enumerate(raws) if raw.strip()}


def test_json_defaults(spark):
    ids = ['{"esearchresult":{"idlist":["1","2"]}}', '{"esearchresult":{}}', "{}", "broken", None]
    frame = spark.createDataFrame([(s,) for s in ids], "j string")
    got = [r[0] for r in frame.select(responses.id_list(F.col("j"))).collect()]
    assert got == [["1", "2"], [], [], [], []]
    pages = ['{"query":{"pages":{"7":{"extract":"x"},"8":{"title":"t"}}}}', '{"query":{}}', "{}"]
    frame = spark.createDataFrame([(s,) for s in pages], "j string")
    got = [r[0] for r in frame.select(responses.page_extracts(F.col("j"))).collect()]
    assert got == [["x", ""], [], []]
    stored = spark.createDataFrame([("c", '{"query":{"categorymembers":[{"ns":0,"title":"p"},'
                                          '{"ns":14,"title":"s"}]}}'), ("d", "{}")],
                                   "category string, json string")
    assert sorted(map(tuple, responses.edges_from_members(stored).collect())) == [
        ("c", "p", 0, 0), ("c", "s", 14, 1)]


# --- categories ---------------------------------------------------------------------------------

def breadth_first(edges, seeds, target, cap):
    found, frontier = {}, list(dict.fromkeys(seeds))
    for _ in range(2):
        below = []
        for category in frontier:
            for _, title, ns, _ in sorted((e for e in edges if e[0] == category),
                                          key=lambda e: (e[3], e[1]))[:cap]:
                if ns == 0:
                    found.setdefault(title)
                else:
                    below.append(title)
        frontier = list(dict.fromkeys(below))
    return list(found)[:target]


def graph(rng):
    edges = [("A", f"hot{i}", 0, i) for i in range(300)]
    edges += [("A", "S1", 14, 3), ("B", "S2", 14, 0), ("B", "S1", 14, 1), ("B", "both", 0, 2),
              ("S1", "both", 0, 0), ("S1", "deep", 14, 1), ("deep", "unreached", 0, 0)]
    edges += [("S2", f"x{rng.randint(0, 60)}", rng.choice([0, 0, 14, 5]), i) for i in range(80)]
    return edges


@pytest.mark.parametrize("target,cap", [(1000, 200), (210, 200), (25, 10), (5, 3)])
def test_walk(spark, target, cap):
    edges = graph(random.Random(9))
    frame = spark.createDataFrame(edges, "category string, title string, ns int, pos bigint").repartition(6)
    got = [r["title"] for r in categories.walk(frame, ["A", "B", "A"], target, cap).collect()]
    assert got == breadth_first(edges, ["A", "B"], target, cap)


def test_walk_with_a_large_frontier(spark, many_groups):
    edges = graph(random.Random(9))
    frame = spark.createDataFrame(edges, "category string, title string, ns int, pos bigint")
    got = [r["title"] for r in categories.walk(frame, ["A", "B"], 500, 50).collect()]
    assert got == breadth_first(edges, ["A", "B"], 500, 50)


def test_articles_without_text_are_dropped(spark):
    edges = spark.createDataFrame([("A", t, 0, i) for i, t in enumerate("pqrs")],
                                  "category string, title string, ns int, pos bigint")
    pages = spark.createDataFrame([("s", "S"), ("p", ""), ("r", "R"), ("z", "Z"), ("q", None)],
                                  "title string, extract string")
    assert texts(categories.category_articles(edges, pages, ["A"], 9, 1, "src")) == ["R", "S"]


def test_member_cap_is_applied_before_the_shuffle(spark, tmp_path):
    edges = spark.createDataFrame(graph(random.Random(1)),
                                  "category string, title string, ns int, pos bigint")
    frontier = categories.seed_frontier(spark, ["A"])
    plan = categories._members(edges, frontier, 200, 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# --- web pages ----------------------------------------------------------------------------------

HREFS = ["/a/b", "c", "../c", "./c/./d", "../../../x", "//other.example/p", "https://z.example/q?r#s", "#f",
         "?q=1", "", "c?x=../y", "d/", "..", ".", "mailto:a@b.example", "/a/../b/", "../", "a/b/../../c#k"]


@pytest.mark.parametrize("base", ["http://h.example/p/q/r?x=1#y", "https://h.example", "http://h.example/",
                                  "http://h.example/p"])
def test_references_resolve_like_urljoin(spark, base):
    frame = spark.createDataFrame(list(enumerate(HREFS)), "i int, h string")
    got = [r[0] for r in frame.orderBy("i").select(resolve(F.lit(base), F.col("h"))).collect()]
    assert got == [urljoin(base, h) for h in HREFS]


def test_links_of_real_markup(spark):
    html = """<a href="/d/one">x</a><A class='k' HREF='/d/two?a=1&amp;b=2'>y</A><a href=/d/three>z</a>
      <!-- <a href="/d/comment"> --><script>var a='<a href="/d/script">';</script><a title="a > b"
      href="/d/four">f</a><a data-href="/d/no">n</a><abbr href="/d/no">
      <a checked href = '/d/five'>5</a><a id="k"href="/d/six">6</a><a name="x" disabled><a href="/other">o</a><a href="/d/one">again</a>"""
    frame = spark.createDataFrame([("http://h.example/x/", html)], "url string, html string")
    links = sorted(r["link"] for r in webpages.page_links(frame, "/d/").collect())
    assert links == [f"http://h.example/d/{p}" for p in ("five", "four", "one", "six", "three", "two?a=1&b=2")]


def test_links_of_broken_and_long_markup(spark):
    html = ('<a ' + "x" * 50000 + ' ' + 'k="v" ' * 500 + 'href="/d/long">l</a><a title="open href="/d/lost>'
            + "<a " * 20000 + '<a href="/d/last">')
    frame = spark.createDataFrame([("http://h.example/", html)], "url string, html string")
    links = {r["link"] for r in webpages.page_links(frame, "/d/").collect()}
    assert {"http://h.example/d/long", "http://h.example/d/last"} <= links


ARTICLES = [
    ("<div id='main-content'><p>One <b>bold</b> end.</p>skip<p>Two</p></div><article><p>no</p></article>",
     "One bold end. Two"),
    ("<article><h1>t</h1><p>A &amp; B &lt; C</p><p> </p><div><p>nested</p></div></article><p>out</p>",
     "A & B < C nested"),
    ("<article><p><b>open<br>line<p>second</article>", "open line second"),
    ("<p>none</p>", None),
    ("<article><p>x<script>var p='</p>';</script>y<!-- c -->z</p></article>", "x y z"),
    ("<article><section><p>in</section>out</article>", "in"),
    ("<div><div id='main-content'></div><p>outside</p></div>", ""),
    ("<article><p>1 < 2 & 3<4</p></article>", "1 < 2 & 3<4"),
    ("", None),
]


@pytest.mark.parametrize("html,want", ARTICLES)
def test_article_paragraphs(html, want):
    assert webpages._article(html) == want


def test_deeply_nested_page_takes_linear_time():
    start = time.monotonic()
    assert len(webpages._article("<article><p>" + "<b>x" * 200_000)) == 399_999
    assert time.monotonic() - start < 20


def test_article_length_gate(spark):
    pages = spark.createDataFrame([(i, f"<article><p>{'x' * n}</p></article>")
                                   for i, n in enumerate([99, 100, 101])], "page_id bigint, html string")
    assert [r["row_id"] for r in webpages.article_text(pages).collect()] == [2]


def test_crawl_rules_match_robotparser(spark):
    rules = {"a.example": [("/private", False), ("/private/open", True), ("/", True)],
             "b.example": [("/x/open", True), ("/x", False)], "c.example": [("", False)],
             "p.example": [("/a%20b", False), ("/c+d", False), ("/é", False), ("/x%", False)],
             "d.example": [("/", False)], "e.example": []}
    rows = [(h, i, p, a) for h, lines in rules.items() for i, (p, a) in enumerate(lines)]
    rows += [(h, None, None, None) for h, lines in rules.items() if not lines]
    paths = ["", "/", "/private", "/private/open", "/x", "/x/open?q=1", "/y#f", "?q", "/a b/1", "/a%20b", "/c+d",
             "/c%2Bd", "/c d", "/%C3%A9/2", "/x%zz"]
    urls = [f"https://{h}{p}" for h in [*rules, "unknown.example"] for p in paths]
    want = []
    for url in urls:
        lines = rules.get(url.split("/")[2].split("?")[0])
        if lines is None:
            continue
        parser = robotparser.RobotFileParser()
        parser.parse(["User-agent: *"] + [f"{'Allow' if a else 'Disallow'}: {p}" for p, a in lines])
        if parser.can_fetch("any", url):
            want.append(url)
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    table = spark.createDataFrame(rows, "host string, rule_no int, path_prefix string, allow boolean")
    assert sorted(r["url"] for r in webpages.crawl_allowed(frame, table).collect()) == sorted(want)


def test_page_records(spark):
    html = "<article><p>" + "word " * 40 + "{}</p></article>"
    pages = spark.createDataFrame(
        [(i, f"http://h{i % 2}.example/{i}", html.format(i)) for i in range(6)],
        "page_id bigint, url string, html string")
    rules = spark.createDataFrame([("h0.example", 0, "/4", False)],
                                  "host string, rule_no int, path_prefix string, allow boolean")
    rows = texts(webpages.page_records(pages, rules, 5, 1, "src"))
    assert [t.split()[-1] for t in rows] == ["0", "2"]


# --- templates ----------------------------------------------------------------------------------

def test_generated_texts(spark):
    first = templates.template_records(spark, 300, 1, "src", "casual").orderBy("row_id").collect()
    again = templates.template_records(spark, 300, 1, "src", "casual").orderBy("row_id").collect()
    assert first == again and len(first) == len({r["text"] for r in first}) == 300
    assert all("{" not in r["text"] and r["text"] == r["text"].strip() for r in first)
    words = templates.Vocabulary(["{symptom} {duration}?"], ["fixed"], ["a", "b"], ["c"])
    small = {r["text"] for r in templates.template_records(spark, 50, 1, "src", words=words).collect()}
    assert small == {"a c?", "b c?", "a c", "b c", "fixed"}


def test_shares_of_the_generator(spark):
    words = templates.Vocabulary(["{symptom} {duration} it's here?"], ["fixed"], ["a"], ["c"])
    rows = [r["text"] for r in templates.generate(
        spark.range(4000).withColumnRenamed("id", "attempt"), words).collect()]
    made = [t for t in rows if t != "fixed"]
    assert abs(len(made) / 4000 - 0.75) < 0.03
    assert abs(sum(" its " in t for t in made) / len(made) - 0.4) < 0.04
    assert abs(sum(not t.endswith("?") for t in made) / len(made) - 0.3) < 0.04


def test_informalise_touches_only_what_it_should(spark):
    frame = spark.createDataFrame([(i, "É i've said don't, don't you?") for i in range(400)],
                                  "id bigint, t string")
    got = {r["t"] for r in templates.informalise(frame, "t", "id").collect()}
    assert got == {f"é {a} said don't, {b} you{c}" for a in ("i've", "ive") for b in ("don't", "dont")
                   for c in ("?", "")}
