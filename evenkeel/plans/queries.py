"""The registered queries: every operator on the given tables.

Each takes a session and the folder of the tables and returns a DataFrame. The tables stand in for the
sources' own: documents for corpora, conversations for question pairs, pages for crawled pages,
region/nation/customer for the category graph, orders and events for API responses.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import text as T
from evenkeel.functions.urls import host
from evenkeel.operators import balance, dedup, metrics, records, sampling
from evenkeel.plans import corpus, run_queries
from evenkeel.plans.build import load_splits, save_splits
from evenkeel.plans.inputs import exchanges, labelled_documents, table, turns
from evenkeel.plans.raw_zone import load_partial, save_partial
from evenkeel.plans.staging import scratch_path, stage
from evenkeel.session import spread
from evenkeel.sources import categories, qa_xml, responses, tables, templates, webpages

NEWLINE = "\n"
SAMPLE_ROWS = 250
TOPIC_QUOTA, TOPICS = 200, 8
TEMPLATE_ROWS = 500
CRAWLED = 30


def _documents(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text", *extra))


def _pages(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    return spread(table(spark, folder, "pages").select("page_id", "url", "html", *extra))


def _document_records(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder, "source", "lang")
    label = F.when(F.col("lang") == "en", 1).otherwise(0).cast("bigint")
    return docs.select("text", label.alias("label"), "source", F.col("lang").alias("subtopic"),
                       F.col("doc_id").alias("ord"))


# --- text functions -----------------------------------------------------------------------------

def _linked_html() -> Column:
    return F.concat(F.lit("see [page "), F.col("url"), F.lit("]("), F.col("url"), F.lit(") "),
                    F.col("html"))


def md_link(spark, folder):
    return _pages(spark, folder).select(
        "page_id", T.md_link_to_label(_linked_html()).alias("text"))


def strip_url(spark, folder):
    return _pages(spark, folder).select("page_id", T.strip_urls(_linked_html()).alias("text"))


def strip_tags(spark, folder):
    return _pages(spark, folder).select("page_id", T.strip_tags(F.col("html")).alias("text"))


def strip_quotes(spark, folder):
    quoted = F.replace("text", F.lit(". "), F.lit(".\n&gt; "))
    return _documents(spark, folder).select("doc_id", T.strip_quoted_lines(quoted).alias("text"))


def strip_underscores(spark, folder):
    ruled = F.replace(F.replace("text", F.lit(" the "), F.lit("___")), F.lit(" de "), F.lit(" _ __ "))
    return _documents(spark, folder).select("doc_id", T.strip_underscores(ruled).alias("text"))


def collapse_ws(spark, folder):
    spaced = F.replace("text", F.lit(". "), F.lit(".　\t  "))
    return _documents(spark, folder).select("doc_id", T.collapse_whitespace(spaced).alias("text"))


def clean_text(spark, folder):
    linked = _pages(spark, folder).select("page_id", _linked_html().alias("raw"))
    return linked.select("page_id", T.clean_text(F.col("raw")).alias("text"))


def length_gate(spark, folder):
    return _documents(spark, folder).filter(T.length_ok(F.col("text"))).select(
        "doc_id", F.length("text").cast("bigint").alias("chars"))


def truncate_sentence(spark, folder):
    return _documents(spark, folder).select("doc_id", T.truncate_sentence(F.col("text")).alias("text"))


def normalise_keys(spark, folder):
    return T.with_dedup_keys(_documents(spark, folder)).select("doc_id", "exact_key", "prefix_key")


def clean_gate_truncate(spark, folder):
    return T.clean_and_filter(_documents(spark, folder))


def cleaned_keys(spark, folder):
    return T.with_dedup_keys(T.clean_and_filter(_documents(spark, folder)), cleaned=True)


# --- records and dedup --------------------------------------------------------------------------

def make_records(spark, folder):
    padded = F.when(F.col("lang") == "de", F.lit("  \n")).otherwise(
        F.concat(F.lit(" \n"), F.col("text"), F.lit("\t ")))
    return records.make_records(_documents(spark, folder, "lang"), padded, 1, "corpus", "prose",
                                "doc_id")


def dedup_kept(spark, folder):
    rows = T.clean_and_filter(_document_records(spark, folder))
    return dedup.deduplicate(rows, cleaned=True)


def dedup_counters(spark, folder):
    keyed = T.with_dedup_keys(T.clean_and_filter(_document_records(spark, folder)), cleaned=True)
    return dedup.dedup_counters(dedup.dedup_groups(keyed))


# --- sampling, balance, split -------------------------------------------------------------------

def sample_exact_n(spark, folder):
    return sampling.sample_exact(table(spark, folder, "documents"), SAMPLE_ROWS, "doc_id", "sample")


def sample_per_group(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return sampling.sample_exact(docs, 40, "doc_id", "by-lang", ["lang"])


def first_n(spark, folder):
    return sampling.first_rows(table(spark, folder, "documents"), SAMPLE_ROWS, "doc_id")


def quota_per_topic(spark, folder):
    docs = _documents(spark, folder, "source")
    chunks = docs.select(
        "doc_id", F.regexp_extract("source", "([0-9]+)$", 1).cast("int").alias("topic_no"),
        F.shiftright("doc_id", 16).alias("page_no"), (F.col("doc_id") % 65536).alias("pos"), "text")
    return responses.topic_rows(chunks, TOPIC_QUOTA, TOPICS).select("doc_id", "topic_no", "text")


def _narrow_documents(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("lang") == "en", 1).otherwise(0).cast("bigint")
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("ord"), label.alias("label"), "source")


def label_counts(spark, folder):
    return balance.label_counts(_narrow_documents(spark, folder))


def class_minimum(spark, folder):
    return balance.minority_size(balance.label_counts(_narrow_documents(spark, folder)))


def balance_classes(spark, folder):
    return balance.balance_classes(_narrow_documents(spark, folder))


def _thin_strata(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by the host-like key ``source-lang-length class``: many strata, some tiny."""
    label = F.when(F.col("lang") == "en", 1).otherwise(0).cast("bigint")
    size = F.floor(F.log2(F.col("n_chars") + 1)).cast("int")
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("ord"), label.alias("label"),
        F.concat("lang", F.lit("-"), size.cast("string")).alias("source"))


def rare_strata(spark, folder):
    return balance.with_strata(_thin_strata(spark, folder))


def split_targets(spark, folder):
    counted = balance.strata_counts(_thin_strata(spark, folder))
    strata = counted.groupBy("stratum").agg(F.sum("rows").alias("rows"))
    return balance.split_targets(strata)


def stratified_split(spark, folder):
    return balance.stratified_split(_thin_strata(spark, folder))


def flagship_split(spark, folder):
    built = corpus.build(labelled_documents(spark, folder))
    return built.rows().select("ord", "text", "label", "source", "split")


# --- metrics and stored data --------------------------------------------------------------------

def source_breakdown(spark, folder):
    return metrics.source_breakdown(balance.balance_classes(_narrow_documents(spark, folder)))


def stage_metrics(spark, folder):
    return corpus.build(labelled_documents(spark, folder)).counts()


def partial_round_trip(spark, folder):
    root = scratch_path(spark, "raw")
    docs = _documents(spark, folder, "lang")
    save_partial(records.make_records(docs, "text", 0, "corpus", None, "doc_id"), root, "corpus")
    return load_partial(spark, root, "corpus")


def csv_round_trip(spark, folder):
    out = scratch_path(spark, "csv")
    save_splits(_document_records(spark, folder).withColumn("split", F.col("subtopic")), out)
    return load_splits(spark, out)


def source_union_priority(spark, folder):
    asked, docs = turns(spark, folder), _documents(spark, folder)
    return records.combine_sources([
        records.make_records(asked, "text", 1, "turns", "question", "row_id"),
        records.make_records(docs, "text", 0, "corpus", None, "doc_id")])


# --- sources ------------------------------------------------------------------------------------

def corpus_sample(spark, folder):
    docs = table(spark, folder, "documents")
    return tables.corpus_sample(docs, SAMPLE_ROWS, 0, "news", "news", row_id="doc_id")


def two_table_half_quota(spark, folder):
    first = turns(spark, folder).select(
        "row_id", F.when(F.col("role") != "system", F.col("role")).alias("title"),
        F.col("text").alias("content"))
    second = table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return tables.two_table_sample(first, second, 301, 0, "reviews", ("first", "second"))


def category_exclude(spark, folder):
    docs = table(spark, folder, "documents").withColumnRenamed("lang", "category")
    return tables.category_sample(docs, SAMPLE_ROWS, 0, "forum", "forum_post", ["de", "fr"],
                                  row_id="doc_id")


def column_fallback(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", F.when(F.col("lang") != "es", F.col("text")).alias("description"))
    texts = tables.column_texts(docs, ["transcription", "description"], "doc_id")
    return tables.first_texts(texts, SAMPLE_ROWS, 1, "notes", "clinical_note")


def unpivot_distinct(spark, folder):
    return tables.question_pairs(exchanges(spark, folder), SAMPLE_ROWS, 1, "questions", "question")


def qa_pairs(spark, folder):
    def tagged(tag: str, column: str) -> Column:
        escaped = F.col(column)
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            escaped = F.replace(escaped, F.lit(char), F.lit(entity))
        return F.coalesce(F.concat(F.lit(f"<{tag}>"), escaped, F.lit(f"</{tag}>")), F.lit(""))

    pair = F.concat(F.lit("<QAPair>"), tagged("Question", "question_1"),
                    tagged("Answer", "question_2"), F.lit("</QAPair>"))
    content = F.concat(F.lit("<Document><QAPairs>"), pair, F.lit("</QAPairs></Document>"))
    files = exchanges(spark, folder).select(F.col("row_id").cast("string").alias("path"),
                                             F.encode(content, "utf-8").alias("content"))
    return qa_xml.extract_pairs(files)


def split_explode(spark, folder):
    docs = _documents(spark, folder)
    return responses.split_chunks(docs, "text", NEWLINE).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "text")


def json_decode(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def json_id_list(spark, folder):
    orders = table(spark, folder, "orders")
    ids = F.concat(F.lit('{"esearchresult":{"idlist":["'), F.col("o_orderkey"), F.lit('","'),
                   F.col("o_custkey"), F.lit('"]}}'))
    json = (F.when(F.col("o_orderstatus") == "F", F.lit('{"esearchresult":{}}'))
            .when(F.col("o_orderstatus") == "P", F.lit("{}")).otherwise(ids))
    return orders.select("o_orderkey", F.explode(responses.id_list(json)).alias("id"))


def json_members(spark, folder):
    customers = table(spark, folder, "customer")
    json = F.when(F.col("c_acctbal") < 0, F.lit('{"query":{}}')).otherwise(F.concat(
        F.lit('{"query":{"categorymembers":[{"pageid":1,"ns":0,"title":"'), F.col("c_name"),
        F.lit('"},{"ns":14,"title":"Category:'), F.col("c_mktsegment"), F.lit('"}]}}')))
    stored = customers.select(F.col("c_name").alias("category"), json.alias("json"))
    return responses.edges_from_members(stored).withColumns(
        {"ns": F.col("ns").cast("bigint"), "pos": F.col("pos").cast("bigint")})


def json_extracts(spark, folder):
    page = F.when(F.contains("url", F.lit("#")), F.create_map()).otherwise(
        F.create_map(F.lit("extract"), F.col("html")))
    json = F.to_json(F.struct(F.struct(
        F.create_map(F.col("page_id").cast("string"), page).alias("pages")).alias("query")))
    stored = _pages(spark, folder).select("page_id", json.alias("json"))
    return stored.select("page_id", F.explode(responses.page_extracts(F.col("json"))).alias("extract"))


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    region, nation = table(spark, folder, "region"), table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    top = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("category"), F.col("n_name").alias("title"), F.lit(14).alias("ns"),
        F.col("n_nationkey").cast("bigint").alias("pos"))
    below = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("category"), F.col("c_name").alias("title"), F.lit(0).alias("ns"),
        F.col("c_custkey").alias("pos"))
    return top.unionByName(below)


def category_walk(spark, folder):
    return categories.walk(_edges(spark, folder), ["ASIA", "EUROPE"], 350, cap=40)


def category_walk_seeds(spark, folder):
    return categories.walk(_edges(spark, folder), ["AMERICA", "AFRICA"], 350, cap=40)


def _tangled_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Nations below regions and below each other in cycles, their segments below them, customers below several."""
    region, nation = table(spark, folder, "region"), table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    other = nation.select((F.col("n_nationkey") - 3).alias("_key"), F.col("n_name").alias("_name"))
    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    guest = customer.filter("c_custkey % 5 = 0").join(nation, (F.col("c_nationkey") + 1) % 25 == F.col("n_nationkey"))
    segment = F.concat("n_name", F.lit("/"), "c_mktsegment")

    def edges(rows: DataFrame, category: Column | str, title: Column | str, ns: int, pos: Column) -> DataFrame:
        named = [F.col(c) if isinstance(c, str) else c for c in (category, title)]
        return rows.select(named[0].alias("category"), named[1].alias("title"), F.lit(ns).alias("ns"),
                           pos.cast("bigint").alias("pos"))

    return records.union_all([
        edges(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")), "r_name", "n_name", 14,
              F.col("n_nationkey")),
        edges(nation.join(other, F.pmod(F.col("n_nationkey") * 7, F.lit(25)) == F.pmod(F.col("_key"), F.lit(25))),
              "n_name", "_name", 14, F.lit(-2)),
        edges(home.select("n_name", "c_mktsegment").distinct(), "n_name", segment, 14, F.lit(-1)),
        edges(home.filter("c_custkey % 3 = 0"), "n_name", "c_name", 0, F.col("c_custkey")),
        edges(guest, "n_name", "c_name", 0, F.col("c_custkey") + 500000),
        edges(home, segment, "c_name", 0, F.col("c_custkey"))])


def category_walk_deep(spark, folder):
    return categories.walk(_tangled_edges(spark, folder), ["ASIA", "PERU"], 900, cap=40, depth=3)


def title_lookup(spark, folder):
    titles = categories.walk(_edges(spark, folder), ["ASIA", "EUROPE"], 350, cap=40)
    customer = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("title"))
    docs = table(spark, folder, "documents").select(
        "doc_id", F.when(F.col("lang") != "de", F.col("text")).otherwise("").alias("extract"))
    articles = docs.join(customer, F.col("doc_id") == F.col("c_custkey")).select("title", "extract")
    return categories.article_texts(titles, articles, 150)


def link_extract(spark, folder):
    return webpages.page_links(_pages(spark, folder), "/th")


def article_text(spark, folder):
    return webpages.article_text(_pages(spark, folder))


def _crawl_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules for two of three kinds of hosts that occur in pages; .org hosts have none."""
    hosts = table(spark, folder, "pages").select(host(F.col("url")).alias("host")).distinct()

    def rules(ending: str, *lines: tuple[int, str, bool]) -> DataFrame:
        listed = F.array(*[F.struct(F.lit(n).alias("rule_no"), F.lit(p).alias("path_prefix"),
                                    F.lit(a).alias("allow")) for n, p, a in lines])
        return hosts.filter(F.endswith("host", F.lit(ending))).select("host", F.inline(listed))

    return rules(".com", (0, "/fr/", False), (1, "/en/7", False), (2, "/en/", True), (3, "/en/3", False),
                 (4, "/de/", False)).unionByName(rules(
        ".net", (0, "/es/5", False), (1, "/es/", True), (2, "/de/1", True), (3, "/de/", False), (4, "", False)))


def robots_filter(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return webpages.crawl_allowed(pages, _crawl_rules(spark, folder))


def crawl_source(spark, folder):
    """Index pages that write the URLs of two in three stored pages in other ways, and what is crawled from them."""
    pages = table(spark, folder, "pages")
    there = F.concat(F.upper(F.regexp_extract("url", "^([a-z]+://[^/]+)", 1)),
                     F.when(F.startswith("url", F.lit("https")), ":443").otherwise(""),
                     F.replace(F.regexp_replace("url", "^[a-z]+://[^/]+|#.*$", ""), F.lit("&"), F.lit("&#38;")))
    anchors = F.concat(F.lit("<ul><li><a class=x href='"), there, F.lit("#part'>one</a><li><a href=\"/missing/en/1\">no</a>"))
    index = pages.filter("page_id % 3 <> 0").select("url", anchors.alias("html"))
    return webpages.crawl_records(index, pages, _crawl_rules(spark, folder), CRAWLED, 0, "crawl", "article", "/en/")


def _order_attempts(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "orders").select(F.col("o_orderkey").alias("attempt")))


def _table_words(spark: SparkSession, folder: str) -> templates.Vocabulary:
    """A vocabulary whose first slot is filled from a table: the fixed list of nations."""
    names = table(spark, folder, "nation").select("n_name").orderBy("n_name").collect()
    return templates.Vocabulary(symptoms=[r["n_name"] for r in names])


def template_fill(spark, folder):
    return templates.generate(_order_attempts(spark, folder), _table_words(spark, folder))


def template_generate(spark, folder):
    texts = templates.generate(_order_attempts(spark, folder), _table_words(spark, folder))
    distinct = stage(records.first_seen(texts, "text", "attempt"), "generated")
    return sampling.first_rows(distinct, TEMPLATE_ROWS, "attempt")


def informalise(spark, folder):
    casual = F.col("text")
    for word, contraction in (("de", "don't"), ("the", "it's"), ("la", "can't"), ("of", "i'm")):
        casual = F.replace(casual, F.lit(f" {word} "), F.lit(f" {contraction} "))
    casual = F.regexp_replace(casual, r"\.\z", "?")
    asked = turns(spark, folder).select("row_id", casual.alias("text"))
    return templates.informalise(asked, "text", "row_id")


QUERIES = {f.__name__: f for f in (
    flagship_split, clean_gate_truncate, cleaned_keys, md_link, strip_url, strip_tags, strip_quotes,
    strip_underscores, collapse_ws, clean_text, length_gate, truncate_sentence, normalise_keys,
    make_records, dedup_kept, dedup_counters, sample_exact_n, sample_per_group, first_n,
    quota_per_topic, label_counts, class_minimum, balance_classes, rare_strata, split_targets,
    stratified_split, source_breakdown, stage_metrics, partial_round_trip, csv_round_trip,
    source_union_priority, corpus_sample, two_table_half_quota, category_exclude, column_fallback,
    unpivot_distinct, qa_pairs, split_explode, json_decode, json_id_list, json_members,
    json_extracts, category_walk, category_walk_seeds, category_walk_deep, title_lookup, link_extract, article_text,
    robots_filter, crawl_source, template_fill, template_generate, informalise)} | run_queries.QUERIES
