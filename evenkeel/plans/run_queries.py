"""Registered queries of whole runs: sources to raw zone to splits, and what a run does with each source.

The sources are made of the given tables: turns of conversations (priority 0), then documents. Their raw zone
lies in a folder of its own; tables that a query stages on the way are removed by the build.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.config import MEDICAL_SEEDS, NON_MEDICAL_SEEDS
from evenkeel.operators.records import make_records, union_all
from evenkeel.plans.build import build_corpus, load_splits
from evenkeel.plans.inputs import exchanges, table, turns, write_pairs, write_texts
from evenkeel.plans.raw_zone import combine, load_partial, run_sources
from evenkeel.plans.registry import Inputs, Source, default_sources
from evenkeel.plans.staging import scratch_path
from evenkeel.session import spread
from evenkeel.sources import qa_xml, tables

CSV_ROWS, XML_PAIRS = 150, 160
TEN_QUOTAS = {"pubmed": 75, "medquad": 60, "mtsamples": 50, "wikipedia_medical": 80, "medquestionpairs": 90,
              "synthetic_casual": 70, "agnews": 110, "newsgroups20": 45, "amazon_yelp": 61, "wikipedia_nonmedical": 70}


def _turn_source(folder: str) -> Source:
    def collect(spark: SparkSession) -> DataFrame:
        turns = table(spark, folder, "conversations").withColumn(
            "row_id", F.col("conv_id") * 100000 + F.col("turn"))
        return make_records(spread(turns), "text", 1, "turns", "question")
    return Source("turns", 1, 0, collect)


def _document_source(folder: str, name: str = "corpus", wanted: str = "true") -> Source:
    def collect(spark: SparkSession) -> DataFrame:
        docs = table(spark, folder, "documents").filter(wanted)
        return make_records(spread(docs), "text", 0, name, "passage", "doc_id")
    return Source(name, 0, 0, collect)


def _failing(source: Source) -> Source:
    """The source, with a record that makes a task fail while the rows are being written."""
    def collect(spark: SparkSession) -> DataFrame:
        rows = source.collect(spark)
        broken = F.when(F.col("row_id") % 10 == 7, F.raise_error(F.lit("a damaged record"))).otherwise(F.col("text"))
        return rows.withColumn("text", broken)
    return Source(source.name, source.label, source.quota, collect)


def pipeline_build(spark: SparkSession, folder: str) -> DataFrame:
    """The saved split files of a full build."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "final")
    build_corpus(spark, [_turn_source(folder), _document_source(folder)], raw, out)
    return load_splits(spark, out)


def skip_collect(spark: SparkSession, folder: str) -> DataFrame:
    """The split files of a build that collects nothing: it takes what earlier runs have stored of both sources."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "final")
    for source in (_document_source(folder), _turn_source(folder)):
        run_sources(spark, [source], raw)

    def gone(_: SparkSession) -> DataFrame:
        raise RuntimeError("the sources are not asked")

    sources = [Source(s.name, s.label, s.quota, gone) for s in (_turn_source(folder), _document_source(folder))]
    build_corpus(spark, sources, raw, out, skip_collect=True)
    return load_splits(spark, out)


def build_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per stage, source and label, as the report of a full build has them."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "final")
    report = build_corpus(spark, [_turn_source(folder), _document_source(folder)], raw, out)
    return spark.createDataFrame([tuple(r[c] for c in ("stage", "source", "label", "rows")) for r in report.counts],
                                 "stage string, source string, label bigint, rows bigint")


def reuse_status(spark: SparkSession, folder: str) -> DataFrame:
    """What four runs do with each source, and the rows it has stored after each.

    The first builds; the second reuses what has rows and tries the others again; the third is forced and
    has a failing source, which keeps its rows; the fourth builds only one.
    """
    raw = scratch_path(spark, "raw")
    turns, docs = _turn_source(folder), _document_source(folder)
    nothing = _document_source(folder, "nothing", "doc_id < 0")
    runs = [run_sources(spark, [turns, docs, nothing], raw),
            run_sources(spark, [turns, docs, nothing], raw),
            run_sources(spark, [turns, _failing(docs), nothing], raw, force=True),
            run_sources(spark, [turns, docs, nothing], raw, force=True, only=["corpus"])]
    told = spark.createDataFrame([(i, s.name, s.status) for i, run in enumerate(runs) for s in run],
                                 "run bigint, source string, status string")
    stored = load_partial(spark, raw, "turns").unionByName(load_partial(spark, raw, "corpus"))
    counted = stored.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    return told.join(counted, "source", "left").select("run", "source", "status", F.coalesce(
        "rows", F.lit(0).cast("bigint")).alias("rows"))


def rebuild_keeps_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The stored rows of a source whose forced rebuild has failed inside a task."""
    raw, docs = scratch_path(spark, "raw"), _document_source(folder)
    run_sources(spark, [docs], raw)
    run_sources(spark, [_failing(docs)], raw, force=True)
    return load_partial(spark, raw, "corpus")


def only_subset(spark: SparkSession, folder: str) -> DataFrame:
    """All that is stored, combined, after a run of one source of two: it keeps its place in the order."""
    raw, sources = scratch_path(spark, "raw"), [_turn_source(folder), _document_source(folder)]
    run_sources(spark, sources, raw, only=["corpus"])
    return combine(spark, sources, raw)


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The first texts of two folders of CSV files: one has both text columns, the other the second only."""
    docs = table(spark, folder, "documents")
    both = docs.select("doc_id", F.when(F.col("lang") != "es", F.col("text")).alias("transcription"),
                       F.lit("unused").alias("description"))
    second = docs.select("doc_id", F.col("lang").alias("keywords"), F.col("text").alias("description"))
    found = []
    for name, rows in (("both", both), ("second", second)):
        path = scratch_path(spark, "csv")
        write_texts(rows, path, "doc_id")
        texts = tables.read_csv_texts(spark, path, ["transcription", "description"], CSV_ROWS)
        found.append(tables.first_texts(texts, CSV_ROWS, 1, name, "clinical_note").drop("row_id"))
    return found[0].unionByName(found[1])


def xml_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The first pairs of XML files in nested folders; damaged files count for nothing."""
    root = scratch_path(spark, "xml")
    write_pairs(spark, folder, root)
    return qa_xml.qa_records(qa_xml.scan_xml(spark, root), XML_PAIRS, 1, "files", "pair").drop("row_id")


def _ten_inputs(spark: SparkSession, folder: str) -> Inputs:
    """Raw material for the ten default sources, each in the form that its source reads, made of the given tables."""
    root = scratch_path(spark, "inputs")

    def save(name: str, rows: DataFrame) -> str:
        rows.write.parquet(f"{root}/{name}")
        return f"{root}/{name}"

    def named(seeds: list[str], place: F.Column) -> F.Column:
        return F.get(F.array(*[F.lit(s) for s in seeds]), place)

    docs = table(spark, folder, "documents")
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    region = F.col("n_regionkey").cast("int")
    top = [nation.select(category.alias("category"), F.col("n_name").alias("title"), F.lit(14).alias("ns"),
                         F.col("n_nationkey").cast("bigint").alias("pos"))
           for category in (named(MEDICAL_SEEDS, region), named(NON_MEDICAL_SEEDS, 6 - region))]
    below = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("category"), F.col("c_name").alias("title"), F.lit(0).alias("ns"),
        F.col("c_custkey").cast("bigint").alias("pos"))
    articles = docs.filter("lang <> 'de'").join(customer, F.col("doc_id") == F.col("c_custkey")).select(
        F.col("c_name").alias("title"), F.col("text").alias("extract"))
    numbered = docs.withColumnRenamed("doc_id", "row_id")
    write_pairs(spark, folder, f"{root}/xml")
    write_texts(docs.select("doc_id", F.when(F.col("lang") != "es", F.col("text")).alias("transcription"),
                            F.lit("unused").alias("description")), f"{root}/csv", "doc_id")
    # Three sources read the same texts: they are written once.
    texts = save("texts", numbered.select("row_id", "text", F.when(F.col("lang") == "de", "sci.med").otherwise(
        F.col("lang")).alias("category")))
    return Inputs(
        abstracts=save("abstracts", docs.select(
            (F.regexp_extract("source", "([0-9]+)$", 1).cast("int") % 25).alias("topic_no"),
            F.col("doc_id").alias("page_no"), F.replace("text", F.lit(". "), F.lit(".\n\n\n")).alias("raw"))),
        qa_folder=f"{root}/xml", notes_csv=f"{root}/csv", edges=save("edges", union_all([*top, below])),
        articles=save("articles", articles), question_pairs=save("pairs", exchanges(spark, folder)),
        news=texts, forum=texts,
        product_reviews=save("products", turns(spark, folder).select(
            "row_id", F.when(F.col("role") != "system", F.col("role")).alias("title"), F.col("text").alias("content"))),
        business_reviews=texts)


def ten_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The combined records of the ten default sources, side by side, after one run on files and tables of theirs."""
    sources, raw = default_sources(_ten_inputs(spark, folder), TEN_QUOTAS), scratch_path(spark, "raw")
    failed = [s for s in run_sources(spark, sources, raw) if s.status == "failed"]
    if failed:
        raise RuntimeError(f"sources that failed: {failed}")
    return combine(spark, sources, raw).drop("ord")


QUERIES = {f.__name__: f for f in (
    pipeline_build, skip_collect, build_counts, reuse_status, rebuild_keeps_rows, only_subset, csv_scan,
    xml_scan, ten_sources)}
