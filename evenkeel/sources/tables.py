"""Sources that are tables or CSV files of texts."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evenkeel.config import EXCLUDED_CATEGORIES, SEED
from evenkeel.functions.text import fence, strip
from evenkeel.operators.numbering import file_starts, number_in_files, with_place
from evenkeel.operators.records import first_seen, make_records, union_all
from evenkeel.operators.sampling import first_rows, halves, sample_exact
from evenkeel.plans.staging import stage
from evenkeel.schema import ROW_ID_BITS

SECOND_TABLE = 1 << (ROW_ID_BITS - 1)  # row ids of a source's second table follow the first's


def corpus_sample(df: DataFrame, quota: int, label: int, source: str, subtopic: str | None = None,
                  text: str = "text", row_id: str = "row_id", purpose: str | None = None,
                  seed: int = SEED) -> DataFrame:
    """Seeded shuffle of a corpus, first ``quota`` rows."""
    chosen = sample_exact(df.select(row_id, text), quota, row_id, purpose or source, seed=seed)
    return make_records(chosen, text, label, source, subtopic, row_id)


def two_table_sample(first: DataFrame, second: DataFrame, quota: int, label: int, source: str,
                     subtopics: tuple[str | None, str | None] = (None, None),
                     row_id: str = "row_id", seed: int = SEED) -> DataFrame:
    """Half the quota from ``first`` (title and content joined), the rest from ``second`` (text)."""
    first_quota, second_quota = halves(quota)
    titled = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("content", F.lit("")))
    a = sample_exact(first.select(row_id, "title", "content"), first_quota, row_id,
                     f"{source}/1", seed=seed)
    b = sample_exact(second.select(row_id, "text"), second_quota, row_id, f"{source}/2", seed=seed)
    return union_all([
        make_records(a, titled, label, source, subtopics[0], row_id),
        make_records(b, "text", label, source, subtopics[1], F.col(row_id) + SECOND_TABLE)])


def without_categories(df: DataFrame, excluded: list[str] = EXCLUDED_CATEGORIES,
                       category: str = "category") -> DataFrame:
    """Drop rows of the excluded categories; a row without a category stays."""
    return df.filter(F.coalesce(~F.col(category).isin(*excluded), F.lit(True)))


def category_sample(df: DataFrame, quota: int, label: int, source: str, subtopic: str | None = None,
                    excluded: list[str] = EXCLUDED_CATEGORIES, category: str = "category",
                    row_id: str = "row_id", seed: int = SEED) -> DataFrame:
    """Forum texts of the allowed categories: seeded shuffle, first ``quota`` rows."""
    allowed = without_categories(df, excluded, category)
    return corpus_sample(allowed, quota, label, source, subtopic, row_id=row_id, seed=seed)


def distinct_questions(df: DataFrame, first: str = "question_1", second: str = "question_2",
                       row_id: str = "row_id") -> DataFrame:
    """Both columns as one: stripped, non-empty, distinct, placed by first occurrence."""
    sides = df.select(F.col(row_id).alias("_row"), F.inline(F.array(
        F.struct(F.lit(0).alias("side"), F.col(first).alias("raw")),
        F.struct(F.lit(1).alias("side"), F.col(second).alias("raw")))))
    texts = fence(sides, text=strip(F.col("raw"))).filter(F.col("text") != "")
    placed = texts.select("text", (F.col("_row") * 2 + F.col("side")).alias("row_id"))
    return first_seen(placed, "text", "row_id")


def question_pairs(df: DataFrame, quota: int, label: int, source: str, subtopic: str | None = None,
                   first: str = "question_1", second: str = "question_2",
                   row_id: str = "row_id") -> DataFrame:
    """The first ``quota`` distinct questions of a question-pair table."""
    questions = stage(distinct_questions(df, first, second, row_id), "questions")
    return make_records(first_rows(questions, quota, "row_id"), "text", label, source, subtopic)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A CSV with header; quoted fields may hold newlines, and quotes doubled as ""."""
    reader = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    return (reader.schema(schema) if schema else reader).csv(path)


def file_name() -> Column:
    """The file of a scanned row, as ``_file``."""
    return F.col("_metadata.file_path").alias("_file")


def number_lines(rows: DataFrame, most: int | None = None) -> DataFrame:
    """``row_id`` for the rows of a CSV scan with ``file_name``: 0, 1, ... by file name, then place; the first ``most``.

    The files are read twice, once to count their rows and once for the rows themselves, from the first file to the one
    in which the cut falls. Nothing but a count per file is shuffled.
    """
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"))
    starts = file_starts(sizes, "_file", most)
    last = starts.extent("_file")[1]
    wanted = rows if most is None else rows.filter(F.col("_file") <= F.lit(last))
    return number_in_files(with_place(wanted), starts, "_file", "_nth", most)


def read_csv_texts(spark: SparkSession, path: str, candidates: list[str], most: int | None = None) -> DataFrame:
    """``text, row_id``: one column of a CSV, the first candidate that exists, without nulls, in file order."""
    raw = read_csv(spark, path)
    text = F.col(column_fallback(raw, candidates)).cast("string").alias("text")
    return number_lines(raw.select(file_name(), text).filter(F.col("text").isNotNull()), most)


def column_fallback(df: DataFrame, candidates: list[str]) -> str:
    """The first of ``candidates`` that the table has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of the columns {candidates} exists")


def column_texts(df: DataFrame, candidates: list[str], row_id: str = "row_id") -> DataFrame:
    """The fallback column as text, nulls dropped."""
    text = F.col(column_fallback(df, candidates)).cast("string")
    return df.select(text.alias("text"), F.col(row_id).alias("row_id")).filter(
        F.col("text").isNotNull())


def first_texts(texts: DataFrame, quota: int, label: int, source: str,
                subtopic: str | None = None) -> DataFrame:
    """Records of the first ``quota`` texts in row order."""
    return make_records(first_rows(texts, quota, "row_id"), "text", label, source, subtopic)
