"""The given tables as record inputs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.plans.staging import copy_beginning, stage
from evenkeel.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that have a label, as records; the document id is the row order."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    documents = spread(table(spark, folder, "documents").select("doc_id", "text", "source"))
    joined = documents.join(labels, "doc_id")
    return joined.select("text", F.col("label").cast("bigint").alias("label"), "source",
                         F.lit(None).cast("string").alias("subtopic"), F.col("doc_id").alias("ord"))


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of conversations with a row order."""
    return table(spark, folder, "conversations").withColumn("row_id", F.col("conv_id") * 100000 + F.col("turn"))


def exchanges(spark: SparkSession, folder: str) -> DataFrame:
    """User turns with the assistant turn that follows, if any: an equi-join on unique keys."""
    every = turns(spark, folder)
    asked = every.filter(F.col("role") == "user").select("row_id", F.col("text").alias("question_1"))
    answered = every.filter(F.col("role") == "assistant").select(
        (F.col("row_id") - 1).alias("row_id"), F.col("text").alias("question_2"))
    return asked.join(answered, "row_id", "left")


def write_pairs(spark: SparkSession, folder: str, root: str) -> None:
    """Exchanges as XML files, several a file, in two folders of which one is nested, and damaged files beside them.

    The damaged files end in the middle of a pair or begin with a broken declaration.
    """
    conversation = F.floor(F.col("row_id") / 100000)
    asked = stage(exchanges(spark, folder), "exchanges")

    def write(rows: DataFrame, name: str, **options: str) -> None:
        (rows.repartitionByRange(3, "row_id").sortWithinPartitions("row_id")
         .select(F.col("question_1").alias("Question"), F.col("question_2").alias("Answer"))
         .write.format("xml").options(rowTag="QAPair", rootTag="QAPairs", **options).save(f"{root}/{name}"))

    write(asked.filter(conversation % 3 == 0), "a")
    write(asked.filter(conversation % 3 == 1), "b/deeper")
    write(asked.filter(conversation % 3 == 2), "a/broken", declaration='version="1.0" <')
    first = spark.read.format("binaryFile").load(f"{root}/b/deeper").orderBy("path").select("path").first()["path"]
    copy_beginning(spark, first, f"{root}/a/cut-off.xml", 2 / 3)


def write_texts(rows: DataFrame, path: str, order: str) -> None:
    """CSV files in the order of a column, which is not written; as other programs write them: quotes doubled, blanks at
    the edges kept.

    What stands in no file should be gone from ``rows``: they are shuffled whole.
    """
    (rows.repartitionByRange(order).sortWithinPartitions(order).drop(order)
     .write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
