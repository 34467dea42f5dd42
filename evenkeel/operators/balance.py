"""Class balance and stratified split by exact counts.

Both work on narrow rows (``ord``, ``label``, ``source``); texts are joined at the very end.
"""

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.config import RARE_STRATUM_ROWS, SEED, TRAIN_FRACTION, VAL_FRACTION
from evenkeel.functions.draws import name_key, order_key
from evenkeel.operators.ranking import HASH_RANGE, Cuts, before_cut, locate_cuts, with_segment
from evenkeel.plans.staging import Pinned, local_table, look_up, pin

SPLITS = ["train", "val", "test"]
SEAT_SCHEMA = T.StructType([T.StructField("_all", T.IntegerType()), T.StructField("cut", T.IntegerType()),
                            T.StructField("target", T.LongType())])
WIDE = "decimal(19,0)"  # the product of two row counts does not fit a BIGINT


def label_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


def minority_size(counts: DataFrame) -> DataFrame:
    return counts.agg(F.min("rows").alias("minority"))


def balance_cuts(rows: DataFrame, order: str = "ord", seed: int = SEED,
                 counts: Pinned | None = None) -> Cuts | None:
    """The cut of every class at the size of the smallest; None when all have the same size."""
    counts = counts or pin(label_counts(rows), "label-counts")
    minority, majority = counts.extent("rows")
    if minority == majority:
        return None
    targets = Pinned(counts.df.select("label", F.lit(0).alias("cut"),
                                      F.lit(minority).cast("bigint").alias("target")), counts.small)
    keyed = rows.withColumn("_key", order_key("balance", F.col(order), seed))
    return locate_cuts(keyed, ["label"], "_key", order, targets, 1, majority)


def in_balance(rows: DataFrame, cuts: Cuts | None, name: str = "balanced", order: str = "ord",
               seed: int = SEED) -> DataFrame:
    """Every row with a mark: does it lie before the cut of its class?"""
    if cuts is None:
        return rows.withColumn(name, F.lit(True))
    keyed = rows.withColumn("_key", order_key("balance", F.col(order), seed))
    return with_segment(keyed, "_key", order, cuts, "_passed").select(*rows.columns, (F.col("_passed") == 0).alias(name))


def within_balance(rows: DataFrame, cuts: Cuts | None, order: str = "ord",
                   seed: int = SEED) -> DataFrame:
    """The rows that the class cuts keep: a map-side filter on label and ``order``."""
    if cuts is None:
        return rows
    keyed = rows.withColumn("_key", order_key("balance", F.col(order), seed))
    return before_cut(keyed, "_key", order, cuts).select(*rows.columns)


def balance_classes(rows: DataFrame, order: str = "ord", seed: int = SEED) -> DataFrame:
    """Sample every class, without replacement, down to the size of the smallest."""
    return within_balance(rows, balance_cuts(rows, order, seed), order, seed)


def strata_counts(rows: DataFrame) -> DataFrame:
    """Rows per label and source with the stratum name; small strata fold into the bare label."""
    counted = rows.groupBy("label", "source").agg(F.count(F.lit(1)).alias("rows"))
    label = F.col("label").cast("string")
    name = F.concat(label, F.lit("_"), F.coalesce(F.col("source"), F.lit("")))
    return counted.withColumn(
        "stratum", F.when(F.col("rows") < RARE_STRATUM_ROWS, label).otherwise(name))


def with_strata(rows: DataFrame) -> DataFrame:
    """Attach the stratum to every row."""
    table = pin(strata_counts(rows).select("label", "source", "stratum"), "strata")
    return look_up(rows, table, ["label", "source"])


def _div(a: Column, b: Column) -> Column:
    """Integer quotient of non-negative values."""
    return ((a - a % b.cast(WIDE)) / b.cast(WIDE)).cast("bigint")


def with_seats(strata: DataFrame, size: str, drawn: int, seats: str, seed: int = SEED) -> DataFrame:
    """Add ``seats``: the largest-remainder share of ``drawn`` in proportion to ``size``.

    Every stratum gets the whole part of its share. The seats that are left go to the largest remainders, and the last of
    these is found as any cut is: by counts of remainder ranges, ties by a hash of the name. So strata
    are never sorted in one task, however many there are.
    """
    share = F.col(size).cast(WIDE) * F.lit(drawn).cast(WIDE)
    total, many = strata.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    if not total:
        return strata.withColumn(seats, F.lit(0).cast("bigint"))
    shared = strata.withColumns({"_whole": _div(share, F.lit(total)), "_behind": -(share % F.lit(total).cast(WIDE)).cast("bigint"),
                                 "_all": F.lit(0), "_tie": name_key(F.col("stratum"), seed)})
    left = drawn - (shared.agg(F.sum("_whole")).first()[0] or 0)
    target = local_table(strata.sparkSession, [(0, 0, left)], SEAT_SCHEMA)
    cuts = locate_cuts(shared, ["_all"], "_behind", "_tie", Pinned(target, True), 1, many, (-total, 0), HASH_RANGE)
    placed = with_segment(shared, "_behind", "_tie", cuts, "_later")
    return placed.select(*strata.columns, (F.col("_whole") + F.when(F.col("_later") == 0, 1).otherwise(0)).alias(seats))


def split_targets(strata: DataFrame, train: str = TRAIN_FRACTION, val: str = VAL_FRACTION,
                  seed: int = SEED) -> DataFrame:
    """Train and validation sizes per stratum by largest remainder.

    ``strata`` has one row per stratum (``stratum, rows``). Of N rows, floor(train * N) are train; of
    the rest, floor(val / (1 - train)) of it are validation. Remainder ties go by a hash of the
    stratum name - by name they would favour one label.
    """
    total = strata.agg(F.sum("rows")).first()[0] or 0
    train_rows = int(total * Fraction(train))
    val_rows = int((total - train_rows) * (Fraction(val) / (1 - Fraction(train))))
    trained = with_seats(strata.select("stratum", "rows"), "rows", train_rows, "train", seed)
    rest = trained.withColumn("_left", F.col("rows") - F.col("train"))
    return with_seats(rest, "_left", val_rows, "val", seed).select(
        "stratum", "rows", "train", "val", (F.col("_left") - F.col("val")).alias("test"))


@dataclass
class SplitPlan:
    """Strata and their cuts: enough to place any row of the table by label, source and ``order``."""

    strata: Pinned
    cuts: Cuts


def split_plan(rows: DataFrame, order: str = "ord", train: str = TRAIN_FRACTION,
               val: str = VAL_FRACTION, seed: int = SEED) -> SplitPlan:
    """Count the strata, share out the split sizes and find the rows at which the splits end."""
    counted = pin(strata_counts(rows), "strata")
    names = Pinned(counted.df.select("label", "source", "stratum"), counted.small)
    strata = pin(counted.df.groupBy("stratum").agg(F.sum("rows").alias("rows")), "stratum-sizes")
    sizes = split_targets(strata.df, train, val, seed)
    targets = pin(sizes.select("stratum", "rows", F.inline(F.array(
        F.struct(F.lit(0).alias("cut"), F.col("train").alias("target")),
        F.struct(F.lit(1).alias("cut"), (F.col("train") + F.col("val")).alias("target"))))),
        "split-targets")
    largest = targets.extent("rows")[1] or 0
    keyed = _split_keyed(rows, names, order, seed)
    cuts = locate_cuts(keyed, ["stratum"], "_key", order,
                       Pinned(targets.df.drop("rows"), targets.small), 2, largest)
    return SplitPlan(names, cuts)


def _split_keyed(rows: DataFrame, names: Pinned, order: str, seed: int, how: str = "inner") -> DataFrame:
    return look_up(rows, names, ["label", "source"], how).withColumn(
        "_key", order_key("split", F.col(order), seed))


def with_split(rows: DataFrame, plan: SplitPlan, order: str = "ord", seed: int = SEED,
               how: str = "inner") -> DataFrame:
    """Add ``split``: train, val or test. Map-side. Rows of strata that the plan does not know go, unless ``how`` is left."""
    placed = with_segment(_split_keyed(rows, plan.strata, order, seed, how), "_key", order, plan.cuts)
    split = F.get(F.array(*[F.lit(s) for s in SPLITS]), F.col("segment"))
    return placed.select(*rows.columns, split.alias("split"))


def stratified_split(rows: DataFrame, order: str = "ord", train: str = TRAIN_FRACTION,
                     val: str = VAL_FRACTION, seed: int = SEED) -> DataFrame:
    """Add ``split``: train, val or test, stratified by label and source."""
    return with_split(rows, split_plan(rows, order, train, val, seed), order, seed)
