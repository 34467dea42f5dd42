"""Exact positional cuts without a global sort.

"The first n rows of each group by key" would, as a window, sort each group in one task; with two
labels that is two tasks for the whole corpus. Here the row at which a cut falls is found first, and
then every row is kept or dropped by comparing its key with that row's - a map-side filter.

To find the row, the key range of the groups is divided into equal buckets and counted with map-side
partial aggregation; the running count names the bucket that holds it. The bucket is divided again
while it has more than ``RANK_AT_MOST`` rows, and only what is left is sorted. Groups known to be
smaller than that are sorted at once.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from evenkeel.functions.draws import ORDER_KEY_SPACE
from evenkeel.plans.staging import Pinned, local_table, look_up, pin

BUCKETS = 4096
RANK_AT_MOST = 200_000
HASH_RANGE = (0, ORDER_KEY_SPACE - 1)
ANY_ID = (-(1 << 63), (1 << 63) - 1)
WIDE = "decimal(38,0)"  # spans of BIGINT ranges need not fit in a BIGINT


@dataclass
class Cuts:
    """Where the cuts fall: per group, ``key_i`` and ``tie_i`` of the last row before cut i.

    Null means that the cut lies beyond the group's last row.
    """

    table: Pinned
    groups: list[str]
    count: int


def locate_cuts(rows: DataFrame, groups: list[str], key: str, tie: str, targets: Pinned,
                cut_count: int, largest_group: int, key_range: tuple[int, int] = HASH_RANGE,
                tie_range: tuple[int, int] = ANY_ID, rank_at_most: int = RANK_AT_MOST,
                buckets: int = BUCKETS) -> Cuts:
    """Find the row at every cut.

    ``targets`` has one row per group and cut: groups, ``cut`` (0-based) and ``target``, the number of
    rows before the cut. ``key`` and ``tie`` are BIGINT columns that order the rows of a group
    strictly, with values in the given ranges (ends included).
    """
    known = F.when(F.col(tie).isNull(), F.raise_error(F.lit(f"null {tie}: rows need an id to be ordered"))).otherwise(
        F.col(tie))
    slim = rows.select(*groups, F.col(key).alias("_key"), known.cast("bigint").alias("_tie"))
    bounds = {"lo": key_range[0], "hi": key_range[1], "tie_lo": tie_range[0], "tie_hi": tie_range[1],
              "before": 0, "c": largest_group}
    wanted = targets.df.filter(F.col("target") > 0).withColumns(
        {name: F.lit(value).cast("bigint") for name, value in bounds.items()})
    found = Pinned(wanted, targets.small)
    if largest_group > rank_at_most:
        found = _narrow(slim, groups, found, rank_at_most, buckets)
        while _oversized(found, rank_at_most):
            found = _narrow(slim, groups, found, rank_at_most, buckets)

    w = Window.partitionBy(*groups, "cut").orderBy("_key", "_tie")
    # Rows that agree in key and tie on both sides of a cut would all be before it.
    repeated = F.lead(F.struct("_key", "_tie")).over(w) == F.struct("_key", "_tie")
    strict = F.when(F.col("_repeated"), F.raise_error(F.lit(f"repeated {tie} at a cut: rows need ids of their own to be ordered")))
    at_cut = (_inside(slim, groups, found)
              .withColumns({"_rank": F.col("before") + F.row_number().over(w), "_repeated": F.coalesce(repeated, F.lit(False))})
              .filter(F.col("_rank") == F.col("target"))
              .select(*groups, "cut", F.col("_key").alias("key"), F.coalesce(strict.cast("bigint"), "_tie").alias("tie")))
    # No row precedes an empty cut: a key below the range puts all rows behind it.
    empty = (targets.df.filter(F.col("target") <= 0)
             .select(*groups, "cut", F.lit(key_range[0] - 1).cast("bigint").alias("key"),
                     F.lit(0).cast("bigint").alias("tie")))
    return Cuts(_one_row_per_group(pin(at_cut.unionByName(empty), "cuts"), groups, cut_count),
                groups, cut_count)


def _inside(slim: DataFrame, groups: list[str], found: Pinned) -> DataFrame:
    """The rows within the range of each cut; a row within two ranges comes twice."""
    return look_up(slim, found, groups).filter(
        F.col("_key").between(F.col("lo"), F.col("hi"))
        & F.col("_tie").between(F.col("tie_lo"), F.col("tie_hi")))


def _too_big(rank_at_most: int) -> Column:
    return (F.col("c") > rank_at_most) & (
        (F.col("hi") > F.col("lo")) | (F.col("tie_hi") > F.col("tie_lo")))


def _oversized(found: Pinned, rank_at_most: int) -> bool:
    return not found.df.filter(_too_big(rank_at_most)).isEmpty()


def _narrow(slim: DataFrame, groups: list[str], found: Pinned, rank_at_most: int,
            buckets: int) -> Pinned:
    """Replace every oversized range by the one of its buckets that holds the cut.

    The key is divided while the range has more than one; then the ties of that one key are, so that a
    key shared by a third of all rows is no obstacle.
    """
    by_key = F.col("hi") > F.col("lo")

    def minus(a: str, b: str) -> Column:
        return F.col(a).cast(WIDE) - F.col(b).cast(WIDE)

    span = F.when(by_key, minus("hi", "lo")).otherwise(minus("tie_hi", "tie_lo"))
    wide = (found.df.filter(_too_big(rank_at_most)).withColumn("_span", span)
            .withColumn("w", F.expr(f"_span div {buckets}L + 1")).drop("c", "_span"))
    offset = F.when(by_key, minus("_key", "lo")).otherwise(minus("_tie", "tie_lo"))
    inside = _inside(slim, groups, Pinned(wide, found.small)).withColumn("_offset", offset)
    hist = (inside.groupBy(*groups, "cut", F.expr("_offset div w").alias("b"))
            .agg(F.count(F.lit(1)).alias("c")))
    running = F.sum("c").over(Window.partitionBy(*groups, "cut").orderBy("b"))
    counted = (look_up(hist.withColumn("_running", running), Pinned(wide, found.small), [*groups, "cut"])
               .withColumn("upto", F.col("before") + F.col("_running")))
    ahead = F.col("upto") - F.col("c")

    def divided(low: str, high: str, mine: Column) -> tuple[Column, Column]:
        start = F.col(low).cast(WIDE) + F.col("b").cast("decimal(18,0)") * F.col("w").cast("decimal(19,0)")
        end = F.least(start + (F.col("w") - 1), F.col(high).cast(WIDE))
        return (F.when(mine, start).otherwise(F.col(low)).cast("bigint").alias(low),
                F.when(mine, end).otherwise(F.col(high)).cast("bigint").alias(high))

    hit = (counted.filter((ahead < F.col("target")) & (F.col("target") <= F.col("upto")))
           .select(*groups, "cut", "target", *divided("lo", "hi", by_key),
                   *divided("tie_lo", "tie_hi", ~by_key), ahead.alias("before"), "c"))
    settled = found.df.filter(~_too_big(rank_at_most)).select(*hit.columns)
    return pin(settled.unionByName(hit), "cuts")


def _one_row_per_group(cuts: Pinned, groups: list[str], cut_count: int) -> Pinned:
    fields = [(f"{name}_{i}", name, i) for i in range(cut_count) for name in ("key", "tie")]
    if cuts.rows is None:
        pivot = cuts.df.groupBy(*groups).agg(
            *[F.max(F.when(F.col("cut") == i, F.col(name))).alias(out) for out, name, i in fields])
        return pin(pivot, "cuts")
    by_group: dict[tuple, dict] = {}
    for r in cuts.rows:
        by_group.setdefault(tuple(r[g] for g in groups), {})[r["cut"]] = r
    named = Row(*groups, *[out for out, _, _ in fields])
    rows = [named(*group, *[at[i][name] if i in at else None for _, name, i in fields])
            for group, at in by_group.items()]
    schema = cuts.df.select(*groups, *[F.col(name).alias(out) for out, name, _ in fields]).schema
    return Pinned(local_table(cuts.df.sparkSession, rows, schema), True, rows)


def _beyond(key: Column, tie: Column, cut_key: Column, cut_tie: Column) -> Column:
    return F.coalesce((key > cut_key) | ((key == cut_key) & (tie > cut_tie)), F.lit(False))


def with_segment(rows: DataFrame, key: str, tie: str, cuts: Cuts, name: str = "segment") -> DataFrame:
    """Add the number of cuts that lie before each row."""
    placed = look_up(rows, cuts.table, cuts.groups, "left")
    passed = sum((_beyond(F.col(key), F.col(tie), F.col(f"key_{i}"), F.col(f"tie_{i}")).cast("int")
                  for i in range(cuts.count)), F.lit(0))
    return placed.select(*rows.columns, passed.alias(name))


def before_cut(rows: DataFrame, key: str, tie: str, cuts: Cuts) -> DataFrame:
    """The rows before the first cut."""
    placed = look_up(rows, cuts.table, cuts.groups, "left")
    return placed.filter(~_beyond(F.col(key), F.col(tie), F.col("key_0"), F.col("tie_0"))).select(
        *rows.columns)


def first_n(rows: DataFrame, n: int, key: Column, tie: str, groups: list[str] = (),
            key_range: tuple[int, int] | None = None, rank_at_most: int = RANK_AT_MOST,
            buckets: int = BUCKETS) -> DataFrame:
    """Exactly the first ``min(n, size)`` rows of every group by ``key`` then ``tie``.

    Both are non-null BIGINTs that order the rows strictly. The range of ``key`` is read from the
    data when it is not given.
    """
    order = rows.columns
    groups = list(groups) or ["_all"]
    keyed = rows.withColumns({"_order": key, "_tied": F.col(tie).cast("bigint")})
    if groups == ["_all"]:
        keyed = keyed.withColumn("_all", F.lit(0))
    spans = [F.min("_tied").alias("tie_lo"), F.max("_tied").alias("tie_hi")]
    if key_range is None:
        spans += [F.min("_order").alias("lo"), F.max("_order").alias("hi")]
    sizes = pin(keyed.groupBy(*groups).agg(F.count(F.lit(1)).alias("rows"), *spans), "sizes")
    largest = sizes.extent("rows")[1]
    if largest is None or largest <= n:
        return rows
    span, tie_span = (
        (sizes.extent(f"{prefix}lo")[0], sizes.extent(f"{prefix}hi")[1]) if known is None else known
        for prefix, known in (("", key_range), ("tie_", None)))
    targets = Pinned(sizes.df.filter(F.col("rows") > n).select(
        *groups, F.lit(0).alias("cut"), F.lit(n).cast("bigint").alias("target")), sizes.small)
    cuts = locate_cuts(keyed, groups, "_order", "_tied", targets, 1, largest, span, tie_span,
                       rank_at_most, buckets)
    if groups == ["_all"]:
        at = cuts.table.rows[0] if cuts.table.rows else cuts.table.df.first()
        last = (F.lit(at["key_0"]), F.lit(at["tie_0"]))
        return keyed.filter(~_beyond(F.col("_order"), F.col("_tied"), *last)).select(*order)
    return before_cut(keyed, "_order", "_tied", cuts).select(*order)
