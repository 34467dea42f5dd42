"""Quality rules: statistics of texts and a decision list learned from labelled ones, all in DataFrame functions.

Sequential covering: a rule is a conjunction of thresholds grown condition by condition on two thirds of the
labelled rows and pruned on the rest; accepted rules are taken off the rows and the next one is grown. Each
step counts labels per feature and bin in one aggregation, which is all that the driver sees.
"""

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.plans.staging import stage

SPACE = "[\\x20\\x09-\\x0D]+"
WINDOW = 8
SYMBOLS = "#*$%&|<>"
BINS = 32
MOST_RULES = 8
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.9
LEAST_COVERED = 5


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(characters: str) -> Column:
    """Characters of the class in the text."""
    return F.length("text") - F.length(F.regexp_replace("text", f"[{characters}]+", ""))


def _repeated(windows: Column) -> Column:
    """Number of words in windows that occur twice or more."""
    def spread(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def places(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, j: F.coalesce(
            (F.get(ordered, j - 1)["k"] == x["k"]), F.lit(False)) | F.coalesce(
            (F.get(ordered, j + 1)["k"] == x["k"]), F.lit(False)))
        return _bind(F.sort_array(F.transform(twice, lambda x: x["i"])), spread)

    keyed = F.transform(windows, lambda k, i: F.struct(k.alias("k"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        _bind(F.sort_array(keyed), places))


def _windows(hashes: Column) -> Column:
    """Hash of every run of eight words."""
    return F.when(F.size(hashes) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(
            *[F.get(hashes, i + k) for k in range(WINDOW)])))


def statistics(docs: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """Statistics of every whole text, a null text having no words, and the columns named in ``others``.

    Besides the base ones: ``n_lines`` with a word, ``n_distinct`` words, ``n_upper`` A-Z, ``n_marks`` (!?|).
    Columns of ``docs`` with the name of a statistic may not be among ``others``.
    """
    kept = [c for c in others if c != "doc_id"]
    rows = docs.select("doc_id", *[c for c in kept if c != "text"], F.col("text").alias("_kept"),
                       F.coalesce("text", F.lit("")).alias("text"))
    split = rows.withColumns({
        "_words": F.array_remove(F.split("text", SPACE), ""),
        "_lines": F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))})
    counted = split.withColumn("_runs", _bind(
        F.transform("_words", lambda w: F.xxhash64(w)), lambda hashes: F.struct(
            F.size(F.array_distinct(hashes)).alias("distinct"),
            _bind(_windows(hashes), _repeated).alias("repeated"))))
    return counted.select(
        "doc_id", *[F.col("_kept").alias("text") if c == "text" else F.col(c) for c in kept],
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        _count(SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.col("_runs.repeated").cast("bigint").alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.col("_runs.distinct").cast("bigint").alias("n_distinct"),
        _count("A-Z").cast("bigint").alias("n_upper"),
        _count("!?|").cast("bigint").alias("n_marks"))


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
              "n_upper", "n_marks"]


def _share(part: str, whole: str) -> Column:
    return F.expr(f"1000L * {part} div greatest({whole}, 1L)")


FEATURES = {
    "n_words": F.col, "word_length": lambda _: _share("word_chars", "n_words"),
    "symbols": lambda _: _share("n_symbols", "n_words"), "dup_lines": lambda _: _share("n_dup_lines", "n_lines"),
    "repeats": lambda _: _share("n_repeat_words", "n_words"), "distinct": lambda _: _share("n_distinct", "n_words"),
    "upper": lambda _: _share("n_upper", "word_chars"), "marks": lambda _: _share("n_marks", "n_words"),
}


def feature(name: str) -> Column:
    return FEATURES[name](name)


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` or ``feature <= threshold``; ``bin`` is the threshold's number."""

    name: str
    above: bool
    threshold: int
    bin: int

    def on_bins(self) -> Column:
        return F.col(self.name) > self.bin if self.above else F.col(self.name) <= self.bin

    def on_statistics(self) -> Column:
        return feature(self.name) > self.threshold if self.above else feature(self.name) <= self.threshold


def _all(conditions: list[Condition], how: str) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & getattr(c, how)()
    return out


@dataclass
class DecisionList:
    """Ordered rules; the first one that holds rejects the text."""

    rules: list[list[Condition]] = field(default_factory=list)

    def kept(self) -> Column:
        """The list as one conditional expression over the statistics, after the fixed base rule."""
        out = F.when(base_failed(), False)
        for rule in self.rules:
            out = out.when(_all(rule, "on_statistics"), False)
        return out.otherwise(True)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def learn(stats: DataFrame, labels: DataFrame) -> DecisionList:
    """The decision list for ``quality`` 0 among the labelled rows; no rules without both classes."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    joined = stats.join(known, "doc_id").select("doc_id", "quality", *[feature(f).alias(f) for f in FEATURES])
    steps = [k / BINS for k in range(BINS + 1)]
    quantiles = joined.groupBy("quality").agg(*[
        F.percentile_approx(f, steps, 1000).alias(f) for f in FEATURES]).collect()
    if len(quantiles) < 2:
        return DecisionList()
    cuts = {f: sorted({v for r in quantiles for v in r[f]}) for f in FEATURES}

    def bin_of(name: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[name])), lambda cut: cut < F.col(name))).alias(name)

    # The bin is the number of cuts below the value: bin > b says value > cuts[b].
    rows = stage(joined.select((F.crc32(F.col("doc_id").cast("string")) % 3 == 0).alias("prune"),
                               (F.col("quality") == 0).alias("bad"), *map(bin_of, FEATURES)), "labelled")
    found = DecisionList()
    while len(found.rules) < MOST_RULES:
        rule = _prune(_grow(rows.filter(~F.col("prune")), cuts), rows.filter("prune"))
        if not rule:
            break
        found.rules.append(rule)
        rows = rows.filter(~_all(rule, "on_bins"))
    return found


def _grow(rows: DataFrame, cuts: dict[str, list[int]]) -> list[Condition]:
    """Add the condition of the largest information gain while it removes good rows."""
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS:
        cells = (rows.filter(_all(rule, "on_bins"))
                 .select("bad", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b"))
                                                    for f in FEATURES])).alias("x"))
                 .groupBy("x.f", "x.b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")))
        counts: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in FEATURES}
        for r in cells.collect():  # at most a row per feature and bin
            counts[r["f"]][r["b"]] = (r["p"], r["n"])
        whole = [sum(v) for v in zip((0, 0), *counts["n_words"].values(), strict=True)]
        if not all(whole):
            break
        best = (0.0, None)
        for f, bins in counts.items():
            p = n = 0
            for b in range(len(cuts[f])):
                p, n = p + bins.get(b, (0, 0))[0], n + bins.get(b, (0, 0))[1]
                for above, hit, miss in ((False, p, n), (True, whole[0] - p, whole[1] - n)):
                    gain = hit * (math.log2(hit / (hit + miss)) - math.log2(whole[0] / sum(whole))) if hit else 0
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(f, above, cuts[f][b], b))
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def _prune(rule: list[Condition], rows: DataFrame) -> list[Condition]:
    """The beginning of the rule that does best on other rows; empty if none is precise enough."""
    if not rule:
        return []
    sums = []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k], "on_bins")
        sums += [F.count_if(hit & F.col("bad")).alias(f"p{k}"), F.count_if(hit & ~F.col("bad")).alias(f"n{k}")]
    r = rows.agg(*sums).first()
    worth = {k: (r[f"p{k}"] - r[f"n{k}"]) / (r[f"p{k}"] + r[f"n{k}"])
             for k in range(1, len(rule) + 1)
             if r[f"p{k}"] >= LEAST_COVERED and r[f"p{k}"] >= LEAST_PRECISION * (r[f"p{k}"] + r[f"n{k}"])}
    return rule[:max(worth, key=lambda k: (worth[k], -k))] if worth else []


def judge(docs: DataFrame, labels: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed`` and ``kept`` of every text, and the columns in ``others``.

    A null or empty text has no words and fails the base rule. Labels that are null, other than 0 and 1 or
    without a document are not learned from; of several for one document the lowest counts. With no labels
    of both kinds only the base rule decides. Repeated rows give repeated rows.
    """
    stats = stage(statistics(docs, others), "statistics")
    rules = learn(stats, labels)
    kept = [c for c in others if c != "doc_id"]
    return stats.select("doc_id", *kept, *STATISTICS, base_failed().alias("base_failed"),
                        rules.kept().alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, in their own columns.

    Each row is judged by its text alone: repeated rows and rows without a ``doc_id`` stay or go with it, null and
    empty texts go. An empty table gives no rows; without labels the base rule decides.
    """
    own = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    renamed = docs.withColumnsRenamed(own)
    judged = judge(renamed, labels, tuple(renamed.columns)).filter("kept")
    return judged.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])
