"""Casual questions from templates, and the informality perturbation."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.config import (
    ATTEMPTS_PER_ROW, CONTRACTION_SHARE, CONTRACTIONS, DROP_QUESTION_SHARE, SEED, SYMPTOM_SHARE)
from evenkeel.functions.draws import chance, draw, pick
from evenkeel.functions.text import fence, strip_edges
from evenkeel.operators.records import first_seen, make_records
from evenkeel.operators.sampling import first_rows
from evenkeel.plans.staging import stage


@dataclass
class Vocabulary:
    """Texts with the slots {symptom} and {duration}, fixed questions, and slot fillers."""

    templates: list[str] = field(default_factory=lambda: [
        "Could {symptom} {duration} be a sign of something bad?",
        "my partner noticed {symptom} {duration}, do we call someone?",
        "I'm dealing with {symptom} {duration} and nothing helps",
        "{symptom} {duration}, what would you do",
        "who do i see about {symptom} {duration}?",
        "how worried should one be about {symptom} {duration}",
        "it started with {symptom} {duration}, now i'm scared",
        "my doctor can't see me and i have {symptom} {duration}",
        "any home remedy for {symptom} {duration}?",
        "{symptom} {duration} after a long flight, related?",
        "i don't know if {symptom} {duration} needs a checkup",
        "does anyone else get {symptom} {duration}?",
    ])
    questions: list[str] = field(default_factory=lambda: [
        "do i need a prescription for stronger cough syrup",
        "when can i shower after stitches",
        "which vaccine do i need before travelling",
        "how often should blood pressure be checked",
        "can i mix cold medicine with coffee",
        "is a low pulse a bad thing when resting",
        "what should i eat after food poisoning",
        "how long until a bruise goes away",
        "should i fast before a blood test",
        "can glasses make your eyes worse",
    ])
    symptoms: list[str] = field(default_factory=lambda: [
        f"{quality}{place} {feeling}"
        for quality in ("", "mild ", "bad ", "strange ")
        for place in ("shoulder", "stomach", "hip", "neck", "foot", "wrist")
        for feeling in ("ache", "cramps", "stiffness", "burning")])
    durations: list[str] = field(default_factory=lambda: [
        f"{span} {count} {unit}"
        for span in ("for about", "for over")
        for count in ("two", "three", "four")
        for unit in ("hours", "days", "weeks")])


def fill(template: Column, **slots: Column) -> Column:
    """Replace the named slots of a template."""
    for name, value in slots.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def informalise(df: DataFrame, text: str, row_id: str, seed: int = SEED,
                purpose: str = "informal") -> DataFrame:
    """Lower the first letter, drop apostrophes at random, drop a closing question mark at random.

    One projection per contraction: the text is read several times in each, and the fence at the end
    keeps later filters from unfolding them.
    """
    out = df.withColumn(text, F.concat(F.lower(F.left(text, F.lit(1))), F.substr(text, F.lit(2))))
    place = F.col(row_id)
    for number, (old, new) in enumerate(CONTRACTIONS):
        padded = F.concat(F.lit(" "), F.col(text), F.lit(" "))
        applies = chance(draw(purpose, place, number, seed), CONTRACTION_SHARE) & F.contains(
            padded, F.lit(old))
        out = out.withColumn(text, F.when(applies, strip_edges(F.replace(padded, F.lit(old), F.lit(new))))
                             .otherwise(F.col(text)))
    dropped = chance(draw(purpose, place, len(CONTRACTIONS), seed), DROP_QUESTION_SHARE)
    final = F.when(dropped, F.regexp_replace(text, r"\?\z", "")).otherwise(F.col(text))
    return fence(out, **{text: final}).select(*df.columns)


def generate(attempts: DataFrame, words: Vocabulary, row_id: str = "attempt",
             seed: int = SEED) -> DataFrame:
    """One perturbed text per attempt; an attempt's text depends on its number and the seed only."""
    place = F.col(row_id)

    def of(values: list[str], number: int) -> Column:
        return pick(draw("template", place, number, seed), values)

    symptom_text = fill(of(words.templates, 1), symptom=of(words.symptoms, 2),
                        duration=of(words.durations, 3))
    text = F.when(chance(draw("template", place, 0, seed), SYMPTOM_SHARE), symptom_text).otherwise(
        of(words.questions, 4))
    return informalise(attempts.select(row_id, text.alias("text")), "text", row_id, seed)


def distinct_texts(quota: int, words: Vocabulary, spark: SparkSession, seed: int = SEED) -> tuple[DataFrame, int]:
    """``text, attempt`` of at least ``quota`` distinct texts, if 20 attempts per row give so many; attempts made.

    Attempts are made in rounds of growing size until there are enough texts. A text belongs to its first
    attempt, so the rounds that are not made could not have changed the first ``quota``.
    """
    most, done, size, found = quota * ATTEMPTS_PER_ROW, 0, 2 * quota, None
    while done < most:
        stop = min(done + size, most)
        attempts = spark.range(done, stop).withColumnRenamed("id", "attempt")
        texts = first_seen(generate(attempts, words, seed=seed), "text", "attempt")
        if found is not None:
            texts = texts.join(found.select("text"), "text", "left_anti")
        new = stage(texts, "generated")
        found = new if found is None else found.unionByName(new)
        done, size = stop, 2 * size
        if found.count() >= quota:
            break
    return found, done


def template_records(spark: SparkSession, quota: int, label: int, source: str,
                     subtopic: str | None = None, words: Vocabulary | None = None,
                     seed: int = SEED) -> DataFrame:
    """The first ``quota`` distinct texts of at most 20 attempts per row."""
    texts, _ = distinct_texts(max(quota, 1), words or Vocabulary(), spark, seed)
    return make_records(first_rows(texts, quota, "attempt"), "text", label, source, subtopic, "attempt")
