"""Text cleaning, gating, truncation and dedup keys as built-in Spark expressions.

All of it runs JVM-side. Java's ``\\s`` is narrower than Unicode whitespace, so the
whitespace class is spelled out.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.config import GATE_FACTOR, MAX_CHARS, MIN_CHARS, PREFIX_CHARS

# The 29 whitespace characters and the cleaning patterns.
WS_BODY = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
           r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = f"[{WS_BODY}]"
NOT_WS = f"[^{WS_BODY}]"
URL = f"http{NOT_WS}+|www\\.{NOT_WS}+"
QUOTED_LINE = r"(?dm)^&gt;.*$"  # only \n ends a line
UNDERSCORES = r"_{2,}"

WS_CHARS = "".join(map(chr, [*range(0x9, 0xe), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680,
                             *range(0x2000, 0x200b), 0x2028, 0x2029, 0x202f, 0x205f, 0x3000]))

# The link \[([^\]]+)\]\(([^)]+)\) and the tag <[^>]+>, each with a second branch for an opening that starts
# none: it is matched to where the attempt failed and put back. Without it every opening of a text
# full of them would scan to the end, in quadratic time.
MD_LINK = r"\[([^\]]++)\]\([^)]++\)|(\[[^\]]*+(?:\](?:\([^)]++\z)?+)?+)"
TAG = r"<[^>]++>|(<[^>]*+\z)"

# Whitespace at the edges. Most characters fail the first of the two ranges; an inner run is scanned once, from its start.
FAST_WS = r"[\x00-\x20\x7f-\x{ffff}&&" + f"[{WS_BODY}]]"
EDGES = f"\\A{FAST_WS}++|{FAST_WS}(?<!{FAST_WS}{{2}}){FAST_WS}*+\\z"

# A text holding none of these literals cannot match any of the five markup patterns.
MARKUP_LITERALS = ["<", "](", "http", "www.", "&gt;", "__"]


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` knows only U+0020).

    Few texts have any, and only these are searched. Pass a plain column: it is read several times.
    """
    spaces = F.lit(WS_CHARS)
    at_edge = (F.instr(spaces, F.left(text, F.lit(1))) > 0) | (F.instr(spaces, F.right(text, F.lit(1))) > 0)
    return F.when(at_edge, strip_edges(text)).otherwise(text)


def strip_edges(text: Column) -> Column:
    """``strip`` by a search of the whole text, which may be an expression."""
    return F.regexp_replace(text, EDGES, "")


def md_link_to_label(text: Column) -> Column:
    return F.regexp_replace(text, MD_LINK, "$1$2")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, TAG, "$1")


def strip_quoted_lines(text: Column) -> Column:
    return F.regexp_replace(text, QUOTED_LINE, "")


def strip_underscores(text: Column) -> Column:
    return F.regexp_replace(text, UNDERSCORES, "")


def collapse_whitespace(text: Column) -> Column:
    """Every whitespace run becomes one space; then edges are trimmed.

    Mapping the characters first and collapsing plain spaces after takes half the time of one regex
    over the whole class, which rewrites the single space after every word to itself.
    """
    spaces = F.translate(text, WS_CHARS, " " * len(WS_CHARS))
    return F.trim(F.regexp_replace(spaces, "  +", " "))


def clean_text(text: Column) -> Column:
    """Markdown links, URLs, tags, quoted lines, underscore runs, whitespace - in this order.

    Null cleans to the empty string. Pass a plain column: it is read several times.
    """
    has_markup = F.lit(False)
    for literal in MARKUP_LITERALS:
        has_markup = has_markup | F.contains(text, F.lit(literal))
    stripped = md_link_to_label(text)
    for step in (strip_urls, strip_tags, strip_quoted_lines, strip_underscores):
        stripped = step(stripped)
    return F.coalesce(collapse_whitespace(F.when(has_markup, stripped).otherwise(text)), F.lit(""))


def length_ok(text: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    return F.length(text).between(min_chars, max_chars * GATE_FACTOR)


def truncate_sentence(text: Column, max_chars: int = MAX_CHARS) -> Column:
    """Cut to ``max_chars`` after the last ". " of the second half, else exactly there."""
    cut = F.left(text, F.lit(max_chars))
    from_end = F.instr(F.reverse(cut), " .")
    period_index = F.lit(max_chars - 1) - from_end
    return (F.when(F.length(text) <= max_chars, text)
            .when((from_end > 0) & (period_index * 2 > max_chars),
                  F.left(text, period_index + 1))
            .otherwise(cut))


def normalise(text: Column) -> Column:
    """Lower-case, strip, collapse: the form that dedup compares."""
    return collapse_whitespace(F.lower(text))


def normalise_cleaned(text: Column) -> Column:
    """``normalise`` for the output of the cleaning chain, where runs are single spaces already.

    Truncation can leave one space at the end and nothing else to strip.
    """
    return F.trim(F.lower(text))


def exact_key(normalised: Column) -> Column:
    return F.md5(normalised)


def prefix_key(normalised: Column, prefix_chars: int = PREFIX_CHARS) -> Column:
    return F.md5(F.left(normalised, F.lit(prefix_chars)))


def fence(df: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns behind a one-element explode.

    Catalyst pushes a filter on a computed column below its projection by repeating the expression;
    it does not push through a generator, so each expression here is evaluated once per row.
    """
    names = list(columns)
    row = F.struct(*[columns[n].alias(n) for n in names])
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(row)))


def clean_and_filter(df: DataFrame, text: str = "text", min_chars: int = MIN_CHARS,
                     max_chars: int = MAX_CHARS) -> DataFrame:
    """Clean, gate by length, truncate. Map-only, every regex evaluated once."""
    order = df.columns
    cleaned = fence(df, **{text: clean_text(F.col(text))})
    gated = cleaned.filter(length_ok(F.col(text), min_chars, max_chars))
    return gated.withColumn(text, truncate_sentence(F.col(text), max_chars)).select(*order)


def clean_and_mark(df: DataFrame, text: str = "text", min_chars: int = MIN_CHARS,
                   max_chars: int = MAX_CHARS) -> DataFrame:
    """As ``clean_and_filter``, but a text that the gate rejects stays as a null."""
    cleaned = fence(df, **{text: clean_text(F.col(text))})
    kept = F.when(length_ok(F.col(text), min_chars, max_chars), truncate_sentence(F.col(text), max_chars))
    return fence(cleaned, **{text: kept}).select(*df.columns)


def with_dedup_keys(df: DataFrame, text: str = "text", cleaned: bool = False,
                    prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Add ``exact_key`` and ``prefix_key`` (md5 hex)."""
    norm = normalise_cleaned(F.col(text)) if cleaned else normalise(F.col(text))
    keyed = fence(df, _norm=norm)
    return keyed.select(*df.columns, exact_key(F.col("_norm")).alias("exact_key"),
                        prefix_key(F.col("_norm"), prefix_chars).alias("prefix_key"))
