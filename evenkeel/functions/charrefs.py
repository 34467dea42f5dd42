"""Character references of HTML, decoded by built-in expressions.

The names are the runtime's own table of named references, held as one constant map.
"""

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a reference looks, what stands for an impossible one, and the code points that are none.
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACEMENT = "�"
LAST_CODE, SURROGATES = 0x10FFFF, (0xD800, 0xDFFF)
NO_CHARACTERS = [(0x1, 0x8), (0xB, 0xB), (0xE, 0x1F), (0x7F, 0x7F), (0xFDD0, 0xFDEF)]
OLD_BYTES = (0x80, 0x9F)  # read as Windows-1252, where that has a character


def _old_byte(code: int) -> str:
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def _names() -> Column:
    """Name, with its semicolon if it needs one, to characters. Folded to a literal by the optimizer."""
    names, characters = " ".join(html5), "\x01".join(html5.values())
    return F.map_from_arrays(F.split(F.lit(names), " "), F.split(F.lit(characters), "\x01"))


# Names that count without a semicolon, the longest first.
BARE = "^(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)) + ")"


def _numbered(reference: Column) -> Column:
    digits = F.regexp_replace(reference, "^#[xX]?0*|;$", "")
    is_hex = F.lower(F.substring(reference, 2, 1)) == "x"
    known = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits)
    code = F.when(digits == "", 0).when(F.length(digits) > 7, LAST_CODE + 1).otherwise(known.cast("int"))
    nothing = (F.pmod(code, F.lit(0x10000)) >= 0xFFFE)
    for first, last in NO_CHARACTERS:
        nothing = nothing | code.between(first, last)
    old = F.array(*[F.lit(_old_byte(c)) for c in range(OLD_BYTES[0], OLD_BYTES[1] + 1)])
    character = F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32")
    return (F.when((code == 0) | code.between(*SURROGATES) | (code > LAST_CODE), REPLACEMENT)
            .when(code.between(*OLD_BYTES), F.get(old, code - OLD_BYTES[0]))
            .when(nothing, "").otherwise(character))


def _named(reference: Column) -> Column:
    names = _names()
    bare = F.regexp_extract(reference, BARE, 1)
    prefix = F.concat(F.element_at(names, bare), F.substr(reference, F.length(bare) + 1))
    return (F.when(reference == "amp;", "&")
            .otherwise(F.coalesce(F.element_at(names, reference), F.when(bare != "", prefix),
                                  F.concat(F.lit("&"), reference))))


def decoded(text: Column) -> Column:
    """``text`` with all references resolved: numbered, named, and names without semicolon at their longest match.

    Texts without an ampersand pass by. What is no reference stays as it is.
    """
    references = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))
    between = F.split(text, REFERENCE, -1)
    characters = F.transform(references, lambda r: F.when(F.startswith(r, F.lit("#")), _numbered(r)).otherwise(_named(r)))
    joined = F.zip_with(between, characters, lambda plain, c: F.concat(plain, F.coalesce(c, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(joined, "")).otherwise(text)
