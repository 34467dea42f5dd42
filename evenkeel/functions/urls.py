"""URL parts and reference resolution as built-in expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def _part(url: Column, pattern: str) -> Column:
    return F.regexp_extract(url, pattern, 1)


def origin(url: Column) -> Column:
    """``scheme://host`` of an absolute URL."""
    return _part(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)")


def host(url: Column) -> Column:
    return F.lower(_part(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"))


def canonical(url: Column) -> Column:
    """One form for the ways to write a URL: scheme and host in lower case, no default port, no fragment, a path."""
    scheme, rest = F.lower(_part(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://")), _part(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)")
    port = F.when(scheme == "http", ":80").when(scheme == "https", ":443").otherwise(":")
    place = F.when(F.endswith(host(url), port), F.left(host(url), F.length(host(url)) - F.length(port))).otherwise(host(url))
    path = F.when(F.left(rest, F.lit(1)) == "/", rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(scheme != "", F.concat(scheme, F.lit("://"), place, path)).otherwise(F.regexp_replace(url, "#.*$", ""))


def percent_decoded(text: Column) -> Column:
    """Resolve percent escapes; a text with a broken escape stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def path_and_query(url: Column) -> Column:
    """What crawl rules match on: everything after the host, "/" if there is nothing."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.when(rest == "", "/").otherwise(percent_decoded(rest))


def _remove_dots(path: Column) -> Column:
    """Resolve "." and ".." segments of an absolute path."""
    segments = F.split(F.substr(path, F.lit(2)), "/")
    walked = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done).otherwise(F.array_append(done, s)))
    folder = F.element_at(segments, -1).isin(".", "..")
    joined = F.concat(F.lit("/"), F.array_join(walked, "/"))
    return F.when(folder & (F.size(walked) > 0), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve(base: Column, href: Column) -> Column:
    """Absolute URL of a reference found on a page at ``base``."""
    no_fragment = F.regexp_replace(base, "#.*$", "")
    no_query = F.regexp_replace(base, "[?#].*$", "")
    base_path = F.regexp_replace(no_query, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    folder = F.regexp_replace(F.when(base_path == "", F.lit("/")).otherwise(base_path), "[^/]*$", "")
    path = _part(href, "^([^?#]*)")
    tail = F.regexp_replace(href, "^[^?#]*", "")
    full = F.when(F.left(path, F.lit(1)) == "/", path).otherwise(F.concat(folder, path))
    dotted = F.contains(full, F.lit("/."))
    clean = F.when(dotted, _remove_dots(full)).otherwise(full)
    return (F.when(href == "", base)
            .when(F.regexp_like(href, F.lit(SCHEME)), href)
            .when(F.left(href, F.lit(2)) == "//", F.concat(_part(base, f"({SCHEME})"), href))
            .when(F.left(href, F.lit(1)) == "#", F.concat(no_fragment, href))
            .when(F.left(href, F.lit(1)) == "?", F.concat(no_query, href))
            .otherwise(F.concat(origin(base), clean, tail)))
