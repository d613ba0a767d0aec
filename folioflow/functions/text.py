"""String expressions with Unicode rules, all native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"(?U)\s+"


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any script."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, _WS, " "))


def filled(c: Column) -> Column:
    """Null for the empty string."""
    return F.when(c != "", c)


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*[filled(c) for c in columns], F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """The group, or null where the pattern isn't found."""
    return filled(F.regexp_extract(c, pattern, group))


def is_all_caps(c: Column) -> Column:
    """At least one cased letter, and none in lower case."""
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}")


def title_case(c: Column) -> Column:
    """A capital after every non-letter, other letters lower."""
    words = F.regexp_extract_all(c, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))), "")


def fix_caps(c: Column) -> Column:
    return F.when(is_all_caps(c), title_case(c)).otherwise(c)


def strip_markup(c: Column) -> Column:
    """Tags to spaces, white space squeezed."""
    return squeeze(F.regexp_replace(c, r"<[^>]+>", " "))


def clean_lines(c: Column) -> Column:
    """Lines stripped, blank ones dropped."""
    return F.array_join(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), "\n")


def last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def decoded(c: Column) -> Column:
    """Percent-decoded, plus signs kept; the input where it can't be decoded."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


#: Characters left as they are in a path, without and with the comma.
SAFE_PATH = "/:@!$&'()*+;=-._~"
SAFE_PATH_COMMA = "/:@!$&'()*+,;=-._~"


def encoded(c: Column, safe: str) -> Column:
    """Percent-encoded UTF-8 but for ASCII letters, digits, ``-._~`` and ``safe``."""
    out = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    out = F.replace(out, F.lit("%7E"), F.lit("~"))
    if "*" not in safe:
        out = F.replace(out, F.lit("*"), F.lit("%2A"))
    for ch in safe:
        if ch not in "-._~*":
            out = F.replace(out, F.lit(f"%{ord(ch):02X}"), F.lit(ch))
    return out


def normalize_url(url: Column, safe: str = SAFE_PATH) -> Column:
    """The url with its path decoded and encoded again, so that a second pass changes nothing."""
    head, path, tail = (F.regexp_extract(url, r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?)([^?#]*)(.*)$", g) for g in (1, 2, 3))
    return F.concat(head, encoded(decoded(path), safe), tail)


def absolute(path: Column, base: str) -> Column:
    return F.when((path == "") | path.startswith("http"), path).otherwise(F.concat(F.lit(base), path))


def with_query(url: Column, pair: str) -> Column:
    """The query pair appended unless the url has it."""
    return F.when(url.contains(pair), url).otherwise(F.concat(url, F.when(url.contains("?"), "&").otherwise("?"), F.lit(pair)))
