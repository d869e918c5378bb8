"""String helpers: whitespace tokens, query terms, path base names, run labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the code points Python's str.split() treats as white space
WHITESPACE_CODEPOINTS = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
    0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]

# one regex character class, literal characters, valid in Java regex and RE2
WHITESPACE_RUN = "[" + "".join(chr(c) for c in WHITESPACE_CODEPOINTS) + "]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """array<string> of whitespace-separated words, empty strings removed."""
    parts = F.split(_col(text), WHITESPACE_RUN)
    return F.filter(parts, lambda w: w != F.lit(""))


def plus_term(term) -> Column:
    """Spaces to '+', as done for search terms."""
    return F.replace(_col(term), F.lit(" "), F.lit("+"))


def quote_path(path) -> Column:
    """Percent-encode like ``urllib.parse.quote`` (safe='/').

    Built on form encoding (``url_encode``), whose differences are undone:
    space is '+' there (a literal '+' is already %2B), '*' is kept there,
    '~' is encoded there, and '/' is kept by ``quote``."""
    enc = F.url_encode(_col(path))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        enc = F.replace(enc, F.lit(a), F.lit(b))
    return enc


def basename(path) -> Column:
    """Last path component."""
    return F.element_at(F.split(_col(path), "/"), -1)


def run_label(fmt: str, *cols) -> Column:
    """printf-style run label from parameter columns."""
    return F.format_string(fmt, *[_col(c) for c in cols])


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 (F13): of an instant (``timestamp``) as it is,
    of a wall-clock time (``timestamp_ntz``) as if in UTC; the session's time zone
    plays no part in either."""
    instant = F.unix_seconds(_col(ts).cast("timestamp"))
    c = _col(ts).cast("timestamp_ntz")
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    wall = days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("bigint")
    return F.when(F.typeof(_col(ts)) == "timestamp", instant).otherwise(wall).cast("bigint")
