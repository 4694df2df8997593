"""Text Column functions.

All built-in Spark expressions: they stay inside whole-stage codegen where
Spark allows it, and every pattern is in the common subset of Java regex and
RE2 so the DuckDB twins can use the same strings.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` / ``str.split()``
# treat as whitespace (``str.isspace``), as one regex class.  Java's ``\s``
# and Spark's ``trim`` are ASCII/space-only, so the class is spelled out.
PY_WS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# The same characters one by one, for ``btrim``, which looks at the ends of a text only.
PY_WS_CHARS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Fixed value: Python's ``string.punctuation``.
PUNCTUATION = string.punctuation

# Characters removed by the line cleaner (F17), after strip:
# tab, newline, ideographic space, the entities &nbsp; and &#x3000;, CR, nbsp.
# One class and one entity: each character is tried once, not once for each of seven.
ILLEGAL_LINE_RE = r"[\t\n\r\x{A0}\x{3000}]|&(?:nbsp|#x3000);"

# Characters trimmed by ``empty_strip`` (F20): CR, LF, Python
# whitespace, zero-width space, ideographic space.
EMPTY_STRIP_CHARS = PY_WS_CHARS + "\u200b"

NON_BMP_RE = r"[\x{10000}-\x{10FFFF}]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def pstrip(c: Column) -> Column:
    """Python ``str.strip()``."""
    return F.btrim(c, F.lit(PY_WS_CHARS))


def pwords(c: Column) -> Column:
    """Python ``str.split()`` (whitespace runs, no empty items)."""
    return F.filter(F.split(c, f"{PY_WS}+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.size(pwords(c))


def distinct_chars(c: Column) -> Column:
    """``set(text)``, as a count of distinct characters."""
    return F.size(F.array_distinct(F.filter(F.split(c, ""), lambda x: x != "")))


def strip_punct(c: Column) -> Column:
    """``w.strip(string.punctuation)``."""
    return F.btrim(c, F.lit(PUNCTUATION))


def clean_lines(c: Column, sep: str = "\n") -> Column:
    """Split lines, strip each, drop blanks, join with ``sep``."""
    lines = F.transform(F.split(c, "\n"), pstrip)
    return F.array_join(F.filter(lines, lambda x: x != ""), sep)


def regex_int(c: Column, pattern: str = r"(?i)(\d+) kbps") -> Column:
    """F16: first capture group of ``pattern`` as a whole number of up to 38
    digits, NULL when absent or longer (one bad value never fails the job)."""
    return F.regexp_extract(c, pattern, 1).try_cast("decimal(38,0)")


def clean_illegal_line(c: Column) -> Column:
    """strip, then drop tabs/newlines/CR/nbsp/U+3000 and their entities."""
    return F.regexp_replace(pstrip(c), ILLEGAL_LINE_RE, "")


def drop_non_bmp(c: Column) -> Column:
    """strip, then drop characters beyond the BMP (emoji)."""
    return F.regexp_replace(pstrip(c), NON_BMP_RE, "")


def clean_line_list(arr: Column) -> Column:
    """F17 then F18 on every line of an array."""
    return F.transform(arr, lambda x: drop_non_bmp(clean_illegal_line(x)))


def empty_strip(c: Column) -> Column:
    """trim whitespace, zero-width and ideographic spaces at both ends."""
    return F.btrim(c, F.lit(EMPTY_STRIP_CHARS))


def _q2b_tables() -> tuple[str, str]:
    """F23 translation table, built from its rule: full-width digits, ASCII
    letters of both cases and the full-width minus map to code point - 0xFEE0."""
    half = string.digits + string.ascii_lowercase + string.ascii_uppercase + "-"
    full = "".join(chr(ord(ch) + 0xFEE0) for ch in half)
    return full, half


Q2B_FULL, Q2B_HALF = _q2b_tables()


def full_to_half(c: Column) -> Column:
    """full-width letters, digits and minus to ASCII."""
    return F.translate(c, Q2B_FULL, Q2B_HALF)


def unify_br(c: Column) -> Column:
    """collapse runs of ``<br/>`` / ``<br />`` into one ``<br />``."""
    return F.regexp_replace(c, "(<br */>)+", "<br />")


def starts_with_any(c: Column, prefixes) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out
