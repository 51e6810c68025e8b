"""Column expressions for text that must behave like Python's ``str`` methods."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Python ends a line at each of these; "\r\n" comes first because it is one end, not two.
LINE_ENDS = ("\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")
# Fixed patterns. The JVM's whitespace class under (?U) plus U+001C..U+001F is what Python strips.
NON_BLANK = r"(?U)[^\s\x1c-\x1f]"
STRIP = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"
TITLE = r"(?is)<title>(.*?)</title>"
URL_PATH = r"^[a-z]+://[^/]*/([^?#]*)"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, STRIP, "")


def is_non_blank(text: Column) -> Column:
    return text.rlike(NON_BLANK)


def decode_utf8(content: Column) -> Column:
    """Bytes to text; malformed sequences become U+FFFD (``decode`` would fail the job)."""
    return F.make_valid_utf8(content.cast("string"))


def newline_ends(text: Column, ends: Sequence[str] = LINE_ENDS) -> Column:
    """Rewrite every line end to ``\\n``. Literal replacement is several times faster than a regex."""
    for end in ends:
        text = F.replace(text, F.lit(end), F.lit("\n"))
    return text


def raw_lines(text: Column) -> Column:
    """Split at every line end; keeps the empty string behind a closing line end."""
    return F.split(newline_ends(text), "\n", -1)


def n_lines(raw: Column) -> Column:
    """Number of lines in ``raw_lines`` output: a closing line end does not start another line."""
    return F.size(raw) - (F.element_at(raw, -1) == "").cast("int")


def split_lines(text: Column) -> Column:
    raw = raw_lines(text)
    return F.slice(raw, 1, n_lines(raw))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def has_extension(name: Column, extensions: Sequence[str]) -> Column:
    """Whether a file name ends in one of ``extensions``; a leading-dot name alone has none."""
    alternatives = "|".join(re.escape(e.lstrip(".")) for e in extensions)
    return name.rlike(rf"(?is)\A\.*[^.].*\.({alternatives})\z")


def first_non_empty(*options: Column | str) -> Column:
    """The first option that is neither NULL nor the empty string, like Python's ``a or b``."""
    columns = [F.lit(o) if isinstance(o, str) else o for o in options]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns[:-1]], columns[-1])
