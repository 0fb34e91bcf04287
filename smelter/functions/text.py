"""Text normalisation used for comparing free text, code and choices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smelter.functions.typing import as_column

# The characters that count as white space when text is compared (every
# Unicode space, and the four ASCII separators that \s leaves out).
SPACE_CHARS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a pattern; (?U) makes \s mean the Unicode property.
SPACES = r"(?U)[\s\x1c-\x1f]+"
QUOTES = "[\"']"
NOT_IN_CHOICE = r"(?U)[^a-zA-Z0-9_@.\s\x1c-\x1f]"


def strip(c: Column | str) -> Column:
    return F.trim(as_column(c), F.lit(SPACE_CHARS))


def collapse_spaces(c: Column | str) -> Column:
    return F.regexp_replace(as_column(c), SPACES, " ")


def squeeze(c: Column | str) -> Column:
    """No outer space, and one plain space for each run of inner space."""
    # Collapsing first leaves at most one plain space on each edge.
    return F.trim(collapse_spaces(c))


def text_key(c: Column | str) -> Column:
    """Equal for texts that differ only in case and white space."""
    return F.lower(squeeze(c))


def code_key(c: Column | str) -> Column:
    """Equal for code that differs only in quote style and white space."""
    return collapse_spaces(F.regexp_replace(strip(c), QUOTES, "'"))


def choice_key(c: Column | str) -> Column:
    """Equal for choices that differ only in case, punctuation and outer space."""
    return F.upper(F.regexp_replace(strip(c), NOT_IN_CHOICE, ""))


def digest(c: Column | str) -> Column:
    """A 32-byte stand-in for a long text as a grouping or join key."""
    return F.unhex(F.sha2(as_column(c), 256))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
