"""Match keys for titles and artists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import SPACE, WORD, Text, as_column, strip

# What ends the main artist's name.
ARTIST_END = r"\bfeaturing\b|\bwith\b|&|,"
# Fixed value: the word set apart where it is glued to a name.
GLUED = "(?i)([a-z])(featuring)"


def title_key(c: Text) -> Column:
    """Title without bracketed parts and punctuation, stripped, lower case."""
    no_brackets = F.regexp_replace(as_column(c), r"\([^\n]*?\)", "")
    return F.lower(strip(F.regexp_replace(no_brackets, f"[^{WORD}{SPACE}]", "")))


def artist_key(c: Text, mode: str = "reference") -> Column:
    """Main artist, stripped and lower case.

    ``reference`` also ends the name at any x that a letter follows (Maxwell gives ``ma``),
    as published results do; ``strict`` ends it only at an x that stands alone between blanks.
    """
    if mode not in ("reference", "strict"):
        raise ValueError("mode is 'reference' or 'strict'")
    cross = "x[a-z]" if mode == "reference" else f"(?<=[{SPACE}])x(?=[{SPACE}])"
    spaced = F.regexp_replace(as_column(c), GLUED, "$1 $2")
    return F.lower(strip(F.regexp_extract(spaced, rf"(?is)^(.*?)(?:{ARTIST_END}|{cross}|\z)", 1)))
