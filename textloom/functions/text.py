"""Column functions on text: all native expressions, so they stay inside the JVM.

Character classes are spelled out because Java's ``\\w``, ``\\s`` and ``.`` are narrower
than the Unicode ones these operators are defined with.
"""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Callable, Mapping, Sequence
from functools import lru_cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes (inside of a bracket expression).
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
# The end-of-sentence mark and the sentence-ending characters.
EOS = "<EOS>"
SENTENCE_END = "[.!?]+"
# Words that the Treebank rules cut in two.
SPLIT_WORDS = ["can|not", "gim|me", "gon|na", "got|ta", "lem|me", "wan|na"]
# Quotation marks that the Treebank rules set apart.
QUOTES = "[«“‘„»”’]"

Text = Column | str


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, where it may occur many times."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however often later steps and filters use it.

    A plain column would be copied into each filter that the optimizer moves below it.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def as_column(c: Text) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Text) -> Column:
    """Remove outer whitespace of every kind, not only blanks."""
    return F.regexp_replace(F.regexp_replace(as_column(c), f"^[{SPACE}]+", ""), f"[{SPACE}]+\\z", "")


def rstrip(c: Text) -> Column:
    return F.regexp_replace(as_column(c), f"[{SPACE}]+\\z", "")


def collapse_space(c: Text) -> Column:
    return F.regexp_replace(as_column(c), f"[{SPACE}]+", " ")


def split_space(c: Text) -> Column:
    """Non-empty pieces between runs of whitespace."""
    return F.regexp_extract_all(as_column(c), F.lit(f"[^{SPACE}]+"), F.lit(0))


def remove_sections(c: Text) -> Column:
    """Drop ``[Chorus]``-like marks that open and close on one line."""
    return F.regexp_replace(as_column(c), r"\[[^\n]*?\]", "")


def remove_hashtags(c: Text) -> Column:
    return F.regexp_replace(as_column(c), f"#[^{SPACE}]+", "")


def remove_mentions(c: Text) -> Column:
    return F.regexp_replace(as_column(c), f"@[^{SPACE}]+", "")


def replace_urls(c: Text) -> Column:
    """Put one blank for each URL; a URL ends before ``#``, ``~`` or any non-ASCII character."""
    return F.regexp_replace(as_column(c), r"https?://[!$-_a-z]+", " ")


def remove_punctuation(c: Text) -> Column:
    """Drop the 32 ASCII punctuation characters."""
    return F.translate(as_column(c), string.punctuation, "")


def words(c: Text) -> Column:
    """Maximal runs of letters, digits and underscores, in any script."""
    return F.regexp_extract_all(as_column(c), F.lit(f"[{WORD}]+"), F.lit(0))


def long_words(c: Text) -> Column:
    """Lower-cased runs of at least two word characters: the usual vectoriser tokens."""
    return F.regexp_extract_all(F.lower(as_column(c)), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def sentence_tokens(c: Text) -> Column:
    """Lower-cased words of each sentence, each non-empty sentence closed by the end mark."""
    sentences = F.transform(F.split(F.lower(as_column(c)), SENTENCE_END), words)
    kept = F.filter(sentences, lambda ws: F.size(ws) > 0)
    return F.flatten(F.transform(kept, lambda ws: F.concat(ws, F.array(F.lit(EOS)))))


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def drop_words(tokens: Column, unwanted: Sequence[str]) -> Column:
    """Remove listed tokens, order kept. The list becomes a hash set in the plan."""
    unwanted = list(unwanted)
    return F.filter(tokens, lambda t: ~t.isin(unwanted)) if unwanted else tokens


def keep_words(tokens: Column, wanted: Sequence[str]) -> Column:
    """Keep listed tokens only, order kept. For large vocabularies join instead."""
    wanted = list(wanted)
    return F.filter(tokens, lambda t: t.isin(wanted))


def drop_short_and_digits(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.rlike(f"^[{DIGIT}]+\\z"))


def treebank_words(c: Column) -> Column:
    """Tokens of lower-case text without ASCII punctuation under the Treebank rules."""
    spaced = F.regexp_replace(c, f"({QUOTES})", " $1 ")
    pairs = [pair.split("|") for pair in SPLIT_WORDS]
    either = "|".join(f"({left})({right})" for left, right in pairs)
    lefts = "".join(f"${2 * i + 1}" for i in range(len(pairs)))
    rights = "".join(f"${2 * i + 2}" for i in range(len(pairs)))
    # Most places are left by their first letter, before anything looks behind.
    first = "".join(sorted({pair[0] for pair in SPLIT_WORDS}))
    cut = F.regexp_replace(spaced, f"(?=[{first}])(?<![{WORD}])(?:{either})(?![{WORD}])", f" {lefts} {rights} ")
    return split_space(cut)


def is_numeric(c: Text) -> Column:
    """True where the whole text is numeric characters; NULL counts as the word ``nan``, hence False."""
    return F.coalesce(as_column(c).rlike(rf"^[\p{{N}}{_numeric_letters()}]+\z"), F.lit(False))


@lru_cache
def _numeric_letters() -> str:
    """Characters with a numeric value that Unicode counts as letters, such as the ideographs for numbers."""
    return "".join(chr(c) for c in range(0x110000) if chr(c).isnumeric() and unicodedata.category(chr(c))[0] != "N")


def contains_ignoring_case(c: Text, phrase: str) -> Column:
    return F.contains(F.lower(as_column(c)), F.lit(phrase.lower()))


def to_number(c: Text) -> Column:
    """DOUBLE, or NULL where the text is no number (a NaN is NULL too)."""
    number = as_column(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def split_commas(c: Text) -> Column:
    """Pieces between commas; an empty text has one (empty) piece."""
    return F.split(as_column(c), ",")


def topic_list(c: Text) -> Column:
    """Pieces between commas; an empty or missing text has none."""
    column = as_column(c)
    return F.when(F.coalesce(column, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(column, ","))


def preview(c: Text, length: int = 300) -> Column:
    return F.substring(as_column(c), 1, length)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``62.3%``-style text of part / whole."""
    return F.concat(F.format_string(f"%.{digits}f", 100.0 * part / whole), F.lit("%"))


def name_emoji(c: Text, names: Mapping[str, str]) -> Column:
    """Replace each emoji of ``names`` by its name; longer sequences win over their parts.

    Only texts that hold a listed emoji are cut up, and runs of ASCII pass as one piece.
    """
    column = as_column(c)
    if not names:
        return column
    keys = sorted(names, key=lambda k: (-len(k), k))
    any_key = "|".join("".join(f"\\x{{{ord(ch):x}}}" for ch in key) for key in keys)
    lookup = F.create_map(*[F.lit(part) for key in keys for part in (key, names[key])])
    pieces = F.regexp_extract_all(column, F.lit(rf"{any_key}|[\x00-\x7f]+|[^\x00-\x7f]"), F.lit(0))
    named = F.transform(pieces, lambda p: F.when(p < "\x80", p).otherwise(F.coalesce(lookup[p], p)))
    return F.when(column.rlike(any_key), F.concat_ws("", named)).otherwise(column)
