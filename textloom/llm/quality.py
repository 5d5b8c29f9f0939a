"""Quality rules: base counts, and divergence of a document's histograms from those of its language.

Two histograms per document, one over character classes and one over the language's common words, are compared
with the language's histogram over the whole corpus by Jensen-Shannon distance (base 2, so 0 to 1). Short
documents are spared: a histogram is judged only with enough characters or words. All of it is DataFrame
expressions; the only shuffled rows are counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import bind, once
from textloom.llm.common import sized_join, stored, without_rows

# Fixed values of the base rules: white space, symbol characters, fewest words, largest share of repeated words in percent.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED = 50, 50
# Character classes beside white space and lower-case a-z.
CLASSES = {
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "mark": "[.,;:!?'\"()-]",
    "symbol": SYMBOLS,
    "wide": r"[^\x00-\x7F]",
    "other": r"[+/=@\[\\\]^_`{}~\x00-\x08\x0E-\x1F\x7F]",
}
N_CLASSES = len(CLASSES) + 2
# The twenty most common words of each language, as frequency lists give them.
COMMON: dict[str, tuple[str, ...]] = {
    "en": tuple("the of and to a in is that it for was on with as be by this are at from".split()),
    "fr": tuple("de la le et les des en un du une que pour est par qui dans avec sur pas au".split()),
    "de": tuple("der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als".split()),
    "es": tuple("de la que el en y los se del las un por con no su una para es al lo".split()),
}
# Limits: distances above which a document is rejected, and guards below which a histogram isn't judged.
MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE = 0.20, 0.35
LEAST_CHARS, LEAST_LETTER_WORDS, LEAST_REFERENCE = 200, 100, 5000


def _repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more. Windows are compared by a 64-bit hash of their three words."""
    n = F.size(words)
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(ordered: Column) -> Column:
            same = lambda a, i: F.coalesce(F.get(ordered, i)["h"] == a["h"], F.lit(False))
            twice = F.filter(ordered, lambda a, i: same(a, i + 1) | same(a, i - 1))
            starts = F.sort_array(F.transform(twice, lambda a: a["i"]))
            zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
            step = lambda done, i: F.struct(i.alias("last"), (done["total"] + F.least(F.lit(3), i - done["last"])).alias("total"))
            return F.aggregate(starts, zero, step, lambda done: done["total"])

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(bind(placed, count))

    return bind(windows, covered)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\t-\r ]+"))


def base_metrics(text: Column) -> Column:
    """A struct of counts of a whole text (not NULL); ``classes`` follows white space, a-z, then ``CLASSES``."""

    def measure(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated_words(words).alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    repeated_lines = bind(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long")

    def counts(words: Column) -> Column:
        chars = F.char_length(text).cast("long")
        space = chars - words["word_chars"]
        # Without a-z and white space little is left, so that the classes are counted on short strings.
        rest = F.regexp_replace(text, r"[a-z\t-\r ]+", "")

        def classes(left: Column) -> Column:
            each = [F.regexp_count(left, F.lit(pattern)).cast("long") for pattern in CLASSES.values()]
            return F.struct(
                words["n_words"].alias("n_words"),
                words["word_chars"].alias("word_chars"),
                each[list(CLASSES).index("symbol")].alias("n_symbols"),
                repeated_lines.alias("n_dup_lines"),
                words["n_repeat_words"].alias("n_repeat_words"),
                F.array(space, chars - space - F.char_length(left), *each).alias("classes"),
            )

        return bind(rest, classes)

    return bind(bind(_words(text), measure), counts)


def word_counts(text: Column, common: Mapping[str, Sequence[str]] = COMMON) -> Column:
    """For each language an array: occurrences of each of its common words, then all other words. Words are runs of letters in lower case."""
    known = sorted({w for words in common.values() for w in words})
    words = F.filter(F.split(F.lower(text), r"\P{L}+"), lambda w: w != "")

    def count(found: Column) -> Column:
        # Doubled blanks keep neighbours from sharing one.
        listed = F.concat(F.lit(" "), F.array_join(F.filter(found, lambda w: w.isin(known)), "  "), F.lit(" "))

        def per_language(joined: Column) -> Column:
            size = F.octet_length(joined)
            each = {w: ((size - F.octet_length(F.replace(joined, F.lit(f" {w} "), F.lit("")))) / len(f" {w} ".encode())).cast("long") for w in known}
            total = F.size(found).cast("long")

            def histogram(words: Sequence[str]) -> Column:
                rest = total
                for w in words:
                    rest = rest - each[w]
                return F.array(*[each[w] for w in words], rest)

            return F.struct(*[histogram(common[lang]).alias(lang) for lang in common])

        return bind(listed, per_language)

    return bind(words, count)


def shannon_distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of counts; NULL if either is empty or sums to 0."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))
    share = lambda x: bind(total(x), lambda t: F.transform(x, lambda v: F.try_divide(v, t)))
    terms = F.zip_with(share(left), share(right), lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.sqrt(F.greatest(total(terms) / 2, F.lit(0.0)))


def features(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", common: Mapping[str, Sequence[str]] = COMMON
) -> DataFrame:
    """Counts per row of ``docs``: the base counts, ``classes``, and ``words``, the counts of the document's language.

    The language is the column's if ``common`` has it, else the one whose common words make up most of the text's
    words (ties: the order of ``common``). ``judged`` is the language's name for the corpus statistics: the column's value, or
    the found one where it is NULL.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_column).cast("binary")).alias("text_hash"),
        F.col(lang_column).cast("string").alias("lang"),
        F.struct(base_metrics(text).alias("base"), word_counts(text, common).alias("words")).alias("_m"),
    )
    rows = once(rows, "_m", F.col("_m"))
    found = lambda lang: F.size(F.col(f"_m.words.{lang}")) - 1
    hits = {lang: F.aggregate(F.slice(F.col(f"_m.words.{lang}"), 1, found(lang)), F.lit(0).cast("long"), lambda a, b: a + b) for lang in common}
    most = F.greatest(*hits.values())
    guess = F.coalesce(*[F.when(hits[lang] == most, F.lit(lang)) for lang in common])
    language = F.when(F.col("lang").isin(*common), F.col("lang")).otherwise(guess)
    words = F.coalesce(*[F.when(F.col("list") == lang, F.col(f"_m.words.{lang}")) for lang in common])
    rows = rows.withColumn("list", language).withColumn("counted", words).withColumn("judged", F.coalesce("lang", "list"))
    return rows.select("doc_id", "text_hash", "lang", "list", "judged", "_m.base.*", F.col("counted").alias("words"))


def references(found: DataFrame, by: str = "list") -> DataFrame:
    """Summed histograms of all well-formed documents: one row per word list (a language of ``COMMON``) or, by ``judged``, per language.

    Well-formed: the base rules hold, and there is at most one symbol character per ten words, so that what the distances are to
    find does not shape the reference.
    """
    good = found.filter(~base_failed() & (10 * F.col("n_symbols") <= F.col("n_words")))
    n_words = len(next(iter(COMMON.values()))) + 1
    sums = [F.sum(F.get("classes", F.lit(i))) for i in range(N_CLASSES)], [F.sum(F.get("words", F.lit(i))) for i in range(n_words)]
    return good.groupBy(by).agg(F.array(*sums[0]).alias("ref_classes"), F.array(*sums[1]).alias("ref_words"), F.sum("n_words").alias("ref_n"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def quality_verdicts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", own: bool = False) -> DataFrame:
    """Base counts, ``base_failed``, both distances and ``kept`` per row of ``docs``.

    ``kept`` is false if the base rules fail or a judged distance is above its limit. A histogram is judged only if the document has at
    least ``LEAST_CHARS`` characters (or ``LEAST_LETTER_WORDS`` words of letters) and its language at least ``LEAST_REFERENCE`` words;
    otherwise its distance is NULL. NULL texts have no word and fail. NULL or unlisted languages are judged by the list that
    fits the text best. Repeated rows and NULL ids stay; other columns are not read.

    With ``own`` an unlisted language has a reference of its own and no part in that of a list: its documents are judged by their
    character classes, and their word distance is NULL, since there is no list for it.
    """
    found = stored(features(docs, id_column, text_column, lang_column), "quality")
    if own:
        known = references(found, "judged").withColumn("ref_words", F.when(F.col("judged").isin(*COMMON), F.col("ref_words")))
        rows = sized_join(found, known, ["judged"], "left")
    else:
        # One row per language of COMMON; its size is known from the stored file.
        known = stored(references(found), "references")
        rows = found.join(known, "list", "left")
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, b: a + b)
    letters = F.aggregate("words", F.lit(0).cast("long"), lambda a, b: a + b)
    enough = F.coalesce(F.col("ref_n") >= LEAST_REFERENCE, F.lit(False))
    rows = rows.withColumns(
        {
            "base_failed": base_failed(),
            "class_distance": F.when(enough & (chars >= LEAST_CHARS), F.round(shannon_distance(F.col("classes"), F.col("ref_classes")), 6)),
            "word_distance": F.when(enough & F.col("ref_words").isNotNull() & (letters >= LEAST_LETTER_WORDS), F.round(shannon_distance(F.col("words"), F.col("ref_words")), 6)),
        }
    )
    far = F.coalesce(F.col("class_distance") > MOST_CLASS_DISTANCE, F.lit(False)) | F.coalesce(F.col("word_distance") > MOST_WORD_DISTANCE, F.lit(False))
    names = ["doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance"]
    return rows.withColumn("kept", ~F.col("base_failed") & ~far).select(*names, "kept")


def keep_good(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", own: bool = False) -> DataFrame:
    """The rows of ``docs`` that the verdict keeps."""
    verdicts = quality_verdicts(docs, id_column, text_column, lang_column, own)
    return without_rows(docs, verdicts.filter(~F.col("kept")), id_column, text_column)
