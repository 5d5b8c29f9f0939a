"""Extraction jobs over a table of stored pages (``url``, ``html``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.markup import absolute_url, inner_text, joined_text, page_attributes, unescape
from textloom.functions.text import bind, collapse_space, once, strip

# The properties of a book and the names they get.
BOOK_FIELDS = {
    "Title": "Title", "Author": "Author", "Reading Level": "Reading_Level", "EBook-No.": "EBook_No.",
    "Language": "Language", "Most Recently Updated": "Most_Recently_Updated",
}
CHART_ROW = "o-chart-results-list-row-container"
CHART_LABEL = "c-label"
ANCHOR = r"(?is)<a\b[^>]*>.*?</a>"


def _href(anchor: Column) -> Column:
    return unescape(page_attributes(F.regexp_extract(anchor, r"(?is)<a\b([^>]*)>", 1))["href"])


def _with_class(tag: str, name: str, whole: bool) -> str:
    """Pattern for the start of a tag whose class attribute holds ``name``: as a word if ``whole``, else anywhere."""
    left, right = (r"(?:{0}*\s)?", r"(?:\s{0}*)?") if whole else ("{0}*", "{0}*")
    quoted = [rf"{q}{left.format(f'[^{q}]')}{name}{right.format(f'[^{q}]')}{q}" for q in "\"'"]
    bare = name + r"(?=[\s>])" if whole else rf"""[^\s"'>]*{name}"""
    return rf"<{tag}\b[^>]*\bclass\s*=\s*(?:{quoted[0]}|{quoted[1]}|{bare})"


def section_links(pages: DataFrame, heading: str, list_tag: str = "ol", url: str = "url", html: str = "html") -> DataFrame:
    """Links of the first list after a heading, absolute and in page order: (url, ``pos``, ``link``).

    ``heading`` is a pattern for the heading's opening tag. Of each list item the first link counts.
    """
    section = F.regexp_extract(html, rf"(?is){heading}.*?<{list_tag}\b[^>]*>(.*?)</{list_tag}>", 1)
    items = F.regexp_extract_all(section, F.lit(r"(?is)<li\b[^>]*>.*?(?=<li\b|\z)"), F.lit(0))
    anchors = F.transform(items, lambda item: F.regexp_extract(item, ANCHOR, 0))
    found = F.filter(anchors, lambda a: a != "")
    links = pages.select(F.col(url), F.posexplode(found).alias("pos", "_anchor"))
    return links.select(url, F.col("pos").cast("bigint").alias("pos"), absolute_url(url, _href(F.col("_anchor"))).alias("link"))


def first_link(pages: DataFrame, phrase: str, url: str = "url", html: str = "html", name: str = "link") -> DataFrame:
    """Add the first link whose text holds ``phrase``, absolute; pages without one, or whose link has no address, are dropped."""
    anchors = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(0))
    wanted = F.get(F.filter(anchors, lambda a: F.contains(inner_text(a), F.lit(phrase))), F.lit(0))
    found = once(pages, "_anchor", wanted).filter("_anchor IS NOT NULL")
    linked = once(found, "_link", absolute_url(url, _href(F.col("_anchor")))).filter("_link IS NOT NULL")
    return linked.withColumn(name, F.col("_link")).drop("_anchor", "_link")


def _cell(row: Column, tag: str) -> Column:
    pattern = rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"
    return F.when(row.rlike(pattern), strip(inner_text(F.regexp_extract(row, pattern, 1))))


def properties(
    pages: DataFrame, fields: Mapping[str, str] = BOOK_FIELDS, table_class: str = "bibrec", url: str = "url", html: str = "html"
) -> DataFrame:
    """Pages with a property table, each named property as a column (NULL when absent).

    A property row has a ``th`` and a ``td``. Of rows with the same name the last one counts.
    """
    table = rf"(?is){_with_class('table', table_class, True)}[^>]*>(.*?)</table>"
    with_table = pages.filter(F.col(html).rlike(table))
    rows = F.regexp_extract_all(F.regexp_extract(html, table, 1), F.lit(r"(?is)<tr\b[^>]*>.*?(?=<tr\b|\z)"), F.lit(0))
    cells = F.transform(rows, lambda r: F.struct(_cell(r, "th").alias("key"), _cell(r, "td").alias("value")))

    def last_value(key: str) -> Column:
        same = F.filter(F.col("_cells"), lambda c: (c["key"] == key) & c["value"].isNotNull())
        return F.try_element_at(F.transform(same, lambda c: c["value"]), F.lit(-1))

    listed = once(with_table, "_cells", cells)
    record = F.struct(*[last_value(key).alias(name) for key, name in fields.items()])
    return once(listed, "_record", record).select(*pages.columns, *[F.col(f"_record.`{name}`").alias(name) for name in fields.values()])


def complete(df: DataFrame, fields) -> DataFrame:
    """Rows whose ``fields`` are all present and not empty."""
    for field in fields:
        value = F.col(f"`{field}`")
        df = df.filter(value.isNotNull() & (value != ""))
    return df


def chart_rows(pages: DataFrame, row_class: str = CHART_ROW, label_class: str = CHART_LABEL, html: str = "html") -> DataFrame:
    """Entries of chart pages in page order: the columns of ``pages`` but html, ``pos``, ``title``, ``artist``.

    The artist is the second label, or the only one. Entries without title or artist are skipped.
    """
    # A row reaches to where the next one starts.
    opening = _with_class("div", row_class, False)
    rows = F.regexp_extract_all(F.col(html), F.lit(rf"(?is){opening}.*?(?={opening}|\z)"), F.lit(0))
    others = [c for c in pages.columns if c != html]
    entries = pages.select(*others, F.posexplode(rows).alias("pos", "_row"))
    label = rf"(?is){_with_class('span', label_class, False)}[^>]*>(.*?)</span>"
    labels = F.regexp_extract_all(F.col("_row"), F.lit(label), F.lit(1))
    artist = bind(labels, lambda ls: F.when(F.size(ls) >= 2, F.get(ls, F.lit(1))).otherwise(F.get(ls, F.lit(0))))
    heading = F.regexp_extract("_row", r"(?is)<h3\b[^>]*>(.*?)</h3>", 1)
    named = F.struct(
        collapse_space(joined_text(heading)).alias("title"), collapse_space(joined_text(artist)).alias("artist")
    )
    cut = once(entries, "_entry", named).select(*others, F.col("pos").cast("bigint").alias("pos"), "_entry.*")
    return cut.filter((F.col("title") != "") & (F.col("artist") != ""))
