"""Column functions that pull values out of markup text."""

from __future__ import annotations

import json
from collections.abc import Mapping
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import Text, as_column, bind, strip

# Fixed value: attribute pattern of record markup.
ATTRIBUTE = r'([A-Za-z_:][A-Za-z0-9_:\-.]*)="([^"]*)"'
# Attributes of pages: a value stands in double quotes, in single quotes, or without any.
PAGE_ATTRIBUTE = r"""([A-Za-z_:][A-Za-z0-9_:\-.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>=`]+))"""
# The standard's entity names; those without a semicolon here are known without one in texts too.
NAMED = dict(html5)
# Character references 128-159 mean Windows-1252 characters.
_WINDOWS = [bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)]


def attributes(c: Text) -> Column:
    """``key="value"`` pairs as a map with lower-case keys; the last of equal keys wins."""
    return _attribute_map(as_column(c), ATTRIBUTE, 1)


def page_attributes(c: Text) -> Column:
    """Attributes of a page's tag, quoted either way or not at all, as a map like that of ``attributes``."""
    return _attribute_map(as_column(c), PAGE_ATTRIBUTE, 3)


def _attribute_map(column: Column, pattern: str, quotings: int) -> Column:
    keys = F.transform(F.regexp_extract_all(column, F.lit(pattern), F.lit(1)), F.lower)
    # The groups of the other quotings are empty.
    values = [F.regexp_extract_all(column, F.lit(pattern), F.lit(i + 2)) for i in range(quotings)]
    zipped = F.arrays_zip(keys.alias("key"), *[v.alias(f"v{i}") for i, v in enumerate(values)])
    value = lambda p: F.concat(*[p[f"v{i}"] for i in range(quotings)])
    pairs = F.transform(zipped, lambda p: F.struct(p["key"].alias("key"), value(p).alias("value")))

    def last_of_each(ps: Column) -> Column:
        def is_last(p: Column, i: Column) -> Column:
            later = F.slice(ps, i + 2, F.size(ps))
            return ~F.exists(later, lambda other: other["key"] == p["key"])

        return F.map_from_entries(F.filter(ps, is_last))

    return bind(pairs, last_of_each)


def _code_point(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _is_control(code: Column) -> Column:
    noncharacter = code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return code.between(1, 8) | code.between(0xB, 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | noncharacter


def _character(code: Column, keep_controls: bool) -> Column:
    windows = F.array(*[F.lit(ch) for ch in _WINDOWS])
    wrong = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF) | code.isNull()
    value = F.when(wrong, F.lit("�")).when(code.between(0x80, 0x9F), F.get(windows, (code - 0x80).cast("int")))
    if not keep_controls:
        value = value.when(_is_control(code), F.lit(""))
    return value.otherwise(_code_point(code))


def unescape(c: Text, names: Mapping[str, str] = NAMED, keep_controls: bool = False) -> Column:
    """Resolve character references and named entities, each once and from left to right."""
    column = as_column(c)
    open_names = "|".join(sorted((n for n in names if not n.endswith(";")), key=len, reverse=True))
    piece = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*;?|[^&]+|&"
    # One literal, folded into a map once per query.
    lookup = F.from_json(F.lit(json.dumps(dict(names))), "map<string,string>")

    def named(p: Column) -> Column:
        # The whole name, or else the longest one at its start that needs no semicolon.
        start = F.regexp_extract(p, f"^&({open_names})", 1) if open_names else F.lit("")
        shorter = F.when(start != "", F.concat(lookup[start], F.substring(p, F.length(start) + 2, F.length(p))))
        return F.coalesce(lookup[F.substring(p, F.lit(2), F.length(p))], shorter, p)

    def resolve(p: Column) -> Column:
        decimal = F.regexp_extract(p, "^&#([0-9]+)", 1).try_cast("bigint")
        hexadecimal = F.conv(F.regexp_extract(p, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 10).try_cast("bigint")
        return (
            F.when(p.rlike("^&#[0-9]"), _character(decimal, keep_controls))
            .when(p.rlike("^&#[xX]"), _character(hexadecimal, keep_controls))
            .otherwise(named(p))
        )

    pieces = F.regexp_extract_all(column, F.lit(piece), F.lit(0))
    plain = lambda p: F.when(F.startswith(p, F.lit("&")), resolve(p)).otherwise(p)
    return F.when(F.contains(column, F.lit("&")), F.concat_ws("", F.transform(pieces, plain))).otherwise(column)


def tag_text(block: Text, tag: str) -> Column:
    """Inner text of the first such tag, unescaped and stripped; NULL when the tag is absent."""
    return bind(raw_tag_text(block, tag), lambda inner: strip(unescape(inner)))


def raw_tag_text(block: Text, tag: str) -> Column:
    column = as_column(block)
    # Fixed value: how an element's text is found.
    pattern = rf"(?s)<{tag}[^>]*>(.*?)</{tag}>"
    return F.when(column.rlike(pattern), F.regexp_extract(column, pattern, 1))


def tag_items(c: Text, tag: str = "D") -> Column:
    """Inner texts of all such tags; none for a missing text."""
    items = F.regexp_extract_all(as_column(c), F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))
    return F.coalesce(items, F.array().cast("array<string>"))


def inner_text(c: Text) -> Column:
    """Text of an HTML fragment: comments and tags removed, entities resolved."""
    return unescape(F.regexp_replace(as_column(c), r"(?s)<!--.*?-->|<[^>]*>", ""))


def joined_text(c: Text) -> Column:
    """Text of an HTML fragment with each piece between tags stripped, and the pieces put together."""
    pieces = F.split(as_column(c), r"(?s)<!--.*?-->|<[^>]*>")
    return F.concat_ws("", F.transform(pieces, lambda p: strip(unescape(p))))


def absolute_url(base: Text, link: Text) -> Column:
    """``link`` as seen from the page ``base``: absolute, scheme-, root-, query- and page-relative."""
    origin_pattern = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
    base, link = as_column(base), as_column(link)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    origin = F.regexp_extract(base, origin_pattern, 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    has_path = page.rlike(origin_pattern + "/")
    folder = F.when(has_path, F.regexp_extract(page, r"(?s)^(.*/)", 1)).otherwise(F.concat(origin, F.lit("/")))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when(F.startswith(link, F.lit("/")), F.concat(origin, _resolve_dots(link)))
        .when(link == "", base)
        .when(F.startswith(link, F.lit("#")), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .when(F.startswith(link, F.lit("?")), F.concat(page, link))
        .otherwise(F.concat(origin, _resolve_dots(F.concat(F.substring(folder, F.length(origin) + 1, F.length(folder)), link))))
    )


def _resolve_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments in the path part; the query and fragment pass unchanged."""
    split_at = r"(?s)^([^?#]*)(.*)$"
    parts = F.split(F.regexp_extract(path, split_at, 1), "/")
    segments = F.slice(parts, F.lit(2), F.size(parts))
    last = F.element_at(segments, -1)
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        empty,
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    resolved = F.concat(F.lit("/"), F.array_join(closed, "/"), F.regexp_extract(path, split_at, 2))
    return F.when(path.rlike(r"^[^?#]*/\.\.?(/|[?#]|\z)"), resolved).otherwise(path)
