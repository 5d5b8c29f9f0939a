"""Extraction from pages and markup, and reading and writing files."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import functions as F

from textloom.functions import markup
from textloom.session import ensure_checkpoint_dir
from textloom.sources import files, news, pages
from workload.registry import query, table

# --- stored pages --------------------------------------------------------------------------

NAV = "nav AS (SELECT page_id, url, regexp_extract(html, '(?is)<nav[^>]*>.*?<ul[^>]*>(.*?)</ul>', 1) AS section FROM pages)"
ABSOLUTE = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href"


@query(
    "page_links",
    f"""WITH {NAV}, hrefs AS (SELECT page_id, url, unnest(regexp_extract_all(section, '<a href="([^"]*)"', 1)) AS raw,
    generate_subscripts(regexp_extract_all(section, '<a href="([^"]*)"', 1), 1) - 1 AS pos FROM nav),
    clean AS (SELECT url, pos::BIGINT AS pos, replace(raw, '&amp;', '&') AS href FROM hrefs) SELECT url, pos, {ABSOLUTE} AS link FROM clean""",
)
def page_links(spark, sf_dir):
    stored = table(spark, sf_dir, "pages").select("url", "html")
    return pages.section_links(stored, r"<nav\b[^>]*>", "ul")


@query(
    "page_first_link",
    f"""WITH anchors AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a[^>]*>.*?</a>')) AS a, generate_subscripts(regexp_extract_all(html, '(?is)<a[^>]*>.*?</a>'), 1) AS i FROM pages),
    hits AS (SELECT page_id, url, a FROM anchors WHERE contains(regexp_replace(a, '<[^>]*>', '', 'g'), 'on') QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY i) = 1),
    hrefs AS (SELECT page_id, url, regexp_extract(a, 'href="([^"]*)"', 1) AS href FROM hits) SELECT page_id, {ABSOLUTE} AS link FROM hrefs""",
)
def page_first_link(spark, sf_dir):
    return pages.first_link(table(spark, sf_dir, "pages"), "on").select("page_id", "link")


# Property tables: built from parts; every third has two authors, every fifth no reading level, every seventh no title text.
PROPERTIES = (
    "'<html><table><tr><th>Title</th><td>wrong</td></tr></table><table border=\"0\" class=\"bibrec\"><tr><th>Author</th><td> First &amp; Co </td></tr>' "
    "|| CASE WHEN p_partkey % 3 = 0 THEN '<tr><th>Author</th><td><a href=\"/x\">' || p_brand || '</a></td></tr>' ELSE '' END "
    "|| '<tr><th> Title </th><td>' || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END || '</td></tr><tr><td>no heading</td></tr>' "
    "|| CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '<tr><th>Reading Level</th><td>' || p_size || ' &#8211; easy</td></tr>' END "
    "|| '<tr><th>EBook-No.</th><td>' || p_partkey || '</td></tr><tr><th>Language</th><td>' || CASE WHEN p_partkey % 2 = 0 THEN 'English' ELSE 'French' END "
    "|| '</td></tr><tr><th>Most Recently Updated</th><td>Sep 11, 2025</td></tr></table><a href=\"x.html\">Read online</a><a href=\"/files/' || p_partkey || '.txt\">Plain Text UTF-8</a></html>'"
)
PROPERTIES_SQL = """SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END AS "Title", CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE 'First & Co' END AS "Author",
CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size || ' – easy' END AS "Reading_Level", p_partkey::VARCHAR AS "EBook_No.",
CASE WHEN p_partkey % 2 = 0 THEN 'English' ELSE 'French' END AS "Language", 'Sep 11, 2025' AS "Most_Recently_Updated" FROM part"""


def _property_pages(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("http://books.example/ebooks/"), F.col("p_partkey").cast("string")).alias("url"),
        F.expr(PROPERTIES).alias("html"),
    )


@query("page_kv", PROPERTIES_SQL)
def page_kv(spark, sf_dir):
    return pages.properties(_property_pages(spark, sf_dir)).drop("url", "html")


@query(
    "catalogue",
    f"""WITH p AS ({PROPERTIES_SQL}) SELECT 'http://books.example/ebooks/' || id AS "URL", "Title", "Author", "Reading_Level", "EBook_No.", "Language", "Most_Recently_Updated",
    'http://books.example/files/' || id || '.txt' AS text_url FROM p WHERE "Language" = 'English' AND "Title" <> '' AND "Reading_Level" IS NOT NULL""",
)
def catalogue(spark, sf_dir):
    from textloom.plans.jobs import catalogue_job

    return catalogue_job(_property_pages(spark, sf_dir).select("url", "html"))


# Chart pages of fifty customers in key order; some entries have one label, some a short title.
CHART_ROW = (
    "'<div class=\"x o-chart-results-list-row-container y\"><ul><li><h3 id=\"t\">\\n\\t ' || CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END || ' &amp;  co </h3>' "
    "|| CASE WHEN c_custkey % 4 = 0 THEN '<span class=\"c-label a\">' || c_mktsegment || '</span>' "
    "ELSE '<span class=\"c-label a\">1</span><span class=\"b c-label\"> ' || c_mktsegment || '  <b>X</b></span><span class=\"c-label\">3</span>' END || '</li></ul></div>'"
)


@query(
    "page_items",
    r"""WITH r AS (SELECT c_custkey // 50 AS year, row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_custkey) - 1 AS pos,
    CASE WHEN c_custkey % 11 = 0 THEN '& co' ELSE c_name || ' & co' END AS title, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE c_mktsegment || 'X' END AS artist FROM customer)
    SELECT year, pos, title, artist FROM r""",
)
def page_items(spark, sf_dir):
    page = F.floor(F.col("c_custkey") / 50).alias("year")
    rows = table(spark, sf_dir, "customer").select(page, "c_custkey", F.expr(CHART_ROW).alias("row"))
    parts = rows.groupBy("year").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "row"))).alias("rows"))
    html = F.concat(F.lit("<body>"), F.concat_ws("<p>ad</p>", F.transform("rows", lambda r: r["row"])), F.lit("</body>"))
    return pages.chart_rows(parts.select("year", html.alias("html")))


LINKS = ["https://other.example/a", "//cdn.example/b", "/root", "page.html", "?q=1", "#part", "../up", "./here", "a/../b/./c", ""]


@query(
    "absolute_links",
    """WITH l AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin,
    regexp_extract(url, '^([^?#]*)', 1) AS page, regexp_extract(url, '^([^#]*)', 1) AS whole, regexp_extract(url, '^[a-z]+://[^/?#]*(/(?:[^?#]*/)?)', 1) AS folder, page_id % 10 AS kind FROM pages),
    up AS (SELECT *, regexp_replace(folder, '[^/]+/$', '') AS parent FROM l)
    SELECT page_id, CASE kind WHEN 0 THEN 'https://other.example/a' WHEN 1 THEN scheme || '://cdn.example/b' WHEN 2 THEN origin || '/root' WHEN 3 THEN origin || folder || 'page.html'
    WHEN 4 THEN page || '?q=1' WHEN 5 THEN whole || '#part' WHEN 6 THEN origin || parent || 'up' WHEN 7 THEN origin || folder || 'here' WHEN 8 THEN origin || folder || 'b/c' ELSE url END AS link FROM up""",
)
def absolute_links(spark, sf_dir):
    links = F.array(*[F.lit(link) for link in LINKS])
    stored = table(spark, sf_dir, "pages").withColumn("href", F.get(links, (F.col("page_id") % 10).cast("int")))
    return stored.select("page_id", markup.absolute_url("url", "href").alias("link"))


# --- markup records ------------------------------------------------------------------------

RECORD = (
    "'<REUTERS TOPICS=\"' || CASE WHEN doc_id % 6 = 0 THEN 'NO' ELSE 'YES' END || '\" LEWISSPLIT=\"' || CASE doc_id % 5 WHEN 0 THEN 'NOT-USED' WHEN 1 THEN 'TEST' ELSE 'TRAIN' END "
    "|| '\" NEWID=\"' || doc_id || '\"><TOPICS>' || CASE WHEN doc_id % 4 = 0 THEN '' ELSE '<D>' || lang || '</D><D>' || source || '</D>' END || '</TOPICS><TEXT>' "
    "|| CASE WHEN doc_id % 7 = 0 THEN '' ELSE '<BODY> ' || replace(replace(text, '&', '&amp;'), '<', '&lt;') || ' &lt;end&gt;&#3;</BODY>' END || '</TEXT></REUTERS>'"
)


def _records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", F.concat(F.lit("file"), (F.col("doc_id") % 8).cast("string")).alias("filename"), F.expr(RECORD).alias("record"))
    return news.split_record(texts, "record")


BODY_SQL = "regexp_replace(regexp_replace(text || ' <end>', '^[\\s]+', ''), '[\\s]+$', '')"
LABELLED_SQL = f"""kept AS (SELECT doc_id, 'file' || doc_id % 8 AS filename, 'YES' AS topics_present, CASE WHEN doc_id % 5 = 1 THEN 'TEST' ELSE 'TRAIN' END AS lewissplit,
CASE WHEN doc_id % 4 = 0 THEN '' ELSE lang || ',' || source END AS topics, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE {BODY_SQL} END AS body_text
FROM documents WHERE doc_id % 6 <> 0 AND doc_id % 5 <> 0)"""


@query(
    "sgml_records",
    f"""WITH {LABELLED_SQL} SELECT topics_present, lewissplit, topics, body_text, filename, row_number() OVER (PARTITION BY filename ORDER BY doc_id) AS record_ix FROM kept""",
)
def sgml_records(spark, sf_dir):
    records = _records(spark, sf_dir).withColumn("block", F.floor(F.col("doc_id") / 100))
    numbered = news.number_records(news.labelled_records(records.drop("record")), pos="doc_id")
    return numbered.select("topics_present", "lewissplit", "topics", "body_text", "filename", "record_ix")


@query(
    "sgml_articles",
    """SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE ' ' || text || ' <end>' || chr(3) END AS text,
    CASE WHEN doc_id % 4 = 0 THEN '' ELSE lang || '|' || source END AS topics FROM documents""",
)
def sgml_articles(spark, sf_dir):
    return news.articles(_records(spark, sf_dir)).withColumn("topics", F.array_join("topics", "|"))


@query(
    "tag_attributes",
    """SELECT doc_id, 3::BIGINT AS n_attributes, CASE WHEN doc_id % 6 = 0 THEN 'NO' ELSE 'YES' END AS topics,
    CASE doc_id % 5 WHEN 0 THEN 'NOT-USED' WHEN 1 THEN 'TEST' ELSE 'TRAIN' END AS lewissplit, doc_id::VARCHAR AS newid FROM documents""",
)
def tag_attributes(spark, sf_dir):
    values = markup.attributes("head")
    return _records(spark, sf_dir).select(
        "doc_id", F.size(values).cast("bigint").alias("n_attributes"), values["topics"].alias("topics"),
        values["lewissplit"].alias("lewissplit"), values["newid"].alias("newid"),
    )


@query(
    "split_filter",
    f"WITH {LABELLED_SQL} SELECT doc_id, lewissplit FROM kept WHERE lewissplit = 'TRAIN' AND body_text IS NOT NULL",
)
def split_filter(spark, sf_dir):
    records = news.labelled_records(_records(spark, sf_dir).drop("record"))
    return records.filter("lewissplit = 'TRAIN'").dropna(subset=["body_text"]).select("doc_id", "lewissplit")


# --- files -----------------------------------------------------------------------------------


def _folder(spark) -> str:
    """A fresh folder: under the shared checkpoint folder where one is set, else a local one. It is removed at exit."""
    folder = f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return folder


def _remove(spark, folder: str) -> None:
    with contextlib.suppress(Exception):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


ODD = "text || CASE doc_id % 3 WHEN 0 THEN ' \"quoted\", comma' WHEN 1 THEN chr(10) || 'next line' ELSE '' END"
ODD_SOURCE = "CASE doc_id % 8 WHEN 0 THEN 'None' WHEN 1 THEN 'NA' WHEN 2 THEN '' ELSE source END"


@query(
    "csv_round_trip",
    f"""SELECT doc_id, {ODD} AS text, CASE WHEN doc_id % 8 < 3 THEN NULL ELSE source END AS source,
    CASE WHEN doc_id % 5 = 0 THEN NULL ELSE n_chars::DOUBLE END AS n_chars FROM documents""",
)
def csv_round_trip(spark, sf_dir):
    folder = _folder(spark)
    number = F.when(F.col("doc_id") % 5 == 0, "bad").otherwise(F.col("n_chars").cast("string"))
    docs = table(spark, sf_dir, "documents")
    odd = docs.select("doc_id", F.expr(ODD).alias("text"), F.expr(ODD_SOURCE).alias("source"), "lang", number.alias("n_chars"))
    files.write_csv(odd, folder)
    schema = "doc_id bigint, text string, source string, lang string, n_chars double"
    return files.read_csv(spark, folder, schema, ["doc_id", "text", "source", "n_chars"])


@query("text_round_trip", "SELECT doc_id::VARCHAR AS doc_id, text FROM documents")
def text_round_trip(spark, sf_dir):
    folder = _folder(spark)
    files.write_texts(table(spark, sf_dir, "documents"), folder)
    return spark.read.parquet(folder).select(F.col("doc_id").cast("string").alias("doc_id"), "text")


@query("json_round_trip", "SELECT doc_id, len(string_split(text, ' '))::BIGINT AS n_tokens, string_split(text, ' ')[1] AS first FROM documents")
def json_round_trip(spark, sf_dir):
    folder = _folder(spark)
    files.write_json(table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ", -1).alias("tokens")), folder)
    stored = spark.read.schema("doc_id bigint, tokens array<string>").json(folder)
    return stored.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.get("tokens", F.lit(0)).alias("first"))


@query("posts_by_author", "SELECT source AS username, text FROM documents WHERE source IN (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 5)")
def posts_by_author(spark, sf_dir):
    from textloom.operators.frequency import rows_of_top_groups

    folder = _folder(spark)
    table(spark, sf_dir, "documents").select(F.col("source").alias("username"), "text").write.parquet(folder)
    return rows_of_top_groups(files.read_posts(spark, folder), "username", 5)



@query("csv_by_name", "SELECT doc_id, source, n_chars FROM documents")
def csv_by_name(spark, sf_dir):
    """The schema lists the columns in another order than the files' header."""
    folder = _folder(spark)
    files.write_csv(table(spark, sf_dir, "documents").select("source", "text", "n_chars", "doc_id"), folder)
    return files.read_csv(spark, folder, "doc_id bigint, n_chars bigint, source string, text string", ["doc_id", "source", "n_chars"])


@query("csv_all_columns", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_all_columns(spark, sf_dir):
    folder = _folder(spark)
    files.write_csv(table(spark, sf_dir, "documents"), folder)
    return files.read_csv(spark, folder, "doc_id bigint, text string, lang string, source string, n_chars bigint")


@query("read_text_folder", "SELECT text || chr(10) AS text FROM documents")
def read_text_folder(spark, sf_dir):
    """One text file per document, written and read back."""
    folder = _folder(spark)
    files.write_text_files(table(spark, sf_dir, "documents"), folder)
    return files.read_texts(spark, f"{folder}/*").select("text")


QUOTINGS = (
    "'<p><a class=''x'' href=''/p' || page_id || '?a=1&amp;b=2''>first &eacute;t&eacute;</a> <a href=plain' || page_id || '.txt>Plain Text &copy</a>'"
    " || '<a href=\"/q' || page_id || '\">Plain Text</a></p>'"
)


@query("quoted_links", "SELECT page_id, 'http://h.example/d/plain' || page_id || '.txt' AS link FROM pages")
def quoted_links(spark, sf_dir):
    """Attributes in single quotes, without quotes and in double quotes."""
    quoted = table(spark, sf_dir, "pages").select("page_id", F.lit("http://h.example/d/").alias("url"), F.expr(QUOTINGS).alias("html"))
    return pages.first_link(quoted, "Plain Text").select("page_id", "link")


ENTITIES = "'x' || page_id || ' &eacute;&Eacute;&szlig;&hearts;&frac12;&notit;&copy &amp;lt; &unknown; &NotEqualTilde; ' || url"


@query("entities_all", "SELECT page_id, 'x' || page_id || ' éÉß♥½¬it;© &lt; &unknown; ≂̸ ' || url AS text FROM pages WHERE NOT contains(url, '&')")
def entities_all(spark, sf_dir):
    stored = table(spark, sf_dir, "pages").filter(~F.contains("url", F.lit("&")))
    return stored.select("page_id", markup.unescape(F.expr(ENTITIES)).alias("text"))
