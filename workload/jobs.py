"""The composite jobs over the given tables, and markup files written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as t
from textloom.operators import frequency, ngram
from textloom.plans import jobs
from textloom.sources import news
from workload.extract import CHART_ROW, LABELLED_SQL, RECORD, _folder
from workload.features import TOPIC_SCORES
from workload.models import ASKED, BIGRAMS, MODEL, SEQUENCE, TRIGRAMS, V
from workload.registry import query, table
from workload.tables import CHART_SQL, REPORT_SQL, _chart
from workload.text import BOOK, BOOK_SQL, EMOJI, LEMMAS, NEWS, NEWS_SQL, STEM_COUNTS, STEMS, STOP, WORD_COUNTS


@query(
    "read_markup_files",
    f"""WITH {LABELLED_SQL} SELECT topics_present, lewissplit, topics, body_text, row_number() OVER (PARTITION BY filename ORDER BY doc_id) AS record_ix FROM kept""",
)
def read_markup_files(spark, sf_dir):
    """Records are written into one file per eighth of the documents, in Latin-1, and read by their closing tags."""
    folder = _folder(spark)
    raw = F.encode(F.expr(RECORD), "ISO-8859-1").cast("string").alias("value")
    records = table(spark, sf_dir, "documents").select((F.col("doc_id") % 8).alias("part"), "doc_id", raw)
    # One task per file.
    placed = records.repartitionById(8, F.col("part").cast("int")).sortWithinPartitions("doc_id")
    placed.select("value").write.text(folder)
    numbered = news.number_records(news.labelled_records(news.read_records(spark, folder, "*.txt")))
    return numbered.select("topics_present", "lewissplit", "topics", "body_text", "record_ix")


@query(
    "job_chart",
    """WITH r AS (SELECT c_custkey // 50 AS year, row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_custkey) - 1 AS pos,
    CASE WHEN c_custkey % 11 = 0 THEN '& co' ELSE c_name || ' & co' END AS title, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE c_mktsegment || 'X' END AS artist FROM customer),
    firsts AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY year, title, artist ORDER BY pos) = 1),
    ranked AS (SELECT year, title, artist, row_number() OVER (PARTITION BY year ORDER BY pos) AS rank FROM firsts)
    SELECT year, title, artist, rank, (rank <= 10)::INT::BIGINT AS top_10 FROM ranked WHERE rank <= 100""",
)
def job_chart(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 50).alias("year"), "c_custkey", F.expr(CHART_ROW).alias("row"))
    parts = rows.groupBy("year").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "row"))).alias("rows"))
    html = F.concat(F.lit("<body>"), F.concat_ws("<p>ad</p>", F.transform("rows", lambda r: r["row"])), F.lit("</body>"))
    return jobs.chart_job(parts.select("year", html.alias("html")))


@query("job_chart_quality", REPORT_SQL.replace("CASE WHEN rank = 7 THEN rank::VARCHAR WHEN rank = 8 THEN NULL ELSE artist END AS artist", "artist"))
def job_chart_quality(spark, sf_dir):
    report = jobs.chart_quality_job(_chart(spark, sf_dir))
    record = F.from_json("value", "title string, artist string")
    short = F.concat(record["title"], F.lit("/"), F.coalesce(record["artist"], F.lit("")))
    rounded = F.round(F.round(F.col("value").try_cast("double"), 4) * 10000).cast("bigint").cast("string")
    value = F.when(F.col("check").isin("head", "best"), short).when(F.col("check") == "rank", rounded).otherwise(F.col("value"))
    return report.withColumn("value", value)


# Songs made of orders; the chart is that of `chart_rank`.
LYRICS = {
    "title": "'Song ' || (o_custkey % 97) || CASE WHEN o_orderkey % 3 = 0 THEN ' (Live)!' ELSE '' END",
    "tag": "CASE WHEN o_orderkey % 9 = 0 THEN 'misc' WHEN o_orderkey % 10 <> 0 THEN 'rap' END",
    "artist": "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN o_orderpriority || ', Other' ELSE o_orderpriority END",
    "year": "CASE WHEN o_orderkey % 19 = 0 THEN 'bad' ELSE CAST(year(o_orderdate) + 9 AS STRING) END",
    "lyrics": "CASE WHEN o_orderkey % 13 <> 0 THEN 'la ' || o_orderkey END",
    "language": "CASE WHEN o_orderkey % 4 = 0 THEN 'fr' ELSE 'en' END",
}
_STEPS = {
    "language": "language = 'en'",
    "year": "number BETWEEN 2003 AND 2023",
    "genre": "tag IS DISTINCT FROM 'misc'",
    "complete": "number IS NOT NULL AND lyrics IS NOT NULL AND title IS NOT NULL AND artist IS NOT NULL",
}
_PASSED = [" AND ".join(f"({c})" for c in list(_STEPS.values())[:i]) or "true" for i in range(5)]
LYRICS_SQL = f"""{CHART_SQL}, lyrics AS (SELECT {", ".join(f"{sql} AS {name}" for name, sql in LYRICS.items())} FROM orders),
typed AS (SELECT *, try_cast(year AS DOUBLE) AS number FROM lyrics),
songs AS (SELECT *, trim(lower(replace(replace(title, '(Live)', ''), '!', ''))) AS t, lower(replace(artist, ', Other', '')) AS a FROM typed WHERE {_PASSED[4]}),
hits AS (SELECT lower(title) AS t, lower(artist) AS a FROM chart),
matched AS (SELECT s.* FROM songs s JOIN hits h ON s.t = h.t AND s.a = h.a)
{" UNION ALL ".join(f"SELECT 'funnel' AS part, '{name}' AS key, count(*) AS n FROM typed WHERE {_PASSED[i]}" for i, name in enumerate(["all", *_STEPS]))}
UNION ALL SELECT 'summary', 'n_rows', count(*) FROM songs
UNION ALL SELECT 'summary', 'n_other_distinct', count(*) FROM (SELECT DISTINCT t, a FROM hits)
UNION ALL SELECT 'summary', 'n_matched', count(*) FROM matched
UNION ALL SELECT 'summary', 'n_matched_distinct', count(*) FROM (SELECT DISTINCT t, a FROM matched)
UNION ALL SELECT 'matched', lyrics, count(*) FROM matched GROUP BY lyrics"""


@query("job_lyrics_match", LYRICS_SQL)
def job_lyrics_match(spark, sf_dir):
    """The funnel, the summary, and how often each lyric was matched."""
    lyrics = table(spark, sf_dir, "orders").select(*[F.expr(sql).alias(name) for name, sql in LYRICS.items()])
    result = jobs.lyrics_match_job(lyrics, _chart(spark, sf_dir))
    names = ["n_rows", "n_other_distinct", "n_matched", "n_matched_distinct"]
    entries = F.array(*[F.struct(F.lit("summary").alias("part"), F.lit(n).alias("key"), F.col(n).alias("n")) for n in names])
    funnel = result["funnel"].select(F.lit("funnel").alias("part"), F.col("name").alias("key"), "n")
    matched = result["matched"].groupBy(F.lit("matched").alias("part"), F.col("lyrics").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return funnel.unionByName(result["summary"].select(F.inline(entries))).unionByName(matched)


def _news(spark, sf_dir, body: str = "text") -> DataFrame:
    """Records of news made of documents; two sources are the test set, as in `multi_topic_nb`."""
    split = F.when(F.col("source").isin("src7", "src13"), "TEST").otherwise("TRAIN").alias("lewissplit")
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("id"), split, F.concat_ws(",", "lang", "source").alias("topics"), F.expr(body).alias("body_text"))


@query(
    "job_topic_nb",
    f"""{TOPIC_SCORES}, averages AS (SELECT 'Multinomial NB' AS topic, round(avg(mnb_f1), 3) AS f1 FROM topic_scores
    UNION ALL SELECT 'Bernoulli NB', round(avg(bnb_f1), 3) FROM topic_scores)
    SELECT topic, mnb_f1, bnb_f1 FROM topic_scores UNION ALL SELECT topic, f1, NULL FROM averages""",
)
def job_topic_nb(spark, sf_dir):
    """F1 of both models per topic, and their averages."""
    result = jobs.topic_nb_job(_news(spark, sf_dir))
    averages = result["comparison"].select(F.col("model").alias("topic"), F.col("average_f1").alias("mnb_f1"), F.lit(None).cast("double").alias("bnb_f1"))
    return result["scores"].select("topic", "mnb_f1", "bnb_f1").unionByName(averages)


@query(
    "job_corpus_description",
    f"""WITH toks AS (SELECT doc_id AS id, source, string_split({NEWS_SQL}, ' ') AS ws FROM documents WHERE ({NEWS}) IS NOT NULL),
    long AS MATERIALIZED (SELECT id, source, w FROM (SELECT id, source, unnest(ws) AS w FROM toks) WHERE w <> ''),
    vocab AS MATERIALIZED (SELECT w FROM long WHERE source NOT IN ('src7', 'src13') GROUP BY w HAVING count(*) > 1)
    SELECT 'term' AS part, id::VARCHAR AS key, w AS value, count(*) AS n FROM long SEMI JOIN vocab USING (w) GROUP BY id, w
    UNION ALL SELECT 'vocabulary', w, '', row_number() OVER (ORDER BY w) - 1 FROM vocab
    UNION ALL SELECT 'topic', topic, '', count(*) FROM (SELECT unnest([lang, source]) AS topic FROM documents) GROUP BY topic
    UNION ALL SELECT 'shape', n_rows::VARCHAR, '', 4 FROM (SELECT count(*) AS n_rows FROM documents)""",
)
def job_corpus_description(spark, sf_dir):
    """Term counts over the vocabulary, the vocabulary with its numbers, topics, and the table's shape."""
    result = jobs.corpus_description_job(_news(spark, sf_dir, NEWS), STOP)

    def rows(name: str, part: str, key: str, value: str | None, n: str) -> DataFrame:
        shown = F.lit("") if value is None else F.col(value)
        return result[name].select(F.lit(part).alias("part"), F.col(key).cast("string").alias("key"), shown.alias("value"), F.col(n).cast("bigint").alias("n"))

    found = rows("term_counts", "term", "id", "term", "tf").unionByName(rows("vocabulary", "vocabulary", "term", None, "term_index"))
    return found.unionByName(rows("topics", "topic", "topic", None, "n")).unionByName(rows("shape", "shape", "n_rows", None, "n_columns"))


@query(
    "job_language_model",
    f"""WITH {BIGRAMS}, {MODEL}, {TRIGRAMS[len(SEQUENCE) + 2:].replace('grams', 'grams3').replace('runs', 'runs3')},
    model3 AS (SELECT context, next, n, (sum(n) OVER (PARTITION BY context))::BIGINT AS ctx_n FROM grams3)
    SELECT 'bigram' AS model, context, next, n, round(n / ctx_n::DOUBLE, 9) AS p FROM model
    UNION ALL SELECT 'trigram', context, next, n, round(n / ctx_n::DOUBLE, 9) FROM model3
    UNION ALL SELECT 'bigram_laplace', context, next, n, round((n + 1) / (ctx_n + {V})::DOUBLE, 9) FROM model
    UNION ALL SELECT 'trigram_laplace', context, next, n, round((n + 1) / (ctx_n + {V})::DOUBLE, 9) FROM model3""",
)
def job_language_model(spark, sf_dir):
    """The four models of the job, one after the other."""
    docs = table(spark, sf_dir, "documents")
    contexts = spark.createDataFrame([(c,) for c in ASKED], "context string")
    tokens = ngram.token_rows(docs, "doc_id", "text")
    starts = tokens.filter(F.size("tokens") > 0).select(F.col("doc_id").alias("walk"), F.get("tokens", F.lit(0)).alias("context"))
    result = jobs.language_model_job(docs, contexts, starts, max_length=2)
    named = [result[n].select(F.lit(n).alias("model"), "context", "next", "n", F.round("p", 9).alias("p")) for n in ("bigram", "trigram", "bigram_laplace", "trigram_laplace")]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


_CLEANED = f"FROM (SELECT doc_id, body AS text FROM ({BOOK_SQL}))"
_BOOK_STEMS, _BOOK_COUNTS = (sql.replace("FROM documents", _CLEANED) for sql in (STEMS, WORD_COUNTS))


@query(
    "job_book_preprocess",
    f"""{_BOOK_STEMS}, {STEM_COUNTS}, {LEMMAS[len(WORD_COUNTS) + 2:]}
    (SELECT 'lemma' AS kind, lemma AS token, n, (SELECT count(*) FROM lc) AS n_distinct FROM lc ORDER BY n DESC, lemma LIMIT 20)
    UNION ALL (SELECT 'stem', stem, n, (SELECT count(*) FROM sc) FROM sc ORDER BY n DESC, stem LIMIT 20)
    UNION ALL SELECT 'difference', '', abs((SELECT count(*) FROM sc) - (SELECT count(*) FROM lc)), 0""",
)
def job_book_preprocess(spark, sf_dir):
    """The most frequent lemmas and stems of cleaned books, and the difference of their numbers. The job learns 10 000 subwords too."""
    raw = table(spark, sf_dir, "documents").select("doc_id", F.expr(BOOK).alias("text"))
    words = frequency.word_counts(jobs.clean_books(raw), t.words(F.lower("text")))
    result = jobs.book_preprocess_job(raw, words.filter("n >= 5").select(F.col("token").alias("word")))
    lemmas = result["lemmas"].select(F.lit("lemma").alias("kind"), F.col("lemma").alias("token"), "n", "n_distinct")
    stems = result["stems"].select(F.lit("stem").alias("kind"), F.col("stem").alias("token"), "n", "n_distinct")
    less = result["comparison"].select(F.lit("difference").alias("kind"), F.lit("").alias("token"), F.col("difference").alias("n"), F.lit(0).cast("bigint").alias("n_distinct"))
    return lemmas.unionByName(stems).unionByName(less)


# --- trained models: rows only -----------------------------------------------------------------


@query("job_author_classifier")
def job_author_classifier(spark, sf_dir):
    """The reports of both models, with 50 000 features; languages stand for authors, of whom five at most are told apart."""
    posts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("username"), "text")
    result = jobs.author_classifier_job(posts, 5, 50_000, EMOJI)
    reports = [result[f"{m}: report"].select(F.lit(m).alias("model"), "class", "precision", "recall", "f1", "support") for m in ("Logistic Regression", "Naive Bayes")]
    return reports[0].unionByName(reports[1])


@query("job_genre_classifier")
def job_genre_classifier(spark, sf_dir):
    """The reports of three models that tell roles apart by their turns."""
    turns = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("lyrics"), F.col("role").alias("tag"))
    words = frequency.word_counts(turns, t.words(F.lower("lyrics"))).filter("n >= 5").select(F.col("token").alias("word"))
    result = jobs.genre_classifier_job(turns, STOP, words, emoji=EMOJI)
    names = ["Logistic Regression", "Naive Bayes", "LinearSVC"]
    reports = [result[f"{m}: report"].select(F.lit(m).alias("model"), "class", "precision", "recall", "f1", "support") for m in names]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query("job_semantic_search")
def job_semantic_search(spark, sf_dir):
    """The five articles nearest to each of three questions."""
    articles = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    asked = spark.createDataFrame([(0, "the only one of them"), (1, "la maison de la mère"), (2, "notaword")], "query_id bigint, text string")
    return jobs.semantic_search_job(articles, asked, STOP)["results"]
