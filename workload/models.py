"""n-gram models, generation and subwords."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import bpe, generate, ngram
from workload.registry import query, table
from workload.text import SENTENCES, SPACE

SEQUENCE = f"{SENTENCES}, seq AS (SELECT doc_id, tok, row_number() OVER (PARTITION BY doc_id ORDER BY s, p) AS i FROM toks)"
CORPUS = f"{SENTENCES}, seq AS (SELECT 1 AS doc_id, tok, row_number() OVER (ORDER BY doc_id, s, p) AS i FROM toks)"


def counts_sql(n: int, sequence: str = SEQUENCE) -> str:
    leads = ", ".join(f"lead(tok, {k}) OVER (PARTITION BY doc_id ORDER BY i) AS t{k}" for k in range(1, n))
    context = " || ' ' || ".join(["tok", *[f"t{k}" for k in range(1, n - 1)]])
    return (
        f"{sequence}, runs AS (SELECT tok, {leads} FROM seq), "
        f"grams AS (SELECT {context} AS context, t{n - 1} AS next, count(*) AS n FROM runs WHERE t{n - 1} IS NOT NULL GROUP BY 1, 2)"
    )


MODEL = "model AS (SELECT context, next, n, (sum(n) OVER (PARTITION BY context))::BIGINT AS ctx_n FROM grams)"
BIGRAMS, TRIGRAMS = counts_sql(2), counts_sql(3)


def tokens(spark, sf_dir):
    return ngram.token_rows(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("bigram_counts", f"WITH {BIGRAMS} SELECT context, next, n FROM grams")
def bigram_counts(spark, sf_dir):
    return ngram.ngram_counts(tokens(spark, sf_dir), 2)


@query("trigram_counts", f"WITH {TRIGRAMS} SELECT context, next, n FROM grams")
def trigram_counts(spark, sf_dir):
    return ngram.ngram_counts(tokens(spark, sf_dir), 3)


@query("trigram_counts_corpus", f"WITH {counts_sql(3, CORPUS)} SELECT context, next, n FROM grams")
def trigram_counts_corpus(spark, sf_dir):
    return ngram.ngram_counts(tokens(spark, sf_dir), 3, "corpus")


@query("context_counts", f"WITH {TRIGRAMS} SELECT context, sum(n)::BIGINT AS ctx_n, count(*) AS n_next FROM grams GROUP BY context")
def context_counts(spark, sf_dir):
    return ngram.context_counts(ngram.ngram_counts(tokens(spark, sf_dir), 3))


@query("bigram_prob", f"WITH {BIGRAMS}, {MODEL} SELECT context, next, n, ctx_n, round(n / ctx_n::DOUBLE, 9) AS p FROM model")
def bigram_prob(spark, sf_dir):
    model = ngram.language_model(ngram.ngram_counts(tokens(spark, sf_dir), 2))
    return model.withColumn("p", F.round("p", 9))


V = "(SELECT count(DISTINCT tok) FROM toks)"


@query(
    "trigram_laplace",
    f"WITH {TRIGRAMS}, {MODEL} SELECT context, next, n, ctx_n, round((n + 1) / (ctx_n + {V})::DOUBLE, 9) AS p FROM model",
)
def trigram_laplace(spark, sf_dir):
    token_table = tokens(spark, sf_dir)
    model = ngram.language_model(ngram.ngram_counts(token_table, 3), ngram.vocabulary_size(token_table))
    return model.withColumn("p", F.round("p", 9))


TOP = "row_number() OVER (PARTITION BY context ORDER BY n DESC, next) AS place, n / ctx_n::DOUBLE AS p"


@query(
    "next_word_top3",
    f"WITH {BIGRAMS}, {MODEL}, ranked AS (SELECT *, {TOP} FROM model) SELECT context, next, round(p, 9) AS p, place FROM ranked WHERE place <= 3",
)
def next_word_top3(spark, sf_dir):
    best = ngram.top_words(ngram.ngram_counts(tokens(spark, sf_dir), 2), 3)
    return best.select("context", "next", F.round("p", 9).alias("p"), "place")


ASKED = ["the", "in", "of", "de", "notaword"]


@query(
    "predict_contexts",
    f"""WITH {BIGRAMS}, {MODEL}, ranked AS (SELECT *, {TOP} FROM model),
    asked AS (SELECT unnest({ASKED!r}) AS context)
    SELECT a.context, r.place, r.next, round(r.p, 9) AS p FROM asked a LEFT JOIN ranked r ON a.context = r.context AND r.place <= 5""",
)
def predict_contexts(spark, sf_dir):
    asked = spark.createDataFrame([(c,) for c in ASKED], "context string")
    # A context's total needs its own n-grams only.
    model = ngram.language_model(ngram.asked_counts(ngram.ngram_counts(tokens(spark, sf_dir), 2), asked))
    return ngram.predict(model, asked, 5).select("context", "place", "next", F.round("p", 9).alias("p"))


@query(
    "model_map",
    f"""WITH {TRIGRAMS}, {MODEL}, ranked AS (SELECT *, {TOP} FROM model)
    SELECT context, count(*) AS size, string_agg(next || '=' || round(p * 1000000)::BIGINT, ',' ORDER BY next) AS words FROM ranked
    WHERE place <= 3 GROUP BY context""",
)
def model_map(spark, sf_dir):
    maps = ngram.packed_predictions(ngram.top_words(ngram.ngram_counts(tokens(spark, sf_dir), 3), 3))
    entries = F.transform(
        F.map_entries("next_words"),
        lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 1000000).cast("bigint").cast("string")),
    )
    return maps.select("context", F.size("next_words").cast("bigint").alias("size"), F.array_join(entries, ",").alias("words"))


@query(
    "model_compare",
    f"""WITH {BIGRAMS}, {MODEL}, {TRIGRAMS[len(SEQUENCE) + 2:].replace('grams', 'grams3').replace('runs', 'runs3')},
    model3 AS (SELECT context, next, n, (sum(n) OVER (PARTITION BY context))::BIGINT AS ctx_n FROM grams3),
    ranked AS (SELECT *, {TOP} FROM model), ranked3 AS (SELECT *, {TOP} FROM model3),
    asked AS (SELECT unnest({ASKED!r}) AS asked)
    SELECT asked, 'bigram' AS model, asked AS context, place, next, round(p, 9) AS p FROM asked LEFT JOIN ranked r ON r.context = asked AND place <= 3
    UNION ALL SELECT asked, 'trigram', 'the ' || asked, place, next, round(p, 9) FROM asked LEFT JOIN ranked3 r ON r.context = 'the ' || asked AND place <= 3""",
)
def model_compare(spark, sf_dir):
    token_table = tokens(spark, sf_dir)
    asked = spark.createDataFrame([(c,) for c in ASKED], "context string")
    wide = asked.select(F.concat_ws(" ", F.lit("the"), "context").alias("context"))
    counts = [ngram.asked_counts(ngram.ngram_counts(token_table, n), keys) for n, keys in ((2, asked), (3, wide))]
    models = [ngram.language_model(c) for c in counts]
    return ngram.compare_models(*models, asked).withColumn("p", F.round("p", 9))


# Walks: one per document, from its first word, twenty words long at most.
STEPS = 20


def _walk_sql() -> str:
    u = "concat('0x', substring(md5(concat('42:', walk, ':{step}')), 1, 15))::BIGINT"
    parts = [
        BIGRAMS,
        "spans AS MATERIALIZED (SELECT context, next, n, sum(n) OVER w AS hi, sum(n) OVER (PARTITION BY context) AS ctx_n FROM grams "
        "WINDOW w AS (PARTITION BY context ORDER BY substring(md5(next), 1, 3), next ROWS UNBOUNDED PRECEDING))",
        "w0 AS MATERIALIZED (SELECT doc_id AS walk, tok AS context, tok AS sentence, false AS ended FROM seq WHERE i = 1)",
        "totals AS MATERIALIZED (SELECT DISTINCT context, ctx_n FROM spans)",
    ]
    for step in range(1, STEPS + 1):
        draw = u.format(step=step)
        parts.append(
            f"d{step} AS MATERIALIZED (SELECT w.walk, w.context, w.sentence, w.ended, {draw} % t.ctx_n AS r FROM w{step - 1} w LEFT JOIN totals t ON t.context = w.context)"
        )
        parts.append(
            f"w{step} AS MATERIALIZED (SELECT d.walk, CASE WHEN d.ended OR s.next IS NULL OR s.next = '<EOS>' THEN d.context ELSE s.next END AS context, "
            f"CASE WHEN d.ended OR s.next IS NULL OR s.next = '<EOS>' THEN d.sentence ELSE d.sentence || ' ' || s.next END AS sentence, "
            f"(d.ended OR s.next IS NULL OR s.next = '<EOS>') AS ended FROM d{step} d LEFT JOIN spans s ON s.context = d.context AND d.r >= s.hi - s.n AND d.r < s.hi)"
        )
    return "WITH " + ",\n".join(parts) + f" SELECT walk, sentence FROM w{STEPS}"


@query("generate_walks", _walk_sql())
def generate_walks(spark, sf_dir):
    token_table = tokens(spark, sf_dir)
    starts = token_table.filter(F.size("tokens") > 0).select(
        F.col("doc_id").alias("walk"), F.get("tokens", F.lit(0)).alias("context")
    )
    return generate.generate(ngram.ngram_counts(token_table, 2), starts, 2, max_length=STEPS)


VOCABULARY = 10_000


@query("bpe_merges")
def bpe_merges(spark, sf_dir):
    model = bpe.learn(table(spark, sf_dir, "documents"), "text", VOCABULARY)
    return bpe.merge_table(spark, model)


@query("bpe_encode")
def bpe_encode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = bpe.learn(docs, "text", VOCABULARY)
    return bpe.encode(docs, "doc_id", "text", model).select("doc_id", F.to_json("ids").alias("ids"))


@query("bpe_pieces", f"SELECT doc_id, regexp_replace(text, '[{SPACE}]+', '', 'g') AS joined FROM documents")
def bpe_pieces(spark, sf_dir):
    """The pieces of a document, put together again, are its text without blanks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = bpe.learn(docs, "text", VOCABULARY)
    split = bpe.pieces(bpe.encode(docs, "doc_id", "text", model), model)
    return split.select("doc_id", F.concat_ws("", "pieces").alias("joined"))


@query("bpe_totals")
def bpe_totals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = bpe.learn(docs, "text", VOCABULARY)
    return bpe.totals(bpe.encode(docs, "doc_id", "text", model), model)
