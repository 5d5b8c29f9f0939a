"""Splits, features, Naive Bayes, linear models and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as t
from textloom.operators import bayes, dictionary, features, linear, metrics, ordering
from workload.registry import query, table

WORDS2 = r"[\p{L}\p{N}_]{2,}"

# --- split ---------------------------------------------------------------------------------

# Each group's part of the test rows: whole quota, then the largest remainders.
SPLIT_SQL = """sizes AS (SELECT lang, count(*) AS n, sum(count(*)) OVER () AS total FROM documents GROUP BY lang),
quotas AS (SELECT lang, ceil(0.2::DOUBLE * total) * n / total AS quota, ceil(0.2::DOUBLE * total) AS wanted FROM sizes),
ranked_quotas AS (SELECT lang, floor(quota) AS whole, wanted - sum(floor(quota)) OVER () AS missing,
  row_number() OVER (ORDER BY round(quota - floor(quota), 9) DESC, lang) AS place FROM quotas),
takes AS (SELECT lang, whole + CASE WHEN place <= missing THEN 1 ELSE 0 END AS take FROM ranked_quotas),
placed AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS place FROM documents),
split AS (SELECT doc_id, p.lang, p.place <= t.take AS is_test FROM placed p JOIN takes t ON p.lang = t.lang)"""


def _split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return ordering.smallest_share(docs, "doc_id", "lang", 0.2, 42, "is_test")


@query("strat_split", f"WITH {SPLIT_SQL} SELECT doc_id, lang, is_test FROM split")
def strat_split(spark, sf_dir):
    return _split(spark, sf_dir).select("doc_id", "lang", "is_test")


# --- features ------------------------------------------------------------------------------

COUNTS_SQL = f"counts AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORDS2}')) AS term FROM documents) GROUP BY 1, 2)"


@query("term_counts", f"WITH {COUNTS_SQL} SELECT doc_id, term, tf FROM counts")
def term_counts(spark, sf_dir):
    return features.term_counts(table(spark, sf_dir, "documents"), "doc_id")


@query("binary_terms", f"WITH {COUNTS_SQL} SELECT doc_id, term, 1::BIGINT AS tf FROM counts")
def binary_terms(spark, sf_dir):
    return features.binary_terms(features.term_counts(table(spark, sf_dir, "documents"), "doc_id"))


@query(
    "known_term_counts",
    f"""WITH {COUNTS_SQL.replace('counts AS (', 'counts AS MATERIALIZED (', 1)},
    vocab AS MATERIALIZED (SELECT term FROM counts JOIN documents USING (doc_id) WHERE source <> 'src1' GROUP BY term HAVING sum(tf) > 1)
    SELECT doc_id, term, tf FROM counts SEMI JOIN vocab USING (term)""",
)
def known_term_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    corpus = dictionary.encode_corpus(docs, "doc_id", t.long_words("text"), F.col("source") != "src1")
    return features.term_counts(corpus.known(2), "doc_id", F.col("tokens"))


# Terms of one to three words, counted per document.
GRAMS_SQL = f"""ws AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORDS2}') AS w FROM documents),
pos AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM ws),
leads AS (SELECT doc_id, a, lead(a, 1) OVER v AS b, lead(a, 2) OVER v AS c FROM pos WINDOW v AS (PARTITION BY doc_id ORDER BY i)),
terms AS (SELECT doc_id, a AS term FROM leads UNION ALL SELECT doc_id, a || ' ' || b FROM leads WHERE b IS NOT NULL
  UNION ALL SELECT doc_id, a || ' ' || b || ' ' || c FROM leads WHERE c IS NOT NULL),
gcounts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2)"""
FEATURES = 10_000
VOCAB_SQL = f"vocab AS (SELECT term, sum(tf)::BIGINT AS total, count(*) AS df FROM gcounts GROUP BY term ORDER BY total DESC, term LIMIT {FEATURES})"


def _grams():
    return t.bind(t.long_words("text"), lambda words: features.word_ngrams(words, 1, 3))


def _gram_counts(docs):
    return features.term_counts(docs, "doc_id", _grams())


@query("ngram_vocab", f"WITH {GRAMS_SQL}, {VOCAB_SQL} SELECT term, total, df FROM vocab")
def ngram_vocab(spark, sf_dir):
    return features.learn_vocabulary(_gram_counts(table(spark, sf_dir, "documents")), FEATURES)


TFIDF_SQL = f"""{GRAMS_SQL}, {SPLIT_SQL},
train AS (SELECT g.* FROM gcounts g JOIN split s ON g.doc_id = s.doc_id WHERE NOT is_test),
vocab AS (SELECT term, sum(tf) AS total, count(*) AS df FROM train GROUP BY term ORDER BY total DESC, term LIMIT {FEATURES}),
raw AS (SELECT g.doc_id, g.term, tf * (ln((1 + (SELECT count(*) FROM split WHERE NOT is_test)) / (1 + df)::DOUBLE) + 1) AS x FROM gcounts g JOIN vocab v ON g.term = v.term),
weights AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def _tfidf(split, *parts):
    """TF-IDF weights of all documents, or of each of the ``parts``, from the vocabulary of the training documents."""
    train = split.filter("NOT is_test")
    vocabulary = features.learn_vocabulary(_gram_counts(train), FEATURES)
    n_train = train.agg(F.count(F.lit(1)))
    keep = lambda part: [c for c in part.columns if c == "label"]
    found = [features.tfidf_rows(part, "doc_id", _grams(), vocabulary, n_train, FEATURES, keep(part)) for part in parts or [split]]
    return found if parts else found[0]


@query("tfidf", f"WITH {TFIDF_SQL} SELECT doc_id, term, round(weight, 6) AS weight FROM weights")
def tfidf(spark, sf_dir):
    return _tfidf(_split(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


# --- Naive Bayes on the language label --------------------------------------------------------

MNB_SQL = f"""{SPLIT_SQL}, {COUNTS_SQL},
traind AS (SELECT doc_id, lang AS label FROM split WHERE NOT is_test), testd AS (SELECT doc_id, lang AS label FROM split WHERE is_test),
ct AS (SELECT label, term, sum(tf) AS s, count(*) AS d FROM counts JOIN traind USING (doc_id) GROUP BY 1, 2),
vocab AS (SELECT DISTINCT term FROM ct), v AS (SELECT count(*) AS v FROM vocab),
prior AS (SELECT label, count(*) AS n, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM traind GROUP BY label),
tot AS (SELECT label, sum(s) AS t FROM ct GROUP BY label),
grid AS (SELECT p.label, w.term, coalesce(ct.s, 0) AS s, coalesce(ct.d, 0) AS d, p.n, tot.t, v.v
  FROM prior p CROSS JOIN vocab w CROSS JOIN v JOIN tot ON tot.label = p.label LEFT JOIN ct ON ct.label = p.label AND ct.term = w.term),
mnb AS (SELECT label, term, ln((s + 1) / (t + v)::DOUBLE) AS lp FROM grid),
bnb AS (SELECT label, term, ln((d + 1) / (n + 2)::DOUBLE) AS lp, ln(1 - (d + 1) / (n + 2)::DOUBLE) AS lq FROM grid),
mscore AS (SELECT t.doc_id, p.label, p.prior + coalesce(sum(c.tf * m.lp), 0) AS score FROM testd t CROSS JOIN prior p
  LEFT JOIN counts c ON c.doc_id = t.doc_id AND c.term IN (SELECT term FROM vocab) LEFT JOIN mnb m ON m.label = p.label AND m.term = c.term GROUP BY t.doc_id, p.label, p.prior),
base AS (SELECT label, sum(lq) AS base FROM bnb GROUP BY label),
bscore AS (SELECT t.doc_id, p.label, p.prior + b.base + coalesce(sum(m.lp - m.lq), 0) AS score FROM testd t CROSS JOIN prior p JOIN base b ON b.label = p.label
  LEFT JOIN counts c ON c.doc_id = t.doc_id AND c.term IN (SELECT term FROM vocab) LEFT JOIN bnb m ON m.label = p.label AND m.term = c.term GROUP BY t.doc_id, p.label, p.prior, b.base),
mpred AS (SELECT doc_id, label AS prediction FROM mscore QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, label) = 1),
bpred AS (SELECT doc_id, label AS prediction FROM bscore QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, label) = 1),
pred AS (SELECT t.doc_id, t.label, p.prediction FROM testd t JOIN mpred p ON p.doc_id = t.doc_id)"""


def _parts(spark, sf_dir):
    """(train, test, train counts, test counts) for the language label."""
    split = _split(spark, sf_dir).withColumnRenamed("lang", "label")
    train, test = split.filter("NOT is_test"), split.filter("is_test")
    return train, test, features.term_counts(train, "doc_id", keep=["label"]), features.term_counts(test, "doc_id")


def _multinomial(spark, sf_dir):
    train, test, train_counts, test_counts = _parts(spark, sf_dir)
    return bayes.fit_multinomial(train, train_counts, "doc_id"), test, test_counts


def _bernoulli(spark, sf_dir):
    train, test, train_counts, test_counts = _parts(spark, sf_dir)
    return bayes.fit_bernoulli(train, features.binary_terms(train_counts), "doc_id"), test, features.binary_terms(test_counts)


def _predicted(spark, sf_dir, fit=_multinomial):
    model, test, counts = fit(spark, sf_dir)
    predictions = bayes.predict(bayes.scores(model, test, counts, "doc_id"), "doc_id")
    return test.select("doc_id", "label").join(predictions, "doc_id")


@query("mnb_params", f"WITH {MNB_SQL} SELECT label, term, round(lp, 6) AS value FROM mnb SEMI JOIN ct USING (label, term)")
def mnb_params(spark, sf_dir):
    model, _, _ = _multinomial(spark, sf_dir)
    return bayes.parameters(model).withColumn("value", F.round("value", 6))


@query("bnb_params", f"WITH {MNB_SQL} SELECT label, term, round(lp - lq, 6) AS value FROM bnb SEMI JOIN ct USING (label, term)")
def bnb_params(spark, sf_dir):
    model, _, _ = _bernoulli(spark, sf_dir)
    return bayes.parameters(model).withColumn("value", F.round("value", 6))


@query("mnb_scores", f"WITH {MNB_SQL} SELECT doc_id, label, round(score, 5) AS score FROM mscore")
def mnb_scores(spark, sf_dir):
    model, test, counts = _multinomial(spark, sf_dir)
    return bayes.scores(model, test, counts, "doc_id").withColumn("score", F.round("score", 5))


@query("bnb_scores", f"WITH {MNB_SQL} SELECT doc_id, label, round(score, 5) AS score FROM bscore")
def bnb_scores(spark, sf_dir):
    model, test, counts = _bernoulli(spark, sf_dir)
    return bayes.scores(model, test, counts, "doc_id").withColumn("score", F.round("score", 5))


@query("mnb_predict", f"WITH {MNB_SQL} SELECT doc_id, label, prediction FROM pred")
def mnb_predict(spark, sf_dir):
    return _predicted(spark, sf_dir)


@query("bnb_predict", f"WITH {MNB_SQL} SELECT t.doc_id, t.label, p.prediction FROM testd t JOIN bpred p ON p.doc_id = t.doc_id")
def bnb_predict(spark, sf_dir):
    return _predicted(spark, sf_dir, _bernoulli)


@query(
    "mnb_probabilities",
    f"""WITH {MNB_SQL}, shifted AS (SELECT doc_id, label, exp(score - max(score) OVER (PARTITION BY doc_id)) AS w FROM mscore)
    SELECT doc_id, label, round(w / sum(w) OVER (PARTITION BY doc_id), 6) AS probability FROM shifted""",
)
def mnb_probabilities(spark, sf_dir):
    model, test, counts = _multinomial(spark, sf_dir)
    scored = bayes.scores(model, test, counts, "doc_id")
    return bayes.probabilities(scored, "doc_id").withColumn("probability", F.round("probability", 6))


TFIDF_MNB_SQL = f"""{TFIDF_SQL},
traind AS (SELECT doc_id, lang AS label FROM split WHERE NOT is_test), testd AS (SELECT doc_id, lang AS label FROM split WHERE is_test),
ct AS (SELECT label, term, sum(weight) AS s FROM weights JOIN traind USING (doc_id) GROUP BY 1, 2),
known AS (SELECT DISTINCT term FROM ct), v AS (SELECT count(*) AS v FROM known), tot AS (SELECT label, sum(s) AS t FROM ct GROUP BY label),
prior AS (SELECT label, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM traind GROUP BY label),
mnb AS (SELECT p.label, w.term, ln((coalesce(ct.s, 0) + 1) / (t + v)) AS lp FROM prior p CROSS JOIN known w CROSS JOIN v
  JOIN tot ON tot.label = p.label LEFT JOIN ct ON ct.label = p.label AND ct.term = w.term),
score AS (SELECT t.doc_id, p.label, p.prior + coalesce(sum(c.weight * m.lp), 0) AS score FROM testd t CROSS JOIN prior p
  LEFT JOIN weights c ON c.doc_id = t.doc_id AND c.term IN (SELECT term FROM known) LEFT JOIN mnb m ON m.label = p.label AND m.term = c.term GROUP BY t.doc_id, p.label, p.prior)"""


@query("mnb_tfidf_scores", f"WITH {TFIDF_MNB_SQL} SELECT doc_id, label, round(score, 5) AS score FROM score")
def mnb_tfidf_scores(spark, sf_dir):
    split = _split(spark, sf_dir).withColumnRenamed("lang", "label")
    train, test = split.filter("NOT is_test"), split.filter("is_test")
    texts = split.select("doc_id", "text")
    # Ids meet their part before texts are cut into terms, so the weights are neither joined nor worked out for the other part.
    learned, held_out = _tfidf(split, texts.join(train.select("doc_id", "label"), "doc_id"), texts.join(test.select("doc_id"), "doc_id", "left_semi"))
    model = bayes.fit_multinomial(train, learned, "doc_id", "weight")
    return bayes.scores(model, test, held_out, "doc_id", "weight").withColumn("score", F.round("score", 5))


# --- metrics -------------------------------------------------------------------------------


@query("accuracy", f"WITH {MNB_SQL} SELECT round(avg((label = prediction)::INT), 9) AS accuracy FROM pred")
def accuracy(spark, sf_dir):
    return metrics.accuracy(_predicted(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 9))


CLASS_SQL = """classes AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
cells AS (SELECT c, (SELECT count(*) FROM pred WHERE label = c AND prediction = c) AS tp, (SELECT count(*) FROM pred WHERE prediction = c) AS said,
  (SELECT count(*) FROM pred WHERE label = c) AS support FROM classes),
pr AS (SELECT c, support, CASE WHEN said = 0 THEN 0 ELSE tp / said::DOUBLE END AS p, CASE WHEN support = 0 THEN 0 ELSE tp / support::DOUBLE END AS r FROM cells),
f AS (SELECT c, support, p, r, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1 FROM pr)"""


@query(
    "class_report",
    f"""WITH {MNB_SQL}, {CLASS_SQL}
    SELECT c AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM f
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'accuracy', NULL, NULL, round((SELECT avg((label = prediction)::INT) FROM pred), 6), sum(support)::BIGINT FROM f""",
)
def class_report(spark, sf_dir):
    report = metrics.class_report(_predicted(spark, sf_dir))
    return report.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("macro_f1", f"WITH {MNB_SQL}, {CLASS_SQL} SELECT round(avg(f1), 6) AS macro_f1 FROM f")
def macro_f1(spark, sf_dir):
    return metrics.macro_f1(_predicted(spark, sf_dir)).withColumn("macro_f1", F.round("macro_f1", 6))


@query(
    "confusion",
    f"""WITH {MNB_SQL}, classes AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred)
    SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM pred WHERE label = a.c AND prediction = b.c) AS n FROM classes a CROSS JOIN classes b""",
)
def confusion(spark, sf_dir):
    return metrics.confusion_matrix(_predicted(spark, sf_dir))


@query(
    "misclassified",
    f"""WITH {MNB_SQL} SELECT t.doc_id, t.label, p.prediction, text FROM testd t JOIN bpred p ON p.doc_id = t.doc_id JOIN documents d ON d.doc_id = t.doc_id
    WHERE t.label <> p.prediction ORDER BY t.doc_id LIMIT 5""",
)
def misclassified(spark, sf_dir):
    wrong = metrics.misclassified(_predicted(spark, sf_dir, _bernoulli), "doc_id", 5)
    return wrong.join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


@query(
    "prf_binary",
    """WITH x AS (SELECT toxic, (quality = 0)::INT AS said FROM labels),
    c AS (SELECT count(*) FILTER (toxic = 1 AND said = 1) AS tp, count(*) FILTER (said = 1) AS s, count(*) FILTER (toxic = 1) AS y FROM x),
    pr AS (SELECT CASE WHEN s = 0 THEN 0 ELSE tp / s::DOUBLE END AS p, CASE WHEN y = 0 THEN 0 ELSE tp / y::DOUBLE END AS r FROM c)
    SELECT round(p, 9) AS precision, round(r, 9) AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 9) AS f1 FROM pr""",
)
def prf_binary(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("said", (F.col("quality") == 0).cast("int"))
    scored = metrics.binary_scores(labels, "toxic", "said")
    return scored.select(*[F.round(c, 9).alias(c) for c in scored.columns])


# --- one classifier per topic ------------------------------------------------------------------

# Training rows: all but source 7 and 13. Topics: language and source; the ten most frequent over all rows.
TOPIC_SQL = f"""{COUNTS_SQL}, d AS (SELECT doc_id, [lang, source] AS topics, source IN ('src7', 'src13') AS is_test FROM documents),
flat AS (SELECT doc_id, is_test, unnest(topics) AS topic FROM d),
topics AS (SELECT topic FROM flat GROUP BY topic ORDER BY count(*) DESC, topic LIMIT 10),
train AS (SELECT doc_id FROM d WHERE NOT is_test), y AS (SELECT t.topic, d.doc_id, is_test, list_contains(topics, t.topic) AS y FROM d CROSS JOIN topics t),
tc AS (SELECT c.* FROM counts c JOIN train USING (doc_id)), vocab AS (SELECT DISTINCT term FROM tc), v AS (SELECT count(*) AS v FROM vocab),
n AS (SELECT topic, y, count(*) AS n FROM y WHERE NOT is_test GROUP BY 1, 2),
ct AS (SELECT y.topic, y.y, term, sum(tf) AS s, count(*) AS df FROM tc JOIN y ON y.doc_id = tc.doc_id GROUP BY 1, 2, 3),
tot AS (SELECT topic, y, sum(s) AS t FROM ct GROUP BY 1, 2),
grid AS (SELECT n.topic, n.y, w.term, ln((coalesce(ct.s, 0) + 1) / (t + v)::DOUBLE) AS lp, ln((coalesce(ct.df, 0) + 1) / (n + 2)::DOUBLE) AS bp, ln(1 - (coalesce(ct.df, 0) + 1) / (n + 2)::DOUBLE) AS bq
  FROM n JOIN tot ON tot.topic = n.topic AND tot.y = n.y CROSS JOIN vocab w CROSS JOIN v LEFT JOIN ct ON ct.topic = n.topic AND ct.y = n.y AND ct.term = w.term),
diff AS (SELECT topic, term, sum(CASE WHEN y THEN lp ELSE -lp END) AS m, sum(CASE WHEN y THEN bp - bq ELSE bq - bp END) AS b, sum(CASE WHEN y THEN bq ELSE -bq END) AS q FROM grid GROUP BY 1, 2),
base AS (SELECT topic, sum(q) AS q FROM diff GROUP BY topic),
prior AS (SELECT topic, coalesce(ln(max(n) FILTER (y) / max(n) FILTER (NOT y)::DOUBLE), '-inf'::DOUBLE) AS prior FROM n GROUP BY topic),
scored AS (SELECT y.topic, y.doc_id, y.y, p.prior + coalesce(sum(c.tf * diff.m), 0) AS m, p.prior + base.q + coalesce(sum(diff.b), 0) AS b
  FROM y JOIN prior p ON p.topic = y.topic JOIN base ON base.topic = y.topic LEFT JOIN counts c ON c.doc_id = y.doc_id AND c.term IN (SELECT term FROM vocab)
  LEFT JOIN diff ON diff.topic = y.topic AND diff.term = c.term WHERE y.is_test GROUP BY y.topic, y.doc_id, y.y, p.prior, base.q),
preds AS (SELECT doc_id, topic, y::INT::BIGINT AS actual, (round(m, 9) > 0)::INT::BIGINT AS mnb, (round(b, 9) > 0)::INT::BIGINT AS bnb FROM scored)"""


def _topic_predictions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.array("lang", "source").alias("topics"), F.col("source").isin("src7", "src13").alias("is_test")
    )
    from textloom.operators import frequency

    topics = frequency.top_labels(docs, F.col("topics"), 10, "topic").select("topic")
    train, test = docs.filter("NOT is_test"), docs.filter("is_test")
    counts = [features.term_counts(train, "doc_id", keep=["topics"]), features.term_counts(test, "doc_id")]
    return bayes.topic_predictions(train.select("doc_id", "topics"), test.select("doc_id", "topics"), *counts, topics, "doc_id")


@query("multi_topic_nb", f"WITH {TOPIC_SQL} SELECT * FROM preds")
def multi_topic_nb(spark, sf_dir):
    return _topic_predictions(spark, sf_dir)


def _prf_sql(model: str) -> str:
    tp, said, yes = f"count(*) FILTER (actual = 1 AND {model} = 1)", f"count(*) FILTER ({model} = 1)", "count(*) FILTER (actual = 1)"
    p = f"CASE WHEN {said} = 0 THEN 0 ELSE {tp} / {said}::DOUBLE END"
    r = f"CASE WHEN {yes} = 0 THEN 0 ELSE {tp} / {yes}::DOUBLE END"
    f1 = f"CASE WHEN {said} + {yes} = 0 THEN 0 ELSE 2 * {tp} / ({said} + {yes})::DOUBLE END"
    return f"round({p}, 3) AS {model}_precision, round({r}, 3) AS {model}_recall, round({f1}, 3) AS {model}_f1"


TOPIC_SCORES = f"WITH {TOPIC_SQL}, topic_scores AS (SELECT topic, {_prf_sql('mnb')}, {_prf_sql('bnb')} FROM preds GROUP BY topic)"


@query("topic_scores", f"{TOPIC_SCORES} SELECT * FROM topic_scores")
def topic_scores(spark, sf_dir):
    return metrics.topic_scores(_topic_predictions(spark, sf_dir))


@query(
    "metric_avg",
    f"""{TOPIC_SCORES} SELECT 'Multinomial NB' AS model, round(avg(mnb_f1), 3) AS average_f1 FROM topic_scores
    UNION ALL SELECT 'Bernoulli NB', round(avg(bnb_f1), 3) FROM topic_scores""",
)
def metric_avg(spark, sf_dir):
    return metrics.model_comparison(metrics.topic_scores(_topic_predictions(spark, sf_dir)))


@query(
    "top_terms_bayes",
    f"""WITH {MNB_SQL} SELECT label, term, round(lp, 6) AS value, row_number() OVER (PARTITION BY label ORDER BY round(lp, 9) DESC, term) AS place
    FROM mnb SEMI JOIN ct USING (label, term) QUALIFY place <= 3""",
)
def top_terms_bayes(spark, sf_dir):
    model, _, _ = _multinomial(spark, sf_dir)
    return linear.top_terms_of(bayes.parameters(model), 3).withColumn("value", F.round("value", 6))


# --- linear models: rows only ------------------------------------------------------------------


def _linear(spark, sf_dir, kind, balanced):
    split = _split(spark, sf_dir)
    model = linear.fit_classifier(split.filter("NOT is_test"), kind, "doc_id", "text", "lang", 10_000, (1, 2), balanced, 1000)
    return model, split.filter("is_test")


def _linear_predictions(spark, sf_dir, kind, balanced):
    model, test = _linear(spark, sf_dir, kind, balanced)
    return linear.classify(model, test, "text").select("doc_id", "lang", "predicted")


@query("logreg")
def logreg(spark, sf_dir):
    return _linear_predictions(spark, sf_dir, "logistic", False)


@query("logreg_balanced")
def logreg_balanced(spark, sf_dir):
    return _linear_predictions(spark, sf_dir, "logistic", True)


@query("svm_ovr")
def svm_ovr(spark, sf_dir):
    return _linear_predictions(spark, sf_dir, "svm", True)


@query("top_terms_svm")
def top_terms_svm(spark, sf_dir):
    model, test = _linear(spark, sf_dir, "svm", True)
    return linear.top_terms(model, test, 3).withColumn("coefficient", F.round("coefficient", 4))


EXAMPLES = ["The one and only of them is on the way.", "Le père et la mère de la maison."]


@query("score_examples")
def score_examples(spark, sf_dir):
    split = _split(spark, sf_dir)
    train = split.filter("NOT is_test")
    models = {kind: linear.fit_classifier(train, kind, "doc_id", "text", "lang", 10_000, (1, 2), False, 1000) for kind in ("logistic", "naive_bayes")}
    return linear.classify_examples(models, EXAMPLES, split)
