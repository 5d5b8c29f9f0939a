"""The composite jobs: whole analyses put together from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import books, cleaners
from textloom.functions import text as t
from textloom.operators import bayes, bpe, chart, dictionary, embed, features, frequency, generate, lemma, linear, match, metrics, ngram, ordering, profile
from textloom.session import cut_lineage, stored_table
from textloom.sources import news, pages


def catalogue_job(stored: DataFrame, language: str = "English", phrase: str = "Plain Text UTF-8") -> DataFrame:
    """Book records from detail pages (``url``, ``html``): complete, in one language, with a text link."""
    fields = list(pages.BOOK_FIELDS.values())
    known = pages.properties(stored).filter(F.col("Language") == language)
    linked = pages.first_link(pages.complete(known, fields), phrase, name="text_url")
    return linked.select(F.col("url").alias("URL"), *[F.col(f"`{c}`") for c in fields], "text_url")


def catalogue_links(stored: DataFrame, heading: str = r'<h2\b[^>]*id="books-last30"[^>]*>') -> DataFrame:
    """Links to the detail pages from the overview page (``url``, ``html``)."""
    return pages.section_links(stored, heading, "ol")


def clean_books(raw: DataFrame) -> DataFrame:
    """Books (``doc_id``, ``text``) without boilerplate and contents list."""
    return raw.withColumn("text", books.clean_book("text"))


def book_preprocess_job(
    raw: DataFrame, dictionary: DataFrame, exceptions: DataFrame | None = None, vocab_size: int = 10_000
) -> dict[str, DataFrame]:
    """Clean books, encode them as subwords, and compare their lemmas with their stems."""
    cleaned = clean_books(raw).persist()
    spark = raw.sparkSession
    model = bpe.learn(cleaned, "text", vocab_size)
    encoded = bpe.pieces(bpe.encode(cleaned, "doc_id", "text", model), model, "tokens")
    counts = cut_lineage(frequency.word_counts(cleaned, t.words(F.lower("text"))))
    lemmas, stems = lemma.lemma_counts(counts, dictionary, exceptions), lemma.stem_counts(counts)
    return {
        "cleaned": cleaned,
        "merges": bpe.merge_table(spark, model),
        "vocabulary": bpe.vocabulary_table(spark, model),
        "encoded": encoded,
        "totals": bpe.totals(encoded, model),
        "lemmas": lemma.top_with_size(lemmas, "lemma"),
        "stems": lemma.top_with_size(stems, "stem"),
        "comparison": lemma.compare_sizes(lemmas, stems),
    }


def language_model_job(
    docs: DataFrame, contexts: DataFrame, starts: DataFrame, max_length: int = 20, seed: int = 42, boundary: str = "document"
) -> dict[str, DataFrame]:
    """Bigram and trigram models of (``doc_id``, ``text``), smoothed and not, with predictions and sentences.

    ``contexts`` is a table (``context``) to predict for; ``starts`` (``walk``, ``context``) starts sentences.
    """
    tokens = ngram.token_rows(docs, "doc_id", "text")
    size = ngram.vocabulary_size(tokens)
    # The models are stored one after the other, and nothing of the work on one is left when the next begins.
    plain = {n: stored_table(ngram.language_model(ngram.ngram_counts(tokens, n, boundary)), "model") for n in (2, 3)}
    # Smoothing changes the probabilities only, so the totals are not joined again.
    smooth = {n: ngram.smoothed(model, size) for n, model in plain.items()}
    return {
        "bigram": plain[2],
        "trigram": plain[3],
        "bigram_laplace": smooth[2],
        "trigram_laplace": smooth[3],
        "predictions": ngram.predict(plain[2], contexts, 5),
        "comparison": ngram.compare_models(plain[2], plain[3], contexts),
        "sentences": generate.generate(plain[2], starts, 2, max_length, seed),
    }


def author_classifier_job(
    posts: DataFrame, top_n: int = 5, max_features: int = 50_000, emoji: Mapping[str, str] | None = None, examples: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Tell the ``top_n`` most frequent authors of (``id``, ``username``, ``text``) apart by two models.

    Examples are scored as they are, without the cleaning that training posts get.
    """
    chosen = frequency.rows_of_top_groups(posts, "username", top_n)
    cleaned = chosen.withColumn("cleaned", cleaners.clean_post("text", emoji)).dropna(subset=["cleaned"])
    split = ordering.smallest_share(cleaned, "id", "username", 0.2, 42, "is_test").persist()
    train, test = split.filter("NOT is_test"), split.filter("is_test")
    grams = (1, 3)
    models = {
        name: linear.fit_classifier(train, kind, "id", "cleaned", "username", max_features, grams)
        for name, kind in (("Logistic Regression", "logistic"), ("Naive Bayes", "naive_bayes"))
    }
    result: dict[str, DataFrame] = {}
    for name, model in models.items():
        predicted = linear.classify(model, test, "cleaned", grams).persist()
        result[f"{name}: predictions"] = predicted
        result[f"{name}: accuracy"] = metrics.accuracy(predicted, "username", "predicted")
        result[f"{name}: report"] = metrics.class_report(predicted, "username", "predicted")
        result[f"{name}: confusion"] = metrics.confusion_matrix(predicted, "username", "predicted")
    logistic = result["Logistic Regression: predictions"]
    result["misclassified"] = metrics.misclassified(logistic, "id", 5, "username", "predicted")
    if examples:
        result["examples"] = linear.classify_examples(models, examples, posts, grams)
    return result


def topic_nb_job(records: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """Two Naive Bayes models per frequent topic of (``id``, ``lewissplit``, ``topics``, ``body_text``)."""
    present = records.dropna(subset=["body_text"]).withColumn("topics", t.topic_list("topics"))
    topics = frequency.top_labels(present, F.col("topics"), k, "topic").select("topic")
    parts = {name: present.filter(F.col("lewissplit") == name) for name in news.SPLITS}
    counts = {name: features.term_counts(part, "id", text="body_text", keep=["topics"]) for name, part in parts.items()}
    labelled = {name: part.select("id", "topics") for name, part in parts.items()}
    predictions = bayes.topic_predictions(
        labelled["TRAIN"], labelled["TEST"], counts["TRAIN"], counts["TEST"], topics, "id"
    ).persist()
    scores = metrics.topic_scores(predictions)
    return {"predictions": predictions, "scores": scores, "comparison": metrics.model_comparison(scores)}


def corpus_description_job(records: DataFrame, stop_words: Sequence[str]) -> dict[str, DataFrame]:
    """Describe (``id``, ``lewissplit``, ``topics``, ``body_text``): sizes, topics, lengths, vocabulary, term counts."""
    present = records.dropna(subset=["body_text"])
    tokens = present.select("id", "lewissplit", cleaners.news_tokens("body_text", stop_words).alias("raw"))
    corpus = dictionary.encode_corpus(tokens, "id", F.col("raw"), F.col("lewissplit") == "TRAIN")
    vocabulary = corpus.terms.filter("total >= 2").select("term", F.col("total").alias("n"))
    return {
        "shape": profile.shape(records),
        "shares": profile.shares(records, "lewissplit"),
        "topics": frequency.label_counts(records, t.topic_list("topics"), "topic"),
        "top_topics": frequency.top_labels(records.filter("lewissplit = 'TRAIN'"), t.topic_list("topics"), 10, "topic"),
        "lengths": profile.length_stats(records, "body_text"),
        "topics_per_record": profile.list_length_counts(records, t.split_commas("topics"), "n_topics"),
        "vocabulary": frequency.vocabulary_index(vocabulary),
        "term_counts": features.term_counts(corpus.known(2), "id", F.col("tokens")),
    }


def semantic_search_job(
    articles: DataFrame, queries: DataFrame, stop_words: Sequence[str], k: int = 5, size: int = 100, partitions: int | None = None
) -> dict[str, DataFrame]:
    """Train word vectors on (``id``, ``text``) and find the ``k`` articles closest to each query (``query_id``, ``text``)."""
    tokens = articles.select("id", "text", cleaners.search_tokens("text", stop_words).alias("tokens")).persist()
    words = embed.train_word_vectors(tokens, size=size, partitions=partitions).persist()
    stored = embed.document_vectors(embed.spread(tokens), "id", F.col("tokens"), words, size)
    asked = queries.select("query_id", cleaners.search_tokens("text", stop_words).alias("tokens"))
    wanted = embed.document_vectors(asked, "query_id", F.col("tokens"), words, size).select("query_id", "vector")
    found = embed.search(stored.select("id", "vector"), wanted, k, "id", size=size)
    shown = found.join(tokens.select("id", t.preview("text").alias("preview")), "id")
    return {"words": words, "documents": stored, "results": shown}


def chart_job(stored: DataFrame, size: int = 100) -> DataFrame:
    """Ranked charts of all years from chart pages (``year``, ``html``)."""
    return chart.rank_chart(pages.chart_rows(stored), ["pos"], size)


def chart_quality_job(ranked: DataFrame) -> DataFrame:
    """Quality report of a chart table; its rows get the key year * 1000 + rank."""
    keyed = ranked.withColumn("row_key", F.col("year").cast("bigint") * 1000 + F.col("rank"))
    return profile.quality_report(keyed, "artist", "year", "rank", "row_key")


def lyrics_steps(language: str = "en", first_year: int = 2003, last_year: int = 2023, unwanted: str = "misc") -> dict[str, Column]:
    """The filter steps of the lyrics job; a missing genre is kept."""
    present = F.lit(True)
    for name in ("year", "lyrics", "title", "artist"):
        present = present & F.col(name).isNotNull()
    return {
        "language": F.col("language") == language,
        "year": F.col("year").between(first_year, last_year),
        "genre": ~F.col("tag").eqNullSafe(unwanted),
        "complete": present,
    }


def lyrics_match_job(lyrics: DataFrame, ranked: DataFrame) -> dict[str, DataFrame]:
    """Keep the lyrics (``title``, ``tag``, ``artist``, ``year``, ``lyrics``, ``language``) of charted songs."""
    typed = lyrics.withColumn("year", t.to_number("year"))
    kept = typed
    for condition in lyrics_steps().values():
        kept = kept.filter(condition)
    keyed, charted = match.with_keys(kept), match.with_keys(ranked)
    matched = match.key_join(keyed, charted, ["lyrics"])
    return {
        "funnel": profile.funnel(typed, lyrics_steps()),
        "matched": matched,
        "summary": match.match_summary(keyed, charted, match.weighted_join(keyed, charted, ["lyrics"]), repeats="repeats"),
    }


def genre_classifier_job(
    songs: DataFrame,
    stop_words: Sequence[str],
    dictionary: DataFrame,
    exceptions: DataFrame | None = None,
    emoji: Mapping[str, str] | None = None,
    max_features: int = 10_000,
    max_iter: int = 1000,
) -> dict[str, DataFrame]:
    """Profile (``id``, ``lyrics``, ``tag``, ...), clean the lyrics, and classify genres by three models.

    As published, the duplicates that the profile reports stay in the training data.
    """
    described = songs.drop("id")
    present = songs.dropna(subset=["lyrics", "tag"])
    tokens = present.select("id", "tag", cleaners.lyric_tokens("lyrics", stop_words, emoji).alias("raw"))
    counts = cut_lineage(frequency.word_counts(tokens, F.col("raw")))
    lemmas = lemma.lemma_table(counts, dictionary, exceptions, ["n"]).withColumnRenamed("lemma", "replacement")
    cleaned = lemma.replace_tokens(tokens, "id", F.col("raw"), lemmas).withColumn("clean_lyrics", F.array_join("tokens", " "))
    split = ordering.smallest_share(cleaned.drop("raw", "tokens"), "id", "tag", 0.2, 42, "is_test").persist()
    train, test = split.filter("NOT is_test"), split.filter("is_test")
    result: dict[str, DataFrame] = {
        "shape": profile.shape(described),
        "missing": profile.null_counts(described),
        "duplicates": profile.duplicate_report(described, ["lyrics"]),
        "genres": frequency.ordered_counts(present, "tag"),
    }
    kinds = {"Logistic Regression": ("logistic", True), "Naive Bayes": ("naive_bayes", False), "LinearSVC": ("svm", True)}
    for name, (kind, balanced) in kinds.items():
        model = linear.fit_classifier(train, kind, "id", "clean_lyrics", "tag", max_features, (1, 2), balanced, max_iter)
        predicted = linear.classify(model, test, "clean_lyrics").persist()
        result[f"{name}: accuracy"] = metrics.accuracy(predicted, "tag", "predicted")
        result[f"{name}: report"] = metrics.class_report(predicted, "tag", "predicted")
        result[f"{name}: confusion"] = metrics.confusion_matrix(predicted, "tag", "predicted")
        result[f"{name}: macro F1"] = metrics.macro_f1(predicted, "tag", "predicted")
        if kind == "svm":
            result["top words"] = linear.top_terms(model, test, 3)
    return result

