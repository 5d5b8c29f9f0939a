"""Operators against brute force on small inputs, hot keys included."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as t
from textloom.functions import vectors
from textloom.operators import bayes, bpe, embed, features, frequency, generate, lemma, linear, match, metrics, ngram, ordering, profile, skew
from textloom.plans import jobs

DOCS = [
    (1, "The cat sat. The cat ran! A dog sat on the cat?"),
    (2, ""),
    (3, "the dog, the cat. and THE bird"),
    (4, "... !"),
    (5, "cat"),
    (6, "Dog and cat and dog and bird. the end."),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


def tokens_of(text):
    import re

    out = []
    for sentence in re.split(r"[.!?]+", text.lower()):
        ws = re.findall(r"\b\w+\b", sentence)
        out += [*ws, t.EOS] if ws else []
    return out


def counted(df):
    return {(r["context"], r["next"]): r["n"] for r in df.collect()}


@pytest.mark.parametrize("n", [2, 3])
def test_ngram_counts(docs, n):
    table = ngram.token_rows(docs, "doc_id", "text")
    per_document, corpus = Counter(), []
    for _, text in DOCS:
        seq = tokens_of(text)
        corpus += seq
        per_document.update((" ".join(seq[i : i + n - 1]), seq[i + n - 1]) for i in range(len(seq) - n + 1))
    whole = Counter((" ".join(corpus[i : i + n - 1]), corpus[i + n - 1]) for i in range(len(corpus) - n + 1))
    assert counted(ngram.ngram_counts(table, n)) == dict(per_document)
    assert counted(ngram.ngram_counts(table, n, "corpus")) == dict(whole)


def test_models_sum_to_one_or_less(docs):
    table = ngram.token_rows(docs, "doc_id", "text")
    counts = ngram.ngram_counts(table, 2)
    plain = ngram.language_model(counts).groupBy("context").agg(F.sum("p").alias("p")).collect()
    assert all(abs(r["p"] - 1) < 1e-12 for r in plain)
    smooth = ngram.language_model(counts, ngram.vocabulary_size(table)).groupBy("context").agg(F.sum("p").alias("p")).collect()
    assert all(r["p"] < 1 for r in smooth)


def test_predictions(docs, spark):
    model = ngram.language_model(ngram.ngram_counts(ngram.token_rows(docs, "doc_id", "text"), 2))
    asked = spark.createDataFrame([("the",), ("nothing",)], "context string")
    got = [(r["context"], r["place"], r["next"]) for r in ngram.predict(model, asked, 2).orderBy("context", "place").collect()]
    assert got == [("nothing", None, None), ("the", 1, "cat"), ("the", 2, "bird")]


def test_generate_is_repeatable_and_follows_the_model(docs, spark):
    counts = ngram.ngram_counts(ngram.token_rows(docs, "doc_id", "text"), 2)
    starts = spark.createDataFrame([(i, "the") for i in range(200)] + [(900, "unknown")], "walk bigint, context string")
    first = {r["walk"]: r["sentence"] for r in generate.generate(counts, starts, 2, max_length=3).collect()}
    again = {r["walk"]: r["sentence"] for r in generate.generate(counts, starts, 2, max_length=3).collect()}
    assert first == again and len(first) == 201 and first[900] == "unknown"
    known = counted(counts)
    followers = Counter()
    for walk, sentence in first.items():
        ws = sentence.split()
        assert len(ws) <= 4
        assert all((a, b) in known for a, b in zip(ws, ws[1:])) or walk == 900
        if walk != 900:
            followers[ws[1]] += 1
    assert followers.most_common(1)[0][0] == "cat"


def test_walks_go_to_stored_slots(docs, spark, monkeypatch):
    """The model is dealt out once: a step shuffles walks, not the model."""
    plans, cut = [], generate.cut_lineage
    monkeypatch.setattr(generate, "cut_lineage", lambda df: plans.append((df.columns, str(df._jdf.queryExecution().executedPlan()))) or cut(df))
    counts = ngram.ngram_counts(ngram.token_rows(docs, "doc_id", "text"), 2)
    starts = spark.createDataFrame([(i, "the") for i in range(20)] + [(900, None)], "walk bigint, context string")
    found = generate.generate(counts, starts, 2, max_length=3).collect()
    assert sorted(r["walk"] for r in found) == [*range(20), 900] and [r["sentence"] for r in found if r["walk"] == 900] == [None]
    steps = [plan.split("InMemoryRelation")[0] for columns, plan in plans if columns == ["walk", "context", "sentence"]][1:]
    assert len(steps) == 3 and all(len(re.findall(r"Exchange hashpartitioning\(context#\d+, slot#", step)) == 1 and "InMemoryTableScan" in step for step in steps)


def test_language_models_are_joined_once(spark, monkeypatch):
    """Both probabilities come from one stored model; nothing is joined again for the smoothed one."""
    joined, join = [], ngram.lookup_join
    monkeypatch.setattr(ngram, "lookup_join", lambda *args: joined.append(1) or join(*args))
    docs = spark.createDataFrame([(1, "a b. a c."), (2, "a b"), (3, None)], "doc_id bigint, text string")
    contexts, starts = spark.createDataFrame([("a",)], "context string"), spark.createDataFrame([(1, "a")], "walk bigint, context string")
    result = jobs.language_model_job(docs, contexts, starts, 2)
    assert len(joined) == 2
    got = {(r["context"], r["next"]): (r["n"], r["ctx_n"], r["p"]) for r in result["bigram_laplace"].collect()}
    assert got[("a", "b")] == (2, 3, 3 / 7) and got[("a", "c")] == (1, 3, 2 / 7)
    assert {(r["context"], r["next"]): r["p"] for r in result["bigram"].collect()}[("a", "b")] == 2 / 3


@pytest.mark.parametrize("kind", ["even", "ties", "wide"])
def test_percentiles_from_brackets(spark, kind):
    rng = random.Random(5)
    draw = {"even": lambda: rng.random(), "ties": lambda: float(rng.randint(0, 3)), "wide": lambda: rng.gauss(0, 1) * 10 ** rng.randint(-9, 9)}[kind]
    values = [draw() for _ in range(4000)] + [math.inf, -math.inf] * 3
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(5)
    shares = [0.0, 0.25, 0.26, 0.5, 0.75, 1.0]
    got = {r["share"]: r["value"] for r in ordering.percentiles(df, "v", shares, 16, accuracy=100).collect()}
    assert got == {s: pytest.approx(float(np.percentile(values, s * 100)), rel=1e-12) for s in shares[1:-1]} | {0.0: -math.inf, 1.0: math.inf}
    inside = df.filter("v IS NOT NULL").withColumnRenamed("v", "_v")
    left = inside.select(ordering._outside_brackets(inside, [0.5], 100).alias("x")).distinct().count()
    assert kind == "ties" or left < 600
    # NaN counts as the highest value.
    nans = spark.createDataFrame([(float(v),) for v in range(1500)] + [(math.nan,)] * 1500, "v double")
    high = {r["share"]: r["value"] for r in ordering.percentiles(nans, "v", [0.25, 0.9], 16, accuracy=100).collect()}
    assert high[0.25] == 749.75 and math.isnan(high[0.9])


def test_row_numbers_neighbours_and_percentiles(spark):
    rng = random.Random(1)
    values = [rng.choice([1.5, rng.randint(0, 50), rng.random() * 100]) for _ in range(997)]
    keys = [f"k{i:05d}" for i in rng.sample(range(99999), 997)]
    df = spark.createDataFrame(list(zip(keys, map(float, values))), "k string, v double")
    got = [(r["k"], r["i"]) for r in ordering.global_row_number(df, "k", "i", 16).orderBy("k").collect()]
    assert got == [(k, i) for i, k in enumerate(sorted(keys))]
    by_key = dict(zip(keys, map(float, values)))
    following = {r["k"]: r["nx"] for r in ordering.with_next(df, "k", "v", "nx", 16).collect()}
    ordered = sorted(keys)
    assert following == {k: (by_key[ordered[i + 1]] if i + 1 < len(ordered) else None) for i, k in enumerate(ordered)}
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["share"]: r["value"] for r in ordering.percentiles(df, "v", shares, 64).collect()}
    for share in shares:
        assert math.isclose(got[share], float(np.percentile(values, share * 100)), rel_tol=1e-9)
    assert ordering.percentiles(df.filter("v > 1000"), "v", shares).count() == 0


def test_top_k_with_histogram(spark):
    rng = random.Random(2)
    rows = [(f"t{i:05d}", int(rng.paretovariate(0.7))) for i in range(20000)]
    df = spark.createDataFrame(rows, "term string, n bigint")
    for k in (5, 11000):
        expected = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
        assert [tuple(r) for r in ordering.top_k(df, "n", "term", k).collect()] == expected


def test_lookup_join_with_a_hot_key(spark):
    rows = [(i, "hot" if i % 3 else f"k{i % 50}") for i in range(3000)] + [(5000, "missing"), (5001, None)]
    fact = spark.createDataFrame(rows, "id bigint, key string")
    counts = Counter(k for _, k in rows if k not in (None, "missing"))
    dim = spark.createDataFrame([(k, n, f"v-{k}") for k, n in counts.items()], "key string, n bigint, value string")
    for hot_keys in (1, 3, 1000):
        inner = skew.lookup_join(fact, dim, ["key"], "n", ["id"], hot_keys=hot_keys)
        got = sorted((r["id"], r["key"], r["value"]) for r in inner.collect())
        assert got == sorted((i, k, f"v-{k}") for i, k in rows if k in counts)
        left = skew.lookup_join(fact, dim, ["key"], "n", ["id"], "left", hot_keys)
        assert left.count() == len(rows) and left.filter("value IS NULL").count() == 2
        partial = dim.drop("n").filter("key <> 'hot'")
        unknown = skew.lookup_join(fact, partial, ["key"], None, ["id"], "left", hot_keys)
        assert unknown.count() == len(rows) and unknown.filter("value IS NULL").count() == 2 + counts["hot"]
        assert skew.lookup_join(fact, partial, ["key"], None, ["id"], "inner", hot_keys).count() == 3000 - counts["hot"]
    salted = skew.salted_join(fact, dim.drop("n"), ["key"], ["id"], "left", 7)
    assert salted.count() == len(rows)
    for most in (5, 1000):
        small = skew.small_join(fact, dim.drop("n"), ["key"], ["id"], "left", most)
        assert small.count() == len(rows) and small.filter("value IS NULL").count() == 2
    few_bytes = skew.small_join(fact, dim.drop("n"), ["key"], ["id"], "left", most_bytes=10)
    assert "BroadcastHashJoin" not in few_bytes._jdf.queryExecution().optimizedPlan().toString()
    assert few_bytes.count() == len(rows) and few_bytes.filter("value IS NULL").count() == 2
    assert skew.fits(dim, len(counts), 10_000) and not skew.fits(dim, len(counts) - 1, 10_000) and not skew.fits(dim, 1000, 50)
    wide = spark.createDataFrame([("a", ["x" * 1000])], "`a.b` string, c array<string>")
    assert skew.fits(wide, 1, 2000) and not skew.fits(wide, 1, 1000) and skew.fits(wide.limit(0), 0, 0)


def test_packed_rows_refuses_large_tables(spark):
    small = spark.range(5).withColumn("rows", skew.packed_rows(spark.range(3), ["id"]))
    assert [len(r["rows"]) for r in small.collect()] == [3] * 5
    with pytest.raises(Exception, match="more than 2 rows"):
        spark.range(1).withColumn("rows", skew.packed_rows(spark.range(3), ["id"], 2)).collect()


def test_split_sizes(spark):
    rows = [(i, "a" if i % 3 else ("b" if i % 2 else "c")) for i in range(1003)]
    df = spark.createDataFrame(rows, "id bigint, label string")
    split = ordering.smallest_share(df, "id", "label", 0.2, 42, "is_test", 16)
    got = {r["label"]: (r["n"], r["t"]) for r in split.groupBy("label").agg(F.count("id").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert sum(test for _, test in got.values()) == math.ceil(0.2 * 1003)
    assert all(abs(test - 0.2 * n) <= 1 for n, test in got.values())


def test_deduplicate_and_reports(spark):
    rows = [(1, "x", None), (2, "x", None), (3, None, "a"), (4, None, "a"), (5, "y", "b"), (6, "y", "c")]
    df = spark.createDataFrame(rows, "id bigint, k string, v string")
    assert sorted(r["id"] for r in profile.deduplicate(df, ["k"], "id").collect()) == [1, 3, 5]
    report = profile.duplicate_report(df.drop("id"), ["k"]).collect()[0]
    assert (report["n_rows"], report["n_duplicate_rows"], report["n_left"]) == (6, 2, 3)
    assert {r["column"]: r["n_null"] for r in profile.null_counts(df).collect()} == {"id": 0, "k": 2, "v": 2}


def test_key_join_keeps_fan_out(spark):
    left = spark.createDataFrame([(i, "t", "a" if i % 2 else "b") for i in range(10)], "id bigint, title_clean string, artist_clean string")
    right = spark.createDataFrame([("t", "a"), ("t", "a"), ("t", "z"), (None, "b")], "title_clean string, artist_clean string")
    assert match.key_join(left, right, ["id"]).count() == 10


def test_contexts_are_joined_outside_array_functions(spark):
    """n-grams are laid out and joined in compiled code, not by a function per array element."""
    table = spark.createDataFrame([(1, ["a", "b", "c", "d"]), (2, ["a"]), (3, None)], "doc_id bigint, tokens array<string>")
    grams = ngram.ngrams(table, 3)
    assert sorted(tuple(r) for r in grams.collect()) == [("a b", "c"), ("b c", "d")]
    assert "lambda" not in grams._jdf.queryExecution().executedPlan().toString()


def test_classifiers_keep_texts_not_their_ngrams(spark, monkeypatch):
    rows = [(i, "one two three" if i % 2 else "four five six", "ab"[i % 2]) for i in range(20)]
    train = spark.createDataFrame(rows, "id bigint, text string, label string")
    stored, persist = [], type(train).persist

    def noted(df, *args):
        stored.append(df.columns)
        return persist(df, *args)

    monkeypatch.setattr(type(train), "persist", noted)
    model = linear.fit_classifier(train, "naive_bayes", "id", "text", "label", 100, (1, 3))
    assert stored and not any("terms" in columns for columns in stored)
    assert all(r["predicted"] == r["label"] for r in linear.classify(model, train, "text", (1, 3)).collect())


def test_matches_are_counted_without_making_them_up(spark):
    """Two million matches of three rows each stay three rows with a number."""
    left = spark.createDataFrame([(i, "t", "a") for i in range(3)] + [(9, None, "a")], "id bigint, title_clean string, artist_clean string")
    right = spark.range(2_000_000).selectExpr("'t' AS title_clean", "'a' AS artist_clean")
    matched = match.weighted_join(left, right, ["id"])
    assert sorted((r["id"], r["repeats"]) for r in matched.collect()) == [(i, 2_000_000) for i in range(3)]
    summary = match.match_summary(left, right, matched, repeats="repeats").collect()[0]
    assert (summary["n_rows"], summary["n_matched"], summary["n_matched_distinct"], summary["match_rate"]) == (4, 6_000_000, 1, 100.0)


def test_bpe_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["lower", "lowest", "newer", "wider", "aaaa", "aaa", "x-ray", "été", "!!", "new"]) for _ in range(60)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    library = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="[UNK]"))
    library.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    trainer = tokenizers.trainers.BpeTrainer(vocab_size=45, special_tokens=bpe.SPECIAL, show_progress=False)
    library.train_from_iterator(texts, trainer=trainer)
    model = bpe.learn(df, "text", 45)
    assert {p: i for i, p in enumerate(model.vocabulary)} == library.get_vocab()
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(df, "doc_id", "text", model).collect()}
    assert got == {i: library.encode(text).ids for i, text in enumerate(texts)}
    named = bpe.pieces(bpe.encode(df, "doc_id", "text", model), model)
    assert {r["doc_id"]: r["pieces"] for r in named.collect()} == {i: library.encode(text).tokens for i, text in enumerate(texts)}
    unseen = spark.createDataFrame([(0, "newest lowers ? ray"), (1, "")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(unseen, "doc_id", "text", model).collect()}
    assert got == {0: library.encode("newest lowers ? ray").ids, 1: []}


def test_lemmas(spark):
    words = spark.createDataFrame([(w,) for w in ["cats", "was", "wolves", "men", "boxes", "ss", "glasses", "geese", "zzz", "ladies"]], "token string")
    dictionary = spark.createDataFrame([(w,) for w in ["cat", "wa", "wolf", "man", "men", "box", "glass", "goose", "lady", "ladies"]], "word string")
    exceptions = spark.createDataFrame([("geese", "goose")], "word string, lemma string")
    got = {r["token"]: r["lemma"] for r in lemma.lemma_table(words, dictionary, exceptions).collect()}
    assert got == {
        "cats": "cat", "was": "wa", "wolves": "wolf", "men": "men", "boxes": "box", "ss": "ss", "glasses": "glass",
        "geese": "goose", "zzz": "zzz", "ladies": "lady",
    }


TRAIN = [(1, "x", "a a b"), (2, "x", "a c"), (3, "y", "b b d"), (4, "y", "d"), (5, "x", "a")]
TEST = [(10, "x", "a d d e"), (11, "y", "e"), (12, "y", "b c d")]


def brute_bayes(kind):
    labels = sorted({label for _, label, _ in TRAIN})
    vocabulary = sorted({w for _, _, text in TRAIN for w in text.split()})
    out = {}
    for i, _, text in TEST:
        counts = Counter(w for w in text.split() if w in vocabulary)
        for label in labels:
            mine = [text for _, other, text in TRAIN if other == label]
            score = math.log(len(mine) / len(TRAIN))
            tf = Counter(w for text in mine for w in text.split())
            df = Counter(w for text in mine for w in set(text.split()))
            for w in vocabulary:
                if kind == "multinomial":
                    score += counts[w] * math.log((tf[w] + 1) / (sum(tf.values()) + len(vocabulary)))
                else:
                    p = (df[w] + 1) / (len(mine) + 2)
                    score += math.log(p) if counts[w] else math.log(1 - p)
            out[i, label] = score
    return out


@pytest.mark.parametrize("kind", ["multinomial", "bernoulli"])
def test_bayes(spark, kind):
    schema = "id bigint, label string, text string"
    train, test = spark.createDataFrame(TRAIN, schema), spark.createDataFrame(TEST, schema)
    counts = [features.term_counts(d, "id", F.split("text", " ")) for d in (train, test)]
    if kind == "bernoulli":
        counts = [features.binary_terms(c) for c in counts]
    fit = bayes.fit_multinomial if kind == "multinomial" else bayes.fit_bernoulli
    scored = bayes.scores(fit(train, counts[0], "id"), test, counts[1], "id")
    got = {(r["id"], r["label"]): r["score"] for r in scored.collect()}
    expected = brute_bayes(kind)
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], rel_tol=1e-9) for k in got)
    best = {r["id"]: r["prediction"] for r in bayes.predict(scored, "id").collect()}
    assert best == {i: min((-expected[i, label], label) for label in ("x", "y"))[1] for i, _, _ in TEST}
    sums = bayes.probabilities(scored, "id").groupBy("id").agg(F.sum("probability").alias("p")).collect()
    assert all(math.isclose(r["p"], 1) for r in sums)


@pytest.mark.parametrize("fits", [True, False])
def test_topic_predictions_match_one_model_per_topic(spark, monkeypatch, fits):
    monkeypatch.setattr(skew, "fits", lambda *_: fits)
    rng = random.Random(9)
    names = ["p", "q", "r"]
    rows = [
        (i, [n for n in names if rng.random() < 0.4], " ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 8))))
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "id bigint, topics array<string>, text string")
    train, test = df.filter("id < 45"), df.filter("id >= 45")
    counts = [features.term_counts(d, "id", F.split("text", " ")) for d in (train, test)]
    topics = spark.createDataFrame([(n,) for n in [*names, "never"]], "topic string")
    parts = [d.select("id", "topics") for d in (train, test)]
    got = {(r["id"], r["topic"]): (r["mnb"], r["bnb"]) for r in bayes.topic_predictions(*parts, *counts, topics, "id").collect()}
    carried = [features.term_counts(train, "id", F.split("text", " "), keep=["topics"]), counts[1]]
    again = bayes.topic_predictions(*parts, *carried, topics.union(spark.sql("SELECT CAST(NULL AS string)")), "id")
    assert {(r["id"], r["topic"]): (r["mnb"], r["bnb"]) for r in again.collect() if r["topic"]} == got
    for name in names:
        labelled = train.select("id", F.array_contains("topics", name).cast("int").alias("label"))
        mnb = bayes.predict(bayes.scores(bayes.fit_multinomial(labelled, counts[0], "id"), test, counts[1], "id"), "id")
        binary = [features.binary_terms(c) for c in counts]
        bnb = bayes.predict(bayes.scores(bayes.fit_bernoulli(labelled, binary[0], "id"), test, binary[1], "id"), "id")
        one = {r["id"]: r["prediction"] for r in mnb.collect()}
        two = {r["id"]: r["prediction"] for r in bnb.collect()}
        assert all(got[i, name] == (one[i], two[i]) for i in one)
    assert all(got[i, "never"] == (0, 0) for i, _, _ in rows if i >= 45)


def test_metrics(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("b", "b"), ("d", "d"), ("a", "z")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id bigint, label string, prediction string")
    names = sorted({x for p in pairs for x in p})
    cells = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(x, y): sum(p == (x, y) for p in pairs) for x in names for y in names}
    expected = {}
    for name in names:
        tp = sum(p == (name, name) for p in pairs)
        said, yes = sum(p[1] == name for p in pairs), sum(p[0] == name for p in pairs)
        precision, recall = (tp / said if said else 0), (tp / yes if yes else 0)
        expected[name] = (precision, recall, 2 * precision * recall / (precision + recall) if tp else 0, yes)
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    for name in names:
        r = report[name]
        assert (r["precision"], r["recall"], r["f1"], r["support"]) == pytest.approx(expected[name])
    assert report["macro avg"]["f1"] == pytest.approx(sum(e[2] for e in expected.values()) / len(names))
    assert report["weighted avg"]["precision"] == pytest.approx(sum(e[0] * e[3] for e in expected.values()) / len(pairs))
    assert report["accuracy"]["f1"] == pytest.approx(4 / 7)
    assert [r["id"] for r in metrics.misclassified(df, "id", 2).collect()] == [1, 3]


def test_tfidf_rows_have_length_one(docs):
    counts = features.term_counts(docs, "doc_id")
    vocabulary = features.learn_vocabulary(counts, 4)
    weights = features.tfidf(counts, vocabulary, docs.agg(F.count("*")), "doc_id", 4)
    lengths = weights.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert lengths and all(math.isclose(r["s"], 1) for r in lengths)


def test_vectors_and_search(spark):
    rng = np.random.default_rng(0)
    data = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(40)] + [(99, [0.0] * 4)]
    df = spark.createDataFrame(data, "id bigint, vector array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0, 0.5, 0.0]), (2, [0.0] * 4)], "query_id bigint, vector array<double>")
    got = defaultdict(list)
    for r in embed.search(df, queries, 3, "id", size=4).orderBy("query_id", "place").collect():
        got[r["query_id"]].append(r["id"])
    q = np.array([1.0, 0.0, 0.5, 0.0])
    sims = {i: (np.dot(q, v) / np.linalg.norm(v) / np.linalg.norm(q) if any(v) else 0) for i, v in data}
    assert got[1] == sorted(sims, key=lambda i: (-round(sims[i], 9), i))[:3]
    assert got[2] == [0, 1, 2]
    loose = df.select(F.max(F.abs(vectors.dot("vector", "vector") - vectors.dot("vector", "vector", 4)))).collect()[0][0]
    assert loose < 1e-12
    words = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "token string, vector array<double>")
    tokens = spark.createDataFrame([(1, ["a", "b", "b", "zz"]), (2, ["zz"]), (3, [])], "id bigint, tokens array<string>")
    means = {r["id"]: r["vector"] for r in embed.document_vectors(tokens, "id", F.col("tokens"), words, 2).collect()}
    assert means[1] == pytest.approx([1 / 3, 2 / 3]) and means[2] == [0.0, 0.0] and means[3] == [0.0, 0.0]


def test_keep_vocabulary_keeps_order_and_rows(docs):
    vocabulary = frequency.frequent_terms(docs, t.words(F.lower("text")), 3)
    kept = {r["doc_id"]: r["tokens"] for r in frequency.keep_vocabulary(docs, "doc_id", t.words(F.lower("text")), vocabulary).collect()}
    import re

    words = {i: re.findall(r"\w+", text.lower()) for i, text in DOCS}
    frequent = {w for w, n in Counter(w for ws in words.values() for w in ws).items() if n >= 3}
    assert kept == {i: [w for w in ws if w in frequent] for i, ws in words.items()}
