"""Corpora as numbers, and tables inside expressions, against plain Python."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.operators import dictionary, features, skew

ROWS = [(i, i % 3, [random.Random(i).choice("abcdefgh") * random.Random(i * 7 + k).randint(1, 3) for k in range(i % 9)]) for i in range(60)]
ROWS += [(100, 0, None), (101, 1, []), (102, 2, ["a", None, "zz", "a"]), (103, 0, ["hot"] * 500), (104, None, ["q"])]


@pytest.fixture(scope="module")
def corpus(spark):
    df = spark.createDataFrame(ROWS, "id long, part int, words array<string>").repartition(4)
    return dictionary.encode_corpus(df, "id", F.col("words"), F.col("part") != 1, keep=["part"])


def plain():
    words = {i: [w for w in ws or [] if w is not None] for i, _, ws in ROWS}
    learned = {i for i, p, _ in ROWS if p is not None and p != 1}
    n, total, df = Counter(), Counter(), Counter()
    for i, ws in words.items():
        n.update(ws)
        if i in learned:
            total.update(ws)
            df.update(set(ws))
    order = sorted(n, key=lambda w: (-total[w], w))
    return words, {w: (k, n[w], total[w], df[w]) for k, w in enumerate(order)}


def test_terms_are_numbered_by_frequency(corpus):
    assert {r.term: (r.number, r.n, r.total, r.df) for r in corpus.terms.collect()} == plain()[1]


def test_rows_keep_their_tokens_and_numbers(corpus):
    words, terms = plain()
    got = {r.id: (r.part, r.tokens, r.numbers) for r in corpus.rows.collect()}
    assert got == {i: (p, words[i], [terms[w][0] for w in words[i]]) for i, p, _ in ROWS}


@pytest.mark.parametrize("least", [1, 2, 9, 10_000])
def test_cut_within_the_row(corpus, least):
    words, terms = plain()
    cut = corpus.known(least)
    got = {r.id: (r.tokens, r.numbers) for r in cut.collect()}
    known = {i: [w for w in ws if terms[w][2] >= least] for i, ws in words.items()}
    assert got == {i: (ws, [terms[w][0] for w in ws]) for i, ws in known.items()}
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


@pytest.mark.parametrize("frequent", [1, 4, 23, 1000])
def test_any_number_of_terms_looked_up_within_rows(spark, frequent):
    """Rows come back whole whatever the number of terms sent to them, and only places of other terms are shuffled."""
    df = spark.createDataFrame([*ROWS, (100, 5, ["rare", "hot", "rare"]), (None, 0, ["q", "only"])], "id long, part int, words array<string>").repartition(3)
    found = dictionary.encode_corpus(df, "id", F.col("words"), F.col("part") != 1, ["part"], frequent)
    numbers = {r.term: r.number for r in found.terms.collect()}
    got = sorted((r.id or -1, r.part or 0, r.tokens, r.numbers) for r in found.rows.collect())
    words = lambda ws: [w for w in ws or [] if w is not None]
    assert got == sorted((r.id or -1, r.part or 0, words(r.words), [numbers[w] for w in words(r.words)]) for r in df.collect())


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "id long, words array<string>")
    found = dictionary.encode_corpus(df, "id", F.col("words"))
    assert found.rows.collect() == [] and found.terms.collect() == [] and found.known(2).collect() == []


@pytest.mark.parametrize("size", [0, 1, 5, 3000])
def test_lookup_inside_expressions(spark, size):
    table = spark.createDataFrame([(f"k{i}", i) for i in range(size)], "k string, v int")
    found = skew.lookup_table(table, "k", ["v"], 3000)
    df = spark.createDataFrame([(1, ["k0", "k4", "none", None, "k2999"]), (2, []), (3, None)], "id int, keys array<string>")
    got = found.attach(df).select("id", F.transform("keys", lambda k: found.get(k)["v"]).alias("v")).collect()
    pick = lambda i: i if i < size else None
    assert {r.id: r.v for r in got} == {1: [pick(0), pick(4), None, None, pick(2999)], 2: [], 3: None}


def test_lookup_fails_above_its_bound(spark):
    table = spark.createDataFrame([(f"k{i}", i) for i in range(11)], "k string, v int")
    found = skew.lookup_table(table, "k", ["v"], 10)
    with pytest.raises(Exception, match="more than 10 rows"):
        found.attach(spark.range(1)).select(found.get(F.lit("k3"))["v"]).collect()


def test_tfidf_within_rows(spark):
    df = spark.createDataFrame(ROWS, "id long, part int, words array<string>").repartition(4)
    vocabulary = features.learn_vocabulary(features.term_counts(df, "id", F.col("words")), 12)
    got = {(r.id, r.term): r.weight for r in features.tfidf_rows(df, "id", F.col("words"), vocabulary, df.agg(F.count("*")), 12).collect()}
    known = {r.term: r.df for r in vocabulary.collect()}
    wanted = {}
    for i, _, ws in ROWS:
        raw = {w: n * (math.log((len(ROWS) + 1) / (known[w] + 1)) + 1) for w, n in Counter(ws or []).items() if w in known}
        size = math.sqrt(sum(x * x for x in raw.values()))
        wanted |= {(i, w): x / size for w, x in raw.items()}
    assert got == pytest.approx(wanted)
    plan = features.tfidf_rows(df, "id", F.col("words"), vocabulary, df.agg(F.count("*")), 12)
    # Nothing is shuffled by document.
    assert "hashpartitioning(id" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("buckets", [4, 64, 1 << 22])
def test_capped_vocabulary_counts_the_terms_of_heavy_buckets_only(spark, monkeypatch, buckets):
    """Whatever the buckets, the terms are those of plain counting; with enough of them most terms are not counted one by one."""
    monkeypatch.setattr(features, "BUCKETS", buckets)
    reached, totals = [], features._totals
    monkeypatch.setattr(features, "_totals", lambda counts: reached.append(counts.select("term").distinct().count()) or totals(counts))
    words = [f"often{i % 40}" for i in range(4000)] + [f"rare{i}" for i in range(900)] + ["twice", "twice"]
    rows = [(i // 10, w) for i, w in enumerate(words)] + [(1, "often3"), (None, "often5")]
    df = spark.createDataFrame(rows, "id long, word string").groupBy("id").agg(F.collect_list("word").alias("words"))
    counts = features.term_counts(df, "id", F.col("words"))
    plain = {}
    for i, w in rows:
        plain.setdefault(w, []).append(i)
    order = sorted(plain, key=lambda w: (-len(plain[w]), w))
    for k in (12, 41, 2000):
        got = features.learn_vocabulary(counts, k).collect()
        assert sorted(((r.term, r.total, r.df) for r in got), key=lambda r: (-r[1], r[0])) == [(w, len(plain[w]), len(set(plain[w]))) for w in order[:k]]
    assert buckets == 4 or reached[0] < 700


def test_weights_keep_columns(spark):
    df = spark.createDataFrame([(1, "x", ["a", "b"]), (1, "y", ["b"])], "id long, label string, words array<string>")
    vocabulary = features.learn_vocabulary(features.term_counts(df, "id", F.col("words")), 2)
    got = features.tfidf_rows(df, "id", F.col("words"), vocabulary, df.agg(F.count("*")), 2, ["label"]).collect()
    assert sorted((r.id, r.label, r.term) for r in got) == [(1, "x", "a"), (1, "x", "b"), (1, "y", "b")]


def test_large_model_is_not_repeated_per_salt(spark, monkeypatch):
    """A model too large to be sent meets the counts by its rows once; heavy keys and the result are as with the small one."""
    fact = spark.createDataFrame([(i, f"k{i % 5 if i % 2 else i % 40}") for i in range(300)] + [(300, None), (301, "none")], "id long, key string")
    dim = spark.createDataFrame([(f"k{i}", i, 10 - i) for i in range(30)], "key string, v int, n int")
    wanted = sorted(tuple(r) for r in skew.small_join(fact, dim, ["key"], ["id"], weight="n").collect())
    monkeypatch.setattr(skew, "salted_join", None)
    got = skew.small_join(fact, dim, ["key"], ["id"], most=10, weight="n")
    assert got.columns == ["id", "key", "v"] and sorted((r.key, r.id, r.v) for r in got.collect()) == wanted
