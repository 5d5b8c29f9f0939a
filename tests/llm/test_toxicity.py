import math
import random
import zlib

import numpy as np
import pytest

from textloom.llm import toxicity
from textloom.llm.toxicity import Model, counterfactuals, encode_text, feature_counts, features_of, words_in

NEUTRAL = [f"n{a}{b}" for a in "abcdefgh" for b in ("ork", "illow", "ast", "um")]
INSULTS = ["stupidhead", "rotter", "vileling"]


def test_words():
    assert words_in("It's A b-c É9é x\ty") == {b"it", b"s", b"a", b"b", b"c", "é".encode(), b"x", b"y"}
    assert words_in(None) == words_in("") == words_in("12 34") == set()


def test_features():
    assert features_of({b"vileling", b"ab"}) == {b"vileling", b"vile*", b"vilel*", b"vileli*", b"ab"}


def test_counterfactuals():
    got = counterfactuals({b"women", b"are", b"here"}, [("women", "men", "girls")])
    assert sorted(map(sorted, got)) == sorted(map(sorted, [{b"men", b"are", b"here"}, {b"girls", b"are", b"here"}]))
    assert counterfactuals({b"nobody"}, [("women", "men")]) == []


def fit(spark, texts, labels, **options):
    counts = spark.createDataFrame([(f, v, n) for (f, v), n in feature_counts(zip(labels, texts, strict=True)).items()], "feature binary, label int, n long")
    chosen = toxicity.select_features(counts, (labels.count(0), labels.count(1)))
    encoded = [encode_text(t, {f: i for i, f in enumerate(chosen)}, toxicity.IDENTITY_GROUPS) for t in texts]
    return toxicity.fit([r for r, _ in encoded], [c for _, cs in encoded for c in cs], labels, chosen, **options)


def labelled(n=600, bias=0.9, seed=1):
    """Insults decide the label; one group is named mostly in toxic texts."""
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        toxic = rng.random() < 0.3
        words = set(rng.choices(NEUTRAL, k=8))
        if toxic:
            words.add(rng.choice(INSULTS))
        if rng.random() < (bias if toxic else 0.05):
            words.add("muslims")
        if rng.random() < 0.1:
            words.add("christians")
        texts.append({w.encode() for w in words})
        labels.append(int(toxic))
    return texts, labels


def test_group_mentions_move_the_score_less(spark):
    texts, labels = labelled()
    free, fair = fit(spark, texts, labels, fairness=0.0), fit(spark, texts, labels, fairness=10.0)
    neutral = " ".join(NEUTRAL[:6])

    def gap(model):
        logit = lambda s: math.log(s / (1 - s))
        return abs(logit(model.score(f"{neutral} muslims")) - logit(model.score(f"{neutral} christians")))

    assert gap(free) > 1 and gap(fair) < 0.3 * gap(free)
    assert fair.score(f"{neutral} muslims") < 0.5
    for insult in INSULTS:
        assert fair.score(f"{neutral} {insult}") > 0.5
    right = sum((fair.score(b" ".join(t).decode()) >= 0.5) == bool(y) for t, y in zip(*labelled(seed=2), strict=True))
    assert right >= 0.97 * 600


def test_beginnings_reach_unseen_words(spark):
    texts, labels = labelled(bias=0.1)
    assert fit(spark, texts, labels).score("stupidest") > 0.5


def test_gradient(spark, monkeypatch):
    """The loss that is minimised has the gradient that is used."""
    texts, labels = labelled(60)
    seen = []
    monkeypatch.setattr(toxicity, "minimise", lambda loss, start: seen.append((loss, start)) or start)
    monkeypatch.setattr(toxicity, "LEAST_DEVIATION", 0.5)
    fit(spark, texts, labels, fairness=2.0, ridge=0.01)
    loss, start = seen[0]
    x = np.random.default_rng(0).normal(size=len(start))
    _, gradient = loss(x)
    for i in range(0, len(x), 7):
        step = np.zeros(len(x))
        step[i] = 1e-6
        assert (loss(x + step)[0] - loss(x - step)[0]) / 2e-6 == pytest.approx(gradient[i], abs=1e-5)


def test_one_label_or_none():
    assert toxicity.fit([], [], [], []).score("x") < 1e-9
    assert toxicity.fit([[]], [], [0], []).score("x") < 1e-9
    assert toxicity.fit([[]], [], [1], []).score("x") > 1 - 1e-9
    assert Model(0.0).score(None) == 0.5


def corpus(n=400):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = rng.choices(NEUTRAL, k=20) + ([rng.choice(INSULTS)] if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words) + ("." if i % 2 else " filler" * 3000)))
        labels.append((i, toxic))
    return rows, labels


def test_table(make):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (None, "rotter here"), (7, rows[7][1])]
    docs = make([(d, t, 1, "x") for d, t in rows + extra], "doc_id long, text string, toxic int, score string")
    marks = make([*labels, (5000, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    got = toxicity.classify(docs, marks).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.predicted == 0 for r in got if r.doc_id in (1000, 1001))


def test_held_out_labels_do_not_matter(make):
    rows, labels = corpus(200)
    docs = make(rows, "doc_id long, text string")
    turned = [(d, 1 - y if zlib.crc32(str(d).encode()) % 5 == 0 else y) for d, y in labels]
    one, two = (toxicity.fit_labelled(docs, make(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert one == two


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.classify(none, marks).collect() == []
    assert [r.predicted for r in toxicity.classify(make([(1, "a")], "doc_id long, text string"), marks).collect()] == [0]
