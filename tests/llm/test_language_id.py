import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest

from textloom.llm import language_id as L
from textloom.llm import queries

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, held_out string, score int"


def plain_ngrams(text):
    """The n-grams of up to four characters that lie in a word with a blank before and behind it."""
    words, word = [], ""
    for c in text.lower() + " ":
        if unicodedata.category(c)[0] in "LM":
            word += c
        elif word:
            words.append(f" {word} ")
            word = ""
    return Counter(w[i : i + n] for w in words for n in range(1, 5) for i in range(len(w) - n + 1) if w[i : i + n] != " ")


def bucket(gram):
    return np.flatnonzero(L.ngram_counts(gram))


@pytest.mark.parametrize("text", ["Hello, wörld!", "a", "ab  cd\n12 ef'g", "ÀÉ İx नमस्ते दुनिया", "x" * 50, "日本語 テキスト"])
def test_ngrams_like_brute_force(text):
    got, wanted = L.ngram_counts(text), plain_ngrams(text)
    # Blanks between words belong to two n-grams of their own each: " " + first letter, last letter + " ".
    assert got.sum() == sum(wanted.values())
    assert len(np.flatnonzero(got)) <= len(wanted) and got.max() >= max(wanted.values())


@pytest.mark.parametrize("text", [None, "", "  \n", "12 34 !?", "́"])
def test_no_letter(text):
    assert L.ngram_counts(text) is None


def test_long_texts_in_portions(monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdeé,", k=rng.randrange(1, 9))) for _ in range(2000))
    whole = L.ngram_counts(text)
    monkeypatch.setattr(L, "PORTION", 300)
    assert (L.ngram_counts(text) == whole).all()


def test_centroids_part_kinds_of_text():
    rng = np.random.default_rng(1)
    kinds = np.eye(50)[:3]
    rows = np.concatenate([k + rng.normal(0, 0.05, (30, 50)) for k in kinds]).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centres, radii = L.centroids(rows, 3)
    assert sorted(np.argmax(centres, axis=1)) == [0, 1, 2] and np.allclose(np.linalg.norm(centres, axis=1), 1, atol=1e-5)
    inside = 1 - (rows @ centres.T).max(axis=1) <= radii[np.argmax(rows @ centres.T, axis=1)]
    assert inside.all()
    same = np.repeat(rows[:1], 5, axis=0)
    assert L.centroids(same, 4)[0].shape == (1, 50)


def prose(rng, lang, n):
    vocabulary = {"en": "the and of that with which there water", "fr": "le la une des pour avec être nous", "el": "και το να είναι με για που δεν"}[lang].split()
    return " ".join(rng.choices(vocabulary, k=n))


def table(seed=4):
    rng = random.Random(seed)
    rows = [(i, prose(rng, lang, rng.randrange(5, 60)), lang, "h", 1) for i, lang in enumerate(rng.choices(["en", "fr", "el"], [6, 2, 2], k=300))]
    rows += [rows[0]] * 90
    rows += [(None, "the water and the", "en", None, None), (500, None, "en", "", 0), (501, "", "fr", "", 0), (502, "123 !!", None, "", 0)]
    return [*rows, (503, "быстрая лиса прыгает через ленивую собаку", None, "", 0), (504, prose(rng, "en", 40000), None, "", 0)]


def test_like_brute_force(make):
    rows = table()
    docs = make(rows, SCHEMA)
    model = L.fit_languages(docs, clusters=2)
    got = L.identify(docs, model).collect()
    assert sorted(set(model.langs)) == ["el", "en", "fr"]
    # Document frequencies come from all rows that are learned from.
    learned = [t for d, t, g, *_ in rows if d is not None and g and zlib.crc32(str(d).encode()) % 4 != 2]
    counted = [c for c in map(L.ngram_counts, learned) if c is not None]
    assert np.allclose(model.idf, np.log((1 + len(counted)) / (1 + np.sum([c > 0 for c in counted], axis=0))) + 1)
    texts = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        counts = L.ngram_counts(texts[r.doc_id])
        if counts is None:
            assert (r.lang, r.nearest, r.score, r.rejected) == ("und", "und", 0.0, True)
            continue
        dense = np.where(counts > 0, (1 + np.log(np.maximum(counts, 1))) * model.idf, 0)
        cosines = dense / np.linalg.norm(dense) @ model.centres
        best = int(np.argmax(cosines))
        assert r.nearest == model.langs[best] and r.score == pytest.approx(cosines[best], abs=1e-5)
        assert r.lang == ("und" if r.rejected else r.nearest)
    by_id = {r.doc_id: r for r in got}
    assert by_id[503].rejected and not by_id[504].rejected and by_id[504].nearest == "en"


def test_held_out_labels_do_not_matter(make):
    rows = table()
    changed = [(d, t, "xx" if d is not None and zlib.crc32(str(d).encode()) % 4 == 2 else g, "z", 7) for d, t, g, *_ in rows]
    one, other = (sorted(map(str, L.identify_languages(make(x, SCHEMA)).collect())) for x in (rows, changed))
    assert one == other


def test_accuracy_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = [r for r in queries.QUERIES["op12_centroid_language"](spark, SF).collect() if r.held_out]
    assert len(got) > 200 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.97 * len(got)
    assert sum(r.rejected for r in got) <= 0.1 * len(got)


def test_nothing_to_learn_from(spark, make):
    assert L.identify_languages(spark.createDataFrame([], SCHEMA)).collect() == []
    got = L.identify_languages(make([(1, "some words", None, "", 0)], SCHEMA)).collect()
    assert [(r.nearest, r.score, r.rejected) for r in got] == [("und", 0.0, True)]
