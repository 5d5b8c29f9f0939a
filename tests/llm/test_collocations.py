import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from brute import ascii_lower
from textloom.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, n string, score string"


def expected(rows, least, longest=5, most=2000):
    """{lang: [(rank, phrase, a, l, r, n, score)]} of (text, lang) rows, counted phrase by phrase."""
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = {}
    for lang, seen in counts.items():
        found = {p: a for p, a in seen.items() if a >= least}
        inside = {
            p[i : i + k] for p, f in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * f >= 100 * found[p[i : i + k]]
        }
        best = []
        for p, a in found.items():
            if len(p) > 1 and p not in inside:
                cuts = [(1000 * a * sizes[lang] // (seen[p[:k]] * seen[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                best.append((-score, -a, " ".join(p).encode(), seen[p[:k]], seen[p[k:]]))
        best = sorted(best)[:most]
        if best:
            out[lang] = [(i, p.decode(), -a, left, right, sizes[lang], -s) for i, (s, a, p, left, right) in enumerate(best, 1)]
    return out


def got(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["lang"], r["rank"])):
        out[r["lang"]].append((r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]))
    return dict(out)


def corpus(seed=5, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "ß", "d-e", "İ", "x y", "the", "of", "zz", "q"]
    fixed = ["one two three four five six", "new york city", "A A A A", "the of the of"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 25)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(words, k=rng.randrange(1, 8))))
        text = "".join(p + rng.choice([". ", ", ", " ", "\t", "\n", "!\x0b", " ", "\x1f", "  "]) for p in parts)
        rows.append((i, text, rng.choice(["en", "en", "fr", None]), "n", "s"))
    hot = (500, "one two three four five six. " * 400, "en", "n", "s")
    return [*rows, hot, *[rows[0]] * 40, (None, None, "en", None, None), (901, "", "de", "", ""), (902, "solo " * 30, "it", "", ""), (903, " . ,", None, "", "")]


@pytest.mark.parametrize(("least", "longest", "shards"), [(20, 5, 16), (1, 3, 3)])
def test_like_brute_force(make, least, longest, shards):
    rows = corpus()
    docs = make(rows, SCHEMA)
    wanted = expected([(t, g) for _, t, g, _, _ in rows], least, longest)
    assert got(C.collocations(docs, least=least, longest=longest, shards=shards)) == wanted
    assert wanted["en"]


def test_first_of_each_language(make):
    rows = corpus(6)
    docs = make(rows, SCHEMA)
    assert got(C.collocations(docs, least=10, most=5)) == expected([(t, g) for _, t, g, _, _ in rows], 10, most=5)


def test_full_bit_table_changes_nothing(make):
    """Chance hits of a far too small table only cost rows."""
    rows = corpus(7)
    assert got(C.collocations(make(rows, SCHEMA), least=15, filter_bits=7)) == expected([(t, g) for _, t, g, _, _ in rows], 15)


def test_long_texts_are_cut_between_pieces(make, monkeypatch):
    rows = corpus(8)
    texts, of = [t.encode() for _, t, _, _, _ in rows if t], list(range(sum(bool(r[1]) for r in rows)))
    monkeypatch.setattr(C, "CHUNK", 100)
    portions = list(C._slices(texts, of))
    assert len(portions) > 50
    joined = defaultdict(bytes)
    for held, groups in portions:
        for text, group in zip(held, groups, strict=True):
            joined[group] += text
            assert joined[group] == texts[group] or text[-1:] in b".,;:!?\n\x0b\x0c\r"
    assert [joined[i] for i in of] == texts


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_windows_and_distinct_phrases():
    chunk = C.Chunk([b"x New york CITY. b", b"new york"], [0, 3], "en")
    found = {}
    for length, at, marks in chunk.windows(3, lambda length, marks, shards: np.ones(len(marks), bool)):
        places, n = chunk.distinct(at, length)
        found[length] = dict(zip(chunk.texts(places, length).to_pylist(), n.tolist(), strict=True))
        # One hash per phrase and language.
        assert len(set(marks.tolist())) == len(places)
    assert found[2] == {b"x new": 1, b"new york": 2, b"york city": 1} and found[3] == {b"x new york": 1, b"new york city": 1}
    assert found[1][b"new"] == 2 and chunk.shards.tolist() == [0, 0, 0, 0, 0, 3, 3]
    marks = C._first(chunk.hashes, chunk.seed)
    assert (C.keys_of(marks, chunk.shards).view(np.int64) < 0).all()
    assert (C.keys_of(marks, 5) & np.uint64(255) == 5).all()
