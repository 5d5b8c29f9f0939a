import hashlib
import random
import re

import pytest

from brute import ascii_lower
from textloom.llm import decontaminate
from textloom.llm.common import stored

WORDS = ["a", "b", "c", "dd", "é", "x1", "ö2", "ß", "Zz", "q"]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def windows(text, size):
    found = words(text)
    if not found:
        return []
    return [tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]


def expected(docs, items, size):
    out = []
    for doc, text in docs:
        found, hit, listed = words(text), set(), set()
        for item, body in items:
            for w in windows(body, size):
                for i in range(len(found) - len(w) + 1):
                    if tuple(found[i : i + len(w)]) == w:
                        hit.update(range(i, i + len(w)))
                        if item is not None:
                            listed.add(str(item))
        joined = hashlib.sha256(",".join(sorted(listed)).encode()).hexdigest()
        out.append((-1 if doc is None else doc, len(found), len(hit), len(listed), joined, bool(hit)))
    return sorted(out)


def near_expected(docs, items, size, stretch):
    out = {}
    for doc, text in docs:
        found = words(text)
        runs = [set(found[i : i + stretch]) for i in range(max(1, len(found) - stretch + 1))]
        out[doc] = sorted({str(i) for i, body in items for w in windows(body, size) for r in runs if i is not None and set(w) <= r})
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(0, 9)))) for i in range(12)]
    items += [(90, None), (91, "!!"), (3, "dd é x1"), (None, "q q"), (5, items[4][1]), (17, "solo")]
    docs = [(i, "".join(w + rng.choice([" ", ", ", "\n", "-"]) for w in rng.choices(WORDS, k=rng.randrange(0, 40)))) for i in range(n)]
    docs += [(100, None), (101, ""), (102, "a"), (None, "dd É x1 q q"), (7, docs[7][1]), (103, " ".join(WORDS * 400)), (104, "xsolo solo.")]
    return docs, items


@pytest.mark.parametrize(("size", "segment", "block"), [(4, 1 << 20, 1 << 22), (4, 50, 30), (10, 1, 1)])
def test_like_brute_force(make, size, segment, block):
    docs, items = corpus(size)
    table = make([(d, t, "w", 1) for d, t in docs], "doc_id long, text string, n_words string, spans int")
    index = stored(decontaminate.build_index(table, segment=segment), "test-index")
    found = decontaminate.search_index(index, make(items, "item_id long, text string"), window=size, block_bytes=block)
    got = [(-1 if r[0] is None else r[0], *r[1:]) for r in decontaminate.digest(found).collect()]
    assert sorted(got) == expected(docs, items, size)


@pytest.mark.parametrize("stretch", [4, 7])
def test_proximity(make, stretch):
    docs, items = corpus(1, 30)
    docs = [d for d in docs if d[0] is not None and d[0] != 7]
    index = stored(decontaminate.build_index(make(docs, "doc_id long, text string"), segment=300), "test-index")
    found = decontaminate.search_index(index, make(items, "item_id long, text string"), window=4, near=stretch)
    assert {r.doc_id: sorted(r.near_items) for r in found.collect()} == near_expected(docs, items, 4, stretch)


def test_spans_do_not_cross_documents(make):
    docs = make([(1, "one two"), (2, "three four one two three four")], "doc_id long, text string", 1)
    found = decontaminate.contamination(docs, make([(1, "one two three")], "item_id long, text string"), window=3).collect()
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in found} == {1: [], 2: [(2, 5)]}


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = make([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(none, items).collect() == []
    docs = make([(1, "a b"), (2, None)], "doc_id long, text string")
    got = decontaminate.digest(decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string"))).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got) == [(1, 2, 0, False), (2, 0, 0, False)]


def test_without_contaminated(make):
    docs = make([(1, "z a b y", "k"), (2, "a c b", "k"), (None, "a b", "k"), (2, "a c b", "k"), (3, None, "k")], "doc_id long, text string, _row_id2 string")
    kept = decontaminate.without_contaminated(docs, make([(1, "A b")], "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 2, 3] and kept.columns == docs.columns
