import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from textloom.llm import packing
from textloom.llm.common import stored
from textloom.llm.tokens import TextEncoder, path_of

WORD = "word_bpe_49k.json"


def test_best_fit_takes_the_tightest_bin():
    bins, fills = [], []
    packing.best_fit([0, 1, 2, 3, 4], [6, 5, 4, 3, 1], 10, bins, fills)
    assert bins == [[0, 2], [1, 3, 4]] and fills == [10, 9]


def optimum(sizes, capacity):
    """Fewest bins by search over placements of the longest item first."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= sizes[i]}.values():
            place(i + 1, [*rooms[:j], rooms[j] - sizes[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(12))
def test_evolved_packings_are_valid_and_few(seed):
    rng = random.Random(seed)
    sizes = sorted([rng.randrange(1, 60) for _ in range(rng.randrange(1, 13))], reverse=True)
    population = packing.evolve(packing.first_population(sizes, 60, 4, rng), sizes, 60, 200, rng)
    for bins in population:
        assert np.bincount(bins, weights=sizes).max() <= 60
    assert len(set(population[0].tolist())) == optimum(sizes, 60)


def test_search_beats_plain_best_fit():
    """Twelve bins are enough for each of these; best fit by falling size needs 13, and the search finds 12 for some."""
    better = 0
    for seed in range(25):
        rng = random.Random(seed)
        sizes = []
        for _ in range(12):
            a = rng.randrange(10, 80)
            b = rng.randrange(5, 100 - a - 4)
            sizes += [a, b, 100 - a - b]
        sizes.sort(reverse=True)
        plain = packing.first_population(sizes, 100, 1, rng)[0].max() + 1
        found = packing.evolve(packing.first_population(sizes, 100, 20, rng), sizes, 100, 1500, rng)[0].max() + 1
        assert 12 <= found <= plain
        better += int(found < plain)
        if better:
            break
    assert better


def test_crossover_keeps_all_items():
    rng = random.Random(2)
    sizes = sorted([rng.randrange(1, 50) for _ in range(200)], reverse=True)
    a, b = packing.first_population(sizes, 64, 2, rng)
    for share in (0.1, 0.5, 1.0):
        child = packing.crossover(a, b, sizes, 64, share, rng)
        assert len(child) == 200 and child.min() == 0 and set(child) == set(range(child.max() + 1))
        assert np.bincount(child, weights=sizes).max() <= 64


def check_sequences(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents_like_brute_force(make):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices("red green blue idea Thing, don't".split(), k=rng.choice([0, 3, 20, 70, 200])))) for i in range(80)]
    rows += [(200, None), (None, "no id"), (5, rows[5][1]), (5, rows[5][1])]
    docs = make([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, length int, uid string")
    got = packing.packed_documents(docs, path_of(WORD), 1, capacity=50).collect()
    library = TextEncoder(path_of(WORD)).tokenizer
    expected = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for i, at in enumerate(range(0, len(ids), 50)):
            part = np.array(ids[at : at + 50], "<u4")
            expected.append((-1 if doc is None else doc, i, at, len(part), zlib.crc32(part.tobytes())))
    key = [(-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]
    assert sorted(key) == sorted(expected)
    n = check_sequences(got, 50)
    assert n <= 1.02 * sum(e[3] for e in expected) / 50 + 1


def test_levels(make):
    """Many small blocks: what they leave is dealt anew."""
    rng = random.Random(3)
    pieces = stored(make([(i, rng.randrange(1, 100)) for i in range(600)], "uid long, length long"), "test-pieces")
    rows = pieces.join(packing.pack(pieces, 100, block=40), "uid").collect()
    whole = pieces.join(packing.pack(pieces, 100), "uid").collect()
    assert len(rows) == len(whole) == 600
    assert check_sequences(rows, 100) <= check_sequences(whole, 100) * 1.08


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed_documents(docs, path_of(WORD), 1).collect() == []
