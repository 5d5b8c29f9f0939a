import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, row string, low long"


def expected(rows, every=100, positives=5, negatives=10, low=30, high=90):
    """Rows (vec_id, vector, label) with one row per id; every pair is scored."""
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], g) for i, v, g in rows if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor, a, label in good:
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b, strict=False)), i, g) for i, b, g in good if i != anchor]
        for s, positive, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            window = sorted(x for x in scored if x[2] != label and -low * s <= -100 * x[0] <= -high * s)
            out += [(anchor, positive, rank, i, -s, -t) for rank, (t, i, _) in enumerate(window[:negatives], 1)]
    return sorted(out)


def got(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def table(seed=1, n=600, width=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.4, (labels, width))
    label = rng.integers(0, labels, n)
    values = (centres[label] + rng.normal(0, 0.3, (n, width))).astype(np.float32)
    # A third of the rows are one vector, under all labels; others tie in a few values.
    values[: n // 3] = values[0]
    values[n // 3 : n // 2] = np.round(values[n // 3 : n // 2])
    return [(int(i), [float(x) for x in v], int(g)) for i, v, g in zip(rng.permutation(n * 3)[:n], values, label, strict=True)]


def odd():
    return [(None, [0.5] * 12, 1), (10_000, None, 1), (10_001, [0.5] * 12, None), (10_002, [0.5] * 11 + [None], 1), (10_100, [float("nan")] * 12, 1), (10_200, [float("inf")] + [1.0] * 11, 2), (None, None, None)]


@pytest.mark.parametrize("tile", [16, H.TILE])
def test_like_brute_force(make, tile):
    rows = [*table(), *odd()]
    docs = make([(*r, "x", 1) for r in rows], SCHEMA)
    wanted = expected(rows, 20)
    assert got(H.hard_negatives(docs, F.col("vec_id") % 20 == 0, tile=tile)) == wanted and len(wanted) > 200


def test_shorter_vectors_and_few_rows(make):
    rows = [(0, [1.0, 1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.7], 2), (3, [0.5, 0.5, 0.5], 2), (4, [], 2), (100, [], 3), (7, [-1.0, 0.25], 2)]
    assert got(H.hard_negatives(make([(*r, "", 0) for r in rows], SCHEMA), F.col("vec_id") % 100 == 0)) == expected(rows)


def test_repeated_ids_count_once(make):
    rows = table(3, 120)
    again = [*rows, *rows[:40], *[rows[5]] * 30, *[(i, [9.0, *v[1:]], 99) for i, v, _ in rows[:10]]]
    assert got(H.hard_negatives(make([(*r, "", 0) for r in again], SCHEMA), F.col("vec_id") % 10 == 0, tile=32)) == expected(rows, 10)


def test_empty_tables(spark, make):
    assert H.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).collect() == []
    rows = [(i + 1, [1.0], 0, "", 0) for i in range(9)]
    assert H.hard_negatives(make(rows, SCHEMA), F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("largest", [3, 256, 1 << 20, 1 << 27])
def test_tile_search_like_brute_force(largest):
    rng = np.random.default_rng(largest)
    rows = rng.integers(-largest, largest + 1, (3000, 6))
    rows = rows[H.str_order(rows, H.LEAF)].astype(np.int32)
    ids, labels = rng.permutation(9000)[:3000].astype(np.int64), rng.integers(0, 3, 3000)
    anchors = rng.integers(-largest, largest + 1, (40, 6))
    scores = anchors @ rows.astype(np.int64).T
    low, high = np.quantile(scores, 0.4, axis=1).astype(np.int64), np.quantile(scores, 0.9, axis=1).astype(np.int64)
    low[:10], high[:10] = H.LOWEST, H.HIGHEST
    floor = np.full(40, H.LOWEST)
    floor[::3] = np.quantile(scores, 0.5, axis=1).astype(np.int64)[::3]
    asked = H.Requests(anchors, ids[:40], np.arange(40) % 3, np.arange(40) % 2 == 0, low, high, floor)
    request, of, score = H.search_tile(asked, ids, labels, rows, 10)
    for i in range(40):
        fits = ((labels == i % 3) == (i % 2 == 0)) & (ids != ids[i]) & (scores[i] >= max(low[i], floor[i])) & (scores[i] <= high[i])
        wanted = sorted(zip(-scores[i][fits], ids[fits], strict=True))[:10]
        assert [(-s, d) for s, d in zip(score[request == i], of[request == i], strict=True)] == wanted


def test_boxes_bound_all_scores():
    rng = np.random.default_rng(0)
    rows, anchors = rng.integers(-50, 50, (500, 8)), rng.integers(-50, 50, (20, 8))
    least, most = H.bounds(anchors, *H.boxes(rows, 64))
    scores = anchors @ rows.T
    for k in range(0, 500, 64):
        part = scores[:, k : k + 64]
        assert (least[:, k // 64] <= part.min(axis=1)).all() and (most[:, k // 64] >= part.max(axis=1)).all()


def test_packing_is_a_permutation_with_smaller_boxes():
    rows = np.random.default_rng(5).integers(-256, 256, (4096, 4))
    order = H.str_order(rows, 64)
    assert sorted(order) == list(range(4096))
    size = lambda x: float(np.prod(np.subtract(*reversed(H.boxes(x, 64))).astype(float), axis=1).mean())
    assert size(rows[order]) < size(rows) / 20


def test_far_boxes_stay_closed():
    """Of well separated groups only the near ones are opened."""
    centres = np.array([[100, 0], [-100, 0], [0, 100], [0, -100]])
    rows = np.repeat(centres, 1024, axis=0) + np.random.default_rng(2).integers(-5, 6, (4096, 2))
    least, most = H.bounds(np.array([[10, 0]]), *H.boxes(rows, 1024))
    assert most[0].argmax() == 0 and (most[0][1:] < least[0][0]).all()
