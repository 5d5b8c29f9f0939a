"""Language identification by the nearest of several centroids per language.

A text is the vector of its character n-grams, hashed to a fixed number of dimensions, weighted by TF-IDF and scaled to length one. Each
language has a few centroids, found by spherical k-means among a bounded sample of its texts, because one language holds several kinds of text.
The centroid with the largest cosine decides. Every centroid has a radius, the distance within which nearly all of its texts lie;
a text beyond the radius of its nearest centroid is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import sized_join, stored

# Dimensions of the vectors, lengths of n-grams (within a word and the blanks around it).
DIMENSIONS, LONGEST = 1 << 14, 4
# Texts per language that centroids are fitted on, at most; centroids per language; rounds of k-means.
MOST_ROWS, CLUSTERS, ROUNDS = 1000, 4, 12
# Share of a centroid's texts within its radius, and how much wider the radius is taken.
WITHIN, WIDER = 0.99, 1.1
# Languages that one model may hold: 256 KB each.
MOST_LANGUAGES = 1000
# Code points of a text that are turned into n-grams at once.
PORTION = 1 << 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Per code point: 2 for letters, 1 for marks that belong to a word, 0 for what separates words."""
    import unicodedata

    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def _portions(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PORTION:
        # A line end or blank separates words, so no n-gram crosses the cut.
        end = max(text.rfind(" ", at, at + PORTION), text.rfind("\n", at, at + PORTION))
        end = at + PORTION if end <= at else end
        yield text[at:end]
        at = end
    yield text[at:]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """How often each hashed n-gram occurs in the whole text, lower-cased; None for a text without a letter."""
    total, letters = np.zeros(DIMENSIONS, np.int64), False
    for part in _portions(text or ""):
        points = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _kinds()[points]
        letters = letters or bool((kind == 2).any())
        points = np.where(kind > 0, points, np.uint32(32))
        blank = kind == 0
        # One blank before, between and after words.
        keep = np.ones(len(points), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        points, blank = points[keep], blank[keep]
        edge = np.array([32], np.uint32)
        if not len(points) or blank.all():
            continue
        if not blank[0]:
            points, blank = np.concatenate([edge, points]), np.concatenate([[True], blank])
        if not blank[-1]:
            points, blank = np.concatenate([points, edge]), np.concatenate([blank, [True]])
        marks, valid = points * np.uint32(0x9E3779B1), ~blank
        spread = (DIMENSIONS - 1).bit_length()
        for n in range(1, LONGEST + 1):
            if n > 1:
                marks = (marks[:-1] ^ (marks[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + points[n - 1 :] * np.uint32(0xC2B2AE3D)
                # Blanks stand at the ends of an n-gram only.
                valid = np.ones(len(marks), bool) if n == 2 else valid[:-1] & ~blank[n - 2 : -1]
            found = (marks[valid] ^ (marks[valid] >> np.uint32(13))) * np.uint32(0x27D4EB2F)
            total += np.bincount(found >> np.uint32(32 - spread), minlength=DIMENSIONS)
    return total if letters else None


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places and values of a text's vector, of length one (or empty)."""
    places = np.flatnonzero(counts)
    values = (1 + np.log(counts[places])) * idf[places]
    size = np.sqrt((values * values).sum())
    return places, values / size if size else values


def centroids(vectors: np.ndarray, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of spherical k-means, and their radii; starts are farthest-first from the mean, so equal input gives equal output."""
    starts = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    nearest = vectors @ vectors[starts[0]]
    while len(starts) < min(clusters, len(vectors)) and nearest.min() < 1 - 1e-6:
        starts.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[starts[-1]])
    centres = vectors[starts].copy()
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[own == k].sum(axis=0) for k in range(len(centres))])
        sizes = np.linalg.norm(sums, axis=1)
        # A centroid that lost all texts is gone.
        moved = sums[sizes > 0] / sizes[sizes > 0, None]
        if moved.shape == centres.shape and np.allclose(moved, centres, atol=1e-6):
            break
        centres = moved
    found = vectors @ centres.T
    own, best = np.argmax(found, axis=1), found.max(axis=1)
    far = [np.quantile(1 - best[own == k], WITHIN) if (own == k).any() else 0.0 for k in range(len(centres))]
    return centres, np.minimum(1, WIDER * np.maximum(np.array(far), 1e-6))


@dataclass
class Model:
    """``centres`` has a column per centroid; ``langs`` and ``radii`` belong to the columns."""

    idf: np.ndarray
    centres: np.ndarray
    langs: list[str]
    radii: np.ndarray

    def nearest(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine from 0 to 1, rejected) of a whole text; ``und``, 0 and rejected without a letter or a model."""
        counts = ngram_counts(text)
        if counts is None or not self.langs:
            return UNKNOWN, 0.0, True
        places, values = vector(counts, self.idf)
        found = values @ self.centres[places]
        best = int(np.argmax(found))
        cosine = float(min(1.0, max(0.0, found[best])))
        return self.langs[best], cosine, 1 - cosine > float(self.radii[best])


def held_out(id_column: str) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 when divided by 4. A NULL id is not held out (and never learned from)."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_languages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", most: int = MOST_ROWS, clusters: int = CLUSTERS
) -> Model:
    """Learn from the rows that are not held out and have an id and a language.

    Document frequencies come from all of them. Centroids of a language come from at most ``most`` distinct rows, drawn by the hash of id and text,
    so the sample is spread over the table and the same on every run; each language is fitted in a task of its own.
    The driver gets ``DIMENSIONS`` counts and ``clusters`` centroids per language, of at most ``MOST_LANGUAGES`` languages.
    """
    id_text = F.col(id_column).cast("string")
    usable = docs.filter(F.col(id_column).isNotNull() & F.col(lang_column).isNotNull() & ~held_out(id_column))
    usable = usable.select(id_text.alias("_id"), F.col(lang_column).cast("string").alias("_lang"), F.col(text_column).cast("string").alias("_text"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                if (counts := ngram_counts(text.as_py())) is not None:
                    seen += counts > 0
                    texts += 1
        places = np.flatnonzero(seen)
        columns = [pa.array(np.append(places, -1)), pa.array(np.append(seen[places], texts))]
        yield pa.RecordBatch.from_arrays(columns, ["place", "n"])

    counted = usable.select("_text").mapInArrow(frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    frequency = {r["place"]: r["n"] for r in counted.collect()}
    texts = frequency.pop(-1, 0)
    idf = np.full(DIMENSIONS, np.log(1 + texts) + 1)
    for place, n in frequency.items():
        idf[place] = np.log((1 + texts) / (1 + n)) + 1

    marked = usable.withColumn("_hash", F.xxhash64("_text"))
    # Rows are drawn by their hash, some more than are needed, so that no language's rows have to meet in one task.
    spread = F.xxhash64("_id", "_hash")
    sizes = marked.groupBy("_lang").agg((F.lit(1.5 * most) / F.count(F.lit(1))).alias("_share"))
    drawn = sized_join(marked.select("_lang", "_id", "_hash"), sizes, ["_lang"])
    drawn = drawn.filter(F.shiftrightunsigned(spread, 33) < F.col("_share") * F.lit(float(1 << 31)))
    order = Window.partitionBy("_lang").orderBy(spread, "_id", "_hash")
    names = drawn.groupBy("_lang", "_id", "_hash").agg(F.lit(1).alias("_one")).withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= most)
    sample = sized_join(marked, names.select("_lang", "_id", "_hash"), ["_lang", "_id", "_hash"], "left_semi")
    sample = stored(sample.groupBy("_lang", "_id", "_hash").agg(F.min("_text").alias("_text")), "sample")

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_hash", "_id"])
        rows = np.zeros((len(group), DIMENSIONS), np.float32)
        filled = 0
        for text in group["_text"]:
            if (counts := ngram_counts(text)) is not None:
                places, values = vector(counts, idf)
                rows[filled, places] = values
                filled += 1
        if not filled:
            return pd.DataFrame({"lang": [], "k": [], "radius": [], "centre": []})
        centres, radii = centroids(rows[:filled], clusters)
        return pd.DataFrame({"lang": key[0], "k": range(len(centres)), "radius": radii.astype(float), "centre": [c.astype("<f4").tobytes() for c in centres]})

    fitted = stored(sample.groupBy("_lang").applyInPandas(fit, "lang string, k int, radius double, centre binary"), "centroids")
    if (n := fitted.select("lang").distinct().count()) > MOST_LANGUAGES:
        raise ValueError(f"{n} languages; a model holds at most {MOST_LANGUAGES}")
    got = sorted(fitted.collect(), key=lambda r: (r["lang"], r["k"]))
    centres = np.stack([np.frombuffer(r["centre"], "<f4") for r in got], axis=1).copy() if got else np.zeros((DIMENSIONS, 0), np.float32)
    return Model(idf, centres, [r["lang"] for r in got], np.array([r["radius"] for r in got]))


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(``doc_id``, ``held_out``, ``lang``, ``nearest``, ``score``, ``rejected``) per row of ``docs``, from its whole text alone.

    ``nearest`` is the language of the nearest centroid and ``score`` the cosine with it; ``lang`` is ``nearest``, or ``und`` if the text is rejected.
    NULL texts and texts without a letter are ``und`` with score 0, and so are all texts if nothing was learned. Repeated rows and NULL ids stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.nearest(t.as_py()) for t in batch.column(2)]
            nearest, cosine, rejected = ([f[i] for f in found] for i in range(3))
            langs: Sequence[str] = [UNKNOWN if r else n for n, r in zip(nearest, rejected, strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(nearest, pa.string()), pa.array(cosine, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang", "nearest", "score", "rejected"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(id_column).alias("held_out"), F.col(text_column).cast("string").alias("_text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang string, nearest string, score double, rejected boolean")


def identify_languages(docs: DataFrame, **options) -> DataFrame:
    """Learn from ``docs`` and identify all of it."""
    return identify(docs, fit_languages(docs, **options))
