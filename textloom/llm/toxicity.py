"""A toxicity classifier that is regularised with counterfactual texts.

Texts that hold an identity term get copies in which the term is replaced by the others of its group; the loss punishes any
difference of score between a text and its copies. So a group's name alone moves the score as little as the labels allow, and
neutral mentions aren't flagged. The model is a logistic regression on the presence of words and word beginnings.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import stored

# Labelled rows per label that the model is fitted on at most, chosen by a hash of the id among all labelled rows.
MOST_ROWS = 4000
# Features that the model keeps at most.
MOST_FEATURES = 20_000
# A feature counts if it is in this many fitted texts, and its share differs between the labels by so many standard errors.
LEAST_TEXTS, LEAST_DEVIATION = 4, 3.5
# Lengths in bytes of word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
# Strengths of the weight penalty (per weight) and of the penalty on counterfactual differences (per text).
RIDGE, FAIRNESS = 3e-5, 1.0
FOLDS = 5
# Bytes that part words: every ASCII character that is no letter.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

# Default identity terms, in groups whose members may stand for each other. A parameter: other lists serve other corpora.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "nonbinary", "transgender"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("disabled", "deaf", "blind", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("femmes", "hommes", "filles", "garçons"),
    ("chrétiens", "musulmans", "juifs", "bouddhistes", "athées"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("christen", "muslime", "juden", "buddhisten", "atheisten"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("cristianos", "musulmanes", "judíos", "budistas", "ateos"),
)


def words_in(text: str | None) -> set[bytes]:
    """Distinct words of a whole text: lower case, runs of letters and of characters beyond ASCII."""
    return set((text or "").lower().encode().translate(LETTERS).split())


def features_of(words: set[bytes]) -> set[bytes]:
    """Whole words, and beginnings marked by a trailing star."""
    found = set(words)
    for n in BEGINNINGS:
        found.update([w[:n] + b"*" for w in words if len(w) >= n])
    return found


def counterfactuals(words: set[bytes], groups: Sequence[Sequence[str]] = IDENTITY_GROUPS) -> list[set[bytes]]:
    """Copies of a text's words in which one identity term is replaced by another one of its group."""
    copies = []
    for group in groups:
        terms = [t.encode() for t in group]
        for term in words.intersection(terms):
            copies += [(words - {term}) | {other} for other in terms if other != term]
    return copies


@dataclass
class Model:
    bias: float
    weights: dict[bytes, float] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        known = features_of(words_in(text)) & self.weights.keys()
        # Sorted, so that a score does not depend on the order of a set.
        return _sigmoid(self.bias + math.fsum(self.weights[f] for f in known))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def _deviation(a: Column, b: Column, n: tuple[int, int]) -> Column:
    """By how many standard errors a feature's share differs between ``a`` of n[0] and ``b`` of n[1] texts."""
    share = (a + b + 1) / F.lit(float(sum(n) + 2))
    return F.abs(b / F.lit(float(n[1])) - a / F.lit(float(n[0]))) / F.sqrt(share * (1 - share) * F.lit(1 / n[0] + 1 / n[1]))


def select_features(counts: DataFrame, n: tuple[int, int], most: int = MOST_FEATURES) -> list[bytes]:
    """From (``feature``, ``label``, ``n``) the features whose share of the n[0] and n[1] texts differs clearly, the clearest first."""
    if not all(n):
        return []
    each = [F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).cast("double").alias(f"n{v}") for v in (0, 1)]
    sums = counts.groupBy("feature").agg(*each).filter(F.col("n0") + F.col("n1") >= LEAST_TEXTS)
    ranked = sums.withColumn("deviation", _deviation(F.col("n0"), F.col("n1"), n)).filter(F.col("deviation") >= LEAST_DEVIATION)
    return [bytes(r["feature"]) for r in ranked.orderBy(F.desc("deviation"), "feature").limit(most).select("feature").collect()]


def feature_counts(words: Iterator[tuple[int, set[bytes]]]) -> Counter:
    """How many texts of each label have each feature."""
    seen: Counter = Counter()
    for label, bag in words:
        seen.update([(f, label) for f in features_of(bag)])
    return seen


def encode_text(words: set[bytes], number: Mapping[bytes, int], groups: Sequence[Sequence[str]]) -> tuple[list[int], list[tuple[list[int], list[int]]]]:
    """Feature numbers of a text, and for each counterfactual copy the features that it loses and gains."""
    bag = features_of(words)
    changes = []
    for copy in counterfactuals(words, groups):
        other = features_of(copy)
        lost, gained = (sorted(number[f] for f in part & number.keys()) for part in (bag - other, other - bag))
        if lost or gained:
            changes.append((lost, gained))
    return sorted(number[f] for f in bag & number.keys()), changes


class _Matrix:
    """Rows of distinct feature numbers; products with it and with its transpose."""

    def __init__(self, rows: Sequence[Sequence[int]], columns: int, values: Sequence[Sequence[float]] | None = None):
        self.n, self.columns = len(rows), columns
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.col = np.array([c for r in rows for c in r], np.int64)
        self.val = np.array([v for r in values for v in r]) if values is not None else np.ones(len(self.col))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.val * w[self.col], minlength=self.n)

    def transposed(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=self.val * x[self.row], minlength=self.columns)


def minimise(loss, start: np.ndarray, steps: int = 300, memory: int = 10, tolerance: float = 1e-6) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving; ``loss`` gives value and gradient."""
    x = start
    value, gradient = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(gradient).max(initial=0.0) < tolerance:
            break
        direction, scales = -gradient, []
        for s, y in reversed(pairs):
            a = s @ direction / (s @ y)
            scales.append(a)
            direction = direction - a * y
        if pairs:
            s, y = pairs[-1]
            direction = direction * (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(scales), strict=True):
            direction = direction + s * (a - y @ direction / (s @ y))
        slope, rate = gradient @ direction, 1.0
        while rate > 1e-10:
            there, after = loss(x + rate * direction)
            if there <= value + 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, y = rate * direction, after - gradient
        if s @ y > 1e-12:
            pairs = [*pairs[-memory + 1 :], (s, y)]
        x, value, gradient = x + s, there, after
    return x


def fit(
    rows: Sequence[Sequence[int]],
    changes: Sequence[tuple[Sequence[int], Sequence[int]]],
    labels: Sequence[int],
    features: Sequence[bytes],
    priors: tuple[float, float] | None = None,
    fairness: float = FAIRNESS,
    ridge: float = RIDGE,
) -> Model:
    """Fit on feature numbers per text and the features that counterfactual copies lose and gain.

    ``priors``: how many texts of label 0 and 1 there are, if the given ones are a sample per label.
    Loss: mean log-loss + ``ridge`` * |w|^2 + ``fairness`` * mean over counterfactual pairs of (w . (x - x'))^2. Without
    texts of both labels there is no weight, and the score is 1 if only label 1 is there and 0 otherwise.
    """
    n = (labels.count(0), labels.count(1))
    total = priors or n
    if not all(n):
        return Model(30.0 if n[1] else -30.0)
    x, y = _Matrix(rows, len(features)), np.asarray(labels, float)
    d = _Matrix([[*lost, *gained] for lost, gained in changes], len(features), [[1.0] * len(lost) + [-1.0] * len(gained) for lost, gained in changes])
    pairs = max(1, len(changes))

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = p[:-1], p[-1]
        z = x.dot(w) + b
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        value = np.mean(np.logaddexp(0, z) - y * z) + ridge * (w @ w)
        gradient = x.transposed(error) / len(y) + 2 * ridge * w
        if changes:
            moved = d.dot(w)
            value += fairness * (moved @ moved) / pairs
            gradient = gradient + 2 * fairness * d.transposed(moved) / pairs
        return float(value), np.append(gradient, error.mean())

    p = minimise(loss, np.zeros(len(features) + 1))
    # The sample holds the labels in other shares than the corpus does.
    shift = math.log(total[1] / n[1]) - math.log(total[0] / n[0])
    weights = {f: float(w) for f, w in zip(features, p[:-1], strict=True) if abs(w) > 1e-6}
    return Model(float(p[-1]) + shift, weights)


def held_out(id_column: str = "doc_id", folds: int = FOLDS) -> Column:
    """Whether a row is kept from fitting: crc32 of the id as text, modulo ``folds``, is 0. A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit_labelled(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    most: int = MOST_ROWS, fairness: float = FAIRNESS, groups: Sequence[Sequence[str]] = IDENTITY_GROUPS,
) -> Model:
    """Fit on the labelled rows that are not held out.

    At most ``most`` rows per label are used, those with the smallest hash of their id, so the sample is the same on every run and spread over
    the whole table; label shares come from all rows. Labels other than 0 and 1 and ids without a document do not count.
    Tasks count features and number them; the driver gets the chosen features and, per sampled text, their numbers.
    """
    usable = labels.select(F.col(id_column).cast("long").alias("_id"), F.col(label_column).cast("int").alias("_label"))
    usable = usable.filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id"))
    counted = {r["_label"]: r["n"] for r in usable.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("_id")
    sampled = [usable.filter(F.col("_label") == v).orderBy(order, "_id").limit(most) for v in (0, 1)]
    # At most 2 * `most` rows of two numbers.
    sample = F.broadcast(sampled[0].unionByName(sampled[1]))
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text")).join(sample, "_id")
    # Of rows with one id the smallest text counts, so the bound holds for texts too.
    rows = stored(rows.groupBy("_id", "_label").agg(F.min("_text").alias("_text")), "labelled-texts")
    n = [rows.filter(F.col("_label") == v).count() for v in (0, 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                seen = feature_counts(zip(part.column(0).to_pylist(), map(words_in, part.column(1).to_pylist()), strict=True))
                columns = [[f for f, _ in seen], [v for _, v in seen], list(seen.values())]
                kinds = [pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["feature", "label", "n"])

    chosen = select_features(rows.select("_label", "_text").mapInArrow(count, "feature binary, label int, n long"), (n[0], n[1]))
    shared = docs.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(chosen)})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints = pa.list_(pa.int32())
        change = pa.struct([("lost", ints), ("gained", ints)])
        for batch in batches:
            found = [encode_text(words_in(t.as_py()), shared.value, groups) for t in batch.column(2)]
            changes = [[{"lost": a, "gained": b} for a, b in x] for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f for f, _ in found], ints), pa.array(changes, pa.list_(change))], ["_id", "_label", "numbers", "changes"]
            )

    schema = "_id long, _label int, numbers array<int>, changes array<struct<lost:array<int>,gained:array<int>>>"
    got = sorted(rows.mapInArrow(encode, schema).collect(), key=lambda r: (r["_id"], r["_label"], r["numbers"]))
    changes = [(c["lost"], c["gained"]) for r in got for c in r["changes"]]
    return fit([r["numbers"] for r in got], changes, [r["_label"] for r in got], chosen, (counted.get(0, 0), counted.get(1, 0)), fairness)


def score_documents(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(``doc_id``, ``held_out``, ``score``, ``predicted``) per row of ``docs``, from the whole text alone.

    NULL and empty texts get the score of a text without any word; repeated rows and NULL ids stay. The model
    that tasks receive has at most ``MOST_FEATURES`` weights.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t.as_py()) for t in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.float64()), pa.array([int(s >= 0.5) for s in found], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(id_column).alias("held_out"), F.col(text_column).cast("string").alias("_text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, **options: Mapping) -> DataFrame:
    """Fit on ``labels`` and score all of ``docs``."""
    return score_documents(docs, fit_labelled(docs, labels, **options))
