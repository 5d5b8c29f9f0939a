"""Benchmark decontamination with a distributed positional inverted index.

The training documents are indexed once, in segments of bounded size: a segment's row holds its terms and, term
by term, the sorted positions of every occurrence. Benchmark texts are searched in blocks of bounded size against all segments.
A search starts from the list of a window's rarest term, shifts it by the term's place in the window, and
intersects it with the shifted lists of the other terms, rarer terms first.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import stored, without_rows

# Words per segment (a longer document is a segment of its own); UTF-8 bytes of benchmark text per search block.
SEGMENT, BLOCK_BYTES = 1 << 20, 1 << 22
# Candidates that are intersected at a time.
CANDIDATES = 1 << 21
# A-Z become a-z; every other ASCII character outside of 0-9 and a-z parts words. Bytes from 128 on belong to words.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
INDEX = "segment long, doc_ids binary, no_id binary, text_hashes binary, n_words binary, terms binary, sizes binary, positions binary"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def _segment(number: int, docs: list[tuple[int | None, int, list[bytes]]]) -> dict:
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    lengths = np.array([len(w) for _, _, w in docs], np.int64)
    ids = np.empty(int(lengths.sum()), np.int32)
    at = 0
    for _, _, words in docs:
        ids[at : at + len(words)] = list(map(known.__getitem__, words))
        at += len(words)
    # One free position after each document, so that no phrase runs on into the next.
    places = np.arange(len(ids)) + np.repeat(np.arange(len(docs)), lengths)
    order = np.argsort(ids, kind="stable")
    return {
        "segment": number,
        "doc_ids": np.array([d or 0 for d, _, _ in docs], "<i8").tobytes(),
        "no_id": bytes(d is None for d, _, _ in docs),
        "text_hashes": np.array([h for _, h, _ in docs], "<i8").tobytes(),
        "n_words": lengths.astype("<i8").tobytes(),
        "terms": b"\n".join(known),
        "sizes": np.bincount(ids, minlength=len(known)).astype("<i8").tobytes(),
        "positions": places[order].astype("<i4").tobytes(),
    }


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", segment: int = SEGMENT) -> DataFrame:
    """Positional postings of all words of all documents, one row per segment; store it before searching.

    NULL texts have no word; every row, repeated ones included, is a document of its own; other columns are not read.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, words = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for doc_id, text_hash, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True
            ):
                found = words_of(text.as_py())
                if held and words + len(found) + len(held) > segment:
                    yield pa.RecordBatch.from_pylist([_segment(number, held)], _SCHEMA)
                    number, held, words = number + 1, [], 0
                held.append((doc_id, text_hash, found))
                words += len(found)
        if held:
            yield pa.RecordBatch.from_pylist([_segment(number, held)], _SCHEMA)

    text = F.col(text_column).cast("binary")
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    return rows.mapInArrow(build, INDEX)


_SCHEMA = pa.schema([(c.split()[0], {"long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in INDEX.split(", ")])


class Queries:
    """The distinct windows of a block of benchmark texts, and the items that hold each."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        vocabulary: defaultdict[bytes, int] = defaultdict(count().__next__)
        parts, owners = [], []
        self.names = sorted({name for name, _ in items if name is not None})
        number = {name: i for i, name in enumerate(self.names)}
        for name, text in items:
            ids = np.array([vocabulary[w] for w in words_of(text)], np.int32)
            if not len(ids):
                continue
            if len(ids) < window:
                found = np.full((1, window), -1, np.int32)
                found[0, : len(ids)] = ids
            else:
                found = sliding_window_view(ids, window)
            parts.append(found)
            owners.append(np.full(len(found), number.get(name, -1)))
        self.terms = list(vocabulary)
        if parts:
            self.windows, inverse = np.unique(np.concatenate(parts), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([inverse.ravel(), np.concatenate(owners)], axis=1), axis=0)
        else:
            self.windows, pairs = np.empty((0, window), np.int32), np.empty((0, 2), np.int64)
        self.lengths = (self.windows >= 0).sum(axis=1)
        # An item without a name counts as a hit, but is not listed.
        pairs = pairs[pairs[:, 1] >= 0]
        self.item_of = pairs[:, 1]
        self.item_at = np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))


class SegmentSearch:
    """Evaluates a block of queries on one segment."""

    def __init__(self, row: dict, queries: Queries):
        self.queries = queries
        self.n_words = np.frombuffer(row["n_words"], "<i8")
        self.starts = np.concatenate([[0], np.cumsum(self.n_words + 1)])
        self.span = int(self.starts[-1]) + queries.windows.shape[1] + 1
        sizes = np.frombuffer(row["sizes"], "<i8")
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        positions = np.frombuffer(row["positions"], "<i4")
        known = dict(zip(row["terms"].split(b"\n"), range(len(sizes)), strict=False)) if len(sizes) else {}
        local = [known.get(t, -1) for t in queries.terms]
        self.lists = [positions[bounds[i] : bounds[i + 1]] if i >= 0 else positions[:0] for i in local]
        self.sizes = np.array([len(x) for x in self.lists], np.int64)
        # All postings of the block's terms in one sorted array: term * span + position.
        joined = np.concatenate([np.empty(0, np.int64), *[x.astype(np.int64) + i * self.span for i, x in enumerate(self.lists) if len(x)]])
        self.postings = np.append(joined, np.iinfo(np.int64).max)

    def _rarest_first(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Chunks of (window, place of each word by rising list length, occurrence of the rarest word)."""
        windows = self.queries.windows
        padded = np.append(self.sizes, np.iinfo(np.int64).max)[windows]
        alive = np.flatnonzero((padded > 0).all(axis=1))
        if not len(alive):
            return
        order = np.argsort(padded[alive], axis=1, kind="stable")
        first = windows[alive, order[:, 0]]
        loads = np.cumsum(self.sizes[first])
        at = 0
        while at < len(alive):
            end = max(at + 1, int(np.searchsorted(loads, (loads[at - 1] if at else 0) + CANDIDATES, "right")))
            rows = np.repeat(np.arange(at, end), self.sizes[first[at:end]])
            yield alive[rows], order[rows], np.concatenate([self.lists[t] for t in first[at:end]]).astype(np.int64)
            at = end

    def exact(self) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence of a window."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for window, order, at in self._rarest_first():
            start = at - order[:, 0]
            for r in range(1, order.shape[1]):
                place = order[:, r]
                term = self.queries.windows[window, place].astype(np.int64)
                wanted = term * self.span + start + place
                hit = self.postings[np.searchsorted(self.postings, wanted)] == wanted
                hit = (term < 0) | hit & (start >= 0)
                window, order, start = window[hit], order[hit], start[hit]
            # Only a window of one word reaches this point unchecked; its start is its occurrence.
            found.append((window, start))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([w for w, _ in found]), np.concatenate([s for _, s in found])

    def near(self, stretch: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (window, document) where ``stretch`` consecutive words of the document hold all words of the window."""
        pairs: set[tuple[int, int]] = set()
        for window, order, at in self._rarest_first():
            doc = np.searchsorted(self.starts, at, "right") - 1
            for r in range(1, order.shape[1]):
                term = self.queries.windows[window, order[:, r]].astype(np.int64)
                low = np.maximum(at - stretch + 1, self.starts[doc])
                high = np.minimum(at + stretch - 1, self.starts[doc + 1] - 2)
                after = self.postings[np.searchsorted(self.postings, term * self.span + low)]
                hit = (term < 0) | (after <= term * self.span + high)
                window, order, at, doc = window[hit], order[hit], at[hit], doc[hit]
            for w, p, d in zip(window.tolist(), at.tolist(), doc.tolist(), strict=True):
                if (w, d) not in pairs and self._fits(w, p, d, stretch):
                    pairs.add((w, d))
        both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def _fits(self, window: int, at: int, doc: int, stretch: int) -> bool:
        terms = {int(t) for t in self.queries.windows[window] if t >= 0}
        low, high = max(at - stretch + 1, int(self.starts[doc])), min(at + stretch - 1, int(self.starts[doc + 1]) - 2)
        places = []
        for t in terms:
            lo, hi = np.searchsorted(self.postings, [t * self.span + low, t * self.span + high + 1])
            places += [(int(p) - t * self.span, t) for p in self.postings[lo:hi]]
        places.sort()
        last: dict[int, int] = {}
        for p, t in places:
            last[t] = p
            if len(last) == len(terms) and p - min(last.values()) < stretch:
                return True
        return False

    def documents(self, window: np.ndarray, doc: np.ndarray) -> dict[int, np.ndarray]:
        """The numbers of the items with a window in each document."""
        if not len(window):
            return {}
        seen = np.unique(doc * len(self.queries.windows) + window)
        doc, window = np.divmod(seen, len(self.queries.windows))
        n = self.queries.item_at[window + 1] - self.queries.item_at[window]
        flat = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.queries.item_at[window], n)
        pairs = np.unique(np.stack([np.repeat(doc, n), self.queries.item_of[flat]], axis=1), axis=0)
        cuts = np.flatnonzero(np.diff(pairs[:, 0])) + 1
        return {int(g[0, 0]): g[:, 1] for g in np.split(pairs, cuts) if len(g)}


FOUND = (
    "segment long, place int, doc_id long, text_hash long, n_words long, spans array<struct<start:long,end:long>>, "
    "items array<string>, near_items array<string>"
)
_FOUND = pa.schema(
    [
        ("segment", pa.int64()),
        ("place", pa.int32()),
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
        ("near_items", pa.list_(pa.string())),
    ]
)


def _search(queries, near: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        for batch in batches:
            for row in batch.to_pylist():
                search = SegmentSearch(row, block)
                window, start = search.exact()
                edges = np.zeros(search.span + 1, np.int64)
                np.add.at(edges, start, 1)
                np.add.at(edges, start + block.lengths[window], -1)
                turns = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(edges) > 0]).astype(np.int8)))
                spans: dict[int, list] = {}
                owner = np.searchsorted(search.starts, turns[::2], "right") - 1
                for d, lo, hi in zip(owner.tolist(), turns[::2].tolist(), turns[1::2].tolist(), strict=True):
                    base = int(search.starts[d])
                    spans.setdefault(d, []).append({"start": lo - base, "end": hi - base})
                items = search.documents(window, np.searchsorted(search.starts, start, "right") - 1)
                close = search.documents(*search.near(near)) if near else {}
                no_id, n = row["no_id"], len(search.n_words)
                ids, hashes = np.frombuffer(row["doc_ids"], "<i8").tolist(), np.frombuffer(row["text_hashes"], "<i8").tolist()
                rows = (
                    {
                        "segment": row["segment"],
                        "place": i,
                        "doc_id": None if no_id[i] else ids[i],
                        "text_hash": hashes[i],
                        "n_words": int(search.n_words[i]),
                        "spans": spans.get(i, []),
                        "items": [block.names[x] for x in items.get(i, ())],
                        "near_items": [block.names[x] for x in close.get(i, ())],
                    }
                    for i in range(n)
                )
                while part := list(islice(rows, 4096)):
                    yield pa.RecordBatch.from_pylist(part, _FOUND)

    return run


def _item_blocks(items: DataFrame, id_column: str, text_column: str, block_bytes: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    wanted = items.select(F.col(id_column).cast("string").alias("_id"), F.col(text_column).cast("binary").alias("_text"))
    for name, text in wanted.toLocalIterator():
        held.append((name, bytes(text) if text is not None else None))
        size += len(text or b"")
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def merged_spans(spans: Column) -> Column:
    """Sorted spans in which those that overlap or touch are one."""
    empty = F.array().cast("array<struct<start:long,end:long>>")
    last = lambda done: F.element_at(done, -1)

    def add(done: Column, span: Column) -> Column:
        joined = F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], span["end"]).alias("end"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, add)


def search_index(
    index: DataFrame, items: DataFrame, id_column: str = "item_id", text_column: str = "text", window: int = 10, near: int = 0,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per indexed document: ``n_words``, the merged ``spans`` (word positions, end exclusive) of exact matches, the ``items``
    with a window in it, and with ``near`` > 0 the ``near_items``: those of which ``near`` consecutive words hold all words of a window.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. The
    items are read in blocks of about ``block_bytes``, and each block is searched in the whole index: what a task
    receives is bounded however many items there are. Items that repeat or share windows are searched once per block; items with
    NULL or empty text never match; an item with a NULL id marks words but is not listed. Without items nothing is hit.
    """
    blocks = [
        index.mapInArrow(_search(index.sparkSession.sparkContext.broadcast(Queries(block, window)), near), FOUND)
        for block in _item_blocks(items, id_column, text_column, block_bytes)
    ]
    if not blocks:
        nothing = index.sparkSession.sparkContext.broadcast(Queries([], window))
        return index.mapInArrow(_search(nothing, near), FOUND)
    if len(blocks) == 1:
        return blocks[0]
    whole = blocks[0]
    for part in blocks[1:]:
        whole = whole.unionByName(part)
    same = ["segment", "place", "doc_id", "text_hash", "n_words"]
    gather = lambda c: F.flatten(F.collect_list(c))
    return whole.groupBy(*same).agg(
        merged_spans(gather("spans")).alias("spans"),
        F.array_distinct(gather("items")).alias("items"),
        F.array_distinct(gather("near_items")).alias("near_items"),
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, near: int = 0, **columns: str) -> DataFrame:
    """Index ``docs`` in the shared folder and search ``items`` in it; see ``search_index``."""
    index = stored(build_index(docs, **columns), "postings")
    return search_index(index, items, window=window, near=near)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the op1 contract from the rows of ``search_index``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    listed = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text no window of ``items`` occurs."""
    found = contamination(docs, items, window, id_column=id_column, text_column=text_column)
    return without_rows(docs, found.filter(F.size("spans") > 0), id_column, text_column)
