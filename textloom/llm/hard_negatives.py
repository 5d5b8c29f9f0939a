"""Hard negatives by exact inner-product search in an STR-packed R-tree.

Vectors are packed by sort-tile-recursive order: cut into slabs along the coordinate of the largest variance, each slab along the next one, and so
on. The upper cuts come from a bounded sample and only decide which rows lie together; every row is indexed. Neighbouring
rows are written as tiles; a tile holds its own small tree of nodes and leaves with minimum bounding boxes.

The inner product of an anchor with any row of a box lies between two sums over coordinates, because each coordinate of the row lies in an interval.
A request visits boxes best first, by the upper end of that interval (not above its score window): the first tile gives a bound for the k-th
result, and of the others only those not strictly below it are visited. Inside a tile the nodes are visited in the same way. Boxes outside of the
request's score window are never opened.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import scratch, stored
from textloom.llm.store import open_store

# Rows of a tile, of a node in it, and of a leaf.
TILE, NODE, LEAF = 8192, 1024, 64
# Rows that the upper cuts are made from, at most about this many numbers; tiles of the directory that a task looks at together.
SAMPLE_NUMBERS, DIRECTORY = 1 << 21, 4096
# Requests that are searched in one tile by one task.
PART = 16384
# Components beyond this count as this, so that scores of up to 511 dimensions fit 64 bits.
LARGEST = 1 << 27
LOWEST, HIGHEST = -(1 << 62), 1 << 62
TILES = "tile long, ids binary, labels binary, rows binary, low binary, high binary"


@dataclass
class Cut:
    """Upper cuts of the packing: slabs along one coordinate, with what follows in each of them."""

    along: int
    at: np.ndarray
    inside: list[Cut | None]

    def assign(self, rows: np.ndarray, number: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(slab number, coordinate along which the slab is ordered) per row."""
        slab = np.searchsorted(self.at, rows[:, self.along], "right")
        # Numbers of nested slabs in sequence: a digit per level.
        found = number * 4096 + slab
        order = rows[:, self.along].copy()
        for k, cut in enumerate(self.inside):
            if cut is not None and len(here := np.flatnonzero(slab == k)):
                found[here], order[here] = cut.assign(rows[here], number * 4096 + k)
        return found, order


def str_cuts(sample: np.ndarray, slots: int, dimensions: list[int]) -> Cut | None:
    """Cuts of ``sample`` into about ``slots`` slabs of equal size, along one dimension after the other."""
    if slots <= 1 or not dimensions or len(sample) < 2:
        return None
    slabs = min(64, max(2, round(slots ** (1 / len(dimensions)))))
    values = np.sort(sample[:, dimensions[0]])
    at = np.unique(values[[len(values) * k // slabs for k in range(1, slabs)]])
    slab = np.searchsorted(at, sample[:, dimensions[0]], "right")
    return Cut(dimensions[0], at, [str_cuts(sample[slab == k], -(-slots // slabs), dimensions[1:]) for k in range(len(at) + 1)])


def str_order(rows: np.ndarray, size: int) -> np.ndarray:
    """The order of ``rows`` in which runs of ``size`` are leaves: recursive slabs, the most varied coordinates first."""
    by_spread = np.argsort(-rows.var(axis=0, dtype=np.float64), kind="stable")

    def pack(at: np.ndarray, depth: int, dims: int) -> np.ndarray:
        leaves = -(-len(at) // size)
        if leaves <= 1 or dims < 1:
            return at
        slabs = max(2, round(leaves ** (1 / dims)))
        at = at[np.argsort(rows[at, by_spread[depth]], kind="stable")]
        step = -(-leaves // slabs) * size
        return np.concatenate([pack(at[k : k + step], depth + 1, dims - 1) for k in range(0, len(at), step)])

    leaves = -(-len(rows) // size)
    return pack(np.arange(len(rows)), 0, min(rows.shape[1], max(1, leaves.bit_length() - 1)))


def boxes(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest coordinates of every run of ``size`` rows."""
    starts = np.arange(0, len(rows), size)
    return np.minimum.reduceat(rows, starts, axis=0), np.maximum.reduceat(rows, starts, axis=0)


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner products of each anchor with rows of each box, coordinate by coordinate."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def exact_kind(dimensions: int, one: np.ndarray, other: np.ndarray) -> type:
    """A number type in which sums of products of the two are exact."""
    most = dimensions * max(1, int(np.abs(one).max(initial=0))) * max(1, int(np.abs(other).max(initial=0)))
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


@dataclass
class Requests:
    """Requests to one tree: all arrays have an entry per request. ``same`` asks for rows of the same label."""

    anchors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    same: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray


def search_tile(asked: Requests, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` rows of a tile per request by (score descending, id ascending): (request, id, score) arrays.

    Rows below ``floor``, the k-th score that a request has already, may be missing; those that reach it never are.
    """
    kind = exact_kind(rows.shape[1], asked.anchors, rows)
    anchors, rows = asked.anchors.astype(kind), rows.astype(kind)
    low, high = boxes(rows, NODE)
    leaf_low, leaf_high = boxes(rows, LEAF)
    least, most = (x.astype(np.int64) for x in bounds(anchors, low, high))
    # Best first; what lies above the window counts as its end.
    reach = np.minimum(most, asked.high[:, None])
    reach[(least > asked.high[:, None]) | (most < asked.low[:, None])] = LOWEST - 1
    queue = np.argsort(-reach, axis=1, kind="stable")
    reach = np.take_along_axis(reach, queue, axis=1)
    kth = np.maximum(asked.floor, asked.low)
    best = tuple(np.zeros(0, np.int64) for _ in range(3))
    for turn in range(queue.shape[1]):
        active = np.flatnonzero(reach[:, turn] >= kth)
        if not len(active):
            break
        found = [best]
        for node in np.unique(queue[active, turn]):
            here = active[queue[active, turn] == node]
            # Leaves that no request of this node needs stay closed.
            leaves = slice(node * (NODE // LEAF), (node + 1) * (NODE // LEAF))
            leaf_least, leaf_most = bounds(anchors[here], leaf_low[leaves], leaf_high[leaves])
            needed = ((leaf_most >= kth[here, None]) & (leaf_least <= asked.high[here, None])).any(axis=0)
            inside = np.flatnonzero(np.repeat(needed, LEAF)[: min(NODE, len(rows) - node * NODE)]) + node * NODE
            if not len(inside):
                continue
            scores = (anchors[here] @ rows[inside].T).astype(np.int64)
            fits = (labels[inside][None, :] == asked.labels[here, None]) == asked.same[here, None]
            fits &= (ids[inside][None, :] != asked.ids[here, None]) & (scores >= kth[here, None]) & (scores <= asked.high[here, None])
            scores[~fits] = LOWEST - 1
            if len(inside) > k:
                fits &= scores >= np.partition(scores, len(inside) - k, axis=1)[:, len(inside) - k, None]
            request, column = np.nonzero(fits)
            found.append((here[request], ids[inside[column]], scores[request, column]))
        request, of, score = (np.concatenate([f[i] for f in found]) for i in range(3))
        order = np.lexsort((of, -score, request))
        request, of, score = request[order], of[order], score[order]
        place = np.arange(len(request)) - np.searchsorted(request, request)
        best = tuple(x[place < k] for x in (request, of, score))
        full = place == k - 1
        kth[request[full]] = np.maximum(kth[request[full]], score[full])
    return best


def usable_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", scale: float = 256.0) -> DataFrame:
    """(``vec_id``, ``label``, ``row``) of the rows that take part; ``row`` holds ``floor(scale * x)`` per component.

    Rows with a NULL id, label or vector, or with a NULL or non-finite component take no part. Of rows with one id the one with the smallest
    (label, components) does. Components beyond ``LARGEST`` count as ``LARGEST``.
    """
    bound = F.lit(float(LARGEST))

    def whole(x: Column) -> Column:
        return F.greatest(F.least(F.floor(F.least(F.greatest(x.cast("double") * F.lit(scale), -bound), bound)), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")

    def finite(x: Column) -> Column:
        value = x.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))

    of = F.col(vector_column)
    rows = vectors.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & of.isNotNull())
    rows = rows.filter(F.forall(of, finite))
    rows = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"), F.transform(of, whole).alias("row"))
    # Only ids are shuffled to find repeated ones.
    again = stored(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("vec_id"), "repeated-ids")
    if again.isEmpty():
        return rows
    once = rows.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "row")).alias("first"))
    return rows.join(again, "vec_id", "left_anti").unionByName(once.select("vec_id", "first.label", "first.row"))


class Tree:
    """The stored tiles of an R-tree, and a directory of their boxes that tasks read block by block."""

    def __init__(self, rows: DataFrame, tile: int = TILE):
        """``rows`` (``vec_id``, ``label``, ``row``); shorter vectors count as filled up with zeros. A tile holds ``tile`` rows."""
        self.spark = rows.sparkSession
        rows = stored(rows, "vectors")
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("row")).alias("width")).first()
        self.n, self.width = size["n"], max(1, size["width"] or 1)
        self.rows = rows.withColumn("row", F.concat("row", F.array_repeat(F.lit(0), F.lit(self.width) - F.size("row"))))
        tiles = -(-self.n // tile)
        shared = self.spark.sparkContext.broadcast(self._cuts(tiles))
        width = self.width

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = _matrix(batch.column(2), width)
                cut = shared.value
                slab, order = cut.assign(values) if cut else (np.zeros(len(values), np.int64), values[:, 0])
                columns = [*batch.columns, pa.array(slab.astype(np.int64)), pa.array(order.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "row", "slab", "along"])

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base, held, size = TaskContext.get().partitionId() << 32, [], 0
            for batch in batches:
                held.append(batch)
                size += batch.num_rows
                while size >= 2 * tile:
                    table = pa.Table.from_batches(held)
                    yield _tile(base, table.slice(0, tile), width)
                    base, held, size = base + 1, table.slice(tile).to_batches(), size - tile
            if size:
                table = pa.Table.from_batches(held)
                for at in range(0, size, tile):
                    yield _tile(base, table.slice(at, tile), width)
                    base += 1

        marked = self.rows.mapInArrow(assign, "vec_id long, label long, row array<int>, slab long, along int")
        # Equal vectors are told apart by the id's hash, so no value makes a large partition.
        order = ["slab", "along", F.xxhash64("vec_id")]
        packed = marked.repartitionByRange(max(1, -(-tiles // 4)), *order).sortWithinPartitions(*order)
        self.tiles = stored(packed.select("vec_id", "label", "row").mapInArrow(build, TILES), "tiles")
        self.folder = scratch(self.spark, "directory")
        self.tiles.select("tile", "low", "high").coalesce(max(1, tiles // 100_000)).write.parquet(self.folder)

    def _cuts(self, tiles: int) -> Cut | None:
        wanted = SAMPLE_NUMBERS // self.width
        every = max(1, self.n // max(1, wanted))
        sample = self.rows.filter(F.pmod(F.xxhash64(F.col("vec_id"), F.lit(7)), F.lit(every)) == 0).orderBy("vec_id").select("row")
        values = _matrix(sample.toArrow().column("row").combine_chunks(), self.width)
        by_spread = np.argsort(-values.var(axis=0, dtype=np.float64), kind="stable") if len(values) else np.zeros(0, int)
        # A slab should hold some sampled rows; what it holds beyond a tile is ordered along its last coordinate.
        slots = min(tiles, max(1, len(values) // 32))
        levels = min(self.width, max(1, slots.bit_length() - 1), 5)
        return str_cuts(values, slots, by_spread[:levels].tolist())

    def search(self, requests: DataFrame, k: int) -> DataFrame:
        """(``anchor_id``, ``request``, ``vec_id``, ``score``): the first ``k`` rows per request, exactly.

        ``requests``: ``anchor_id``, ``request`` (a number of the request among those of its anchor), ``label``, ``row``, ``same``, ``low`` and ``high`` (the score window, inclusive).
        """
        requests = stored(requests.withColumn("floor", F.lit(LOWEST)), "requests")
        part = max(1, -(-requests.count() // PART))
        first = self._visit(self._route(requests.withColumn("seen", F.lit(-1).cast("long")), True), k, part, "first-tiles")
        key = ["anchor_id", "request"]
        kth = first.filter("vec_id is not null").groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        seen = first.filter("vec_id is null").select(*key, F.col("tile").alias("seen"))
        floors = requests.drop("floor").join(seen, key).join(kth, key, "left")
        floors = floors.withColumn("floor", F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(LOWEST)))
        rest = self._visit(self._route(floors.select(*requests.columns, "seen"), False), k, part, "other-tiles")
        found = first.unionByName(rest).filter("vec_id is not null").select(*key, "vec_id", "score")
        order = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def _route(self, requests: DataFrame, only_best: bool) -> DataFrame:
        """Requests with the tiles that they visit: the best one, or all others that may hold results."""
        folder, width = self.folder, self.width

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 2048):
                    yield from routed(batch.slice(at, 2048))

        def routed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            names = batch.schema.names
            anchors = _matrix(batch.column(names.index("row")), width)
            low, high, floor, seen = (batch.column(names.index(c)).to_numpy() for c in ("low", "high", "floor", "seen"))
            best, best_tile = np.full(len(anchors), LOWEST - 1), np.full(len(anchors), -1)
            for tile, box_low, box_high in _directory(folder, width):
                kind = exact_kind(width, anchors, np.maximum(np.abs(box_low), np.abs(box_high)))
                least, most = (x.astype(np.int64) for x in bounds(anchors.astype(kind), box_low.astype(kind), box_high.astype(kind)))
                fits = (most >= low[:, None]) & (least <= high[:, None])
                if only_best:
                    reach = np.where(fits, np.minimum(most, high[:, None]), LOWEST - 1)
                    at = np.argmax(reach, axis=1)
                    better = reach[np.arange(len(at)), at] > best
                    best[better], best_tile[better] = reach[better, at[better]], tile[at[better]]
                    continue
                row, column = np.nonzero(fits & (most >= floor[:, None]) & (tile[None, :] != seen[:, None]))
                if len(row):
                    yield _with_tile(batch.take(pa.array(row)), tile[column])
            if only_best and (best_tile >= 0).any():
                yield _with_tile(batch.take(pa.array(np.flatnonzero(best_tile >= 0))), best_tile[best_tile >= 0])

        schema = "anchor_id long, request long, label long, row array<int>, same boolean, low long, high long, floor long, tile long"
        columns = ["anchor_id", "request", "label", "row", "same", "low", "high", "floor", "seen"]
        return requests.select(*columns).mapInArrow(route, schema)

    def _visit(self, cells: DataFrame, k: int, parts: int, tag: str) -> DataFrame:
        """(``anchor_id``, ``request``, ``tile``, ``vec_id``, ``score``) per result of a visited tile, and a row without a result per visit."""
        cells = stored(cells.withColumn("part", F.pmod(F.xxhash64("anchor_id", "request"), F.lit(parts)).cast("int")), f"{tag}-asked")
        # A tile that very many requests visit is sent to several tasks.
        pairs = cells.select(F.col("tile").alias("tile"), F.col("part").alias("part")).distinct()
        visited = self.tiles.select("tile", "ids", "labels", "rows").join(pairs, "tile")
        width = self.width

        def search(asked: pa.Table, tiles: pa.Table) -> pa.Table:
            names = ("anchor_id", "request", "label", "same", "low", "high", "floor", "tile")
            asked = asked.combine_chunks()
            c = {n: asked.column(n).to_numpy() for n in names}
            anchors = _matrix(asked.column("row").combine_chunks(), width)
            ids, labels = (np.frombuffer(tiles.column(n)[0].as_py(), "<i8") for n in ("ids", "labels"))
            rows = np.frombuffer(tiles.column("rows")[0].as_py(), "<i4").reshape(-1, width)
            found = [(np.arange(asked.num_rows), np.full(asked.num_rows, LOWEST), np.full(asked.num_rows, LOWEST))]
            for at in range(0, asked.num_rows, 512):
                part = slice(at, at + 512)
                requests = Requests(anchors[part], c["anchor_id"][part], c["label"][part], c["same"][part], c["low"][part], c["high"][part], c["floor"][part])
                request, of, score = search_tile(requests, ids, labels, rows, k)
                found.append((request + at, of, score))
            request, of, score = (np.concatenate([f[i] for f in found]) for i in range(3))
            none = np.arange(len(of)) < asked.num_rows
            columns = [c["anchor_id"][request], c["request"][request], c["tile"][request]]
            results = [pa.array(of, mask=none), pa.array(score, mask=none)]
            return pa.Table.from_arrays([*map(pa.array, columns), *results], ["anchor_id", "request", "tile", "vec_id", "score"])

        found = cells.groupBy("tile", "part").cogroup(visited.groupBy("tile", "part")).applyInArrow(search, "anchor_id long, request long, tile long, vec_id long, score long")
        return stored(found, tag)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def _with_tile(batch: pa.RecordBatch, tile: np.ndarray) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != "seen"]
    return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(n)) for n in names), pa.array(tile)], [*names, "tile"])


def _tile(number: int, rows: pa.Table, width: int) -> pa.RecordBatch:
    values = _matrix(rows.column("row").combine_chunks(), width)
    order = str_order(values, LEAF)
    values = values[order]
    ids, labels = (rows.column(c).to_numpy()[order].astype("<i8") for c in ("vec_id", "label"))
    packed = [ids, labels, values.astype("<i4"), values.min(axis=0).astype("<i4"), values.max(axis=0).astype("<i4")]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], ["tile", "ids", "labels", "rows", "low", "high"])


def _directory(folder: str, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tiles, least coordinates, largest coordinates) of the stored directory, some thousand tiles at a time."""
    fs, path = open_store(folder)
    for info in sorted(fs.get_file_info(pafs.FileSelector(path)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with fs.open_input_file(info.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(DIRECTORY):
                    low, high = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<i4").reshape(-1, width) for i in (1, 2))
                    yield batch.column(0).to_numpy(), low, high


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0, tile: int = TILE,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``), exactly.

    ``anchors`` is a condition on ``vec_id``. An anchor's positives are the first ``positives`` other rows of its label by (score descending, id ascending); the negatives of
    each are the first ``negatives`` rows of other labels with scores from ``low`` to ``high`` per cent of the positive's. Scores are inner
    products of the components ``floor(scale * x)``. Which rows take part: ``usable_vectors``. Vectors of different lengths are
    compared as if the shorter one ended with zeros. An empty table, or one without anchors, gives an empty result; other columns are not read.
    """
    tree = Tree(usable_vectors(vectors, id_column, vector_column, label_column, scale), tile)
    asked = tree.rows.filter(anchors).select(F.col("vec_id").alias("anchor_id"), "label", "row")
    whole = asked.select("*", F.lit(0).cast("long").alias("request"), F.lit(True).alias("same"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"))
    near = stored(tree.search(whole, positives).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Below zero the window is empty.
    windows = near.filter("positive_score >= 0").select("anchor_id", F.col("positive_id").alias("request"), F.lit(False).alias("same"),
        F.expr(f"({low}L * positive_score + 99) div 100").alias("low"), F.expr(f"({high}L * positive_score) div 100").alias("high"))
    requests = asked.join(windows.filter("low <= high"), "anchor_id")
    far = tree.search(requests, negatives).select("anchor_id", F.col("request").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return far.join(near, ["anchor_id", "positive_id"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
