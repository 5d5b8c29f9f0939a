"""Packing of documents into sequences by a grouping genetic algorithm on islands.

Documents become token pieces; pieces are dealt into blocks of bounded size, and every block is packed by several
islands. A chromosome is a list of whole bins. Crossover injects well-filled bins of one parent into the
other, removes the bins that hold an item twice, and puts the displaced items back by best fit, longest
first. After each epoch the best chromosome of an island moves to the next island of the block by a join. Bins that are
nearly full are final; the items of all other bins are dealt anew, until one block holds the rest.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import stored
from textloom.llm.tokens import encoder

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
# Items per block, islands per block, epochs, offspring per island and epoch, chromosomes per island.
BLOCK, ISLANDS, EPOCHS, OFFSPRING, POPULATION = 4096, 2, 2, 60, 6
# How far sizes are blurred for the orders that the first chromosomes are packed in.
BLURS = (0.0, 0.05, 0.5, 0.1, 2.0, 0.2, 8.0, 1.0)
# A bin filled to this share is final.
FULL = 0.995


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: a document's ids and ``end_id``, cut into pieces of ``capacity`` only if there are more.

    A NULL text is empty, so its document is the end id alone. Repeated rows give pieces each. ``uid`` numbers the pieces; it is
    fixed once the result is stored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = memoryview(encode(text.as_py()) + end)
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((uid, name, i, at // 4, len(part) // 4, zlib.crc32(part)))
                    uid += 1
            yield _batch(rows, PIECES)

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("binary").alias("_text"))
    return rows.mapInArrow(cut, PIECES)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*[c.split() for c in schema.split(", ")], strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds, strict=True)], list(names))


def best_fit(items: list[int], sizes: list[int], capacity: int, bins: list[list[int]], fills: list[int]) -> None:
    """Put ``items`` in turn into the bin with the least room that is enough, or into a new bin; changes ``bins`` and ``fills``."""
    room = sorted((capacity - f, b) for b, f in enumerate(fills) if f < capacity)
    for item in items:
        size = sizes[item]
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
            bins[b].append(item)
            fills[b] += size
        else:
            left, b = capacity, len(bins)
            bins.append([item])
            fills.append(size)
        if left > size:
            insort(room, (left - size, b))


def crossover(receiver: np.ndarray, donor: np.ndarray, sizes: list[int], capacity: int, share: float, rng: random.Random) -> np.ndarray:
    """A child of two chromosomes (bin number of every item); items are numbered by falling size."""
    weights = np.asarray(sizes)
    donor_fill = np.bincount(donor, weights=weights)
    order = np.argsort(-donor_fill, kind="stable")
    # Some of the best-filled half, so that two children of the same parents differ.
    top = order[: max(1, len(order) // 2)].tolist()
    chosen = np.zeros(len(donor_fill), bool)
    chosen[rng.sample(top, max(1, int(len(top) * share)))] = True
    injected = chosen[donor]
    broken = np.zeros(int(receiver.max()) + 1, bool)
    broken[receiver[injected]] = True
    # The receiver's emptiest bins go too: what they hold gets another chance beside the displaced items.
    fill = np.bincount(receiver, weights=weights)
    broken[np.argsort(fill, kind="stable")[: rng.randrange(0, 2 + len(fill) // 50)]] = True
    displaced = np.flatnonzero(broken[receiver] & ~injected)
    child = np.where(injected, len(broken) + donor, receiver)
    child[displaced] = -1
    placed = child >= 0
    _, child[placed] = np.unique(child[placed], return_inverse=True)
    n = int(child.max()) + 1
    fills = np.bincount(child[placed], weights=weights[placed], minlength=n).astype(int).tolist()
    bins: list[list[int]] = [[] for _ in range(n)]
    blur = rng.choice([0.0, 0.05, 0.3])
    order = sorted(displaced.tolist(), key=lambda i: -sizes[i] * (1 + blur * rng.random()))
    best_fit(order, sizes, capacity, bins, fills)
    for b, items in enumerate(bins):
        child[items] = b
    return child


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the sum of squared fills: full bins beside an emptier one beat even fills."""
    fill = np.bincount(bins, weights=sizes) / capacity
    return -len(fill), float((fill * fill).sum())


def first_population(sizes: list[int], capacity: int, count: int, rng: random.Random) -> list[np.ndarray]:
    """Best fit by falling size, then by sizes that are blurred more and more."""
    found = []
    for blur in range(count):
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + BLURS[blur % len(BLURS)] * rng.random()))
        bins: list[list[int]] = []
        best_fit(order, sizes, capacity, bins, [])
        placed = np.zeros(len(sizes), np.int32)
        for b, items in enumerate(bins):
            placed[items] = b
        found.append(placed)
    return found


def evolve(population: list[np.ndarray], sizes: list[int], capacity: int, offspring: int, rng: random.Random) -> list[np.ndarray]:
    """Replace the worst chromosome by each child that is better; the best one comes first in the result."""
    weights = np.asarray(sizes)
    scored = sorted(((fitness(p, weights, capacity), p) for p in population), key=lambda x: x[0], reverse=True)
    least = -(-int(weights.sum()) // capacity)
    for _ in range(offspring):
        if -scored[0][0][0] <= least or len(scored) < 2:
            break  # no packing has fewer bins
        receiver, donor = rng.sample(scored, 2)
        child = crossover(receiver[1], donor[1], sizes, capacity, rng.choice([0.1, 0.25, 0.5]), rng)
        score = fitness(child, weights, capacity)
        if score > scored[-1][0] and all(score != s for s, _ in scored):
            scored[-1] = (score, child)
            scored.sort(key=lambda x: x[0], reverse=True)
    return [p for _, p in scored]


STATE = "block long, island int, uids binary, sizes binary, population array<binary>, bins long, fill double"


def _epoch(capacity: int, seed: int, offspring: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rng = random.Random(f"{seed}:{row['block']}:{row['island']}")
                if row["population"] is None:
                    items = sorted(row["items"], key=lambda x: (-x["length"], x["uid"]))
                    sizes = [x["length"] for x in items]
                    uids = np.array([x["uid"] for x in items], "<i8").tobytes()
                    population = first_population(sizes, capacity, count, rng)
                else:
                    uids, sizes = row["uids"], np.frombuffer(row["sizes"], "<i4").tolist()
                    population = [np.frombuffer(p, "<i4").copy() for p in row["population"]]
                    if row["guest"] is not None:
                        population[-1] = np.frombuffer(row["guest"], "<i4").copy()
                population = evolve(population, sizes, capacity, offspring, rng)
                few, fill = fitness(population[0], np.asarray(sizes), capacity)
                packed = [p.astype("<i4").tobytes() for p in population]
                out = (row["block"], row["island"], uids, np.array(sizes, "<i4").tobytes(), packed, -few, fill)
                yield _batch([out], STATE)

    return run


PLACED = "uid long, sequence_id long, offset long, length long, filled long"


def _placements(capacity: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins, sizes = np.frombuffer(row["best"], "<i4"), np.frombuffer(row["sizes"], "<i4").astype("i8")
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(sizes[order])
                filled = np.bincount(bins, weights=sizes).astype("i8")
                base = np.cumsum(filled) - filled
                number = (level << 56) + (row["block"] << 20) + bins[order].astype("i8")
                uids = np.frombuffer(row["uids"], "<i8")[order]
                offset = ends - sizes[order] - base[bins[order]]
                columns = [uids, number, offset, sizes[order], filled[bins[order]]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["uid", "sequence_id", "offset", "length", "filled"])

    return run


def pack_block_level(items: DataFrame, n: int, capacity: int, level: int, block: int, seed: int) -> DataFrame:
    """Pack ``n`` items (``uid``, ``length``) block by block; rows of ``PLACED``."""
    blocks = -(-n // block)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(blocks)))
    gathered = dealt.groupBy("block").agg(F.collect_list(F.struct("uid", "length")).alias("items"))
    islands = gathered.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    islands = islands.withColumn("population", F.lit(None).cast("array<binary>")).repartition("block", "island")
    state = stored(islands.mapInArrow(_epoch(capacity, seed, OFFSPRING, POPULATION), STATE), "packing")
    for epoch in range(1, EPOCHS):
        guests = state.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.get("population", F.lit(0)).alias("guest"))
        met = state.join(guests, ["block", "island"]).repartition("block", "island")
        state = stored(met.mapInArrow(_epoch(capacity, seed + epoch, OFFSPRING, POPULATION), STATE), "packing")
    best = F.max_by(F.struct("uids", "sizes", F.get("population", F.lit(0)).alias("best")), F.struct(-F.col("bins"), "fill", -F.col("island")))
    chosen = state.groupBy("block").agg(best.alias("x")).select("block", "x.*")
    return chosen.mapInArrow(_placements(capacity, level), PLACED)


def pack(pieces: DataFrame, capacity: int, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """(``uid``, ``sequence_id``, ``offset``) per piece of the stored table ``pieces``: every sequence is filled without gaps from 0
    and holds at most ``capacity`` tokens. Items that fill a sequence alone skip the search. An empty table gives no row.
    """
    alone = pieces.filter(F.col("length") >= capacity)
    done = [alone.select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    items = pieces.filter(F.col("length") < capacity).select("uid", "length")
    n, level = items.count(), 0
    while n:
        placed = stored(pack_block_level(items, n, capacity, level, block, seed + 1000 * level), "placed")
        final = F.lit(True) if n <= block else F.col("filled") >= int(FULL * capacity)
        rest = placed.filter(~final).select("uid", "length")
        left = rest.count()
        if 2 * left > n:  # dealing anew would not help
            final, left = F.lit(True), 0
        done.append(placed.filter(final).select("uid", "sequence_id", "offset"))
        items, n, level = rest, left, level + 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: its document, place in it, checksum, sequence, and place there."""
    pieces = stored(cut_pieces(docs, tokenizer, end_id, capacity, id_column, text_column), "pieces")
    return pieces.join(pack(pieces, capacity), "uid").drop("uid")
