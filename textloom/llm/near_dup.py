"""SimHash near-duplicates by an inverted index over fingerprint bytes and their positions.

Two fingerprints that differ in at most 4 of 64 bits differ in at most 4 of their 8 bytes, so they share at
least 4 positional bytes. A list per single (position, byte) would hold 1/256 of the corpus, and tallying from
such lists means a quadratic number of pairs. The index therefore keys its lists on positional bytes taken three
(or four) at a time, in a family of position sets of which every set of four positions contains one: any pair with four
shared positional bytes meets in a list. For pairs that meet, the shared positional bytes are tallied, pairs
with at least four are retained, and those are verified on all bits.

``similar_documents`` is the wider mode: documents whose sets of word shingles have a Jaccard similarity of at least 0.8. Candidates
share a shingle of their prefixes, which no such pair fails to do, and whole shingle sets decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import NULL_ID, connected_groups, listed_links, row_key, sized_join, stored, without_rows

BITS, BYTES = 64, 8
# Members of a list that are compared as one block; longer lists are cut into blocks that meet pairwise.
BLOCK = 1024
# Chance partners per list member from which on the lists are keyed on four bytes instead of three.
CHANCE = 16
# The wider mode: words of a shingle; texts that say which shingles are common, and how many such shingles are told to tasks at most.
WIDE_WORDS, ORDER_TEXTS, ORDER_MOST = 5, 4096, 1 << 18
# Shingles in two or more prefixes that are broadcast at most, as 8-byte numbers; more are joined by a shuffle.
MOST_KEYS = 3 << 20


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of a text's word shingles: a bit is set if over half of the shingle hashes have it set.

    A-Z become a-z, words are separated by ASCII white space, repeated shingles count each time. Fewer words
    than a shingle make one shingle; no word gives 0.
    """
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    k = min(words, len(tokens))
    starts = [0, *(ends[: len(tokens) - k] + 1).tolist()]
    counts = np.zeros(BITS, np.int64)
    spans = ends[k - 1 :].tolist()
    for at in range(0, len(starts), 65536):
        parts = [joined[lo:hi] for lo, hi in zip(starts[at : at + 65536], spans[at : at + 65536], strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(seed)), "<u8", len(parts))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4) -> DataFrame:
    """(``doc_id``, ``text_hash``, ``fp``) per row; ``fp`` is the fingerprint as a signed 64-bit integer."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"]
            )

    text = F.col(text_column).cast("binary")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("_text"))
    return rows.mapInArrow(score, "doc_id long, text_hash long, fp long")


def position_sets(size: int) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions such that any four of the eight positions contain one of the sets."""
    groups = [range(0, 3), range(3, 6), range(6, 8)]
    if size == 4:
        return list(combinations(range(BYTES), 4))
    if size != 3:
        raise ValueError("size is 3 or 4")
    sets: list[tuple[int, ...]] = [s for g in groups for s in combinations(g, 3)]
    for here, after in zip(groups, [*groups[1:], groups[0]], strict=True):
        sets += [(*pair, one) for pair in combinations(here, 2) for one in after]
    return sets


def _key(number: int, positions: tuple[int, ...]) -> Column:
    key = F.lit(number).cast("long")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)))
    return key


def _link_runs(limit: int, least_shared: int):
    """Links within runs of one list: (``a``, ``b``) edges of a forest that connects what the linked pairs connect."""

    def forest(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        n = len(fp)
        starts = np.flatnonzero(np.concatenate([[True], np.any(key[1:] != key[:-1], axis=1)]))
        ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
        left, right, at, step = [], [], np.arange(n), 1
        while True:
            at = at[at + step < ends[at]]
            if not len(at):
                break
            apart = fp[at] ^ fp[at + step]
            shared = (apart.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
            near = at[shared >= least_shared]
            near = near[np.bitwise_count(fp[near] ^ fp[near + step]) <= limit]
            left.append(near)
            right.append(near + step)
            step += 1
        if not left:
            return None
        i, j = np.concatenate(left), np.concatenate(right)
        if not len(i):
            return None
        label = np.arange(n)
        while True:
            least = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            label = label[label]
            if np.array_equal(label, before):
                break
        moved = np.flatnonzero(label != np.arange(n))
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[moved].view(np.int64)), pa.array(fp[label[moved]].view(np.int64))], ["a", "b"]
        )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.empty((0, 3), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            key = np.concatenate([held_key, np.stack(columns[:3], axis=1)])
            fp = np.concatenate([held_fp, columns[3].astype(np.int64).view(np.uint64)])
            last = len(key) - 1
            if last < 0:
                continue
            # The last run may go on in the next batch.
            cut = int(np.flatnonzero(np.any(key != key[last], axis=1))[-1]) + 1 if np.any(key != key[last]) else 0
            if cut and (found := forest(key[:cut], fp[:cut])) is not None:
                yield found
            held_key, held_fp = key[cut:], fp[cut:]
        if len(held_fp) and (found := forest(held_key, held_fp)) is not None:
            yield found

    return link


def links(fps: DataFrame, limit: int = 4, size: int | None = None, block: int = BLOCK) -> DataFrame:
    """Edges (``a``, ``b``) that connect exactly what pairs of distinct fingerprints (``fp``) within ``limit`` <= 4 bits connect.

    Lists longer than ``block`` are cut into blocks by a hash, and each two blocks meet in a cell of their own, so no task
    gets an unbounded group. Within a cell the linked pairs become a forest before they leave the task.
    """
    if size is None:
        size = 3 if fps.count() <= CHANCE << 24 else 4
    keys = F.array(*[_key(i, s) for i, s in enumerate(position_sets(size))])
    postings = fps.select("fp", F.explode(keys).alias("key"))
    long_lists = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    long_lists = stored(long_lists.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "long-lists")
    cells = postings.join(long_lists, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = cells.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    runs = cells.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    # 64 bits with at most `limit` of 8 bytes touched: the others are shared.
    return runs.mapInArrow(_link_runs(limit, BYTES - limit), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = 4, words: int = 4) -> DataFrame:
    """(``doc_id``, ``text_hash``, ``fp``, ``component_id``, ``root``) per row of ``docs``.

    ``component_id`` is the smallest id among the documents that links of at most ``limit`` bits reach. Copies collapse
    into one fingerprint before anything is paired. NULL texts and texts without words have fingerprint 0
    and link like others. ``component_id`` is NULL only if no document of the group has an id; ``root``, a fingerprint, names the group always.
    Repeated rows stay, and other columns of ``docs`` are not read.
    """
    if not 0 <= limit <= 4:
        raise ValueError("limit is at most 4 bits")
    rows = stored(fingerprints(docs, id_column, text_column, words), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = connected_groups(links(classes.select("fp"), limit))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id", "root")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def shingle_set(text: bytes | None, words: int = WIDE_WORDS, seed: int = 42) -> np.ndarray:
    """The distinct hashes of a text's word shingles, ascending; words as in ``fingerprint``. No word makes one empty shingle."""
    tokens = (text or b"").lower().split()
    k = min(words, len(tokens))
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(tokens[i : i + k]), seed) for i in range(len(tokens) - k + 1)], np.uint64))


def prefix_keys(shingles: np.ndarray, common: np.ndarray, least: float) -> np.ndarray:
    """The first shingles in an order that all texts share: ascending, the ``common`` ones (ascending too) behind all others.

    Two sets of similarity ``least`` or more have so many shingles in common that their prefixes share one.
    """
    n = len(shingles)
    taken = n - math.ceil(least * n - 1e-6) + 1
    at = np.searchsorted(common, shingles)
    often = (common[np.minimum(at, len(common) - 1)] == shingles) if len(common) else np.zeros(n, bool)
    return np.concatenate([shingles[~often], shingles[often]])[:taken]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def common_shingles(marked: DataFrame, words: int = WIDE_WORDS, texts: int = ORDER_TEXTS, most: int = ORDER_MOST) -> np.ndarray:
    """Shingles that more than one of about ``texts`` texts hold, ascending, ``most`` at most: which they are changes the work, never a result."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = [shingle_set(t.as_py(), words).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int64())], ["shingle"])

    drawn = marked.select("at", "_text").filter(F.pmod(F.xxhash64(F.lit(1), "at"), F.lit(-(-marked.count() // texts) or 1)) == 0)
    counts = drawn.dropDuplicates(["at"]).mapInArrow(each, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    often = counts.filter("n > 1").orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    return np.sort(often.column("shingle").to_numpy().view(np.uint64))


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.8, words: int = WIDE_WORDS) -> DataFrame:
    """(``doc_id``, ``text_hash``, ``root``) per row of ``docs``: ``root`` names the group that similarities of at least ``least`` connect.

    Similarity is the Jaccard similarity of the sets of word shingles. Texts without words are one group.
    """
    if not 0 < least <= 1:
        raise ValueError("least is above 0 and at most 1")
    text = F.col(text_column).cast("binary")
    marked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("at"), text.alias("_text"))
    common = common_shingles(marked, words)
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [shingle_set(t.as_py(), words) for t in batch.column(2)]
            keys = [prefix_keys(s, shared.value, least).view(np.int64) for s in sets]
            columns = [pa.array(list(map(len, sets)), pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "at", "chars", "keys"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = [shingle_set(t.as_py(), words).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["at", "shingles"])

    rows = stored(marked.mapInArrow(sketches, "doc_id long, at long, chars long, keys array<long>"), "sketches")
    # Nearly all shingles are in one text: only those in two or more go on, once for each text. Exact copies are one text.
    postings = rows.select("at", "chars", F.explode("keys").alias("key"))
    met = postings.groupBy("key").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).filter("lo != hi").select("key")
    postings = sized_join(postings, met, ["key"], "left_semi", MOST_KEYS).select("at", "chars", "key").distinct()

    def enough(shared: Column, left: Column, right: Column) -> Column:
        # Of the text whose prefix ends first, what the other holds is shared within the prefixes or behind its own.
        behind = F.greatest(*[F.ceil(least * c - 1e-6) - 1 for c in (left, right)])
        return shared + behind >= (left + right) * (least / (1 + least)) - 1e-6

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "candidates")
        places = pairs.select(F.col("a").alias("at")).unionByName(pairs.select(F.col("b").alias("at"))).distinct()
        texts = sized_join(marked.select("at", "_text"), places, ["at"], "left_semi").dropDuplicates(["at"])
        texts = stored(texts.mapInArrow(sets, "at long, shingles array<long>"), "shingles")
        both = pairs.join(texts.select(F.col("at").alias("a"), F.col("shingles").alias("left")), "a")
        both = both.join(texts.select(F.col("at").alias("b"), F.col("shingles").alias("right")), "b")
        common = F.size(F.array_intersect("left", "right"))
        return both.filter(common >= F.lit(least) * (F.size("left") + F.size("right") - common) - 1e-9).select("a", "b")

    found = connected_groups(listed_links(postings, verified, least, enough))
    rooted = rows.join(found.withColumnRenamed("node", "at"), "at", "left")
    return rooted.select("doc_id", F.col("at").alias("text_hash"), F.coalesce("root", "at").alias("root"))


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), BITS // 4, "0")


def one_per_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = 4, words: int = 4, least: float | None = None) -> DataFrame:
    """The rows of ``docs`` of which one per group stays: the smallest id, then the smallest text hash; one of repeated rows.

    With ``least`` the groups are those of ``similar_documents`` with five words, else those of ``near_duplicates``.
    """
    if least is None:
        found = stored(near_duplicates(docs, id_column, text_column, limit, words), "groups")
    else:
        found = stored(similar_documents(docs, id_column, text_column, least), "groups")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("best")
    kept = found.groupBy("root").agg(best).select("root", F.struct("best.doc_id", "best.text_hash").alias("best"))
    # The root of a huge group is one row of the small side; counts are taken before the join.
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).join(kept, "root")
    chosen = F.struct("doc_id", "text_hash") == F.col("best")
    gone, again = rows.filter(~chosen), rows.filter(chosen & (F.col("n") > 1))
    side = again.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_row_id"), F.col("text_hash").alias("_row_hash"))
    repeats = sized_join(docs.withColumns(row_key(id_column, text_column)), side, ["_row_id", "_row_hash"], "left_semi")
    repeats = repeats.dropDuplicates(["_row_id", "_row_hash"]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return without_rows(docs, gone.unionByName(again), id_column, text_column).unionByName(repeats)
