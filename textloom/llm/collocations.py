"""Phrase collocations by SON partitioning: local mining at proportionally lower support, then exact global counts.

Documents are dealt to ``shards`` logical shards by the hash of their text. Of ``least`` occurrences in a language, some
shard must hold its proportional part: a phrase that reaches ``least`` overall reaches ``least * words of the shard / words of the language``
in one shard at least. Each shard is mined completely at that support, level by level (a phrase is frequent only if
both of its one-word-shorter parts are), the locally frequent phrases are united, and one more scan counts those over all shards.

A shard is no task: every task counts its chunks of text for all shards, and Spark adds up (language, shard, phrase). So the number of
shards, and with it the local support, does not depend on the size of the table. What the level below found reaches the tasks as a bit table of fixed size
on phrase hashes, and local counts are kept on hashes too: what two phrases share by chance makes a candidate more, never
one less. The last scan counts the phrases themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import sized_join, stored
from textloom.operators.skew import lookup_join

SHARDS = 16
# Bytes of text that are counted together in a task; texts and pieces that are longer make a larger chunk.
CHUNK = 3 << 20
# Rows of counts that leave a task at once.
ROWS = 1 << 16
# Bits of the table that holds the hashes of frequent phrases: 8 MB.
FILTER_BITS = 26
# What tasks count on: the hash of language and phrase, with the shard in its last eight bits.
LOCAL, GLOBAL = "key long, lang long, n long", "lang string, phrase binary, n long"

WORD, BLANK, BREAK = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _first(words: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Hashes of one-word phrases, from hashes of words and of their language."""
    mixed = (words ^ seed) * _MIX
    return mixed ^ (mixed >> np.uint64(29))


def _longer(phrases: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of the phrases with one more word."""
    mixed = (phrases * _STEP + words) * _MIX
    return mixed ^ (mixed >> np.uint64(29))


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 1)


def keys_of(marks: np.ndarray, shards: np.ndarray | int) -> np.ndarray:
    """Phrase hashes as keys of a shard; never below 256, which stand for the numbers of words."""
    return ((marks | np.uint64(1 << 63)) & ~np.uint64(255)) | np.asarray(shards).astype(np.uint64)


class Chunk:
    """The words of some texts of one language as numbers, with the piece and the shard of each."""

    def __init__(self, texts: list[bytes], shards: list[int], lang: str):
        data = LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        kind = KIND[data]
        inside = kind == WORD
        edges = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.size, self.seed = len(starts), np.uint64(lang_seed(lang))
        offsets = np.zeros(self.size + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), self.size, [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = spans.dictionary_encode()
        self.vocabulary, self.words = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.pieces = np.cumsum(kind == BREAK, dtype=np.int32)[starts] if self.size else np.zeros(0, np.int32)
        first = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
        self.shards = np.asarray(shards, np.uint8)[np.searchsorted(first, starts, "right") - 1]
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.vocabulary.to_pylist()], np.uint64)
        self.hashes = hashes[self.words] if self.size else np.zeros(0, np.uint64)

    def windows(self, longest: int, passes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length: the places and the hashes of all phrases.

        ``passes(length, hashes, shards)`` says which of the phrases may go on to longer ones and are yielded.
        """
        marks, at = _first(self.hashes, self.seed), np.arange(self.size)
        for length in range(1, longest + 1):
            if length > 1:
                # Two phrases that overlap in all but one word make the phrase that is one word longer.
                follows = np.flatnonzero((at[1:] == at[:-1] + 1) & (self.pieces[at[1:]] == self.pieces[at[:-1]]))
                marks, at = _longer(marks[follows], self.hashes[at[follows] + length - 1]), at[follows]
            keep = passes(length, marks, self.shards[at])
            marks, at = marks[keep], at[keep]
            yield length, at, marks

    def distinct(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """A place of each distinct phrase, and how often it occurs; phrases are compared word by word."""
        codes = self.words[at]
        for i in range(1, length):
            _, codes = np.unique(codes * len(self.vocabulary) + self.words[at + i], return_inverse=True)
        _, place, n = np.unique(codes, return_index=True, return_counts=True)
        return at[place], n

    def texts(self, at: np.ndarray, length: int) -> pa.Array:
        parts = [self.vocabulary.take(pa.array(self.words[at + i])) for i in range(length)]
        joined = parts[0] if length == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        return joined.cast(pa.binary())


def _slices(texts: list[bytes], groups: list[int]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Texts in portions of about ``CHUNK`` bytes; a longer text is cut where one of its pieces ends."""
    held, of, size = [], [], 0
    for text, group in zip(texts, groups, strict=True):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > CHUNK - size:
                found = PIECE_END.search(text, at + CHUNK - size)
                end = found.end() if found else end
            held.append(text[at:end])
            of.append(group)
            size, at = size + end - at, end
            if size >= CHUNK:
                yield held, of
                held, of, size = [], [], 0
    if held:
        yield held, of


def _bit_index(keys: np.ndarray, filter_bits: int) -> np.ndarray:
    """The bit of a key: some bits of the hash, moved by the shard."""
    moved = ((keys & np.uint64(255)) * np.uint64(0x9E3779B1)) & np.uint64((1 << filter_bits) - 1)
    return ((keys >> np.uint64(63 - filter_bits)) & np.uint64((1 << filter_bits) - 1)) ^ moved


def _bit_table(keys: DataFrame, filter_bits: int) -> Broadcast:
    """Keys as a bit table: at most 2^``filter_bits`` bits reach the driver."""
    most = (1 << filter_bits) - 1
    bit = F.shiftrightunsigned("key", 63 - filter_bits).bitwiseAND(F.lit(most)).bitwiseXOR((F.col("key").bitwiseAND(F.lit(255)) * F.lit(0x9E3779B1)).bitwiseAND(F.lit(most)))
    bits = keys.select(bit.alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    got = words.toArrow()
    table = np.zeros(max(1, 1 << max(0, filter_bits - 6)), "<u8")
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table.tobytes())


def _counter(lengths: range, table: Broadcast | None, filter_bits: int, local: bool, gate: int):
    """Task: counts of phrases of ``lengths`` words; phrases up to ``gate`` words must be in the bit table.

    With ``local`` rows are keys of a shard with the hash of the language, and the numbers of words stand under the shards' own numbers; without,
    rows are languages and phrases.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8) if table is not None else None

        def passes(length: int, marks: np.ndarray, shards: np.ndarray) -> np.ndarray:
            if bits is None or length > gate:
                return np.ones(len(marks), bool)
            bit = _bit_index(keys_of(marks, shards if local else 0), filter_bits)
            return (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

        def local_rows(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            if 1 in lengths:
                words = np.bincount(chunk.shards, minlength=256)
                yield np.flatnonzero(words), words[words > 0]
            for length, at, marks in chunk.windows(lengths[-1], passes):
                if length in lengths and len(at):
                    # Equal hashes of two phrases would add up: a candidate more, never one less.
                    yield np.unique(keys_of(marks, chunk.shards[at]), return_counts=True)

        for batch in batches:
            by_lang: dict[str, tuple[list[bytes], list[int]]] = {}
            for lang, shard, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                texts, shards = by_lang.setdefault(lang.as_py(), ([], []))
                texts.append(text.as_py())
                shards.append(shard.as_py())
            for lang, (texts, shards) in by_lang.items():
                seed = lang_seed(lang) - (1 << 63)
                for some, of in _slices(texts, shards):
                    chunk = Chunk(some, of, lang)
                    if local:
                        for key, n in local_rows(chunk):
                            for i in range(0, len(key), ROWS):
                                part = slice(i, i + ROWS)
                                columns = [pa.array(key[part].view(np.int64)), pa.array(np.full(len(key[part]), seed)), pa.array(n[part].astype(np.int64))]
                                yield pa.RecordBatch.from_arrays(columns, ["key", "lang", "n"])
                        continue
                    for length, places, _ in chunk.windows(lengths[-1], passes):
                        at, n = chunk.distinct(places, length)
                        for i in range(0, len(at), ROWS):
                            part = slice(i, i + ROWS)
                            phrases = chunk.texts(at[part], length)
                            columns = [pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(n[part].astype(np.int64))]
                            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])

    return count


def phrase_counts(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = 100, longest: int = 5,
    shards: int = SHARDS, filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words that occur at least ``least`` times in a language: (``lang``, ``phrase``, ``length``, ``a``); and (``lang``, ``n``).

    A-Z become a-z; texts fall into pieces at ``. , ; : ! ?`` and line ends (0x0A-0x0D), pieces into words at spaces and tabs. Occurrences
    lie within a piece and may overlap. ``n`` is the number of words of the language. A NULL language is ``und``, a NULL text is empty.
    Repeated rows count each time; an empty table gives empty results; other columns are not read.
    """
    if longest < 1 or least < 1 or not 1 <= shards <= 256:
        raise ValueError("phrases have a word and occur once at least; there are 1 to 256 shards")
    text = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.pmod(F.xxhash64(text), F.lit(shards)).cast("int").alias("shard"), text.alias("_text"))

    def mine(lengths: range, table: Broadcast | None, gate: int = 1) -> DataFrame:
        found = rows.mapInArrow(_counter(lengths, table, filter_bits, True, gate), LOCAL)
        return found.groupBy("key", "lang").agg(F.sum("n").alias("n"))

    words = stored(mine(range(1, 2), None), "words")
    shard = F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("shard")
    # Hashes have their first bit set, so they are negative.
    totals = words.filter("key >= 0").select("lang", shard, "n")
    sizes = stored(totals.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    local = totals.select("lang", "shard", F.col("n").alias("in_shard")).join(sizes.withColumnRenamed("n", "in_lang"), "lang")
    local = stored(local.select("lang", "shard", F.expr(f"({least}L * in_shard + in_lang - 1) div in_lang").alias("local")), "local")

    def frequent(counts: DataFrame) -> DataFrame:
        kept = sized_join(counts.filter("key < 0").select("key", "lang", "n", shard), local, ["lang", "shard"]).filter("n >= local")
        return stored(kept.select("key"), "frequent")

    mined = frequent(words)
    if longest > 1:
        mined = mined.unionByName(frequent(mine(range(2, 3), _bit_table(mined, filter_bits))))
    if longest > 2:
        mined = mined.unionByName(frequent(mine(range(3, longest + 1), _bit_table(mined, filter_bits), gate=2)))
    candidates = mined.select(F.col("key").bitwiseAND(F.lit(~255)).alias("key"))
    counted = rows.mapInArrow(_counter(range(1, longest + 1), _bit_table(candidates, filter_bits), filter_bits, False, longest), GLOBAL)
    counted = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).filter(F.col("a") >= least).withColumn("phrase", F.col("phrase").cast("string"))
    counted = stored(counted.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("length"), "a"), "phrases")
    # Back from hashes to the names of languages.
    names = rows.groupBy("lang").agg(F.lit(1).alias("_one")).select("lang").mapInArrow(_seeds, "lang string, seed long")
    return counted, stored(names.join(sizes.withColumnRenamed("lang", "seed"), "seed").select("lang", "n"), "sizes")


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seeds = [lang_seed(lang) - (1 << 63) for lang in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(seeds, pa.int64())], ["lang", "seed"])


def collocations(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = 100, longest: int = 5, most: int = 2000,
    shards: int = SHARDS, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The first ``most`` phrases of 2 to ``longest`` words of each language: (``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``).

    Of the ways to cut a phrase of ``a`` occurrences in two, with ``l`` and ``r`` occurrences of the parts, the one with the lowest
    ``floor(1000 a n / (l r))`` counts, ties to the shorter first part. A phrase that never occurs outside of a longer one is left out. Order: score and ``a``
    descending, phrase in byte order. Input cases are those of ``phrase_counts``.
    """
    counted, sizes = phrase_counts(docs, text_column, lang_column, least, longest, shards, filter_bits)
    words = F.split("phrase", " ")
    parts = counted.filter("length > 1").select("lang", "phrase", "length", "a", words.alias("words"))
    # A phrase inside a longer one of the same count is inside one that is a single word longer, of the same count too.
    inner = F.array(F.slice("words", F.lit(1), F.col("length") - 1), F.slice("words", F.lit(2), F.col("length") - 1))
    covers = parts.filter("length > 2").select("lang", F.explode(inner).alias("inner"), "a")
    covers = covers.groupBy("lang", F.concat_ws(" ", "inner").alias("phrase")).agg(F.max("a").alias("covered"))
    kept = parts.join(covers, ["lang", "phrase"], "left").filter("covered is null or covered < a")
    cuts = kept.select("lang", "phrase", "a", "words", "length", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.concat_ws(" ", F.slice("words", F.lit(1), F.col("k"))).alias("head"),
        F.concat_ws(" ", F.slice("words", F.col("k") + 1, F.col("length") - F.col("k"))).alias("tail"),
    )
    of = counted.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    cuts = lookup_join(cuts, of, ["lang", "head"], None, ["phrase", "k"])
    cuts = lookup_join(cuts, of.select("lang", F.col("head").alias("tail"), F.col("l").alias("r")), ["lang", "tail"], None, ["phrase", "k"])
    scored = sized_join(cuts, sizes, ["lang"])
    # Exact: products of up to 38 digits, and a division of whole numbers.
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")}
    above, below = F.lit(1000).cast("decimal(38,0)") * wide["a"] * wide["n"], wide["l"] * wide["r"]
    scored = scored.withColumn("above", above).withColumn("below", below).withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    best = best.select("lang", "phrase", "a", "n", "best.score", "best.l", "best.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
