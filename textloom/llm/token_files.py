"""Flat files of token ids with 64-bit document offsets.

A folder holds, per partition, ``<part>.ids`` (unsigned integers, 16 or 32 bits, little-endian,
documents one after another), ``<part>.off`` (64-bit offsets in ids: documents + 1 values, from 0)
and ``<part>.doc`` (64-bit document ids), and one ``manifest.json``. Partitions follow the order of
document ids; the base of each is the prefix sum of the sizes before it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import scratch
from textloom.llm.store import RangeReader, create, keep_only, make_folder, open_store
from textloom.llm.tokens import encoder

# What stands for a NULL document id in the files: the smallest 64-bit integer.
NULL_ID = -(1 << 63)
PART = "part long, file string, n_docs long, n_tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text", width: int = 16
) -> dict:
    """Encode every whole text, append ``end_id``, and write ids in ascending id order; returns the manifest.

    ``tokenizer`` is a file of the tokenizers library on every executor. ``width`` is 16 or 32 bits: an id that
    does not fit 16 bits fails the task. Rows are dealt out by ranges of the id and of the text's hash, so
    that many rows with one id are shared out too; rows with equal ids stand in the order of their hash. A NULL
    text is empty, a NULL id comes first (``NULL_ID``), an empty table gives no partition. Only the partitions'
    sizes reach the driver. A repeated or lost task attempt writes files of its own; those that the finished
    attempts did not report are removed.
    """
    kind = {16: "<u2", 32: "<u4"}[width]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        files, total, sizes, ids = {}, 0, 0, []
        for batch in batches:
            if not files:
                files = {k: create(folder, f"{name}.{k}") for k in ("ids", "off", "doc")}
                files["off"].write(np.zeros(1, "<u8").tobytes())
            docs_of = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8")
            ends = np.zeros(batch.num_rows, "<u8")
            for i, text in enumerate(batch.column(1)):
                found = np.frombuffer(encode(text.as_py()), "<u4")
                if width == 16 and (end_id > 0xFFFF or len(found) and int(found.max()) > 0xFFFF):
                    raise ValueError("an id needs more than 16 bits: write with width=32")
                ids.append(found.astype(kind).tobytes())
                ids.append(np.array([end_id], kind).tobytes())
                total += len(found) + 1
                ends[i] = total
                if len(ids) >= 2048:
                    files["ids"].write(b"".join(ids))
                    ids = []
            sizes += batch.num_rows
            files["off"].write(ends.tobytes())
            files["doc"].write(docs_of.tobytes())
        if files:
            files["ids"].write(b"".join(ids))
            for f in files.values():
                f.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([task.partitionId()]), "file": pa.array([name]), "n_docs": pa.array([sizes]), "n_tokens": pa.array([total])}
            )

    make_folder(folder)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("binary").alias("_text"))
    rows = rows.withColumn("_hash", F.xxhash64("_text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, F.asc_nulls_first("_id"), "_hash").sortWithinPartitions(F.asc_nulls_first("_id"), "_hash")
    parts = sorted(dealt.select("_id", "_text").mapInArrow(write, PART).collect())
    keep_only(folder, {f"{p['file']}.{k}" for p in parts for k in ("ids", "off", "doc")})
    bases = np.concatenate([[0], np.cumsum([p["n_tokens"] for p in parts], dtype="u8")]).astype("u8").tolist()
    listed = [
        {"file": p["file"], "n_docs": p["n_docs"], "n_tokens": p["n_tokens"], "base": base} for p, base in zip(parts, bases, strict=False)
    ]
    manifest = {"width": width, "n_tokens": bases[-1], "parts": listed}
    with create(folder, "manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> dict:
    fs, path = open_store(folder)
    with fs.open_input_stream(f"{path}/manifest.json") as f:
        return json.loads(f.read())


def documents_in(folder: str, part: dict, width: int, block: int = 65536) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, global start, ids) of each document of a partition, from the memory-mapped files, ``block`` offsets at a time."""
    kind = np.dtype({16: "<u2", 32: "<u4"}[width])
    ids, off, doc = (RangeReader(folder, f"{part['file']}.{k}") for k in ("ids", "off", "doc"))
    for at in range(0, part["n_docs"], block):
        n = min(block, part["n_docs"] - at)
        bounds = np.frombuffer(off.read(8 * at, 8 * (n + 1)), "<u8").astype("i8")
        names = np.frombuffer(doc.read(8 * at, 8 * n), "<i8")
        for name, lo, hi in zip(names.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            found = np.frombuffer(ids.read(lo * kind.itemsize, (hi - lo) * kind.itemsize), kind)
            yield (None if name == NULL_ID else name), part["base"] + lo, found


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document: its id, first position among all ids, number of ids, and their CRC-32 as 32-bit ids."""
    manifest = read_manifest(folder)
    width = manifest["width"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                rows: list[tuple] = []
                for name, start, found in documents_in(folder, part, width):
                    rows.append((name, start, len(found), zlib.crc32(found.astype("<u4").tobytes())))
                    if len(rows) == 16384:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    columns = "file string, n_docs long, n_tokens long, base long"
    parts = [(p["file"], p["n_docs"], p["n_tokens"], p["base"]) for p in manifest["parts"]]
    table = spark.createDataFrame(parts, columns)
    return table.repartition(max(1, len(parts)), "file").mapInArrow(read, ROWS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 4
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_file_rows(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the files into a new shared folder and read them back."""
    folder = scratch(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(docs.sparkSession, folder)
