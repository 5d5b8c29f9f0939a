"""News records in SGML-like files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.markup import attributes, raw_tag_text, tag_items, tag_text, unescape
from textloom.functions.text import once

# The record element and the accepted values of its attributes.
RECORD = "REUTERS"
SPLITS = ["TEST", "TRAIN"]


def read_records(spark: SparkSession, path: str, pattern: str = "*.sgm", tag: str = RECORD) -> DataFrame:
    """Cut files into records: (``filename``, ``block``, ``pos``, ``head``, ``content``).

    The closing tag is the line separator, so large files are split between tasks and no
    file is held as a whole. ``block`` and ``pos`` order the records of a file. Files are
    Latin-1; a record ends with its closing tag, which the last record of a file must have.
    """
    reader = spark.read.option("lineSep", f"</{tag}>").option("pathGlobFilter", pattern)
    chunks = reader.text(path).select(
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("chunk"),
    )
    return split_record(chunks, "chunk", tag).drop("chunk")


def split_record(df: DataFrame, text: str, tag: str = RECORD) -> DataFrame:
    """Keep rows whose text opens a record, with its ``head`` (attributes) and ``content``."""
    pattern = rf"(?s)<{tag}\b([^>]*)>(.*?)(?:</{tag}>|\z)"
    opened = df.filter(F.col(text).rlike(rf"<{tag}\b[^>]*>"))
    return opened.withColumn("head", F.regexp_extract(text, pattern, 1)).withColumn(
        "content", F.regexp_extract(text, pattern, 2)
    )



def labelled_records(records: DataFrame) -> DataFrame:
    """Records with topics of a known split: head and content turned into columns."""
    values = once(records, "_values", attributes(F.col("head")))
    kept = values.filter((F.col("_values")["topics"] == "YES") & F.col("_values")["lewissplit"].isin(SPLITS))
    body = once(kept, "body_text", tag_text("content", "BODY"))
    others = [c for c in records.columns if c not in ("head", "content")]
    return body.select(
        *others,
        F.col("_values")["topics"].alias("topics_present"),
        F.col("_values")["lewissplit"].alias("lewissplit"),
        F.array_join(tag_items(tag_text("content", "TOPICS")), ",").alias("topics"),
        "body_text",
    )


def number_records(records: DataFrame, file: str = "filename", block: str = "block", pos: str = "pos") -> DataFrame:
    """Add ``record_ix``: 1-based place among the records of the file.

    Places are counted within a block, which has bounded size, and moved up by the records
    of the blocks before it, so a huge file is not numbered by one task.
    """
    within = F.row_number().over(Window.partitionBy(file, block).orderBy(pos)).cast("bigint")
    sizes = records.groupBy(file, block).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(file, block, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    numbered = records.withColumn("_within", within).join(offsets, [file, block])
    return numbered.withColumn("record_ix", F.col("_before") + F.col("_within")).drop("_within", "_before")


def read_labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Training and test news: (``topics_present``, ``lewissplit``, ``topics``, ``body_text``, ``filename``, ``record_ix``)."""
    numbered = number_records(labelled_records(read_records(spark, folder)))
    return numbered.select("topics_present", "lewissplit", "topics", "body_text", "filename", "record_ix")


def articles(records: DataFrame) -> DataFrame:
    """All records: (``id``, ``text``, ``topics``); a missing body is an empty text, and nothing is stripped."""
    body = unescape(F.coalesce(raw_tag_text("content", "BODY"), F.lit("")), keep_controls=True)
    listed = tag_items(raw_tag_text("content", "TOPICS"))
    return records.select(
        attributes(F.col("head"))["newid"].alias("id"),
        body.alias("text"),
        F.transform(listed, lambda t: unescape(t, keep_controls=True)).alias("topics"),
    )


def read_articles(spark: SparkSession, folder: str) -> DataFrame:
    return articles(read_records(spark, folder))
