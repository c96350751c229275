"""Landed list files: ``<landing>/source=<name>/<any file>``."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievelake.functions.text import split_line
from sievelake.tables import folders

LANDED = "value STRING, source STRING"
ARRIVED = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY, source STRING"
PATTERN_SIGN = re.compile(r"([{}\[\]*?\\])")


@dataclass(frozen=True)
class Lists:
    """Landed lists.

    ``documents`` has one row per file: source, path, content_length (characters) and
    fetch_metadata. ``lines`` has their numbered lines: source, path, line_number, line
    and the fetch_metadata of the file. Both read ``starts``, a folder with a short row per
    split.
    """

    documents: DataFrame
    lines: DataFrame
    starts: str


def _pieces(spark: SparkSession, landing: str, only: Sequence[str] | None = None) -> DataFrame:
    """Lines with the file split they start in and an id that grows in file order.

    The scan ends lines at line feeds; the other, rare line breaks are split afterwards.
    """
    return (
        spark.read.schema(LANDED)
        .option("lineSep", "\n")
        .option("basePath", landing)
        .text(landing if only is None else [PATTERN_SIGN.sub(r"\\\1", path) for path in only])
        .select(
            "source",
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("file_size"),
            "value",
            F.posexplode(split_line(F.col("value"))).alias("piece", "line"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )


def _empty_files(spark: SparkSession, landing: str, only: Sequence[str] | None) -> DataFrame:
    """Files without content, which a scan leaves out, from the folder listing."""
    found = folders.glob(spark, f"{landing}/source=*/*", empty=True)
    empty = [(path,) for path in found if only is None or path in only]
    return spark.createDataFrame(empty, "path string").select(
        F.url_decode(F.regexp_extract("path", "/source=([^/]*)/", 1)).alias("source"),
        "path",
        F.lit(0).cast("bigint").alias("content_length"),
    )


def _fetched(files: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Files with their fetch_metadata: the length, and what the manifest knows.

    The manifest is by path, or by source where it has no path. Of rows with the same key
    the greatest counts, so a key that repeats doubles no file.
    """
    if manifest is not None:
        key = "path" if "path" in manifest.columns else "source"
        others = [c for c in manifest.columns if c not in ("path", "source")]
        one = manifest.groupBy(key).agg(F.max(F.struct(*others)).alias("row")).select(key, "row.*")
        files = files.join(one, key, "left")
    names = ["http_status", "content_length", "content_type", "source_url"]
    pairs = [
        x
        for name in names
        if name in files.columns
        for x in (F.lit(name), F.col(name).cast("string"))
    ]
    known = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    others = [name for name in names if name in files.columns and name != "content_length"]
    return files.withColumn("fetch_metadata", known).drop(*others)


def scan_lists(
    spark: SparkSession,
    landing: str,
    manifest: DataFrame | None = None,
    only: Sequence[str] | None = None,
) -> Lists:
    """The lists of a landing folder; files of any size are read in splits.

    A first job counts the lines and characters of every split and writes a small table of
    where each split starts to count, by running totals over the splits of a file. Ids
    grow in file order within a split, so the position in it is the distance from its
    lowest id. Should the session cut the files differently later on, lines have no split
    or leave the range of theirs, and the reading job fails: it never gives fewer lines.

    ``manifest`` (path or source, http_status, content_type, source_url, all text) adds
    what the fetch recorded. ``only`` names the files to read, as ``arrivals`` gives them.
    """
    pieces = _pieces(spark, landing, only)
    # Every line counted with its line feed; the last one of a file may lack it.
    once = F.col("piece") == 0
    counted = pieces.groupBy("source", "path", "block").agg(
        F.min("id").alias("first_id"),
        F.count("*").alias("n"),
        F.sum(F.when(once, F.length("value") + 1)).alias("characters"),
        F.sum(F.when(once, F.octet_length("value") + 1)).alias("bytes"),
        F.max("file_size").alias("file_size"),
    )
    file = Window.partitionBy("path")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    unended = F.when(F.sum("bytes").over(file) > F.col("file_size"), 1).otherwise(0)
    starts_path = folders.scratch(spark, "splits")
    _fetched(
        counted.select(
            "source",
            "path",
            "block",
            "first_id",
            "n",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
            (F.sum("characters").over(file) - unended).alias("content_length"),
        ),
        manifest,
    ).write.parquet(starts_path)
    starts = spark.read.parquet(starts_path)
    documents = (
        starts.filter("block = 0")
        .select("source", "path", "content_length", "fetch_metadata")
        .unionByName(_fetched(_empty_files(spark, landing, only), manifest))
    )
    # Numbers only, one short row per split; the text of the fetch is one row per file.
    splits = starts.select("path", "block", "first_id", "n", "before")
    files = starts.filter("block = 0").select("path", "fetch_metadata")
    position = F.col("id") - F.col("first_id") + 1
    checked = F.when(position.between(1, F.col("n")), position).otherwise(
        F.raise_error(F.lit("list files were cut differently when their lines were counted"))
    )
    lines = (
        pieces.join(splits, ["path", "block"], "left")
        .join(files, "path", "left")
        .select(
            "source",
            "path",
            (F.col("before") + checked).alias("line_number"),
            "line",
            "fetch_metadata",
        )
    )
    return Lists(documents, lines, starts_path)


def arrivals(
    spark: SparkSession, landing: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of landed files: source, path and length. What is in them is not read."""
    reader = spark.readStream.format("binaryFile").schema(ARRIVED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing).select("source", "path", "length")


def document_stream(
    spark: SparkSession, landing: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of whole list files for ``lists.lines``: source, path, content, fetch_metadata.

    One file is one row, which numbers its lines without a second scan; use it for lists
    of ordinary size; ``plans.ingest.stream`` reads files of any size in splits.
    """
    reader = spark.readStream.schema(LANDED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(landing, wholetext=True).select(
        "source",
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("content"),
        F.create_map(F.lit("content_length"), F.length("value").cast("string")).alias(
            "fetch_metadata"
        ),
    )
