"""Bronze layer: land raw NDJSON datasets, keep an ingest manifest, discover
and scan datasets tolerantly (S1-S4, S6, S16 input).

Layout under a bronze root (a folder in shared storage):

    <root>/dataset_id=<id>/landing=<uuid>/part-*.txt   one JSON object per line
    <root>/_manifest/     Parquet: dataset_id, landing, run_id, actor,
                          item_count, downloaded_at

The manifest is written last: a landing it does not name is the remains of a
failed run and is never read. Folders without a landing (files put there by
other tools) and a flat ``<root>/<id>.jsonl`` layout are read as they are.
Dataset ids are taken from the path as text, so 007, 7 and 1e3 stay apart.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import py_strip
from ..schemas import MANIFEST_DDL, checked
from ..session import read_if_present

def manifest_path(root: str) -> str:
    return os.path.join(root, "_manifest")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_present(lambda: spark.read.schema(MANIFEST_DDL).parquet(manifest_path(root)))
    return spark.createDataFrame([], MANIFEST_DDL) if found is None else found


def dataset_of_path(path: Column) -> Column:
    """Dataset id of a file: the (escaped) folder name, else the flat file's."""
    folder = F.regexp_extract(path, r"/dataset_id=([^/]+)/", 1)
    flat = F.regexp_extract(path, r"([^/]+)\.jsonl$", 1)
    raw = F.when(folder != "", folder).otherwise(flat)
    return F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def landing_of_path(path: Column) -> Column:
    return F.regexp_extract(path, r"/landing=([^/]+)/", 1)


def write_landing(lines: DataFrame, root: str, order_by: str | None = None) -> str:
    """Write the lines of datasets that the manifest does not know; returns the landing."""
    spark = lines.sparkSession
    # Broadcast: the known ids among this run's datasets, each a folder; a shuffle by dataset would move every line to a few tasks.
    known = read_manifest(spark, root).select("dataset_id").distinct().join(lines.select("dataset_id").distinct(), "dataset_id", "left_semi")
    new = lines.join(F.broadcast(known), "dataset_id", "left_anti")
    order = [F.col("dataset_id")] + ([F.col(order_by)] if order_by else [])
    landing = uuid.uuid4().hex
    # No partition count: AQE joins neighbouring ranges, so the files follow the bytes.
    (new.repartitionByRange(*order).sortWithinPartitions(*order)
     .select("dataset_id", F.lit(landing).alias("landing"), F.col("line").alias("value"))
     .write.mode("append").partitionBy("dataset_id", "landing").text(root))
    return landing


def land(lines: DataFrame, root: str, *, run_id: str = "", actor: str = "",
         downloaded_at: F.Column | None = None, order_by: str | None = None) -> DataFrame:
    """Idempotently land datasets (S4): ``lines`` has (dataset_id, line[,
    order_by]). Datasets already in the manifest are skipped; new ones are
    written one object per line, then recorded in the manifest with the count
    of non-blank lines written. Returns (dataset_id, item_count, skipped).

    Rows are range-partitioned by (dataset_id, order), so each task writes one
    contiguous slice and the file names preserve line order."""
    spark = lines.sparkSession
    landing = write_landing(lines, root, order_by)
    written = read_if_present(lambda: spark.read.text(os.path.join(root, "dataset_id=*", f"landing={landing}")))
    if written is not None:
        ts = downloaded_at if downloaded_at is not None else F.localtimestamp()
        counts = written.select(dataset_of_path(F.col("_metadata.file_path")).alias("dataset_id"), "value") \
            .groupBy("dataset_id").agg(F.count_if(py_strip(F.col("value")) != "").alias("item_count"))
        rows = counts.select("dataset_id", F.lit(landing).alias("landing"), F.lit(run_id).alias("run_id"),
                      F.lit(actor).alias("actor"), F.col("item_count").cast("bigint").alias("item_count"),
                      ts.cast("timestamp_ntz").alias("downloaded_at"))
        checked(rows, MANIFEST_DDL).coalesce(1).write.mode("append").parquet(manifest_path(root))
    known = read_manifest(spark, root).select("dataset_id", "landing", "item_count")
    return (lines.select("dataset_id").distinct().join(known, "dataset_id", "left")
            .select("dataset_id", "item_count", (F.col("landing") != landing).alias("skipped")))


def json_array_lines(payload: DataFrame) -> DataFrame:
    """S3: (dataset_id, value) with a JSON array in ``value`` -> one compact JSON object per line."""
    return payload.select("dataset_id", F.explode(F.from_json("value", "array<variant>")).alias("v")) \
        .select("dataset_id", F.to_json("v").alias("line"))


def listing(spark: SparkSession, root: str, folders: list[str] | None = None) -> DataFrame:
    """Published files (dataset_id, path, file_name, length, file_mtime), of the given
    dataset folders only where some are given, without reading contents: the binaryFile
    source skips the bytes when ``content`` is not selected."""
    def files(*where: str, glob: str = "*"):
        return read_if_present(lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                               .option("pathGlobFilter", glob).load(list(where)))
    found = files(*(folders or [os.path.join(root, "dataset_id=*")]))
    if found is None and not folders:
        found = files(root, glob="*.jsonl")
    if found is None:
        return spark.createDataFrame([], "dataset_id string, path string, file_name string, length long, file_mtime timestamp_ntz")
    found = found.select(dataset_of_path(F.col("path")).alias("dataset_id"), landing_of_path(F.col("path")).alias("landing"), "path",
                         F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "length",
                         F.col("modificationTime").cast("timestamp_ntz").alias("file_mtime"))
    published = read_manifest(spark, root).select("dataset_id", "landing").distinct()
    landed = found.filter("landing != ''").join(published, ["dataset_id", "landing"], "left_semi")
    return landed.unionByName(found.filter("landing = ''")).drop("landing")


def order_times(files: DataFrame, root: str) -> DataFrame:
    """(dataset_id, ds_order_ts): the manifest's downloaded_at, else the oldest file's time."""
    first = files.groupBy("dataset_id").agg(F.min("file_mtime").alias("mtime"))
    landed = read_manifest(files.sparkSession, root).groupBy("dataset_id").agg(F.min("downloaded_at").alias("downloaded_at"))
    return first.join(landed, "dataset_id", "left").select(
        "dataset_id", F.coalesce("downloaded_at", "mtime").alias("ds_order_ts"))


def discover(spark: SparkSession, root: str, progress: DataFrame | None) -> DataFrame:
    """Datasets present in bronze minus those already completed, with
    their order timestamp."""
    found = order_times(listing(spark, root), root)
    if progress is not None:
        found = found.join(progress.select(F.col("source_dataset").alias("dataset_id")),
                           "dataset_id", "left_anti")
    return found


def lines_of(raw: DataFrame) -> DataFrame:
    """Non-blank lines with their position, from a text scan or micro-batch.

    Columns: dataset_id, line (stripped), file_name, block_start, row_id.
    (block_start, row_id) are taken in the scan projection, before any shuffle,
    so they give the line order inside each file (D5)."""
    return (raw.select(
        dataset_of_path(F.col("_metadata.file_path")).alias("dataset_id"),
        py_strip(F.col("value")).alias("line"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"))
        .filter(F.col("line") != ""))


def scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of the given files; nothing else is opened."""
    return lines_of(spark.read.text(paths))


def target_list(spark: SparkSession, path: str) -> DataFrame:
    """One username/URL per line, stripped, blanks dropped."""
    t = spark.read.text(path).select(py_strip(F.col("value")).alias("target"))
    return t.filter(F.col("target") != "")
