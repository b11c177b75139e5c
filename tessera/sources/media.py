"""Media inventory (S7, S8, F11): list media files per (dataset, post) from
storage metadata only; the bytes are never read or copied.

Layout: ``<root>/<dataset_id>/<post_id>/<file name>``. Folders on a mounted
file system are listed by the executors, each its share, so neither the files
nor the tasks that list them grow on the driver. Other stores are listed
through Spark's file index, which the driver holds."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import media as M
from ..session import local_path

ROWS = 4096  # entries sent at once
ENTRY_DDL = "path binary, length long"  # a folder has no length


def _passed_over(name: bytes) -> bool:
    """Names that Spark's file sources do not read."""
    return name.startswith(b".") or name.endswith(b"._COPYING_") or (name.startswith(b"_") and b"=" not in name)


def _entries(folder: bytes, deep: bool) -> Iterator[tuple[bytes, int | None]]:
    """Files (path, length) and folders (path, None) in a folder; with ``deep``
    the files of its folders instead of these. Empty files are no media, as for
    Spark's file sources."""
    try:
        with os.scandir(folder) as found:
            for e in found:
                if _passed_over(e.name):
                    continue
                if not e.is_dir():
                    if n := e.stat().st_size:
                        yield e.path, n
                elif deep:
                    yield from _entries(e.path, True)
                else:
                    yield e.path, None
    except FileNotFoundError:  # deleted meanwhile
        return


def _opened(entries: DataFrame, deep: bool) -> DataFrame:
    """``entries`` with what is in its folders in their place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple[bytes, int | None]]:
            for batch in batches:
                for path, n in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                    if n is None:
                        yield from _entries(path, deep)
                    else:
                        yield path, n

        def made(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())], names=["path", "length"])

        rows: list = []
        for r in each():
            rows.append(r)
            if len(rows) == ROWS:
                yield made(rows)
                rows = []
        if rows:
            yield made(rows)

    return entries.mapInArrow(run, ENTRY_DDL)


def _walked(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the files in a mounted folder: one task lists its
    datasets, then the tasks share out these, then the posts' folders."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = spark.createDataFrame([(bytearray(os.fsencode(folder)), None)], ENTRY_DDL)
    datasets = _opened(top.coalesce(1), False).repartition(parts, "path")
    return _opened(_opened(datasets, False).repartition(parts, "path"), True).select(F.col("path").cast("string").alias("path"), "length")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(source_dataset, post_id, file_name, size) for every regular file that is
    not empty, whether the executors list them or the binaryFile source, which
    reads no bytes where ``content`` is not selected."""
    mounted = local_path(spark, root)
    if mounted is not None and os.path.isdir(mounted):
        files = _walked(spark, mounted)
    else:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(root).select("path", "length"))
    rel = F.regexp_extract("path", r"([^/]+)/([^/]+)/([^/]+)$", 0)
    parts = F.split(rel, "/")
    return files.select(parts[0].alias("source_dataset"), parts[1].alias("post_id"),
                        parts[2].alias("file_name"), F.col("length").alias("size"))


def manifest(files: DataFrame) -> DataFrame:
    """Supported files per post, sorted by name (F11 filter). A post's
    group is bounded by its own media count."""
    ok = files.filter(M.is_supported(F.col("file_name")))
    return ok.groupBy("source_dataset", "post_id").agg(
        F.array_sort(F.collect_list("file_name")).alias("media_files")) \
        .withColumn("media_count", F.size("media_files"))
