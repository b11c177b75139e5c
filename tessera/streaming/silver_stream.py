"""Bronze -> silver as a Structured Streaming job.

New bronze files are picked up by the file source; each micro-batch is
parsed, deduplicated and upserted with ``foreachBatch`` (same operators as
the batch job). Files may come in any order: a row replaces a stored one only
if its line is not the older of the two in write order (dataset order, file,
position), so the result is that of one batch run over all files. Each file's
rows are counted once, under its name, in a table bucketed by dataset; a
dataset is recorded as complete when all its published files have been counted.
A batch lists the folders and reads the counts of its own datasets, whatever
bronze holds besides. The stream's checkpoint lives in shared storage, so a
restarted driver resumes where it stopped; a replayed micro-batch rewrites the
same rows.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import silver as S
from ..operators.upsert import record_progress
from ..session import cut_lineage
from ..sources import bronze as B


def _file_key(dataset: Column, name: Column) -> Column:
    return F.concat(dataset, F.lit("/"), name)


def run(med, as_of: Column, checkpoint: str | None = None, files_per_batch: int | None = None,
        newest_first: bool = False, media: DataFrame | None = None):
    """Process every bronze file available now, then stop. Returns the query."""
    spark = med.spark
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true").option("latestFirst", newest_first)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(os.path.join(med.bronze, "dataset_id=*")).select("value", "_metadata")

    def complete_datasets(listing: DataFrame) -> DataFrame:
        """Post counts of the listed datasets whose files are all counted."""
        files = listing.filter("length > 0").select(
            F.col("dataset_id").alias("source_dataset"), _file_key(F.col("dataset_id"), F.col("file_name")).alias("file_key"))
        counted = med.stream_files.read_near(files).select("file_key", "post_count")
        seen = files.join(counted, "file_key", "left")
        return (seen.groupBy("source_dataset").agg(F.sum("post_count").alias("post_count"), F.bool_and(F.col("post_count").isNotNull()).alias("all"))
                .filter("all").drop("all"))

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        path = F.col("_metadata.file_path")
        files = cut_lineage(batch.select(B.dataset_of_path(path).alias("source_dataset"), F.col("_metadata.file_name").alias("file_name"),
                                         F.regexp_extract(path, r"^(.*/dataset_id=[^/]+)/", 1).alias("folder")).distinct())
        # The folders of this batch's datasets; the file source holds its files' paths too.
        folders = [unquote(r[0]) for r in files.select("folder").distinct().collect()]
        if not folders:
            return
        listing = cut_lineage(B.listing(spark, med.bronze, folders))
        # Broadcast: one row a dataset of this batch; a shuffle by dataset would bring its lines to one task.
        lines = B.lines_of(batch).join(F.broadcast(B.order_times(listing, med.bronze)), "dataset_id")
        good, _ = S.parse(lines)
        rows = cut_lineage(S.normalise(good))
        if rows.take(1):
            med.silver.upsert(S.attach_media(S.latest_per_key(rows), media), as_of=as_of, order="_order")
        counts = rows.groupBy("source_dataset", F.col("_order.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("post_count"))
        counted = files.join(counts, ["source_dataset", "file_name"], "left").select(
            "source_dataset", _file_key(F.col("source_dataset"), F.col("file_name")).alias("file_key"),
            F.coalesce("post_count", F.lit(0)).alias("post_count"))
        med.stream_files.upsert(cut_lineage(counted), as_of=as_of, keep_first=())
        done = complete_datasets(listing)
        if med.progress() is not None:
            done = done.join(med.progress().select("source_dataset"), "source_dataset", "left_anti")
        done = cut_lineage(done)
        if done.take(1):
            record_progress(med.completed, done, as_of)

    q = (stream.writeStream.foreachBatch(upsert)
         .option("checkpointLocation", checkpoint or os.path.join(med.root, "_stream_ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
