"""Registered queries: media inventory and selection (S7, S8, F11, P18-P20,
W5) and the streaming silver job (S16)."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions import media as M
from ..session import cut_lineage, local_path, shared_path
from ..sources import media as SM
from ..streaming import silver_stream
from .medallion import N_DATASETS, Medallion, land_events, silver_view
from .registry import query
from .q_silver import RUN1_AT, _ts


def _media_files(cat, prefix="ds-", datasets=2):
    """One media file per conversation turn (extension by role, some upper
    case), plus per conversation video.mp4 (2 turns), image.jpg (3 turns) or
    an unsupported notes.txt."""
    c = cat.conversations.select("conv_id", "turn", "role", "text")
    ext = (F.when(F.col("role") == "user",
                  F.when(F.pmod("turn", F.lit(2)) == 0, "jpg").otherwise("JPG"))
           .when(F.col("role") == "assistant", "mp4").otherwise("txt"))
    turns = c.select("conv_id", F.format_string("media_%02d.%s", F.col("turn"), ext)
                     .alias("file_name"), F.col("text").alias("content"))
    n = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("content"))
    extra = n.select("conv_id", F.when(F.col("n") == 2, "video.mp4")
                     .when(F.col("n") == 3, "image.jpg").otherwise("notes.txt")
                     .alias("file_name"), "content")
    files = turns.unionByName(extra)
    return files.withColumn("source_dataset",
                            F.concat(F.lit(prefix), F.pmod("conv_id", F.lit(datasets)).cast("string")))


def _land_media(spark, cat, *dataset):
    """Write the media fixture files (executors write their own rows)."""
    root = shared_path(spark, "media")
    top = local_path(spark, root)
    if top is None:
        raise RuntimeError("media files are written with plain file I/O: spark.checkpoint.dir must be a mounted folder")

    def write(batches):
        made = None
        for batch in batches:
            for r in batch.to_pylist():
                d = os.path.join(top, r["source_dataset"], str(r["conv_id"]))
                if d != made:
                    os.makedirs(d, exist_ok=True)
                    made = d
                with open(os.path.join(d, r["file_name"]), "wb") as fh:
                    fh.write((r["content"] or "").encode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    _media_files(cat, *dataset).mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return root


@query("media_inventory")
def q_media_inventory(spark, sf_dir):
    root = _land_media(spark, Catalog(spark, sf_dir))
    return SM.manifest(SM.listing(spark, root))


@query("mime_types")
def q_mime_types(spark, sf_dir):
    root = _land_media(spark, Catalog(spark, sf_dir))
    f = SM.listing(spark, root)
    return f.select("source_dataset", "post_id", "file_name",
                    M.mime_type(F.col("file_name")).alias("mime_type"),
                    M.is_video(F.col("file_name")).alias("is_video"))


@query("media_selection")
def q_media_selection(spark, sf_dir):
    """W5 with the slide cap at 4 (fixture conversations have <= 8 turns)."""
    root = _land_media(spark, Catalog(spark, sf_dir))
    names = SM.listing(spark, root).groupBy("source_dataset", "post_id") \
        .agg(F.collect_list("file_name").alias("names"))
    sel = M.select_media(F.col("names"), max_slides=4)
    return names.select("source_dataset", "post_id", sel.alias("media")) \
        .select("source_dataset", "post_id", "media",
                M.video_subset(F.col("media")).alias("videos"),
                M.media_type_label(F.col("media")).alias("media_type"))


def _media_of_posts(spark, cat):
    """The manifest of media landed in the events' own dataset folders (post id =
    conversation id), listed once: the silver runs may read it several times."""
    return cut_lineage(SM.manifest(SM.listing(spark, _land_media(spark, cat, "ds", N_DATASETS))))


@query("silver_with_media")
def q_silver_with_media(spark, sf_dir):
    """The silver run with a media manifest: a post gets the files of its own dataset."""
    cat = Catalog(spark, sf_dir)
    m = Medallion(spark)
    land_events(spark, cat, root=m.bronze)
    m.deduplicate_all(_ts(RUN1_AT), media=_media_of_posts(spark, cat))
    return silver_view(m.silver_posts())


@query("stream_silver_with_media")
def q_stream_silver_with_media(spark, sf_dir):
    cat = Catalog(spark, sf_dir)
    m = Medallion(spark)
    land_events(spark, cat, root=m.bronze)
    silver_stream.run(m, _ts(RUN1_AT), media=_media_of_posts(spark, cat))
    return silver_view(m.silver_posts())


@query("stream_silver")
def q_stream_silver(spark, sf_dir):
    m = Medallion(spark)
    land_events(spark, Catalog(spark, sf_dir), root=m.bronze)
    silver_stream.run(m, _ts(RUN1_AT))
    return silver_view(m.silver_posts())


@query("stream_progress_counts")
def q_stream_progress_counts(spark, sf_dir):
    """One file per micro-batch: still one progress row a dataset, complete
    only with its last file."""
    m = Medallion(spark, buckets=2)
    land_events(spark, Catalog(spark, sf_dir), root=m.bronze)
    silver_stream.run(m, _ts(RUN1_AT), files_per_batch=1)
    return m.progress().select("source_dataset", "post_count", "completed_at")


@query("stream_silver_newest_first")
def q_stream_silver_newest_first(spark, sf_dir):
    """One file per micro-batch, the newest first: older lines come in later
    batches and replace nothing newer."""
    m = Medallion(spark, buckets=2)
    land_events(spark, Catalog(spark, sf_dir), root=m.bronze)
    silver_stream.run(m, _ts(RUN1_AT), files_per_batch=1, newest_first=True)
    return silver_view(m.silver_posts())
