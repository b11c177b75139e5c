"""Bounded samples of labelled documents, shared by the classifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import fold, texts


#: Documents of more characters than this are not sampled, which bounds the sample in bytes.
LONGEST = 1 << 16


def sample(documents: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """(doc_id, y, text) of at most ``rows`` labelled documents outside the
    held-out fold, the ones of smallest id hash. A document labelled more than
    once is positive if any row says so; null labels and ids are no labels. An
    id that several documents carry stands for that of smallest text hash, so
    there are at most ``rows`` documents, of at most ``LONGEST`` characters.
    The chosen ids (16 bytes each, ``rows`` at most) are broadcast, so the
    documents are read without a shuffle; only the sample is."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")) \
        .filter("doc_id is not null and y is not null").filter(fold(F.col("doc_id"), folds) != held)
    some = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = texts(documents).filter(F.length("text") <= LONGEST).join(F.broadcast(some), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def collect(df: DataFrame, make: Callable, schema: str):
    """The sample turned into features by ``make`` on the executors, as one
    pandas frame in doc_id order; its size is bounded by the sample's."""
    return df.mapInArrow(make, schema).toPandas().sort_values(["doc_id"], kind="stable").reset_index(drop=True)
