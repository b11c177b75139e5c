"""Access to the driver's Parquet tables.

Reads are lazy: Catalyst prunes columns and pushes filters into each scan,
so callers select only what they need.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .session import configure

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


class Catalog:
    """Lazy table handles for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)
