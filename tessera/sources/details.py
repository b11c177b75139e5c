"""Profile-details records (S13): an NDJSON export, one object a line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import py_strip
from ..operators.dims import DETAILS_TYPE


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """The records of the files at ``path`` (columns of DETAILS_TYPE), with
    ``line_no``, the order of the lines. Blank lines are passed over; a line
    that is no JSON fails the import, and so does a path that does not exist."""
    lines = spark.read.text(path).select(
        py_strip(F.col("value")).alias("value"),
        F.struct(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"),
                 F.monotonically_increasing_id()).alias("line_no"))
    parsed = lines.filter(F.col("value") != "").select(F.parse_json("value").alias("v"), "line_no")
    return parsed.select(F.variant_get("v", "$", DETAILS_TYPE).alias("r"), "line_no").select("r.*", "line_no")
