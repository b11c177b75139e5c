"""Registry of named queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (or data Spark derives from them) so its
work grows with the tables; none runs on fixed inline input alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import views as V
from .star import Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("fact_post")
def q_fact_post(spark, sf_dir):
    s = Star(spark, sf_dir)
    posts = s.posts()
    return V.fact_post(posts, s.profiles(), s.dim_time(), s.gold())


@query("profile_stats")
def q_profile_stats(spark, sf_dir):
    s = Star(spark, sf_dir)
    return V.profile_stats(s.posts(), s.profiles())


# Query modules register themselves on import.
from . import q_silver, q_gold, q_plan, q_enrich, q_media, q_graph  # noqa: E402,F401
