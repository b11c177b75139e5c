"""Enrichment hook (E2-E5, E7, E8): apply a per-post function to the work queue.

The model call is the reference's one user-code hook, so this is the one
place where per-row Python runs: ``mapInPandas`` over a hash-partitioned
queue. ``partitions`` is the number of callers at a time; a caller that must
keep to a request budget does so in its own function. Speculation must stay
off so a post is never sent twice; results are checkpointed before they are
merged into gold (idempotent upsert)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# ---- fixed values (must equal the reference behaviour) -------------------
MAX_ATTEMPTS = 4
FAILURE_ERROR = "gemini_failed"
# ---------------------------------------------------------------------------

COLUMNS = ["post_id", "status", "result_json", "error", "attempts"]
RESULT_SCHEMA = "post_id string, status string, result_json string, error string, attempts int"


class RateLimited(Exception):
    """The model refused for quota reasons (HTTP 429)."""


class Unavailable(Exception):
    """The model was unavailable or timed out (HTTP 503 / timeout)."""


def attempt(fn: Callable[[dict], str], post: dict) -> tuple[dict | None, int]:
    """(parsed result or None, attempts): quota, outage and bad JSON are tried
    again, any other error is final."""
    for n in range(1, MAX_ATTEMPTS + 1):
        try:
            return json.loads(fn({**post, "_attempt": n})), n
        except (RateLimited, Unavailable, TimeoutError, json.JSONDecodeError):
            continue
        except Exception:  # noqa: BLE001 - the hook's own failure: this post fails, the run goes on
            return None, n
    return None, MAX_ATTEMPTS


def enrich(queue: DataFrame, enricher: Callable[[dict], str], *, partitions: int,
           columns: tuple[str, ...] = ("post_id", "url", "caption", "media")) -> DataFrame:
    """Run ``enricher(post_dict) -> JSON text`` on every queued post."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for post in pdf.to_dict("records"):
                if post.get("media") is not None:
                    post["media"] = list(post["media"])
                result, n = attempt(enricher, post)
                done = result is not None
                out.append((post["post_id"], "analysed" if done else "failed",
                            json.dumps(result, ensure_ascii=False) if done else None,
                            None if done else FAILURE_ERROR, n))
            yield pd.DataFrame(out, columns=COLUMNS)

    # Checkpointed: a recomputation (lost executor, second consumer) must not
    # call the model again.
    return cut_lineage(queue.select(*columns).repartition(partitions, "post_id").mapInPandas(run, RESULT_SCHEMA))


def summary(results: DataFrame) -> DataFrame:
    """Counts per status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("posts"))
