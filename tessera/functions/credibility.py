"""Two-character credibility code: source reliability A-F x information
credibility 1-6."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference behaviour) -------------------
SOURCE_LABELS = {
    "A": "Practitioner",
    "B": "Expert",
    "C": "Curator",
    "D": "Unknown",
    "E": "Engagement baiter",
    "F": "Cannot assess",
}
INFORMATION_LABELS = {
    "1": "Demonstrated",
    "2": "Probably true",
    "3": "Possibly true",
    "4": "Opinion",
    "5": "Improbable",
    "6": "Cannot assess",
}
HIGH_CONFIDENCE = ["A1", "A2", "B1", "B2"]
CODE_PATTERN = "^[A-F][1-6]$"
# ---------------------------------------------------------------------------


def _lookup(d: dict, key: Column) -> Column:
    m = F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, key)


def is_valid(code: Column) -> Column:
    return F.coalesce(code.rlike(CODE_PATTERN), F.lit(False))


def source_label(code: Column) -> Column:
    return F.when(is_valid(code), _lookup(SOURCE_LABELS, F.substring(code, 1, 1)))


def information_label(code: Column) -> Column:
    return F.when(is_valid(code), _lookup(INFORMATION_LABELS, F.substring(code, 2, 1)))


def is_high_confidence(code: Column) -> Column:
    return F.coalesce(code.isin(HIGH_CONFIDENCE), F.lit(False))
