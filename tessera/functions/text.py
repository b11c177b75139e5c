"""String column functions: trimming, truncation, engagement-bait detection,
profile URLs, term normalisation. All built-in Spark expressions (codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference behaviour) -------------------
# Engagement-bait patterns, alternated and matched case-insensitively.
BAIT_PATTERNS = [
    r"\bcomment\s+\w+",
    r"\bDM\s+(me\s+)?\w+",
    r"\bDM\b",
    r"\blink\s+in\s+bio\b",
    r"\bcheck\s+(my|the)\s+link\b",
    r"\bdrop\s+a\s+\w+\s+below\b",
    r"\bmessage\s+me\b",
]
CAPTION_MAX_CHARS = 5000
PROFILE_URL_PREFIX = "https://www.instagram.com/"
# ---------------------------------------------------------------------------

# Python's \b \w \s are Unicode-aware; Java needs (?U) for the same classes.
# Every pattern starts with \b; testing it once before the alternation is the
# same search and about twice as fast on long captions.
assert all(p.startswith(r"\b") for p in BAIT_PATTERNS)
BAIT_REGEX = "(?iU)\\b(?:" + "|".join(p[2:] for p in BAIT_PATTERNS) + ")"


def py_strip(c: Column) -> Column:
    """str.strip(): remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def truncate_chars(c: Column, n: int = CAPTION_MAX_CHARS) -> Column:
    """First n characters (code points), like a Python slice."""
    return F.substring(c, 1, n)


def engagement_bait(caption: Column) -> Column:
    """True when the full (untruncated) caption contains a bait phrase."""
    return F.coalesce(caption, F.lit("")).rlike(BAIT_REGEX)


def profile_url(username: Column) -> Column:
    """Username or profile URL -> canonical profile URL (last path segment)."""
    stripped = F.regexp_replace(F.trim(username), r"^/+|/+$", "")
    return F.concat(F.lit(PROFILE_URL_PREFIX),
                    F.element_at(F.split(stripped, "/"), -1), F.lit("/"))


def normalise_term(c: Column) -> Column:
    """Exact-dedup key of a taxonomy term: lower + trim."""
    return F.lower(F.trim(c))


def alnum_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9A-Za-z]", "")
