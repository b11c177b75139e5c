"""URL filter (op7): rules first, then a blocked Bloom filter of listed
canonical URLs whose possible hits go to an exact hash join.

The filter is a table of ``blocks`` rows, each a block of eight 64-bit words;
a URL sets one bit in every word of one block. Its size is fixed by
``blocks`` (72 bytes a row), however long the list, so it is safe to
broadcast; a list too long for it only lets more URLs through to the join,
which settles each of them. All steps are built-in functions.

Defined cases: a null url, or one without ``://``, has an empty host and
path, fits no rule, is never listed and is allowed; repeated pages keep one
row each; empty tables give empty results; other columns are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import LOWER, UPPER

#: (action, host, path); a rule is written host + path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Words that mark a host as one for the list.
SPAM_WORDS = ("spam", "pills", "casino", "viagra", "payday", "replica", "jackpot", "lottery")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or port, path without slashes at its end;
    scheme, query and fragment gone."""
    return F.concat(F.regexp_replace(host, r"^www\.|:[0-9]*$", ""), F.regexp_replace(path, "/+$", ""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits, else null."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, action = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(action)
    return name, action


def _place(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a URL and its bit in each of the block's eight words."""
    bits = F.xxhash64(url, F.lit(7))
    return (F.pmod(F.xxhash64(url), F.lit(blocks)).cast("int"),
            [F.shiftrightunsigned(bits, 8 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(8)])


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """Filter of column ``canonical`` as rows (block, w0..w7), ``blocks`` at most."""
    block, bits = _place(F.col("canonical"), blocks)
    return (listed.select(block.alias("block"), *[_bit(b).alias(f"w{i}") for i, b in enumerate(bits)])
            .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)]))


def maybe_in(df: DataFrame, key: str, filter_: DataFrame, blocks: int) -> DataFrame:
    """``df`` with ``possible``: false only where column ``key`` is certainly
    not in the filter (a null key never is)."""
    block, bits = _place(F.col(key), blocks)
    hit = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(_bit(b)) != 0 for i, b in enumerate(bits)])
    return (df.withColumn("block", block).join(F.broadcast(filter_), "block", "left")
            .withColumn("possible", F.coalesce(hit, F.lit(False))).drop("block", *[f"w{i}" for i in range(8)]))


def listed_by_host(pages: DataFrame, words=SPAM_WORDS) -> DataFrame:
    """The list of a crawl: canonical URLs, once each, of pages on hosts that
    carry one of ``words`` between dots or hyphens."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    return (pages.select(canonical(host, path).alias("canonical"), host.alias("host"))
            .filter(F.col("host").rlike(r"(^|[.-])(" + "|".join(words) + r")($|[.-])"))
            .select("canonical").distinct())


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, blocks: int = 1 << 15, salts: int = 16) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page. ``listed`` has
    distinct canonical URLs in ``canonical``. Possible hits meet the list once
    per URL; the found URLs go back to the pages under ``salts`` salts, so a
    URL that a third of all pages share is dealt to as many tasks."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, action = rule_for(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule, "action": action, "canonical": canonical(F.col("host"), F.col("path"))})
    probed = maybe_in(p, "canonical", bloom(listed, blocks), blocks).withColumn("possible", F.col("rule").isNull() & F.col("possible"))
    possible = probed.filter("possible")
    found = (possible.select("canonical").distinct().join(listed, "canonical")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("listed", F.lit(True)))
    judged = (possible.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(salts)).cast("int"))
              .join(found, ["canonical", "salt"], "left"))
    cols = ["page_id", "host", "path", "rule"]
    blocked = F.when(F.coalesce(F.col("listed"), F.lit(False)), "block").otherwise("allow")
    return (probed.filter(~F.col("possible")).select(*cols, F.coalesce("action", F.lit("allow")).alias("verdict"))
            .unionByName(judged.select(*cols, blocked.alias("verdict"))))
