"""Document fingerprints (op8), built-in functions only: bottom-k sketches of
word-shingle hashes.

A fingerprint is the sorted list of the k smallest distinct 64-bit hashes of
a text's five-word shingles (A-Z in lower case, words cut at white space; a
text of fewer words is one shingle; an empty text has none). The k smallest
of two sketches together are the sketch of both texts together, so parts
merge; resemblance, containment and the distinct count follow from them.

Defined cases: a null text is the empty text; two empty texts have likeness
1, an empty and another 0; null ids come last in descending order; equal ids
follow by hash of the text; in a table of one row the next document is
itself; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import LOWER, UPPER, texts

K, WORDS = 128, 5
_LEAST = -(1 << 63)


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.translate(text, UPPER, LOWER), "[ \\t-\\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(h: Column, words: int = WORDS) -> Column:
    """Hashes of a document's shingles from its word hashes."""
    many = F.transform(F.slice(h, 1, F.greatest(F.size(h) - (words - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, words)]))
    return (F.when(F.size(h) >= words, many).when(F.size(h) > 0, F.array(F.xxhash64(h)))
            .otherwise(F.array().cast("array<bigint>")))


def bottom_k(s: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(s)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts' union from the parts' sketches."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; exact where neither text has over k shingles."""
    u = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), u))
    return F.when(F.size(u) == 0, 1.0).otherwise(both / F.size(u)).cast("double")


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: (k-1) over the share of the hash
    range below the k-th value; exact below k."""
    share = (F.element_at(a, -1).cast("double") - float(_LEAST)) / float(1 << 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    r = resemblance(a, b, k)
    shared = r / (r + 1) * (distinct_count(a, k) + distinct_count(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def show(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.hex(x)), ",")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc_id, sketch, n_shingles_est) of each text, without a shuffle."""
    h = texts(df, id_col, text_col).select("doc_id", word_hashes(F.col("text")).alias("h"))
    return (h.select("doc_id", bottom_k(shingles(F.col("h")), k).alias("sketch"))
            .withColumn("n_shingles_est", distinct_count(F.col("sketch"), k)))


def with_next(df: DataFrame, buckets: int | None = None) -> DataFrame:
    """(bucket, ghost, doc_id, text, ...) dealt so that each bucket is a range of ids
    with, as a ghost row at its end, the first document of the range after it.
    A window over a bucket then sees every row's next document, and no task
    holds more than a range. Ranges come from quantiles of the ids; the driver
    gets two values a bucket."""
    spark = df.sparkSession
    n = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(_LEAST).cast("long"))
    keyed = df.withColumn("key", key)
    cuts = keyed.select(F.percentile_approx("key", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    bounds = F.lit(sorted(set(cuts))).cast("array<bigint>")
    keyed = keyed.withColumn("own", F.size(F.filter(bounds, lambda b: b <= F.col("key"))))
    first = sorted(tuple(r) for r in keyed.groupBy("own").agg(F.max("key")).collect())
    if not first:
        return keyed.withColumnRenamed("own", "bucket").withColumn("ghost", F.lit(False))
    home = [b for b, _ in first]
    to = F.lit(home[1:] + home[:1]).cast("array<int>")  # the range above; the highest's first follows the lowest
    at = F.array_position(F.lit([k for _, k in first]).cast("array<bigint>"), F.col("key"))
    places = F.when(at > 0, F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("ghost")),
                                    F.struct(F.get(to, (at - 1).cast("int")).alias("bucket"), F.lit(True).alias("ghost"))))
    places = places.otherwise(F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("ghost"))))
    return keyed.select(*df.columns, "key", F.inline(places))


def fingerprint_edits(df: DataFrame, k: int = K, buckets: int | None = None) -> DataFrame:
    """The query's table: each document, its edited text and the next document."""
    in_order = Window.partitionBy("bucket").orderBy(
        "ghost", F.col("key").desc(), F.xxhash64("text"), "text")
    t = with_next(texts(df), buckets).withColumn("next", F.lead("text").over(in_order))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - cut)"), F.expr("substring(coalesce(next, ''), 1, cut)"))
    t = t.withColumns({"n_chars": n.cast("int"), "cut": cut}).withColumn("edited", edited).drop("next")
    t = t.withColumns({"h": word_hashes(F.col("text")), "edited_h": word_hashes(F.col("edited")),
                       "edited_sha256": F.sha2(F.col("edited").cast("binary"), 256)}).drop("edited")
    t = t.withColumns({"fp": bottom_k(shingles(F.col("h")), k), "edited_fp": bottom_k(shingles(F.col("edited_h")), k)})
    t = t.drop("h", "edited_h").withColumn("next_fp", F.lead("fp").over(in_order)).filter(~F.col("ghost"))
    return t.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        show(F.col("fp")).alias("fingerprint"), show(F.col("edited_fp")).alias("edited_fingerprint"),
        resemblance(F.col("fp"), F.col("edited_fp"), k).alias("near_edited"),
        resemblance(F.col("fp"), F.col("next_fp"), k).alias("near_next"),
        distinct_count(F.col("fp"), k).alias("n_shingles_est"),
        containment(F.col("edited_fp"), F.col("fp"), k).alias("edited_contained"))
