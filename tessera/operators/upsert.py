"""Set-based upsert on plain Parquet (M1, M2, M5): merge on read, no row writes.

A table is hash-bucketed (``bucket = pmod(xxhash64(bucket_by), B)``). The first
rows of a bucket are its base; an upsert writes only its own rows, as a delta
beside the base, and a read takes each key from the newest delta that has it:

    <path>/v=<n>/bucket=<b>/...   files of version n: a base or a delta
    <path>/_index/                one row a version: the base and the deltas of
                                  every bucket from then on

A version is published by its row in the index, written last. A run that fails
earlier leaves the table as it was, and the next one overwrites what it left.
``compact`` folds deltas into a new base; ``vacuum`` drops the files that no
recent version needs, so a read may go on while both run. One writer at a time.

Where a version has each of its keys once, and all keys that a bucket had, it
is the bucket's new base. In a table that ``appends``, one that has none of
them is a further part of the base. Neither needs a merge, and no fold.
"""

from __future__ import annotations

import os
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import checked
from ..session import read_if_present, shuffles_dropped

BUCKET = "bucket"
INDEX_DDL = "v int, live array<struct<bucket:int,base:int,rows:bigint,deltas:array<int>,delta_rows:bigint,more:array<int>>>"


class Live(NamedTuple):
    """What a published bucket consists of: versions, and how many rows they hold."""
    bucket: int
    base: int
    rows: int
    deltas: tuple[int, ...]
    delta_rows: int
    more: tuple[int, ...] = ()

    @property
    def bases(self) -> tuple[int, ...]:
        return (self.base, *self.more)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def carried(new: DataFrame, old: DataFrame | None, key: str, *, as_of: Column,
            keep_first: tuple[str, ...], order: str | None) -> DataFrame:
    """The new rows as they are written: columns in keep_first (first-insert
    time) come from the old row of the key, ``as_of`` where there is none. With
    ``order``, a new row whose order is below its old row's is left out."""
    for c in keep_first:
        new = new.withColumn(c, as_of.cast("timestamp_ntz"))
    needed = [*keep_first, *([order] if order else [])]
    if old is None or not needed:
        return new
    known = old.select(F.col(key).alias("_old_key"), *[F.col(c).alias(f"_old_{c}") for c in needed])
    both = new.join(known, new[key].eqNullSafe(known["_old_key"]), "left")
    if order:
        both = both.filter(F.col(f"_old_{order}").isNull() | (F.col(order) >= F.col(f"_old_{order}")))
    first = {c: F.coalesce(F.col(f"_old_{c}"), F.col(c)) for c in keep_first}
    return both.select(*[first.get(c, F.col(c)).alias(c) for c in new.columns])


class BucketedTable:
    """A Parquet table in shared storage, versioned by hash bucket. ``buckets``
    and ``bucket_by`` (the key unless named) are properties of the table: size
    the first to the data, and keep both. A bucket is folded when its deltas
    are ``max_deltas`` or hold ``fold_at`` times its base's rows. ``appends``:
    most upserts bring new keys only."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64, ddl: str = "",
                 bucket_by: str | None = None, max_deltas: int = 8, fold_at: float = 1.0, keep_versions: int = 16, appends: bool = False):
        self.spark, self.path, self.key, self.buckets, self.ddl = spark, path, key, buckets, ddl
        self.bucket_by, self.max_deltas, self.fold_at, self.keep_versions = bucket_by or key, max_deltas, fold_at, keep_versions
        self.appends = appends

    def _index(self) -> DataFrame | None:
        return read_if_present(lambda: self.spark.read.schema(INDEX_DDL).parquet(os.path.join(self.path, "_index")))

    def _published(self) -> tuple[int, dict[int, Live]]:
        """(latest version, bucket -> its parts): ``buckets`` entries at most."""
        index = self._index()
        row = index.agg(F.max("v").alias("v"), F.max_by("live", "v").alias("live")).first() if index is not None else None
        if row is None or row.v is None:
            return 0, {}
        return row.v, {x.bucket: Live(x.bucket, x.base, x.rows, tuple(x.deltas), x.delta_rows, tuple(x.more or ())) for x in row.live}

    def exists(self) -> bool:
        return bool(self._published()[1])

    def _folder(self, version: int, bucket: int) -> str:
        return os.path.join(self.path, f"v={version}", f"{BUCKET}={bucket}")

    def _rows(self, live: list[Live]) -> DataFrame | None:
        """Rows of these buckets. Bases without deltas are read as they are; of
        the others, the keys that a delta has are left out of the base."""
        if not live:
            return None
        plain = [self._folder(v, x.bucket) for x in live if not x.deltas for v in x.bases]
        layered = [x for x in live if x.deltas]
        out = self.spark.read.parquet(*plain) if plain else None
        if layered:
            base = self.spark.read.parquet(*[self._folder(v, x.bucket) for x in layered for v in x.bases])
            deltas = self.spark.read.parquet(*[self._folder(v, x.bucket) for x in layered for v in x.deltas])
            version = F.regexp_extract(F.col("_metadata.file_path"), rf"/v=(\d+)/{BUCKET}=\d+/[^/]+$", 1).cast("int")
            payload = [c for c in base.columns if c != self.key]
            # A column each, so that what a reader does not ask for is not moved.
            newest = (deltas.select(*base.columns, version.alias("_v")).groupBy(self.key)
                      .agg(*[F.max_by(c, "_v").alias(c) for c in payload]).select(*base.columns))
            changed = deltas.select(F.col(self.key).alias("_changed"))
            both = base.join(changed, base[self.key].eqNullSafe(changed["_changed"]), "left_anti").unionByName(newest)
            out = both if out is None else out.unionByName(both)
        return out

    def read(self) -> DataFrame | None:
        """The published rows; None before the first upsert."""
        return self._rows(list(self._published()[1].values()))

    def _touched(self, keys: DataFrame) -> set[int]:
        return {r[0] for r in keys.select(bucket_of(F.col(self.bucket_by), self.buckets)).distinct().collect()}

    def read_near(self, keys: DataFrame) -> DataFrame | None:
        """Rows of the buckets that ``keys`` (with the column bucketed by) fall in."""
        touched = self._touched(keys)
        return self._rows([x for x in self._published()[1].values() if x.bucket in touched])

    def _write(self, rows: DataFrame, version: int) -> dict[int, int]:
        """Write a version's files; returns its rows by bucket, from the files' footers."""
        path = os.path.join(self.path, f"v={version}")
        dealt = checked(rows, self.ddl).withColumn(BUCKET, bucket_of(F.col(self.bucket_by), self.buckets))
        with shuffles_dropped(self.spark):
            (dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
             .partitionBy(BUCKET).parquet(path))
        written = self.spark.read.schema(f"{BUCKET} int").parquet(path)
        return {r[0]: r[1] for r in written.groupBy(BUCKET).count().collect()}

    def _append_index(self, version: int, live: dict[int, Live]) -> None:
        rows = self.spark.createDataFrame([(version, [tuple(x) for _, x in sorted(live.items())])], INDEX_DDL)
        rows.coalesce(1).write.mode("append").parquet(os.path.join(self.path, "_index"))

    def write(self, new: DataFrame, *, as_of: Column, keep_first: tuple[str, ...] = ("silvered_at",),
              order: str | None = None) -> int:
        """Write the rows (one a key) as the next version, unpublished; returns its
        number. With ``order`` a row never replaces one of greater order."""
        latest, live = self._published()
        old = None
        if live and (keep_first or order):
            touched = self._touched(new)
            old = self._rows([x for x in live.values() if x.bucket in touched])
        rows = carried(new, old, self.key, as_of=as_of, keep_first=keep_first, order=order)
        if live:
            have = set(self._rows([next(iter(live.values()))]).columns)
            if have != set(rows.columns):
                raise ValueError(f"columns that only the table or only the new rows have: {sorted(have ^ set(rows.columns))}")
        self._pending = (latest + 1, live, self._write(rows, latest + 1))
        return latest + 1

    def publish(self) -> None:
        """Make the version that ``write`` wrote the current one."""
        version, live, written = self._pending
        whole, apart = self._compared(version, live, written)
        for b, n in written.items():
            x = live.get(b)
            if x is None or b in whole:
                live[b] = Live(b, version, n, (), 0)
            elif b in apart:
                live[b] = x._replace(rows=x.rows + n, more=(*x.more, version))
            else:
                live[b] = x._replace(deltas=(*x.deltas, version), delta_rows=x.delta_rows + n)
        if written:
            self._append_index(version, live)

    def _compared(self, version: int, live: dict[int, Live], written: dict[int, int]) -> tuple[set[int], set[int]]:
        """Of the buckets in which the version has each of its keys once: those of
        whose keys it has all, and those of which it has none. Only the key is
        read, and only where the counts of rows leave one of the two open."""
        may = [live[b] for b, n in written.items() if b in live and (self.appends or n >= live[b].rows)]
        if not may:
            return set(), set()
        bucket = bucket_of(F.col(self.bucket_by), self.buckets).alias("b")
        new = self.spark.read.parquet(*[self._folder(version, x.bucket) for x in may])
        keys = (new.select(bucket, F.col(self.key).alias("k"), F.lit(1).alias("now"), F.lit(0).alias("was"))
                .unionByName(self._rows(may).select(bucket, F.col(self.key).alias("k"), F.lit(0).alias("now"), F.lit(1).alias("was")))
                .groupBy("b", "k").agg(F.sum("now").alias("now"), F.max("was").alias("was")))
        found = keys.groupBy("b").agg(F.max("now").alias("most"), F.count_if(F.col("now") == 0).alias("left"),
                                      F.count_if((F.col("now") > 0) & (F.col("was") > 0)).alias("hit")).collect()
        once = [r for r in found if r.most == 1]
        return {r.b for r in once if not r.left}, {r.b for r in once if self.appends and not r.hit}

    def upsert(self, new: DataFrame, *, as_of: Column, keep_first: tuple[str, ...] = ("silvered_at",),
               order: str | None = None) -> DataFrame | None:
        self.write(new, as_of=as_of, keep_first=keep_first, order=order)
        self.publish()
        live = self._pending[1].values()
        due = {x.bucket for x in live if len(x.deltas) >= self.max_deltas or x.delta_rows > self.fold_at * x.rows}
        if due:
            self.compact(due)
            self.vacuum()
        return self.read()

    def compact(self, buckets: set[int] | None = None) -> None:
        """Fold the deltas of these buckets (all unless named) into new bases."""
        latest, live = self._published()
        chosen = [x for x in live.values() if x.deltas and (buckets is None or x.bucket in buckets)]
        if chosen:
            written = self._write(self._rows(chosen), latest + 1)
            self._append_index(latest + 1, live | {b: Live(b, latest + 1, n, (), 0) for b, n in written.items()})

    def vacuum(self, keep: int | None = None) -> None:
        """Drop the files that none of the last ``keep`` versions needs, then the
        index rows of the versions before. A read that began ``keep`` or more
        versions ago may fail; it never gets other rows."""
        index = self._index()
        rows = [] if index is None else index.select("v", "live", F.col("_metadata.file_path").alias("file")).collect()
        rows.sort(key=lambda r: r.v)
        gone, kept = rows[:-(keep or self.keep_versions)], rows[-(keep or self.keep_versions):]

        def needed(some) -> set[tuple[int, int]]:
            return {(v, x.bucket) for r in some for x in r.live for v in (x.base, *(x.more or ()), *x.deltas)}

        for v, b in sorted(needed(gone) - needed(kept)):
            self._delete(self._folder(v, b))
        for r in gone:
            self._delete(r.file)

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def record_progress(table: BucketedTable, counts: DataFrame, as_of: Column) -> None:
    """M2: one row a dataset, recorded as complete only after its silver write."""
    table.upsert(counts.select("source_dataset", F.col("post_count").cast("bigint").alias("post_count"),
                               as_of.cast("timestamp_ntz").alias("completed_at")),
                 as_of=as_of, keep_first=())
