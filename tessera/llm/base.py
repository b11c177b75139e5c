"""What the operators of this package share: reading, staging, folds, word caches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
A_Z = str.maketrans(UPPER, LOWER)
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends at files that
    every executor can read, so a lost executor costs no recomputation."""
    path = shared_path(df.sparkSession, "llm", tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text), a null text as the empty one; other columns stay behind."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def in_small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows and, as Spark ends a batch that
    reaches it, about ``BATCH_BYTES``: a Python worker, and the executor that
    fills its batches, holds a few MB of text at a time."""
    conf = spark.conf
    most = conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")  # Spark gives bytes as 67108864b
    if not most.isdigit() or not 0 < int(most) <= BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def batch(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


class Memo(dict):
    """word -> value, made on first use. Of two generations of ``most`` words
    the older is dropped when the younger is full: frequent words stay. Words
    longer than ``longest`` are not kept, so memory is bounded in bytes
    whatever the vocabulary."""

    def __init__(self, make: Callable, most: int = 250_000, longest: int | None = None):
        super().__init__()
        self.make, self.most, self.older, self.longest = make, most, {}, longest

    def __missing__(self, word):
        if self.longest is not None and len(word) > self.longest:
            return self.make(word)
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
        if len(self) >= self.most:
            self.age()
        self[word] = value
        return value

    def age(self) -> None:
        """The younger generation becomes the older."""
        self.older = dict(self)
        self.clear()


def utf8(column: pa.Array) -> list[bytes]:
    """A text column's values as UTF-8 bytes; null is the empty text."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def pieces(text: bytes, most: int = 1 << 20) -> Iterator[bytes]:
    """The text, a very long one cut at spaces or line ends (so never in a
    word) into parts of about ``most`` bytes: Python then holds the words of
    one part at a time."""
    at = 0
    while len(text) - at > most:
        ends = [e for e in (text.find(b" ", at + most), text.find(b"\n", at + most)) if e >= 0]
        if not ends:
            break
        yield text[at:min(ends)]
        at = min(ends)
    yield text[at:] if at else text


_HELD: dict = {}
_LIBC = ctypes.CDLL(None)


def held(name, make: Callable):
    """What an operator keeps in a Python worker between tasks (caches, a
    vocabulary). A worker serves one operator after another: what the last one
    kept goes first, so the sizes do not add up."""
    if name not in _HELD:
        let_go()
        _HELD[name] = make()
    return _HELD[name]


def let_go() -> None:
    """Drop what other operators left in this worker, and give the memory back."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Allocators keep freed memory; on a shared machine it is better returned."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what the work on some 16 MB of them left free goes back to
    the system, and at a task's end the rest, so waiting workers stay small."""
    seen = 0
    for b in batches:
        seen += b.nbytes
        yield b
        del b
        if seen > 1 << 24:
            seen = 0
            give_back()
    give_back()
