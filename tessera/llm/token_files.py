"""Token ids as binary files (op4): independent zstandard frames, a trailing
seek table and a checksum per frame.

A file holds one range of documents in ascending doc_id order as one stream
of little-endian unsigned 32-bit ids. The stream is cut every ``frame_bytes``
into frames that decompress on their own. After the data frames come two
skippable frames: the document index (ids, token counts, place of the file in
the order) and the seek table of the public zstandard seekable format
(compressed size, size, low 32 bits of xxh64 for each frame). A reader looks
at the end of the file, finds the documents it wants, and decompresses only
the frames that hold them.

Files are written through Spark's text sink, one row per frame, with an empty
skippable frame as "line separator": zstandard readers pass over it, and the
sink's commit protocol keeps files of lost or repeated tasks out, on any file
system that Spark can write.

Defined cases: a null text is the empty text; a document always has the end
id, so an empty one has one token; a null doc_id sorts first; equal doc_ids
follow each other by text; an empty table gives no file and no row; columns
other than id and text are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .base import held, in_small_batches, shared_path, stage, texts

#: Fixed values of the zstandard frame and seekable formats.
SKIPPABLE_SEEK, SKIPPABLE_INDEX, SEEKABLE_FOOTER = 0x184D2A5E, 0x184D2A51, 0x8F92EAB1
#: An empty skippable frame (magic 0x184D2A50, length 0); all its bytes are ASCII.
SEPARATOR = "P*M\x18\0\0\0\0"
END_ID = 1


class WordEncoder:
    """Ids of a text as bytes. The tokenizer drops white space and never joins
    across it, so a text's ids are those of its space- and newline-separated
    words in turn; ids of words seen before are kept (two generations of at
    most ``most`` words)."""

    def __init__(self, path: str, most: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.young: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.young]
        if len(self.young) + len(new) > self.most:
            self.older, self.young, new = self.young, {}, list(words)
        unknown = []
        for w in new:
            if w in self.older:
                self.young[w] = self.older[w]
            else:
                unknown.append(w)
        for k in range(0, len(unknown), 256):  # together as one text, cut again by the tokens' offsets
            part = unknown[k:k + 256]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = struct.pack(f"<{len(e.ids)}I", *e.ids)
            ends = list(accumulate(len(w) + 1 for w in part))
            at = 0
            for w, cut in zip(part, (4 * n for n in np.searchsorted([o[0] for o in e.offsets], ends).tolist())):
                self.young[w] = ids[at:cut]
                at = cut

    def __call__(self, values: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in values]
        self._learn(set().union(*split))
        return [b"".join(map(self.young.__getitem__, words)) for words in split]


def encoder(path: str) -> WordEncoder:
    """One encoder per tokenizer file and Python worker."""
    return held(("ids", path), lambda: WordEncoder(path))


def skippable(magic: int, payload: bytes) -> bytes:
    return struct.pack("<II", magic, len(payload)) + payload


class FileCutter:
    """Turns the documents of one file, in order, into its frames."""

    def __init__(self, shard: int, frame_bytes: int):
        self.shard, self.frame_bytes = shard, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=1)
        self.pending, self.seek, self.ids, self.counts = bytearray(), [], [], []

    def _frame(self, data: bytes) -> bytes:
        z = self.zstd.compress(data)
        self.seek.append(struct.pack("<III", len(z) + len(SEPARATOR), len(data), xxh64_intdigest(data) & 0xFFFFFFFF))
        return z

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[bytes]:
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.pending += ids
        while len(self.pending) >= self.frame_bytes:
            data = bytes(self.pending[:self.frame_bytes])
            del self.pending[:self.frame_bytes]
            yield self._frame(data)

    def end(self) -> Iterator[bytes]:
        if self.pending:
            yield self._frame(bytes(self.pending))
        index = b"".join(struct.pack("<?qQ", d is None, d or 0, n) for d, n in zip(self.ids, self.counts))
        yield skippable(SKIPPABLE_INDEX, struct.pack("<Q", self.shard) + self.zstd.compress(index))
        yield skippable(SKIPPABLE_SEEK, b"".join(self.seek) + struct.pack("<IBI", len(self.seek), 0x80, SEEKABLE_FOOTER))


class TokenFile:
    """Random access to one file's content (bytes-like)."""

    def __init__(self, content: bytes):
        self.data = memoryview(content)
        end = len(self.data) - len(SEPARATOR)
        n, flags, magic = struct.unpack_from("<IBI", self.data, end - 9)
        if magic != SEEKABLE_FOOTER or flags != 0x80:
            raise ValueError("no seek table at the end of the file")
        at = end - 9 - 12 * n
        self.frames, offset, start = [], 0, 0
        for size, length, check in struct.iter_unpack("<III", self.data[at:end - 9]):
            self.frames.append((start, length, offset, size - len(SEPARATOR), check))
            offset, start = offset + size, start + length
        magic, size = struct.unpack_from("<II", self.data, offset)
        if magic != SKIPPABLE_INDEX:
            raise ValueError("no document index after the data frames")
        self.zstd, body = zstandard.ZstdDecompressor(), self.data[offset + 8:offset + 8 + size]
        self.shard, self.docs, place = struct.unpack_from("<Q", body)[0], [], 0
        for none, doc_id, n in struct.iter_unpack("<?qQ", self.zstd.decompress(body[8:])):
            self.docs.append((None if none else doc_id, place, n))
            place += n

    def frame(self, k: int) -> bytes:
        _, length, offset, size, check = self.frames[k]
        data = self.zstd.decompress(self.data[offset:offset + size], max_output_size=length)
        if xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} fails its checksum")
        return data

    def read(self, wanted=None) -> Iterator[tuple[int | None, int, int, int, bytes | None]]:
        """(doc_id, first token, tokens, crc32, ids) of the wanted documents
        (None: of all, without ids), each frame decompressed once at most."""
        k, held = 0, (-1, b"")
        for doc_id, first, n in self.docs:
            if wanted is not None and doc_id not in wanted:
                continue
            at, end, crc, parts = 4 * first, 4 * (first + n), 0, []
            while k < len(self.frames) and self.frames[k][0] + self.frames[k][1] <= at:
                k += 1
            j = k
            while at < end:
                if held[0] != j:
                    held = (j, self.frame(j))
                begin = self.frames[j][0]
                piece = held[1][at - begin:end - begin]
                crc = zlib.crc32(piece, crc)
                if wanted is not None:
                    parts.append(piece)
                at, j = at + len(piece), j + 1
            yield doc_id, first, n, crc, b"".join(parts) if wanted is not None else None


def write_token_files(df: DataFrame, tokenizer: str, path: str, files: int | None = None,
                      frame_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``text_col`` and write ``files`` files (default: the session's
    shuffle partitions) under ``path``. One shuffle, by ranges of the id."""
    spark = df.sparkSession
    in_small_batches(spark)
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = texts(df, id_col, text_col).repartitionByRange(n, *order).sortWithinPartitions(*order, "text")
    end = struct.pack("<I", END_ID)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, cut = encoder(tokenizer), FileCutter(TaskContext.get().partitionId(), frame_bytes)
        row = lambda z: pa.RecordBatch.from_arrays([pa.array([z], pa.binary())], names=["frame"])
        for b in batches:
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), encode(b.column("text").to_pylist())):
                for z in cut.add(doc_id, ids + end):
                    yield row(z)
        if cut.ids:
            for z in cut.end():
                yield row(z)

    (ranged.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string"))
     .write.option("lineSep", SEPARATOR).text(path))


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(shard, doc_id, first, n_tokens, ids_crc32, ids) from the files. With
    ``doc_ids`` only frames that hold one of them are decompressed and ``ids``
    is filled; without, all documents come back with ``ids`` null."""
    in_small_batches(spark)
    wanted = None if doc_ids is None else set(doc_ids)
    schema = "shard long, doc_id long, first long, n_tokens long, ids_crc32 long, ids binary"
    fields = pa.schema([("shard", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                f = TokenFile(content.as_buffer())
                rows = [(f.shard, *r) for r in f.read(wanted)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t.type) for c, t in zip(zip(*rows), fields)], schema=fields)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(read, schema)


def token_table(df: DataFrame, tokenizer: str, files: int | None = None, frame_bytes: int = 1 << 20) -> DataFrame:
    """Write the files, read them back, and give each document its place:
    (doc_id, start, n_tokens, ids_crc32). The running count of ids needs one
    row per file only: totals of files, summed in file order."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", "token-files")
    write_token_files(df, tokenizer, path, files, frame_bytes)
    docs = stage(read_token_files(spark, path).drop("ids"), "token-rows")
    totals = docs.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("shard", F.coalesce(F.sum("total").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    # one row per file: broadcast is bounded by the number of files.
    return (docs.join(F.broadcast(before), "shard")
            .select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))
