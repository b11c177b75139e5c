"""Cross-tokenizer alignment (op12): how the tokens of two tokenizers lie on one
text, with exact-text deduplication.

A shuffle by the full text leaves each distinct text once, with its number of
rows. Each is tokenised and aligned once: space + text by a byte-level BPE (A),
text by a piece model that adds that space (B). A stretch between two ends of
the merged token borders lies in one A and one B token, so each such stretch is
one link. A text's links are staged as id pairs with counts; corpus counts of
pairs weigh each text by its number of rows; the measures that need them are
taken from the staged pairs and joined to the doc_ids by the text's sha256.

Work inside a text: neither tokenizer has a token across the border before a
single space or line end between two other characters (A's pattern starts a new
word there, no piece of B holds one but in front; ``Aligner`` checks that). So a
text is cut there, units seen before are looked up, and new ones are tokenised
and aligned many at a time.

The table of pair counts is dealt in blocks of about ``BLOCK`` pairs, each of
which is broadcast in turn; measures are sums, so more blocks (a larger corpus
has more pairs, at most the product of both vocabularies) only mean more passes
over the staged pairs.

Defined cases: null and empty texts, texts that are not valid UTF-8, and texts
whose tokens of A or B do not join to space + text (B writes U+2581 for a
space, so a text that holds that character is one) have zeros and an empty
hash. Repeated rows and ids and null ids each keep their row. An empty table
gives no row. Very long texts are worked on in parts of about a million
characters. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .base import held, in_small_batches, texts, utf8

#: The sign that the piece model writes for a space, and how
#: byte-level BPE files write bytes (printable Latin-1 as itself, the others as
#: characters from 256 on, in order).
SPACE = "▁"
PLAIN_BYTES = (*range(33, 127), *range(161, 173), *range(174, 256))
#: Ids of both tokenizers are below this, so that a pair is one number.
IDS = 1 << 16
BLOCK, PART = 1 << 21, 1 << 20
BORDER = re.compile(r"(?<=\S)(?=[ \n]\S)")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: Records of units that A or B do not give back, and of more than one word:
#: their numbers make any sum negative.
LOSSY, MANY = (b"", b"", -(1 << 80)), (b"", b"", -(1 << 100))


def byte_characters() -> dict[str, int]:
    others = (b for b in range(256) if b not in PLAIN_BYTES)
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Both tokenizers and the units seen before (two generations of at most
    ``most`` units of at most ``longest`` characters)."""

    def __init__(self, byte_bpe: str, pieces: str, most: int = 300_000, longest: int = 48):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=pieces)
        place = byte_characters()
        if max(self.a.get_vocab(False).values()) >= IDS or self.b.GetPieceSize() > IDS:
            raise ValueError("more token ids than a pair has room for")
        self.a_bytes = [b""] * IDS
        for t, i in self.a.get_vocab(False).items():
            self.a_bytes[i] = bytes(map(place.__getitem__, t))
        plain = [self.b.IdToPiece(i) for i in range(self.b.GetPieceSize())]
        special = [self.b.IsControl(i) or self.b.IsUnknown(i) for i in range(len(plain))]
        self.b_bytes = [b"" if special[i] else bytes([int(p[1:-1], 16)]) if self.b.IsByte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(plain)]
        crossing = any(SPACE in p.lstrip(SPACE) or "\n" in p for i, p in enumerate(plain) if not special[i])
        self.cut = None if crossing else BORDER
        self.a_size, self.b_size = (np.array(list(map(len, d)), np.int64) for d in (self.a_bytes, self.b_bytes))
        self.written = [sep + b"%d" % i for sep in (b";", b",", b"|", b",") for i in range(IDS)]
        self.most, self.longest = most, longest
        self.young: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a stretch that starts with a space or line end; None where
        either side does not join to the stretch."""
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:], num_threads=1) if text[0] == " " else self.b.encode(text, num_threads=1)[1:]
        raw = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        return a, b

    def align(self, units: list[str]) -> list[tuple]:
        """For units (each with its leading space or line end) in a row: (links
        as id pairs, groups as text, numbers of tokens packed)."""
        ids = self.encode("".join(units))
        if ids is not None:
            a, b = (np.array(i, np.int64) for i in ids)
            a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            unit_end = np.cumsum([len(u.encode()) for u in units])
            link_end, group_end = np.union1d(a_end, b_end), np.intersect1d(a_end, b_end)
            if np.isin(unit_end, group_end).all():
                a_at, b_at = np.searchsorted(a_end, link_end), np.searchsorted(b_end, link_end)
                links = (a[a_at] * IDS + b[b_at]).astype(np.uint32)
                a_group, b_group = np.searchsorted(group_end, a_end), np.searchsorted(group_end, b_end)
                order = np.empty(len(a) + len(b), np.int64)
                order[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = a + IDS * (np.diff(a_group, prepend=-1) == 0)
                order[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = b + IDS * (2 + (np.diff(b_group, prepend=-1) == 0))
                signs = list(map(self.written.__getitem__, order.tolist()))
                a_to, b_to, links_to = ([0, *(np.searchsorted(e, unit_end) + 1).tolist()] for e in (a_end, b_end, link_end))
                return [(links[links_to[k]:links_to[k + 1]].tobytes(),
                         b"".join(signs[a_to[k] + b_to[k]:a_to[k + 1] + b_to[k + 1]]),
                         a_to[k + 1] - a_to[k] + (b_to[k + 1] - b_to[k] << 31)) for k in range(len(units))]
        return [self.align([u])[0] for u in units] if len(units) > 1 else [LOSSY]

    def learn(self, units: set[str]) -> None:
        """Make sure that each unit has its record: keys are units without
        their leading space; ``MANY`` if that holds more than a word."""
        new = [u for u in units if u not in self.young]
        if not new:
            return
        if len(self.young) + len(new) > self.most:
            self.older, self.young, new = self.young, {}, list(units)
        unknown = []
        for u in new:
            record = self.older.get(u, LOSSY)
            if record is not LOSSY:
                self.young[u] = record
            elif len(u.split()) != 1 or u.strip() != u.removeprefix("\n"):
                self.young[u] = MANY
            else:
                unknown.append(u)
        for k in range(0, len(unknown), 512):
            some = unknown[k:k + 512]
            self.young.update(zip(some, self.align([u if u[0] == "\n" else " " + u for u in some])))

    def prepare(self, values: list[bytes]) -> None:
        """Learn the units of many texts together."""
        if self.cut is not None:
            some = set().union(*(t.decode("utf-8", "ignore").replace("\n", " \n").split(" ") for t in values))
            self.learn({u for u in some if len(u) <= self.longest})

    def part(self, text: str) -> tuple[bytes, bytes, int]:
        """Links, groups and numbers of a text's units, each put together."""
        if self.cut is None:
            return self.align([" " + text])[0]
        units = text.replace("\n", " \n").split(" ")
        some = set(units)
        if all(len(u) <= self.longest for u in some):
            self.learn(some)
            links, groups, numbers = zip(*map(self.young.__getitem__, units))
            total = sum(numbers)
            if total > MANY[2] // 2:
                return b"".join(links), b"".join(groups), total
        units = self.cut.split(" " + text)
        short = {u for u in units if len(u) <= self.longest and not any(map(str.isspace, u[1:]))}
        self.learn({u.removeprefix(" ") for u in short})
        links, groups, numbers = zip(*(self.young[u.removeprefix(" ")] if u in short else self.align([u])[0] for u in units))
        return b"".join(links), b"".join(groups), sum(numbers)

    def parts(self, text: str) -> Iterator[str]:
        """The text, a very long one cut at borders. A part that follows a
        space starts after it; one that follows a line end keeps it."""
        at = 0
        while len(text) - at > PART and self.cut is not None:
            found = self.cut.search(text, at + PART)
            while found and text[found.end()] != " ":
                found = self.cut.search(text, found.end() + 1)
            if not found:
                break
            yield text[at:found.start()]
            at = found.start() + 1
        yield text[at:] if at else text

    def aligned(self, raw: bytes) -> tuple:
        """(n_a, n_b, n_groups, n_links, hash, pairs, their counts) of a text."""
        nothing = (0, 0, 0, 0, "", np.zeros(0, np.uint32), np.zeros(0, np.int64))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return nothing
        if not text:
            return nothing
        packed, groups, links, digest = 0, 0, [], None
        for p in self.parts(text):
            some, written, numbers = self.part(p)
            if numbers < 0:
                return nothing
            packed += numbers
            links.append(np.frombuffer(some, np.uint32))
            groups += written.count(b"|")
            if digest is None:
                digest, written = hashlib.sha256(), written[1:]
            digest.update(written)
        links = np.concatenate(links)
        pairs, counts = np.unique(links, return_counts=True)
        return packed & (1 << 31) - 1, packed >> 31, groups, len(links), digest.hexdigest(), pairs, counts


def pack(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising pairs as steps, and counts, byte plane by byte plane (for the
    file format's compression)."""
    both = np.concatenate((np.diff(pairs, prepend=np.uint32(0)), counts.astype(np.uint32))).astype("<u4")
    return both.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    n = len(both) // 2
    return np.cumsum(both[:n], dtype=np.uint32), both[n:].astype(np.int64)


_TEXT = "key binary, rows long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def _align_texts(distinct: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(("align", byte_bpe, pieces), lambda: Aligner(byte_bpe, pieces))
        for b in batches:
            raw = utf8(b.column("text"))
            got: list = []
            while len(got) < len(raw):  # about two million bytes at a time
                some = takewhile(lambda s: s[1] <= 1 << 21, zip(raw[len(got):], accumulate(map(len, raw[len(got):]))))
                lot = [t for t, _ in some] or raw[len(got):len(got) + 1]
                aligner.prepare([t for t in lot if len(t) <= PART])
                got += map(aligner.aligned, lot)
            columns = list(zip(*(g[:5] for g in got))) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.sha256(r).digest() for r in raw], pa.binary()), b.column("rows"), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 pa.array(columns[4], pa.string()), pa.array([pack(*g[5:]) for g in got], pa.binary())],
                names=["key", "rows", *COUNTS, "groups_sha256", "pairs"])

    return distinct.mapInArrow(run, _TEXT)


def pair_counts(aligned: DataFrame, most: int = 1 << 21) -> DataFrame:
    """(pair, n): links of each id pair in the whole corpus. A task adds up at
    most about ``most`` different pairs before it passes them on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, sums = np.zeros(0, np.uint32), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(sums)], names=["pair", "n"])

        for b in batches:
            some, n = [pairs], [sums]
            for rows, data in zip(b.column("rows").to_pylist(), b.column("pairs").to_pylist()):
                p, c = unpack(data)
                some.append(p)
                n.append(c * rows)
            pairs, at = np.unique(np.concatenate(some), return_inverse=True)
            sums, added = np.zeros(len(pairs), np.int64), np.concatenate(n)
            np.add.at(sums, at, added)
            if len(pairs) > most:
                for k in range(0, len(pairs), 1 << 16):
                    yield out().slice(k, 1 << 16)
                pairs, sums = pairs[:0], sums[:0]
        for k in range(0, len(pairs), 1 << 16):
            yield out().slice(k, 1 << 16)

    return aligned.select("rows", "pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_best(pairs: DataFrame) -> DataFrame:
    """(pair, n, best): whether n is the highest of its B id."""
    b = F.pmod(F.col("pair"), F.lit(IDS)).alias("b")
    highest = pairs.groupBy(b).agg(F.max("n").alias("highest"))
    return pairs.withColumn("b", b).join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


_MEASURES = "key binary, rows long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"


def _measures(aligned: DataFrame, block: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """The texts with n_best and count_sum over one block of pairs."""
    shared = aligned.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for b in batches:
            sums, bests = [], []
            for data in b.column("pairs").to_pylist():
                p, c = unpack(data)
                at = np.searchsorted(pairs, p)
                at[at == len(pairs)] = 0
                c = np.where(pairs[at] == p, c, 0) if len(pairs) else c[:0]
                sums.append(int(c @ n[at]) if len(c) else 0)
                bests.append(int(c @ best[at]) if len(c) else 0)
            keep = b.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*map(b.column, keep), pa.array(bests, pa.int64()), pa.array(sums, pa.int64())], names=[*keep, "n_best", "count_sum"])

    return aligned.mapInArrow(run, _MEASURES)


def _staged(df: DataFrame, tag: str) -> DataFrame:
    path = shared_path(df.sparkSession, "llm", tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def alignment(documents: DataFrame, byte_bpe: str, pieces: str, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    of every document."""
    spark = documents.sparkSession
    in_small_batches(spark, 500)
    docs = texts(documents)
    distinct = docs.groupBy("text").agg(F.count("*").alias("rows"))
    aligned = _staged(_align_texts(distinct, byte_bpe, pieces), "alignment-texts")
    pairs = _staged(with_best(pair_counts(aligned)), "alignment-pairs")
    blocks = max(1, -(-pairs.count() // block))
    # each block's pairs by a hash of the pair: about ``block`` rows of 17 bytes
    numbered, measures = pairs.withColumn("block", F.pmod(F.xxhash64("pair"), F.lit(blocks))), []
    for k in range(blocks):
        got = numbered.filter(F.col("block") == k).select("pair", "n", "best").toPandas().sort_values("pair")
        some = (got["pair"].to_numpy(np.uint32), got["n"].to_numpy(np.int64), got["best"].to_numpy(np.int64))
        measures.append(_staged(_measures(aligned, some), "alignment-measures"))
    found = reduce(DataFrame.unionByName, measures)
    if blocks > 1:
        same = [c for c in aligned.columns if c not in ("key", "pairs")]
        found = _staged(found.groupBy("key").agg(*[F.max(c).alias(c) for c in same], *[F.sum(c).alias(c) for c in ("n_best", "count_sum")]), "alignment-results")
    return _to_documents(docs, found)


def _to_documents(docs: DataFrame, measures: DataFrame, share: int = 1024) -> DataFrame:
    """Measures joined to the doc_ids. Texts of at least a ``share``-th of all
    rows (so at most ``share`` texts) are broadcast; no other key has more."""
    columns = [*COUNTS, "n_best", "count_sum", "groups_sha256"]
    ids = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"))
    rows = measures.agg(F.sum("rows")).first()[0] or 0
    hot = measures.filter(F.col("rows") * share >= rows)
    cold = measures.filter(F.col("rows") * share < rows).select("key", *columns)
    split = ids.join(F.broadcast(hot.select("key", *columns)), "key", "left")
    return (split.filter(F.col("n_a").isNotNull()).select("doc_id", *columns)
            .unionByName(split.filter(F.col("n_a").isNull()).select("doc_id", "key").join(cold, "key").select("doc_id", *columns)))
