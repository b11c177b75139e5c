"""Benchmark decontamination (op10) with suffix arrays of the training text.

Training documents are cut into shards (an Arrow batch each). A shard's words
become numbers of the benchmark's vocabulary, and a suffix array is built by
prefix doubling over its runs of known words: a suffix that starts at an
unknown word, or in a run shorter than the shortest window, cannot match and
is left out. Every test suffix that starts a window is binary-searched in the
array; the interval found gives all occurrences, and each is extended to the
longest verbatim match. The benchmark is a stated query set: it goes to the
tasks in blocks of at most ``block_chars`` characters (plus one item), one
pass over the documents each, and the passes' hits are merged by document.

A window is ``WINDOW`` consecutive words of an item (a shorter item is one
window); words are runs of digits, letters and non-ASCII characters, A-Z in
lower case. A document is contaminated if a twentieth of its words or more lie
in occurrences of windows.

Defined cases: null or empty texts have no words and no hits; a null item_id
is written as the empty string; items that repeat an id count once; rows that
repeat a document each get their result; an empty benchmark contaminates
nothing; an empty documents table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_hexdigest

from .base import batch, in_small_batches, let_go, pieces, texts, tidy, utf8

WINDOW = 13
#: Bytes to words: word bytes in lower case, all others a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))

MATCHES = pa.schema([("doc_id", pa.int64()), ("text_key", pa.string()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())),
                     ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string())),
                     ("longest", pa.int64()), ("longest_at", pa.int64()), ("longest_item", pa.string())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("text_key", pa.string()),
                    ("longest", pa.int64()), ("longest_at", pa.int64()), ("longest_item", pa.string())])
_SQL = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean",
        pa.list_(pa.int64()): "array<long>", pa.list_(pa.string()): "array<string>"}


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL[f.type]}" for f in schema)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class TestBlock:
    """Items of one block: their words as numbers, and their distinct windows."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        numbers, owners, windows = [], [], {}
        for name, text in items:
            w = [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words(text)]
            begin, size = len(numbers), min(window, len(w))
            numbers += w
            owners += [name] * len(w)
            for k in range(len(w) - size + 1 if w else 0):
                windows.setdefault(tuple(w[k:k + size]), []).append((begin + k, begin + len(w)))
        self.numbers = np.array(numbers, np.int32)
        self.windows = list(windows.values())  # of each distinct window: (place, end of item) of its suffixes
        self.owners = owners
        self.sizes = np.array([len(k) for k in windows], np.int64)
        self.table = np.full((len(windows), window), -1, np.int32)
        for row, key in enumerate(windows):
            self.table[row, :len(key)] = key
        self.shortest = int(self.sizes.min()) if len(windows) else 0
        self.deepest = max((e - p for v in self.windows for p, e in v), default=0)


class SuffixArray:
    """Suffixes of ``ids`` (0: unknown word or end of a document) in runs of
    known words of ``shortest`` or more, ordered by their first ``deepest`` words."""

    def __init__(self, ids: np.ndarray, shortest: int, deepest: int):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).view(np.int8), [0]))))
        begin, end = edges[::2], edges[1::2]
        keep = end - begin >= shortest
        begin, size = begin[keep], (end - begin)[keep]
        total = int((size + 1).sum())
        first = np.concatenate(([0], np.cumsum(size + 1)[:-1])) if len(size) else size
        run = np.repeat(np.arange(len(size)), size + 1)
        within = np.arange(total) - first[run] if total else np.zeros(0, np.int64)
        inside = within < size[run] if total else np.zeros(0, bool)
        self.place = np.where(inside, begin[run] + within, -1) if total else within  # in ids
        self.words = np.where(inside, ids[np.maximum(self.place, 0)], 0).astype(np.int32) if total else np.zeros(0, np.int32)
        rank, k = self.words.astype(np.int64), 1
        while total:
            after = np.zeros(total, np.int64)
            if k < total:
                after[:-k] = rank[k:]
            after[rank == 0] = 0
            if k >= max(deepest, 1):
                break
            both = rank * (int(after.max()) + 1) + after
            order = np.argsort(both, kind="stable")
            both = both[order]
            new = np.empty(total, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(both[1:] != both[:-1])))
            rank, k = new + (0 if not inside.all() else 1), 2 * k
            if int(new.max()) + 1 == total:
                break
        self.order = np.argsort(rank, kind="stable")
        self.order = self.order[inside[self.order]]

    def _prefix(self, rows: np.ndarray, width: int) -> np.ndarray:
        padded = np.concatenate((self.words, np.zeros(width, np.int32)))
        return padded[rows[:, None] + np.arange(width)]

    def search(self, table: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[low, high) in the array of suffixes that begin with each row of ``table``."""
        bounds = []
        used = np.arange(table.shape[1]) < sizes[:, None]
        for upper in (False, True):
            low, high = np.zeros(len(table), np.int64), np.full(len(table), len(self.order), np.int64)
            while (open_ := np.flatnonzero(low < high)).size:
                mid = (low[open_] + high[open_]) // 2
                found = self._prefix(self.order[mid], table.shape[1])
                differ = (found != table[open_]) & used[open_]
                at = differ.argmax(axis=1)
                row = np.arange(len(open_))
                less = np.where(differ[row, at], found[row, at] < table[open_][row, at], upper)
                low[open_[less]], high[open_[~less]] = mid[less] + 1, mid[~less]
            bounds.append(low)
        return bounds[0], bounds[1]


def matches_in(ids: list[np.ndarray], test: TestBlock, step: int = 8192) -> list[tuple]:
    """Of each document: starts and ends of window occurrences, items, and the
    longest verbatim match (words, place, item)."""
    found = [[[], [], set(), (0, 0, None)] for _ in ids]
    lengths = np.array([len(x) for x in ids], np.int64)
    if not len(test.windows) or not lengths.sum():
        return found
    joined = np.concatenate([np.concatenate((x, [0])) for x in ids]).astype(np.int32)
    begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    array = SuffixArray(joined, test.shortest, test.deepest)
    if not len(array.order):
        return found
    for k in range(0, len(test.table), step):
        sizes = test.sizes[k:k + step]
        low, high = array.search(test.table[k:k + step], sizes)
        for w in np.flatnonzero(high > low):
            spots = array.order[low[w]:high[w]]
            places = array.place[spots]
            docs = np.searchsorted(begins, places, "right") - 1
            suffixes = test.windows[k + w]
            owners = {test.owners[p] for p, _ in suffixes}
            for d, at in zip(docs.tolist(), (places - begins[docs]).tolist()):
                found[d][0].append(at)
                found[d][1].append(at + int(sizes[w]))
                found[d][2] |= owners
            for p, e in suffixes:  # extend to the longest match of this test suffix
                want = test.numbers[p:e]
                for j in range(0, len(spots), 4096):
                    same = np.logical_and.accumulate(array._prefix(spots[j:j + 4096], e - p) == want, axis=1).sum(axis=1)
                    at = (places - begins[docs])[j:j + 4096]
                    for d, x, n in zip(docs[j:j + 4096].tolist(), at.tolist(), same.tolist()):
                        if n > found[d][3][0]:
                            found[d][3] = (n, x, test.owners[p])
    return found


def summary(n_words: int, starts, ends, items) -> tuple[int, int, str, bool]:
    """(n_hit, n_items, items_sha256, contaminated) from all occurrences."""
    hit, reach = 0, 0
    for s, e in sorted(zip(starts, ends)):
        hit += max(0, e - max(s, reach))
        reach = max(reach, e)
    names = sorted(set(items))
    return hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0 and 20 * hit >= n_words


def _blocks(benchmark: DataFrame, block_chars: int, window: int):
    """The benchmark, block by block; the driver holds one block's texts at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text") + F.length("item_id") + 16)).first()[0] or 0
    n = max(1, -(-total // block_chars))
    for b in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield TestBlock([(r.item_id, r.text.encode()) for r in part], window)


def _search(test: Broadcast) -> Callable:
    """On the executors: batches with doc_id and text to MATCHES, all occurrences of the block's windows."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        block = test.value
        number = block.vocabulary.get
        for b in tidy(batches):
            values = utf8(b.column("text"))
            ids = [np.concatenate([np.fromiter(map(number, w, repeat(0)), np.int32, len(w))
                                   for w in map(words, pieces(t))]) for t in values]
            rows = matches_in(ids, block)
            yield batch(MATCHES, {
                "doc_id": b.column("doc_id").to_pylist(), "text_key": [xxh3_128_hexdigest(t) for t in values], "n_words": [len(x) for x in ids],
                "starts": [r[0] for r in rows], "ends": [r[1] for r in rows], "items": [sorted(r[2]) for r in rows],
                "longest": [r[3][0] for r in rows], "longest_at": [r[3][1] for r in rows],
                "longest_item": [r[3][2] for r in rows]})

    return search


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """MATCHES to RESULT."""
    for b in batches:
        c = {n: b.column(n).to_pylist() for n in MATCHES.names}
        judged = [summary(*r) for r in zip(c["n_words"], c["starts"], c["ends"], c["items"])]
        hit, items, sha, bad = zip(*judged) if judged else ((), (), (), ())
        yield batch(RESULT, c | {"n_hit": hit, "n_items": items, "items_sha256": sha, "contaminated": bad})


def _searches(documents: DataFrame, benchmark: DataFrame, block_chars: int, window: int) -> list[Callable]:
    """A search for each block; what they share is bounded by block_chars."""
    in_small_batches(documents.sparkSession)
    share = documents.sparkSession.sparkContext.broadcast
    return [_search(share(t)) for t in _blocks(benchmark, block_chars, window)]


def _contamination(documents: DataFrame, searches: list[Callable]) -> DataFrame:
    docs = texts(documents)
    if len(searches) == 1:  # searched and judged by one worker a task
        search = searches[0]
        return docs.mapInArrow(lambda batches: _judge(search(batches)), ddl(RESULT))
    found = _merged([docs.mapInArrow(search, ddl(MATCHES)) for search in searches])
    return found.mapInArrow(lambda batches: _judge(tidy(batches)), ddl(RESULT))


def contamination(documents: DataFrame, benchmark: DataFrame, block_chars: int = 8_000_000,
                  window: int = WINDOW) -> DataFrame:
    """One row a document: see RESULT. Without a shuffle while the benchmark is one block."""
    return _contamination(documents, _searches(documents, benchmark, block_chars, window))


def _merged(passes: list[DataFrame]) -> DataFrame:
    """Hits of all passes by document. Rows that repeat a document are alike
    in every pass, so one row of each pass is kept and as many copies given back."""
    rows = None
    for k, p in enumerate(passes):
        p = p.withColumn("block", F.lit(k))
        rows = p if rows is None else rows.unionByName(p)
    one = rows.groupBy("doc_id", "text_key", "n_words", "block").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("starts", "ends", "items")],
        F.first(F.struct("longest", "longest_at", "longest_item")).alias("best"))
    g = one.groupBy("doc_id", "text_key", "n_words").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.max_by("best", F.col("best.longest")).alias("best"), F.max("copies").cast("int").alias("copies"))
    return (g.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
            .select("doc_id", "text_key", "n_words", "starts", "ends", "items", "best.*"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, block_chars: int = 8_000_000, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with all their columns. While
    the benchmark is one block a row's text decides alone, so rows are judged
    and kept in one pass. Hits of several blocks are merged first; rows are
    told apart by doc_id and text then: clean ones stay whatever id they share."""
    searches = _searches(documents, benchmark, block_chars, window)
    if len(searches) == 1:
        search = searches[0]

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now = []

            def text_of() -> Iterator[pa.RecordBatch]:
                for b in batches:
                    now[:] = [b]
                    yield pa.RecordBatch.from_arrays([pa.nulls(b.num_rows, pa.int64()), b.column("text").cast(pa.string())], names=["doc_id", "text"])

            for judged in _judge(search(text_of())):  # one for each batch
                yield now[0].filter(pc.invert(judged.column("contaminated")))

        return documents.mapInArrow(clean, documents.schema)
    bad = _contamination(documents, searches).filter("contaminated").select("doc_id", "text_key").distinct()
    text_key = F.arrow_udf(lambda t: pa.array([xxh3_128_hexdigest(x) for x in utf8(t)], pa.string()), "string")
    whole = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), text_key(F.col("text").cast("string")).alias("key"))
    same = F.col("d.id").eqNullSafe(F.col("bad.doc_id")) & (F.col("d.key") == F.col("bad.text_key"))
    return whole.alias("d").join(bad.alias("bad"), same, "left_anti").select("row.*")
