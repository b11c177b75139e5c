"""N-gram Jaccard join (op2) with a token-group matrix.

Every document is the set of its four-word shingles, as 64-bit hashes; equal
sets are one node. Two nodes link at a Jaccard similarity of 0.85 or more.

1. A fixed-size count sketch of all shingles gives one order of tokens for
   the whole corpus, rare ones first. Any common order is correct; a good one
   keeps frequent passages out of prefixes.
2. Two sets as similar as that share a token among the first
   ``n - ceil(0.85 n) + 1`` of each. Only tokens in two nodes' prefixes stay.
3. Nodes are first put in families by their least token (similar sets share
   it, with their similarity as probability); families of over ``GROUP`` nodes
   are cut into parts by hash, in two ways. A node shares enough prefix tokens
   with its family, or links with nothing in it; sets of the first are
   fetched, and all links inside a family's part found.
4. The rows of the token-group matrix: nodes that share as many prefix tokens
   with others as a link between equal sizes needs are grouped by the most
   frequent of them (near copies hold the same), others stay with their family;
   groups are cut into parts of about ``GROUP``. Nodes already connected need no further link between them: a node
   queries only groups with a node of a larger component. The number of its
   tokens in the union of a group's prefixes bounds its overlap with every
   member, and again, once the sets are there, the union of their whole sets:
   only groups that qualify are opened, and their members compared exactly.
   Before whole sets are fetched, a fourth of each (``heads``, 32 bits a token)
   bounds every overlap: queries and members that link with nothing go there.
5. Components of all links, over the nodes; a document has its node's.

Hot keys: copies are one node; a hot token is salted, and its nodes meet its
groups, not each other; queries on one group are dealt in parts of ``QUERIES``; joins are left
to adaptive execution to split. Broadcast: the sketch (4 MB), a Bloom filter of
document ids (8 MB) and the number of parts by bin of groups (4 MB), all of
fixed size. Bloom or bin collisions only add nodes to groups, or cut more
parts: results do not depend on them.

Defined cases: null and empty texts have n_shingles 0 and link with nothing;
component_id is the smallest non-null doc_id of the component, and the
document's own id if it has no shingles; repeated rows keep a row each; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from ..operators.graph import connected_components
from .base import batch, in_small_batches, let_go, pieces, stage, texts, tidy, utf8
from .url_filter import bloom, maybe_in

WORDS, PERCENT = 4, 85
GROUP, QUERIES, HOT, SALTS = 256, 256, 10_000, 64
SKETCH_BITS, SKETCH_BLOCKS = 20, 16
BLOOM_BITS, BIN_BITS = 26, 20
KEEP_BLOCKS = 1 << 17
HEAD_BITS = 2


def shingle_set(text: bytes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    parts = [np.fromiter(map(xxh64_intdigest, w), np.uint64, len(w))
             for w in (p.lower().split() for p in pieces(text))]  # bytes: A-Z, and the six ASCII white spaces
    h = parts[0] if len(parts) == 1 else np.concatenate(parts)
    if not len(h):
        return h
    if len(h) < n:
        return np.array([xxh64_intdigest(h.tobytes(), 1)], np.uint64)
    key = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        key = (key ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    key.sort()
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    return key[new]


def _mixed(key: np.ndarray) -> np.ndarray:
    key = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (key ^ (key >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)


_KEYS = ("nh", "anchor", "bin", "cut0", "cut1")
_PROFILE = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("nh", pa.int64()), ("anchor", pa.int64()),
                      ("bin", pa.int32()), ("cut0", pa.int32()), ("cut1", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])


def node_keys(node: bytes, s: np.ndarray) -> tuple[int, int, int, int, int]:
    """(nh, anchor, bin, cut0, cut1) of a node."""
    least = s[:1].view(np.int64)
    return (int.from_bytes(node[:8], "little", signed=True), int(least[0]), int(_mixed(least)[0] >> np.uint64(64 - BIN_BITS)),
            int.from_bytes(node[8:11], "little"), int.from_bytes(node[11:14], "little"))


def profiles(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: of each document (doc_id, n, node) and, made from the
    node, nh (a short hash), anchor (the set's least token), bin (a hash of
    it) and cut0, cut1; of each task (block, counts), its part of the token
    sketch."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for b in tidy(batches):
            sets = [shingle_set(t) for t in utf8(b.column("text"))]
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            if len(flat):
                counts += np.bincount((flat >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS).astype(np.uint32)
            node = [xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            made = [node_keys(x, s) if len(s) else (None,) * 5 for x, s in zip(node, sets)]
            yield batch(_PROFILE, {"doc_id": b.column("doc_id").to_pylist(), "n": [len(s) for s in sets], "node": node}
                        | dict(zip(_KEYS, zip(*made) if made else [[]] * 5)) | {"block": [None] * len(sets), "counts": [None] * len(sets)})
        if counts.any():
            yield batch(_PROFILE, {c: [None] * SKETCH_BLOCKS for c in ("doc_id", "n", "node", *_KEYS)} | {
                "block": range(SKETCH_BLOCKS), "counts": [zlib.compress(c.tobytes(), 1) for c in counts.reshape(SKETCH_BLOCKS, -1)]})

    return docs.mapInArrow(read, "doc_id long, n long, node binary, nh long, anchor long, bin int, cut0 int, cut1 int, block int, counts binary")


def _sketch(parts: DataFrame) -> np.ndarray:
    """The tasks' counts added up block by block; 2^SKETCH_BITS numbers in all."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in tidy(batches):
            for k, c in zip(b.column("block").to_pylist(), b.column("counts").to_pylist()):
                c = np.frombuffer(zlib.decompress(c), np.uint32).astype(np.uint64)
                total[k] = total[k] + c if k in total else c
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())], names=["block", "counts"])

    rows = parts.repartition(SKETCH_BLOCKS, "block").mapInArrow(add, "block int, counts binary").collect()
    out = np.zeros((SKETCH_BLOCKS, (1 << SKETCH_BITS) // SKETCH_BLOCKS), np.uint64)
    for r in rows:
        out[r.block] = np.frombuffer(r.counts, np.uint64)
    return np.minimum(out.ravel(), np.iinfo(np.uint32).max).astype(np.uint32)


def prefixes(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(token, nh, hot) of the tokens in each set's prefix; ``hot`` if the
    sketch counts the token, or its bucket, over HOT times."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        counts = shared.value
        for b in tidy(batches):
            tokens, owners, hot, seen = [], [], [], set()
            for s in map(shingle_set, utf8(b.column("text"))):
                node = xxh3_128_digest(s.tobytes())
                if len(s) and node not in seen:
                    seen.add(node)
                    first = len(s) - -(-PERCENT * len(s) // 100) + 1
                    often = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    order = np.lexsort((s, often))[:first]
                    tokens.append(s[order])
                    hot.append(often[order] > HOT)
                    owners.append(np.full(len(order), int.from_bytes(node[:8], "little", signed=True), np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(owners)), pa.array(np.concatenate(hot))], names=["token", "nh", "hot"])

    return docs.mapInArrow(read, "token long, nh long, hot boolean")


def _bloom_bits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m = _mixed(ids)
    return (m >> np.uint64(64 - BLOOM_BITS)).astype(np.int64), (_mixed(m) >> np.uint64(64 - BLOOM_BITS)).astype(np.int64)


def _bloom(ids: DataFrame) -> np.ndarray:
    """Bloom filter of column ``cid``: two bits each of 2^BLOOM_BITS. Tasks
    send words of 64 bits; the driver gets the filter, of fixed size."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tidy(batches):
            at = np.unique(np.concatenate(_bloom_bits(b.column("cid").to_numpy(zero_copy_only=False))))
            bit = np.left_shift(np.uint64(1), (at & 63).astype(np.uint64))
            word, first = np.unique(at >> 6, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(np.bitwise_or.reduceat(bit, first).view(np.int64) if len(at) else np.zeros(0, np.int64))], names=["word", "bits"])

    words = ids.filter("cid is not null").mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(1 << (BLOOM_BITS - 6), np.int64)
    got = words.toArrow()
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out


def head(s: np.ndarray) -> np.ndarray:
    """The set's tokens in the first 2^-HEAD_BITS of all hashes, cut to 32 bits and
    in order: sets have at least as many of them in common as of the whole tokens."""
    return (s[:np.searchsorted(s, np.uint64(1 << (64 - HEAD_BITS)))] >> np.uint64(32 - HEAD_BITS)).astype(np.uint32)


def node_sets(docs: DataFrame, cids: DataFrame, parts: np.ndarray, heads: bool = False) -> DataFrame:
    """(anchor, part, way, node, tokens) of the documents whose id is one of
    ``cids``, and of a few others that the filter lets through; null ids
    always pass. ``parts``: of each bin, how many parts its groups are cut in.
    ``heads``: tokens are those of ``head``."""
    shared = docs.sparkSession.sparkContext.broadcast((_bloom(cids), parts))
    names = ["anchor", "part", "way", "node", "tokens"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        filter_, parts = shared.value
        for b in tidy(batches):
            ids = b.column("doc_id")
            a, c = _bloom_bits(ids.fill_null(0).to_numpy(zero_copy_only=False))
            hit = lambda at: (filter_[at >> 6] >> (at & 63)) & 1
            keep = pa.array((hit(a) & hit(c)).astype(bool) | ids.is_null().to_numpy(zero_copy_only=False))
            rows = []
            for s in (shingle_set(t) for t in utf8(b.column("text").filter(keep))):
                if len(s):
                    data = s.tobytes()
                    node = xxh3_128_digest(data)
                    data = head(s).tobytes() if heads else data
                    _, anchor, bin_, cut0, cut1 = node_keys(node, s)
                    rows.append((anchor, cut0 % int(parts[bin_]), 0, node, data))
                    if parts[bin_] > 1:
                        rows.append((anchor, cut1 % int(parts[bin_]), 1, node, data))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=names)

    return docs.mapInArrow(read, "anchor long, part int, way int, node binary, tokens binary")


class Group:
    """A row of the token-group matrix: its members' sets, and their union."""

    def __init__(self, nodes: list[bytes], sets: list[np.ndarray]):
        self.nodes, self.sizes = nodes, np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.member = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.union, first = np.unique(flat[order], return_index=True)
        self.first = np.concatenate((first, [len(flat)]))

    def linked(self, query: np.ndarray) -> np.ndarray:
        """Members that link with the query, of a group whose bound qualifies."""
        at = self._found(query)
        if 100 * len(at) < PERCENT * len(query):  # even the union overlaps too little
            return np.zeros(0, np.int64)
        both = self._shared(at)
        return np.flatnonzero(100 * both >= PERCENT * (self.sizes + len(query) - both))

    def possible(self, query: np.ndarray, n: int, whole: np.ndarray) -> np.ndarray:
        """Members that may link with a query of n tokens, of a group of heads;
        ``whole``: the sizes of its members' whole sets. What a head lacks of the
        other the whole set lacks too."""
        both = self._shared(self._found(query))
        most = np.minimum(n - (len(query) - both), whole - (self.sizes - both))
        return np.flatnonzero((100 + PERCENT) * most >= PERCENT * (whole + n))

    def _found(self, query: np.ndarray) -> np.ndarray:
        if not len(self.union):
            return np.zeros(0, np.int64)
        at = np.searchsorted(self.union, query)
        return at[self.union[np.minimum(at, len(self.union) - 1)] == query]

    def _shared(self, at: np.ndarray) -> np.ndarray:
        """Of each member, how many of the union's tokens ``at`` these places it has."""
        begin, size = self.first[at], self.first[at + 1] - self.first[at]
        spread = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(self.member[spread], minlength=len(self.nodes))


def _runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of a sorted partition, key by key."""
    now, rows = None, []
    for b in tidy(batches):
        for r in b.to_pylist():
            k = tuple(r[c] for c in key)
            if k != now:
                if rows:
                    yield now, rows
                now, rows = k, []
            rows.append(r)
    if rows:
        yield now, rows


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) that connect each group's members as all their links do."""
    for _, rows in _runs(batches, ["anchor", "part", "way"]):
        held = {r["node"]: np.frombuffer(r["tokens"], np.uint64) for r in rows}
        if len(held) > 1:
            nodes, sets = list(held), list(held.values())
            group, root = Group(nodes, sets), np.arange(len(nodes))
            for i, s in enumerate(sets):
                near = np.unique(root[np.append(group.linked(s), i)])
                root[np.isin(root, near)] = near[0]
            moved = np.flatnonzero(root != np.arange(len(nodes))).tolist()
            if moved:
                yield pa.RecordBatch.from_arrays([pa.array([nodes[root[i]] for i in moved], pa.binary()), pa.array([nodes[i] for i in moved], pa.binary())], names=["u", "v"])


_ROLES = pa.schema([("node", pa.binary()), ("cid", pa.int64()), ("anchor", pa.int64()), ("part", pa.int32()), ("salt", pa.int32()), ("member", pa.bool_())])


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The roles of queries and members that, by their heads, may link with one of the other."""
    for key, rows in _runs(batches, ["anchor", "part", "salt"]):
        held = {r["node"]: r for r in rows if r["member"]}
        asked = {r["node"]: r for r in rows if not r["member"]}
        if held and asked:
            group = Group(list(held), [np.frombuffer(r["tokens"], np.uint32) for r in held.values()])
            whole = np.array([r["n"] for r in held.values()], np.int64)
            near, members = [], np.zeros(len(held), bool)
            for q in asked.values():
                found = group.possible(np.frombuffer(q["tokens"], np.uint32), q["n"], whole)
                if len(found):
                    near.append(q)
                    members[found] = True
            near += [r for r, m in zip(held.values(), members.tolist()) if m]
            if near:
                yield batch(_ROLES, {c: [r[c] for r in near] for c in ("node", "cid", "member")} | {c: [x] * len(near) for c, x in zip(("anchor", "part", "salt"), key)})


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of queries with the members of the group they are dealt to."""
    for _, rows in _runs(batches, ["anchor", "part", "salt"]):
        held = {r["node"]: np.frombuffer(r["tokens"], np.uint64) for r in rows if r["member"]}
        if held:
            group = Group(list(held), list(held.values()))
            asked = {r["node"]: r["tokens"] for r in rows if not r["member"]}
            found = [(q, group.nodes[m]) for q, d in asked.items() for m in group.linked(np.frombuffer(d, np.uint64)).tolist()]
            if found:
                u, v = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])


def _by_node(posted: DataFrame) -> DataFrame:
    """(nh, held): of each node the tokens that another node's prefix holds
    too, with the number of postings of each. A hot token is kept unseen, under
    salts (at most HOT postings of a token meet in a task), and counts as HOT."""
    salted = posted.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("nh"), F.lit(SALTS))).otherwise(0))
    together = Window.partitionBy("token", "salt")
    shared = (salted.withColumn("least", F.min("nh").over(together)).withColumn("most", F.max("nh").over(together))
              .withColumn("seen", F.when(F.col("hot"), HOT).otherwise(F.count(F.lit(1)).over(together)).cast("int"))
              .filter("hot or least < most").select("token", "salt", "nh", "seen").distinct())
    return shared.groupBy("nh").agg(F.collect_list(F.struct("token", "seen")).alias("held"))


def _needed(n: Column, m: Column) -> Column:
    """Least number of tokens that linked sets of n and m tokens share in their
    prefixes: their least overlap, less all of the set whose prefix ends first
    that lies behind its prefix."""
    return F.ceil(F.lit(PERCENT) * (n + m) / F.lit(100 + PERCENT)) - F.ceil(F.lit(PERCENT) * F.greatest(n, m) / F.lit(100)) + 1


def _qualified(counted: DataFrame, *group: str) -> DataFrame:
    """Rows (node, n, *group, tokens, least, most) added up by node and group,
    those kept whose tokens suffice for some member's size."""
    each = counted.groupBy("node", "n", *group).agg(
        F.sum("tokens").alias("tokens"), F.min("least").alias("least"), F.max("most").alias("most"))
    n = F.col("n")
    low = F.greatest("least", F.ceil(F.lit(PERCENT) * n / 100))
    high = F.least("most", F.floor(F.lit(100) * n / PERCENT))
    # what is needed grows up to a member of the query's own size and then falls by PERCENT^2 / (100 (100 + PERCENT))
    # a size, give or take the two ceilings, which move it by less than 2: it is least at the low end, or so near the high one
    near = -(-200 * (100 + PERCENT) // PERCENT**2)
    return (each.filter((low <= high) & (F.col("tokens") >= F.least(_needed(n, low), *(_needed(n, F.greatest(low, high - k)) for k in range(near)))))
            .select("node", *group))


def near_own(held: DataFrame) -> DataFrame:
    """Nodes (nh) that their own group's bound lets through. ``held``: (token,
    node, n, anchor, part); a part of a group is bounded, so are the windows."""
    together = Window.partitionBy("at")  # one hash of token and part: parts that share one would only let more nodes through
    at = held.select("node", "n", F.xxhash64("token", "anchor", "part").alias("at"))
    shared = at.select("node", "n", F.count(F.lit(1)).over(together).alias("nodes"), F.min("n").over(together).alias("least"),
                       F.max("n").over(together).alias("most"), F.lit(1).alias("tokens")).filter("nodes > 1")
    return _qualified(shared)


def queries_of(held: DataFrame, ranked: DataFrame) -> DataFrame:
    """Queries on the matrix that its bound lets through: (node, anchor, part)
    of groups that hold a node of higher rank, where all parts of the group
    together hold enough of the query's tokens. ``held``: (token, node, n,
    anchor, rank); ``ranked``: (node, anchor, part, rank)."""
    key = ["token", "anchor"]
    at_groups = stage(held.groupBy(*key).agg(F.count(F.lit(1)).alias("nodes"), F.max("rank").alias("top"), F.min("rank").alias("low"),
                                             F.min("n").alias("least"), F.max("n").alias("most")), "jaccard-at-groups")
    # tokens of the same groups ask the same: they are taken together, with their number
    asks = at_groups.groupBy("token").agg(F.bit_xor(F.xxhash64("anchor")).alias("ask"), F.count(F.lit(1)).alias("groups"),
                                          F.max("top").alias("over"), F.min("low").alias("under"))
    asks = asks.filter("groups > 1 and under < over").select("token", "ask", "over")
    groups = (at_groups.join(asks.select("token", "ask"), "token").groupBy("ask", "anchor")
              .agg(F.max("top").alias("top"), F.min("least").alias("least"), F.max("most").alias("most")))
    asking = (held.join(asks, "token").filter("rank < over")
              .groupBy("ask", "node", "n", "rank", F.col("anchor").alias("home")).agg(F.count(F.lit(1)).alias("tokens")))
    meets = ((asking["ask"] == groups["ask"]) & (F.col("rank") < F.col("top")) & (F.col("anchor") != F.col("home"))
             & (F.lit(100) * F.col("n") >= F.lit(PERCENT) * F.col("least")) & (F.lit(100) * F.col("most") >= F.lit(PERCENT) * F.col("n")))
    away = asking.join(groups, meets).select("node", "n", "anchor", "tokens", "least", "most")
    home = (held.join(at_groups.filter("nodes > 1 and low < top"), key).filter("rank < top")
            .select("node", "n", "anchor", F.lit(1).alias("tokens"), "least", "most"))
    tops = ranked.groupBy("anchor", "part").agg(F.max("rank").alias("top"))
    return (_qualified(away.unionByName(home), "anchor").join(ranked.select("node", "rank"), "node")
            .join(tops, "anchor").filter("rank < top").select("node", "anchor", "part"))


def _parts(classes: DataFrame) -> np.ndarray:
    """Of each bin of anchors, the number of parts that its largest group is
    cut in, where that is over GROUP; the driver gets 2^BIN_BITS rows at most."""
    large = (classes.groupBy("bin", "anchor").agg(F.count(F.lit(1)).alias("nodes")).filter(F.col("nodes") > GROUP)
             .groupBy("bin").agg(F.ceil(F.max("nodes") / GROUP).cast("int").alias("parts")).toArrow())
    out = np.ones(1 << BIN_BITS, np.int32)
    out[large.column("bin").to_numpy()] = large.column("parts").to_numpy()
    return out


def _of_bins(spark: SparkSession, parts: np.ndarray) -> DataFrame:
    """(bin, parts) of the bins whose groups are cut; 2^BIN_BITS rows at most: bounded for a broadcast.
    Made of Arrow: a list would start Python workers of another kind on every executor, which stay."""
    cut = np.flatnonzero(parts > 1)
    return F.broadcast(spark.createDataFrame(pa.table({"bin": pa.array(cut, pa.int32()), "parts": pa.array(parts[cut], pa.int32())})))


def ranks(comp: DataFrame) -> DataFrame:
    """(node, comp, rank) of (node, comp): larger components (by powers of two)
    rank higher, those of like size by a hash of 59 bits; all in one long."""
    size = comp.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    return comp.join(size, "comp").select("node", "comp", _rank(F.col("size"), F.col("comp")).alias("rank"))


def _rank(size: Column, comp: Column) -> Column:
    return F.shiftleft(F.least(F.floor(F.log2(size)), F.lit(15)).cast("long"), 59).bitwiseOR(F.shiftrightunsigned(F.xxhash64(comp), 5))


def links(docs: DataFrame, classes: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(src, dst) links of nodes that connect all that link."""
    spark = docs.sparkSession
    parts = _parts(classes)
    # postings come dealt by nh, as their join needs them: not staged before
    seeds = (classes.join(_by_node(prefixes(docs, sketch)), "nh").join(_of_bins(spark, parts), "bin", "left")
             .select("nh", "node", "n", "cid", "cut0", "held", "anchor", F.pmod("cut0", F.coalesce("parts", F.lit(1))).cast("int").alias("part")))
    seeds = stage(seeds, "jaccard-seeds")
    # below, a node goes by its short hash: nodes that share one would only be compared more often
    near = near_own(seeds.select(F.col("nh").alias("node"), "n", "anchor", "part", F.explode("held.token").alias("token")))
    near = stage(seeds.select("nh", "cid").join(near.withColumnRenamed("node", "nh"), "nh", "left_semi"), "jaccard-near")
    order = ["anchor", "part", "way"]
    inside = node_sets(docs, near.select("cid"), parts).repartition(*order).sortWithinPartitions(*order).mapInArrow(_within, "u binary, v binary")
    comp = stage(connected_components(stage(inside.select(F.col("u").alias("src"), F.col("v").alias("dst")), "jaccard-inside")), "jaccard-tied")
    comp = comp.select("node", F.col("component").alias("comp"))

    hub = F.array_max(F.transform("held", lambda x: F.struct(x["seen"], x["token"])))["token"]
    close = F.size("held") >= _needed(F.col("n"), F.col("n"))
    bin_ = F.pmod(F.xxhash64("hub"), F.lit(1 << BIN_BITS)).cast("int")
    homes = seeds.withColumn("hub", F.when(close, hub)).withColumn("bin", F.when(F.col("hub").isNotNull(), bin_))
    many = _parts(homes.filter("hub is not null").select("bin", F.col("hub").alias("anchor")))
    homes = homes.join(_of_bins(spark, many), "bin", "left").select(
        "nh", "node", "n", "cid", F.col("held.token").alias("tokens"), F.coalesce("hub", "anchor").alias("anchor"),
        F.when(F.col("hub").isNotNull(), F.pmod("cut0", F.coalesce("parts", F.lit(1)))).otherwise(F.col("part")).cast("int").alias("part"))
    ranked = stage(homes.join(ranks(comp).drop("comp"), "node", "left").select(
        "nh", "node", "n", "cid", "tokens", "anchor", "part", F.coalesce("rank", _rank(F.lit(1), F.col("node"))).alias("rank")), "jaccard-ranked")
    held = ranked.select(F.col("nh").alias("node"), "n", "anchor", "rank", F.explode("tokens").alias("token"))
    queries = queries_of(held, ranked.select(F.col("nh").alias("node"), "anchor", "part", "rank"))
    queries = queries.withColumnRenamed("node", "nh").join(ranked.select("nh", "node", "n", "cid"), "nh").drop("nh")
    queries = stage(queries, "jaccard-queries")
    dealt = queries.groupBy("anchor", "part").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("salts"),
                                                  F.min("n").alias("least"), F.max("n").alias("most"))
    fits = (F.lit(100) * F.col("n") >= F.lit(PERCENT) * F.col("least")) & (F.lit(100) * F.col("most") >= F.lit(PERCENT) * F.col("n"))
    members = (ranked.join(dealt, ["anchor", "part"]).filter(fits)  # others are too small or too large for any query
               .select("node", "cid", ranked["n"], "anchor", "part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("member")))
    asking = (queries.join(dealt, ["anchor", "part"])
              .select("node", "cid", queries["n"], "anchor", "part", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), F.lit(False).alias("member")))
    roles = stage(members.unionByName(asking), "jaccard-roles")
    order = ["anchor", "part", "salt"]
    heads = node_sets(docs, roles.select("cid").distinct(), parts, heads=True).filter("way = 0").select("node", "tokens")
    roles = stage(roles.join(heads, "node").repartition(*order).sortWithinPartitions(*order)
                  .mapInArrow(_may_link, "node binary, cid long, anchor long, part int, salt int, member boolean"), "jaccard-possible")
    sets = node_sets(docs, roles.select("cid").distinct(), parts).filter("way = 0").select("node", "tokens")
    outside = (roles.drop("cid").join(sets, "node").repartition(*order).sortWithinPartitions(*order)
               .mapInArrow(_across, "u binary, v binary"))
    ties = comp.select(F.col("comp").alias("src"), F.col("node").alias("dst")).filter("src != dst")
    return ties.unionByName(stage(outside.select(F.col("u").alias("src"), F.col("v").alias("dst")), "jaccard-outside"))


def components(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row a document."""
    return _placed(documents).select("doc_id", "n_shingles", "component_id")


def _placed(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, node, label), a row a document; node
    and label, its component's name, are null without shingles."""
    in_small_batches(documents.sparkSession)
    docs = texts(documents)
    rows = stage(profiles(docs), "jaccard-profiles")
    own = rows.filter("block is null").select("doc_id", "n", "node", *_KEYS)
    classes = stage(own.filter("node is not null").groupBy("node", *_KEYS).agg(F.first("n").alias("n"), F.min("doc_id").alias("cid")), "jaccard-classes")
    sketch = _sketch(rows.filter("block is not null").select("block", "counts"))
    comp = connected_components(links(docs, classes, sketch)).withColumnRenamed("component", "label")
    named = classes.select("node", "cid").join(comp, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("cid").alias("component_id"))
    named = named.select("node", "label").join(least, "label").select("node", "label", "component_id")
    own = own.select("doc_id", F.col("n").alias("n_shingles"), "node")
    return (own.filter("node is not null").join(named, "node").select("doc_id", "n_shingles", "component_id", "node", "label")
            .unionByName(own.filter("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "node", F.lit(None).cast("binary").alias("label"))))


def keep_one(documents: DataFrame) -> DataFrame:
    """Of each component one row, of its smallest doc_id, all columns kept.
    Where rows of one doc_id hold different shingles ("mixed"), each is judged
    by (doc_id, node). A row with a null doc_id goes if its component has an
    id; of a component without any, one row of the least node stays, and rows
    without shingles stay all. Documents that a Bloom filter (fixed size) of the ids in question does not
    know pass without a shuffle."""
    placed = stage(_placed(documents).select("doc_id", "component_id", F.coalesce("node", F.lit(b"")).alias("node"), "label"), "jaccard-components")
    found = placed.filter("doc_id is not null")
    judged = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("doc_id") == F.col("component_id")).alias("first"),
                                         (F.min("node") < F.max("node")).alias("mixed"))
    asked = stage(judged.filter("rows > 1 or not first").select(F.col("doc_id").cast("string").alias("canonical"), "first", "mixed"), "jaccard-asked")
    chosen = found.filter("doc_id = component_id").groupBy("label", "doc_id").agg(F.min("node").alias("node"))
    chosen = (chosen.select(F.col("doc_id").cast("string").alias("canonical"), "node").join(asked.filter("mixed"), "canonical", "left_semi")
              .withColumn("chosen", F.lit(True)))
    whole = documents.filter(F.col("doc_id").isNotNull()).select(F.struct("*").alias("row"), F.col("doc_id").cast("string").alias("canonical"))
    probed = maybe_in(whole, "canonical", bloom(asked, KEEP_BLOCKS), KEEP_BLOCKS)
    node_of = F.arrow_udf(lambda t: pa.array([xxh3_128_digest(s.tobytes()) if len(s) else b"" for s in map(shingle_set, utf8(t))], pa.binary()), "binary").asNondeterministic()  # else conditions on it are pushed below and it is evaluated again for them, in a second worker
    mixed = F.coalesce("mixed", F.lit(False))
    rest = (probed.filter("possible").join(asked, "canonical", "left").filter(mixed | F.coalesce("first", F.lit(True)))
            .withColumn("node", node_of(F.when(mixed, F.col("row.text").cast("string"))))
            .join(chosen, ["canonical", "node"], "left").filter(~mixed | F.coalesce("chosen", F.lit(False)))
            .dropDuplicates(["canonical", "node"]))
    nameless = (placed.filter("doc_id is null and label is not null").groupBy("label")
                .agg(F.min("component_id").alias("id"), F.min("node").alias("node")).filter("id is null").select("node"))
    without = (documents.filter(F.col("doc_id").isNull()).select(F.struct("*").alias("row"))
               .withColumn("node", node_of(F.col("row.text").cast("string"))))
    alone = without.join(nameless, "node", "left_semi").dropDuplicates(["node"])
    return (probed.filter(~F.col("possible")).select("row.*").unionByName(rest.select("row.*"))
            .unionByName(without.filter(F.col("node") == F.lit(b"")).select("row.*")).unionByName(alone.select("row.*")))
