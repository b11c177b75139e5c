"""Ball index for cosine joins (T4, J16): exact, blocked, without all pairs.

Each block of more than ``tile`` vectors is divided among centres chosen from
the data (farthest first, on a bounded sample); a vector belongs to the ball of
its nearest centre. Angles obey the triangle inequality: a vector within angle
t of some member of a ball is at most its radius + t (and at least its least
angle - t) away from the centre. So a vector visits only such balls, and no
qualifying pair is lost, whatever the sample.

Balls near each other are a group of about ``GROUP`` vectors. A vector is sent
once to every group that has a ball it visits, whatever it visits there, so
what is shuffled is the vectors times the groups they visit, not the balls. A
group's members are cut into rows of about ``GROUP``, its calls into columns of
``CALLS``; a row and a column meet under a key of their own, so no key grows
with the data, however alike the vectors are. A task holds a key's members,
streams its calls past them ball by ball, and passes pairs on as it finds them.

Bounds: at most ``MOST_CENTRES`` centres in all blocks together (they are
broadcast), fitted on at most eight times as many rows; statistics are
collected of their balls and of blocks of more than ``GROUP`` vectors only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged

MOST_CENTRES = 4096
GROUP, CALLS = 8192, 16384
#: Cosines computed at once, pairs passed on at once, rows sent at once.
PRODUCT, PAIRS, ROWS = 1 << 21, 1 << 14, 1 << 11


def farthest_first(rows: np.ndarray, k: int) -> np.ndarray:
    """``k`` rows at most, each the farthest from those before; the first row
    starts, equal rows are taken once."""
    chosen, nearest = [0], rows @ rows[0]
    while len(chosen) < min(k, len(rows)):
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-12:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, rows @ rows[far])
    return rows[chosen]


def centres(units: DataFrame, tile: int, most: int = MOST_CENTRES) -> dict:
    """block -> centres, for the blocks of more than ``tile`` vectors (the
    ``most`` largest of them); about one centre a tile, ``most`` in all."""
    sizes = units.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile)
    large = sizes.orderBy(F.desc("n"), "block").limit(most).collect()
    total = sum(r["n"] for r in large)
    wanted = {r["block"]: max(1, min(-(-r["n"] // tile), most * r["n"] // total)) for r in large}
    if not wanted:
        return {}
    share = units.sparkSession.createDataFrame([(r["block"], int(min(1.0, 4 * wanted[r["block"]] / r["n"]) * (1 << 31))) for r in large if r["block"] is not None],
                                               f"block {units.schema['block'].dataType.simpleString()}, share long")
    place = F.xxhash64("id", "u")
    some = (units.join(F.broadcast(share), "block").filter(F.pmod(place, F.lit(1 << 31)) < F.col("share"))
            .select("block", "u", place.alias("h")).limit(8 * most).collect())
    by_block: dict = {}
    for r in sorted(some, key=lambda r: r["h"]):
        by_block.setdefault(r["block"], []).append(r["u"])
    return {b: farthest_first(np.array(rows), wanted[b]) for b, rows in by_block.items()}


def _numbers(column: pa.ListArray) -> np.ndarray:
    """The vectors of a list column as rows of a matrix; an error where their lengths differ."""
    width = np.diff(column.offsets.to_numpy())
    if len(width) and (width != width[0]).any():
        raise ValueError("vectors of different lengths in a block")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(width), width[0] if len(width) else 0)


def _angles(batch: pa.RecordBatch, index: dict) -> Iterator[tuple]:
    """(block, row numbers, angles to the block's centres) of a batch."""
    rows: dict = {}
    for k, b in enumerate(batch.column("block").to_pylist()):
        rows.setdefault(b, []).append(k)
    u = batch.column("u")
    for b, at in rows.items():
        if b in index:
            yield b, at, np.arccos(np.clip(_numbers(u.take(pa.array(at))) @ index[b].T, -1, 1))
        else:
            yield b, at, np.zeros((len(at), 1))


def _radii(units: DataFrame, index: dict) -> dict:
    """block -> (least, largest) angle of each ball's members to its centre."""
    shared, kind = units.sparkSession.sparkContext.broadcast(index), units.schema["block"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for b, at, angles in _angles(batch, shared.value):
                ball, angle = angles.argmin(1), angles.min(1)
                out += [(b, int(j), float(angle[ball == j].min()), float(angle[ball == j].max())) for j in np.unique(ball)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], batch.schema.field("block").type), *(pa.array([o[k] for o in out], t) for k, t in ((1, pa.int32()), (2, pa.float64()), (3, pa.float64())))],
                                             names=["block", "ball", "least", "most"])

    large = units.filter(F.col("block").isin(list(index))).select("block", "u")
    got = large.mapInArrow(run, f"block {kind}, ball int, least double, most double").groupBy("block", "ball").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    out = {b: (np.full(len(c), np.inf), np.full(len(c), -np.inf)) for b, c in index.items()}
    for r in got.collect():
        out[r["block"]][0][r["ball"]], out[r["block"]][1][r["ball"]] = r["least"], r["most"]
    return out


def visits(units: DataFrame, threshold: float, tile: int, most: int = MOST_CENTRES) -> DataFrame:
    """(id, block, u, ball, visits): each vector's ball, and the balls, its own
    and later ones, that may hold vectors within the threshold."""
    return _placed(units, threshold, tile, most)[0]


def _placed(units: DataFrame, threshold: float, tile: int, most: int) -> tuple[DataFrame, dict]:
    """``visits``, and the centres of the blocks that have some."""
    index = centres(units, tile, most)
    radii = _radii(units, index) if index else {}
    reach = math.acos(max(min(threshold, 1.0), -1.0)) + 1e-7
    shared = units.sparkSession.sparkContext.broadcast((index, radii))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, seen = [0] * batch.num_rows, [[0]] * batch.num_rows
            index, radii = shared.value
            for b, at, angles in _angles(batch, index):
                if b not in index:
                    continue
                least, largest = radii[b]
                ball = angles.argmin(1)
                may = (angles <= largest + reach) & (angles >= least - reach) & (np.arange(angles.shape[1]) > ball[:, None])
                may[np.arange(len(at)), ball] = True
                for k, j, m in zip(at, ball.tolist(), may):
                    own[k], seen[k] = j, np.flatnonzero(m).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32()), pa.array(seen, pa.list_(pa.int32()))], names=[*batch.schema.names, "ball", "visits"])

    kinds = {f.name: f.dataType.simpleString() for f in units.schema}
    schema = f"id {kinds['id']}, block {kinds['block']}, u array<double>, ball int, visits array<int>"
    return staged(units.select("id", "block", "u").mapInArrow(run, schema)), index


def _chain(rows: np.ndarray) -> list[int]:
    """The rows in an order in which each is followed by the nearest of those left."""
    order, left = [0], np.ones(len(rows), bool)
    left[0] = False
    while left.any():
        order.append(int(np.where(left, rows @ rows[order[-1]], -np.inf).argmax()))
        left[order[-1]] = False
    return order


def _groups(placed: DataFrame, index: dict, group: int, calls: int) -> dict:
    """block -> (group of each ball, rows and columns of each group), for the
    blocks with centres or more than ``group`` vectors; others are one key."""
    sizes = placed.groupBy("block", "ball").agg(F.count(F.lit(1)).alias("n")).groupBy("block").agg(
        F.collect_list(F.struct("ball", "n")).alias("balls")).filter(F.col("block").isin(list(index)) | (F.aggregate("balls", F.lit(0).cast("bigint"), lambda t, x: t + x["n"]) > group))
    of, members = {}, {}
    for r in sizes.collect():
        order = _chain(index[r["block"]]) if r["block"] in index else [0]
        n = dict(r["balls"])
        of[r["block"]], members[r["block"]] = np.zeros(len(order), int), [0]
        for ball in order:
            if members[r["block"]][-1] and members[r["block"]][-1] + n.get(ball, 0) > group:
                members[r["block"]].append(0)
            members[r["block"]][-1] += n.get(ball, 0)
            of[r["block"]][ball] = len(members[r["block"]]) - 1
    if not of:
        return {}
    shared, kind = placed.sparkSession.sparkContext.broadcast(of), placed.schema["block"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict = {}
            for b, balls in zip(batch.column("block").to_pylist(), batch.column("visits").to_pylist()):
                for g in set(shared.value[b][balls].tolist()):
                    seen[b, g] = seen.get((b, g), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], batch.schema.field("block").type), pa.array([k[1] for k in seen], pa.int32()),
                                              pa.array(list(seen.values()), pa.int64())], names=["block", "to", "calls"])

    called = placed.filter(F.col("block").isin(list(of))).select("block", "visits").mapInArrow(run, f"block {kind}, to int, calls long")
    columns = {b: np.ones(len(n), int) for b, n in members.items()}
    for r in called.groupBy("block", "to").agg(F.sum("calls").alias("calls")).collect():
        columns[r["block"]][r["to"]] = -(-r["calls"] // calls)
    return {b: (of[b], np.maximum(1, -(-np.array(n) // group)), columns[b]) for b, n in members.items()}


def _lists(starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    """A list for each stretch of the values."""
    n = ends - starts
    offsets = np.concatenate(([0], np.cumsum(n)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[np.repeat(starts - offsets[:-1], n) + np.arange(offsets[-1])], pa.int32()))


def _dealt(placed: DataFrame, groups: dict) -> DataFrame:
    """A row for each key that a vector goes to: as a member (side 0) of its
    ball's group, as a call (side 1) of the balls that it visits in a group."""
    shared = placed.sparkSession.sparkContext.broadcast(groups)
    alone = np.zeros(1, int), np.ones(1, int), np.ones(1, int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of: dict = {}
            for k, b in enumerate(batch.column("block").to_pylist()):
                of.setdefault(b, []).append(k)
            own, h, h2 = (batch.column(c).to_numpy() for c in ("ball", "h", "h2"))
            for b, at in of.items():
                group, rows, columns = shared.value.get(b, alone)
                at, to = np.array(at), batch.column("visits").take(pa.array(at))
                # Members: one row for each column of their group.
                g = group[own[at]]
                times = columns[g]
                first = np.cumsum(times) - times
                yield from sent(batch, 0, np.repeat(at, times), np.repeat(g, times), np.repeat(h[at] % rows[g], times), np.arange(times.sum()) - np.repeat(first, times), None)
                # Calls: one row for each group, and for each row of its members.
                who, ball = np.repeat(at, np.diff(to.offsets.to_numpy())), to.flatten().to_numpy()
                order = np.lexsort((ball, group[ball], who))
                who, ball = who[order], ball[order]
                g = group[ball]
                starts = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (g[1:] != g[:-1])])
                ends, who, g = np.r_[starts[1:], len(ball)], who[starts], g[starts]
                times = rows[g]
                first = np.cumsum(times) - times
                yield from sent(batch, 1, np.repeat(who, times), np.repeat(g, times), np.arange(times.sum()) - np.repeat(first, times), np.repeat(h2[who] % columns[g], times),
                                (np.repeat(starts, times), np.repeat(ends, times), ball))

    def sent(batch, side, at, group, row, column, stretches) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(at), ROWS):
            some = slice(k, k + ROWS)
            rows = batch.take(pa.array(at[some]))
            n = rows.num_rows
            lists = _lists(np.zeros(n, int), np.zeros(n, int), np.zeros(0, int)) if stretches is None else _lists(stretches[0][some], stretches[1][some], stretches[2])
            yield pa.RecordBatch.from_arrays([rows.column("block"), *(pa.array(x[some], pa.int32()) for x in (group, row, column)), pa.array(np.full(n, side), pa.int32()),
                                              rows.column("id"), rows.column("u"), rows.column("ball"), lists],
                                             names=["block", "to", "row", "column", "side", "id", "u", "ball", "visits"])

    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
    h = [F.pmod(F.xxhash64("id", "u", F.lit(k)), F.lit(1 << 31)).alias(c) for k, c in ((1, "h"), (2, "h2"))]
    return placed.select("*", *h).mapInArrow(
        run, f"block {kinds['block']}, to int, row int, column int, side int, id {kinds['id']}, u array<double>, ball int, visits array<int>")


class _Members:
    """The members that a key's calls are compared with, ball by ball."""

    def __init__(self, parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts).sort_by("ball").combine_chunks().to_batches()
        self.rows = rows[0] if rows else parts[0]
        self.ball, self.u = self.rows.column("ball").to_numpy(), _numbers(self.rows.column("u"))

    def pairs(self, calls: pa.RecordBatch, threshold: float) -> Iterator[pa.RecordBatch]:
        u, own, to = _numbers(calls.column("u")), calls.column("ball").to_numpy(), calls.column("visits")
        who, to = np.repeat(np.arange(len(own)), np.diff(to.offsets.to_numpy())), to.flatten().to_numpy()
        order = np.argsort(to, kind="stable")
        who, to = who[order], to[order]
        for ball in np.unique(to):
            low, high = np.searchsorted(self.ball, [ball, ball + 1])
            callers, step = who[slice(*np.searchsorted(to, [ball, ball + 1]))], max(1, PRODUCT // max(1, high - low))
            for k in range(0, len(callers) if high > low else 0, step):
                some = callers[k:k + step]
                near = np.argwhere(u[some] @ self.u[low:high].T >= threshold - 1e-9)
                for m in range(0, len(near), PAIRS):
                    i, j = some[near[m:m + PAIRS, 0]], near[m:m + PAIRS, 1] + low
                    exact = np.cumsum(self.u[j] * u[i], axis=1)[:, -1]  # added up in order, as a fold does
                    ok = exact >= threshold
                    yield self._made(calls, i[ok], j[ok], exact[ok], own[i[ok]] == ball)

    def _made(self, calls: pa.RecordBatch, i: np.ndarray, j: np.ndarray, cosine: np.ndarray, inside: np.ndarray) -> pa.RecordBatch:
        x, y = calls.column("id").take(pa.array(i)), self.rows.column("id").take(pa.array(j))
        once = pc.if_else(pa.array(inside), pc.less(x, y), pc.not_equal(x, y))  # in its own ball a pair is met from both sides
        return pa.RecordBatch.from_arrays([calls.column("block").take(pa.array(i)), pc.min_element_wise(x, y), pc.max_element_wise(x, y), pa.array(cosine)],
                                          names=["block", "id_a", "id_b", "cosine"]).filter(once)


def ball_join(units: DataFrame, threshold: float, tile: int = 512, most: int = MOST_CENTRES, group: int = GROUP, calls: int = CALLS) -> DataFrame:
    """(block, id_a, id_b, cosine) of all pairs id_a < id_b in a block with
    cosine >= threshold. ``units``: (id, block, u) with unit vectors u; rows
    without id or block, and vectors that lack a number, have no pairs."""
    kinds = {f.name: f.dataType.simpleString() for f in units.schema}
    units = staged(units.select("id", "block", "u").filter("id is not null and block is not null and u is not null")) \
        .filter(F.forall("u", lambda x: x.isNotNull() & ~F.isnan(x)))
    placed, index = _placed(units, threshold, tile, most)
    key = ["block", "to", "row", "column"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held = None, [], None
        for batch in batches:
            # Stretches of rows with the same key and side; they are sorted so.
            ends = np.zeros(max(0, batch.num_rows - 1), bool)
            for c in (*key, "side"):
                v = batch.column(c)
                ends |= pc.not_equal(v[1:], v[:-1]).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(ends) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                some = batch.slice(low, high - low)
                if some.num_rows == 0:
                    continue
                this = tuple(some.column(c)[0].as_py() for c in key)
                if this != now:
                    now, parts, held = this, [], None
                if some.column("side")[0].as_py() == 0:
                    parts.append(some)
                elif parts:
                    held = held or _Members(parts)
                    yield from held.pairs(some, threshold)

    dealt = _dealt(placed, _groups(placed, index, group, calls)).repartition(*key).sortWithinPartitions(*key, "side")
    return dealt.mapInArrow(compare, f"block {kinds['block']}, id_a {kinds['id']}, id_b {kinds['id']}, cosine double")
