"""SentencePiece encoding and decoding (op3) by a max-plus parallel scan.

The vocabulary's pieces span a lattice over the text. A path is the model's
own encoding exactly if every piece on it, and every two in a row, encode to
themselves (merges that a whole text makes inside two neighbouring pieces are
those that the pair makes alone). So a step from one piece to the next weighs
-1 if the pair is its own encoding and minus infinity if not: the one finite
path is the encoding, and its weight counts the tokens.

A long text is cut into chunks of ``CHUNK`` characters. A state at a boundary
is the piece over the character before it; a chunk's transfer matrix holds the
best weight from each state at its left to each state at its right boundary.
Matrices are combined in max-plus algebra from both ends, which gives the
state of the best path at every boundary, and each chunk is traced back on
its own between its two states. A text of one chunk has fixed ends and needs
no scan. Inside a chunk no piece crosses the start of a word, so words are
solved on their own, the new ones of a group of texts together in numpy, and
kept (two generations of bounded size).

Decoding joins the pieces, bytes for characters that are no piece.

Defined cases: null and empty texts have no tokens and decode to the empty
text; U+2581 in a text is read as a space, as the library does; equal long
texts are encoded once; repeated rows get a row each; an empty table gives no
row; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Memo, held, in_small_batches, stage, texts, tidy

CHUNK = 32768
SPACE = "▁"
NEVER = -np.inf
PAIRS = 1 << 20  # slots of the table of judged pairs, 8 bytes each
GROUP = 1 << 16  # characters of the texts whose words are solved together
FEW = 50  # so many new words are solved one by one


class Vocabulary:
    """Pieces of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str, most: int = 60_000):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(model.GetPieceSize())
        plain = [i for i in size if not (model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i) or model.IsUnused(i))]
        self.id = {model.IdToPiece(i): i for i in plain}
        self.score = {p: model.GetScore(i) for p, i in self.id.items()}
        self.longest = max(map(len, self.id))
        self.byte_id = {int(model.IdToPiece(i)[3:5], 16): i for i in size if model.IsByte(i)}
        out = [b""] * len(size)
        for i in plain:
            out[i] = model.IdToPiece(i).replace(SPACE, " ").encode()
        for b, i in self.byte_id.items():
            out[i] = bytes([b])
        self.bytes = pa.array(out, pa.binary())
        # where no piece crosses: before a space after anything else, around a line end
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.id)
        lines = any("\n" in p and len(p) > 1 for p in self.id)
        self.words = None if crossing or lines else re.compile(f"{SPACE}+[^{SPACE}\n]*|\n+|[^{SPACE}\n]+")
        self.raw_words = re.compile(rb" +[^ \n]*|\n+|[^ \n]+")  # the same in UTF-8, spaces as they are
        self.split: dict[str, tuple[str, str] | None] = {}  # of pieces that encode to themselves: the last merge
        for p in self.id:
            last: list = [None]
            if self.merged(p, last) == [p]:
                self.split[p] = last[0]
        self.tree: dict = {}  # character by character; "" holds the id of a piece that ends there
        for p in self.split:
            node = self.tree
            for c in p:
                node = node.setdefault(c, {})
            node[""] = self.id[p]
        self.piece = {i: p for p, i in self.id.items()}
        self.right, self.left = (Memo(partial(self._spine, side=side), 8192) for side in (1, 0))
        self._flatten()
        self.pairs = array("q", bytes(8 * PAIRS))  # of two pieces the judgement of _follows, in a table of fixed size
        self.known = Memo(self._encode_raw, most, longest=64)

    def _flatten(self) -> None:
        """The tree in arrays, for many words at a time: ``kind`` numbers the
        characters that are pieces from 1; ``edges`` are parent * kinds +
        kind, sorted, and the k-th leads to node k + 1 (the root is 0), where
        piece ``ends[k + 1]`` ends, or none (-1)."""
        single = sorted(c for c in self.id if len(c) == 1)
        self.kind = np.zeros(0x110000, np.uint16 if len(single) < 1 << 16 else np.int32)
        self.kind[[ord(c) for c in single]] = np.arange(1, len(single) + 1)
        self.kinds = len(single) + 1
        edges, ends, level = [], [-1], [self.tree]
        while level:  # by depth: nodes are numbered in the order of their edges
            below = []
            first = len(ends) - len(level)
            for k, node in enumerate(level, first):
                for kind, c in sorted((int(self.kind[ord(c)]), c) for c in node if c):
                    if kind:  # with other characters in pieces, ``complete`` is false
                        edges.append(k * self.kinds + kind)
                        ends.append(node[c].get("", -1))
                        below.append(node[c])
            level = below
        self.edges, self.ends = np.array(edges, np.int64), np.array(ends, np.int64)
        self.complete = all(c in self.id for p in self.id for c in p)
        self.byte_ids = np.array([self.byte_id.get(b, -1) for b in range(256)])

    def _allowed(self, last: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Whether each piece ``i`` may follow the piece ``last`` (-1: a start, or a character that is no piece)."""
        pairs = np.frombuffer(self.pairs, np.int64)
        pair = last << 20 | i
        slot = (last * 40503 ^ i) & PAIRS - 1
        kept = pairs.take(slot)
        free = (last < 0) | (i < 0)
        yes = (kept & 1).astype(bool) | free
        new = np.flatnonzero((kept >> 1 != pair + 1) & ~free)
        if len(new):
            each, first, back = np.unique(pair[new], return_index=True, return_inverse=True)
            judged = np.fromiter(map(self._judge, each.tolist(), slot[new[first]].tolist()), bool, len(each))
            yes[new] = judged[back]
        return yes

    def solve(self, words: list[bytes]) -> list[bytes]:
        """``encode_word`` of many words: their lattices side by side, a step
        at a time over the places equally far from the start of each word."""
        texts = [w.decode().replace(" ", SPACE) for w in words]
        points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        stops = np.cumsum(size + 1) - 1
        starts = stops - size
        kind = self.kind.take(points).astype(np.int64)
        kind[stops] = 0  # no edge
        odd = kind == 0  # characters that are no piece: a step on their own
        odd[stops] = False
        odd = np.flatnonzero(odd)
        place = np.flatnonzero(kind)
        node, edges = np.zeros(len(place), np.int64), self.edges
        froms, tos, which = [odd], [odd + 1], [np.full(len(odd), -1)]
        at = place
        while len(at):  # all pieces at all places, character by character
            edge = node * self.kinds + kind[at]
            k = np.searchsorted(edges, edge)
            there = np.flatnonzero(edges.take(k, mode="clip") == edge)
            place, at, node = place[there], at[there] + 1, k[there] + 1
            i = self.ends[node]
            piece = np.flatnonzero(i >= 0)
            froms.append(place[piece])
            tos.append(at[piece])
            which.append(i[piece])
        came, what = np.full(len(points), -1), np.full(len(points), -1)
        came[starts] = starts
        first, to, which = map(np.concatenate, (froms, tos, which))
        far = first - np.repeat(starts, size + 1)[first]
        order = np.argsort(far.astype(np.uint16) if size.max(initial=0) < 1 << 16 else far, kind="stable")
        first, to, which = first[order], to[order], which[order]
        step = np.cumsum(np.bincount(far, minlength=1)).tolist()
        for a, z in zip([0, *step], step):
            reached = a + np.flatnonzero((came[first[a:z]] >= 0) & (came[to[a:z]] < 0))
            reached = reached[self._allowed(what[first[reached]], which[reached])]
            came[to[reached]], what[to[reached]] = first[reached], which[reached]
        on = np.zeros(len(points), bool)  # where a piece of the path ends
        at = stops[size > 0]
        while len(at):
            on[at] = True
            at = came[at]
            at = at[came[at] != at]
        ids, places = what[on], np.flatnonzero(on)
        plain = ids < 0
        width = np.ones(len(points), np.int64)
        if plain.any():
            c = points[places[plain] - 1]
            width[places[plain]] = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
            ids = np.repeat(ids, width[places])
            ids[ids < 0] = self.byte_ids[np.frombuffer(c.tobytes().decode("utf-32-le").encode(), np.uint8)]
        count = np.concatenate(([0], np.cumsum(on * width) * 4))
        data = ids.astype("<u4").tobytes()
        return [data[a:z] for a, z in zip(count[starts].tolist(), count[stops + 1].tolist())]

    def learn(self, words: set[bytes]) -> None:
        """Keep the words, the new ones solved together if they are many."""
        known, longest = self.known, self.known.longest
        if len(known) >= known.most:
            known.age()
        older = known.older
        absent = [w for w in words if w not in known]
        known.update((w, older[w]) for w in absent if w in older)
        new = [w for w in absent if w not in older and len(w) <= longest]
        if len(new) > FEW and self.complete:
            known.update(zip(new, self.solve(new)))

    def merged(self, text: str, last: list | None = None) -> list[str]:
        """Pieces of a short text by the model's merges: best score first,
        leftmost of equals. ``last`` gets the last merge's two parts."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1], -np.inf)
                if s > best:
                    best, at = s, k
            if at < 0:
                break
            if last is not None:
                last[0] = (parts[at], parts[at + 1])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, piece: str, side: int) -> list[tuple[str, float, float]] | None:
        """The symbols that stand at the piece's right (1) or left (0) end
        while it is merged, each with the score at which it is made and at
        which it is used up. None if a part is made at a worse score than the
        whole, where merges are not in order of score."""
        out, used = [], -np.inf
        while True:
            parts = self.split.get(piece)
            made = self.score[piece] if parts else np.inf
            if made <= used:
                return None
            out.append((piece, made, used))
            if parts is None:
                return out
            piece, used = parts[side], made

    def _judge(self, pair: int, slot: int) -> int:
        """``_follows`` of a pair of ids, kept in its slot over what was there."""
        yes = int(self._follows(pair))
        self.pairs[slot] = pair + 1 << 1 | yes
        return yes

    def _follows(self, pair: int) -> bool:
        """Whether the two pieces (ids, the first shifted by 20 bits), side by side, encode to themselves: no merge
        across their border comes before the symbols there are used up inside
        them. Of equal scores the merge further left comes first."""
        first, second = self.piece[pair >> 20], self.piece[pair & 0xFFFFF]
        a, b = self.right[first], self.left[second]
        if a is None or b is None:
            return self.merged(first + second) == [first, second]
        score = self.score.get
        for x, x_made, x_used in a:
            for y, y_made, y_used in b:
                if x_made > y_used and y_made > x_used:  # both stand there at one time
                    s = score(x + y)
                    if s is not None and s > x_used and s >= y_used:
                        return False
        return True

    def ids_of(self, text: str, path: list[tuple[int, int]]) -> bytes:
        out: list[int] = []
        for at, i in path:
            out += (i,) if i >= 0 else (self.byte_id[b] for b in text[at].encode())
        return struct.pack(f"<{len(out)}I", *out)

    def ending(self, text: str, end: int, low: int) -> Iterator[int]:
        """Starts, at ``low`` or after, of pieces that end at ``end``, longest first."""
        for start in range(max(low, end - self.longest), end):
            if text[start:end] in self.split:
                yield start
        if end - 1 >= low and text[end - 1] not in self.id:
            yield end - 1  # a character that is no piece

    def trace(self, text: str, first: int, last: int, end: int) -> list[tuple[int, int]] | None:
        """(start, id) of the pieces of the finite path over text[first:end]
        after piece ``last``; None if there is none. -1 is the start of a word
        or text, or a character that is no piece: with these nothing merges."""
        size = end - first
        if size <= 0:
            return None
        came, what = [-1] * (size + 1), [-1] * (size + 1)
        came[0], what[0] = 0, last
        tree, pairs, judge = self.tree, self.pairs, self._judge
        for s in range(size):
            if came[s] < 0:
                continue
            last, node = what[s], tree
            for e in range(s + 1, size + 1):
                node = node.get(text[first + e - 1])
                if node is None:
                    break
                i = node.get("")
                if i is None or came[e] >= 0:
                    continue
                if last >= 0:
                    pair = last << 20 | i
                    slot = (last * 40503 ^ i) & PAIRS - 1
                    kept = pairs[slot]
                    if not (kept & 1 if kept >> 1 == pair + 1 else judge(pair, slot)):
                        continue
                came[e], what[e] = s, i
            if came[s + 1] < 0 and text[first + s] not in self.id:
                came[s + 1] = s
        if came[size] < 0:
            return None
        path, at = [], size
        while at:
            path.append((first + came[at], what[at]))
            at = came[at]
        path.reverse()
        return path

    def encode_word(self, word: str) -> bytes:
        return self.ids_of(word, self.trace(word, 0, -1, len(word)))

    def _encode_raw(self, word: bytes) -> bytes:
        return self.encode_word(word.decode().replace(" ", SPACE))

    def encode_words(self, text: str) -> bytes:
        """Ids of a text that starts and ends with whole words. Words are kept
        as UTF-8, which takes half of what text with U+2581 in it does."""
        return next(self.encode_texts([text]))

    def encode_texts(self, texts: list[str]) -> Iterator[bytes]:
        """``encode_words`` of each text; the new words of ``GROUP`` characters are solved together."""
        group, held = [], 0
        for n, text in enumerate(texts, 1):
            group.append(self.raw_words.findall(text.replace(SPACE, " ").encode()))
            held += len(text)
            if held >= GROUP or n == len(texts):
                self.learn(set().union(*group))
                for words in group:
                    yield b"".join(map(self.known.__getitem__, words))
                group, held = [], 0

    def cuts(self, text: str, first: int, end: int) -> list[int]:
        """Word starts in text[first:end], and ``end`` if a word ends there; needs a character before."""
        return [m.start() for m in self.words.finditer(text, first, end)] if self.words else []

    def decode(self, ids: bytes) -> str:
        if not ids:
            return ""
        data = self.bytes.take(pa.array(np.frombuffer(ids, "<u4"))).buffers()[2]  # the values, one after another
        return (data.to_pybytes() if data else b"").removeprefix(b" ").decode("utf-8", "replace")


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per file and Python worker."""
    return held(("pieces", path), lambda: Vocabulary(path))


def prepared(text: str) -> str:
    """The text as the model sees it: a space in front, spaces visible."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def encode_whole(v: Vocabulary, text: str) -> bytes:
    """Ids of a text of one chunk, whose boundary states are its ends."""
    if not text:
        return b""
    return v.encode_word(prepared(text)) if v.words is None else v.encode_words(" " + text)


def encode_all(v: Vocabulary, values: list[str]) -> Iterator[bytes]:
    """``encode_whole`` of each text."""
    if v.words is None:
        return (encode_whole(v, t) for t in values)
    return v.encode_texts([" " + t if t else t for t in values])


# Boundary states are (start, end) of the piece over the character before the
# boundary, in places relative to it; a chunk sees ``longest`` characters more on both sides.

def states_at(v: Vocabulary, text: str, boundary: int) -> list[tuple[int, int]]:
    """All pieces over the character before ``boundary``, in fixed order."""
    out = []
    for end in range(boundary, min(len(text), boundary + v.longest - 1) + 1):
        for start in v.ending(text, end, max(0, end - v.longest)):
            if start < boundary:
                out.append((start - boundary, end - boundary))
    return sorted(set(out))


class Chunk:
    """text[left:right] of a prepared text, with its surroundings."""

    def __init__(self, v: Vocabulary, before: str, body: str, after: str):
        self.v, self.text = v, before + body + after
        self.left, self.right = len(before), len(before) + len(body)
        self.first, self.last = not before, not after

    def enters(self) -> list[tuple[int, int]]:
        return [(0, 0)] if self.first else states_at(self.v, self.text, self.left)

    def leaves(self) -> list[tuple[int, int]]:
        return [s for s in states_at(self.v, self.text, self.right) if not self.last or s[1] == 0]

    def _entered(self, enter: tuple[int, int]) -> tuple[int, int]:
        """Where the chunk's own pieces begin, and the id of the piece before."""
        begin = self.left + enter[1]
        return begin, -1 if self.first else self.v.id.get(self.text[self.left + enter[0]:begin], -1)

    def _ending(self, begin: int, last: int, leave: tuple[int, int]) -> list[tuple[int, int]] | None:
        """Pieces from ``begin`` on to the one that is the leaving state."""
        found = self.v.trace(self.text, begin, last, self.right + leave[1])
        return found if found and found[-1][0] == self.right + leave[0] else None

    def _path(self, enter: tuple[int, int], leave: tuple[int, int]) -> list[tuple[int, int]] | None:
        """The chunk's own pieces: none where one piece reaches over all of it."""
        begin, last = self._entered(enter)
        if not self.first and (self.left + enter[0], begin) == (self.right + leave[0], self.right + leave[1]):
            return []
        return self._ending(begin, last, leave)

    def _inner(self) -> tuple[int, int] | None:
        """First and last word start well inside the chunk: every path passes them."""
        at = [c for c in self.v.cuts(self.text, self.left, self.right) if c > self.left + self.v.longest and c < self.right - self.v.longest
              and not (self.text[c - 1] == SPACE == self.text[c])]
        return (at[0], at[-1]) if at else None

    def matrix(self) -> np.ndarray:
        """Best weight from each entering to each leaving state."""
        enters, leaves, inner = self.enters(), self.leaves(), self._inner()
        out = np.full((len(enters), len(leaves)), NEVER)
        if inner is None:
            for i, e in enumerate(enters):
                for j, s in enumerate(leaves):
                    found = self._path(e, s)
                    if found is not None:
                        out[i, j] = -len(found)
            return out
        middle = -(len(self.v.encode_words(self.text[slice(*inner)])) // 4)
        tails = [self._ending(inner[1], -1, s) for s in leaves]
        for i, e in enumerate(enters):
            head = self.v.trace(self.text, *self._entered(e), inner[0])
            for j, tail in enumerate(tails):
                if head is not None and tail is not None:
                    out[i, j] = middle - len(head) - len(tail)
        return out

    def encode(self, enter: int, leave: int) -> bytes:
        """Ids of the pieces that start in the chunk, traced back between its two states."""
        e, s, inner = self.enters()[enter], self.leaves()[leave], self._inner()
        if inner is None:
            return self.v.ids_of(self.text, self._path(e, s))
        head = self.v.trace(self.text, *self._entered(e), inner[0])
        middle = self.v.encode_words(self.text[slice(*inner)])
        return self.v.ids_of(self.text, head) + middle + self.v.ids_of(self.text, self._ending(inner[1], -1, s))


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product with + for times and max for plus; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1) if a.shape[1] else np.full((a.shape[0], b.shape[1]), NEVER)


def scan(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(entering, leaving) state of the best path for each chunk."""
    ahead, after = [np.zeros((1, 1))], [np.zeros((matrices[-1].shape[1], 1))]
    for m in matrices:
        ahead.append(max_plus(ahead[-1], m))
    for m in reversed(matrices):
        after.append(max_plus(m, after[-1]))
    after.reverse()
    best = [int((a[0] + z[:, 0]).argmax()) for a, z in zip(ahead, after)]
    return list(zip(best, best[1:]))


def _chunks(batches: Iterator[pa.RecordBatch], longest: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """A row a chunk: (text_key, chunk, before, body, after)."""
    names = ["text_key", "chunk", "before", "body", "after"]
    for b in tidy(batches):
        for key, text in zip(b.column("text_key").to_pylist(), b.column("text").to_pylist()):
            ready = prepared(text)
            for k, at in enumerate(range(0, len(ready), chunk)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], pa.string()), pa.array([k], pa.int64()), pa.array([ready[max(0, at - longest):at]], pa.string()),
                     pa.array([ready[at:at + chunk]], pa.string()), pa.array([ready[at + chunk:at + chunk + longest]], pa.string())], names=names)


def _long_ids(long: DataFrame, model: str, chunk: int) -> DataFrame:
    """(text_key, ids) of distinct texts of over one chunk."""
    longest = vocabulary(model).longest
    of_text = long.groupBy("text_key").agg(F.first("text").alias("text"))
    chunks = stage(of_text.mapInArrow(lambda b: _chunks(b, longest, chunk), "text_key string, chunk long, before string, body string, after string"), "pieces-chunks")

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in tidy(batches):
            rows = [Chunk(v, *t).matrix() for t in zip(*(b.column(n).to_pylist() for n in ("before", "body", "after")))]
            yield pa.RecordBatch.from_arrays([b.column("text_key"), b.column("chunk"), pa.array([m.shape[0] for m in rows], pa.int64()),
                                              pa.array([m.tobytes() for m in rows], pa.binary())], names=["text_key", "chunk", "rows", "matrix"])

    def path(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        ways = scan([np.frombuffer(m).reshape(n, -1) for n, m in zip(rows["rows"], rows["matrix"])])
        return pd.DataFrame({"text_key": rows["text_key"].to_numpy(), "chunk": rows["chunk"].to_numpy(), "enter": [a for a, _ in ways], "leave": [z for _, z in ways]})

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in tidy(batches):
            ids = [Chunk(v, *t[:3]).encode(*t[3:]) for t in zip(*(b.column(n).to_pylist() for n in ("before", "body", "after", "enter", "leave")))]
            yield pa.RecordBatch.from_arrays([b.column("text_key"), b.column("chunk"), pa.array(ids, pa.binary())], names=["text_key", "chunk", "ids"])

    ways = (chunks.mapInArrow(transfer, "text_key string, chunk long, rows long, matrix binary")
            .groupBy("text_key").applyInPandas(path, "text_key string, chunk long, enter long, leave long"))
    traced = chunks.join(ways, ["text_key", "chunk"]).mapInArrow(back, "text_key string, chunk long, ids binary")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])
    return stage(traced.groupBy("text_key").agg(parts.alias("parts")), "pieces-long")


def encode(documents: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_crc32, round_trip) of every document; ids
    as an array; ``round_trip``: the ids decode to the text."""
    in_small_batches(documents.sparkSession)
    docs = texts(documents)
    chunk = max(chunk, 2 * vocabulary(model).longest)  # a chunk's two states then share no piece, but in the last one
    short = docs.filter(F.length("text") < chunk).withColumn("parts", F.lit(None).cast("array<binary>"))
    long = docs.filter(F.length("text") >= chunk).withColumn("text_key", F.sha2("text", 256))
    long = long.join(_long_ids(long, model, chunk), "text_key").select("doc_id", "text", "parts")
    names = ["doc_id", "n_tokens", "ids", "ids_crc32", "round_trip"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in tidy(batches):
            values, parts = b.column("text").to_pylist(), b.column("parts").to_pylist()
            whole = encode_all(v, [t for t, p in zip(values, parts) if p is None])
            ids = [next(whole) if p is None else b"".join(p) for p in parts]
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(ends), pa.int64()), lists, pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                 pa.array([v.decode(i) == t for i, t in zip(ids, values)], pa.bool_())], names=names)

    return short.unionByName(long).mapInArrow(write, "doc_id long, n_tokens long, ids array<int>, ids_crc32 long, round_trip boolean")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    in_small_batches(encoded.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in tidy(batches):
            out = [v.decode(np.array(i or [], "<u4").tobytes()) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(read, "doc_id long, text string")
