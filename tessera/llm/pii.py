"""Personal data (op5): base patterns, and a character BiLSTM with CRF
transitions that adds spans the patterns miss.

The patterns' spans on a bounded sample of windows are the labels that the
tagger is trained on, in numpy, along with copies whose separators and leading
plus signs are varied, so that it learns a span's surroundings and shape and
not one notation. Text is decoded in overlapping windows; each character takes
its tag from the window in which it stands most central, and spans are read
off the whole text's tags. An added span must hold a digit or an ``@`` (so
only windows near one are decoded: nothing else could yield a span), must
have the least content of its kind, and must not touch a base span, which
always stays.

Defined cases: null and empty texts have no spans (base_sha256 of the empty
string); without any training window no span is added; long runs of digits or
letters cost linear time; repeated rows get a row each; an empty table gives
no row; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import batch, in_small_batches, let_go, texts, tidy, utf8

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE, NEAR = 64, 32, 24
TAGS = 1 + 2 * len(KINDS)
FIT_WINDOWS = 3000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(rb"[0-9@]")

#: Character classes, by code point below 128; all others are class 4.
_SPECIAL = "@.-+() \n_%:=\"'/\\,;"
_CLASS = np.full(129, 5 + len(_SPECIAL), np.int64)
for _c in range(128):
    _CLASS[_c] = (1 if chr(_c).isdigit() else 2 if chr(_c).islower() else 3 if chr(_c).isupper()
                  else 5 + _SPECIAL.index(chr(_c)) if chr(_c) in _SPECIAL else 5 + len(_SPECIAL))
_CLASS[128] = 4
CLASSES = 6 + len(_SPECIAL)  # 0 pads
_DIGIT, _PLUS, _SPACE, _DASH, _DOT = 1, *(5 + _SPECIAL.index(c) for c in "+ -.")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, walking from one ``@`` to the next: linear in the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, *s) for s in emails(text)] if "@" in text else []
    out += [(1, *m.span()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        d = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _CLASS[np.minimum(points, 128)]


def window_starts(text: str) -> list[int]:
    """Starts of the windows over all characters within NEAR of a digit or ``@``."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = np.flatnonzero(((points >= 48) & (points <= 57)) | (points == 64))
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 2 * NEAR)
    begin = np.maximum(at[np.concatenate(([0], cut + 1))] - NEAR, 0)
    end = np.minimum(at[np.concatenate((cut, [len(at) - 1]))] + NEAR + 1, len(text))
    out: list[int] = []
    for b, e in zip(begin.tolist(), end.tolist()):
        out += range(b, max(b + 1, e - STRIDE), STRIDE)
    return out


def cut_windows(values: np.ndarray, starts: list[int], pad: int = 0) -> np.ndarray:
    padded = np.concatenate((values, np.full(WINDOW, pad, values.dtype)))
    return padded[np.array(starts, np.int64)[:, None] + np.arange(WINDOW)]


def tags_of(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        tags[start:end] = 2 + 2 * kind
        tags[start] = 1 + 2 * kind
    return tags


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _softmax_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Character BiLSTM with CRF transitions; arrays are (time, window, ...)."""

    def __init__(self, hidden: int = 16, seed: int = 5):
        r, h = np.random.default_rng(seed), hidden
        self.hidden, self.trained = h, False
        self.p = {"out": r.normal(0, 0.1, (2 * h, TAGS)), "out_b": np.zeros(TAGS), "step": np.zeros((TAGS, TAGS))}
        for d in "fb":
            self.p |= {f"w{d}": r.normal(0, 0.3, (CLASSES, 4 * h)), f"u{d}": r.normal(0, 0.25, (h, 4 * h)), f"c{d}": np.zeros(4 * h)}
            self.p[f"c{d}"][h:2 * h] = 1.0

    def _lstm(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states of one direction; ``keep`` gets what the gradient needs."""
        w, u, c, n = self.p["w" + d], self.p["u" + d], self.p["c" + d], self.hidden
        h = s = np.zeros((x.shape[1], n), w.dtype)
        out = np.empty((*x.shape, n), w.dtype)
        for t in (range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)):
            z = w[x[t]] + h @ u + c
            gate, g = _sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])
            last, before = s, h
            s = gate[:, n:2 * n] * s + gate[:, :n] * g
            th = np.tanh(s)
            h = gate[:, 2 * n:] * th
            out[t] = h
            if keep is not None:
                keep.append((t, gate, g, last, th, before))
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        both = np.concatenate((self._lstm(x, "f"), self._lstm(x, "b")), axis=2)
        return both @ self.p["out"] + self.p["out_b"]

    def decode(self, windows: np.ndarray) -> np.ndarray:
        """Best tags (window, time) by Viterbi."""
        e, step = self.emissions(windows.T), self.p["step"]
        best, back = e[0], []
        for t in range(1, len(e)):
            score = best[:, :, None] + step
            back.append(score.argmax(1))
            best = score.max(1) + e[t]
        tags = np.empty((len(windows), len(e)), np.int64)
        tags[:, -1] = best.argmax(1)
        for t in range(len(e) - 2, -1, -1):
            tags[:, t] = back[t][np.arange(len(windows)), tags[:, t + 1]]
        return tags

    def gradient(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood a window, and its gradient."""
        x, y, h, n = windows.T, tags.T, self.hidden, len(windows)
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._lstm(x, d, kept[d]) for d in "fb"], axis=2)
        e, step, rows = both @ self.p["out"] + self.p["out_b"], self.p["step"], np.arange(n)
        ahead, after = [e[0]], [np.zeros_like(e[0])]
        for t in range(1, len(e)):
            ahead.append(_softmax_sum(ahead[-1][:, :, None] + step, 1) + e[t])
            after.append(_softmax_sum(step + (after[-1] + e[len(e) - t])[:, None, :], 2))
        after.reverse()
        total = _softmax_sum(ahead[-1], 1)
        loss = total.sum() - sum(e[t][rows, y[t]].sum() for t in range(len(e)))
        de, dstep = np.empty_like(e), np.zeros_like(step)
        for t in range(len(e)):
            de[t] = np.exp(ahead[t] + after[t] - total[:, None])
            de[t][rows, y[t]] -= 1
            if t:
                pair = ahead[t - 1][:, :, None] + step + (e[t] + after[t])[:, None, :] - total[:, None, None]
                dstep += np.exp(pair).sum(0)
                np.add.at(dstep, (y[t - 1], y[t]), -1)
                loss -= step[y[t - 1], y[t]].sum()
        g = {"step": dstep, "out": np.einsum("tnh,tnk->hk", both, de), "out_b": de.sum((0, 1))}
        dboth = de @ self.p["out"].T
        for k, d in enumerate("fb"):
            dw, du, dc = (np.zeros_like(self.p[v + d]) for v in "wuc")
            dh_next, ds_next = np.zeros((n, h)), np.zeros((n, h))
            for t, gate, cand, last, th, before in reversed(kept[d]):
                i, f, o = gate[:, :h], gate[:, h:2 * h], gate[:, 2 * h:]
                dh = dboth[t][:, k * h:(k + 1) * h] + dh_next
                ds = dh * o * (1 - th * th) + ds_next
                dz = np.concatenate((ds * cand * i * (1 - i), ds * last * f * (1 - f), dh * th * o * (1 - o), ds * i * (1 - cand * cand)), axis=1)
                np.add.at(dw, x[t], dz)
                du += before.T @ dz
                dc += dz.sum(0)
                dh_next, ds_next = dz @ self.p["u" + d].T, ds * f
            g |= {"w" + d: dw, "u" + d: du, "c" + d: dc}
        return loss / n, {k: v / n for k, v in g.items()}

    def fit(self, windows: np.ndarray, tags: np.ndarray, steps: int = 420, size: int = 64, rate: float = 0.01, seed: int = 5) -> "Tagger":
        """``steps`` gradient steps, however many windows there are."""
        r = np.random.default_rng(seed)
        mean, square, k = {n: 0.0 for n in self.p}, {n: 0.0 for n in self.p}, 0
        while k < steps and len(windows):
            order = r.permutation(len(windows))
            for at in range(0, min(len(order), size * (steps - k)), size):
                part = order[at:at + size]
                k += 1
                for name, g in self.gradient(windows[part], tags[part])[1].items():
                    g = np.clip(g, -5, 5)
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    square[name] = 0.99 * square[name] + 0.01 * g * g
                    self.p[name] = self.p[name] - rate * (mean[name] / (1 - 0.9 ** k)) / (np.sqrt(square[name] / (1 - 0.99 ** k)) + 1e-8)
        self.trained = len(windows) > 0
        self.p = {n: v.astype(np.float32) for n, v in self.p.items()}
        return self


def varied(windows: np.ndarray, tags: np.ndarray, seed: int = 5) -> np.ndarray:
    """Copies with other separators inside phone and card spans, and a digit
    or nothing in place of a phone's plus sign."""
    r, out = np.random.default_rng(seed), windows.copy()
    phone, card = (tags == 7) | (tags == 8), (tags == 5) | (tags == 6)
    to = r.choice([_SPACE, _DASH, _DOT], len(out))[:, None]
    out = np.where((phone | card) & ((out == _SPACE) | (out == _DASH)), to, out)
    return np.where(phone & (out == _PLUS), r.choice([_DIGIT, _SPACE], len(out))[:, None], out)


def added_spans(tags: np.ndarray, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the tagged text that are plausible and touch no base span."""
    taken = np.zeros(len(text) + 1, bool)
    for _, s, e in base:
        taken[s:e] = True
    out, at, on = [], 0, np.flatnonzero(tags)
    while at < len(on):
        start = int(on[at])
        kind = int(tags[start] - 1) // 2
        end = start + 1
        while end < len(tags) and tags[end] == 2 + 2 * kind:
            end += 1
        at = int(np.searchsorted(on, end))
        while end > start and text[end - 1].isspace():
            end -= 1
        while start < end and text[start].isspace():
            start += 1
        found = text[start:end]
        digits = sum(c in "0123456789" for c in found)
        enough = ("@" in found.strip("@") and len(found) >= 5, digits >= 4 and found.count(".") >= 3, digits >= 13, 9 <= digits <= 15)[kind]
        if enough and not taken[start:end].any():
            out.append((kind, start, end))
    return out


def find_all(values: list[str], tagger: Tagger, size: int = 2048) -> list[tuple[list, list]]:
    """(base, added) spans of each text."""
    base = [base_spans(t) for t in values]
    if not tagger.trained:
        return [(b, []) for b in base]
    starts = [window_starts(t) for t in values]
    tags = [np.zeros(len(t), np.int64) for t in values]
    rank = [np.zeros(len(t), np.int64) for t in values]
    middle = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW))
    places = [(k, s) for k, own in enumerate(starts) for s in own]
    shapes = {k: classes_of(values[k]) for k in {k for k, _ in places}}
    for at in range(0, len(places), size):
        part = places[at:at + size]
        windows = np.concatenate([cut_windows(shapes[k], [s]) for k, s in part])
        for (k, s), found in zip(part, tagger.decode(windows)):
            n = min(WINDOW, len(tags[k]) - s)
            better = middle[:n] > rank[k][s:s + n]
            tags[k][s:s + n][better] = found[:n][better]
            rank[k][s:s + n][better] = middle[:n][better]
    return [(b, added_spans(x, t, b) if o else []) for b, x, t, o in zip(base, tags, values, starts)]


def show(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def fit(documents: DataFrame, fit_windows: int = FIT_WINDOWS) -> Tagger:
    """Train on at most ``fit_windows`` distinct windows, those of smallest hash."""
    in_small_batches(documents.sparkSession)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in tidy(batches):
            x, y = [], []
            for raw in utf8(b.column("text")):
                if _TRIGGER.search(raw):
                    text = raw.decode()
                    starts = window_starts(text)
                    x += [w.astype(np.uint8).tobytes() for w in cut_windows(classes_of(text), starts)]
                    y += [w.astype(np.uint8).tobytes() for w in cut_windows(tags_of(len(text), base_spans(text)), starts)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["x", "y"])

    some = (texts(documents).mapInArrow(label, "x binary, y binary").distinct()
            .orderBy(F.xxhash64("x", "y"), "x", "y").limit(fit_windows).toPandas())
    if not len(some):
        return Tagger()
    x, y = (np.array([np.frombuffer(v, np.uint8) for v in some[c]], np.int64) for c in "xy")
    has = (y > 4).any(1)
    # a window cut in a span begins inside it; that is fine for tags, not for variation
    return Tagger().fit(np.concatenate((x, varied(x[has], y[has]))), np.concatenate((y, y[has])))


RESULT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS),
                    ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])


def personal_data(documents: DataFrame, fit_windows: int = FIT_WINDOWS) -> DataFrame:
    """One row a document: see RESULT."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, fit_windows))
    nothing = hashlib.sha256(b"").hexdigest()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in tidy(batches):
            raw = utf8(b.column("text"))
            some = [k for k, t in enumerate(raw) if _TRIGGER.search(t)]
            rows = [[0, 0, 0, 0, nothing, "", 0] for _ in raw]
            for k, (base, added) in zip(some, find_all([raw[k].decode() for k in some], shared.value)):
                counts = [sum(s[0] == kind for s in base) for kind in range(len(KINDS))]
                rows[k] = [*counts, hashlib.sha256(show(base).encode()).hexdigest(), show(base + added), len(added)]
            columns = dict(zip(RESULT.names[1:], zip(*rows))) if rows else {n: [] for n in RESULT.names[1:]}
            yield batch(RESULT, {"doc_id": b.column("doc_id").to_pylist()} | columns)

    schema = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in RESULT)
    return texts(documents).mapInArrow(find, schema)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, as its kind in angle brackets."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(documents: DataFrame, fit_windows: int = FIT_WINDOWS) -> DataFrame:
    """All documents and columns, personal data masked in ``text`` until no
    base pattern matches, and ``n_chars``, where there is one, the new length."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, fit_windows))

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in tidy(batches):
            raw = b.column("text").cast(pa.string()).to_pylist()
            some = [k for k, t in enumerate(raw) if t and _TRIGGER.search(t.encode())]
            for k, (base, added) in zip(some, find_all([raw[k] for k in some], shared.value)):
                raw[k] = masked(raw[k], base + added)
                while left := base_spans(raw[k]):  # what a masked neighbour had hidden; each turn masks digits or an @
                    raw[k] = masked(raw[k], left)
            yield b.set_column(b.schema.get_field_index("text"), b.schema.field("text"), pa.array(raw, pa.string()).cast(b.schema.field("text").type))

    out = documents.mapInArrow(mask, documents.schema)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(out.dtypes)["n_chars"]))
    return out.select(documents.columns)
