"""HTML extraction (op13): a recurrent network labels every block of a page.

A page is read tag by tag into leaf blocks: runs of text between block-level
tags, each with its tag path (names, and the words of class, id and role, of
all open blocks). A block is a vector: hashed path entries, hashed words, and
lengths, links, marks and place. A bidirectional LSTM in numpy reads the
page's blocks in order, so each is judged in the context of the whole page,
and blocks of the main text are joined.

No page comes with labels. Training pages, ``fit_pages`` at most (chosen by
hash, 80 blocks of each, 32 words of each block), are labelled where their own
markup says what a part is (``evidence``); and their texts are set again in
other layouts (``variant``), with menus, notices, sidebars, forms, comments and
adverts around them, with other names or none, so that the network must also
go by words, shape and neighbours.

Rules of reading: comments, scripts, styles, titles and the like are no
blocks; character references are decoded; white space in a block (br counts as
such) becomes one space; an unclosed tag or comment runs to the end of the
page; an end tag without a start is passed over.

Defined cases: null and empty pages, and pages without main text, give the
empty string; bytes that are not valid UTF-8 are replaced; without any
evidence in the table the network learns from layouts alone, and in an empty
table there is nothing to do; repeated pages are read alike; other columns are
ignored.
"""

from __future__ import annotations

import json
import random
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from .base import Memo, held, in_small_batches

FIT_PAGES, FIT_BLOCKS, FIT_WORDS = 300, 80, 32
PATHS, WORDS, PATH_SIZE, WORD_SIZE, SHAPE, HIDDEN = 2048, 4096, 16, 8, 11, 16

#: Elements that end a block of text (HTML's block-level
#: elements, cells and form controls), those that cannot hold any, and those
#: whose content is not markup or not for readers.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html label legend li main menu nav noscript ol
optgroup option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TEXT = "script|style|template|textarea|title|iframe|noembed|noframes|svg|xmp|object"
#: A start tag that ends an open element of the second kind, if no element of the third kind was opened since.
IMPLIED = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
           "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
#: Words of class and id that say what a part of a page is.
BESIDE = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation
breadcrumb breadcrumbs sidebar rail footer masthead topbar cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe
subscription signup social share sharing related recommended trending comment comments reply replies disqus discussion respond
widget login search pagination pager toolbar copyright disclaimer""".split())
BESIDE_TAGS = frozenset("nav footer aside form menu button select option label fieldset legend dialog noscript search".split())
MAIN = frozenset("article content entry post story articlebody".split())
MAIN_TAGS = frozenset(("article", "main"))

TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<({HIDDEN_TEXT})(?=[\s/>])(?:[^>\"'=]++|=\s*+(?:\"[^\"]*\"|'[^']*')|[\"'=])*+>?.*?(?:</\1\s*+[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*\"|'[^']*')|[\"'=])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def entries(name: str, attributes: str) -> tuple[str, ...]:
    """Path entries of a start tag: its name, and the words it is named by."""
    words = (w.lower() for m in NAMED.finditer(attributes) for w in PART.findall(m[1] or m[2] or m[3] or ""))
    return (name, *dict.fromkeys("." + w for w in words))


class Reader:
    """Splits pages into leaf blocks."""

    def __init__(self):
        self.starts = Memo(lambda tag: entries(*tag), 20_000)

    def leaves(self, page: str) -> list[tuple[tuple[str, ...], str, float]]:
        """(path entries, text, share of it in links) of each block."""
        out, buffer, stack, path = [], [], [], ()
        links, linked, at = 0, 0, 0

        def end() -> None:
            nonlocal linked
            if buffer:
                size = sum(map(len, buffer))
                text = " ".join(unescape("".join(buffer)).split())
                if text:
                    out.append((path, text, min(1.0, linked / size)))
                buffer.clear()
            linked = 0

        def close(k: int) -> None:
            nonlocal path
            end()
            del stack[k:]
            path = stack[-1][1] if stack else ()

        for m in TOKEN.finditer(page):
            if m.start() > at:
                buffer.append(page[at:m.start()])
                linked += (m.start() - at) * (links > 0)
            at = m.end()
            name = m[3]
            if name is None:
                continue
            name = name.lower()
            if name == "a":
                links = max(0, links + (-1 if m[2] else 1))
            elif name == "br":
                buffer.append("\n")
            elif name == "hr":
                end()
            elif name in BLOCKS:
                links = 0
                if m[2]:
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == name:
                            close(k)
                            break
                    else:
                        end()
                    continue
                if stack and stack[-1][0] == "p":
                    close(len(stack) - 1)
                ends, walls = IMPLIED.get(name, ((), ()))
                for k in range(len(stack) - 1, -1, -1) if ends else ():
                    if stack[k][0] in walls:
                        break
                    if stack[k][0] in ends.split():
                        close(k)
                        break
                end()
                attributes = m[4]
                here = self.starts[name, attributes] if len(attributes) <= 200 else entries(name, attributes)
                path = path + here if len(stack) < 200 else path  # deeper than browsers go
                stack.append((name, path))
        if at < len(page):
            buffer.append(page[at:])
            linked += (len(page) - at) * (links > 0)
        end()
        return out


def evidence(path: tuple[str, ...]) -> int | None:
    """What the markup says of a block: 1 main text, 0 beside it, None nothing."""
    main = False
    for e in path:
        if e in BESIDE_TAGS or (e[0] == "." and e[1:] in BESIDE) or (e in ("header", ".header") and not main):
            return 0
        main = main or e in MAIN_TAGS or (e[0] == "." and e[1:] in MAIN)
    return 1 if main else None


# --- vectors of blocks --------------------------------------------------------

def path_ids(path: tuple[str, ...]) -> list[int]:
    """Each entry once, and the innermost block's once more as such."""
    own = next((i for i in range(len(path) - 1, -1, -1) if path[i][0] != "."), 0)
    return [xxh32_intdigest(e) % PATHS for e in dict.fromkeys(path)] + [xxh32_intdigest("in " + e) % PATHS for e in path[own:]]


def word_ids(text: str, of: Memo) -> list[int]:
    return [of[w] if len(w) <= 40 else xxh32_intdigest(w) % WORDS for w in text.lower().split()]


def place(path: tuple[str, ...], k: int, n: int) -> list[float]:
    """What the markup says, and where in the page the block is."""
    said = evidence(path)
    return [float(said == 0), float(said == 1), k / n, (n - k) / n]


def shape(text: str, linked: float) -> list[float]:
    size = len(text)
    return [np.log1p(size) / 8, np.log1p(text.count(" ")) / 6, linked, float(text[-1] in ".!?…。\"»”"),
            sum(map(text.count, ",.;:")) / size * 5, float(text[:1].isupper()), float("©" in text)]


class Labeller:
    """Embedded paths and words, a bidirectional LSTM, a logistic output that
    also sees the block itself."""

    def __init__(self, seed: int = 13):
        r, size = np.random.default_rng(seed), PATH_SIZE + WORD_SIZE + SHAPE
        make = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"path": r.normal(0, 0.3, (PATHS, PATH_SIZE)), "word": r.normal(0, 0.1, (WORDS, WORD_SIZE)),
                  "out": np.zeros(2 * HIDDEN + size), "bias": np.zeros(1)}
        for side in "fb":
            self.p |= {side + "x": make(size, 4 * HIDDEN), side + "h": make(HIDDEN, 4 * HIDDEN),
                       side + "0": np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))}

    def vectors(self, paths: list[list[int]], words: list[list[int]], shapes: list[list[float]]) -> np.ndarray:
        """One row a block: path entries summed, words averaged, its shape."""
        out = np.zeros((len(paths), PATH_SIZE + WORD_SIZE + SHAPE))
        for ids, table, to in ((paths, self.p["path"], slice(0, PATH_SIZE)), (words, self.p["word"], slice(PATH_SIZE, PATH_SIZE + WORD_SIZE))):
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for some in ids for i in some), np.int64, int(sizes.sum()))
            full = np.flatnonzero(sizes)
            if len(full):
                sums = np.add.reduceat(table[flat], (np.cumsum(sizes) - sizes)[full])
                out[full, to] = sums / (np.sqrt(sizes[full]) if to.start == 0 else sizes[full])[:, None]
        out[:, PATH_SIZE + WORD_SIZE:] = shapes
        return out

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (page, block, unit); padding has state zero."""
        n, steps, _ = x.shape
        z_all, wh = x @ self.p[side + "x"] + self.p[side + "0"], self.p[side + "h"]
        h, c, out = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), np.zeros((n, steps, HIDDEN))
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = z_all[:, t] + h @ wh
            gates = 0.5 * (1 + np.tanh(0.5 * z[:, :3 * HIDDEN]))
            g, m = np.tanh(z[:, 3 * HIDDEN:]), mask[:, t, None]
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            before_h, before_c = h, c
            c = (f * c + i * g) * m
            tc = np.tanh(c)
            h = o * tc * m
            out[:, t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, tc, before_h, before_c, m))
        return out

    def raw(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return np.concatenate((self._run(x, mask, "f"), self._run(x, mask, "b"), x), 2) @ self.p["out"] + self.p["bias"]

    def label(self, pages: list[np.ndarray], most: int = 1 << 14) -> list[np.ndarray]:
        """For each page's block vectors, which blocks are main text. Pages of
        like length are read together, ``most`` blocks with padding at a time
        (a longer page on its own)."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            some = order[-max(1, most // len(pages[order[-1]])):]
            del order[-len(some):]
            x, mask = padded([pages[k] for k in some])
            for k, z in zip(some, self.raw(x, mask)):
                out[k] = z[:len(pages[k])] >= 0
        return out

    def _back(self, x: np.ndarray, keep: list, side: str, d_out: np.ndarray, grad: dict) -> np.ndarray:
        d_x, d_h, d_c = np.zeros_like(x), 0.0, 0.0
        wx, wh = self.p[side + "x"], self.p[side + "h"]
        for t, i, f, o, g, tc, before_h, before_c, m in reversed(keep):
            d_h = (d_out[:, t] + d_h) * m
            d_c = (d_c + d_h * o * (1 - tc * tc)) * m
            d_z = np.concatenate((d_c * g * i * (1 - i), d_c * before_c * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - g * g)), 1)
            grad[side + "x"] += x[:, t].T @ d_z
            grad[side + "h"] += before_h.T @ d_z
            grad[side + "0"] += d_z.sum(0)
            d_x[:, t] = d_z @ wx.T
            d_h, d_c = d_z @ wh.T, d_c * f
        return d_x

    def gradient(self, examples: list[tuple]) -> tuple[float, dict]:
        """Loss and gradients over pages (paths, words, shapes, labels)."""
        x, mask = padded([self.vectors(*e[:3]) for e in examples])
        y = np.full(mask.shape, -1.0)
        for k, e in enumerate(examples):
            y[k, :len(e[3])] = [-1 if v is None else v for v in e[3]]
        known = (y >= 0) & (mask > 0)
        keep_f, keep_b = [], []
        full = np.concatenate((self._run(x, mask, "f", keep_f), self._run(x, mask, "b", keep_b), x), 2)
        z = full @ self.p["out"] + self.p["bias"]
        probability, count = 0.5 * (1 + np.tanh(0.5 * z)), max(1, int(known.sum()))
        loss = float(np.where(known, np.logaddexp(0, z) - y * z, 0).sum() / count)
        error = np.where(known, probability - y, 0) / count
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["out"], grad["bias"] = np.einsum("ntd,nt->d", full, error), error.sum(keepdims=True).reshape(1)
        d_full = error[:, :, None] * self.p["out"]
        d_x = d_full[:, :, 2 * HIDDEN:] + self._back(x, keep_f, "f", d_full[:, :, :HIDDEN], grad) \
            + self._back(x, keep_b, "b", d_full[:, :, HIDDEN:2 * HIDDEN], grad)
        for k, (paths, words, _, _) in enumerate(examples):
            for name, ids, to, power in (("path", paths, slice(0, PATH_SIZE), 0.5), ("word", words, slice(PATH_SIZE, PATH_SIZE + WORD_SIZE), 1.0)):
                sizes = np.array([len(i) for i in ids])
                flat = np.array([i for some in ids for i in some], np.int64)
                rows = np.repeat(d_x[k, :len(ids), to] / np.maximum(sizes, 1)[:, None] ** power, sizes, axis=0)
                np.add.at(grad[name], flat, rows)
        return loss, grad

    def fit(self, examples: list[tuple], passes: int = 8, size: int = 24, rate: float = 0.01, seed: int = 13) -> "Labeller":
        """Adam steps over the examples, pages of like length together. Half of
        the blocks lend their words from another page each time: what a part
        says here and there must not outweigh where it stands."""
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        order, step = random.Random(seed), 0
        said = [w for e in examples for w in e[1]]
        for turn in range(passes):
            shuffled = sorted(examples, key=lambda e: (len(e[3]) // 8, order.random()))
            lots = [shuffled[k:k + size] for k in range(0, len(shuffled), size)]
            order.shuffle(lots)
            for lot in lots:
                step += 1
                _, grad = self.gradient([(e[0], [order.choice(said) if order.random() < 0.5 else w for w in e[1]], *e[2:]) for e in lot])
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                pace = rate * (0.3 if turn >= passes - 2 else 1)
                for k, g in grad.items():
                    g = g * min(1.0, 5 / (norm + 1e-12))
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.p[k] -= pace * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
        return self


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, pages[0].shape[1])), np.zeros((len(pages), steps))
    for k, p in enumerate(pages):
        x[k, :len(p)], mask[k, :len(p)] = p, 1
    return x, mask


# --- training pages -----------------------------------------------------------

#: Layouts that pages are set in again: for each part of a page, ways to wrap
#: it (start tags, outermost first), and short texts that often stand there.
LAYOUTS = {
    "menu": ("nav ul li", "header nav ul li", "div.menu ul li", "div.main-nav div", "ul.navigation li", "div#navbar p", "div.breadcrumbs span"),
    "head": ("header h1", "header div", "header p", "div.header h1", "div.header p", "div#masthead h2", "div.site-header div", "div.topbar p"),
    "notice": ("div.cookie-notice p", "div#cookie-banner div", "div.alert p", "div.consent div p", "section.notice p", "aside.notice p", "div.popup p"),
    "advert": ("div.ad", "aside.ad p", "div.advertisement p", "div.ads-top div", "div.sponsored p", "div#banner p", "div.promo p"),
    "side": ("aside p", "aside ul li", "aside h3", "aside.sidebar div p", "div.sidebar ul li", "div.sidebar h4", "div#sidebar div p", "div.related ul li", "section.related p", "div.widget p"),
    "form": ("form label", "form p", "form div", "div.newsletter form p", "section.subscribe form button", "div.login p", "form.search button"),
    "comments": ("section.comments div.comment p", "section.comments h3", "div#comments h2", "div#comments ol li p", "div.comments div p", "section#comments article.comment p",
                 "ul.comment-list li div", "div.replies div p", "aside.discussion p"),
    "foot": ("footer", "footer p", "footer div p", "div.footer p", "div#footer ul li", "footer ul li", "div.copyright"),
    "main": ("article", "main", "main article", "main article div", "div.content", "div#content", "div.post-content", "div.entry-content", "div.article-body",
             "section.story", "div#main div.post", "main div.text", "div.page article.post div.body"),
}
WITHIN = ("p", "p", "p", "p", "p", "div", "ul li", "ol li", "blockquote p", "h2", "h3", "pre", "section p", "figure figcaption", "table tr td", "dl dd")
PHRASES = {
    "menu": ("Home", "About", "Contact", "News", "Sports", "Login", "Blog", "Startseite", "Kontakt", "Accueil", "Inicio"),
    "head": ("Welcome", "The daily site", "Your source for news", "Menu"),
    "notice": ("We use cookies to improve your experience.", "This site uses cookies. Accept all", "Please enable JavaScript to view this page.",
               "Wir verwenden Cookies.", "Ce site utilise des cookies.", "Este sitio usa cookies."),
    "advert": ("Advertisement", "Sponsored", "Buy now and save 50%", "Anzeige", "Publicité", "Publicidad"),
    "side": ("Related articles", "Most read", "Popular posts", "Read more", "Follow us", "Share this", "Tags", "Mehr lesen", "À lire aussi", "Más leídas"),
    "form": ("Email address", "Subscribe", "Sign up", "Search", "Your name", "Password", "Send", "Anmelden", "Envoyer", "Enviar"),
    "comments": ("Comments", "Leave a comment", "Reply", "3 comments", "Great post, thanks for sharing!", "I disagree.", "First!", "Posted by user12 on May 3",
                 "Kommentare", "Commentaires", "Comentarios"),
    "foot": ("© 2024 All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "© Example Ltd", "Impressum", "Mentions légales"),
}


def wrapped(layout: str) -> tuple[str, ...]:
    """Path entries of a layout such as ``div.ad p``."""
    out: tuple[str, ...] = ("html", "body")
    for tag in layout.split():
        name, *words = re.split(r"[.#]", tag)
        out += (name, *("." + w for some in words for w in some.split("-")))
    return out


def example(leaves: list[tuple[tuple[str, ...], list[int], list[float]]], labels: list) -> tuple:
    n = len(leaves)
    shapes = [[*s, *place(p, k, n)] for k, (p, _, s) in enumerate(leaves)]
    return [path_ids(p) for p, _, _ in leaves], [w for _, w, _ in leaves], shapes, labels


def variant(main: list[tuple], stock: list[tuple], rng: random.Random, of: Memo) -> tuple:
    """A page's main blocks in another layout, with other parts around them:
    ``stock`` has blocks of other pages, whose texts fill these parts. In some
    pages names are dropped or replaced, so that they say nothing."""
    blind = rng.random()

    def named(path: tuple[str, ...], salt: str) -> tuple[str, ...]:
        if blind > 0.35:
            return path
        plain = tuple("div" if e in ("article", "main", "nav", "aside", "footer", "header", "section") and blind < 0.2 else e for e in path)
        return tuple((f".{salt}{len(e)}" if e[0] == "." else e) for e in plain if e[0] != "." or blind < 0.3)

    def part(kind: str, most: int) -> list[tuple]:
        layout, out, nameless = rng.choice(LAYOUTS[kind]), [], rng.random() < 0.04
        for _ in range(rng.randint(1, most)):
            if rng.random() < 0.5:
                text = rng.choice(PHRASES[kind])
                words, s = word_ids(text, of), shape(text, float(kind in ("menu", "side", "foot") and rng.random() < 0.7))
            else:
                _, words, s = rng.choice(stock)
                short = kind in ("menu", "head", "form") or (kind in ("side", "foot") and rng.random() < 0.7)
                if short:
                    words = words[:rng.randint(1, 4)]
                    s = shape(" ".join(["worded"] * max(1, len(words))), float(kind == "menu" or rng.random() < 0.4))
            out.append((("html", "body", "div", "p") if nameless else named(wrapped(layout), "x" + str(rng.randint(0, 9))), words, s, 0))
        return out

    around, container = [], rng.choice(LAYOUTS["main"])
    salt = "y" + str(rng.randint(0, 9))
    for k, (_, words, s) in enumerate(main):
        within = "h1" if k == 0 and rng.random() < 0.8 else rng.choice(WITHIN[:5]) if rng.random() < 0.7 else rng.choice(WITHIN)
        if rng.random() < 0.08:
            words = words[:rng.randint(1, 3)]
            s = shape(" ".join(["worded"] * max(1, len(words))), 0.0)
        around.append((named(wrapped(container), salt) + tuple(within.split()), words, s, 1))
        if rng.random() < 0.04:
            around += [(named(wrapped(container), salt) + p[2:], w, z, 0) for p, w, z, _ in part(rng.choice(("advert", "side", "form")), 2)]
    before = [b for kind, chance, most in (("notice", 0.3, 2), ("head", 0.5, 2), ("menu", 0.9, 7), ("advert", 0.4, 2), ("side", 0.2, 5)) if rng.random() < chance for b in part(kind, most)]
    after = [b for kind, chance, most in (("advert", 0.2, 2), ("form", 0.3, 3), ("comments", 0.45, 6), ("side", 0.45, 6), ("menu", 0.1, 4), ("notice", 0.15, 1), ("foot", 0.85, 3)) if rng.random() < chance for b in part(kind, most)]
    blocks = before + around + after
    return example([b[:3] for b in blocks], [b[3] for b in blocks])


def training(pages: list[list[tuple]], seed: int = 13, variants: int = 3, least: int = 900) -> list[tuple]:
    """Examples from pages of (path, word ids, shape) blocks: the pages, and
    ``variants`` of each, more where that makes fewer than ``least``. A table
    with few main texts gets made ones beside them."""
    rng, of = random.Random(seed), Memo(lambda w: xxh32_intdigest(w) % WORDS)
    out, mains, stock = [], [], []
    for blocks in pages:
        labels = [evidence(p) for p, _, _ in blocks]
        if any(v is not None for v in labels):
            out.append(example(blocks, labels))
        if rows := [b for b, v in zip(blocks, labels) if v == 1]:
            mains.append(rows)
        stock += blocks
    if len(mains) < 60:
        made = lambda n: (("p",), word_ids("word " * n, of), shape("Word " * n + ".", 0.0))
        mains += [[made(rng.randint(3, 60)) for _ in range(rng.randint(1, 8))] for _ in range(60)]
        stock += [made(rng.randint(3, 30)) for _ in range(60)]
    for _ in range(max(variants, -(-least // len(mains)))):
        for rows in mains:
            if len(rows) > 12 and rng.random() < 0.7:
                rows = rows[:rng.randint(1, 12)]
            out.append(variant(rows, stock, rng, of))
    return out


def _page(column: pa.Array) -> list[str]:
    return [(v or b"").decode("utf-8", "replace") for v in column.cast(pa.binary()).to_pylist()]


def _tools() -> tuple[Reader, Memo]:
    return held("html", lambda: (Reader(), Memo(lambda w: xxh32_intdigest(w) % WORDS, 200_000)))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, of = _tools()
    for b in batches:
        out = []
        for page in _page(b.column("html")):
            leaves = reader.leaves(page)
            if len(leaves) > FIT_BLOCKS:
                leaves = leaves[:FIT_BLOCKS // 2] + leaves[-FIT_BLOCKS // 2:]
            out.append(json.dumps([(p[:40], word_ids(t[:2000], of)[:FIT_WORDS], shape(t, a)) for p, t, a in leaves]))
        yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, pa.string())], names=["key", "record"])


def sample(pages: DataFrame, fit_pages: int = FIT_PAGES) -> list[list[tuple]]:
    """Blocks of at most ``fit_pages`` different pages, those of smallest hash
    (a share of about four times as many is looked at, so that no more come
    to the driver from a large table)."""
    key = F.xxhash64("url", "html")
    rows = pages.select(key.alias("key"), "html").filter("html is not null")
    share = min(1.0, 4 * fit_pages / max(1, pages.count()))
    some = rows.filter(F.pmod("key", F.lit(1 << 32)) < int(share * (1 << 32))) if share < 1 else rows
    keys = some.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(fit_pages)
    found = some.join(F.broadcast(keys), "key").mapInArrow(_records, "key long, record string").groupBy("key").agg(F.max("record").alias("record"))
    return [[(tuple(p), w, s) for p, w, s in json.loads(r["record"])] for r in sorted(found.collect(), key=lambda r: r["key"])]


def fit(pages: DataFrame, fit_pages: int = FIT_PAGES) -> Labeller:
    return Labeller().fit(training(sample(pages, fit_pages)))


def main_text(pages: list[str], labeller: Labeller, reader: Reader, of: Memo) -> list[str]:
    read = [reader.leaves(p) for p in pages]
    paths = Memo(path_ids, 5000)
    vectors = [labeller.vectors([paths[p] for p, _, _ in leaves], [word_ids(t, of) for _, t, _ in leaves],
                                [[*shape(t, a), *place(p, k, len(leaves))] for k, (p, t, a) in enumerate(leaves)]) if leaves else np.zeros((0, 1)) for leaves in read]
    return ["\n".join(t for (_, t, _), keep in zip(leaves, labels.tolist()) if keep) for leaves, labels in zip(read, labeller.label(vectors))]


def extract(pages: DataFrame, fit_pages: int = FIT_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    spark = pages.sparkSession
    in_small_batches(spark, 500)
    if pages.isEmpty():
        return spark.createDataFrame([], "page_id long, url string, text string, n_chars long")
    shared = spark.sparkContext.broadcast(fit(pages, fit_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, of = _tools()
        for b in batches:
            got = main_text(_page(b.column("html")), shared.value, reader, of)
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(got, pa.string()), pa.array(map(len, got), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
