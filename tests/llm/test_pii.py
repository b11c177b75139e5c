"""Personal data: base patterns against plain regular expressions, the tagger's gradient, spans, masking."""

import hashlib
import random
import re

import numpy as np
import pytest

from tessera.llm import pii as P


def luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        n = int(c) * (2 if i % 2 else 1)
        s += n // 10 + n % 10
    return s % 10 == 0


def plain(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_against_plain_patterns():
    r = random.Random(2)
    parts = ["a@b.co", "x.y+z@m-1.example.com", "@", "..", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6", "0001.2.3.4", "4539 5787 6362 1486",
             "4539578763621486", "4539-5787-6362-1487", "+1 (306) 555-1428", "+44.20.7946.0958", "+12", " ", "é", "\n", "-", "7", "Z", "9" * 25, "a.b@c", "d@e..f"]
    for _ in range(3000):
        text = "".join(r.choice(parts) + r.choice(["", " ", "x"]) for _ in range(r.randrange(1, 9)))
        assert P.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 300000, "1" * 300000, "1." * 150000, "a@" * 100000, "1 " * 150000, "+1" * 100000])
def test_long_runs_take_linear_time(text):
    assert isinstance(P.base_spans(text), list)


def made(n=300, seed=4):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(2, 8)))
    out = []
    for i in range(n):
        w = [word() for _ in range(30)]
        if i % 4:
            w[r.randrange(30)] = r.choice([f"{word()}.{r.randrange(99)}@{word()}.com", f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}",
                                           ".".join(str(r.randrange(256)) for _ in range(4)), "4539578763621486", f"token{r.randrange(10**6)}"])
        out.append((i, " ".join(w)))
    return out


def test_gradient():
    text = made()[3][1] + " mail a@b.com 1.2.3.4"
    starts = P.window_starts(text)
    x, y = P.cut_windows(P.classes_of(text), starts), P.cut_windows(P.tags_of(len(text), P.base_spans(text)), starts)
    m = P.Tagger(hidden=4)
    g = m.gradient(x, y)[1]
    for name in m.p:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        losses = []
        for step in (1e-5, -2e-5):
            m.p[name][at] += step
            losses.append(m.gradient(x, y)[0])
        m.p[name][at] += 1e-5
        assert abs((losses[0] - losses[1]) / 2e-5 - g[name][at]) < 1e-4


def test_query_shape_and_added_spans(spark):
    docs = made() + [(900, None), (901, ""), (902, "at 71.129.171.132 4815819516090933 end"), (903, "mail é a@b.com"), (903, "mail é a@b.com")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as spans", "'x' as n_email")
    rows = P.personal_data(df, fit_windows=400).collect()
    assert len(rows) == len(docs)
    text = dict(docs)
    added = 0
    for r in rows:
        base = plain(text[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(P.show(base).encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert set(P.show(base).split(",")) - {""} <= set(spans) and len(spans) == len(base) + r.n_added
        added += r.n_added
    assert next(r.spans for r in rows if r.doc_id == 903) == "email:7:14"


def test_redact(spark):
    df = spark.createDataFrame([(1, "x a@b.com y +1 (306) 555-1428", 29), (2, None, 0), (3, "no data", 7),
                                (4, "71.129.171.132 4539578763621486", 31)], "doc_id long, text string, n_chars long")
    rows = {r.doc_id: r for r in P.redact(df, fit_windows=50).collect()}
    assert rows[1].text == "x <EMAIL> y <PHONE>" and rows[1].n_chars == len(rows[1].text)
    assert rows[4].text == "<IP> <CARD>"
    assert rows[2].text is None and rows[3].text == "no data"
    assert P.personal_data(df.limit(0)).collect() == []


def test_windows_are_reconciled():
    """A span across window borders comes out whole."""
    docs = [t for _, t in made(600)]
    x, y = [], []
    for t in docs:
        s = P.window_starts(t)
        if s:
            x.append(P.cut_windows(P.classes_of(t), s))
            y.append(P.cut_windows(P.tags_of(len(t), P.base_spans(t)), s))
    m = P.Tagger().fit(np.concatenate(x), np.concatenate(y))
    text = docs[1]
    found = P.find_all([text], m)[0]
    tags = np.zeros(len(text), np.int64)
    for s, got in zip(P.window_starts(text), m.decode(P.cut_windows(P.classes_of(text), P.window_starts(text)))):
        tags[s:s + P.WINDOW] = np.maximum(tags[s:s + P.WINDOW], got[:len(text) - s])
    assert found[0] == plain(text)
    assert (m.decode(np.concatenate(x)) == np.concatenate(y)).mean() > 0.99
