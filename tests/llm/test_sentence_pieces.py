"""SentencePiece: ids as the library's, the scan on chunks, exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tessera.llm import sentence_pieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  hello  world ", "a b\tc\n\nd", "ﬁ é ½", "", " ", "a​b\x00c\x7f", "日本語 😀日本語 こんにちは世界", "a" * 90, "<s> <0x41> </s> <unk>",
       " " * 37 + "x", "\n \n  \n", "def f(x):\n    return x  # ok", "https://www.example.com/a?b=c&d=1234567890"]


@pytest.fixture(scope="module")
def tools():
    return S.vocabulary(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def fuzz(n, size, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice("abcdehlorst  \n.,'1aeiou ABÉ日😀") for _ in range(r.randrange(1, size))) for _ in range(n)]


def test_encoding_is_the_library_s(tools):
    v, library = tools
    for text in [*ODD, *fuzz(2000, 60), "x▁y"]:
        ids = S.encode_whole(v, text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text), text
        assert v.decode(ids) == text.replace("▁", " ")


def test_pairs_are_judged_as_by_merging(tools):
    v, _ = tools
    r = random.Random(3)
    pieces = [p for p in v.split if "▁" not in p[1:]]
    for _ in range(20000):
        a, b = r.choice(pieces), r.choice(pieces)
        assert v._follows(v.id[a] << 20 | v.id[b]) == (v.merged(a + b) == [a, b]), (a, b)


@pytest.mark.parametrize("size", [32, 64, 300])
def test_scan_over_chunks(tools, size):
    v, _ = tools
    for text in [t for t in ODD if t] + fuzz(30, 900) + ["ababab" * 100, "日本語" * 60, *("ab" * n for n in range(28, 52))]:
        ready = S.prepared(text)
        chunks = [S.Chunk(v, ready[max(0, a - v.longest):a], ready[a:a + size], ready[a + size:a + size + v.longest]) for a in range(0, len(ready), size)]
        ways = S.scan([c.matrix() for c in chunks])
        assert b"".join(c.encode(*w) for c, w in zip(chunks, ways)) == S.encode_whole(v, text)


def test_products_are_associative():
    r = np.random.default_rng(0)
    a, b, c = (np.where(r.random(s) < 0.3, S.NEVER, r.integers(-9, 0, s)) for s in ((3, 4), (4, 2), (2, 5)))
    assert (S.max_plus(S.max_plus(a, b), c) == S.max_plus(a, S.max_plus(b, c))).all()


def test_documents(spark, tools):
    _, library = tools
    giant = " ".join(fuzz(400, 60, 5))
    docs = list(enumerate([*ODD, None, giant, giant, "z" * 3000])) + [(1, ODD[1]), (None, giant)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as ids", "'k' as text_key")
    got = S.encode(df, PATH, chunk=500)
    rows = got.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((i, library.encode(t or "")) for i, t in docs), key=key)
    assert sorted(((r.doc_id, list(r.ids)) for r in rows), key=key) == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in S.decode(got, PATH).collect())
    assert texts == sorted((i is None, i or 0, t or "") for i, t in docs)
    assert S.encode(df.limit(0), PATH).collect() == []


def test_words_solved_together(tools):
    v, library = tools
    words = sorted({w for t in [*ODD, *fuzz(1500, 60, 7), "naïve 日😀x­\x00y ½½ " * 3] if t for w in v.raw_words.findall((" " + t).encode())})
    assert len(words) > 1000 and any(c not in v.id for w in words for c in w.decode().replace(" ", S.SPACE))
    assert v.solve(words) == [v._encode_raw(w) for w in words]
    assert v.solve([]) == [] and v.solve([words[5]]) == [v._encode_raw(words[5])]


def test_texts_encoded_together(tools, monkeypatch):
    _, library = tools
    v = S.Vocabulary(PATH, most=40)  # far fewer than the words
    monkeypatch.setattr(S, "GROUP", 500)
    texts = [*ODD, *fuzz(300, 80, 11), "x" * 100 + " y", ""]
    got = list(S.encode_all(v, texts))
    assert [np.frombuffer(i, "<u4").tolist() for i in got] == [library.encode(t) for t in texts]
    assert len(v.known) + len(v.known.older) < 2 * (40 + 500)
    calls = []
    monkeypatch.setattr(v, "encode_word", lambda w: calls.append(w) or S.Vocabulary.encode_word(v, w))
    v.known.age()
    v.known.age()
    list(S.encode_all(v, ["some new words " + " ".join(f"w{i}x" for i in range(200))]))
    assert not calls  # many new words are not traced one by one
