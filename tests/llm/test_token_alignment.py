"""op12 against a plain version: both tokenizers on whole texts, byte by byte."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tessera.llm import token_alignment

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
        self.a.encode_special_tokens = True
        self.place = token_alignment.byte_characters()

    def tokens(self, text):
        """[(id, bytes)] of A and B; none where they do not give the text back."""
        if not text:
            return [], []
        e = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.place[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])

    def links(self, a, b):
        owner = lambda side: [k for k, (_, t) in enumerate(side) for _ in t]
        return sorted(set(zip(owner(a), owner(b))))

    def groups(self, a, b):
        ends = lambda side: [sum(len(t) for _, t in side[:k + 1]) for k in range(len(side))]
        common, out, i, j = sorted(set(ends(a)) & set(ends(b))), [], 0, 0
        ea, eb = ends(a), ends(b)
        for c in common:
            left, right = [], []
            while i < len(a) and ea[i] <= c:
                left.append(str(a[i][0]))
                i += 1
            while j < len(b) and eb[j] <= c:
                right.append(str(b[j][0]))
                j += 1
            out.append(",".join(left) + "|" + ",".join(right))
        return out

    def rows(self, docs):
        seen = [(d, *self.tokens(t or "")) for d, t in docs]
        links = [[(a[i][0], b[j][0]) for i, j in self.links(a, b)] for _, a, b in seen]
        count = Counter(p for some in links for p in some)
        high = Counter()
        for (x, y), n in count.items():
            high[y] = max(high[y], n)
        for (d, a, b), some in zip(seen, links):
            groups = self.groups(a, b)
            yield (d, len(a), len(b), len(groups), len(some), sum(count[p] == high[p[1]] for p in some), sum(count[p] for p in some),
                   hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")


@pytest.fixture(scope="module")
def plain():
    return Plain()


ODD = ["", None, " ", "\n", "a", " a", "a ", "  two  spaces", "tab\there and\n\nlines \n mixed \r\n", "nb sp 　wide line", "▁piece",
       "a ▁ b", "<|endoftext|> <s> </s> <unk> <0x0A>", "emoji 👩‍👩‍👧 flag 🇫🇷", "naïve façade é", "日本語のテキスト と 漢字", "x\x00y \x1c z", "don't we'll 's 'tis",
       "\nstarts", "ends\n", "word\nword\nword", "ab" * 60 + " " + "7" * 90, "﻿bom", "İstanbul ﬁne Å ½"]


def compare(got, want):
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_odd_texts(spark, plain):
    docs = [(k, t) for k, t in enumerate(ODD)] + [(None, "a b"), (3, "a b"), (3, "a b")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'k' as key", "1 as rows", "2L as n_a")
    compare(token_alignment.alignment(df, BYTES, PIECES).collect(), list(plain.rows(docs)))


def test_blocks_of_pairs_add_up(spark, plain):
    words = random.Random(4)
    docs = [(k, " ".join(words.choice(["the", "theth", "ingan", "ouwh", "été", "1234", "x\ny"]) for _ in range(30))) for k in range(40)]
    docs += [(100 + k, docs[0][1]) for k in range(60)]
    got = token_alignment.alignment(spark.createDataFrame(docs, "doc_id long, text string"), BYTES, PIECES, block=20).collect()
    compare(got, list(plain.rows(docs)))


def test_long_texts_in_parts(plain, monkeypatch):
    monkeypatch.setattr(token_alignment, "PART", 300)
    words = random.Random(5)
    text = "".join(words.choice(["word", "été", "日本", "a.b", "123"]) + words.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(2000))
    a, b = plain.tokens(text)
    got = token_alignment.Aligner(BYTES, PIECES).aligned(text.encode())
    groups = plain.groups(a, b)
    assert got[:5] == (len(a), len(b), len(groups), len(plain.links(a, b)), hashlib.sha256(";".join(groups).encode()).hexdigest())


def test_small_cache_changes_nothing(plain):
    aligner, words = token_alignment.Aligner(BYTES, PIECES, most=5), random.Random(6)
    for _ in range(20):
        text = " ".join(words.choice(["alpha", "beta", "gamma", "delta", "eps\nilon", "zeta", "eta", "theta"]) for _ in range(12))
        a, b = plain.tokens(text)
        assert aligner.aligned(text.encode())[:2] == (len(a), len(b))
    assert len(aligner.young) <= 20


def test_not_utf8_and_packing():
    import numpy as np
    aligner = token_alignment.Aligner(BYTES, PIECES)
    assert aligner.aligned(b"a \xff b")[:5] == (0, 0, 0, 0, "")
    pairs, counts = np.array([0, 5, 70000, 2 ** 32 - 1], np.uint32), np.array([1, 2, 70000, 3])
    p, c = token_alignment.unpack(token_alignment.pack(pairs, counts))
    assert p.tolist() == pairs.tolist() and c.tolist() == counts.tolist()


def test_driver_documents(spark, sf_small, plain):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    compare(token_alignment.alignment(df, BYTES, PIECES).collect(), list(plain.rows([(r.doc_id, r.text) for r in df.collect()])))


def test_empty_table(spark):
    assert token_alignment.alignment(spark.createDataFrame([], "doc_id long, text string"), BYTES, PIECES).collect() == []
