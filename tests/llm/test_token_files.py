"""Token files: ids as the library's, exact round trips, random access, the query's columns."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from tessera.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["Hello  world", None, "", " \n\t", "don't x<|endoftext|>y İstanbul ΑΣ", "é ́ ﬁ½ 日本語 가각 가", "a\x0bb\x1cc d　e f",
         "\x01 x\x01", "long word " * 20000, "tail"]


def expected(docs):
    tok, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


@pytest.mark.parametrize("frame_bytes", [1 << 20, 64])
def test_table(spark, frame_bytes):
    docs = [(7 * i % 10, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (5, TEXTS[5]), (-3, "x")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, start int")
    got = T.token_table(df, PATH, files=3, frame_bytes=frame_bytes)
    same = [r for r in docs if r[0] == 5]
    assert same[0][0] == same[1][0]
    rows = sorted(map(tuple, got.collect()), key=lambda r: r[1])
    want = expected(docs)
    assert [r[0] for r in rows] == [r[0] for r in want] and sorted(r[2:] for r in rows) == sorted(r[2:] for r in want)
    assert [r[1] for r in rows] == list(np.cumsum([0] + [r[2] for r in rows])[:-1])


def test_random_access_and_standard_format(spark, tmp_path):
    df = spark.createDataFrame([(i, f"w{i} " * (50 * i)) for i in range(40)], "doc_id long, text string")
    out = str(tmp_path / "files")
    T.write_token_files(df, PATH, out, files=2, frame_bytes=4096)
    tok = Tokenizer.from_file(PATH)
    for r in T.read_token_files(spark, out, [3, 39, 12]).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == [*tok.encode(f"w{r.doc_id} " * (50 * r.doc_id), add_special_tokens=False).ids, 1]
        assert r.ids_crc32 == zlib.crc32(r.ids)
    assert T.read_token_files(spark, out, [3, 39, 12]).count() == 3
    content = next((tmp_path / "files").glob("part-*")).read_bytes()
    f = T.TokenFile(content)
    plain = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert plain == b"".join(f.frame(k) for k in range(len(f.frames)))  # any zstandard reader can read it
    opened, inner = [], f.frame
    f.frame = lambda k: opened.append(k) or inner(k)
    list(f.read({f.docs[-1][0]}))
    assert len(opened) < len(f.frames) / 2
    bad = bytearray(content)
    bad[f.frames[1][2] + f.frames[1][3] // 2] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(T.TokenFile(bytes(bad)).read())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert T.token_table(df, PATH, files=2).collect() == []


def test_on_the_tables(spark, sf_small):
    import __spark_entry__ as E
    rows = E.queries()["op4_token_files"](spark, sf_small).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    docs = [tuple(x) for x in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, rows)) == expected(docs)
