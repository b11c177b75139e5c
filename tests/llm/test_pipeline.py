"""The corpus pipeline: stage by stage against brute-force readings of each stage's rule."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as C
from tessera.llm import pii as P
from tests.llm import test_decontaminate, test_jaccard_join


@pytest.fixture(scope="module")
def stages(spark):
    from tessera.llm.base import stage, table
    sf = "/root/testdata/sf0.001"
    out = [table(spark, sf, "documents")]
    for name, f in C.STAGES:
        out.append(stage(f(spark, out[-1], sf), f"test-{name}"))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_toxic_documents_go(spark, stages):
    insults = {"idiot", "moron", "scum", "worthless", "pathetic"}
    before, after = dict(texts(stages[0])), dict(texts(stages[1]))
    gone = set(before) - set(after)
    assert after.items() <= before.items()
    assert not any(len(insults & set(t.lower().split())) >= 2 for t in after.values())
    assert len(gone) < 0.25 * len(before)


def test_one_of_each_component_stays(stages):
    want = {d for d, _, c in test_jaccard_join.brute(texts(stages[1])) if d == c}
    assert {d for d, _ in texts(stages[2])} == want and stages[2].count() == len(want)


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    clean = {r[0] for r in test_decontaminate.brute(texts(stages[2]), items) if not r[-1]}
    assert {d for d, _ in texts(stages[3])} == clean


def test_personal_data_is_masked(stages):
    before, after = dict(texts(stages[3])), dict(texts(stages[4]))
    assert set(before) == set(after)
    assert not any(P.base_spans(t) for t in after.values())
    assert all(after[d] == t for d, t in before.items() if not any(c in "0123456789@" for c in t))


def test_ids_and_columns(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(C.PIECES))
    text = dict(texts(stages[4]))
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(text) and all(r.round_trip for r in rows)
    assert all(list(r.ids) == library.encode(text[r.doc_id]) for r in rows)
    assert all(s.columns == stages[0].columns for s in stages[:5])


def test_odd_rows_pass_through(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, "a b c d e f", 1), (None, None, 2), (2, "", 3), (2, "", 3), (3, "mail a@b.com now please", 4)], "doc_id long, text string, tokens int") \
        .write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = C.run(spark, sf).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, 1), (False, 2), (False, 3), (True, 0)]
    assert np.sum([r.n_tokens for r in rows]) > 0
