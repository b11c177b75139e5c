"""What workers keep and what a sample holds is bounded in bytes."""

from tessera.llm import base, labelled
from tessera.llm.sentence_pieces import Vocabulary


def test_sample_holds_one_document_an_id(spark):
    docs = spark.range(20_000).selectExpr("7L as doc_id", "concat('text ', id) as text").unionByName(
        spark.createDataFrame([(8, "b"), (8, None), (9, "x" * (labelled.LONGEST + 1)), (None, "c")], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0), (8, None), (9, 1), (None, 1)], "doc_id long, toxic int")
    got = labelled.sample(docs, labels, "toxic", 5, 99, 10).collect()
    assert sorted((r.doc_id, r.y) for r in got) == [(7, 1), (8, 0)]
    again = labelled.sample(docs.repartition(7, "text"), labels, "toxic", 5, 99, 10).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert labelled.sample(docs, labels, "toxic", 5, 99, 1).count() <= 1


def test_long_words_are_not_kept():
    m = base.Memo(len, most=3, longest=5)
    assert [m[w] for w in ("a", "bb", "a" * 6, "ccc", "dddd", "a")] == [1, 2, 6, 3, 4, 1]
    assert "a" * 6 not in m and "a" * 6 not in m.older and len(m) + len(m.older) <= 6


def test_pieces_of_long_words_are_not_kept():
    import public_tokenizers
    v = Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert v.known[b" " + b"ab" * 5000] and not v.known


def test_a_worker_keeps_one_operators_caches():
    base.held("a", list).append(1)
    assert base.held("a", list) == [1]
    base.held("b", list)
    assert base.held("a", list) == []
    base.let_go()
    assert base._HELD == {}
