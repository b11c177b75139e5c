"""Contamination against a brute-force reading of the rule."""

import hashlib
import random
import re

import pytest

from tessera.llm import decontaminate as D

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))


def brute(docs, items, window=D.WINDOW):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + window]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    found |= got
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def got(spark, docs, items, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "doc_id as starts", "'x' as block")
    b = spark.createDataFrame(items, "item_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in D.contamination(d, b, **how).select(cols).collect()), key=repr)


def made(seed=3):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["é", "Ünter", "x9"]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([3, 12, 13, 14, 40]))) for i in range(20)] + [(None, text(15)), (3, text(20)), (50, ""), (51, None)]
    docs = [(i, text(r.choice([0, 2, 50, 300]))) for i in range(40)]
    for i in range(40, 60):
        docs.append((i, text(r.choice([0, 40, 400])) + ", " + r.choice(items[:20])[1].upper() + "! " + text(30)))
    return docs + [(60, None), (61, ""), (None, docs[45][1]), docs[44], docs[44]], items


@pytest.mark.parametrize("block_chars", [8_000_000, 600])
def test_against_brute_force(spark, block_chars):
    docs, items = made()
    assert got(spark, docs, items, block_chars=block_chars) == brute(docs, items)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b c")]) == []
    assert got(spark, [(1, "a b")], []) == brute([(1, "a b")], [])


def test_longest_match_and_filter(spark):
    item = " ".join(f"t{i}" for i in range(30))
    docs = [(1, "zero one " + " ".join(f"t{i}" for i in range(5, 25)) + " end"), (2, "clean text of words")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    r = {x.doc_id: x for x in D.contamination(d, b).collect()}
    assert (r[1].longest, r[1].longest_at, r[1].longest_item, r[1].n_hit) == (20, 2, "7", 20)
    assert [x.doc_id for x in D.decontaminate(d, b).collect()] == [2]


def test_on_the_tables(spark, sf_small):
    import __spark_entry__ as E
    rows = E.queries()["op10_decontaminate"](spark, sf_small).collect()
    docs = [tuple(x) for x in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(x) for x in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in rows), key=repr) == brute(docs, items)
    assert any(r.contaminated for r in rows)


@pytest.mark.parametrize("block_chars", [8_000_000, 20])
def test_clean_rows_stay_whatever_id_they_share(spark, block_chars):
    item = " ".join(f"t{i}" for i in range(30))
    docs = [(1, item, "a"), (1, "clean one", "b"), (1, item, "c"), (None, item, "d"), (None, "clean two", "e"), (None, None, "f"), (None, "clean two", "g"), (2, "clean", "h")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as row", "2 as id", "3 as key")
    b = spark.createDataFrame([(7, item), (8, "other words")], "item_id long, text string")
    out = D.decontaminate(d, b, block_chars=block_chars)
    assert out.columns == d.columns and sorted(r.source for r in out.collect()) == ["b", "e", "f", "g", "h"]


@pytest.mark.parametrize("of", [D.contamination, D.decontaminate])
def test_one_block_is_searched_judged_and_filtered_by_one_worker_without_a_shuffle(spark, of):
    d = spark.createDataFrame([(1, "a b", 3)], "doc_id long, text string, n int").repartition(2).cache()
    b = spark.createDataFrame([(7, "a b")], "item_id long, text string")
    plan = of(d, b)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and "ArrowEvalPython" not in plan, plan


@pytest.mark.parametrize("block_chars", [8_000_000, 20])
def test_rows_are_kept_whole_over_many_batches(spark, block_chars):
    item = " ".join(f"t{i}" for i in range(15))
    rows = [(k if k % 7 else None, f"{k} {item}" if k % 3 == 0 else f"clean {k}" if k % 5 else None, k) for k in range(2500)]
    d = spark.createDataFrame(rows, "doc_id long, text string, n int").coalesce(1)
    b = spark.createDataFrame([(7, item), (8, "other words")], "item_id long, text string")
    want = sorted((r for r in rows if r[2] % 3), key=repr)
    assert sorted(map(tuple, D.decontaminate(d, b, block_chars=block_chars).collect()), key=repr) == want
