"""Components of the n-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from tessera.llm import jaccard_join as J

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_Z))
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=repr)


def got(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as node", "text as tokens", "2 as n")
    return sorted((tuple(r) for r in J.components(df).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def family(r, ids, words, edits):
    base = [f"b{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in ids:
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(words)] = f"e{r.randrange(10**6)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("group", [4, 64])
def test_families_against_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(J, "GROUP", group)
    monkeypatch.setattr(J, "QUERIES", 5)
    r = random.Random(group)
    docs = family(r, range(100, 160), 120, 4) + family(r, range(160, 175), 60, 3) + family(r, range(175, 180), 8, 1)
    passage = " ".join(f"p{i}" for i in range(60))
    docs += [(i, passage + " " + " ".join(f"u{r.randrange(10**6)}" for _ in range(r.choice([2, 6, 9, 40])))) for i in range(200, 230)]
    docs += [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  Two"), (6, "two one"), (7, "a b c d"), (8, "É é"), (9, "é é")]
    docs += [(None, docs[0][1]), docs[5], docs[5], (300, "a b a b a b a b " * 2000), (301, "b a b a b a b a " * 2000)]
    r.shuffle(docs)
    assert got(spark, docs) == brute(docs)


def test_no_rows_and_no_candidates(spark):
    assert got(spark, []) == []
    docs = [(3, "a b c d e"), (4, "f g h i"), (5, None)]
    assert got(spark, docs) == brute(docs)


def test_on_the_tables(spark, sf_small):
    import __spark_entry__ as E
    rows = E.queries()["op2_jaccard_join"](spark, sf_small).select("doc_id", "n_shingles", "component_id").collect()
    docs = [tuple(x) for x in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, rows), key=repr) == brute(docs)
    assert any(r.doc_id != r.component_id for r in rows)


def test_keep_one(spark):
    t = "the quick brown fox jumps over the lazy dog"
    df = spark.createDataFrame([(2, t, "x"), (1, t.upper(), "y"), (1, t.upper(), "y"), (3, "other words are in here", "z"), (None, t, "n")],
                               "doc_id long, text string, source string").selectExpr("*", "1 as canonical", "true as possible", "2 as block", "3 as w0", "'r' as row")
    out = J.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id, r.source) for r in out.collect()) == [(False, 1, "y"), (False, 3, "z")]


def test_group_bound_holds_for_sizes_between_the_ends(spark):
    """x links with y (23 of 27) and shares one prefix token with the group of y, z and w."""
    c, y = [f"c{i}" for i in range(1, 24)], ["y1", "y2", "y3"]
    sets = {"x": c + ["u"], "y": y + c, "z": ["z1"] + y + c, "w": y + c[:22]}  # in the order of tokens
    assert 100 * len(set(c)) >= 85 * len(set(sets["x"]) | set(sets["y"]))
    prefix = {k: s[:len(s) - -(-85 * len(s) // 100) + 1] for k, s in sets.items()}
    ids = {t: i for i, t in enumerate(sets["z"] + ["u"])}
    rows = [(ids[t], k, len(sets[k])) for k in sets for t in prefix[k]]
    held = spark.createDataFrame(rows, "token long, node string, n int")
    own = held.selectExpr("token", "node", "n", "1L as anchor", "0 as part")
    assert "x" in {r.node for r in J.near_own(own).collect()}
    asked = held.selectExpr("token", "node", "n", "if(node = 'x', 1L, 2L) as anchor", "if(node = 'x', struct(1 as size, 0L as comp), struct(3 as size, 1L as comp)) as rank")
    ranked = asked.selectExpr("node", "anchor", "0 as part", "rank").distinct()
    assert ("x", 2) in {(r.node, r.anchor) for r in J.queries_of(asked, ranked).collect()}


def test_group_bound_is_the_least_need(spark):
    def needed(n, m):
        return -(-85 * (n + m) // 185) - -(-85 * max(n, m) // 100) + 1
    rows, want = [], set()
    for n in range(1, 150):
        low, high = -(-85 * n // 100), 100 * n // 85
        for a, b in ((low, high), (n, high), (low, n), ((low + n) // 2, (n + high) // 2)):
            least = min(needed(n, m) for m in range(a, b + 1))
            rows += [(f"{n}-{a}-{b}-{t}", n, 1, t, a, b) for t in (least, least - 1)]
            want.add(f"{n}-{a}-{b}-{least}")
    counted = spark.createDataFrame(rows, "node string, n int, g int, tokens int, least int, most int").distinct()
    assert {r.node for r in J._qualified(counted, "g").collect()} == want


def test_keep_one_leaves_a_row_of_each_component(spark):
    a, b, c, d = ("the quick brown fox jumps over the lazy dog", "some other words stand in here", "nothing like it was seen before", "a last one of its own kind")
    docs = [(1, a, "a1"), (5, a, "a5"), (5, b, "b5"), (7, b, "b7"), (6, c, "c6"), (6, d, "d6"), (6, d, "d6"), (8, "", "e8"), (8, None, "e8"), (8, c, "c8"), (None, a, "n")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as mixed", "2 as chosen", "3 as label")
    out = J.keep_one(df)
    assert out.columns == df.columns
    assert sorted(r.source for r in out.collect()) == ["a1", "b5", "c6", "d6", "e8"]


def test_keep_one_of_two_linked_texts_of_an_id(spark):
    words = [f"w{i}" for i in range(100)]
    df = spark.createDataFrame([(3, " ".join(words)), (3, " ".join([*words, "more"])), (4, " ".join(words))], "doc_id long, text string")
    assert [r.doc_id for r in J.keep_one(df).collect()] == [3]


def test_keep_one_of_rows_without_id(spark):
    near = " ".join(f"w{i}" for i in range(60))
    alone = " ".join(f"v{i}" for i in range(60))
    rows = [(1, near, "a"), (None, near, "b"), (None, near + " end", "c"), (None, alone, "d"), (None, alone, "e"), (None, alone + " end", "f"),
            (None, "other words of one row", "g"), (None, None, "h"), (None, "", "i"), (None, " ", "j"), (2, "", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = J.keep_one(df)
    assert out.columns == df.columns
    kept = sorted(r.source for r in out.collect())
    assert len(kept) == 7 and len({"d", "e", "f"} & set(kept)) == 1
    assert set(kept) - {"d", "e", "f"} == {"a", "g", "h", "i", "j", "k"}


def test_sets_are_made_without_a_cache():
    from xxhash import xxh64_intdigest

    from tessera.llm import base

    base.let_go()
    words = [b"W%d" % (k % 23) for k in range(200)]
    got = J.shingle_set(b" ".join(words) + b"\n")
    assert base._HELD == {}  # no word is kept in the worker
    want = set()
    for k in range(len(words) - 3):
        key = 0
        for w in words[k:k + 4]:
            key = (key ^ xxh64_intdigest(w.lower())) * 0x9E3779B97F4A7C15 % 2**64
            key ^= key >> 29
        want.add(key)
    assert got.tolist() == sorted(want)


def test_heads_lose_no_link_and_drop_what_cannot_be_one():
    r = np.random.default_rng(5)
    pool = r.integers(0, 1 << 64, 3000, np.uint64)
    sets = [np.unique(pool[:k]) for k in (1, 2, 3, 40)]
    for lo in range(0, 2400, 300):
        base = pool[lo:lo + 300]
        sets += [np.unique(np.concatenate((base[:300 - k], r.integers(0, 1 << 64, k, np.uint64)))) for k in (0, 5, 20, 30, 60, 150)]
    nodes = [b"%d" % i for i in range(len(sets))]
    whole, heads = J.Group(nodes, sets), J.Group(nodes, [J.head(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    links = dropped = 0
    for s in sets:
        linked, possible = set(whole.linked(s).tolist()), set(heads.possible(J.head(s), len(s), sizes).tolist())
        assert linked <= possible
        links += len(linked)
        dropped += len(sets) - len(possible)
    assert links > len(sets) and dropped > len(sets) ** 2 / 2
    none = J.Group([b"a", b"b"], [np.zeros(0, np.uint32)] * 2)
    assert none.possible(np.zeros(0, np.uint32), 3, np.array([3, 30])).tolist() == [0]


def test_whole_sets_are_fetched_for_roles_that_may_link(spark, monkeypatch):
    """Documents with a passage in common that do not link: their heads say so."""
    r, staged = random.Random(2), {}
    keep = J.stage

    def stage(df, tag):
        staged[tag] = keep(df, tag)
        return staged[tag]

    monkeypatch.setattr(J, "stage", stage)
    passage = " ".join(f"p{i}" for i in range(150))
    docs = family(r, range(20), 200, 2) + [(i, passage + " " + " ".join(f"u{r.randrange(10**6)}" for _ in range(40))) for i in range(30, 60)]
    assert got(spark, docs) == brute(docs)
    fetched = {x.cid for x in staged["jaccard-possible"].collect()}
    asked = {x.cid for x in staged["jaccard-roles"].collect()}
    assert fetched <= asked and "jaccard-postings" not in staged
    assert {r["tokens"] for r in staged["jaccard-ranked"].selectExpr("typeof(rank) as tokens").collect()} <= {"bigint"}


def test_parts_of_bins_need_no_python_workers(spark):
    parts = np.ones(1 << J.BIN_BITS, np.int32)
    assert J._of_bins(spark, parts).collect() == []
    parts[[3, 9]] = 2, 5
    of_bins = J._of_bins(spark, parts)
    assert sorted(map(tuple, of_bins.collect())) == [(3, 2), (9, 5)] and of_bins.dtypes == [("bin", "int"), ("parts", "int")]
    plan = of_bins._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" in plan, plan


def test_keep_one_makes_a_node_in_one_worker_a_task(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (2, text + " end"), (None, text), (None, "alone in its class here"), (None, None)]
    out = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(re.match(r"[\s:+|-]*", line)[0])
    chained = [(a, b) for k, a in enumerate(plan) if "ArrowEvalPython" in a
               for b in (next((x for x in plan[k + 1:] if not re.search(r"\b(Project|Filter)\b", x)), ""),) if "ArrowEvalPython" in b and depth(b) > depth(a)]
    assert any("ArrowEvalPython" in x for x in plan) and not chained, "\n".join(plan)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, text), (None, "alone in its class here"), (None, None)], key=repr)
