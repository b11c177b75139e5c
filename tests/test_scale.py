"""What the work of a run grows with: files by bytes, no shuffle of lines by
dataset, texts cut and orders dropped before their joins, pairs found once."""

import glob
import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera.operators import gold as G
from tessera.operators import taxonomy as TX
from tessera.operators import term_registry as TR
from tessera.operators.upsert import BucketedTable
from tessera.plans import registry  # noqa: F401
from tessera.plans import q_graph, q_media, star
from tessera.plans.medallion import Medallion
from tessera.schemas import ANALYSIS_DDL
from tessera.session import staged
from tessera.sources import bronze as B
from tessera.sources import media as SM
from tessera.streaming import silver_stream


def at():
    return F.lit("2024-05-01 00:00:00").cast("timestamp_ntz")


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _lines(spark, n, datasets):
    return spark.range(n).select(F.concat(F.lit("d"), (F.col("id") % datasets).cast("string")).alias("dataset_id"), F.col("id").alias("k"),
                                 F.concat(F.lit('{"id": '), (F.col("id") + 1).cast("string"), F.lit("}")).alias("line"))


def test_landed_files_follow_the_bytes_not_the_shuffle_partitions(spark, tmp_path, many_partitions):
    med = Medallion(spark, str(tmp_path), buckets=2)
    B.land(_lines(spark, 600, 2), med.bronze, downloaded_at=at(), order_by="k")
    assert len(glob.glob(os.path.join(med.bronze, "dataset_id=*", "*", "part-*.txt"))) <= 8
    q = silver_stream.run(med, at(), files_per_batch=1)
    assert q.lastProgress["batchId"] < 8
    assert {tuple(r) for r in med.progress().select("source_dataset", "post_count").collect()} == {("d0", 300), ("d1", 300)}
    assert med.silver_posts().count() == 600


def test_landing_does_not_shuffle_lines_by_dataset(spark, tmp_path, monkeypatch):
    root, kept = str(tmp_path / "b"), []
    first = _lines(spark, 30, 2)
    B.land(first, root, downloaded_at=at(), order_by="k")
    ranged = type(first).repartitionByRange
    monkeypatch.setattr(type(first), "repartitionByRange", lambda self, *a: kept.append(self) or ranged(self, *a))
    B.land(_lines(spark, 60, 3), root, downloaded_at=at(), order_by="k")
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.index("LeftAnti") < plan.index("BroadcastExchange")
    assert {tuple(r) for r in B.read_manifest(spark, root).select("dataset_id", "item_count").collect()} == {("d0", 15), ("d1", 15), ("d2", 20)}


def test_captions_are_cut_and_flagged_before_the_joins(spark):
    class Cat:
        documents = spark.createDataFrame([(0, "x" * 6000 + " DM me"), (1, None), (9, "plain"), (None, "t")], "doc_id long, text string")
    rows = {r.doc_id: r for r in star.stored_captions(Cat).collect()}
    assert (len(rows[0].caption), rows[0].bait) == (5000, True)
    assert (rows[1].caption, rows[1].bait, rows[9].bait) == (None, False, False)


def test_resources_of_wanted_orders_only(spark):
    class Cat:
        lineitem = spark.createDataFrame([(1, 2, 5), (1, 1, 6), (2, 1, 5), (None, 1, 5)], "l_orderkey long, l_linenumber int, l_partkey long")
        part = spark.createDataFrame([(5, "p5", "b", "t"), (6, "p6", "b", "t")], "p_partkey long, p_name string, p_brand string, p_type string")
    wanted = spark.createDataFrame([(1,), (1,), (None,), (7,)], "r_orderkey long")
    got = {r.r_orderkey: [x.name for x in r.resources] for r in star.resources(Cat, wanted).collect()}
    assert got == {1: ["p6", "p5"]}


def test_similar_pairs_are_found_once(spark, monkeypatch):
    class S:
        class cat:
            embeddings = spark.createDataFrame([(i, 0, [1.0, float(i % 3)]) for i in range(9)], "vec_id long, label int, embedding array<float>")
    runs = spark.sparkContext.accumulator(0)
    real = TX.similar_pairs

    def counted(units, threshold):
        def tick(batches):
            runs.add(1)
            yield from batches
        found = real(units, threshold).coalesce(1)
        return found.mapInArrow(tick, found.schema)
    monkeypatch.setattr(TX, "similar_pairs", counted)
    p, u = q_graph._pairs(S)
    TX.review_queue(p, TX.clusters(p, u)).collect()
    assert runs.value == 1


def _rows(spark, n, tag):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(tag).alias("tag"))


def test_a_version_with_all_keys_is_the_new_base(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=2)
    for tag in "abc":
        t.upsert(_rows(spark, 60, tag), as_of=at(), keep_first=())
    live = t._published()[1].values()
    assert {(x.base, x.deltas, x.more) for x in live} == {(3, (), ())}
    assert {r.tag for r in t.read().collect()} == {"c"} and t.read().count() == 60
    t.upsert(_rows(spark, 59, "d").unionByName(_rows(spark, 1, "e")), as_of=at(), keep_first=())  # a key twice, another not at all
    assert sorted(r.k for r in t.read().collect()) == sorted(str(i) for i in range(60))
    assert next(r.tag for r in t.read().collect() if r.k == "59") == "c"


def test_new_keys_of_an_appended_table_are_not_merged(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=2, keep_versions=1, appends=True)
    for i in range(3):
        t.upsert(_rows(spark, 40, str(i)).withColumn("k", F.concat("k", F.lit(f"/{i}"))), as_of=at(), keep_first=())
    assert {(x.base, x.more, x.deltas) for x in t._published()[1].values()} == {(1, (2, 3), ())}
    t.upsert(_rows(spark, 40, "again").withColumn("k", F.concat("k", F.lit("/2"))), as_of=at(), keep_first=())  # the run came twice
    want = sorted([(f"{k}/{i}", str(i)) for k in range(40) for i in (0, 1)] + [(f"{k}/2", "again") for k in range(40)])
    for _ in range(2):
        assert sorted((r.k, r.tag) for r in t.read().collect()) == want
        t.vacuum()
        t.compact()


def test_a_run_writes_its_documents_once(spark, tmp_path, monkeypatch):
    """Every document goes to the history and to the table once a run, and none stays in shuffles or checkpoints."""
    store = G.GoldStore(spark, str(tmp_path / "gold"), buckets=2)
    first = spark.range(20).select(F.col("id").cast("string").alias("post_id"), F.lit(3).alias("schema_version"), F.lit("analysed").alias("status"),
                                   F.from_json(F.concat(F.lit('{"domain": "'), F.col("id").cast("string"), F.lit('"}')), ANALYSIS_DDL).alias("result"),
                                   F.lit(None).cast("string").alias("error"), F.lit(1).alias("attempts"), at().alias("analysed_at"))
    store.gold.upsert(first, as_of=at(), keep_first=())
    written, write = [], BucketedTable._write
    monkeypatch.setattr(BucketedTable, "_write", lambda self, rows, v: written.append(sum((n := write(self, rows, v)).values())) or n)
    monkeypatch.setattr(type(first), "checkpoint", lambda self, eager=True: pytest.fail("documents are checkpointed"))
    results = first.select("post_id", "status", F.to_json("result").alias("result_json"), "error")
    for seq in range(3):
        store.run(results, at(), seq)
    assert written == [20] * 6
    assert sorted((r.post_id, r.seq, r.result.domain) for r in store.history().collect()) == sorted((str(i), s, str(i)) for i in range(20) for s in range(3))
    assert {(r.attempts, r.result.domain == r.post_id) for r in store.gold.read().collect()} == {(4, True)}


def test_staged_rows_leave_no_shuffle_files(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = local.getAllFiles().size()
    out = staged(spark.range(4000).groupBy((F.col("id") % 100).alias("g")).count())
    for _ in range(50):  # files go right after the write ends
        if local.getAllFiles().size() <= before:
            break
        time.sleep(0.1)
    assert local.getAllFiles().size() <= before
    assert out.count() == 100 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def _put(root, *names, body=b"x"):
    for n in names:
        os.makedirs(os.path.dirname(os.path.join(root, n)), exist_ok=True)
        with open(os.path.join(root, n), "wb") as f:
            f.write(body * len(n))


def test_media_are_listed_by_executors_as_by_the_file_index(spark, tmp_path):
    root = str(tmp_path / "m")
    _put(root, "ds-0/1/a.jpg", "ds-0/1/b b%20+.MP4", "ds-0/2/é.png", "ds-1/2/deep/er/c.gif", "ds-1/notes.txt", "top.txt",
         "ds-1/3/_hidden.jpg", "ds-1/3/.dot.jpg", "ds-1/_temporary/4/d.jpg", "ds-1/k=1/_p=2.jpg", "ds-1/5/e.jpg._COPYING_")
    _put(root, "ds-1/3/empty.jpg", body=b"")
    os.makedirs(os.path.join(root, "ds-1", "6"))
    rel = F.split(F.regexp_extract("path", r"([^/]+)/([^/]+)/([^/]+)$", 0), "/")
    indexed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    want = sorted(tuple(r) for r in indexed.select(rel[0], rel[1], rel[2], "length").collect())
    for at_ in (root, f"file://{root}"):
        got = SM.listing(spark, at_)
        assert sorted(tuple(r) for r in got.collect()) == want and len(want) == 7
        assert "binaryFile" not in got._jdf.queryExecution().toString()
    with pytest.raises(AnalysisException):
        SM.listing(spark, str(tmp_path / "nowhere")).collect()


def test_media_of_a_uri_are_written_below_its_path(spark, monkeypatch, tmp_path):
    class Cat:
        conversations = spark.createDataFrame([(7, 0, "user", "hi"), (7, 1, "assistant", None), (8, 0, "tool", "x")], "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(q_media, "shared_path", lambda *_: f"file://{tmp_path}/media")
    got = q_media._media_of_posts(spark, Cat)
    assert {(r.source_dataset, r.post_id, *r.media_files) for r in got.collect()} == {("ds1", "7", "media_00.jpg", "video.mp4")}
    assert sorted(os.listdir(tmp_path / "media" / "ds1" / "7")) == ["media_00.jpg", "media_01.mp4", "video.mp4"]


def test_pairs_are_staged_not_checkpointed(spark, monkeypatch):
    class S:
        class cat:
            embeddings = spark.createDataFrame([(i, 0, [1.0, float(i % 3)]) for i in range(9)], "vec_id long, label int, embedding array<float>")
    monkeypatch.setattr(type(S.cat.embeddings), "checkpoint", lambda self, eager=True: pytest.fail("pairs are checkpointed"))
    p, _ = q_graph._pairs(S)
    assert p.count() == 36 and {r.status for r in p.collect()} <= {"auto_merged", "pending_review", "distinct"}


def test_edges_meet_few_heads_before_a_shuffle(spark):
    terms = spark.range(30).select(F.col("id").alias("term_id"), F.lit("t").alias("term_type"), F.col("id").cast("string").alias("raw_value"))
    clusters = spark.range(30).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("component"))
    edges = spark.range(30).crossJoin(spark.range(30).toDF("b")).filter("id < b").select(F.col("id").alias("id_a"), F.col("b").alias("id_b"), F.lit(0.5).alias("cosine"))
    rows = TR.cluster_rows(terms, clusters, staged(edges), F.lit("2024-05-01"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [component" in plan and "LeftSemi" in plan
    assert sorted((r.term_id, r.similarity_score, r.merged_into_id) for r in rows.collect()) == [(0, None, None)] + [(i, 0.5, 0) for i in range(1, 30)]
