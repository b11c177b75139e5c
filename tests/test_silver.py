"""Bronze -> silver: key rules, last write wins, versioned upsert, progress, failed runs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import silver as S
from tessera.operators.upsert import BucketedTable
from tessera.plans.medallion import Medallion, silver_view
from tessera.session import read_if_present
from tessera.sources import bronze as B
from tessera.streaming import silver_stream


def at(day):
    return F.lit(f"2024-05-{day:02d} 10:00:00").cast("timestamp_ntz")


def lines(spark, dataset, objs):
    return spark.createDataFrame([(dataset, i, o if isinstance(o, str) else json.dumps(o)) for i, o in enumerate(objs)],
                                 "dataset_id string, n int, line string")


def land(spark, med, dataset, objs, day):
    return B.land(lines(spark, dataset, objs), med.bronze, downloaded_at=at(day), order_by="n").collect()


def boat(key, **more):
    return {"id": key, "shortCode": f"boat-{key}", "ownerId": 77, "ownerUsername": "harbour", **more}


def rows(med):
    return {r.post_id: r for r in silver_view(med.silver_posts()).collect()}


def test_blank_dataset_is_recorded_once(spark):
    med = Medallion(spark)
    land(spark, med, "quiet", ["", "  \t"], 1)
    assert tuple(med.deduplicate_all(at(2)).first()) == (1, 0)
    assert tuple(med.deduplicate_all(at(3)).first()) == (0, 0)
    assert med.silver_posts() is None
    assert [(r.source_dataset, r.post_count) for r in med.progress().collect()] == [("quiet", 0)]


def test_later_dataset_wins_and_first_insert_time_stays(spark):
    med = Medallion(spark, buckets=3)
    land(spark, med, "north", [boat(5, caption="calm"), boat(6, likesCount=2), boat(5, caption="windy")], 1)
    assert tuple(med.deduplicate_all(at(2)).first()) == (1, 3)
    assert rows(med)["5"].caption == "windy"
    land(spark, med, "south", [boat(6, likesCount=9, hashtags=["sail"], metaData={"followersCount": 41})], 2)
    assert tuple(med.deduplicate_all(at(4)).first()) == (1, 1)
    got = rows(med)
    assert (got["6"].likes_count, got["6"].source_dataset, list(got["6"].hashtags), got["6"].meta_followers) == (9, "south", ["sail"], 41)
    assert {str(r.silvered_at) for r in got.values()} == {"2024-05-02 10:00:00"}
    assert got["5"].owner_id == "77" and got["5"].video_play_count == 0


def test_landing_twice_skips(spark):
    med = Medallion(spark)
    assert [(r.item_count, r.skipped) for r in land(spark, med, "a", [boat(1), " "], 1)] == [(1, False)]
    assert [(r.item_count, r.skipped) for r in land(spark, med, "a", [boat(1), boat(2)], 1)] == [(1, True)]


def test_odd_lines(spark):
    df = lines(spark, "d", ["{oops", "7", '"text"', {"caption": "keyless"}, {"id": 0, "shortCode": "zero"}, {"id": "0"}, {"id": False, "shortCode": None}])
    good, bad = S.parse(df.withColumnRenamed("n", "row_id"))
    assert sorted(r.post_id for r in good.collect()) == ["0", "zero"]
    assert sorted(r.reason for r in bad.collect()) == ["malformed", "no_key", "no_key", "not_object", "not_object"]


def test_part_numbers_order_lines(spark):
    names = [("part-99999-x.txt", 1), ("part-100000-x.txt", 2)]
    df = spark.createDataFrame([(n, k) for n, k in names], "file_name string, k int").select(
        "*", F.lit("d").alias("dataset_id"), at(1).alias("ds_order_ts"), F.lit(0).alias("block_start"), F.lit(0).alias("row_id"))
    assert [r.k for r in df.orderBy(S.order_key()).collect()] == [1, 2]


def test_media_of_posts(spark):
    posts = spark.createDataFrame([("x", "s"), ("y", "s")], "post_id string, source_dataset string")
    media = spark.createDataFrame([("s", "y", ["1.png"]), ("t", "x", ["2.png"])], "source_dataset string, post_id string, media_files array<string>")
    assert {r.post_id: (list(r.media_files), r.media_count) for r in S.attach_media(posts, media).collect()} == {"x": ([], 0), "y": (["1.png"], 1)}


def table(spark, tmp_path):
    return BucketedTable(spark, str(tmp_path / "t"), "k", buckets=2)


def test_unpublished_version_is_not_seen(spark, tmp_path):
    t, stamp = table(spark, tmp_path), at(1)
    df = lambda *v: spark.createDataFrame(list(v), "k string, n int")
    assert t.read() is None
    t.upsert(df(("a", 1), ("b", 1), ("c", 1)), as_of=stamp)
    t.write(df(("a", 9), ("d", 9)), as_of=stamp)  # stopped before publishing
    assert sorted((r.k, r.n) for r in t.read().collect()) == [("a", 1), ("b", 1), ("c", 1)]
    t.upsert(df(("b", 2)), as_of=stamp)
    assert sorted((r.k, r.n) for r in t.read().collect()) == [("a", 1), ("b", 2), ("c", 1)]


def test_failed_read_never_passes_for_an_empty_table(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(spark.createDataFrame([("a", 1)], "k string, n int"), as_of=at(1))
    index = str(tmp_path / "t" / "_index")
    for f in os.listdir(index):
        if f.endswith(".parquet"):
            with open(os.path.join(index, f), "wb") as out:
                out.write(b"damaged")
    with pytest.raises(Exception):
        t.upsert(spark.createDataFrame([("b", 1)], "k string, n int"), as_of=at(2))
    assert os.listdir(tmp_path / "t") and not os.path.exists(tmp_path / "t" / "v=2")
    assert read_if_present(lambda: spark.read.parquet(str(tmp_path / "nowhere"))) is None


def _folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def _wide(spark, first, last, step=1, tag="old"):
    return spark.range(first, last, step).select(F.col("id").cast("string").alias("k"), F.lit(tag).alias("tag"), F.sha2(F.concat("id", F.lit(tag)), 256).alias("body"))


def test_upsert_writes_what_changes(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=2)
    t.upsert(_wide(spark, 0, 40_000), as_of=at(1))
    t.upsert(_wide(spark, 0, 40_000, 100, "new").coalesce(1), as_of=at(2))
    assert _folder_bytes(tmp_path / "t" / "v=2") < 0.03 * _folder_bytes(tmp_path / "t" / "v=1")
    t.upsert(_wide(spark, 39_900, 40_100, 100, "newer").coalesce(1), as_of=at(3))
    got = {r.k: (r.tag, str(r.silvered_at)[:10]) for r in t.read().select("k", "tag", "silvered_at").collect()}
    want = {str(i): ("new" if i % 100 == 0 else "old", "2024-05-01") for i in range(40_000)}
    assert got == want | {"39900": ("newer", "2024-05-01"), "40000": ("newer", "2024-05-03")} and t.read().count() == 40_001


def test_reads_go_on_while_a_table_is_compacted(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=3, fold_at=9.0)
    for i in range(4):
        t.upsert(_wide(spark, 0, 50 * (i + 1), i + 1, f"t{i}"), as_of=at(i + 1))
    before = t.read()
    want = sorted(tuple(r) for r in t.read().collect())
    t.compact()
    assert all(not x.deltas for x in t._published()[1].values())
    t.vacuum(keep=2)
    assert sorted(tuple(r) for r in before.collect()) == want == sorted(tuple(r) for r in t.read().collect())
    t.vacuum(keep=1)
    assert sorted(tuple(r) for r in t.read().collect()) == want
    assert {d for d, _, fs in os.walk(tmp_path / "t") if any(f.endswith(".parquet") for f in fs)} == \
        {str(tmp_path / "t" / "_index")} | {str(tmp_path / "t" / "v=5" / f"bucket={b}") for b in range(3)}


def test_deltas_are_folded_when_there_are_many(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), "k", buckets=1, max_deltas=3, fold_at=9.0, keep_versions=2)
    df = lambda *v: spark.createDataFrame(list(v), "k string, n int")
    t.upsert(df(*[(c, 0) for c in "abcdef"]), as_of=at(1))
    for i in range(1, 6):
        t.upsert(df(("a", i), (None, i)), as_of=at(2))
    assert {r.k: r.n for r in t.read().collect()} == {"a": 5, None: 5, **{c: 0 for c in "bcdef"}}
    assert t.read().count() == 7 and len(t._published()[1][0].deltas) < 3
    t.upsert(df(("z", 1)).limit(0), as_of=at(3))
    assert t.read().count() == 7


def test_order_keeps_newer_rows(spark, tmp_path):
    t = table(spark, tmp_path)
    df = lambda *v: spark.createDataFrame(list(v), "k string, n int")
    t.upsert(df(("a", 5), ("b", 5)), as_of=at(1), order="n")
    t.upsert(df(("a", 3), ("b", 8), ("c", 1)), as_of=at(2), order="n")
    t.upsert(df(("b", 6)), as_of=at(3), order="n")
    assert {r.k: r.n for r in t.read().collect()} == {"a": 5, "b": 8, "c": 1}


def test_failed_landing_is_not_read(spark):
    med = Medallion(spark)
    B.write_landing(lines(spark, "a", [boat(1), boat(2)]), med.bronze, "n")  # stopped before the manifest
    assert med.deduplicate_all(at(1)).first().datasets_processed == 0
    land(spark, med, "a", [boat(1), boat(2)], 1)
    assert tuple(med.deduplicate_all(at(1)).first()) == (1, 2)


def _landed_in_turn(spark):
    """Two datasets with the same posts, the newer landed last, in several files."""
    med = Medallion(spark, buckets=2)
    B.land(lines(spark, "old", [boat(i % 4 + 1, caption=f"old {i}") for i in range(8)]).repartition(3, "n"), med.bronze, downloaded_at=at(1), order_by="n").collect()
    B.land(lines(spark, "new", [boat(i, caption=f"new {i}") for i in (1, 3, 9)]).repartition(2, "n"), med.bronze, downloaded_at=at(2), order_by="n").collect()
    return med


def test_older_lines_of_a_later_batch_do_not_replace_newer_ones(spark):
    at_once, newest_first, in_order = _landed_in_turn(spark), _landed_in_turn(spark), _landed_in_turn(spark)
    at_once.deduplicate_all(at(5))
    silver_stream.run(newest_first, at(5), files_per_batch=1, newest_first=True)
    silver_stream.run(in_order, at(5), files_per_batch=1)
    want = {k: r.caption for k, r in rows(at_once).items()}
    assert want["1"] == "new 1" and want["2"] == "old 5"
    for med in (newest_first, in_order):
        assert {k: r.caption for k, r in rows(med).items()} == want
        assert sorted((r.source_dataset, r.post_count) for r in med.progress().collect()) == [("new", 3), ("old", 8)]


def test_strict_runs_keep_rows_of_later_datasets(spark):
    plain, strict = Medallion(spark, buckets=2), Medallion(spark, buckets=2)
    for med, how in ((plain, False), (strict, True)):
        land(spark, med, "late", [boat(1, caption="late")], 9)
        med.deduplicate_all(at(10), strict=how)
        land(spark, med, "early", [boat(1, caption="early"), boat(2)], 3)
        med.deduplicate_all(at(11), strict=how)
    assert rows(plain)["1"].caption == "early" and rows(strict)["1"].caption == "late"
    assert set(rows(plain)) == set(rows(strict)) == {"1", "2"}


def test_stream_completes_a_dataset_with_its_last_file(spark):
    med = Medallion(spark, buckets=2)
    land(spark, med, "007", [boat(i) for i in range(6)], 1)
    land(spark, med, "7", [boat(9)], 1)
    silver_stream.run(med, at(2), files_per_batch=1)
    assert sorted((r.source_dataset, r.post_count) for r in med.progress().collect()) == [("007", 6), ("7", 1)]
    assert len(rows(med)) == 7 and med.deduplicate_all(at(3)).first().datasets_processed == 0
