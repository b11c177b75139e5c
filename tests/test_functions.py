"""Column functions: bait detector, key coalescing, URLs, media rules,
credibility codes, calendar ."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import credibility as C
from tessera.functions import media as M
from tessera.functions import text as T
from tessera.functions.calendar import calendar_columns, parse_ts

BAIT_TRUE = ["Comment BREAD and I will send you the recipe", "dm me, I reply to all", "more on this: link in bio!",
             "leave a comment with your town", "just message me about prices", "Comment YEAST", "you can check the link tonight", "send a DM"]
BAIT_FALSE = ["We open at eight tomorrow", "", "the administrator called", "a long commentary on rye", "linked lists", None]


def test_bait_detector(spark):
    rows = [(c, True) for c in BAIT_TRUE] + [(c, False) for c in BAIT_FALSE]
    df = spark.createDataFrame(rows, "caption string, expected boolean")
    got = df.select("caption", "expected", T.engagement_bait(F.col("caption")).alias("b")).collect()
    assert [(r.caption, r.b) for r in got] == [(r.caption, r.expected) for r in got]


def test_profile_url(spark):
    names = ["harbour.pilot", "tide_7", "x"]
    df = spark.createDataFrame([(n, f) for n in names for f in (n, "/" + n, n + "//")], "n string, given string")
    url = T.profile_url(F.col("given"))
    for r in df.select("n", url.alias("url"), T.profile_url(url).alias("again")).collect():
        assert r.url.endswith(f".com/{r.n}/") and r.url.startswith("https://") and r.again == r.url


def test_strip_and_truncate(spark):
    df = spark.createDataFrame([("  x y \t\n", "a" * 5003)], "s string, c string")
    r = df.select(T.py_strip(F.col("s")).alias("s"),
                  F.length(T.truncate_chars(F.col("c"))).alias("n")).first()
    assert r.s == "x y" and r.n == 5000


@pytest.mark.parametrize("names,expected,label", [
    (["video.mp4", "media_00.jpg"], ["video.mp4"], "video"),
    (["image.jpg", "media_00.jpg"], ["image.jpg"], "image"),
    (["media_02.txt", "media_01.mp4", "media_00.jpg"], ["media_00.jpg", "media_01.mp4"],
     "carousel"),
    ([f"media_{i:02d}.jpg" for i in range(14)], [f"media_{i:02d}.jpg" for i in range(12)],
     "carousel"),
    ([], [], "none"),
    (["A.JPG"], ["A.JPG"], "image"),
])
def test_media_selection(spark, names, expected, label):
    df = spark.createDataFrame([(names,)], "names array<string>")
    r = df.select(M.select_media(F.col("names")).alias("m")) \
        .select("m", M.media_type_label(F.col("m")).alias("l")).first()
    assert list(r.m) == expected and r.l == label


def test_mime_types(spark):
    df = spark.createDataFrame([("a.MOV",), ("b.jpeg",), ("c.bin",), (".mp4",)], "n string")
    got = [r[0] for r in df.select(M.mime_type(F.col("n"))).collect()]
    assert got == ["video/quicktime", "image/jpeg", "application/octet-stream",
                   "application/octet-stream"]


def test_credibility(spark):
    df = spark.createDataFrame([("A1",), ("E5",), ("G1",), (None,)], "c string")
    got = df.select(C.source_label(F.col("c")), C.information_label(F.col("c")),
                    C.is_high_confidence(F.col("c"))).collect()
    assert tuple(got[0]) == ("Practitioner", "Demonstrated", True)
    assert tuple(got[1]) == ("Engagement baiter", "Improbable", False)
    assert tuple(got[2]) == (None, None, False)


def test_timestamp_and_calendar(spark):
    df = spark.createDataFrame([("2025-06-15T23:30:00+02:00",), ("2025-12-01T00:00:00.000Z",),
                                ("",), ("garbage",)], "t string")
    rows = df.select(parse_ts(F.col("t")).alias("ts")) \
        .select("ts", *calendar_columns(F.to_date("ts"))).collect()
    assert str(rows[0].ts) == "2025-06-15 23:30:00"  # wall clock kept, offset dropped
    assert rows[1].time_key == 20251201 and rows[1].quarter == 4  # not the float-division 5
    assert rows[2].ts is None and rows[3].ts is None
