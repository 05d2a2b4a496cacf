from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lettermill.functions import paths
from lettermill.operators.order import scan_rank


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "path, name, kind",
    [
        ("a.eml", "a.eml", "eml"),
        ("dir/A.EML", "A.EML", "eml"),
        ("x.html", "x.html", "html"),
        ("x.HTM", "x.HTM", "html"),
        ("b.zip!in/c.mbox", "c.mbox", "mbox"),
        ("b.zip!c.zip", "c.zip", "zip"),
        ("m.msg", "m.msg", "unsupported"),
        ("m.PST", "m.PST", "unsupported"),
        ("n.png", "n.png", "noise"),
        ("noext", "noext", "noise"),
        ("c.mbox#3", "c.mbox", "mbox"),
        ("a#1.eml", "a", "noise"),
        ("d#/e.eml", "d", "noise"),
        (".eml", ".eml", "eml"),
        ("", "", "noise"),
    ],
)
def test_classification(spark, path, name, kind):
    assert one(spark, paths.basename_of(F.lit(path))) == name
    assert one(spark, paths.classify_item(F.lit(path))) == kind


def test_hash_in_names_can_be_allowed(spark):
    assert one(spark, paths.classify_item(F.lit("a#1.eml"), cut_hash=False)) == "eml"


@pytest.mark.parametrize(
    "test, yes, no",
    [
        (paths.is_eml, ["x.eml", "X.EML"], ["x.emlx", "eml"]),
        (paths.is_html, ["x.html", "x.HTM"], ["x.xhtm1"]),
        (paths.is_mbox, ["x.mbox"], ["mbox"]),
        (paths.is_zip, ["x.Zip"], ["x.zip.txt"]),
        (paths.is_unsupported, ["x.msg", "x.PST"], ["x.eml"]),
    ],
)
def test_suffix_tests(spark, test, yes, no):
    assert all(one(spark, test(F.lit(n))) for n in yes)
    assert not any(one(spark, test(F.lit(n))) for n in no)


@pytest.mark.parametrize(
    "name, unsafe",
    [("ok.eml", False), ("/abs", True), ("\\abs", True), ("../x", True), ("a/../b", True),
     ("a\\..\\b", True), ("..a/b", False), ("a..b", False)],
)
def test_unsafe_members(spark, name, unsafe):
    assert one(spark, paths.is_unsafe_member(F.lit(name))) is unsafe


def test_scan_order_is_the_walk_order(spark, tmp_path, work):
    names = ["b.eml", "a/z.eml", "a/b/c.eml", "a/b.eml", "Z.eml", "a.eml", "c/a.eml", "a/b/a.eml",
             "é.eml", "_x.eml", ".hidden.eml"]
    for n in names:
        p = tmp_path / "t" / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"")
    walked = []
    for folder, subs, files in os.walk(tmp_path / "t"):
        subs.sort()
        walked += [os.path.relpath(os.path.join(folder, f), tmp_path / "t") for f in sorted(files)]
    frame = spark.createDataFrame([("n", "p", n) for n in names], "namespace string, partition string, relpath string")
    ranked = scan_rank(frame.repartition(5), work).orderBy("rank").collect()
    assert [r.relpath for r in ranked] == walked
    assert [r["rank"] for r in ranked] == list(range(1, len(names) + 1))


def test_partition_names(spark):
    rows = [("timestamp=2024-07-15", True), ("timestamp=2024-99-99", True), ("timestamp=2024-7-15", False),
            ("xtimestamp=2024-07-15", False), ("timestamp=2024-07-15x", False)]
    frame = spark.createDataFrame(rows, "name string, ok boolean")
    assert frame.filter(paths.is_partition_dir("name") != F.col("ok")).count() == 0
    assert one(spark, paths.partition_date(F.lit("timestamp=2024-99-99"))) is None
    assert str(one(spark, paths.partition_date(F.lit("timestamp=2024-07-15")))) == "2024-07-15"


def test_hops(spark):
    assert one(spark, paths.hops(F.lit("a.zip!b/c.mbox#4"))) == ["a.zip", "b/c.mbox", "4"]
