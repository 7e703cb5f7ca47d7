"""Listing by prefix and resumable export."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from chronoweave.sources import prefix
from chronoweave.session import ship_package


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "store"
    for k in range(7):
        (root / f"session_{k}/videos").mkdir(parents=True)
        (root / f"session_{k}/metadata.json").write_text(f'{{"k": {k}}}')
        (root / f"session_{k}/videos/head.mp4").write_bytes(bytes([k]) * (1000 * k))
    (root / "readme.txt").write_text("x")
    return root


def test_pages_list_every_file_once(spark, tree):
    ship_package(spark)
    for size in (1, 3, 100):
        files = prefix.list_prefix(spark, f"file://{tree}", size)
        rows = files.collect()
        assert sorted(r["path"] for r in rows) == sorted(f"file://{d}/{n}" for d, _, names in os.walk(tree) for n in names)
        assert len({r["page"] for r in rows}) == -(-8 // size) == files.rdd.getNumPartitions()
    assert {(r["group"], r["n_files"], r["bytes"]) for r in prefix.browse(files).collect()} == {("", 1, 1)} | {(f"session_{k}", 2, 8 + 1000 * k) for k in range(7)}
    assert prefix.list_prefix(spark, f"file://{tree}", pattern="*.mp4").count() == 7
    assert prefix.list_prefix(spark, f"file://{tree}/none").count() == 0


def test_an_export_goes_on_after_a_failure(spark, tree, tmp_path):
    ship_package(spark)
    root, target, manifest = f"file://{tree}", f"file://{tmp_path}/copy", f"file://{tmp_path}/manifest"
    files = prefix.list_prefix(spark, root)
    # two files go after the listing: their copies fail, the others are made
    listed = spark.createDataFrame(files.collect(), files.schema)
    for k in (2, 5):
        os.rename(tree / f"session_{k}/metadata.json", tmp_path / f"kept{k}")
    first = prefix.export_files(listed, root, target, manifest, tasks=3).collect()
    assert sorted(r["status"] for r in first) == ["done"] * 13 + ["failed"] * 2 and all(r["error"] for r in first if r["status"] == "failed")
    for k in (2, 5):
        os.rename(tmp_path / f"kept{k}", tree / f"session_{k}/metadata.json")
    second = prefix.export_files(listed, root, target, manifest).collect()
    assert sorted(r["path"] for r in second) == [f"{root}/session_{k}/metadata.json" for k in (2, 5)]
    assert prefix.export_files(listed, root, target, manifest).count() == 0
    for d, _, names in os.walk(tree):
        for n in names:
            copy = os.path.join(str(tmp_path / "copy"), os.path.relpath(os.path.join(d, n), tree))
            assert open(copy, "rb").read() == open(os.path.join(d, n), "rb").read()
    assert not [n for _, _, names in os.walk(tmp_path / "copy") for n in names if n.endswith(".part")]
    done = prefix.read_manifest(spark, manifest)
    assert done.where("status = 'done'").count() == 15
    one = done.where(F.col("path").endswith("session_3/videos/head.mp4")).first()
    assert one["sha256"] == hashlib.sha256(bytes([3]) * 3000).hexdigest() and one["size"] == 3000
    # a damaged copy is found; a file that has changed is copied again
    (tmp_path / "copy/session_3/videos/head.mp4").write_bytes(b"broken")
    assert [r["path"] for r in prefix.verify_export(listed, manifest).where("not ok").collect()] == [one["path"]]
    (tree / "session_3/videos/head.mp4").write_bytes(b"new")
    os.utime(tree / "session_3/videos/head.mp4", (2_000_000_000, 2_000_000_000))
    assert [r["size"] for r in prefix.export_files(prefix.list_prefix(spark, root), root, target, manifest).collect()] == [3]
