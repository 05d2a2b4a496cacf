"""The bucket listed in rounds, against a plain walk."""

from __future__ import annotations

import os

import pytest

from lettermill.plans.ingest import scan_bucket
from lettermill.sources import listing


def plain(root) -> set:
    out = set()
    for tenant in os.listdir(root):
        for day in os.listdir(root / tenant) if (root / tenant).is_dir() else ():
            if not day.startswith("timestamp=2024-"):
                continue
            for folder, _, names in os.walk(root / tenant / day):
                for name in names:
                    path = os.path.join(folder, name)
                    rel = os.path.relpath(path, root / tenant / day)
                    if os.path.isfile(path):
                        out.add((tenant, day, rel, path, os.stat(path).st_size, os.stat(path).st_mtime_ns))
    return out


@pytest.mark.parametrize("share", [1, 7, 5000])
def test_rounds_find_what_a_walk_finds(spark, bucket, monkeypatch, tmp_path, share):
    monkeypatch.setattr(listing, "FIRST_SHARE", share)
    monkeypatch.setattr(listing, "SHARE", 3 * share)
    for i in range(40):
        bucket.put(b"x" * i, f"{'deep/' * (i % 6)}m{i}.eml", day=f"2024-07-{15 + i % 3}", namespace=f"t{i % 4}")
    bucket.put(b"", "empty.eml", namespace="alone")
    (bucket.root / "stray.eml").write_bytes(b"x")
    (bucket.root / "t1" / "stray.eml").write_bytes(b"x")
    (bucket.root / "t1" / "other").mkdir()
    (bucket.root / "t1" / "timestamp=2024-08-01").mkdir()
    day = bucket.root / "t0" / "timestamp=2024-07-15"
    os.symlink(day / "m0.eml", day / "linked.eml")
    os.symlink(day, day / "loop")  # a linked directory is not entered
    os.symlink(bucket.root / "nowhere", day / "gone.eml")
    os.mkfifo(day / "pipe.eml")
    work = str(tmp_path / "list")
    found = listing.with_stats(listing.list_bucket(spark, str(bucket), work), 4).collect()
    assert {tuple(r) for r in found} == plain(bucket.root) and len(found) == len(plain(bucket.root))
    rounds = len(os.listdir(work))
    assert rounds >= 4 if share == 1 else rounds <= 4
    some = scan_bucket(spark, str(bucket), {"namespaces": "t1, t2", "min_partition": "timestamp=2024-07-16"}).collect()
    assert {tuple(r) for r in some} == {r for r in plain(bucket.root) if r[0] in ("t1", "t2") and r[1] >= "timestamp=2024-07-16"}


def test_roots(spark, bucket, tmp_path):
    assert scan_bucket(spark, str(bucket) + "-missing").count() == 0
    assert scan_bucket(spark, str(bucket)).count() == 0
    (tmp_path / "file").write_bytes(b"")
    with pytest.raises(NotADirectoryError):
        scan_bucket(spark, str(tmp_path / "file"))
