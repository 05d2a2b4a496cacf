from __future__ import annotations

import os
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lettermill.catalog.builders import make_zip, mark_encrypted  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def mail(name: str) -> bytes:
    return (
        f"From: {name}@example.com\r\nTo: desk@example.com\r\nSubject: {name}\r\n\r\nbody {name}\r\n"
    ).encode()


MAIL_A, MAIL_B, MAIL_C, MAIL_D = (mail(n) for n in ("ann", "ben", "cleo", "dora"))
PAGE = b"<!doctype html><html><body><p>Good day</p></body></html>"


def make_mbox(*messages: bytes) -> bytes:
    return b"".join(
        b"From sender%d@example.com Mon Jul 15 10:00:0%d 2024\n" % (i, i) + m.rstrip(b"\n") + b"\n\n"
        for i, m in enumerate(messages)
    )


class Bucket:
    """A bucket folder and the state next to it."""

    def __init__(self, root: Path):
        self.root, self.state = root / "bucket", str(root / "state")
        self.root.mkdir(parents=True, exist_ok=True)

    def put(self, content: bytes, name: str, day: str = "2024-07-15", namespace: str = "ns") -> Path:
        path = self.root / namespace / f"timestamp={day}" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
        return path

    def __str__(self) -> str:
        return str(self.root)


@pytest.fixture
def bucket(tmp_path):
    return Bucket(tmp_path)


@pytest.fixture
def work(tmp_path):
    return str(tmp_path / f"work-{uuid.uuid4().hex}")


def fill_edge_cases(bucket: Bucket) -> None:
    """14 files: 6 distinct emails in 8 places, 7 skips for 5 reasons."""
    bucket.put(MAIL_A, "simple.eml")
    bucket.put(PAGE, "page.html")
    bucket.put(b"\x89PNG\r\n\x1a\n", "noise.png")
    bucket.put(b"PK\x03\x04 not a sheet", "noise.xlsx")
    bucket.put(make_zip([]), "empty.zip")
    bucket.put(b"", "empty.mbox")
    bucket.put(make_zip([("victim.eml", MAIL_B)])[:32], "bad.zip")
    bucket.put(mark_encrypted(make_zip([("secret.eml", MAIL_B)])), "locked.zip")
    inner = make_zip([("mail.mbox", make_mbox(MAIL_B, MAIL_C))])
    bucket.put(make_zip([("inner.zip", inner)]), "nested.zip")
    bucket.put(make_mbox(MAIL_D), "colliding_a.mbox")
    bucket.put(make_mbox(PAGE + b"\n# other bytes\n"), "colliding_b.mbox")
    bucket.put(b"\xd0\xcf\x11\xe0 message", "deferred.msg")
    bucket.put(MAIL_A, "duplicate.eml")
    bucket.put(MAIL_A, "duplicate.eml", day="2024-07-16")


def set_mtime(path: Path, delta_ns: int) -> None:
    info = path.stat()
    os.utime(path, ns=(info.st_atime_ns, info.st_mtime_ns + delta_ns))
