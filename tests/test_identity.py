from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lettermill.functions import identity


def expected_canonical(raw: bytes) -> bytes:
    if raw[:3] == b"\xef\xbb\xbf":
        raw = raw[3:]
    raw = re.sub(rb"\AFrom [^\r\n]*\r?\n", b"", raw)
    return re.sub(rb"\r\n?", b"\n", raw).rstrip(b"\n\t ")


def expected_id(namespace: str, raw: bytes) -> str:
    return hashlib.sha256(namespace.encode() + b"\0" + expected_canonical(raw)).hexdigest()


FRAGMENTS = st.sampled_from(
    [b"\xef\xbb\xbf", b"From a b\n", b"From x\r\n", b"From ", b"\r\n", b"\r", b"\n", b" ", b"\t",
     b"\x0b", b"\x0c", b"\x85", b"\xc3\xa9", b"\xc3", b"\xff", b"\x00", b"text", b"From",
     b" " * 255, b"\n" * 256, b"\r\n" * 128, b"\t" * 300, b"x" * 254]
)
RAW = st.one_of(
    st.binary(max_size=60), st.lists(FRAGMENTS, max_size=8).map(b"".join)
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(RAW, min_size=60, max_size=120))
def test_canonical_and_id_match_python(spark, raws):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw binary")
    rows = frame.select(
        "raw", identity.canonicalize("raw").alias("c"), identity.email_id(F.lit("té"), "raw").alias("id")
    ).collect()
    for row in rows:
        raw = bytes(row.raw)
        assert bytes(row.c) == expected_canonical(raw), raw
        assert row.id == expected_id("té", raw), raw


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_tenants_do_not_share_ids(spark):
    a = one(spark, identity.email_id(F.lit("ab"), F.lit(b"cd body")))
    assert a != one(spark, identity.email_id(F.lit("abcd"), F.lit(b" body")))
    assert a != one(spark, identity.email_id(F.lit("xy"), F.lit(b"cd body")))


def test_container_framing_does_not_change_the_id(spark):
    body = b"From: a@example.com\r\nSubject: s\r\n\r\nhello\r\n"
    forms = [body, body.replace(b"\r\n", b"\n"), b"From a@example.com Mon Jul 15\r\n" + body,
             b"\xef\xbb\xbf" + body, body + b"\n \t"]
    ids = {one(spark, identity.email_id(F.lit("t"), F.lit(f))) for f in forms}
    assert ids == {expected_id("t", body)}


def test_known_digest(spark):
    assert one(spark, identity.content_sha256(F.lit(b""))) == (
        "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    )


@pytest.mark.parametrize(
    "column",
    [
        identity.email_id, identity.source_id, identity.pool_relpath,
    ],
)
def test_missing_inputs_are_errors(spark, column):
    bad = {
        identity.email_id: [lambda: identity.email_id(F.lit(""), F.lit(b"x"))],
        identity.source_id: [
            lambda: identity.source_id(F.lit(""), F.lit("p"), F.lit("r")),
            lambda: identity.source_id(F.lit("n"), F.lit(""), F.lit("r")),
            lambda: identity.source_id(F.lit("n"), F.lit("p"), F.lit("")),
        ],
        identity.pool_relpath: [lambda: identity.pool_relpath(F.lit("ab"))],
    }[column]
    for build in bad:
        with pytest.raises(Exception, match="must be non-empty|too short"):
            one(spark, build())


def test_source_id_is_the_location(spark):
    def sid(n, p, r):
        return one(spark, identity.source_id(F.lit(n), F.lit(p), F.lit(r)))

    base = sid("ns", "timestamp=2024-07-15", "sub/x.eml")
    assert base == hashlib.sha256(b"ns\0timestamp=2024-07-15\0sub/x.eml").hexdigest()
    assert base == sid("ns", "timestamp=2024-07-15", "sub\\x.eml")
    assert base == sid("ns", "timestamp=2024-07-15", "./sub//x.eml")
    assert base != sid("ns", "timestamp=2024-07-16", "sub/x.eml")
    assert base != sid("n2", "timestamp=2024-07-15", "sub/x.eml")


@pytest.mark.parametrize(
    "path", ["a", "a/b", "a//b", "./a", "a/./b", "/a", "//a", "///a", ".", "", "a/", "a\\b", "..", "a/../b"]
)
def test_posix_relpath_matches_pathlib(spark, path):
    from pathlib import PurePosixPath

    expected = PurePosixPath(path.replace("\\", "/")).as_posix()
    assert one(spark, identity.posix_relpath(F.lit(path))) == expected


def test_pool_paths(spark):
    eid = "ab" + "0" * 62
    assert one(spark, identity.pool_relpath(F.lit(eid))) == f"ab/{eid}.eml"
    assert one(spark, identity.pool_path(F.lit(eid), F.lit("html"))) == f"emails/ab/{eid}.html"
    assert one(spark, identity.pool_path(F.lit(eid), F.lit("eml"))) == f"emails/ab/{eid}.eml"
