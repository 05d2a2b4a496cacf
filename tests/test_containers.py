from __future__ import annotations

import io
import mailbox
import random
import zipfile

import pyarrow as pa
import pytest
from conftest import MAIL_A, MAIL_B, MAIL_C, PAGE, make_mbox
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lettermill import schemas as S
from lettermill.catalog.builders import damage, make_zip, mark_encrypted, members as packed_members, pack_zip
from lettermill.operators import archive
from lettermill.operators.archive import Refused, members
from lettermill.operators.mbox import explode_mbox, split_messages
from lettermill.operators.unpack import UnpackLimits, by_bytes, unpack


def item(path: str, raw: bytes, namespace: str = "t"):
    return (path, namespace, "timestamp=2024-07-15", path, path, 0, [], raw)


def run(spark, work, *files, limits=UnpackLimits()):
    frame = spark.createDataFrame([item(p, r) for p, r in files], S.ITEMS)
    return unpack(frame, work, limits)


def leaves(result):
    return {
        r.internal_path: (bytes(r.raw), r.container_depth, r.format) for r in result.leaves.collect()
    }


def skips(result):
    return {r.internal_path: (r.reason, r.details) for r in result.skips.collect()}


# --- mailboxes --------------------------------------------------------------


def stdlib_slices(raw: bytes, path) -> list[bytes]:
    path.write_bytes(raw)
    box = mailbox.mbox(str(path), create=False)
    try:
        return [box.get_bytes(k) for k in box.keys()]
    finally:
        box.close()


PARTS = st.sampled_from(
    [b"From a b\n", b"From \n", b"From x", b"\n", b"\n\n", b"\r\n", b"\r", b"body\n", b">From q\n",
     b"From: h\n", b"\x85", b"\xff\xfe", b"x", b" From y\n"]
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PARTS, max_size=10).map(b"".join), min_size=50, max_size=100))
def test_messages_match_the_standard_library(spark, tmp_path, boxes):
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(boxes)], "i int, raw binary")
    got = frame.select("i", split_messages("raw").alias("m")).collect()
    for row in got:
        expected = stdlib_slices(boxes[row.i], tmp_path / "box")
        assert [bytes(m) for m in row.m] == expected, boxes[row.i]


def test_message_paths_and_depth(spark, work):
    result = run(spark, work, ("in.mbox", make_mbox(MAIL_A, MAIL_B)))
    found = leaves(result)
    assert set(found) == {"in.mbox#0", "in.mbox#1"}
    assert found["in.mbox#0"][1:] == (1, "eml")
    assert not found["in.mbox#0"][0].startswith(b"From sender")


def test_empty_mailbox(spark, work):
    result = run(spark, work, ("none.mbox", b""), ("pre.mbox", b"only a preamble\n"))
    assert leaves(result) == {}
    assert skips(result) == {"none.mbox": (S.EMPTY_CONTAINER, ""), "pre.mbox": (S.EMPTY_CONTAINER, "")}


def test_explode_mbox_keeps_empty_ones(spark):
    frame = spark.createDataFrame([(1, b""), (2, make_mbox(MAIL_A))], "k int, raw binary")
    rows = {(r.k, r.msg_idx) for r in explode_mbox(frame).collect()}
    assert rows == {(1, None), (2, 0)}


def test_rewritten_messages(spark, work):
    long = b"Subject: " + b"word " * 40 + b"\n\nbody\n"
    box = make_mbox(long, MAIL_A, b"no headers at all")
    result = run(spark, work, ("w.mbox", box), ("x.eml", long), limits=UnpackLimits(rewrite_mbox=True))
    found = leaves(result)
    for i, raw in enumerate(stdlib_bytes(box, work)):
        assert found[f"w.mbox#{i}"][0] == raw
    assert found["x.eml"][0] == long
    assert found["w.mbox#0"][0] != long.rstrip(b"\n")


def stdlib_bytes(raw: bytes, work: str) -> list[bytes]:
    from pathlib import Path

    path = Path(work + ".mbox")
    path.write_bytes(raw)
    box = mailbox.mbox(str(path), create=False)
    try:
        return [box.get_message(k).as_bytes() for k in box.keys()]
    finally:
        box.close()


def test_a_message_that_cannot_be_written_ends_its_mailbox(spark, work, monkeypatch):
    from lettermill.operators import mbox

    def picky(body: bytes) -> bytes:
        if b"ben" in body:
            raise KeyError("content-transfer-encoding")
        return body

    monkeypatch.setattr(mbox, "_written_back", picky)
    box = make_mbox(MAIL_A, MAIL_B, MAIL_C)
    result = run(spark, work, ("w.mbox", box), ("b.eml", MAIL_B), limits=UnpackLimits(rewrite_mbox=True))
    assert set(leaves(result)) == {"w.mbox#0", "b.eml"}
    assert skips(result) == {"w.mbox": (S.CORRUPT_ARCHIVE, "mbox: 'content-transfer-encoding'")}


# --- archives ---------------------------------------------------------------


def names(raw: bytes, limit: int = S.MAX_MEMBER_BYTES):
    return [(n, b) for _, n, b in members(io.BytesIO(raw), limit)]


def test_members_by_name():
    assert names(make_zip([("b.eml", b"B"), ("a.eml", b"A")])) == [("a.eml", b"A"), ("b.eml", b"B")]


def test_directories_and_unsafe_names_are_dropped():
    raw = make_zip([("sub/", b""), ("sub/x.eml", b"X"), ("../up", b"U"), ("/abs", b"U"), ("ok", b"K")])
    assert names(raw) == [("ok", b"K"), ("sub/x.eml", b"X")]


@pytest.mark.parametrize(
    "raw, reason",
    [
        (b"not a zip at all", S.CORRUPT_ARCHIVE),
        (make_zip([("x.eml", MAIL_A)])[:60], S.CORRUPT_ARCHIVE),
        (damage(make_zip([("x.eml", MAIL_A * 20)])), S.CORRUPT_ARCHIVE),
        (mark_encrypted(make_zip([("x.eml", MAIL_A)])), S.PASSWORD_PROTECTED),
        (make_zip([]), S.EMPTY_CONTAINER),
        (make_zip([("only/", b"")]), S.EMPTY_CONTAINER),
    ],
)
def test_refused_archives(raw, reason):
    with pytest.raises(Refused) as refused:
        names(raw)
    assert refused.value.reason == reason


@pytest.mark.parametrize("hold", [archive.HOLD_BYTES, 0])
def test_member_limit_refuses_the_whole_archive(monkeypatch, hold):
    monkeypatch.setattr(archive, "HOLD_BYTES", hold)
    raw = make_zip([("a.eml", b"1"), ("big.eml", b"123456789")])
    assert names(raw, 9) == [("a.eml", b"1"), ("big.eml", b"123456789")]
    with pytest.raises(Refused) as refused:
        names(raw, 4)
    assert refused.value.details == "member too large: member 'big.eml' declares 9 bytes"


def test_one_bad_member_loses_the_archive(spark, work):
    raw = bytearray(make_zip([("a.eml", MAIL_A), ("b.eml", MAIL_B * 9)]))
    with zipfile.ZipFile(io.BytesIO(bytes(raw))) as z:
        at = z.infolist()[1].header_offset + 30 + len("b.eml") + 2
    raw[at] ^= 0xFF
    result = run(spark, work, ("x.zip", bytes(raw)))
    assert leaves(result) == {}
    assert skips(result)["x.zip"][0] == S.CORRUPT_ARCHIVE


def test_zip_in_zip(spark, work):
    outer = make_zip([("nested.zip", make_zip([("deep.eml", MAIL_A)])), ("top.eml", MAIL_B)])
    found = leaves(run(spark, work, ("batch.zip", outer)))
    assert found == {
        "batch.zip!top.eml": (MAIL_B, 1, "eml"),
        "batch.zip!nested.zip!deep.eml": (MAIL_A, 2, "eml"),
    }


def test_mailbox_in_archives(spark, work):
    raw = make_zip([("mail.mbox", make_mbox(MAIL_B, MAIL_C))])
    for _ in range(2):
        raw = make_zip([("z.zip", raw)])
    found = leaves(run(spark, work, ("r.zip", raw)))
    assert {p: v[1] for p, v in found.items()} == {
        "r.zip!z.zip!z.zip!mail.mbox#0": 4, "r.zip!z.zip!z.zip!mail.mbox#1": 4
    }


def test_noise_is_not_empty(spark, work):
    result = run(spark, work, ("junk.zip", make_zip([("p.png", b"x"), ("r.xlsx", b"y"), ("m.msg", b"z")])))
    assert skips(result) == {
        "junk.zip!p.png": (S.NOT_AN_EMAIL, ""),
        "junk.zip!r.xlsx": (S.NOT_AN_EMAIL, ""),
        "junk.zip!m.msg": (S.UNSUPPORTED_FORMAT_DEFERRED, "format not yet implemented: m.msg"),
    }


def nest(depth: int, leaf=("deep.eml", MAIL_A)) -> bytes:
    raw = make_zip([leaf])
    for _ in range(depth - 1):
        raw = make_zip([("z.zip", raw)])
    return raw


def test_depth_limit(spark, work):
    result = run(spark, work, ("root.zip", nest(3)), limits=UnpackLimits(max_depth=2))
    assert leaves(result) == {}
    assert skips(result) == {"root.zip!z.zip!z.zip": (S.DEPTH_LIMIT_EXCEEDED, "depth 3 > 2")}


def test_default_depth_limit(spark, work):
    result = run(spark, work, ("ok.zip", nest(8)), ("no.zip", nest(9)), ("box.zip", nest(8, ("m.mbox", make_mbox(MAIL_A)))))
    assert list(leaves(result).values()) == [(MAIL_A, 8, "eml")]
    assert {r for r, _ in skips(result).values()} == {S.DEPTH_LIMIT_EXCEEDED}
    assert {d for _, d in skips(result).values()} == {"depth 9 > 8"}


def test_members_with_one_name_are_all_kept(spark, work):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        raw = make_zip([("x.eml", MAIL_A), ("x.eml", MAIL_B)])
    rows = run(spark, work, ("d.zip", raw)).leaves.collect()
    assert sorted(bytes(r.raw) for r in rows) == sorted([MAIL_A, MAIL_B])
    assert {r.internal_path for r in rows} == {"d.zip!x.eml"}
    assert len({r.leaf_key for r in rows}) == 2


def test_leaf_ids(spark, work):
    rows = run(spark, work, ("a.eml", MAIL_A), ("b.mbox", make_mbox(MAIL_A)), ("p.htm", PAGE)).leaves
    ids = {r.internal_path: r.email_id for r in rows.collect()}
    assert ids["a.eml"] == ids["b.mbox#0"] != ids["p.htm"]
    assert rows.filter(F.col("format") == "html").count() == 1


# --- members by their place -------------------------------------------------


class Watched(io.BytesIO):
    """A file that remembers how many bytes were read."""

    total = 0

    def read(self, size=-1):
        out = super().read(size)
        self.total += len(out)
        return out


def packed_variously() -> bytes:
    out = io.BytesIO(b"a stub before the archive")
    out.seek(0, io.SEEK_END)
    with zipfile.ZipFile(out, "a") as z:
        for i, method in enumerate((zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)):
            z.writestr(zipfile.ZipInfo(f"{i} ü.eml"), MAIL_A * (i + 1) * 20, method)
        z.writestr("empty.eml", b"")
        z.writestr("dir/", b"")
        z.writestr("../out.eml", MAIL_B)
        z.writestr("twice.eml", MAIL_B)
        with pytest.warns(UserWarning):
            z.writestr("twice.eml", MAIL_C)
    return out.getvalue()


def read_both_ways(raw: bytes, limit: int = 1 << 20):
    with archive.open_archive(io.BytesIO(raw)) as opened:
        for info, place in zip(archive.usable_members(opened), archive.places(opened), strict=True):
            ways = []
            for read in (
                lambda info=info: archive.read_member(opened, info, limit),
                lambda place=place: archive.read_place(io.BytesIO(raw), place, limit),
            ):
                try:
                    ways.append(read())
                except Refused as refused:
                    ways.append((refused.reason, refused.details))
            yield place, ways


def test_members_read_by_place_are_those_of_the_archive():
    seen = list(read_both_ways(packed_variously()))
    assert [p["name"] for p, _ in seen] == ["0 ü.eml", "1 ü.eml", "2 ü.eml", "3 ü.eml", "empty.eml", "twice.eml", "twice.eml"]
    for _, (whole, placed) in seen:
        assert isinstance(whole, bytes) and whole == placed


@pytest.mark.parametrize("spoil", [mark_encrypted, damage, lambda raw: b"XX" + raw[2:], lambda raw: raw[:30] + b"?" + raw[31:]])
def test_bad_members_read_by_place_are_refused_alike(spoil):
    raw = spoil(make_zip([("a.eml", MAIL_A), ("password.eml", MAIL_B)]))
    seen = list(read_both_ways(raw))
    assert any(isinstance(whole, tuple) for _, (whole, _) in seen)
    for _, (whole, placed) in seen:
        assert whole == placed
    for _, (whole, placed) in read_both_ways(raw, limit=3):
        assert whole == placed and whole[1].startswith("member too large")


@given(st.data())
@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
def test_any_damage_is_refused_alike(data):
    raw = bytearray(make_zip([("a.eml", MAIL_A), ("b.eml", MAIL_B)]))
    for _ in range(data.draw(st.integers(1, 3))):
        raw[data.draw(st.integers(0, len(raw) - 1))] = data.draw(st.integers(0, 255))
    try:
        seen = list(read_both_ways(bytes(raw)))
    except Refused:
        return
    for _, (whole, placed) in seen:
        assert whole == placed


def test_members_said_to_start_at_the_same_place_are_refused_alike():
    raw = bytearray(make_zip([("a.eml", MAIL_A), ("b.eml", MAIL_B)]))
    at = raw.rfind(b"PK\x01\x02") + 42  # where the directory says that the last member starts
    raw[at:at + 4] = bytes(4)
    seen = list(read_both_ways(bytes(raw)))
    assert len({place["at"] for place, _ in seen}) == 1
    for _, (whole, placed) in seen:
        assert whole == placed


def test_a_member_costs_the_same_however_many_others_there_are():
    costs = []
    for n in (10, 3000):
        raw = make_zip([(f"{i:06d}.eml", MAIL_A + b"%06d" % i) for i in range(n)])
        with archive.open_archive(io.BytesIO(raw)) as opened:
            *_, last = archive.places(opened)
        file = Watched(raw)
        assert archive.read_place(file, last, 1 << 20) == MAIL_A + b"%06d" % (n - 1)
        costs.append(file.total)
    assert max(costs) < 5000


# --- waves by bytes ---------------------------------------------------------


def test_a_big_archive_among_many_small_ones_has_a_task_of_its_own(spark):
    sizes = [50] * 300 + [40_000, 9_000]
    rows = [(f"s{i % 3}", [i], n, b"x" * n) for i, n in enumerate(sizes)]
    table = spark.createDataFrame(rows, "source_id string, pos array<int>, size_bytes bigint, raw binary")
    dealt = by_bytes(table, task_bytes=2_000)
    assert dealt.columns == table.columns
    tasks = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("size_bytes").alias("b")).collect()
    assert sum(t.n for t in tasks) == len(sizes)
    assert {(t.n, t.b) for t in tasks if t.b >= 9_000} == {(1, 40_000), (1, 9_000)}
    assert max(t.b for t in tasks if t.b < 9_000) < 3 * sum(sizes) / len(tasks)


@pytest.mark.parametrize("sizes", [[], [0], [0, 0, 0], [5], [7] * 9])
def test_waves_of_any_sizes_keep_their_archives(spark, sizes):
    rows = [("s", [i], n, b"x" * n) for i, n in enumerate(sizes)]
    table = spark.createDataFrame(rows, "source_id string, pos array<int>, size_bytes bigint, raw binary")
    assert sorted(r.pos[0] for r in by_bytes(table, task_bytes=6).collect()) == list(range(len(sizes)))


# --- small archives are opened where they are -------------------------------


def test_small_archives_need_no_waves(spark, work):
    inner = make_zip([("mail.mbox", make_mbox(MAIL_B, MAIL_C)), ("low.ZIP", make_zip([("x.eml", MAIL_A)]))])
    bad = make_zip([("victim.eml", MAIL_B)])[:32]
    small = [("a.zip", make_zip([("in.zip", inner), ("top.eml", MAIL_A), ("bad.zip", bad)])), ("b#c.zip", inner)]
    noise = random.Random(3).randbytes(archive.NESTED_BYTES + 9)  # does not compress
    large = [("a.zip", make_zip([("in.zip", inner), ("top.eml", MAIL_A), ("bad.zip", bad), ("z.png", noise)])), small[1]]
    limits = UnpackLimits(max_depth=3)
    one, more = run(spark, work, *small, limits=limits), run(spark, work + "-large", *large, limits=limits)
    assert (one.waves, more.waves) == (1, 2)
    assert leaves(one) == leaves(more)
    assert sorted(leaves(one)) == [
        "a.zip!in.zip!low.ZIP!x.eml", "a.zip!in.zip!mail.mbox#0", "a.zip!in.zip!mail.mbox#1", "a.zip!top.eml"
    ]
    assert skips(more).pop("a.zip!z.png") and "a.zip!bad.zip" in skips(one)
    assert skips(one) == {k: v for k, v in skips(more).items() if k != "a.zip!z.png"}
    shallow = run(spark, work + "-shallow", *small, limits=UnpackLimits(max_depth=2))
    assert skips(shallow)["a.zip!in.zip!low.ZIP"][0] == S.DEPTH_LIMIT_EXCEEDED


def test_what_is_opened_in_place_is_bounded(monkeypatch):
    inner = make_zip([("x.eml", MAIL_A)])
    raw = make_zip([(f"{i}.zip", inner) for i in range(5)])
    row = {"source_id": "s", "namespace": "n", "partition": "p", "relpath": "r.zip", "internal_path": "r.zip",
           "container_depth": 0, "pos": []}
    monkeypatch.setattr(archive, "NESTED_BYTES", 3 * len(inner))
    found = [r["internal_path"] for r in archive.nested_rows(row, io.BytesIO(raw), 1 << 20, 8)]
    assert found == [f"r.zip!{i}.zip!x.eml" for i in range(3)] + ["r.zip!3.zip", "r.zip!4.zip"]


def test_rows_go_to_python_in_small_batches(spark):
    text = F.repeat(F.lit("x"), 10_000)
    docs = spark.range(3000, numPartitions=1).select("id", packed_members(("a.eml", text)).alias("m"))
    packed = pack_zip(docs, "m", "raw")
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes], pa.int64())], names=["n"])

    # what pack_zip sets for its own input holds for any bytes of the query
    most = docs.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]
    assert most < 6_000_000
