"""Suffix-array dedup: passages that also stand elsewhere are removed, byte by byte.

A passage is any string of PASSAGE bytes. Each of its occurrences holds the same
minimizer (the gram with the least hash), so passages can only repeat where minimizers
do; only those are kept. Passages of a text that share one minimizer form a stretch.
Equal stretches repeat as a whole. Of the others with the same minimizer, one of each
kind is gathered, and suffix order, common prefixes and longest previous factors tell
which of their passages start elsewhere. Minimizers with very many different stretches
are counted passage by passage instead, with partial sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import digest16, text_batches, whole_text
from lettermill.llm.suffixes import previous_factors
from lettermill.llm.words import _M, _M_INVERSE, _powers, mix64
from lettermill.storage import stored

PASSAGE, GRAM = 200, 64
#: Bytes of text in one go; positions must fit 20 bits.
SLICE = 1 << 19
#: Bytes of stretches in one suffix array.
ARRAY = 1 << 19
#: Different stretches of one minimizer in one suffix array, at most.
HOT = 1024


class Hashes:
    """64-bit hashes of any range of a byte string."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_M, max(n, 1))[:n], out=self.sums[1:])
        self.back = _powers(_M_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.back[start] + np.uint64(seed))


def slices(texts: list[bytes], passage: int):
    """Lists of (text number, offset, bytes) of about SLICE bytes; long texts overlap so that every
    passage lies in exactly one slice."""
    out, held = [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(len(t) - passage + 1, 0), SLICE):
            part = t[a : a + SLICE + passage - 1]
            if held and held + len(part) > SLICE:
                yield out
                out, held = [], 0
            out.append((i, a, part))
            held += len(part)
    if out:
        yield out


def stretches(parts: list[tuple[int, int, bytes]], passage: int, gram: int):
    """Runs of passage starts with one minimizer, over concatenated parts: (part, minimizer hash, hash of
    the whole stretch, first start, last start), the starts within the concatenation; and the bytes."""
    raw = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    sizes = np.array([len(p[2]) for p in parts])
    ends = np.cumsum(sizes)
    n, span = len(raw), passage - gram + 1
    h = Hashes(raw)
    at = np.arange(n - gram + 1)
    grams = h.of(at, at + gram)
    least = (grams >> np.uint64(20) << np.uint64(20)) | at.astype(np.uint64)  # ties go to the left
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)  # of the minimizer of each passage
    owner = np.repeat(np.arange(len(parts)), sizes)
    start = np.flatnonzero(np.arange(len(place)) + passage <= ends[owner[: len(place)]])
    turn = np.ones(len(start), bool)
    turn[1:] = (place[start[1:]] != place[start[:-1]]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(turn)
    last = np.append(first[1:], len(start)) - 1
    lo, hi = start[first], start[last]
    return owner[lo], grams[place[lo]], h.of(lo, hi + passage, 1), lo, hi, raw, ends - sizes


def _counted(passage: int, gram: int):
    def run(batches):
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for parts in slices(texts, passage):
                value, n = np.unique(stretches(parts, passage, gram)[1], return_counts=True)
                yield pa.record_batch([pa.array(value.view(np.int64)), pa.array(n, pa.int64())], names=["gram", "n"])

    return run


def _listed(passage: int, gram: int):
    def run(batches):
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for parts in slices(texts, passage):
                part, value, whole, lo, hi, _, at = stretches(parts, passage, gram)
                text = np.array([p[0] for p in parts])[part]
                move = (np.array([p[1] for p in parts]) - at)[part]
                rows = pa.array(text)
                yield pa.record_batch(
                    [batch.column("doc_id").take(rows), batch.column("body").take(rows),
                     pa.array(value.view(np.int64)), pa.array(whole.view(np.int64)),
                     pa.array((lo + move).astype(np.int64)), pa.array((hi + move).astype(np.int64))],
                    names=["doc_id", "body", "gram", "whole", "lo", "hi"],
                )

    return run


def _cut_out(passage: int):
    def run(batches):
        for batch in batches:
            rows = []
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "body", "text", "parts")]
            for doc_id, body, text, parts in zip(*cols, strict=True):
                data = text.encode()
                rows += [(doc_id, body, p["gram"], p["whole"], p["n"], p["lo"], data[p["lo"] : p["hi"] + passage]) for p in parts]
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            out = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["doc_id", "body", "gram", "whole", "n", "lo", "stretch"],
            )

    return run


_SPAN = "doc_id long, body binary, lo long, hi long"


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    out = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "body", "lo", "hi"])


def repeated_starts(strings: list[bytes], passage: int, first_stays: bool) -> list[list[tuple[int, int]]]:
    """For each string, in corpus order, the ranges of starts whose passage also starts elsewhere among
    the strings; earlier only if the first one stays."""
    raw = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64)
    sizes = np.array([len(s) for s in strings])
    at = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.empty(int(sizes.sum()) + len(strings), np.int64)
    symbols[at + sizes] = 256 + np.arange(len(strings))  # a symbol of its own ends each string
    inside = np.ones(len(symbols), bool)
    inside[at + sizes] = False
    symbols[inside] = raw
    factor, source = previous_factors(symbols, passage)
    hit = factor >= passage
    if not first_stays:
        hit |= source
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    marks = np.flatnonzero(hit)
    if len(marks):
        own = np.searchsorted(at, marks, "right") - 1
        cut = np.flatnonzero((np.diff(marks) != 1) | (np.diff(own) != 0)) + 1
        for run in np.split(np.arange(len(marks)), cut):
            i = int(own[run[0]])
            out[i].append((int(marks[run[0]] - at[i]), int(marks[run[-1]] - at[i])))
    return out


def _by_suffixes(passage: int, first_stays: bool):
    """Rows sorted by minimizer; all of one minimizer go into the same suffix array."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[4]))
        found = repeated_starts([r[5] for r in rows], passage, first_stays)
        return _spans([
            (doc_id, body, lo + a, lo + b)
            for (doc_id, body, _, n, lo, _), own in zip(rows, found, strict=True)
            if n == 1 or first_stays
            for a, b in own
        ])

    def run(batches):
        held, group, size = [], [], 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "body", "gram", "n", "lo", "stretch")]
            for row in zip(*cols, strict=True):
                if group and group[-1][2] != row[2]:
                    held += group
                    group = []
                    if size > ARRAY:
                        yield solve(held)
                        held, size = [], 0
                group.append(row)
                size += len(row[5])
        if held or group:
            yield solve(held + group)

    return run


def _each_passage(passage: int):
    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "body", "n", "lo", "stretch")]
            for doc_id, body, n, lo, s in zip(*cols, strict=True):
                h = Hashes(np.frombuffer(s, np.uint8))
                a = np.arange(len(s) - passage + 1)
                one, two = (h.of(a, a + passage, seed).view(np.int64) for seed in (2, 3))
                half = h.of(a, a + passage // 2, 4).view(np.int64)
                yield pa.record_batch(
                    [pa.array([doc_id] * len(a), pa.int64()), pa.array([body] * len(a), pa.binary()),
                     pa.array([n] * len(a), pa.int64()), pa.array(lo + a), pa.array(one), pa.array(two ^ half)],
                    names=["doc_id", "body", "n", "lo", "one", "two"],
                )

    return run


def _merged(spans: list[dict], passage: int) -> list[tuple[int, int]]:
    """Bytes that passages starting in lo..hi cover, as maximal runs."""
    out: list[tuple[int, int]] = []
    for s in sorted(spans, key=lambda s: s["lo"]):
        a, b = s["lo"], s["hi"] + passage
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _removed(passage: int):
    def run(batches):
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data, at, parts = text.encode(), 0, []
                runs = _merged(spans or [], passage)
                for a, b in runs:
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                n_bytes.append(len(data))
                n_spans.append(len(runs))
                kept.append(b"".join(parts))
                n_removed.append(len(data) - len(kept[-1]))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def repeated_passages(texts: DataFrame, passage: int, gram: int, first_stays: bool) -> DataFrame:
    """doc_id, body, text -> doc_id, body, lo, hi: ranges of starts of the passages to remove."""
    counts = texts.select("text").mapInArrow(_counted(passage, gram), "gram long, n long")
    twice = stored(counts.groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram"), "grams")
    listed = texts.mapInArrow(
        _listed(passage, gram), "doc_id long, body binary, gram long, whole long, lo long, hi long"
    )
    found = stored(listed.join(twice, "gram", "left_semi"), "stretches")
    kinds = stored(
        found.groupBy("gram", "whole").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "body", "lo", "hi")).alias("first")
        ),
        "kinds",
    )
    same = found.join(kinds.filter("n > 1"), ["gram", "whole"])
    if first_stays:
        same = same.filter(F.struct("doc_id", "body", "lo", "hi") != F.col("first"))
    spans = same.select("doc_id", "body", "lo", "hi")
    variety = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = (
        kinds.join(variety, "gram")
        .select("gram", "whole", "n", "kinds", "first.*")
        .groupBy(F.col("doc_id").alias("of_id"), F.col("body").alias("of_body"))
        .agg(F.collect_list(F.struct("gram", "whole", "n", "lo", "hi")).alias("parts"))
    )
    cut = (
        texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("body") == F.col("of_body")))
        .select("doc_id", "body", "text", "parts")
        .mapInArrow(_cut_out(passage), "doc_id long, body binary, gram long, whole long, n long, lo long, stretch binary")
    )
    # a repeated row gives its stretches twice
    cut = stored(cut.dropDuplicates(["gram", "whole"]).join(variety, "gram"), "cut")
    few = cut.filter(F.col("kinds") <= HOT).repartition("gram").sortWithinPartitions("gram")
    spans = spans.unionByName(few.drop("whole", "kinds").mapInArrow(_by_suffixes(passage, first_stays), _SPAN))
    many = cut.filter(F.col("kinds") > HOT).select("doc_id", "body", "n", "lo", "stretch")
    each = many.mapInArrow(_each_passage(passage), "doc_id long, body binary, n long, lo long, one long, two long")
    again = (
        each.groupBy("one", "two")
        .agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "body", "lo")).alias("first"))
        .filter("times > 1")
    )
    hot = each.join(again, ["one", "two"])
    hot = hot.filter(F.struct("doc_id", "body", "lo") != F.col("first")) if first_stays else hot.filter("n = 1")
    return spans.unionByName(hot.select("doc_id", "body", "lo", F.col("lo").alias("hi")))


def remove_passages(
    docs: DataFrame, passage: int = PASSAGE, gram: int = GRAM, first_stays: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary: the other bytes).

    Removes each byte covered by a string of `passage` bytes that also starts earlier (order:
    doc_id, then place); with first_stays=False anywhere else, so that no copy stays.

    `passage` is a multiple of 4 from `gram` to 508 (the steps and the reach of the suffix order), else a
    ValueError; texts may have any length. Texts are judged as UTF-8 bytes; matches never cross texts. Null and empty texts have no
    bytes. Rows with equal doc_id and text are copies of each other, but the first of them
    can't be told apart, so first_stays keeps either all or none of a passage in them. Rows
    without doc_id sort first. An empty table gives an empty table; other columns are ignored.
    """
    text_batches(docs.sparkSession)
    if passage % 4 or not gram <= passage <= 508:
        raise ValueError(f"passage must be a multiple of 4 from {gram} to 508, not {passage}")
    text = whole_text()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest16(text).alias("body"), text.alias("text"))
    spans = repeated_passages(texts, passage, gram, first_stays)
    # copies share their spans: distinct ones are as many as one copy has
    own = spans.distinct().groupBy(F.col("doc_id").alias("of_id"), F.col("body").alias("of_body")).agg(
        F.collect_list(F.struct("lo", "hi")).alias("spans")
    )
    joined = texts.join(own, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("body") == F.col("of_body")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _removed(passage), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op4_passage_dedup(spark, sf_dir: str) -> DataFrame:
    removed = remove_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"), first_stays=False)
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
