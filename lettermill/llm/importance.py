"""Importance resampling towards a target distribution, by hashed runs of words.

Separator newlines cut texts into lines. Lines repeat, so the features of each distinct
line are counted once: their counts are multiplied by the line's occurrences, and their
gains are added to every text that holds the line. Runs of words that cross a line break
are counted text by text, and added separately. Every bucket of features has a gain: by
how much it is likelier in the target than in the corpus. A text's weight is the mean of
its gains, and texts are drawn without replacement by weight plus Gumbel noise.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.common import digest16, whole_text
from lettermill.storage import stored

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: A line with more than this share of all occurrences is joined by broadcast: at most so many are.
HOT_LINES = 1000
#: Words remembered by a task between two clearings.
_REMEMBERED = 1 << 18


@dataclass(frozen=True)
class Resampling:
    order: int = 1  # words of a feature, at most
    buckets: int = 10_000
    min_words: int = 20  # of a text that may be drawn
    percent: int = 10  # of the texts that may be drawn
    seed: str = "2024"


class _Buckets(dict):
    """Feature -> bucket, worked out once for each feature."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.n
        return bucket


def line_features(line: bytes, order: int, bucket_of) -> tuple[int, list[int]]:
    """Words of a line, and the buckets of its runs of words."""
    words = _WORD.findall(line.lower())
    out = [bucket_of[w] for w in words]
    for n in range(2, order + 1):
        out += [bucket_of[b" ".join(words[i : i + n])] for i in range(len(words) - n + 1)]
    return len(words), out


def crossing_features(text: bytes, order: int, bucket_of) -> list[int]:
    """Buckets of the runs of words that cross a line break."""
    words, line_of = [], []
    for k, line in enumerate(text.lower().split(b"\n")):
        own = _WORD.findall(line)
        words += own
        line_of += [k] * len(own)
    return [
        bucket_of[b" ".join(words[i : i + n])]
        for n in range(2, order + 1)
        for i in range(len(words) - n + 1)
        if line_of[i] != line_of[i + n - 1]
    ]


def _lists(values: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.fromiter((x for v in values for x in v), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _lines_counted(order: int, buckets: int):
    def run(batches):
        bucket_of = _Buckets(buckets)
        for batch in batches:
            found = [line_features(x.as_py(), order, bucket_of) for x in batch.column("line")]
            yield pa.record_batch(
                [batch.column("segment"), batch.column("times"), pa.array([n for n, _ in found], pa.int64()),
                 _lists([b for _, b in found])],
                names=["segment", "times", "n_words", "buckets"],
            )

    return run


def segments(texts: DataFrame, how: Resampling) -> DataFrame:
    """Distinct lines with a word: segment (digest), times, n_words, buckets. `texts` has `text`."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).filter(_has_word(F.col("line")))
    counted = lines.groupBy("line").agg(F.count("*").alias("times"))
    counted = counted.select(digest16(F.col("line")).alias("segment"), "times", F.col("line").cast("binary").alias("line"))
    return counted.mapInArrow(
        _lines_counted(how.order, how.buckets), "segment binary, times long, n_words long, buckets array<int>"
    )


def _has_word(line: Column) -> Column:
    """Whether a line holds a word."""
    return line.rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def crossings(texts: DataFrame, how: Resampling) -> DataFrame:
    """doc_id, body, times (1), n_words (0) and buckets of what crosses line breaks, row by row."""

    def run(batches):
        bucket_of = _Buckets(how.buckets)
        for batch in batches:
            found = [crossing_features(x.as_py().encode(), how.order, bucket_of) for x in batch.column("text")]
            n = len(found)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("body"), pa.array([1] * n, pa.int64()), pa.array([0] * n, pa.int64()),
                 _lists(found)],
                names=["doc_id", "body", "times", "n_words", "buckets"],
            )

    return texts.select("doc_id", "body", "text").mapInArrow(
        run, "doc_id long, body binary, times long, n_words long, buckets array<int>"
    )


def bucket_counts(frame: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, as `buckets` numbers."""
    out = np.zeros(buckets, np.int64)
    each = frame.select("times", F.explode("buckets").alias("bucket"))
    for row in each.groupBy("bucket").agg(F.sum("times").alias("n")).collect():  # at most `buckets` rows
        out[row.bucket] = row.n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of how much likelier a bucket is in the target, smoothed by one, floored."""
    n, s, t = len(own), float(own.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log((float(b) + 1) * (s + n) / ((float(a) + 1) * (t + n)))) for a, b in zip(own, target, strict=True)],
        np.int64,
    )


def _gained(frame: DataFrame, keys: list[str], gain: np.ndarray) -> DataFrame:
    """n_words, n_features and the sum of the gains in place of the buckets."""

    def run(batches):
        for batch in batches:
            lists = batch.column("buckets")
            ends = lists.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gain[lists.flatten().to_numpy()])])
            at = ends - ends[0]
            yield pa.record_batch(
                [*[batch.column(k) for k in keys], batch.column("n_words"), pa.array(np.diff(at)), pa.array(sums[at[1:]] - sums[at[:-1]])],
                names=[*keys, "n_words", "n_features", "gain"],
            )

    types = {f.name: f.dataType.simpleString() for f in frame.schema}
    ddl = ", ".join(f"{k} {types[k]}" for k in keys)
    return frame.select(*keys, "n_words", "buckets").mapInArrow(run, f"{ddl}, n_words long, n_features long, gain long")


def text_gains(texts: DataFrame, target: DataFrame, how: Resampling) -> DataFrame:
    """doc_id, body (digest of the text), copies, n_words, n_features and gain of all copies together."""
    spark = texts.sparkSession
    lines = stored(segments(texts, how), "importance-lines")
    own = bucket_counts(lines, how.buckets)
    wanted = bucket_counts(segments(target, how), how.buckets)
    crossed = None
    if how.order > 1:
        crossed = stored(crossings(texts, how), "importance-crossings")
        own += bucket_counts(crossed, how.buckets)
        extra = target.select(F.lit(0).cast("long").alias("doc_id"), F.unhex(F.lit("")).alias("body"), "text")
        wanted += bucket_counts(crossings(extra, how), how.buckets)
    gain = gains(own, wanted)
    gained = _gained(lines, ["segment", "times"], gain)
    total = lines.agg(F.sum("times")).first()[0] or 0
    is_hot = F.col("times") * HOT_LINES > total
    names = ["segment", "n_words", "n_features", "gain"]
    hot, cold = gained.filter(is_hot).select(*names), gained.filter(~is_hot).select(*names)
    held = texts.select("doc_id", "body", F.explode(F.split("text", "\n")).alias("line")).filter(_has_word(F.col("line")))
    held = held.select("doc_id", "body", digest16(F.col("line")).alias("segment"))
    hot = stored(hot, "importance-hot")  # fewer than HOT_LINES rows
    sums = ["doc_id", "body", F.lit(0).alias("copies"), "n_words", "n_features", "gain"]
    parts = [
        texts.select("doc_id", "body", F.lit(1).alias("copies"), *[F.lit(0).cast("long").alias(c) for c in names[1:]]),
        held.join(F.broadcast(hot), "segment").select(*sums),
        held.join(F.broadcast(hot.select("segment")), "segment", "left_anti").join(cold, "segment").select(*sums),
    ]
    if crossed is not None:
        parts.append(_gained(crossed, ["doc_id", "body"], gain).select(*sums))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("doc_id", "body").agg(*[F.sum(c).cast("long").alias(c) for c in ("copies", *names[1:])])


def _floor_div(a: str, b: str) -> Column:
    return F.expr(f"({a} - pmod({a}, {b})) div {b}")


def _noise(seed: str) -> Column:
    """Gumbel noise of a document, by a digest of its id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_scores(docs: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """doc_id, n_features, weight, score and rank (from 1; null: not drawn) of every row of `docs`.

    `target` has `text`. A null or empty text has no features, weight 0, and is never drawn if
    `min_words` is above 0. Texts of any length are handled whole, in lines. Ties go to the smaller
    doc_id, null last; rows that repeat doc_id and text are drawn one after the other. A null doc_id
    draws its noise as an empty one. An empty target gives the gains that smoothing alone makes;
    empty `docs` give an empty table; other columns are ignored.
    """
    text = whole_text()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest16(text).alias("body"), text.alias("text"))
    found = text_gains(texts, target.select(whole_text().alias("text")), how)
    found = found.select(
        "doc_id", "body", "copies",
        _floor_div("n_words", "copies").alias("n_words"),
        _floor_div("n_features", "copies").alias("n_features"),
        F.when(F.col("n_features") == 0, F.lit(0)).otherwise(_floor_div("gain", "nullif(n_features, 0)")).cast("long").alias("weight"),
    )
    found = stored(found.withColumn("score", F.col("weight") + _noise(how.seed)), "importance-scores")
    may = F.col("n_words") >= how.min_words
    # Scores are whole numbers within some 150,000: how many are above each is a small table.
    levels = found.filter(may).groupBy("score").agg(F.sum("copies").alias("n"))
    levels = stored(levels, "importance-levels")
    wanted = (levels.agg(F.sum("n")).first()[0] or 0) * how.percent // 100
    above = F.sum("n").over(Window.orderBy(F.col("score").desc())) - F.col("n")
    levels = levels.select("score", above.alias("above")).filter(F.col("above") < wanted)
    marked = found.join(F.broadcast(levels), "score", "left")
    drawn = may & F.col("above").isNotNull()
    # one score holds few texts, since the noise spreads them
    level = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "body")
    ahead = F.sum("copies").over(level.rowsBetween(Window.unboundedPreceding, -1))
    out = ["doc_id", "n_features", "weight", "score"]
    top = marked.filter(drawn).withColumn("ahead", ahead)
    top = top.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("k"))
    rank = F.col("above") + F.coalesce(F.col("ahead"), F.lit(0)) + F.col("k")
    top = top.select(*out, F.when(rank <= wanted, rank).cast("long").alias("rank"))
    rest = marked.filter(~drawn).select(*out, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("rank"))
    return top.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """The rows of `docs` that are drawn, all columns; rows that repeat doc_id and text stand or fall together
    if the first of them is drawn."""
    found = importance_scores(docs, target, how).filter("rank is not null").select(F.col("doc_id").alias("drawn_id")).distinct()
    return docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("drawn_id")), "left_semi")


def op11_importance(spark, sf_dir: str) -> DataFrame:
    return importance_scores(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


OP11_SQL = r"""
WITH remainders AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS r
  FROM (SELECT unnest(range(0, 256)) AS i)
), texts AS (
  SELECT 'd' AS side, doc_id, rowid AS place, coalesce(text, '') AS text FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
  UNION ALL SELECT 'b', NULL, NULL, coalesce(text, '') FROM benchmark
), words AS (
  SELECT side, place, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM texts
), hashed AS (
  SELECT w, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(w))),
                                                    lambda k: ('0x' || substr(hex(encode(w)), 2 * k + 1, 2))::BIGINT)),
    lambda c, b: xor(r[1 + (xor(c, b) & 255)], c >> 8))) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM words), remainders
), counts AS (
  SELECT bucket, count(*) FILTER (side = 'd')::DOUBLE AS s, count(*) FILTER (side = 'b')::DOUBLE AS t
  FROM words JOIN hashed USING (w) GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counts) + 10000)
                                 / ((s + 1) * ((SELECT sum(t) FROM counts) + 10000))))::BIGINT AS gain
  FROM counts
), weights AS (
  SELECT place, count(*)::BIGINT AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM words JOIN hashed USING (w) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY place
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (place) WHERE side = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank FROM ranked
"""
