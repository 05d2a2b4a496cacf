"""Quality rules with robust multivariate outliers.

Four statistics of each text, transformed to be near normal, are compared with what is
usual for its language and source: location and scatter are estimated there by the
minimum covariance determinant, and texts too far away by Mahalanobis distance go.

An estimate starts from medians and is concentrated step by step: distances are counted
in narrow bins together with the sums that mean and covariance need, so that one pass
of partial sums gives the nearest three quarters and their new estimate. A task sees a
group as its bins only (at most BINS rows), however many texts the group has.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import packed, text_batches, whole_text
from lettermill.llm.words import split_words, text_blocks, window_hashes
from lettermill.storage import stored

FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: Smaller groups are judged by their language, and by all texts if that is small too.
MIN_GROUP = 200
#: Share of a group that the estimate rests on, and concentration steps.
CORE, STEPS = 0.75, 4
#: Squared distance that rejects: far beyond chance (a chi-square of 4 exceeds it once in 1e9).
CUTOFF = 48.0
#: Words added to each text in the shares of repeated lines and words, so that one line said twice
#: is not much of a short text either.
SMOOTH = 100
#: Least standard deviation per feature, so that a statistic that hardly varies rejects only what
#: differs much. Each stays well below what its statistic can reach over the square root of CUTOFF:
#: any of them can reject alone.
FLOOR = (0.1, 0.6, 0.03, 0.3)
#: Bins: 64 for a factor of two of the distance, and 512 for one unit of a feature.
D_BINS, F_BINS, BINS = 64, 512, 8192


def text_stats(texts: list[bytes]) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    w = split_words(texts)
    n_words = np.diff(w.first)
    in_word = np.zeros(len(w.raw) + 1, np.int8)
    in_word[w.starts], in_word[w.ends] = 1, -1
    inside = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)

    def per_text(mask: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(mask)
        return np.diff(np.searchsorted(at, w.bounds))

    chars = per_text(inside & ((w.raw & 0xC0) != 0x80))
    symbols = per_text(np.isin(w.raw, np.frombuffer(b"#*$%&|<>", np.uint8)))
    lines = [[x for x in t.split(b"\n") if x.strip(BLANKS.encode())] for t in texts]
    dup_lines = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    h, at = window_hashes(w, 3)
    owner = w.owner[at]
    order = np.lexsort((h, owner))
    same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(w.starts), bool)
    for k in range(3):
        covered[at[twice] + k] = True
    repeats = np.diff(np.concatenate([[0], np.cumsum(covered)])[w.first])
    return [n_words, chars, symbols, dup_lines, repeats]


_COUNTS = [s.split()[0] for s in STATS.split(", ")]


def _counted(texts: pa.Array) -> pa.Array:
    """The counts of each text, a struct for each."""
    parts = []
    for a, b in text_blocks(pc.binary_length(texts).to_pylist()):
        own = [t.as_py().encode() for t in texts.slice(a, b - a)]
        parts.append([pa.array(s, pa.int64()) for s in text_stats(own)])
    columns = [pa.concat_arrays([p[i] for p in parts]) if parts else pa.array([], pa.int64()) for i in range(len(_COUNTS))]
    return pa.StructArray.from_arrays(columns, names=_COUNTS)


def measure(docs: DataFrame, carry: bool) -> DataFrame:
    """lang, source, doc_id, the counts, base_failed and the features of each text; row (struct of
    all input columns) too if it is to be carried along. Only texts pass through Python."""
    text_batches(docs.sparkSession)
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    row = [packed(docs)] if carry else []
    counted = F.arrow_udf(_counted, f"struct<{STATS.replace(' long', ': bigint')}>")
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *keys, counted(whole_text()).alias("counts"), *row
    )
    given = given.select("doc_id", "lang", "source", "counts.*", *(["row"] if carry else []))
    words = F.greatest(F.col("n_words"), F.lit(1))
    return given.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
            "symbols": F.log1p(1000 * F.col("n_symbols") / words),
            # in tenths; logarithms would level what repeats a lot with what repeats a little
            "dup_lines": 10 * F.col("n_dup_lines") / (F.col("n_words") + SMOOTH),
            "repeats": 10 * F.col("n_repeat_words") / (F.col("n_words") + SMOOTH),
        }
    )


def _chi2_even(x: float, k: int) -> float:
    """Chi-square distribution function for an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))


def consistency() -> float:
    """What the scatter of the nearest CORE share is to be multiplied by for normal data."""
    p, low, high = len(FEATURES), 0.0, 100.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_even(mid, p) < CORE else (low, mid)
    return CORE / _chi2_even(low, p + 2)


PARAMS = "level int, part string, n long, center array<double>, inverse array<double>"


def _estimate(level, part, n, center: np.ndarray, scatter: np.ndarray) -> pd.DataFrame:
    inverse = np.linalg.inv(scatter + np.diag(np.square(FLOOR)))
    return pd.DataFrame(
        {"level": [level], "part": [part], "n": [int(n)], "center": [center.tolist()],
         "inverse": [inverse.ravel().tolist()]}
    )


def _start(bins: pd.DataFrame) -> pd.DataFrame:
    """Medians and median deviations of a group, from its bins."""
    center, spread = [], []
    for f in range(len(FEATURES)):
        own = bins[bins.feature == f].sort_values("bin")
        x, c = own.bin.to_numpy() / F_BINS, own.n.to_numpy()
        mid = x[np.searchsorted(np.cumsum(c), c.sum() / 2)]
        order = np.argsort(np.abs(x - mid), kind="stable")
        deviation = np.abs(x - mid)[order][np.searchsorted(np.cumsum(c[order]), c.sum() / 2)]
        center.append(mid)
        spread.append(1.4826 * deviation)
    first = bins.iloc[0]
    n = bins[bins.feature == 0].n.sum()
    return _estimate(first.level, first.part, n, np.array(center), np.diag(np.square(spread)))


def _concentrate(bins: pd.DataFrame) -> pd.DataFrame:
    """Mean and covariance of the nearest CORE share of a group, from its bins of distances."""
    p = len(FEATURES)
    bins = bins.sort_values("bin")
    upto = int(np.searchsorted(np.cumsum(bins.n.to_numpy()), CORE * bins.n.sum())) + 1
    core = bins.iloc[:upto]
    n = core.n.sum()
    mean = np.array([core[f"s{i}"].sum() for i in range(p)]) / n
    second = np.array([[core[f"q{min(i, j)}{max(i, j)}"].sum() for j in range(p)] for i in range(p)]) / n
    first = bins.iloc[0]
    return _estimate(first.level, first.part, bins.n.sum(), mean, consistency() * (second - np.outer(mean, mean)))


def _distance() -> Column:
    p = len(FEATURES)
    diff = [F.col(f) - F.col("center")[i] for i, f in enumerate(FEATURES)]
    terms = [diff[i] * diff[j] * F.col("inverse")[i * p + j] for i in range(p) for j in range(p)]
    return sum(terms[1:], terms[0])


def estimates(measured: DataFrame) -> DataFrame:
    """PARAMS of every language and source (level 0), language (1) and of all texts (2)."""
    p = len(FEATURES)
    parts = [F.concat_ws("\x1f", "lang", "source"), F.col("lang"), F.lit("")]
    levels = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), c.alias("part")) for i, c in enumerate(parts)]))
    good = stored(measured.filter(~F.col("base_failed")).select("lang", "source", *FEATURES), "quality-stats")
    rows = good.select(levels.alias("g"), *FEATURES).select("g.*", *FEATURES)
    binned = F.explode(
        F.array(*[F.struct(F.lit(i).alias("feature"), F.round(F.col(f) * F_BINS).cast("int").alias("bin"))
                  for i, f in enumerate(FEATURES)])
    )
    counted = rows.select("level", "part", binned.alias("b")).groupBy("level", "part", "b.feature", "b.bin")
    params = stored(
        counted.agg(F.count(F.lit(1)).alias("n")).groupBy("level", "part").applyInPandas(_start, PARAMS), "quality"
    )
    place = F.least(F.greatest(F.round(F.log2(F.col("d") + 1e-6) * D_BINS), F.lit(-BINS // 2)), F.lit(BINS // 2))
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    sums += [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"q{i}{j}") for i in range(p) for j in range(i, p)]
    for _ in range(STEPS):
        far = rows.join(params.drop("n"), ["level", "part"]).withColumn("d", _distance())
        bins = far.groupBy("level", "part", place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"), *sums)
        params = stored(bins.groupBy("level", "part").applyInPandas(_concentrate, PARAMS), "quality")
    return params


def judge(docs: DataFrame, carry: bool = False, min_group: int = MIN_GROUP) -> DataFrame:
    """Per input row: doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance (squared; null if there is nothing to compare with), kept; and row
    (struct of all input columns) with `carry`.

    A null or empty text has no words and fails the base rule. A null language or source is
    a value of its own. A language and source with fewer than `min_group` texts that pass the base rules
    is judged by its language, and by all texts if that has fewer too. Repeated rows count as often as they occur and are judged alike. A
    group in which a statistic never varies falls back on FLOOR. An empty table gives an
    empty table; other columns are carried only.
    """
    params = estimates(measure(docs, False))
    measured = measure(docs, carry)
    enough = params.filter((F.col("n") >= min_group) | (F.col("level") == 2))

    def of(level: int, name: str) -> DataFrame:
        one = enough.filter(F.col("level") == level)
        return one.select(F.col("part").alias(f"p_{name}"), F.struct("center", "inverse").alias(f"e_{name}"))

    near, wide, all_ = of(0, "near"), of(1, "wide"), of(2, "all")
    joined = (
        measured.withColumn("k", F.concat_ws("\x1f", "lang", "source"))
        .join(near, F.col("k") == F.col("p_near"), "left")
        .join(wide, F.col("lang") == F.col("p_wide"), "left")
        .join(F.broadcast(all_), F.lit("") == F.col("p_all"), "left")  # one row
        .withColumn("e", F.coalesce("e_near", "e_wide", "e_all"))
        .select("*", F.col("e.center").alias("center"), F.col("e.inverse").alias("inverse"))
        .withColumn("distance", _distance())
    )
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= CUTOFF)
    names = ["doc_id", "lang", "source", *(s.split()[0] for s in STATS.split(", ")), "base_failed", "distance"]
    return joined.select(*names, kept.alias("kept"), *(["row"] if carry else []))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance",
    )
