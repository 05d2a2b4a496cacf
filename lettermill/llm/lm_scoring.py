"""Scoring by cross-entropy difference.

Two models of words and word pairs, one of target texts and one of all others, are counted
over every text. Texts are taken in groups of some MB. A group cuts the sorted list of the
64-bit hashes of its words and pairs into ranges and sends each with its counts to the task
that has this range of all groups. It answers in the same order with the sums over all
texts, zero for what one text alone has: nothing is left of that once the text's own words
are taken out. The larger corpus is scaled to the smaller one. A text's score is the mean
over its words of what a word costs under the target model less what it costs under the
other; its own words are taken out of the counts first, so that no text vouches for itself.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import text_batches, whole_text
from lettermill.llm.words import mix64, split_words, text_blocks
from lettermill.storage import size_of, stored

#: Weight of pairs against single words, and what is added to each word's count.
PAIR_WEIGHT, ADDED = 0.6, 0.5
#: Bytes of text that share one list of words and pairs (a longer text has a list of its own), and bytes of all
#: texts for each range of hashes.
GROUP_BYTES, RANGE_BYTES = 12 << 20, 4 << 20
#: Target ids up to so many bytes on disk go to every task; beyond it they meet the texts in a merge join.
IDS_BYTES = 64 << 20

#: The texts of a group, compressed as one piece; `sizes` are their bytes.
_GROUP = "block long, n_bytes long, doc_ids array<long>, targets array<boolean>, sizes array<long>, texts binary"
_SENT = "part long, block long, words binary, pairs binary"
#: The sums in the order sent, and of one row per range its distinct words and their counts in both models.
_ANSWERED = "block long, part long, words binary, pairs binary, distinct long, words_0 long, words_1 long"
_SCORES = "doc_id long, n_words long, loss_target double, loss_other double"


def _planes(*columns: np.ndarray) -> bytes:
    """Columns of numbers as bytes of equal weight side by side, which compress well where numbers are small."""
    raw = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(1).compress(b"".join(raw))


def _columns(data: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(sum(sizes), -1)
    ends = np.cumsum(sizes)
    return [np.ascontiguousarray(raw[e - n : e].T).view(k)[:, 0] for k, n, e in zip(kinds, sizes, ends, strict=True)]


def _group_row(block: int, ids: list, targets: list, texts: list[bytes]) -> pa.RecordBatch:
    sizes, press = [len(t) for t in texts], zstandard.ZstdCompressor(3)
    values = block, sum(sizes), ids, targets, sizes, press.compress(b"".join(texts))
    kinds = pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()
    return pa.record_batch(
        [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
        names=["block", "n_bytes", "doc_ids", "targets", "sizes", "texts"],
    )


def _grouped(batches, group_bytes: int):
    block, held, ids, targets, texts = TaskContext.get().partitionId() << 32, 0, [], [], []
    for batch in batches:
        for i, target, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "target", "text")], strict=True):
            raw = text.encode()
            if texts and (held + len(raw) > group_bytes or len(texts) >= group_bytes >> 3):
                yield _group_row(block, ids, targets, texts)
                block, held, ids, targets, texts = block + 1, 0, [], [], []
            ids.append(i)
            targets.append(target)
            texts.append(raw)
            held += len(raw)
    if texts:
        yield _group_row(block, ids, targets, texts)


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together (the last one leads), and where each run of equal ones starts in it."""
    order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(new)


class _Text:
    """Words and pairs of some texts as hashes, one entry for each word. A pair is that of a word with the one before."""

    __slots__ = ("first", "hashes", "n_words", "own_pair", "own_word", "owner", "pair", "targets")

    def __init__(self, texts: list[bytes], targets: np.ndarray):
        w = split_words(texts, lower=True)
        self.hashes, self.owner, self.n_words, self.targets = w.hashes, w.owner, np.diff(w.first), targets
        self.first = np.ones(len(w.owner), bool)
        self.first[1:] = w.owner[1:] != w.owner[:-1]
        self.pair = mix64(np.roll(w.hashes, 1) * np.uint64(0xD6E8FEB86659FD93) + w.hashes)
        self.own_word, self.own_pair = None, None

    def distinct(self, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, count and target flag of each distinct word (0) or pair (1) of each text; how often its own text
        has the word or pair of each entry is kept."""
        at = np.flatnonzero(~self.first) if kind else np.arange(len(self.owner))
        value, owner = (self.pair if kind else self.hashes)[at], self.owner[at]
        order, runs = _runs(value, owner)
        sizes = np.diff(np.append(runs, len(order)))
        own = np.zeros(len(self.owner), np.int32)
        own[at[order]] = np.repeat(sizes, sizes)
        if kind:
            self.own_pair = own
        else:
            self.own_word = own
        return value[order[runs]], sizes, self.targets[owner[order[runs]]]


def _read_group(row: dict) -> tuple[list[_Text], list[tuple[np.ndarray, ...]]]:
    """The texts of a group in portions, and of its words and then its pairs: sorted distinct hashes, counts in other
    texts and in targets, and whether more than one text has it."""
    raw, sizes, targets = zstandard.ZstdDecompressor().decompress(row["texts"]) if row["n_bytes"] else b"", row["sizes"], row["targets"]
    ends, portions, found = np.cumsum(sizes).tolist(), [], ([], [])
    for a, b in text_blocks(sizes):
        portion = _Text([raw[e - n : e] for n, e in zip(sizes[a:b], ends[a:b], strict=True)], np.array(targets[a:b], bool))
        portions.append(portion)
        for kind in (0, 1):
            found[kind].append(portion.distinct(kind))
    return portions, [_summed(*[np.concatenate(c) for c in zip(*f, strict=True)]) for f in found]


def _summed(gram: np.ndarray, n: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, ...]:
    order, at = _runs(gram)
    if not len(order):
        return gram, *[np.zeros(0, np.uint32)] * 2, np.zeros(0, bool)
    n, target = n[order], target[order]
    counts = [np.add.reduceat(np.where(target == bool(m), n, 0), at).astype(np.uint32) for m in (0, 1)]
    return gram[order[at]], *counts, np.diff(np.append(at, len(order))) > 1


def _bounds(gram: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2**bits ranges starts in the sorted hashes; one more at the end."""
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(gram, starts), len(gram))


def _sent(batches, bits: int):
    for batch in batches:
        for row in batch.to_pylist():
            lists = _read_group(row)[1]
            bounds = [_bounds(g[0], bits) for g in lists]
            rows = []
            for part in np.flatnonzero(np.diff(bounds[0]) + np.diff(bounds[1])).tolist():
                data = []
                for (gram, *rest), at in zip(lists, bounds, strict=True):
                    a, b = at[part], at[part + 1]
                    data.append(_planes(np.diff(gram[a:b], prepend=np.uint64(0)), *[r[a:b] for r in rest]))
                rows.append((part, row["block"], *data))
            for i in range(0, len(rows), 1000):
                columns = zip(*rows[i : i + 1000], strict=True)
                kinds = pa.int64(), pa.int64(), pa.binary(), pa.binary()
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "block", "words", "pairs"])


def _answered(table: pa.Table) -> pa.Table:
    """Sums of one range over all groups, for each group in the order it sent."""
    answers, facts = [], []
    for name in ("words", "pairs"):
        sent = [_columns(d.as_py(), "u8", "u4", "u4", "?") for d in table[name]]
        sizes = [len(s[0]) for s in sent]
        gram = np.concatenate([np.cumsum(s[0], dtype=np.uint64) for s in sent])
        n_0, n_1, many = (np.concatenate([s[i] for s in sent]) for i in (1, 2, 3))
        order, at = _runs(gram)
        sums = [np.zeros(0, np.int64)] * 2
        if len(order):
            runs = np.diff(np.append(at, len(order)))
            shared = np.logical_or.reduceat(many[order], at) | (runs > 1)
            sums = [np.add.reduceat(n[order].astype(np.int64), at) for n in (n_0, n_1)]
        facts.append([len(at), *[int(s.sum()) for s in sums]])
        back = []
        for s in sums:
            out = np.zeros(len(order), np.int64)
            if len(order):
                out[order] = np.repeat(np.where(shared, s, 0), runs)
            back.append(np.split(out, np.cumsum(sizes)[:-1]))
        answers.append(pa.array([_planes(a, b) for a, b in zip(*back, strict=True)], pa.binary()))
    once = [pa.array([f, *[0] * (len(table) - 1)], pa.int64()) for f in facts[0]]
    return pa.table([table["block"], table["part"], *answers, *once], names=[c.split()[0] for c in _ANSWERED.split(", ")])


def _losses(t: _Text, lists: list, sums: list, totals: list[int], distinct: int) -> list[np.ndarray]:
    """What the words of each text cost under the other texts' model and under the target model."""
    out, mine = [], t.targets[t.owner]
    word_at, pair_at = np.searchsorted(lists[0][0], t.hashes), np.searchsorted(lists[1][0], np.where(t.first, 0, t.pair))
    last = np.zeros(len(t.n_words), np.uint64)  # the last word of each text has no successor
    last[t.owner] = t.hashes
    follows = np.roll(t.own_word - (t.hashes == last[t.owner]), 1)
    for model in (0, 1):
        own = (mine == bool(model)).astype(np.int64)
        # what one text alone has is answered with zero: nothing is left of it in either model
        known = sums[0][model][word_at]
        word = np.maximum(known - own * t.own_word, 0)
        held = np.where(t.first, 0, np.maximum(np.roll(known, 1) - own * follows, 0))
        chained = held > 0
        scale = min(totals) / totals[model]
        single = (scale * word + ADDED) / (scale * (totals[model] - own * t.n_words[t.owner]) + ADDED * distinct)
        # the word before counts as often as it occurs, to within one per text of its successors
        both = np.maximum(sums[1][model][pair_at[chained]] - (own * t.own_pair)[chained], 0)
        chance = single.copy()
        chance[chained] = PAIR_WEIGHT * np.minimum(both, held[chained]) / held[chained] + (1 - PAIR_WEIGHT) * single[chained]
        out.append(np.bincount(t.owner, -np.log(chance), len(t.n_words)))
    return out


def _scored(group: pa.Table, answers: pa.Table, totals: list[int], distinct: int) -> pa.Table:
    (row,) = group.to_pylist()
    portions, lists = _read_group(row)
    answers = answers.sort_by("part")
    sums = []
    for name, (gram, *_) in zip(("words", "pairs"), lists, strict=True):
        parts = [_columns(d.as_py(), "i8", "i8") for d in answers[name]]
        sums.append([np.concatenate([np.zeros(0, np.int64), *[p[m] for p in parts]]) for m in (0, 1)])
        if len(sums[-1][0]) != len(gram):
            raise ValueError(f"{len(gram)} {name} sent and {len(sums[-1][0])} answered")
    n_words, costs = np.concatenate([t.n_words for t in portions]), [np.zeros(len(row["sizes"]))] * 2
    if min(totals):
        costs = [np.concatenate(c) for c in zip(*[_losses(t, lists, sums, totals, distinct) for t in portions], strict=True)]
    none = (n_words == 0) | (not min(totals))
    means = [pa.array(c / np.maximum(n_words, 1), pa.float64(), mask=none) for c in reversed(costs)]
    columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(n_words, pa.int64()), *means]
    return pa.table(columns, names=["doc_id", "n_words", "loss_target", "loss_other"])


def score_documents(docs: DataFrame, target_ids: DataFrame, group_bytes: int = GROUP_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_words, loss_target, loss_other, score (their difference: lower is more like the
    texts whose doc_id is in `target_ids`).

    A text without words, or null, has null losses. Without target texts, or with nothing
    else, all scores are null. Repeated rows count as often as they occur; repeated ids in
    `target_ids` count once; a row without doc_id is no target. An empty table gives an empty
    table; other columns are ignored. A text of any length is read whole, by one task. Texts
    are grouped up to `group_bytes` and hashes cut into a range per `range_bytes` of all
    texts; both change the cost and not the scores.
    """
    spark = docs.sparkSession
    text_batches(spark)
    ids = target_ids.select(F.col("doc_id").cast("long").alias("target_id")).filter("target_id is not null").distinct()
    ids = stored(ids, "lm-targets")
    files = ids.inputFiles()
    few = not files or size_of(spark, files[0].rsplit("/", 1)[0]) <= IDS_BYTES
    flagged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .join(ids.hint("broadcast" if few else "merge"), F.col("doc_id") == F.col("target_id"), "left")
        .select("doc_id", "text", F.col("target_id").isNotNull().alias("target"))
    )
    # groups are named as they are written: rows may repeat a doc_id or lack it
    groups = stored(flagged.mapInArrow(partial(_grouped, group_bytes=group_bytes), _GROUP), "lm-texts")
    size = groups.agg(F.sum("n_bytes")).first()[0] or 0
    bits = max(size // range_bytes, 1).bit_length() - 1
    sent = groups.mapInArrow(partial(_sent, bits=bits), _SENT)
    answers = stored(sent.groupBy("part").applyInArrow(_answered, _ANSWERED), "lm-sums")
    found = answers.agg(*[F.sum(c) for c in ("words_0", "words_1", "distinct")]).first()
    totals, distinct = [found[0] or 0, found[1] or 0], found[2] or 0
    replies = answers.select("block", "part", "words", "pairs")
    scored = partial(_scored, totals=totals, distinct=distinct)
    each = groups.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(lambda group, sums: scored(group, sums), _SCORES)
    return each.withColumn("score", F.col("loss_target") - F.col("loss_other"))


def op5_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 AND toxic = 0")
    return score_documents(docs, good)
