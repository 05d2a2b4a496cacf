"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of its bytes says so, hence at the same places in
every copy of a passage. Each distinct chunk of a task is encoded once; documents
that share lines are brought into the same task first. What a new chunk holds between
certain word starts is looked up too, and encoded only if no chunk had it before, since
ids never cross a word start. Two neighbouring chunks are
then joined by encoding the text around the cut again, from the last certain word
start of the left one up to the first one of the right one. Where there is none, the
chunks are encoded again as one, until all joins are certain. Ids therefore equal
those of the whole text.
"""

from __future__ import annotations

import hashlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.bpe import Bpe, Runs, blocks, default_path, first_word_start, last_word_start, load
from lettermill.llm.common import text_batches, whole_text

#: Bytes of a chunk: at least, about one cut in so many blanks, at most.
LEAST, ONE_IN, MOST = 512, 512, 8192
#: Bytes of chunks and ids remembered in a task; older ones are encoded again if they return.
MEMO_BYTES = 32 << 20


def cut_places(data: bytes) -> list[int]:
    """Where to cut, ends included: before a blank after a non-blank where the hash of the 16
    bytes before it is small, or at MOST bytes; never inside a character."""
    n = len(data)
    if n <= LEAST:
        return [0, n]
    raw = np.frombuffer(data, np.uint8)
    h, width = raw.astype(np.uint32), 1
    while width < 16:  # the hash of 2w bytes out of two hashes of w
        h = h[:-width] * np.uint32(pow(0x01000193, width, 1 << 32)) + h[width:]
        width *= 2
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    ends = np.flatnonzero((raw[16:] == 32) & (raw[15:-1] != 32) & (h[:-1] % np.uint32(ONE_IN) == 0)) + 16
    out = [0]
    for c in [*ends.tolist(), n]:
        while c - out[-1] > MOST:
            forced = out[-1] + MOST
            while data[forced] & 0xC0 == 0x80:
                forced -= 1
            out.append(forced)
        if LEAST <= c - out[-1] and c <= n - LEAST:
            out.append(c)
    return [*out, n]


@dataclass(slots=True)
class Piece:
    """A run of text with its tokens."""

    text: str
    ids: np.ndarray


class ChunkEncoder:
    def __init__(self, bpe: Bpe):
        self.bpe, self.memo, self.held = bpe, {}, 0
        self.runs = Runs(bpe, lambda e: array("I", e.ids).tobytes())
        self.lengths = np.array([len(b) for b in bpe.token_bytes()], np.int64) if bpe.byte_level else None

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts; of runs between word starts that were seen before, from memory."""
        return [np.frombuffer(b"".join(own), np.uint32) for own in self.runs.of(texts)]

    def _pieces(self, chunks: list[str]) -> list[Piece]:
        """A piece for each chunk; unseen ones are encoded in one call."""
        found = {c: self.memo[c] for c in chunks if c in self.memo}
        new = list(dict.fromkeys(c for c in chunks if c not in found))
        for a, b in blocks(new):
            for c, ids in zip(new[a:b], self._ids(new[a:b]), strict=True):
                p = found[c] = self.memo[c] = Piece(c, ids)
                self.held += 4 * len(c) + p.ids.nbytes + 500
        while self.held > MEMO_BYTES:
            c = next(iter(self.memo))
            p = self.memo.pop(c)
            self.held -= 4 * len(c) + p.ids.nbytes + 500
        return [found[c] for c in chunks]

    def _tokens_before(self, p: Piece, place: int) -> int:
        """Tokens of a piece before a word start."""
        if place > len(p.text) // 2:
            rest, ids = len(p.text[place:].encode()), p.ids[::-1]
        else:
            rest, ids = len(p.text[:place].encode()), p.ids
        few = ids[: rest + 1]  # a token has a byte at least
        n = int(np.searchsorted(np.cumsum(self.lengths[few]), rest, "left")) + 1 if rest else 0
        return len(p.ids) - n if place > len(p.text) // 2 else n

    def _join(self, pairs: list[tuple[Piece, Piece, bool, bool]]) -> list[tuple[int, np.ndarray, int] | None]:
        """For each pair (left, right, left is the first of its text, right is the last): tokens kept
        of the left one, tokens between, first token kept of the right one; None where either
        has no certain word start."""
        spans = []
        for left, right, first, last in pairs:
            a = last_word_start(left.text)
            b = first_word_start(right.text)
            a = 0 if a is None and first else a
            b = len(right.text) if b is None and last else b
            spans.append(None if a is None or b is None else (a, b))
        windows = [
            left.text[s[0] :] + right.text[: s[1]] if s else "" for (left, right, *_), s in zip(pairs, spans, strict=True)
        ]
        out = []
        for (left, right, *_), s, between in zip(pairs, spans, self.bpe.ids(windows), strict=True):
            if s is None:
                out.append(None)
                continue
            stop, start = self._tokens_before(left, s[0]), self._tokens_before(right, s[1])
            out.append((stop, np.array(between, np.uint32), start))
        return out

    def segments(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that hold no special strings."""
        cuts = []
        for t in texts:
            data = t.encode()
            places = cut_places(data)
            cuts.append([data[a:b].decode() for a, b in zip(places, places[1:])])  # noqa: B905
        flat = iter(self._pieces([c for own in cuts for c in own]))
        runs = [[next(flat) for _ in own] for own in cuts]
        joins: list[list] = [[None] * (len(own) - 1) for own in runs]
        waiting = [(r, i) for r, own in enumerate(joins) for i in range(len(own))]
        while waiting:
            got = self._join([(runs[r][i], runs[r][i + 1], i == 0, i + 2 == len(runs[r])) for r, i in waiting])
            for (r, i), found in zip(waiting, got, strict=True):
                joins[r][i] = found
            waiting = []
            for r in range(len(runs)):
                own, links = runs[r], joins[r]
                # what a join leaves of a piece on its left must not end before what it gave away
                bad = {i for i, j in enumerate(links) if j is None}
                bad |= {i for i in range(1, len(links)) if links[i] and links[i - 1] and links[i][0] < links[i - 1][2]}
                if not bad:
                    continue
                merged, left, start = [], [], 0
                for i in range(len(own)):
                    if i not in bad:  # the run of pieces that ends here becomes one
                        merged.append(own[start] if start == i else "".join(p.text for p in own[start : i + 1]))
                        left.append(links[i] if i < len(links) and start == i else None)
                        start = i + 1
                fresh = iter(self._pieces([m for m in merged if isinstance(m, str)]))
                is_new = [isinstance(m, str) for m in merged]
                runs[r] = [next(fresh) if new else m for m, new in zip(merged, is_new, strict=True)]
                joins[r] = left[:-1]
                for i in range(len(joins[r])):
                    if is_new[i] or is_new[i + 1]:
                        joins[r][i] = None
                        waiting.append((r, i))
        out = []
        for own, links in zip(runs, joins, strict=True):
            parts, start = [], 0
            for p, (stop, between, following) in zip(own, links):  # noqa: B905
                parts += [p.ids[start:stop], between]
                start = following
            out.append(np.concatenate([*parts, own[-1].ids[start:]]))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, as the library gives them."""
        if not self.bpe.splits:
            return [np.array(i, np.uint32) for i in self.bpe.ids(texts)]
        plans, segments = [], []
        for t in texts:
            plan, at = [], 0
            for m in self.bpe.special_at.finditer(t) if self.bpe.special_at else ():
                plan += [len(segments), m[0]]
                segments.append(t[at : m.start()])
                at = m.end()
            plan.append(len(segments))
            segments.append(t[at:])
            plans.append(plan)
        ids = self.segments(segments)
        return [
            np.concatenate(
                [ids[p] if isinstance(p, int) else np.array([self.bpe.special[p]], np.uint32) for p in plan]
            )
            for plan in plans
        ]


def _encoded(path: str):
    def run(batches):
        bpe = load(path)
        encoder = ChunkEncoder(bpe)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in blocks(texts):
                ids = encoder.encode(texts[a:b])
                yield a, b, batch, ids, bpe

    return run


def _as_ids(path: str):
    def run(batches):
        for a, b, batch, ids, bpe in _encoded(path)(batches):
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                    pa.array([bpe.decode(i.tolist()) for i in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return run


def _as_digests(path: str):
    def run(batches):
        digits: list[str] = []
        for a, b, batch, ids, bpe in _encoded(path)(batches):
            digits = digits or [str(i) for i in range(len(bpe.token_bytes()))]
            lists = [i.tolist() for i in ids]
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array([len(i) for i in lists], pa.int64()),
                    pa.array([hashlib.sha256(",".join([digits[x] for x in i]).encode()).hexdigest() for i in lists]),
                    pa.array([hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in lists]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def encode_documents(docs: DataFrame, path: str | None = None, digests: bool = False) -> DataFrame:
    """Encode every whole text and decode it again: doc_id, n_tokens, ids array<int>, decoded;
    with `digests` ids_sha256 (of the decimal ids, joined by commas) and decoded_sha256 instead.

    A null or empty text has no tokens and decodes to the empty text. A repeated row gives
    equal rows; rows without doc_id keep null. An empty table gives an empty table; other
    columns are ignored. Texts of any length: chunks bound what is encoded at once, unless
    the text has no certain word boundary at all.
    """
    text_batches(docs.sparkSession)
    path = path or default_path()
    # Documents that share lines meet in a task; Spark splits a partition that gets too large.
    near = F.array_min(F.transform(F.split("text", "\n"), lambda line: F.xxhash64(line)))
    gathered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .withColumn("near", near)
        .hint("rebalance", "near")
        .select("doc_id", "text")
    )
    if digests:
        return gathered.mapInArrow(
            _as_digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        )
    return gathered.mapInArrow(_as_ids(path), "doc_id long, n_tokens long, ids array<int>, decoded string")


def op3_bpe_codec(spark, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), digests=True)
