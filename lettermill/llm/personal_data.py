"""Personal data by patterns and a character-level BiLSTM with CRF transitions.

Four patterns find mail and network addresses, card and phone numbers. A tagger
(`char_tagger`) learns from their spans, on a bounded sample of windows, also with spans
written as the patterns don't know them (a phone number without +, `name (at) host`, `name at host`, other
separators in a card number), and adds what looks and stands like them. It learns from
windows around digits, @ and (at) and at drawn places, and reads every character of a text.

A text is cut into overlapping windows from its start to its end. Each is tagged, and
decoded unless its scores prove it outside throughout. A stretch is a run of windows that
hold something, with one on either side; where neighbours in it disagree on what they share,
the tag scores of all its windows are averaged, less weight toward a window's ends, and the
stretch is decoded once as a whole. What a tagger of characters can't see is then tested:
the check digit of a card, the numbers of digits and parts, and that no letter or digit goes
on beside the span.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.char_tagger import PAD, WINDOW, Reader, Weights, decode, symbols, train, undecided
from lettermill.llm.common import text_batches, whole_text
from lettermill.llm.words import text_blocks
from lettermill.storage import stored

PATTERNS = ("email", "ip", "card", "phone")
KINDS = (*PATTERNS, *(f"field_{k}" for k in PATTERNS))
#: The kind of a drawn window without an anchor; 0 is one around an anchor without a span.
PLAIN = len(PATTERNS) + 1
#: Windows that the tagger learns from: at most so many of each kind, as many around anchors without a span,
#: and as many at drawn places without an anchor.
SAMPLE = 400
#: Characters around an anchor, and how far the windows to learn from lie apart.
MARGIN, STRIDE = 24, 32
#: Characters of a window when texts are read, and those that it shares with the next one.
LONG, SHARED = 256, 32
#: Windows tagged at once: what a step touches fits the processor's cache.
_AT_ONCE = 224
#: Windows kept until they are decoded together.
_WAIT = 1024
#: Bytes of texts read in one go.
_BLOCK_BYTES = 4 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match starts where its run of digits starts: leftmost matches never start inside one. A pattern
# that begins with a set of characters is searched for several times faster than one that looks back first.
_IP = re.compile(r"([0-9](?<![0-9][0-9])[0-9]*+)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@(\[](?:(?<=[0-9@])|(?<=[(\[])at[)\]])")
_NO_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end()))
        free = host.end() if host else at + 1
        at = text.find("@", free)
    return out


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, in code points, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and passes_luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text around its anchors; they don't touch."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def windows(text: str, a: int, b: int) -> list[int]:
    """Where the windows around anchors start; they may reach over the end of their part, and over the text's."""
    return list(range(a, max(a + 1, b - WINDOW + STRIDE), STRIDE))


def cut(text: str, start: int) -> np.ndarray:
    out = np.full(WINDOW, PAD, np.uint8)
    own = symbols(text[start : start + WINDOW])
    out[: len(own)] = own
    return out


def tags_of(spans: list[tuple[int, int, int]], start: int, size: int = WINDOW) -> np.ndarray:
    """Tags of a window; of spans that overlap the first listed counts. A span cut by the
    window's start goes on inside, so its first character there counts as its beginning."""
    out = np.zeros(size, np.uint8)
    for kind, a, b in spans:
        a, b = max(a, start) - start, min(b, start + size) - start
        if a < b and not out[a:b].any():
            out[a:b] = 2 + 2 * kind
            out[a] = 1 + 2 * kind
    return out


def variants(text: str, spans: list[tuple[int, int, int]], start: int):
    """(text, spans) with each span near `start` written in ways that its pattern doesn't know."""
    for kind, a, b in spans:
        if not (start <= a and b <= start + WINDOW):
            continue
        own = text[a:b]
        turn = int.from_bytes(hashlib.md5(own.encode()).digest()[:2], "little")
        if kind == 0:
            forms = [own.replace("@", ("(at)", " (at) ", "[at]")[turn % 3]), own.replace("@", " at ")]
        elif kind == 2:
            digits = _NO_DIGIT.sub("", own)
            forms = [(".", "/", "  ")[turn % 3].join(digits[i : i + 4] for i in range(0, len(digits), 4))]
        elif kind == 3:
            forms = [own[1:]]
        else:
            continue
        left = max(0, start)
        for form in forms:
            changed = text[left:a] + form + text[b : left + WINDOW]
            yield changed, [(kind, a - left, a - left + len(form))]


def _examples(batches):
    for batch in batches:
        rows = set()
        for value in batch.column("text"):
            text = value.as_py()
            parts = stretches(text)
            drawn = int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "little") % max(1, len(text) - WINDOW + 1)
            if text and not _ANCHOR.search(text, drawn, drawn + WINDOW):
                rows.add((PLAIN, cut(text, drawn).tobytes(), bytes(WINDOW)))
            spans = base_spans(text) if parts else []
            for a, b in parts:
                near = [s for s in spans if s[1] < b and s[2] > a]
                for start in windows(text, a, b):
                    x, y = cut(text, start), tags_of(near, start)
                    kind = int(y.max() + 1) // 2
                    rows.add((kind, x.tobytes(), y.tobytes()))
                    for changed, own in variants(text, near, start) if kind else ():
                        rows.add((kind, cut(changed, 0).tobytes(), tags_of(own, 0).tobytes()))
        cols = [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []]
        yield pa.record_batch(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
            names=["kind", "x", "y"],
        )


def samples(docs: DataFrame, sample: int = SAMPLE) -> list:
    """At most `sample` different windows of each kind, and of both sorts without a span, drawn by digest."""
    texts = docs.select(whole_text().alias("text"))
    found = stored(texts.mapInArrow(_examples, "kind int, x binary, y binary"), "pii-windows")
    rows = []
    for kind in range(PLAIN + 1):
        one = found.filter(F.col("kind") == kind).withColumn("draw", F.md5(F.concat("x", "y")))
        rows += one.groupBy("draw", "x", "y").count().orderBy("draw").limit(sample).collect()
    return rows


def fit(docs: DataFrame, sample: int = SAMPLE, steps: int = 250) -> Weights | None:
    """The tagger, from at most 6 x `sample` windows; None if the patterns find nothing."""
    rows = samples(docs, sample)
    if not any(any(r.y) for r in rows):
        return None
    x = np.stack([np.frombuffer(bytes(r.x), np.uint8) for r in rows])
    y = np.stack([np.frombuffer(bytes(r.y), np.uint8) for r in rows])
    return train(x, y, len(PATTERNS), steps, batch=128)


def reconciled(weights: Weights, emit: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Tags of a whole stretch from those of its windows (time x window)."""
    return all_reconciled(weights, [(emit, tags)])[0]


def all_reconciled(weights: Weights, each: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """What `reconciled` gives for each stretch; those of one size are decoded together."""
    out: list = [None] * len(each)
    open_: dict[int, list[tuple[int, np.ndarray]]] = {}
    for k, (emit, tags) in enumerate(each):
        long, n = tags.shape
        step = long - SHARED
        size = step * n + SHARED
        if (tags[step:, :-1] == tags[:SHARED, 1:]).all():
            out[k] = np.empty(size, np.uint8)
            for i in range(n):
                out[k][step * i : step * i + long] = tags[:, i]
            continue
        slope = np.minimum(np.arange(long), np.arange(long)[::-1])[:, None] + 1.0
        total, weight = np.zeros((size, emit.shape[2])), np.zeros((size, 1))
        for i in range(n):
            at = slice(step * i, step * i + long)
            total[at] += emit[:, i] * slope
            weight[at] += slope
        open_.setdefault(size, []).append((k, total / weight))
    for some in open_.values():
        tags = decode(weights, np.stack([mean for _, mean in some], axis=1))
        for i, (k, _) in enumerate(some):
            out[k] = tags[:, i]
    return out


def holds(kind: int, text: str, a: int, b: int) -> bool:
    """Whether text[a:b] can be of its kind at all."""
    if text[max(0, a - 1) : a].isalnum() or text[b : b + 1].isalnum():
        return False
    own = text[a:b]
    if kind == 0:
        return "." in own and ("@" in own or "at" in own)
    digits = _NO_DIGIT.sub("", own)
    if kind == 1:
        parts = [p.lstrip("0") for p in _NO_DIGIT.sub(" ", own).split()]
        return len(parts) == 4 and all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and passes_luhn(digits)
    return 9 <= len(digits) <= 15


def long_windows(text: str) -> np.ndarray:
    """The windows of a whole text (window x time); the last one may reach over its end."""
    step = LONG - SHARED
    n = max(1, -(-(len(text) - SHARED) // step))
    own = np.full(n * step + SHARED, PAD, np.uint8)
    own[: len(text)] = symbols(text)
    return np.lib.stride_tricks.sliding_window_view(own, LONG)[::step]


def _blocks(texts: list[str]):
    """All windows of the texts, _AT_ONCE at a time: text and number of each, and their symbols."""
    held, places, ids = 0, [], []
    for i, text in enumerate(texts):
        rows = long_windows(text) if text else ()
        at = 0
        while at < len(rows):
            some = rows[at : at + _AT_ONCE - held]
            places += [(i, at + k) for k in range(len(some))]
            ids.append(some)
            held, at = held + len(some), at + len(some)
            if held == _AT_ONCE:
                yield places, np.concatenate(ids)
                held, places, ids = 0, [], []
    if held:
        yield places, np.concatenate(ids)


def field_spans(weights: Weights, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) that the tagger finds in each text. Every window of every text is tagged."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    stretch: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # text, number, scores and tags of its windows
    ended: list[list[tuple[int, int, np.ndarray, np.ndarray]]] = []
    waiting: list[tuple[int, int, np.ndarray, bool]] = []  # text, number, scores, whether open to more than outside

    def settle():
        if stretch:
            ended.append(stretch.copy())
            stretch.clear()

    before = None  # the last window that is in no stretch: the next one may take it in
    holding = False  # whether the last window holds something

    def decided():
        """Decodes the waiting windows and puts them into stretches; tells the spans of those that have ended."""
        nonlocal before, holding
        open_ = [emit for *_, emit, more in waiting if more]
        decoded = iter(decode(weights, np.stack(open_, axis=1)).T if open_ else ())
        for owner, number, emit, more in waiting:
            row = (owner, number, emit, next(decoded) if more else np.zeros(LONG, np.uint8))
            last = stretch[-1] if stretch else before
            follows = last is not None and last[0] == row[0] and last[1] + 1 == row[1]
            some = bool(row[3].any())
            # a stretch goes on until two windows in a row hold nothing
            if some:
                if not follows:
                    settle()
                elif not stretch:
                    stretch.append(before)
                stretch.append(row)
            elif follows and stretch and holding:
                stretch.append(row)
            else:
                settle()
            before, holding = row, some
        waiting.clear()
        parts = [tuple(np.stack([row[k] for row in own], axis=1) for k in (2, 3)) for own in ended]
        for own, tags in zip(ended, all_reconciled(weights, parts), strict=True):
            owner, start, *_ = own[0]
            text = texts[owner]
            found = _spans(tags, start * (LONG - SHARED), len(text))
            out[owner].extend(s for s in found if holds(s[0], text, s[1], s[2]))
        ended.clear()

    reader = Reader(weights)
    for places, ids in _blocks(texts):
        emit = reader.scores(ids)
        open_ = undecided(weights, emit)
        # what holds nothing counts beside what may hold something, and at the edge of a block
        near = open_ | np.append(open_[1:], True) | np.insert(open_[:-1], 0, True)
        waiting += [(*places[k], emit[:, k].copy(), bool(open_[k])) for k in np.flatnonzero(near).tolist()]
        if len(waiting) >= _WAIT:
            decided()
    decided()
    settle()
    decided()
    return out


def _spans(tags: np.ndarray, start: int, most: int) -> list[tuple[int, int, int]]:
    out = []
    for i in np.flatnonzero(tags % 2 == 1):
        inside, j = tags[i] + 1, int(i) + 1
        while j < len(tags) and tags[j] == inside:
            j += 1
        out.append((int(tags[i]) // 2, start + int(i), min(start + j, most)))
    return out


def _found(weights: Weights | None):
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            column = batch.column("text")
            for a, b in text_blocks(pc.binary_length(column).to_pylist(), _BLOCK_BYTES):
                texts = column.slice(a, b - a).to_pylist()
                rows = []
                added = field_spans(weights, texts) if weights else [[] for _ in texts]
                for text, own in zip(texts, added, strict=True):
                    base = base_spans(text)
                    more = [
                        (k + len(PATTERNS), s, e) for k, s, e in own if not any(s < y and x < e for _, x, y in base)
                    ]
                    rows.append([{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(base + more)])
                yield pa.record_batch(
                    [batch.column("doc_id").slice(a, b - a), pa.array(rows, kind_type)], names=["doc_id", "spans"]
                )

    return run


def find_personal_data(docs: DataFrame, weights: Weights | None = None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> (code points, end exclusive), ordered by kind and start.

    The kinds email, ip, card and phone are the patterns'; field_email and so on are what the
    tagger adds, and they touch none of those. It is fitted to `docs` if none is given; without any
    match of the patterns there is no tagger. A null or empty text has no spans; a text of any
    length is read whole. Repeated rows give equal rows, and teach once; rows without doc_id keep
    null. An empty table gives an empty table; other columns are ignored.
    """
    text_batches(docs.sparkSession)
    weights = weights or fit(docs, sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(
        _found(weights), "doc_id long, spans array<struct<kind: string, start: bigint, `end`: bigint>>"
    )


def op13_personal_data(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: ~s["kind"].startswith("field_"))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in PATTERNS],
        F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )
