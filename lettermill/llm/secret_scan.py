"""Secret scans with a linear-chain conditional random field.

Three patterns find secrets of known form. A field over the tokens of a text adds those
of like look and setting: each token is the beginning of a secret, inside one, or
outside, by its shape, what stands around it and what kind of file it is in. It learns
from the spans of the patterns, on a bounded sample of windows. Every token of a text is
scored, and the whole chain is decoded exactly: where scores alone prove a token outside,
the chain falls into parts that Viterbi decodes one by one.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import text_batches, whole_text
from lettermill.llm.words import text_blocks
from lettermill.storage import stored

KINDS = ("assign", "access", "hex", "field")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = re.compile(
    "(" + "|".join(map(_any_case, ["password", "passwd", "secret", "token"])) + f"|{_any_case('api')}_?{_any_case('key')})"
    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
MIN_CHARS, LONG_CHARS = 6, 20
#: Windows that the field learns from: so many with a secret, and so many without.
SAMPLE = 3000
#: Tokens of a window that it learns from.
RUN_TOKENS = 8
TAGS = 3  # outside, begin, inside
_TOKEN = np.zeros(256, bool)
_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True
#: Different tokens whose own features a task remembers at once.
KNOWN = 200_000
_CUES = (b"pass", b"pwd", b"secret", b"token", b"key", b"auth", b"credential", b"bearer")
_KNOWN_START = re.compile(rb"(?:sk|pk|ghp|gho|xox[a-z]|AIza|eyJ)")
_BEFORE = re.compile(rb"(?i)(pass|pwd|secret|token|key|auth|credential|bearer)\w*[\"']?[^\S\n]*(?:[:=]|is)?[^\S\n]*[\"']?$")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) of the patterns, in code points."""
    out = []
    data = text.encode().lower()
    if any(w in data for w in _WORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(out)


def may_match(data: bytes, long: bool) -> bool:
    """Whether a pattern can match at all in a text; `long`: it has a token long enough for a hex secret."""
    if long or b"AKIA" in data:
        return True
    lower = data.lower()
    return any(w in lower for w in _WORDS)


@dataclass(slots=True)
class Runs:
    """All tokens of a text, in order, and their features (token x feature)."""

    spans: np.ndarray  # token x (start, end), in code points
    features: np.ndarray
    likely: np.ndarray  # tokens of a length and look that secrets often have; a draw looks at it, no verdict


def runs_of(texts: list[bytes], known: dict[bytes, bytes] | None = None) -> tuple[list[Runs | None], np.ndarray]:
    """Tokens of each text (None: it has none), and whether it holds one long enough for a hex secret.
    `known` remembers what tokens say by themselves."""
    block = b"\n".join([*texts, b""])
    raw = np.frombuffer(block, np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _TOKEN[raw]
    turns = np.diff(inside)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    digits = np.concatenate([[0], np.cumsum((raw >= 48) & (raw <= 57))])
    sizes = ends - starts
    may = ((sizes >= MIN_CHARS) & (digits[ends] > digits[starts])) | (sizes >= LONG_CHARS)
    first = np.searchsorted(starts, bounds)
    features = _features(block, raw, starts, ends, {} if known is None else known)
    out: list[Runs | None] = [None] * len(texts)
    long = np.zeros(len(texts), bool)
    for d, data in enumerate(texts):
        own = slice(int(first[d]), int(first[d + 1]))
        if own.start == own.stop:
            continue
        long[d] = sizes[own].max() >= 24
        s, e = starts[own] - bounds[d], ends[own] - bounds[d]
        if not data.isascii():
            places = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
            s, e = places[s], places[e - 1] + 1
        features[own, -3:] = _file_features(data, int(may[own].sum()))
        out[d] = Runs(np.stack([s, e], axis=1), features[own], may[own])
    return out, long


def _file_features(data: bytes, tokens: int) -> list[bool]:
    head = len(data) + 1
    marks = sum(data.count(c) for c in (b"{", b"}", b";", b"=", b"<", b">")) * 50 > head
    return [tokens > 3, marks, data.count(b"\n") * 60 > head]


def _own_features(token: bytes) -> bytes:
    n, lowered = len(token), token.lower()
    digits = n - len(token.translate(None, b"0123456789"))
    upper, lower = lowered != token, token.upper() != token
    vowels = n - len(lowered.translate(None, b"aeiou"))
    return bytes([
        True, n < 12, 12 <= n < 20, 20 <= n < 32, n >= 32,
        digits == 0, digits == n, 0 < digits < 0.15 * n, digits >= 0.3 * n,
        upper and lower and digits > 0, upper and not lower, lower and not upper,
        not token.translate(None, b"0123456789abcdef"), b"/" in token, b"+" in token, b"_" in token, b"-" in token,
        vowels < 0.2 * n, vowels > 0.35 * n, len(set(token)) > 0.5 * n,
        token.startswith(b"AKIA"), bool(_KNOWN_START.match(token)), n < MIN_CHARS,
    ])


def _features(block: bytes, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: dict[bytes, bytes]) -> np.ndarray:
    """What tokens say by themselves, what stands around them, and three columns for their file."""
    tokens = [block[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    own = list(map(known.get, tokens))
    for i in [i for i, f in enumerate(own) if f is None]:
        t = tokens[i]
        own[i] = f = known.get(t) or _own_features(t)
        if len(known) < KNOWN and len(t) <= LONG_CHARS:
            known[t] = f
    one = np.frombuffer(b"".join(own), np.uint8).reshape(len(starts), -1 if len(starts) else 0)
    # texts are parted by a line feed, which is none of the signs looked for
    solid = np.maximum.accumulate(np.where(raw != 32, np.arange(len(raw)), -1))
    at = np.where(starts > 0, solid[starts - 1], -1) if len(starts) else starts
    last = np.where((at >= 0) & (starts - at <= 32), raw[at], 0) if len(starts) else starts
    after = raw[ends]
    quote = lambda c: (c == 34) | (c == 39)
    lower = block.lower()
    cues = []
    for word in _CUES:
        i = lower.find(word)
        while i >= 0:
            cues.append(i)
            i = lower.find(word, i + 1)
    cues = np.sort(np.array(cues, np.int64))
    told = np.searchsorted(cues, starts) > np.searchsorted(cues, starts - 32)
    for i in np.flatnonzero(told):
        s = int(starts[i])
        told[i] = _BEFORE.search(block[max(0, s - 32) : s]) is not None
    around = [(last == 58) | (last == 61), quote(last), quote(after), last == 47, told, (last == 64) | (after == 64)]
    file = np.zeros((len(starts), 3), np.uint8)
    return np.concatenate([one, np.stack(around, axis=1).astype(np.uint8), file], axis=1)


def tags_of(run, secrets: list[tuple[int, int]]) -> list[int]:
    """Tags that known secrets (start, end), by start, give to tokens in order."""
    out, before, at = [], None, 0
    if not secrets:
        return [0] * len(run)
    for s, e in np.asarray(run).tolist():
        while at < len(secrets) and secrets[at][1] <= s:
            at += 1
        hit = at if at < len(secrets) and secrets[at][0] < e else None
        out.append(0 if hit is None else 2 if hit == before else 1)
        before = hit
    return out


@dataclass
class Field:
    emit: np.ndarray  # feature x tag
    move: np.ndarray  # tag x tag; outside stands before and after every run

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x.astype(float) @ self.emit

    def open_parts(self, scores: np.ndarray) -> list[tuple[int, int]]:
        """Parts of a chain outside of which every token is outside in all best taggings.

        Such a token can be taken outside whatever its neighbours are, at a gain: the loss by the
        moves around it is at most a constant, and an inside after it, which then has to be a
        beginning, loses no more than it does beside any tag that follows. As outside also stands
        before and after a chain, what is best for the parts is best for the whole.
        """
        m = self.move
        lead = scores[:, 0, None] - scores[:, 1:]  # outside over begin, inside
        # what the next token loses as a beginning instead of an inside, by the tag after it
        turn = np.append(scores[1:, 1] - scores[1:, 2], 0.0) + (m[1] - m[2]).min()
        # by tag before: out of it, into what follows
        gain = np.full(len(scores), np.inf)
        for before in range(TAGS):
            for own in (1, 2):
                step = m[before, 0] - m[before, own]
                ends = min(m[0, 0] - m[own, 0], m[0, 1] - m[own, 1])
                goes_on = m[0, 1] - m[own, 2] + turn
                gain = np.minimum(gain, lead[:, own - 1] + step + np.minimum(ends, goes_on))
        open_ = np.concatenate([[0], (gain <= 1e-6).astype(np.int8), [0]])
        edges = np.diff(open_)
        return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))

    def decode(self, x: np.ndarray) -> list[int]:
        """The best tags of a chain, by Viterbi; ties go to the lower tag."""
        scores = self.scores(x)
        out = [0] * len(x)
        for a, b in self.open_parts(scores):
            out[a:b] = self._best(scores[a:b])
        return out

    def _best(self, scores: np.ndarray) -> list[int]:
        back: list[np.ndarray] = []
        best = self.move[0] + scores[0]
        for row in scores[1:]:
            through = best[:, None] + self.move
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + row
        tag = int((best + self.move[:, 0]).argmax())
        out = [tag]
        for b in reversed(back):
            tag = int(b[tag])
            out.append(tag)
        return out[::-1]


def train(runs: list[np.ndarray], tags: list[list[int]], steps: int = 300, decay: float = 1e-3) -> Field:
    """Penalised maximum likelihood by gradient steps (Adam) over all runs at once."""
    n, f, longest = len(runs), runs[0].shape[1], max(map(len, runs))
    x, y = np.zeros((n, longest, f)), np.zeros((n, longest), int)
    mask = np.zeros((n, longest), bool)
    for i, (r, t) in enumerate(zip(runs, tags, strict=True)):
        x[i, : len(r)], y[i, : len(t)], mask[i, : len(r)] = r, t, True
    forbidden = np.zeros((TAGS, TAGS))
    forbidden[0, 2] = -1e4  # inside needs a beginning
    emit, move = np.zeros((f, TAGS)), np.zeros((TAGS, TAGS))
    one = np.eye(TAGS)
    seen_emit = np.einsum("ntf,nty->fy", x, one[y] * mask[..., None])
    before = np.concatenate([np.zeros((n, 1), int), y[:, :-1]], axis=1)
    seen_move = np.einsum("nti,ntj->ij", one[before] * mask[..., None], one[y])
    ends = mask.sum(axis=1) - 1
    seen_move[:, 0] += one[y[np.arange(n), ends]].sum(axis=0)
    state = [np.zeros_like(a) for a in (emit, emit, move, move)]
    for step in range(1, steps + 1):
        m = move + forbidden
        s = x @ emit
        low = np.full((n, longest + 1, TAGS), -1e9)
        low[:, 0, 0] = 0.0
        for t in range(longest):  # forward
            z = low[:, t, :, None] + m
            top = z.max(axis=1)
            new = top + np.log(np.exp(z - top[:, None]).sum(axis=1)) + s[:, t]
            low[:, t + 1] = np.where(mask[:, t, None], new, low[:, t])
        high = np.zeros((n, longest + 1, TAGS))
        high[:, longest] = m[:, 0]
        for t in range(longest - 1, 0, -1):  # backward
            z = m[None] + (s[:, t] + high[:, t + 1])[:, None]
            top = z.max(axis=2)
            new = top + np.log(np.exp(z - top[..., None]).sum(axis=2))
            high[:, t] = np.where(mask[:, t, None], new, m[:, 0])
        last = low[:, longest] + m[:, 0]
        top = last.max(axis=1)
        total = top + np.log(np.exp(last - top[:, None]).sum(axis=1))
        want_emit, want_move = np.zeros_like(emit), np.zeros_like(move)
        for t in range(longest):
            here = mask[:, t]
            p = np.exp(low[here, t + 1] + high[here, t + 1] - total[here, None])
            want_emit += x[here, t].T @ p
            z = low[here, t, :, None] + m + (s[here, t] + high[here, t + 1])[:, None]
            want_move += np.exp(z - total[here, None, None]).sum(axis=0)
        want_move[:, 0] += np.exp(last - total[:, None]).sum(axis=0)
        for a, seen, want, i in ((emit, seen_emit, want_emit, 0), (move, seen_move, want_move, 2)):
            g = (seen - want) / n - decay * a
            state[i] = 0.9 * state[i] + 0.1 * g
            state[i + 1] = 0.999 * state[i + 1] + 0.001 * g * g
            a += 0.1 * (state[i] / (1 - 0.9**step)) / (np.sqrt(state[i + 1] / (1 - 0.999**step)) + 1e-8)
    return Field(emit, move + forbidden)


def _secrets(text: str) -> list[tuple[int, int]]:
    return sorted({(own, end) for _, _, end, own in base_spans(text)})


def _examples(batches):
    known: dict[bytes, bytes] = {}
    for batch in batches:
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        rows = []
        for a, b in text_blocks([len(t) for t in texts]):
            for data, runs, long in zip(texts[a:b], *runs_of(texts[a:b], known), strict=True):
                if runs is None:
                    continue
                secrets = _secrets(data.decode()) if may_match(data, long) else []
                tags = np.array(tags_of(runs.spans, secrets), np.uint8)
                # a window around each first token of a secret, of a likely token without one, and at a drawn place
                digest = hashlib.md5(data).digest()
                n = len(tags)
                begins, near = np.flatnonzero(tags == 1), np.flatnonzero(runs.likely & (tags == 0))
                chosen = {}
                for at in [*begins.tolist(), *near.tolist(), int.from_bytes(digest[:4], "little") % n]:
                    # a window starts beside a token that is outside, or at one that begins
                    own = slice(max(0, at - RUN_TOKENS // 2), at + RUN_TOKENS // 2)
                    if tags[own.start] != 2:
                        chosen.setdefault(own.start // (RUN_TOKENS // 2), own)
                for own in chosen.values():
                    kind = bool(tags[own].any())
                    draw = hashlib.md5(digest + own.start.to_bytes(8, "little")).digest()
                    rows.append((draw[:8], kind, runs.features[own].tobytes(), tags[own].tobytes()))
        cols = [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], [], []]
        yield pa.record_batch(
            [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.bool_()), pa.array(cols[2], pa.binary()),
             pa.array(cols[3], pa.binary())],
            names=["draw", "secret", "x", "y"],
        )


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """The field, from at most 2 x `sample` runs drawn by hash; None if the patterns find no secret."""
    texts = docs.select(whole_text().alias("text"))
    runs = stored(texts.mapInArrow(_examples, "draw binary, secret boolean, x binary, y binary"), "secret-runs")
    rows = []
    for kind in (True, False):
        one = runs.filter(F.col("secret") == kind)
        rows += one.groupBy("draw", "x", "y").count().orderBy("draw", "x", "y").limit(sample).collect()
    if not any(any(r.y) for r in rows):
        return None
    x = [np.frombuffer(bytes(r.x), np.uint8).reshape(len(r.y), -1) for r in rows]
    return train(x, [list(bytes(r.y)) for r in rows])


def spans_of(text: str, runs: Runs | None, field: Field | None, base: list) -> list[tuple[int, int, int]]:
    """All spans (start, kind, end): the base ones, and those of the field that touch none of them."""
    out = [(s, k, e) for s, k, e, _ in base]
    if runs and field:
        run, tags = runs.spans, field.decode(runs.features)
        i = 0
        while i < len(tags):
            if tags[i]:
                j = i + 1
                while j < len(tags) and tags[j] == 2:
                    j += 1
                s, e = int(run[i][0]), int(run[j - 1][1])
                if not any(s < b and a < e for a, _, b, _ in base):
                    out.append((s, 3, e))
                i = j
            else:
                i += 1
    return sorted(out)


def _scanned(field: Field | None):
    def run(batches):
        seen: dict[bytes, bytes] = {}
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for a, b in text_blocks([len(t) for t in texts]):
                runs, long = runs_of(texts[a:b], seen)
                rows = []
                for i, own in enumerate(runs):
                    data = texts[a + i]
                    known = may_match(data, long[i])
                    text = data.decode() if known or own else ""
                    base = base_spans(text) if known else []
                    every = spans_of(text, own, field, base)
                    rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in every])
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
                    ],
                    names=["doc_id", "spans"],
                )

    return run


def scan_secrets(docs: DataFrame, field: Field | None = None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> (code points, end exclusive), ordered by start and kind.

    The kinds assign, access and hex are the patterns', field is the field's. It is fitted to
    `docs` if none is given. A null or empty text has no spans. A repeated row gives equal
    rows, and teaches once; rows without doc_id keep null. An empty table gives an empty
    table; other columns are ignored.
    """
    text_batches(docs.sparkSession)
    field = field or fit(docs, sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(
        _scanned(field), "doc_id long, spans array<struct<kind: string, start: bigint, `end`: bigint>>"
    )


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "field")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )
