"""A tokenizer file of the tokenizers library, and what can be proven about its word boundaries.

A byte-level tokenizer cuts a text into words from left to right; where the next
word ends hangs on what follows it, never on what came before, and only a few
characters are looked at beyond its end. So a word start that is further than
MARGIN from the end of a piece is also a word start of any longer text with the
same characters up to there, and two pieces that share a word start at the same
place agree on everything after it. Tokens never cross words.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters that a word boundary must keep from the end of a piece to be certain.
MARGIN = 24
#: Text encoded in one call; bounds the memory that encodings take.
BLOCK_CHARS = 400_000
#: Characters of a run between word starts that is worth remembering, and runs remembered between two clearings.
RUN_CHARS, RUNS = 64, 1 << 18


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def blocks(texts: list[str], most: int = BLOCK_CHARS):
    """Ranges (start, end) of texts with at most `most` characters together, or one text."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > most:
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


class Bpe:
    """One tokenizer. `splits`: its word boundaries obey the rule above, so texts may be cut."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        first, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        odd = any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added)
        longest = max((len(a["content"]) for a in added), default=0)
        self.byte_level = first.get("type") == "ByteLevel"
        self.splits = (
            self.byte_level
            and bool(first.get("use_regex"))
            and not first.get("add_prefix_space")
            and not odd
            and spec.get("normalizer") is None
            and longest + 4 <= MARGIN
        )
        self.special = {a["content"]: a["id"] for a in added}
        by_length = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("|".join(map(re.escape, by_length))) if by_length else None

    def encode(self, texts: list[str]) -> list:
        """Encodings with word numbers and places."""
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def fast(self, texts: list[str]) -> list:
        """Encodings with ids only."""
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.fast(texts)]

    @lru_cache(maxsize=1)  # noqa: B019
    def token_bytes(self) -> list[bytes]:
        """The bytes of each token id of a byte-level vocabulary."""
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        table = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            table[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        return table

    def decode(self, ids) -> str:
        if not self.byte_level:
            return self.tokenizer.decode(list(ids), skip_special_tokens=False)
        table = self.token_bytes()
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


#: A space as in _SURE below, written so that the search runs from space to space.
_BETWEEN = re.compile(r" (?<=[\w!-~] )(?=[\w!-~])")


class Runs:
    """What the runs between certain word starts give, remembered. Ids never cross a word start, so the runs of a text
    give together what the whole of it gives; for texts without special strings, of a tokenizer that `splits`."""

    def __init__(self, bpe: Bpe, value: Callable):
        self.bpe, self.value, self.known = bpe, value, {}

    def _values(self, texts: list[str]) -> list:
        return [self.value(e) for a, b in blocks(texts) for e in self.bpe.fast(texts[a:b])]

    def of(self, texts: list[str]) -> list[list]:
        """The values of the runs of each text, in order; each run after the first one starts with its space."""
        known, firsts, rest = self.known, [], []
        for t in texts:
            first, *own = _BETWEEN.split(t)
            firsts.append(first)
            rest.append(own)
        new = list(dict.fromkeys(chain.from_iterable(rest)).keys() - known.keys())
        known.update(zip(new, self._values([" " + w for w in new]), strict=True))
        out = [[v, *map(known.__getitem__, own)] for v, own in zip(self._values(firsts), rest, strict=True)]
        for w in new:
            if len(w) >= RUN_CHARS:
                del known[w]
        if len(known) > RUNS:
            known.clear()
        return out


def word_starts(encoding) -> tuple[np.ndarray, np.ndarray]:
    """Places and token numbers of all word starts of an encoding."""
    words = encoding.word_ids
    at = [i for i, w in enumerate(words) if i == 0 or w is None or words[i - 1] is None or w != words[i - 1]]
    offsets = encoding.offsets
    return np.array([offsets[i][0] for i in at], np.int64), np.array(at, np.int64)


#: A lone space between visible characters starts a word whatever stands around them.
_SURE = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")


def first_word_start(text: str) -> int | None:
    """The first word start inside a text that no context can undo."""
    m = _SURE.search(text)
    return m.start() if m else None


def last_word_start(text: str) -> int | None:
    size = 128
    while True:
        found = [m.start() for m in _SURE.finditer(text, max(0, len(text) - size))]
        if found or size >= len(text):
            return found[-1] if found else None
        size *= 8
