"""A bidirectional LSTM over characters with CRF transitions, in numpy.

Windows of WINDOW characters are tagged; PAD stands for what lies before or after a text.
Tags are 0 (outside), and for each kind k a beginning (1 + 2k) and an inside (2 + 2k).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np

WINDOW = 64
#: Symbols: the ASCII characters, every other character, and nothing.
OTHER, PAD = 128, 129
SYMBOLS = 130


def symbols(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), OTHER).astype(np.uint8)


def forbidden(tags: int) -> tuple[np.ndarray, np.ndarray]:
    """What may not follow (tag x tag), and what may not come first: an inside without its beginning."""
    move = np.zeros((tags, tags), bool)
    inside = np.arange(2, tags, 2)
    move[:, inside] = True
    move[inside - 1, inside] = move[inside, inside] = False
    first = np.zeros(tags, bool)
    first[inside] = True
    return move, first


@dataclass
class Weights:
    embed: np.ndarray  # symbol x dim
    gates_in: np.ndarray  # direction x dim x 4 hidden
    gates_on: np.ndarray  # direction x hidden x 4 hidden
    gates_bias: np.ndarray  # direction x 4 hidden
    out: np.ndarray  # 2 hidden x tag
    out_bias: np.ndarray
    move: np.ndarray  # tag x tag
    first: np.ndarray

    @classmethod
    def new(cls, kinds: int, dim: int, hidden: int, rng) -> Weights:
        tags = 1 + 2 * kinds
        bias = np.zeros((2, 4 * hidden))
        bias[:, hidden : 2 * hidden] = 1.0  # remember at first
        scale = 1 / np.sqrt(hidden)
        return cls(
            rng.normal(0, 0.3, (SYMBOLS, dim)), rng.normal(0, scale, (2, dim, 4 * hidden)),
            rng.normal(0, scale, (2, hidden, 4 * hidden)), bias, rng.normal(0, scale, (2 * hidden, tags)),
            np.zeros(tags), np.zeros((tags, tags)), np.zeros(tags),
        )

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def lightened(self) -> Weights:
        return Weights(*[a.astype(np.float32) for a in self.arrays()])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def emissions(w: Weights, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Tag scores (time x window x tag) of windows (window x time). `keep` collects what learning needs."""
    n, time = ids.shape
    hidden = w.gates_on.shape[1]
    both = np.stack([ids, ids[:, ::-1]])
    x = w.embed[both]  # direction x window x time x dim
    into = np.matmul(x.reshape(2, n * time, -1), w.gates_in).reshape(2, n, time, -1) + w.gates_bias[:, None, None]
    h = np.zeros((2, n, hidden), w.out.dtype)
    c = np.zeros_like(h)
    out = np.empty((time, 2, n, hidden), w.out.dtype)
    for t in range(time):
        z = into[:, :, t] + np.matmul(h, w.gates_on)
        gates = _sigmoid(z[..., : 3 * hidden])
        i, f, o = gates[..., :hidden], gates[..., hidden : 2 * hidden], gates[..., 2 * hidden :]
        g = np.tanh(z[..., 3 * hidden :])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        if keep is not None:
            keep.append((h, before, gates, g, squashed))
        h = o * squashed
        out[t] = h
    features = np.concatenate([out[:, 0], out[::-1, 1]], axis=2)
    if keep is not None:
        keep += [features, both, x]
    return features @ w.out + w.out_bias


class Reader:
    """Gives what `emissions` gives, for reading many windows of any length. Both directions step side by side;
    units lie in rows, so that every step works on whole rows in place, and all that a step touches stays in the
    processor's cache: one product adds what symbol, bias and the step before say, and gives the tag scores of
    the step before, too."""

    def __init__(self, w: Weights):
        dim, hidden, kind = w.embed.shape[1], w.gates_on.shape[1], w.out.dtype
        tags = w.out.shape[1]
        half = np.ones(4 * hidden, kind)
        half[: 3 * hidden] = 0.5  # a sigmoid is half of one more than the tanh of half its argument
        # the halves left out of a step's result are in the weights that read it
        self.weights = np.zeros((2, tags + 4 * hidden, hidden + dim + 1), kind)
        for d, own in enumerate(self.weights):
            own[:tags, :hidden] = w.out[d * hidden : (d + 1) * hidden].T / 2
            i, f, o, g = np.vstack([w.gates_on[d] * half / 2, w.gates_in[d] * half, w.gates_bias[d] * half]).T.reshape(4, hidden, -1)
            own[tags:] = np.vstack([o, i, f, g])
        self.weights[0, :tags, -1] = w.out_bias
        self.embed = w.embed.T.copy()
        self.tags, self.dim, self.hidden, self.kind = tags, dim, hidden, kind
        self.room: list[np.ndarray] = []

    def _room(self, n: int, time: int) -> list[np.ndarray]:
        """Arrays for so many windows, in room that is kept for the next ones."""
        shapes = [
            (self.hidden + self.dim + 1, 2, n), (self.tags + 5 * self.hidden, 2, n),
            (self.hidden, 2, n), (time, self.tags, n), (time, 2, n),
        ]
        sizes = [int(np.prod(shape)) for shape in shapes]
        if not self.room or any(size > len(own) for size, own in zip(sizes, self.room, strict=True)):
            self.room = [np.empty(size, kind) for size, kind in zip(sizes, [*[self.kind] * 4, np.intp], strict=True)]
        return [own[:size].reshape(shape) for own, size, shape in zip(self.room, sizes, shapes, strict=True)]

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores (time x window x tag) of windows (window x time), good until the next call."""
        n, time = ids.shape
        hidden, tags = self.hidden, self.tags
        before, z, own, out, at = self._room(n, time)
        h, x = before[:hidden], before[hidden:-1]
        last, o, i, f, g, c = np.split(z, [tags + k * hidden for k in range(5)])
        gates, sigmoids = z[tags:-hidden], z[tags : tags + 3 * hidden]
        kept, new = z[tags + hidden : tags + 3 * hidden], z[tags + 3 * hidden :]  # i and f, g and c
        by_direction, result = before.transpose(1, 0, 2), z[:-hidden].transpose(1, 0, 2)
        at[:, 0] = ids.T
        at[:, 1] = at[::-1, 0]
        before[-1] = 1
        h[:], c[:] = 0, 0
        for t in range(time + 1):
            if t < time:
                np.take(self.embed, at[t], axis=1, out=x, mode="clip")
            np.matmul(self.weights, by_direction, out=result)
            if t:  # each place is met by one direction first, then by the other
                for d, place in enumerate((t - 1, time - t)):
                    met = 2 * t > time + 1 or (2 * t == time + 1 and d)
                    np.add(out[place], last[:, d], out=out[place]) if met else np.copyto(out[place], last[:, d])
            if t < time:
                np.tanh(gates, out=gates)
                sigmoids += 1
                kept *= new
                np.add(i, f, out=c)
                c *= 0.5
                np.tanh(c, out=own)
                np.multiply(o, own, out=h)
        return out.transpose(0, 2, 1)


def undecided(w: Weights, emit: np.ndarray) -> np.ndarray:
    """Sequences that a bound does not prove outside throughout: those where a path that has left outside can be
    worth more than one that never does. As long as none is, a span begins at no gain from what came
    before it, so the gains of all spans of a kind that end here follow from those that end one step before."""
    begin, inside = np.arange(1, emit.shape[2], 2), np.arange(2, emit.shape[2], 2)

    def gain(x) -> np.ndarray:
        return (x - w.move[0, 0]).astype(emit.dtype)[:, None]

    enter, on, again = gain(w.move[:, begin].max(axis=0)), gain(w.move[begin, inside]), gain(w.move[inside, inside])
    leave = [np.maximum(0, gain(w.move[own, 0])) for own in (begin, inside)]
    first = gain(w.first[begin] - w.first[0] + w.move[0, 0])
    scores = emit.transpose(0, 2, 1)
    # the most of a span that begins anywhere, that has gone on up to here, and that goes on with the next step
    top = np.full((len(begin), emit.shape[1]), -np.inf, emit.dtype)
    most, gone_on = top.copy(), top.copy()
    for t in range(0, len(scores), 32):  # so many steps stay in the processor's cache
        some = scores[t : t + 32]
        begun, steps = some[:, 1::2] - some[:, :1], some[:, 2::2] - some[:, :1]
        begun += enter
        if not t:
            begun[0] += first - enter
        np.maximum(top, begun.max(axis=0), out=top)
        begun += on - again
        steps += again
        for start, step in zip(begun, steps, strict=True):
            gone_on += step
            np.maximum(most, gone_on, out=most)
            np.maximum(gone_on, start, out=gone_on)
    return (np.maximum(top + leave[0], most + leave[1]) > -0.01).any(axis=0)


def _learn_back(w: Weights, keep: list, by_emission: np.ndarray) -> list[np.ndarray]:
    """Gradients of all weights but the CRF's, from those by the tag scores."""
    features, both, x = keep[-3:]
    steps = keep[:-3]
    time, n, tags = by_emission.shape
    hidden = w.gates_on.shape[1]
    flat = by_emission.reshape(-1, tags)
    by_out = features.reshape(-1, 2 * hidden).T @ flat
    by_features = (flat @ w.out.T).reshape(time, n, 2 * hidden)
    by_h = np.stack([by_features[..., :hidden], by_features[::-1, :, hidden:]], axis=1)  # time x direction x window
    by_into = np.empty((2, n, time, 4 * hidden))
    by_on = np.zeros_like(w.gates_on)
    next_h = np.zeros((2, n, hidden))
    next_c = np.zeros_like(next_h)
    back = w.gates_on.transpose(0, 2, 1)
    for t in range(time - 1, -1, -1):
        h, c, gates, g, squashed = steps[t]
        i, f, o = gates[..., :hidden], gates[..., hidden : 2 * hidden], gates[..., 2 * hidden :]
        dh = by_h[t] + next_h
        dc = next_c + dh * o * (1 - squashed * squashed)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)], axis=2)
        by_into[:, :, t] = dz
        by_on += np.matmul(h.transpose(0, 2, 1), dz)
        next_h, next_c = np.matmul(dz, back), dc * f
    rows = by_into.reshape(2, n * time, -1)
    by_in = np.matmul(x.reshape(2, n * time, -1).transpose(0, 2, 1), rows)
    by_x = np.matmul(rows, w.gates_in.transpose(0, 2, 1))
    by_embed = np.zeros_like(w.embed)
    np.add.at(by_embed, both.reshape(-1), by_x.reshape(2 * n * time, -1))
    return [by_embed, by_in, by_on, rows.sum(axis=1), by_out, flat.sum(axis=0)]


def crf_gradients(w: Weights, emit: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Negative log-likelihood of `tags` (time x window), and its gradients by emissions, moves and first tags."""
    time, n, k = emit.shape
    no_move, no_first = forbidden(k)
    move = np.where(no_move, -np.inf, w.move)
    e_move = np.exp(move)
    low, high = np.empty_like(emit), np.zeros_like(emit)
    low[0] = emit[0] + np.where(no_first, -1e9, w.first)
    for t in range(1, time):
        top = low[t - 1].max(axis=1, keepdims=True)
        low[t] = np.log(np.exp(low[t - 1] - top) @ e_move + 1e-300) + top + emit[t]
    for t in range(time - 2, -1, -1):
        after = emit[t + 1] + high[t + 1]
        top = after.max(axis=1, keepdims=True)
        high[t] = np.log(np.exp(after - top) @ e_move.T + 1e-300) + top
    top = low[-1].max(axis=1, keepdims=True)
    total = (np.log(np.exp(low[-1] - top).sum(axis=1, keepdims=True)) + top)[:, 0]
    share = np.exp(low + high - total[None, :, None])
    one = np.eye(k)[tags]
    a, b = low[:-1], emit[1:] + high[1:]
    ta, tb = a.max(axis=2, keepdims=True), b.max(axis=2, keepdims=True)
    weight = np.exp(ta + tb - total[None, :, None])
    pairs = ((np.exp(a - ta) * weight).reshape(-1, k).T @ np.exp(b - tb).reshape(-1, k)) * e_move
    seen = one[:-1].reshape(-1, k).T @ one[1:].reshape(-1, k)
    held = (emit * one).sum() + (seen * np.where(no_move, 0, w.move)).sum() + (one[0] * w.first).sum()
    return float(total.sum() - held), [share - one, pairs - seen, (share[0] - one[0]).sum(axis=0)]


def train(
    ids: np.ndarray, tags: np.ndarray, kinds: int, steps: int = 200, batch: int = 64, dim: int = 12, hidden: int = 24, rate: float = 0.01
) -> Weights:
    """Weights of greatest likelihood, by Adam on batches; `ids` and `tags` are window x time."""
    rng = np.random.default_rng(7)
    w = Weights.new(kinds, dim, hidden, rng)
    state = [(np.zeros_like(a), np.zeros_like(a)) for a in w.arrays()]
    order = np.empty(0, int)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(ids)):
            order = np.concatenate([order, rng.permutation(len(ids))])
        own, order = order[:batch], order[batch:]
        keep: list = []
        emit = emissions(w, ids[own], keep)
        _, (by_emit, by_move, by_first) = crf_gradients(w, emit, tags[own].T.astype(int))
        grads = [*_learn_back(w, keep, by_emit), by_move, by_first]
        norm = np.sqrt(sum((g * g).sum() for g in grads))
        scale = min(1.0, 5.0 * len(own) / max(norm, 1e-12)) / len(own)
        slow = rate * (1 - 0.9 * step / steps)
        for a, g, (m, v) in zip(w.arrays(), grads, state, strict=True):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= slow * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w.lightened()


def decode(w: Weights, emit: np.ndarray) -> np.ndarray:
    """The best tags (time x sequence) by Viterbi; ties go to the lower tag."""
    time, n, k = emit.shape
    no_move, no_first = forbidden(k)
    move = np.where(no_move, -1e9, w.move.astype(float))
    back = np.empty((time, n, k), np.uint8)
    best = emit[0] + np.where(no_first, -1e9, w.first)
    for t in range(1, time):
        through = best[:, :, None] + move
        back[t] = through.argmax(axis=1)
        best = through.max(axis=1) + emit[t]
    out = np.empty((time, n), np.uint8)
    out[-1] = best.argmax(axis=1)
    for t in range(time - 1, 0, -1):
        out[t - 1] = back[t, np.arange(n), out[t]]
    return out
