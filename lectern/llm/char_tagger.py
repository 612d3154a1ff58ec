"""A character-level bidirectional LSTM with CRF transitions, in NumPy.

Arrays are laid out as (features, texts), one column for each window of text,
so that a step in time is a few products and element-wise functions over all
windows of a block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

f32 = np.float32
# Classes of characters: 0 none, 1 to 95 for space to tilde, then line break, other control characters, digits, capitals, letters, rest.
CHARS = 102
FORBIDDEN = f32(-1e4)


def _class_table() -> np.ndarray:
    table = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        text = chr(c)
        if 32 <= c < 127:
            table[c] = c - 31
        elif c == 10:
            table[c] = 96
        elif c < 32 or c == 127:
            table[c] = 97
        elif text.isdigit():
            table[c] = 98
        elif text.isupper():
            table[c] = 99
        elif text.isalpha():
            table[c] = 100
        else:
            table[c] = 101
    return table


_TABLE: list[np.ndarray] = []


def char_classes(text: str) -> np.ndarray:
    """The class of each character."""
    if not _TABLE:
        _TABLE.append(_class_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 1 << 16, _TABLE[0][np.minimum(points, (1 << 16) - 1)], 101).astype(np.uint8)


@dataclass
class Tagger:
    """``sides`` are the forward and the backward LSTM: rows i, f, o, g over state, embedding and one."""

    embedding: np.ndarray
    sides: list[np.ndarray]
    out: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    @classmethod
    def random(cls, kinds: int, hidden: int, dims: int, seed: int) -> Tagger:
        """Labels are 0 (outside), 2 k + 1 (first character of kind k) and 2 k + 2 (a later one)."""
        rng = np.random.default_rng(seed)
        tags = 1 + 2 * kinds
        sides = []
        for _ in range(2):
            side = rng.normal(0, (hidden + dims) ** -0.5, (4 * hidden, hidden + dims + 1)).astype(f32)
            side[:, -1] = 0
            side[hidden : 2 * hidden, -1] = 1
            sides.append(side)
        out = rng.normal(0, hidden**-0.5, (tags, 2 * hidden + 1)).astype(f32)
        out[:, -1] = 0
        return cls(rng.normal(0, 0.5, (dims, CHARS)).astype(f32), sides, out, np.zeros((tags, tags), f32), np.zeros(tags, f32))

    @property
    def hidden(self) -> int:
        return self.sides[0].shape[0] // 4

    def barred(self) -> tuple[np.ndarray, np.ndarray]:
        """Moves (from, to) and starts with those that no labelling has forbidden."""
        moves, first = self.moves.copy(), self.first.copy()
        for to in range(2, len(first), 2):
            first[to] = FORBIDDEN
            for come in range(len(first)):
                if come not in (to - 1, to):
                    moves[come, to] = FORBIDDEN
        return moves, first

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.sides, self.out, self.moves, self.first]


def run_side(model: Tagger, side: int, ids: np.ndarray, lengths: np.ndarray, out: np.ndarray, keep: list | None = None) -> None:
    """The states of one direction into ``out`` (times, hidden, texts); ``keep`` gets what the gradient needs.

    The backward direction starts at each text's own end.
    """
    n, dims, weights = model.hidden, len(model.embedding), model.sides[side]
    steps, texts = ids.shape
    # Half of the argument of the three gates, so that one tanh does for all: sigmoid(x) = (1 + tanh(x / 2)) / 2.
    scaled = weights.copy()
    scaled[: 3 * n] *= f32(0.5)
    x = np.zeros((n + dims + 1, texts), f32)
    x[-1] = 1
    z = np.empty((4 * n, texts), f32)
    cell, bent, part = np.zeros((n, texts), f32), np.empty((n, texts), f32), np.empty((n, texts), f32)
    shortest = int(lengths.min(initial=steps))
    half = f32(0.5)
    for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
        np.take(model.embedding, ids[t], axis=1, out=x[n:-1], mode="clip")
        np.matmul(scaled, x, out=z)
        np.tanh(z, out=z)
        gates = z[: 3 * n]
        gates *= half
        gates += half
        if keep is not None:
            keep.append((x.copy(), z.copy(), cell.copy()))
        cell *= z[n : 2 * n]
        np.multiply(z[:n], z[3 * n :], out=part)
        cell += part
        if side and t >= shortest:
            cell *= t < lengths
        np.tanh(cell, out=bent)
        np.multiply(z[2 * n : 3 * n], bent, out=x[:n])
        out[t] = x[:n]


def emissions(model: Tagger, ids: np.ndarray, lengths: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Scores (times, labels, texts) and the states they come from."""
    n = model.hidden
    states = np.empty((ids.shape[0], 2 * n, ids.shape[1]), f32)
    for side in range(2):
        kept = None if keep is None else []
        run_side(model, side, ids, lengths, states[:, side * n : (side + 1) * n], kept)
        if keep is not None:
            keep.append(kept)
    return np.matmul(model.out[:, :-1], states) + model.out[:, -1:], states


def may_leave(model: Tagger, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The texts whose best labelling may have a label other than 0.

    A labelling that leaves 0 gains at most what its characters score above 0 and the best moves;
    where that is not positive at any character, staying outside is best.
    """
    moves, first = model.barred()
    gain = max(float((moves[:, 1:] - moves[0, 0]).max()), float((first[1:] - first[0]).max()))
    back = max(0.0, float((moves[1:, 0] - moves[0, 0]).max()))
    inside = np.arange(len(scores))[:, None] < lengths
    above = np.where(inside, scores[:, 1:].max(axis=1) - scores[:, 0], -np.inf).max(axis=0)
    return np.flatnonzero(above + gain + back > 0)


def best_labels(model: Tagger, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The labelling with the highest score of each text (times, texts); 0 after its end."""
    moves, first = model.barred()
    steps, tags, texts = scores.shape
    total = scores[0] + first[:, None]
    came = np.zeros((steps, tags, texts), np.uint8)
    stay = np.arange(tags, dtype=np.uint8)[:, None]
    for t in range(1, steps):
        paths = total[:, None, :] + moves[:, :, None]
        inside = t < lengths
        came[t] = np.where(inside, paths.argmax(axis=0), stay)
        total = np.where(inside, paths.max(axis=0) + scores[t], total)
    found = np.zeros((steps, texts), np.uint8)
    at = total.argmax(axis=0)
    each = np.arange(texts)
    for t in range(steps - 1, -1, -1):
        found[t] = np.where(t < lengths, at, 0)
        at = came[t, at, each]
    return found


def loss_and_gradients(model: Tagger, ids: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood of the labellings (times, texts) and its gradient by each parameter; texts are equally long."""
    n, dims = model.hidden, len(model.embedding)
    steps, texts = ids.shape
    full = np.full(texts, steps)
    keep: list = []
    scores, states = emissions(model, ids, full, keep)
    moves, first = model.barred()
    tags = len(first)
    each = np.arange(texts)

    # Forward and backward sums, scaled to one at each time.
    lift = scores.max(axis=1)
    local = np.exp(scores - lift[:, None])
    step = np.exp(moves)
    forth, scale = np.empty_like(local), np.empty((steps, texts), f32)
    now = local[0] * np.exp(first)[:, None]
    for t in range(steps):
        if t:
            now = (step.T @ forth[t - 1]) * local[t]
        scale[t] = now.sum(axis=0)
        forth[t] = now / scale[t]
    back = np.ones((tags, texts), f32)
    marginal = np.empty_like(local)
    marginal[-1] = forth[-1]
    pairs = np.zeros((tags, tags), f32)
    for t in range(steps - 1, 0, -1):
        ahead = back * local[t] / scale[t]
        pairs += forth[t - 1] @ ahead.T
        back = step @ ahead
        marginal[t - 1] = forth[t - 1] * back
    pairs *= step

    gold = np.take_along_axis(scores, labels[:, None, :].astype(np.int64), axis=1)[:, 0].sum()
    gold += first[labels[0]].sum() + moves[labels[:-1], labels[1:]].sum()
    loss = float(np.log(scale).sum() + lift.sum() - gold) / texts

    push = marginal
    push[np.arange(steps)[:, None], labels, each[None, :]] -= 1
    push /= texts
    seen = np.zeros((tags, tags), f32)
    np.add.at(seen, (labels[:-1].ravel(), labels[1:].ravel()), 1)
    by_moves, by_first = (pairs - seen) / texts, push[0].sum(axis=1)
    by_moves[moves <= FORBIDDEN], by_first[first <= FORBIDDEN] = 0, 0
    flat = push.transpose(1, 0, 2).reshape(tags, -1)
    by_out = np.concatenate([flat @ states.transpose(1, 0, 2).reshape(2 * n, -1).T, flat.sum(axis=1)[:, None]], 1)
    by_states = np.matmul(model.out[:, :-1].T, push)

    by_embedding = np.zeros_like(model.embedding)
    by_sides = []
    for side in range(2):
        weights = model.sides[side]
        order = list(range(steps)) if side == 0 else list(range(steps - 1, -1, -1))
        total = np.zeros_like(weights)
        by_inputs = np.empty((steps, dims, texts), f32)
        dh, dc = np.zeros((n, texts), f32), np.zeros((n, texts), f32)
        for k in range(steps - 1, -1, -1):
            t = order[k]
            x, z, before = keep[side][k]
            i, f, o, g = z[:n], z[n : 2 * n], z[2 * n : 3 * n], z[3 * n :]
            bent = np.tanh(before * f + i * g)
            dh = dh + by_states[t, side * n : (side + 1) * n]
            dc = dc + dh * o * (1 - bent * bent)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - g * g)])
            total += dz @ x.T
            dx = weights.T @ dz
            dh, dc = dx[:n], dc * f
            by_inputs[t] = dx[n:-1]
        by_sides.append(total)
        places = ids.ravel()
        for d in range(dims):
            by_embedding[d] += np.bincount(places, by_inputs[:, d].ravel(), CHARS).astype(f32)
    return loss, [by_embedding, *by_sides, by_out, by_moves, by_first]


def train(ids: np.ndarray, labels: np.ndarray, kinds: int, hidden: int, dims: int, steps: int, batch: int, rate: float, seed: int) -> Tagger:
    """Fit to windows (times, texts) by Adam with a falling rate; gradients are cut at a norm of five."""
    model = Tagger.random(kinds, hidden, dims, seed)
    rng = np.random.default_rng(seed + 1)
    own = model.parameters()
    mean, square = [np.zeros_like(p) for p in own], [np.zeros_like(p) for p in own]
    order = np.zeros(0, np.int64)
    for k in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(ids.shape[1])])
        chosen, order = order[:batch], order[batch:]
        _, slopes = loss_and_gradients(model, ids[:, chosen], labels[:, chosen])
        norm = float(np.sqrt(sum((s * s).sum() for s in slopes)))
        cut = min(1.0, 5 / max(norm, 1e-9))
        now = rate * (1 - k / (steps + 1)) ** 0.5
        for p, s, m, v in zip(own, slopes, mean, square):
            s = s * f32(cut)
            m += f32(0.1) * (s - m)
            v += f32(0.01) * (s * s - v)
            p -= f32(now / (1 - 0.9**k)) * m / (np.sqrt(v / f32(1 - 0.99**k)) + f32(1e-8))
    return model
