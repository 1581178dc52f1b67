"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, carried state.

Words are numbered by frequency: the `head` words are grouped in classes of equal size, and the model gives
P(class | state) x P(word | class, state). All other words fall by their last letters in `tails` further classes,
which the model tells apart too; within those, words have the probabilities of their smoothed counts. Documents
run through lanes: a lane takes one document after the other, in windows of `steps` tokens, and the state goes on
from window to window, so every document is learned and scored whole. An end token before a document resets the
state.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np


@dataclass(frozen=True)
class Shape:
    """Sizes of a model: head words = classes x width; token ids run on through `buckets` for other words, bucket b in tail class b % tails."""

    hidden: int = 24
    inner: int = 16
    classes: int = 32
    width: int = 32
    tails: int = 16
    buckets: int = 1024
    steps: int = 32

    @property
    def head(self) -> int:
        return self.classes * self.width

    @property
    def inputs(self) -> int:
        return self.head + self.buckets

    def parts(self) -> dict[str, tuple[int, ...]]:
        h, out = self.hidden, self.classes + self.tails
        return {"embed": (self.inputs, self.inner), "enter": (self.inner, 3 * h), "gate_bias": (3 * h,), "keep": (h, 2 * h), "new": (h, h), "to_class": (h, out), "class_bias": (out,), "to_word": (self.classes, h, self.width), "word_bias": (self.classes, self.width)}


def start(shape: Shape, seed: int = 5) -> dict[str, np.ndarray]:
    """Small random weights, zero biases."""
    rng = np.random.default_rng(seed)
    return {k: (np.zeros(s) if k.endswith("bias") else rng.normal(0, 1 / np.sqrt(shape.inner if k in ("embed", "enter") else shape.hidden), s)).astype(np.float32) for k, s in shape.parts().items()}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w.reshape(-1) for w in weights.values()])


def unflat(shape: Shape, values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in shape.parts().items():
        n = int(np.prod(s))
        out[k], at = values[at : at + n].reshape(s).astype(np.float32), at + n
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


@lru_cache(8)
def class_table(shape: Shape) -> np.ndarray:
    """Output class of each token id."""
    ids = np.arange(shape.inputs)
    return np.where(ids < shape.head, ids // shape.width, shape.classes + (ids - shape.head) % shape.tails).astype(np.int16)


class Trace:
    """What backpropagation needs of the steps of a window: for each, the state before it, both gates, the held and the new state."""

    def __init__(self, steps: int, lanes: int, h: int):
        self.before, self.held, self.new = (np.empty((steps, lanes, h), np.float32) for _ in range(3))
        self.gates = np.empty((steps, lanes, 2 * h), np.float32)


def run_steps(shape: Shape, w: dict[str, np.ndarray], inputs: np.ndarray, state: np.ndarray, end: int, trace: Trace | None = None) -> np.ndarray:
    """States after each step (steps x lanes x hidden); inputs are steps x lanes; the state is reset at end tokens."""
    h = shape.hidden
    out = np.empty((*inputs.shape, h), np.float32)
    entered = w["embed"][inputs] @ w["enter"]
    entered += w["gate_bias"]
    goes_on = (inputs != end)[:, :, None].astype(np.float32)
    one = Trace(1, inputs.shape[1], h) if trace is None else trace
    for t, gate in enumerate(entered):
        at = 0 if trace is None else t
        before, zr, held, new = one.before[at], one.gates[at], one.held[at], one.new[at]
        np.multiply(state, goes_on[t], out=before)
        np.matmul(before, w["keep"], out=zr)
        zr += gate[:, : 2 * h]
        sigmoid(zr)
        np.multiply(zr[:, h:], before, out=held)
        np.matmul(held, w["new"], out=new)
        new += gate[:, 2 * h :]
        np.tanh(new, out=new)
        state = out[t]
        np.subtract(new, before, out=state)
        state *= zr[:, :h]
        state += before
    return out


def softmax_parts(d: np.ndarray, at: tuple) -> np.ndarray:
    """Logits d become probabilities in place; natural logs of those at the places `at`. One maximum serves all rows, as
    logits are near each other; where they are far apart, each row has its own."""
    top = d.max()
    if top - d.min() > 60:
        top = d.max(axis=1, keepdims=True)
    d -= top
    logs = d[at]
    np.exp(d, out=d)
    sums = d @ np.ones(d.shape[1], d.dtype)
    d *= (1 / sums)[:, None]
    return logs - np.log(sums)


def column_sums(x: np.ndarray) -> np.ndarray:
    return np.ones(len(x), x.dtype) @ x


def by_class(shape: Shape, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """An order of the targets by class, their classes in it, and where each head class begins and the last ends."""
    kinds = class_table(shape)[targets]
    order = np.argsort(kinds, kind="stable")
    kinds = kinds[order].astype(np.intp)
    return order, kinds, np.searchsorted(kinds, np.arange(shape.classes + 1)).tolist()


def token_logs(shape: Shape, w: dict[str, np.ndarray], states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of P(class), for head words times P(word | class), of each target (states: n x hidden)."""
    order, kinds, edges = by_class(shape, targets)
    states, targets, every = states[order], targets[order], np.arange(len(targets))
    logs = softmax_parts(states @ w["to_class"] + w["class_bias"], (every, kinds))
    for c in range(shape.classes):
        a, b = edges[c], edges[c + 1]
        if a < b:
            logs[a:b] += softmax_parts(states[a:b] @ w["to_word"][c] + w["word_bias"][c], (every[: b - a], targets[a:b] - c * shape.width))
    out = np.empty(len(logs), logs.dtype)
    out[order] = logs
    return out


def gradients(shape: Shape, w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, state: np.ndarray, end: int, known: np.ndarray | None = None) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
    """Gradients of the mean loss over one window (backpropagation ends at its start), the last state, the loss.

    known, of the targets' shape, is False where a lane has run out; those places count for nothing.
    """
    h = shape.hidden
    trace = Trace(*inputs.shape, h)
    states = run_steps(shape, w, inputs, state, end, trace)
    flat_targets = targets.reshape(-1) if known is None else targets.reshape(-1)[known.reshape(-1)]
    order, kinds, edges = by_class(shape, flat_targets)
    places = order if known is None else np.flatnonzero(known)[order]
    mine, flat_targets, n = states.reshape(-1, h)[places], flat_targets[order], len(order)
    every = np.arange(n)
    d = mine @ w["to_class"]
    d += w["class_bias"]
    loss = -float(softmax_parts(d, (every, kinds)).sum())
    d[every, kinds] -= 1
    g = {"to_class": mine.T @ d, "class_bias": column_sums(d), "to_word": np.zeros_like(w["to_word"]), "word_bias": np.zeros_like(w["word_bias"])}
    d_mine = d @ w["to_class"].T
    for c in range(shape.classes):
        a, b = edges[c], edges[c + 1]
        if a < b:
            d = mine[a:b] @ w["to_word"][c]
            d += w["word_bias"][c]
            at = every[: b - a], flat_targets[a:b] - c * shape.width
            loss -= float(softmax_parts(d, at).sum())
            d[at] -= 1
            g["to_word"][c], g["word_bias"][c] = mine[a:b].T @ d, column_sums(d)
            d_mine[a:b] += d @ w["to_word"][c].T
    d_states = np.empty((targets.size, h), np.float32) if known is None else np.zeros((targets.size, h), np.float32)
    d_states[places] = d_mine
    d_states = d_states.reshape(states.shape)
    d_gates = np.empty((*inputs.shape, 3 * h), np.float32)
    d_next = np.zeros_like(state)
    keep_back, new_back = np.ascontiguousarray(w["keep"].T), np.ascontiguousarray(w["new"].T)
    goes_on = (inputs != end)[:, :, None].astype(np.float32)
    # What doesn't depend on later steps, for all steps at once.
    z, r = trace.gates[:, :, :h], trace.gates[:, :, h:]
    z_slope = trace.new - trace.before
    z_slope *= 1 - z
    z_slope *= z
    new_slope = trace.new * trace.new
    np.subtract(1, new_slope, out=new_slope)
    new_slope *= z
    r_slope = 1 - r
    r_slope *= trace.held
    for t in range(len(inputs) - 1, -1, -1):
        d_next += d_states[t]
        now = d_gates[t]
        np.multiply(d_next, z_slope[t], out=now[:, :h])
        np.multiply(d_next, new_slope[t], out=now[:, 2 * h :])
        d_held = now[:, 2 * h :] @ new_back
        np.multiply(d_held, r_slope[t], out=now[:, h : 2 * h])
        d_next -= d_next * z[t]
        d_held *= r[t]
        d_next += d_held
        d_next += now[:, : 2 * h] @ keep_back
        d_next *= goes_on[t]
    flat_gates = d_gates.reshape(-1, 3 * h)
    g["new"] = trace.held.reshape(-1, h).T @ flat_gates[:, 2 * h :]
    g["keep"] = trace.before.reshape(-1, h).T @ flat_gates[:, : 2 * h]
    ids = inputs.reshape(-1)
    g["enter"], g["gate_bias"] = w["embed"][ids].T @ flat_gates, column_sums(flat_gates)
    d_embed = flat_gates @ w["enter"].T
    order = np.argsort(ids.astype(np.int32), kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    g["embed"] = np.zeros_like(w["embed"])
    g["embed"][ids[first]] = np.add.reduceat(d_embed[order], first, axis=0)
    for x in g.values():
        x /= n
    return g, states[-1], loss / n


class Lanes:
    """Documents (token ids, each closed by an end) dealt to lanes and run through windows of `steps` tokens.

    The longest document goes to the emptiest lane, so that lanes end at about the same time; those with more tokens
    stand first, and a window has the lanes that still have some.
    """

    def __init__(self, documents: list[np.ndarray], lanes: int):
        lanes = min(lanes, len(documents))
        loads = [(0, i) for i in range(lanes)]
        queues: list[list[int]] = [[] for _ in range(lanes)]
        for d in sorted(range(len(documents)), key=lambda d: -len(documents[d])):
            load, lane = heapq.heappop(loads)
            queues[lane].append(d)
            heapq.heappush(loads, (load + len(documents[d]), lane))
        queues.sort(key=lambda q: -sum(len(documents[d]) for d in q))
        self.tokens = [np.concatenate([documents[d] for d in q]) for q in queues]
        self.owners = [np.repeat(np.array(q, np.int32), [len(documents[d]) for d in q]) for q in queues]
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)

    def windows(self, steps: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """inputs, targets and owners (document of each target, -1 where its lane has run out) of one window after the other."""
        if not len(self.sizes):
            return
        longest = int(self.sizes.max())
        last = np.full(len(self.sizes), end)
        for at in range(0, longest, steps):
            live, size = int((self.sizes > at).sum()), min(steps, longest - at)
            targets, owner = np.full((size, live), end), np.full((size, live), -1)
            for i in range(live):
                part = self.tokens[i][at : at + size]
                targets[: len(part), i], owner[: len(part), i] = part, self.owners[i][at : at + size]
            # A lane that ran out did so at the end of a document, where nothing goes on.
            yield np.concatenate((last[None, :live], targets[:-1])), targets, owner
            last = targets[-1]


class Trainer:
    """Adam over truncated backpropagation windows of whole documents; the state goes on from window to window.

    A window with fewer tokens than lanes x steps is learned at a rate in proportion to those it has.
    """

    def __init__(self, shape: Shape, weights: dict[str, np.ndarray], rate: float, end: int = 0, lanes: int = 64):
        self.shape, self.w, self.rate, self.count, self.end, self.lanes = shape, {k: v.copy() for k, v in weights.items()}, rate, 0, end, lanes
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}
        #: tokens learned, and the sum of their losses
        self.tokens, self.loss = 0, 0.0

    def learn(self, documents: list[np.ndarray]) -> None:
        """One pass over all tokens of whole documents, each of which closes with `end`."""
        state = np.zeros((min(self.lanes, len(documents)), self.shape.hidden), np.float32)
        for inputs, targets, owner in Lanes(documents, self.lanes).windows(self.shape.steps, self.end):
            known = owner >= 0
            n = int(known.sum())
            g, state, loss = gradients(self.shape, self.w, inputs, targets, state[: inputs.shape[1]], self.end, None if n == known.size else known)
            self.tokens, self.loss, self.count = self.tokens + n, self.loss + loss * n, self.count + 1
            self.update(g, self.rate * n / (self.shape.steps * self.lanes))

    def update(self, g: dict[str, np.ndarray], rate: float) -> None:
        norm = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        step = rate / (1 - 0.9**self.count)
        level = 1 - 0.99**self.count
        for k, x in g.items():
            x *= scale
            mean, square = self.mean[k], self.square[k]
            mean *= 0.9
            mean += 0.1 * x
            x *= x
            square *= 0.99
            square += 0.01 * x
            np.divide(square, level, out=x)
            np.sqrt(x, out=x)
            x += 1e-7
            np.divide(mean, x, out=x)
            x *= step
            self.w[k] -= x


def score_documents(shape: Shape, w: dict[str, np.ndarray], documents: list[np.ndarray], end: int, lanes: int = 512) -> np.ndarray:
    """Natural log-likelihood of each document's token ids (each closes with `end`), by the model's classes and head words."""
    sums = np.zeros(len(documents))
    state = np.zeros((min(lanes, len(documents)), shape.hidden), np.float32)
    for inputs, targets, owner in Lanes(documents, lanes).windows(shape.steps, end):
        states = run_steps(shape, w, inputs, state[: inputs.shape[1]], end)
        state = states[-1]
        owner, flat = owner.reshape(-1), states.reshape(-1, shape.hidden)
        known = owner >= 0
        if not known.all():
            flat, targets, owner = flat[known], targets.reshape(-1)[known], owner[known]
        sums += np.bincount(owner, weights=token_logs(shape, w, flat, targets.reshape(-1)), minlength=len(documents))
    return sums
