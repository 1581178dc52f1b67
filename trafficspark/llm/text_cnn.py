"""A convolutional text classifier in numpy: hashed word embeddings, several filter widths, max pooling.

A word's vector adds up the embeddings of its hashed parts (the word and its character n-grams, with marks at
both ends), so that an inflected form that was never met still has the vectors of its parts. Filters of each width
pass over the vectors, each keeps its greatest response in the whole text, and a logistic layer weighs these. Only the
windows that won a maximum learn, so a step costs little more than the pass forward.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np

WORD, GAP = re.compile(r"[^\W\d_]+"), re.compile(r"[\W\d_]")
#: Characters and words handled at a time, so that work arrays stay small however long a text is.
CHARS, WORDS = 1 << 20, 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)
BY_PLACE = np.cumprod(np.full(64, MIX))


@dataclass(frozen=True)
class Shape:
    """What a model is made of: buckets of the embedding, its size, filter widths, filters of each width, n-gram orders."""

    buckets: int = 1 << 18
    size: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    orders: tuple[int, ...] = (4, 5)

    @property
    def pooled(self) -> int:
        return len(self.widths) * self.filters


def pieces(text: str) -> Iterator[list[str]]:
    """The lower-cased words of a text, about CHARS characters at a time, cut between words."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + CHARS) if at + CHARS < len(text) else None
        end = gap.start() if gap else len(text)
        yield WORD.findall(text[at:end].lower())
        at = end


def word_parts(words: list[str], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all parts of the words in a row, and where each word's parts begin: the word itself, then its n-grams."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - starts[owner]
    # The whole word: a sum over its characters, each multiplied by a number that goes by its place.
    whole = np.add.reduceat(points * BY_PLACE[place % len(BY_PLACE)], starts)
    keys, owners = [whole * MIX], [np.arange(len(words))]
    for n in shape.orders:
        first = np.flatnonzero(place + n <= sizes[owner])
        h = np.full(len(first), n, np.uint64)
        for k in range(n):
            h = (h ^ points[first + k]) * MIX
            h ^= h >> np.uint64(29)
        keys.append(h * MIX)
        owners.append(owner[first])
    buckets = ((np.concatenate(keys) >> np.uint64(20)) % np.uint64(shape.buckets)).astype(np.int32)
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(words))
    return buckets[order], np.concatenate(([0], np.cumsum(counts)[:-1]))


class TextCnn:
    """Parameters and the pass forward. `filters` holds a (size x filters) block for each width and each place in it."""

    def __init__(self, shape: Shape, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.shape = shape
        self.embedding = rng.normal(0, 0.15, (shape.buckets, shape.size)).astype(np.float32)
        self.filters = rng.normal(0, 0.3, (shape.size, sum(shape.widths) * shape.filters)).astype(np.float32)
        self.shift = np.zeros(shape.pooled, np.float32)
        self.weights = rng.normal(0, 0.3, shape.pooled).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    @classmethod
    def of(cls, shape: Shape, parameters: list[np.ndarray]) -> TextCnn:
        """A trained model from its parameters."""
        model = cls.__new__(cls)
        model.shape = shape
        model.embedding, model.filters, model.shift, model.weights, model.bias = parameters
        return model

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.shift, self.weights, self.bias]

    def blocks(self) -> Iterator[tuple[int, int, int]]:
        """(number of the width, place in the window, first column) of each block of `filters`."""
        at = 0
        for i, width in enumerate(self.shape.widths):
            for j in range(width):
                yield i, j, at
                at += self.shape.filters

    def vectors(self, parts: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sums of each word's parts, over the root of their number, so that long words don't stand out."""
        if not len(starts):
            return np.zeros((0, self.shape.size), np.float32)
        counts = np.diff(np.append(starts, len(parts))).astype(np.float32)
        return np.add.reduceat(self.embedding[parts], starts, axis=0) / np.sqrt(counts)[:, None]

    def responses(self, rows: np.ndarray) -> np.ndarray:
        """Response of every filter at every window of a run of word vectors; windows that leave the run meet zeros."""
        n, f = len(rows), self.shape.filters
        product, out = rows @ self.filters, np.zeros((n, self.shape.pooled), np.float32)
        for i, j, at in self.blocks():
            out[: n - j, i * f : (i + 1) * f] += product[j:, at : at + f]
        return out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.shift, 0) @ self.weights + self.bias[0]


class WordVectors:
    """Place of each word in a table of vectors. Place 0 is the zero vector; the table starts anew beyond `limit` words."""

    def __init__(self, model: TextCnn, limit: int = 300_000):
        self.model, self.limit = model, limit
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((1, self.model.shape.size), np.float32)

    def places(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.known))
        size = len(self.known) + 1
        if size + len(new) > len(self.table):
            grown = np.zeros((max(2 * len(self.table), size + len(new)), self.model.shape.size), np.float32)
            grown[:size] = self.table[:size]
            self.table = grown
        if new:
            self.table[size : size + len(new)] = self.model.vectors(*word_parts(new, self.model.shape))
            self.known.update(zip(new, range(size, size + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))


def runs(text: str, gap: int) -> Iterator[tuple[list[str], bool]]:
    """The words of a text in runs of WORDS at most, and whether a run is the last; the last `gap` words of each stand in the next one too."""
    held: list[str] = []
    for words in pieces(text):
        for a in range(0, len(words), WORDS):
            if held:
                yield held, False
            held = held[max(0, len(held) - gap) :] + words[a : a + WORDS]
    if held:
        yield held, True


def pooled(model: TextCnn, vectors: WordVectors, texts: list[str]) -> np.ndarray:
    """Greatest response of each filter in each whole text; texts without words have 0 throughout."""
    gap = max(model.shape.widths) - 1
    out = np.full((len(texts), model.shape.pooled), -np.inf, np.float32)
    words: list[str] = []
    owners, sizes, lasts = [], [], []

    def flush() -> None:
        if len(vectors.known) > vectors.limit:
            vectors.clear()
        # Each run ends in zeros (the vector at place 0), so that no window reaches into the next.
        ends = np.cumsum([n + gap for n in sizes])
        begin = np.concatenate(([0], ends[:-1]))
        places = np.zeros(ends[-1], np.int32)
        places[np.arange(len(words)) + gap * np.repeat(np.arange(len(sizes)), sizes)] = vectors.places(words)
        found = model.responses(vectors.table[places])
        for first, end, last in zip(begin, ends, lasts, strict=True):
            # Windows start at words; those that the text goes on from are whole in the next run only.
            found[max(first, end - gap * (1 if last else 2)) : end] = -np.inf
        np.maximum.at(out, owners, np.maximum.reduceat(found, begin))

    for i, text in enumerate(texts):
        for run, last in runs(text, gap):
            words += run
            owners.append(i)
            sizes.append(len(run))
            lasts.append(last)
            if len(words) >= WORDS:
                flush()
                words, owners, sizes, lasts = [], [], [], []
    if words:
        flush()
    return np.where(np.isfinite(out), out, 0)


class Adagrad:
    """Steps that shrink with what each parameter has moved; rows of the embedding step only when met."""

    def __init__(self, parameters: list[np.ndarray], rate: float):
        self.parameters, self.rate = parameters, rate
        self.sums = [np.full(p.shape, 1e-3, np.float32) for p in parameters]

    def step(self, k: int, gradient: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        self.sums[k][rows] += gradient * gradient
        self.parameters[k][rows] -= self.rate * gradient / np.sqrt(self.sums[k][rows])


def numbered(texts: list[str], shape: Shape) -> tuple[list[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each text as a run of word numbers, and of each word its parts: all of them, where each word's begin and end."""
    known: dict[str, int] = {}
    documents = []
    for text in texts:
        runs = [np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32) for words in pieces(text)]
        documents.append(np.concatenate([np.zeros(0, np.int32), *runs]))
    parts, starts = word_parts(list(known), shape) if known else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    return documents, (parts, starts, np.append(starts, len(parts)))


def go_through(model: TextCnn, adagrad: Adagrad, texts: list[str], labels: np.ndarray, weigh: np.ndarray, rng: np.random.Generator, *, epochs: int = 1, batch: int = 32, drop: float = 0.5) -> None:
    """Steps over all texts, `epochs` times. Memory: 4 bytes a word, and the distinct words."""
    documents, words = numbered(texts, model.shape)
    gap = max(model.shape.widths) - 1
    for _ in range(epochs):
        # Texts of like length share a batch, batches come in random order.
        order = sorted(rng.permutation(len(texts)), key=lambda i: len(documents[i]) // 64)
        batches = [order[a : a + batch] for a in range(0, len(order), batch)]
        for b in rng.permutation(len(batches)):
            chosen = [i for i in batches[b] if len(documents[i])]
            if chosen:
                learn(model, adagrad, [documents[i] for i in chosen], labels[chosen], weigh[chosen], words, gap, rng if drop else None, drop)


def train(texts: list[str], labels: np.ndarray, shape: Shape, *, epochs: int = 5, least: int = 500, batch: int = 32, rate: float = 0.1, drop: float = 0.5, seed: int = 7) -> TextCnn:
    """A model of the texts' labels (0 or 1), classes weighed alike; deterministic. Memory: as in `go_through`.

    Each step leaves out a share `drop` of the words, so that a document's label isn't learned from one chance word.
    Few texts are gone through more often, so that at least `least` steps are made.
    """
    model, rng = TextCnn(shape, seed), np.random.default_rng(seed)
    share = np.array([max(1, (labels == c).sum()) for c in (0, 1)]) / len(labels)
    epochs = max(epochs, -(-least * batch // max(1, len(texts))))
    go_through(model, Adagrad(model.parameters(), rate), texts, labels, 0.5 / share[labels.astype(int)], rng, epochs=epochs, batch=batch, drop=drop)
    return model


def learn(model: TextCnn, adagrad: Adagrad, documents: list[np.ndarray], labels: np.ndarray, weigh: np.ndarray, words: tuple[np.ndarray, np.ndarray, np.ndarray], gap: int, rng: np.random.Generator | None, drop: float) -> None:
    """One step over a batch of documents, each a run of word numbers."""
    parts, starts, ends = words
    f, shape = model.shape.filters, model.shape
    met, inverse = np.unique(np.concatenate(documents), return_inverse=True)
    counts = ends[met + 1] - starts[met]
    firsts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    own = parts[np.arange(counts.sum()) - np.repeat(firsts - starts[met], counts)]
    table = np.concatenate((np.zeros((1, shape.size), np.float32), model.vectors(own, firsts)))
    zeros, runs, at = np.zeros(gap, np.int64), [], 0
    for d in documents:
        runs += [inverse[at : at + len(d)] + 1, zeros]
        at += len(d)
    places = np.concatenate(runs)
    if rng is not None:
        places[rng.random(len(places)) < drop] = 0
    begin = np.cumsum([0, *(len(d) + gap for d in documents)])
    out = model.responses(table[places])
    won = np.stack([out[a : b - gap].argmax(axis=0) + a for a, b in pairwise(begin)])
    best = out[won, np.arange(shape.pooled)]
    active = best + model.shift > 0
    hidden = np.where(active, best + model.shift, 0)
    error = (weigh * (1 / (1 + np.exp(-(hidden @ model.weights + model.bias[0]))) - labels) / len(labels)).astype(np.float32)
    back = error[:, None] * model.weights * active  # documents x pooled
    d_filters, d_table = np.zeros_like(model.filters), np.zeros_like(table)
    for i, j, column in model.blocks():
        # A window at the very end of the batch may reach past it, where there are zeros.
        at = places[np.minimum(won[:, i * f : (i + 1) * f] + j, len(places) - 1)]
        for k in range(f):
            b = back[:, i * f + k]
            d_filters[:, column + k] = b @ table[at[:, k]]
            np.add.at(d_table, at[:, k], b[:, None] * model.filters[:, column + k])
    moved = np.flatnonzero(np.abs(d_table[1:]).sum(axis=1))
    if len(moved):
        rows = np.concatenate([own[firsts[m] : firsts[m] + counts[m]] for m in moved])
        each = np.repeat(d_table[1 + moved] / np.sqrt(counts[moved])[:, None], counts[moved], axis=0).astype(np.float32)
        distinct, place = np.unique(rows, return_inverse=True)
        summed = np.zeros((len(distinct), shape.size), np.float32)
        np.add.at(summed, place, each)
        adagrad.step(0, summed, distinct)
    adagrad.step(1, d_filters)
    adagrad.step(2, back.sum(axis=0))
    adagrad.step(3, error @ hidden)
    adagrad.step(4, error.sum(keepdims=True))
