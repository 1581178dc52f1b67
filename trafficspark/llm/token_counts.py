"""Exact token counts of every prefix of a text, without encoding it again.

Prefix dynamic programming over BPE: the encoding of a prefix ends in the one token whose pair with the last
token of the shorter prefix is stable (BPE over the two tokens together gives back the two). `PrefixTable`
fills this in from left to right, so each prefix costs one lookup of an earlier one. A document has the running
count at the end of each run between white space; the table answers inside a run.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficspark.llm import wordpieces

END = "</w>"
BYTE_OF = {c: b for b, c in enumerate(wordpieces.SYMBOL)}
RUN = re.compile(r"\S+")


class PrefixTable:
    """Counts for every prefix of a piece, in lists by place, so that memory is linear in its length.

    Prefixes of up to `shared` symbols are kept for other pieces that begin alike, `limit` of them at most.
    """

    def __init__(self, tokenizer, limit: int = 1_000_000, shared: int = 24):
        import json

        model = json.loads(tokenizer.to_str())["model"]
        self.vocab = set(model["vocab"])
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        #: by the last two symbols (and the word end) of a token: symbols in the longest such token
        self.reach: dict[str, int] = {}
        for t in self.vocab:
            body = t.removesuffix(END)
            key = body[-2:] + t[len(body) :]
            self.reach[key] = max(len(body), self.reach.get(key, 2))
        self.limit, self.shared = limit, shared
        self.stable: dict[tuple[str, str], bool] = {}
        self.made: dict[str, tuple[str, str] | None] = {}
        self.edges: dict[tuple[str, int], list | None] = {}
        #: prefix without word end: its last token and its count
        self.open: dict[str, tuple[str, int]] = {}

    def parts(self, token: str) -> tuple[str, str] | None:
        """The last merge of BPE over the token alone: None for a single symbol; ("", "") if it stays in pieces."""
        if token not in self.made:
            body, end = token.removesuffix(END), token.endswith(END)
            symbols = list(body)
            if end:
                symbols[-1] += END
            pair = None
            while len(symbols) > 1:
                best, at = min((self.rank.get((a, b), len(self.rank)), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)))
                if best == len(self.rank):
                    pair = ("", "")
                    break
                pair = (symbols[at], symbols[at + 1])
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            self.made[token] = pair
        return self.made[token]

    def spine(self, token: str, side: int) -> list[tuple[str, float]] | None:
        """The tokens that stand at one edge (0 left, 1 right) while BPE builds the token, each with the rank of
        the merge that takes it in; None if BPE doesn't build the token."""
        key = (token, side)
        if key not in self.edges:
            out, taken = [], float("inf")
            while token:
                out.append((token, taken))
                if not (pair := self.parts(token)):
                    break
                taken, token = self.rank.get(pair, 0), pair[side]
            self.edges[key] = out if token else None
        return self.edges[key]

    def fits(self, left: str, right: str) -> bool:
        """Whether `right` can follow `left`: BPE over both gives just these two; left is empty at the start.

        Merges apply in the order of rank and each part has a lower rank than its whole. So the two stay apart
        unless, at the edge between them, some pair of parts has a merge before either part is taken in by its
        own side; of equal merges, the leftmost goes first.
        """
        b = self.spine(right, 0)
        if not left or b is None:
            return b is not None
        key = (left, right)
        if (known := self.stable.get(key)) is None:
            if len(self.stable) > self.limit:
                self.stable.clear()
            rank, never = self.rank, float("inf")
            known = self.stable[key] = not any((q := rank.get((x, y), never)) < rx and q <= ry for x, rx in self.spine(left, 1) for y, ry in b if (x, y) in rank)
        return known

    def last(self, symbols: str, size: int, end: str, tokens: list[str], counts: list[int]) -> tuple[str, int]:
        """Last token and count of the first `size` symbols, from the last tokens and counts of all shorter prefixes."""
        vocab = self.vocab
        for start in range(max(0, size - self.reach.get(symbols[max(0, size - 2) : size] + end, 2)), size):
            token = symbols[start:size] + end
            if token in vocab and self.fits(tokens[start], token):
                return token, counts[start] + 1
        raise ValueError(f"no token ends {symbols[max(0, size - 50) : size]!r}")

    def fill(self, symbols: str, size: int) -> tuple[list[str], list[int]]:
        """Last token and count of the prefixes of 0 to `size` symbols, none of them at a word's end."""
        tokens, counts = [""], [0]
        if len(self.open) > self.limit:
            self.open.clear()
        for i in range(1, size + 1):
            known = self.open.get(symbols[:i]) if i <= self.shared else None
            if known is None:
                known = self.last(symbols, i, "", tokens, counts)
                if i <= self.shared:
                    self.open[symbols[:i]] = known
            tokens.append(known[0])
            counts.append(known[1])
        return tokens, counts

    def count(self, piece: str) -> int:
        """Tokens of a whole piece."""
        return self.count_symbols(wordpieces.symbols(piece))

    def count_symbols(self, symbols: str) -> int:
        tokens, counts = self.fill(symbols, len(symbols) - 1)
        return self.last(symbols, len(symbols), END, tokens, counts)[1]

    def prefixes(self, piece: str) -> list[int]:
        """Tokens of each prefix of the piece, by characters, as if the text ended there; the first is 0."""
        ends = accumulate(map(len, piece if piece.isascii() else map(str.encode, piece)))
        return self.prefixes_at(wordpieces.symbols(piece), list(ends))

    def prefixes_at(self, symbols: str, ends: list[int]) -> list[int]:
        """Tokens of the prefixes that end at these symbols, after a first 0."""
        tokens, counts = self.fill(symbols, len(symbols) - 1)
        return [0, *(self.last(symbols, i, END, tokens, counts)[1] for i in ends)]


def white(c: str) -> bool:
    """Whether the library takes a character for white space, which it drops."""
    return c.isspace() and c not in wordpieces.ODD


def joined(a: str, b: str) -> bool:
    """Whether the normal form of a text may not be cut between two of its characters: they make one, or one space."""
    if white(a) and white(b):
        return True
    nfc = unicodedata.normalize
    return not b.isascii() and (unicodedata.combining(b) > 0 or nfc("NFC", a + b) != nfc("NFC", a) + nfc("NFC", b))


class Counter:
    """Counts for whole texts and their prefixes, by the runs between white space and the pieces of each."""

    def __init__(self, path: str):
        self.tokenizer = wordpieces.load(path)
        self.table = PrefixTable(self.tokenizer)
        # A line feed, which closes each run, counts as -1.
        self.pieces = wordpieces.Cache(lambda new: [-1 if p == "\n" else self.table.count(p) for p in new], limit=1_500_000)
        self.runs = wordpieces.Cache(self.of_runs)
        self.special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}

    def of_runs(self, new: list[str]) -> list[int]:
        pieces, others = wordpieces.pieces_of_runs(new)
        counts = np.array(self.pieces.of(pieces), np.int64)
        closed = counts < 0
        sums = np.cumsum(np.where(closed, 0, counts))[closed]
        plain = np.diff(sums, prepend=0).tolist()
        if not others:
            return plain
        told, in_order = {r: self.of_other_run(r) for r in others}, iter(plain)
        return [told[r] if r in told else next(in_order) for r in new]

    def of_other_run(self, run: str) -> int:
        """Count of a run that isn't plain, split by the library; a special string is one token."""
        count = 0
        for part in re.split("(" + "|".join(map(re.escape, sorted(self.special))) + ")", run):
            if part in self.special:
                count += 1
            elif part:
                count += sum(self.table.count_symbols(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part)))
        return count

    def total(self, text: str) -> int:
        return sum(self.runs.of(wordpieces.runs(text)))

    def running(self, text: str) -> tuple[list[int], list[int]]:
        """Ends of the runs (in characters) and the count of the prefix up to each."""
        found = wordpieces.runs(text)
        if len(found) == 1:
            return [len(text)], self.runs.of(found)
        return [m.end() for m in RUN.finditer(text)], list(accumulate(self.runs.of(found)))

    def of_prefix(self, text: str, cut: int, running: tuple[list[int], list[int]] | None = None) -> int:
        """Tokens of text[:cut], from the stored counts of earlier runs and the table for the run that is cut."""
        ends, counts = running or self.running(text)
        k = bisect_right(ends, cut)
        # A cut can join nothing to an earlier run; only the run it goes through is split anew.
        return (counts[k - 1] if k else 0) + sum(self.of_runs(wordpieces.runs(text[ends[k - 1] if k else 0 : cut])))

    def longest_prefix(self, text: str, budget: int, running: tuple[list[int], list[int]] | None = None) -> int:
        """Most characters of the text that take `budget` tokens at most, as if the text ended there, never between
        characters that normal form may join. Read from the stored counts up to the run that is cut, then from the table."""
        ends, counts = running or self.running(text)
        k = bisect_right(counts, budget)
        if k == len(counts):
            return len(text)
        at, left = (ends[k - 1], budget - counts[k - 1]) if k else (0, budget)
        run = text[at : ends[k]]
        at += self.cut_run(run, left)
        end = at
        while end < len(text) and white(text[end]):  # takes no token
            end += 1
        return end - 1 if at < end < len(text) and joined(text[end - 1], text[end]) else end

    def cut_run(self, run: str, left: int) -> int:
        """Most characters of a run (with what white space is in it) that take `left` tokens at most, where all of it takes more."""
        special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        at = 0
        for m in [*special.finditer(run), None]:
            part = run[at : m.start() if m else len(run)]
            taken, cut = self.cut_part(part, left)
            left, at = left - taken, at + cut
            if cut < len(part) or m is None:
                return at
            if not left:
                # Cut inside, a special string is ordinary text, which may join what stands before it.
                most = self.of_prefix(run, at)
                return next((c for c in range(m.end() - 1, at, -1) if self.of_prefix(run, c) <= most), at)
            left, at = left - 1, m.end()
        return at

    def cut_part(self, part: str, left: int) -> tuple[int, int]:
        """Tokens and characters of the longest prefix of ordinary text within `left` tokens."""
        normal = self.tokenizer.normalizer.normalize_str
        known = dict(zip(*self.joints(part, normal), strict=True))  # place in normal form to place in the text
        taken, best = 0, 0
        for piece, (begin, end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal(part)):
            inside = self.inside(piece)
            # Byte-level pieces have a symbol a byte; joints tell which of them end a character of the text.
            for place, count in zip(range(begin, end + 1), inside, strict=True):
                if taken + count <= left and known.get(place, -1) >= best:
                    best = known[place]
            if taken + inside[-1] > left:
                return taken, best
            taken += inside[-1]
        return taken, len(part)

    def joints(self, part: str, normal) -> tuple[list[int], list[int]]:
        """Places of a text's normal form, and of the text, where the two can be cut alike."""
        cuts = [i for i in range(1, len(part)) if not joined(part[i - 1], part[i])]
        cuts = [0, *cuts, len(part)] if part else [0]
        sizes = [len(normal(part[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]
        return list(accumulate(sizes, initial=0)), cuts

    def inside(self, symbols: str) -> list[int]:
        """Tokens of each prefix of a piece in normal form, by characters, as if the text ended there."""
        text = bytes(map(BYTE_OF.__getitem__, symbols)).decode()
        found = self.table.prefixes_at(symbols, list(accumulate(len(c.encode()) for c in text)))
        if len(text) == 3 and text[0] == "'" and text[1:].isalpha():  # without its last letter a contraction is a quote and a letter
            found[2] = found[1] + self.table.count(text[1])
        return found


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, prefixes: bool = False, budgets: tuple[int, ...] = ()) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    `prefixes` adds prefix_ends and prefix_tokens (arrays: the end of each run between white space in characters,
    tokens up to there); each of `budgets` adds chars_<budget>, the length of the longest prefix
    within that many tokens, in any script. All are read from the running counts of a text. A null text counts as empty: 0 bytes and tokens. Very long texts and words take memory
    in proportion to their length. Repeated rows are counted each; null ids stay null; other columns are ignored.
    An empty table gives an empty result. No shuffle: one pass over the texts.
    """
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    schema += ", prefix_ends array<int>, prefix_tokens array<int>" * prefixes + "".join(f", chars_{b} int" for b in budgets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = [list(accumulate(c.runs.of(wordpieces.runs(t)))) for t in texts]
            totals = [k[-1] if k else 0 for k in counts]
            columns = [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(totals, pa.int64()), pa.array([n > limit for n in totals], pa.bool_())]
            if prefixes:
                kept = [c.running(t) for t in texts]
                columns += [pa.array([k[i] for k in kept], pa.list_(pa.int32())) for i in (0, 1)]
            columns += [pa.array([len(t) if n <= b else c.longest_prefix(t, b) for t, n in zip(texts, totals, strict=True)], pa.int32()) for b in budgets]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", *["prefix_ends", "prefix_tokens"] * prefixes, *(f"chars_{b}" for b in budgets)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
