"""Repeated-substring removal with a sparse, externally sorted suffix array.

Induced sorting sorts a thinned set of suffixes first and derives all others from it. The thinned set here is
chosen by content, so that it can be found in one pass over texts on many machines: in every window of
`length` bytes the `gram` with the least hash is its anchor, and equal windows have equal anchors at equal
offsets. About one suffix in 170 is an anchor's. Anchors whose gram occurs once are done. For the rest, Spark's
external sort (spilling sorted runs and merging them) orders the suffixes at the anchors within each gram, each
with the bytes before it; the common-prefix lengths of neighbours in that order, and in the order of the
reversed bytes before the anchor, then decide every window around the anchor: windows that start o bytes before
their anchors are equal if the suffixes share length - o bytes and the bytes before share o.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficspark.llm import common

GRAM = 64
#: Distinct contexts of one gram that a task compares at a time; grams with more are decided by a shuffle of their windows.
GROUP = 1 << 16
PIECE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
POSITION = np.uint64((1 << 22) - 1)


def byte_values() -> np.ndarray:
    """A fixed 64-bit value for each byte."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    x ^= x >> np.uint64(29)
    return (x * np.uint64(0x94D049BB133111EB)) | np.uint64(1)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[int, tuple] = {}


def rolling(data: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of n bytes, by differences of a running polynomial sum modulo 2**64, mixed."""
    size = len(data)
    if seed not in _tables or len(_tables[seed][1]) <= size:
        base = BASE + np.uint64(seed * 2)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        room = max(size + 1, 1 << 16)
        _tables[seed] = byte_values(), powers(base, room), powers(inverse, room)
    values, up, down = _tables[seed]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data] * up[:size])))
    h = (sums[n:] - sums[:-n]) * down[: size - n + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def window_anchor(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` hashes, the place of its least (the leftmost of equals)."""
    n = len(hashes)
    keyed = np.full(-(-n // width) * width, ~np.uint64(0), np.uint64)
    keyed[:n] = (hashes & ~POSITION) | np.arange(n, dtype=np.uint64)
    blocks = keyed.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(back[: n - width + 1], ahead[width - 1 : n]) & POSITION).astype(np.int64)


def anchors(text: bytes, lengths: tuple[int, ...]) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """For each length, piece by piece: hash (each length has its own), pos, lo, hi: anchors and the first and last start of the windows they stand for."""
    for at in range(0, max(0, len(text) - min(lengths) + 1), PIECE):
        data = np.frombuffer(text, np.uint8, min(PIECE + max(lengths) - 1, len(text) - at), at)
        hashes = rolling(data, GRAM)
        for length in lengths:
            windows = min(PIECE, len(text) - at - length + 1)
            if windows > 0:
                place = window_anchor(hashes[: windows + length - GRAM], length - GRAM + 1)
                first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
                last = np.concatenate((first[1:] - 1, [len(place) - 1]))
                named = hashes[place[first]] ^ np.uint64(length * 0x9E3779B97F4A7C15 % (1 << 64))
                yield length, (named.view(np.int64), place[first] + at, first + at, last + at)


def common_prefix(a: bytes, b: bytes) -> int:
    """Bytes that a and b share at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x))


def repeated_offsets(rights: list[bytes], lefts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(member, first, last) for runs of offsets o whose window (o bytes of left, length - o of right) another member has.

    rights are in suffix order; lefts are the reversed bytes before.
    """
    m = len(rights)
    right_lcp = np.array([0, *(common_prefix(rights[i], rights[i + 1]) for i in range(m - 1))])
    order = sorted(range(m), key=lefts.__getitem__)
    left_lcp = np.array([0, *(common_prefix(lefts[order[i]], lefts[order[i + 1]]) for i in range(m - 1))])
    most = min(max(map(len, lefts)), length - GRAM)
    if m == 2:
        low, high = max(0, length - int(right_lcp[1])), min(most, int(left_lcp[1]))
        return [(0, low, high), (1, low, high)] if low <= high else []
    back = np.empty(m, np.int64)
    back[order] = np.arange(m)
    hit = np.zeros((m, most + 1), bool)
    step = max(1, (1 << 19) // m)
    for at in range(0, most + 1, step):
        o = np.arange(at, min(at + step, most + 1))[:, None]
        by_right = np.cumsum(right_lcp[None, :] < length - o, axis=1)
        by_left = np.cumsum(left_lcp[None, :] < o, axis=1)[:, back]
        pair = by_right * (m + 1) + by_left
        turn = np.argsort(pair, axis=1, kind="stable")
        ranked = np.take_along_axis(pair, turn, axis=1)
        same = ranked[:, 1:] == ranked[:, :-1]
        flags = np.zeros(pair.shape, bool)
        flags[:, 1:] |= same
        flags[:, :-1] |= same
        back_flags = np.empty_like(flags)
        np.put_along_axis(back_flags, turn, flags, axis=1)
        hit[:, at : at + len(o)] = back_flags.T
    # A window needs o bytes before the anchor and length - o from it on; shorter contexts share no class.
    left_size, right_size = np.array([len(x) for x in lefts]), np.array([len(x) for x in rights])
    o = np.arange(most + 1)
    hit &= (o[None, :] <= left_size[:, None]) & (length - o[None, :] <= right_size[:, None])
    edges = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    start_member, start = np.nonzero(edges == 1)
    _, end = np.nonzero(edges == -1)
    return list(zip(start_member.tolist(), start.tolist(), (end - 1).tolist(), strict=True))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on doc_id (null equals null) and mark, alike wherever it is used, so that a shuffle of texts is made once."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["mark"] == right["mark"])


def find_repeats(docs: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """doc_id, mark, length, start, end: for each length, stretches of bytes covered by strings of so many bytes that start elsewhere too."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [part[0] for text in batch.column(0).to_pylist() for _, part in anchors(text, lengths)]
            if found:
                grams, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n)], ["gram", "n"])

    # Written, so that the join has nothing but its two sides in its stage and can be dealt anew where a gram is hot.
    several = docs.select("bytes").mapInArrow(count_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    several = common.stored(several, "grams")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            parts, rows, sizes, names = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for length, part in anchors(text, lengths):
                    parts.append(part)
                    rows.append(np.full(len(part[0]), i))
                    sizes.append(np.full(len(part[0]), length, np.int32))
                    names += [xxhash.xxh3_128_digest(text[lo : hi + length], pos - lo) for pos, lo, hi in zip(*(c.tolist() for c in part[1:]), strict=True)]
            if parts:
                at = pa.array(np.concatenate(rows))
                found = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
                hashes = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(sizes)), *found, pa.array(hashes[:, 0]), pa.array(hashes[:, 1])], ["doc_id", "mark", "length", "gram", "pos", "lo", "hi", "h1", "h2"])

    placed = docs.mapInArrow(scan, f"doc_id {kind}, mark long, length int, gram long, pos long, lo long, hi long, h1 long, h2 long")
    held = common.stored(placed.join(several, "gram"), "anchors")

    # Contexts (all bytes of an anchor's windows) by their hash: those that occur again repeat in all their windows.
    me = F.struct("doc_id", "mark", "pos", "lo", "hi")
    distinct = held.groupBy("gram", "length", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(me).alias("rep"))
    distinct = common.stored(distinct, "contexts")
    groups = common.stored(distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "groups")
    whole = held.join(distinct.where("n > 1").select("gram", "h1", "h2"), ["gram", "h1", "h2"]).select("doc_id", "mark", "length", F.col("lo").alias("start"), (F.col("hi") + F.col("length")).alias("end"))
    # One of each context goes on to be compared with the others of its gram.
    ours = distinct.select("gram", "length", "rep.*").join(groups, "gram")
    by_doc = ours.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("gram", "length", "pos", "lo", "hi", "m")).alias("anchors"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set = set()
            for doc_id, mark, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (doc_id, mark) in seen:  # repeated rows stand next to each other, or their contexts equal each other and are met as such
                    continue
                seen.add((doc_id, mark))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id] * n, batch.schema.field(0).type), pa.array([mark] * n, pa.int64()), *(pa.array([x[c] for x in found], k) for c, k in (("length", pa.int32()), ("gram", pa.int64()), ("pos", pa.int64()), ("m", pa.int64()))),
                        pa.array([text[x["lo"] : x["pos"]][::-1] for x in found], pa.binary()), pa.array([text[x["pos"] : x["hi"] + x["length"]] for x in found], pa.binary()),
                    ],
                    ["doc_id", "mark", "length", "gram", "pos", "m", "left", "right"],
                )

    joined = docs.join(by_doc, same_row(docs, by_doc)).select(docs["doc_id"], docs["mark"], docs["bytes"], by_doc["anchors"])
    around = joined.mapInArrow(contexts, f"doc_id {kind}, mark long, length int, gram long, pos long, m long, left binary, right binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, held, types = None, [], None

        def decide() -> pa.RecordBatch | None:
            runs = repeated_offsets([r["right"] for r in held], [r["left"] for r in held], held[0]["length"]) if len(held) > 1 else []
            if not runs:
                return None
            rows = [(held[i]["doc_id"], held[i]["mark"], held[i]["length"], held[i]["pos"] - last, held[i]["pos"] - first + held[i]["length"]) for i, first, last in runs]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["doc_id", "mark", "length", "start", "end"])

        for batch in batches:
            types = [batch.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            for row in batch.to_pylist():
                if row["gram"] != gram:
                    if (out := decide()) is not None:
                        yield out
                    gram, held = row["gram"], []
                held.append(row)
        if held and (out := decide()) is not None:
            yield out

    spans = f"doc_id {kind}, mark long, length int, start long, end long"
    columns = ["gram", "doc_id", "mark", "length", "pos", "left", "right"]
    partly = around.where(F.col("m") <= GROUP).select(columns).repartition("gram").sortWithinPartitions("gram", "right").mapInArrow(compare, spans)
    if groups.where(F.col("m") > GROUP).isEmpty():
        return whole.unionByName(partly)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                data = np.frombuffer(row["left"][::-1] + row["right"], np.uint8)
                starts = np.arange(len(data) - row["length"] + 1) + row["pos"] - len(row["left"])
                at = pa.array([i] * len(starts))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in (1, 2, 3)), pa.array(starts), pa.array(rolling(data, row["length"]).view(np.int64)), pa.array(rolling(data, row["length"], 1).view(np.int64))], ["doc_id", "mark", "length", "start", "w1", "w2"])

    single = around.where(F.col("m") > GROUP).select(columns).mapInArrow(windows, f"doc_id {kind}, mark long, length int, start long, w1 long, w2 long")
    twice = single.groupBy("length", "w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("length", "w1", "w2")
    hot = single.join(twice, ["length", "w1", "w2"]).select("doc_id", "mark", "length", "start", (F.col("start") + F.col("length")).alias("end"))
    return whole.unionByName(partly).unionByName(hot)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 400, passage: int = 200, passage_words: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (start, end), n_passages and kept (bytes) for every row.

    Every byte goes that is covered by a string of `length` bytes which also starts anywhere else in the
    input, in the same document or another; matches lie within documents. n_passages says how many stretches of
    more than passage_words words are covered by strings of `passage` bytes which also start elsewhere: repeated
    passages that may be too short to be removed. Null texts count as empty; texts shorter than `length` stay whole,
    and very long ones are gone through piece by piece. Repeated rows are copies of each other, so all their
    strings repeat. Null ids are fine; an empty table gives an empty result; other columns are ignored. kept is
    binary, for a stretch may begin or end inside a character.
    """
    whole = docs.select(F.col(id_col).alias("doc_id"), common.binary_large(F.col(text_col)).alias("bytes")).select("doc_id", F.xxhash64("bytes").alias("mark"), "bytes")
    kind = whole.schema["doc_id"].dataType.simpleString()
    lengths = (length, passage) if passage != length else (length,)
    spans = find_repeats(whole, lengths).groupBy("doc_id", "mark").agg(F.collect_set(F.struct("length", "start", "end")).alias("spans"))
    joined = whole.join(spans, same_row(whole, spans), "left").select(whole["doc_id"], whole["bytes"], spans["spans"])

    def runs_of(found: list[dict] | None, size: int) -> list[list[int]]:
        runs: list[list[int]] = []
        for start, end in sorted((s["start"], s["end"]) for s in found or () if s["length"] == size):
            if runs and start <= runs[-1][1]:
                runs[-1][1] = max(end, runs[-1][1])
            else:
                runs.append([start, end])
        return runs

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, merged, passages, kept = [], [], [], [], []
            for data, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                runs = runs_of(found, length)
                edges = [0, *(x for r in runs for x in r), len(data)]
                sizes.append(len(data))
                removed.append(sum(e - s for s, e in runs))
                merged.append([{"start": s, "end": e} for s, e in runs])
                passages.append(sum(len(data[s:e].split()) > passage_words for s, e in runs_of(found, passage)))
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(m) for m in merged], pa.int64()), pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(passages, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "n_passages", "kept"])

    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, n_passages long, kept binary")
