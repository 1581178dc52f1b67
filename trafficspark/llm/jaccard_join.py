"""Exact n-gram Jaccard join over pivots, Voronoi regions and triangle-inequality windows, with its groups as components.

Jaccard distance is a metric, but most texts are at distance 1 from each other, where distances to pivots tell
nothing. So the join first finds who may be near: sets that reach the threshold share some of their first shingles
in a fixed order (frequent ones last), and sets of like size that share any, directly or through others, make up a
cell. In a cell some members are pivots, and every member belongs to the Voronoi region of its nearest pivot. If two members
are within the radius r of each other, each is at most 2 r farther from the other's pivot than from its own; so a
member is replicated to the regions of earlier pivots within that window, and every pair meets in one region. The
regions are joined in the same way, by pivots of their own. Pairs that links already join needn't be looked at.

A cell that one task can take is joined there; larger ones are cut on the cluster, round by round, until their
regions fit. Where rounds take off little, as in texts of one template, all about as far from each other,
the sets that share one first shingle are a cell, dealt in blocks and pairs of blocks if it is large.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficspark.llm import common
from trafficspark.llm.components import components

#: Members of a cell that one task joins; larger cells get rounds on the cluster.
CELL = 2048
#: Pivots of a cell in a round on the cluster, and of a region within a task; a region of LEAF members is compared directly.
PIVOTS, INNER, LEAF = 24, 8, 48
#: A round that leaves more than this share of the members of large cells is the last one.
SHRINKS = 0.75
#: Shingles known as frequent, at most; they come last in order, and any order gives the same links.
FREQUENT = 200_000
#: Shingles that a task counts at a time, in search of frequent ones.
REPORTED = 8_000_000
#: Rows of representatives up to which they are sent to all tasks; beyond that, both sides are shuffled.
BROADCAST_ROWS = 500_000
#: Bytes that part words, A-Z lower-cased, and the first 0 to 8 bytes of 8. Words of more than LONG_WORD bytes are hashed one by one.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG_WORD = 64
#: Bytes of texts that are split at a time, so that what is made of them stays in the processor's cache.
PIECE = 500_000
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * B
    return x ^ (x >> np.uint64(29))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of all texts in a row (A-Z lower-cased), and how many words each text has."""
    import xxhash

    data = np.frombuffer(b"".join(texts), np.uint8)
    edges = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    some = edges[:-1] < edges[1:]
    space = SPACE[data]
    first = ~space
    last = first.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    # A text's first and last words begin and end there, whatever stands beside them.
    for at, marks in ((edges[:-1][some], first), (edges[1:][some] - 1, last)):
        marks[at] = ~space[at]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    low = np.zeros(len(data) // 8 * 8 + 16, np.uint8)
    low[: len(data)] = LOWER[data]
    eights = low.view("<u8")

    def part(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The next 8 bytes of each word, zeros after its end."""
        i, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        # The shift by 64 - bits goes in two, as one by 64 bits is none.
        return (eights[i] >> bits | eights[i + 1] << (np.uint64(63) - bits) << np.uint64(1)) & MASKS[np.minimum(left, 8)]

    h = mixed((mixed(sizes.astype(np.uint64) * A) + part(starts, sizes)) * A)
    at, more = 8, np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD))
    while len(more):
        left = sizes[more] - at
        h[more] = mixed((h[more] + part(starts[more] + at, left)) * A)
        at, more = at + 8, more[left > 8]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(low[starts[i] : starts[i] + sizes[i]])
    return h, np.diff(np.searchsorted(starts, edges))


def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles (A-Z lower-cased); of all words if they are fewer than k."""
    sets: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def add() -> None:
        ids, counts = word_hashes(held)
        begins = np.cumsum(counts) - counts
        h = np.full(max(0, len(ids) - k + 1), k, np.uint64)  # those across two texts are left out below
        for i in range(k):
            h = mixed((h + ids[i : len(h) + i]) * A)
        for a, n in zip(begins.tolist(), counts.tolist(), strict=True):
            if n >= k:
                h[a : a + n - k + 1].sort()
        new = np.concatenate((np.full(min(1, len(h)), True), h[1:] != h[:-1]))
        new[begins[counts >= k]] = True
        for a, n in zip(begins.tolist(), counts.tolist(), strict=True):
            if n >= k:
                sets.append(h[a : a + n - k + 1][new[a : a + n - k + 1]])
                continue
            one = np.full(min(1, n), n, np.uint64)
            for i in range(n):
                one = mixed((one + ids[a + i]) * A)
            sets.append(one)

    for t in texts:
        held.append(t or b"")
        size += len(held[-1])
        if size >= PIECE:
            add()
            held, size = [], 0
    if held:
        add()
    return sets


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """`shingle_sets` of one text."""
    return shingle_sets([text], k)[0]


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed integers."""
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist())


def meetings(n: int) -> int:
    """Shared first shingles that are asked for, of sets of n: more of them cost longer prefixes and tell apart
    documents that have no more than a passage in common."""
    return 1 + n // 20


def prefix_size(n: int, num: int, den: int) -> int:
    """First shingles of a set of n among which any two sets at the threshold share `meetings` of the smaller:
    they share num / den of the larger at least, so at most n - that are missing before."""
    return min(n, n - -(-num * n // den) + meetings(n))


class Cell:
    """Links among the members of a cell, by Voronoi regions; pairs that links already join aren't looked at, nor are
    pairs of one side (0 is on no side)."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int, sides: list[int] | None = None, groups: np.ndarray | None = None):
        self.num, self.den, self.sizes = num, den, np.array([len(s) for s in sets])
        self.radius = 1 - num / den + 1e-9
        self.sides = np.array(sides) if sides else np.zeros(len(sets), np.int64)
        self.group = np.arange(len(sets)) if groups is None else groups.copy()
        # Values that one member alone has add to no intersection; most go by a table of hashes, before the sort.
        every = np.concatenate(sets)
        # The table grows with the cell, as most cells hold a few sets.
        slots = (every >> np.uint64(40)).astype(np.int64) & ((1 << min(22, (4 * len(every)).bit_length())) - 1)
        often = np.bincount(slots)[slots] > 1
        values, ids, counts = np.unique(every[often], return_inverse=True, return_counts=True)
        often[often] = (counts > 1)[ids]
        self.ids = (np.cumsum(counts > 1) - 1)[ids[(counts > 1)[ids]]]
        self.counts = np.bincount(np.repeat(np.arange(len(sets)), self.sizes)[often], minlength=len(sets))
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))
        self.mark = np.zeros(int((counts > 1).sum()), np.int32)

    def held(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shared values of all members in a row, and where each begins and the last ends."""
        counts = self.counts[members]
        edges = np.concatenate(([0], np.cumsum(counts)))
        return self.ids[np.repeat(self.starts[members] - edges[:-1], counts) + np.arange(edges[-1])], edges

    def shared(self, p: int, values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """How many values of member p each of the held members has."""
        mine = self.ids[self.starts[p] : self.starts[p + 1]]
        self.mark[mine] = 1
        sums = np.concatenate(([0], np.cumsum(self.mark[values], dtype=np.int64)))
        self.mark[mine] = 0
        return sums[edges[1:]] - sums[edges[:-1]]

    def joined(self, p: int, others: np.ndarray, both: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links of p to those of the others (not of its side) that reach the threshold and aren't joined yet."""
        near = self.den * both >= self.num * (self.sizes[others] + self.sizes[p] - both)
        if self.sides[p]:
            near &= self.sides[others] != self.sides[p]
        for y in others[near].tolist():
            if self.group[y] != self.group[p]:
                yield p, y
                self.group[self.group == self.group[y]] = self.group[p]

    def links(self) -> Iterator[tuple[int, int]]:
        yield from self.region(np.arange(len(self.sizes)))

    def region(self, members: np.ndarray) -> Iterator[tuple[int, int]]:
        if len(members) < 2 or (self.group[members] == self.group[members[0]]).all():
            return
        if len(members) <= LEAF:
            yield from self.directly(members)
            return
        held = self.held(members)
        distances = []
        for p in members[np.linspace(0, len(members) - 1, INNER).astype(np.intp)].tolist():
            both = self.shared(p, *held)
            yield from self.joined(p, members, both)
            distances.append(1 - both / (self.sizes[members] + self.sizes[p] - both))
        d = np.array(distances)
        own = d.argmin(axis=0)
        window = d <= d.min(axis=0) + 2 * self.radius
        inside = [members[(own == i) | (window[i] & (own > i))] for i in range(len(d))]
        if max(map(len, inside)) > SHRINKS * len(members):
            yield from self.directly(members, d)
            return
        for some in inside:
            yield from self.region(some)

    def directly(self, members: np.ndarray, distances: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
        """All pairs that sizes and the windows around pivots leave open."""
        m, sizes = len(members), self.sizes[members]
        values, edges = self.held(members)
        often = np.bincount(values, minlength=len(self.mark)) > 1
        width = int(often.sum())
        if m > LEAF and width * m < 40_000_000 and width < 8 * edges[-1] / m:
            # Few values that any two share: products of their rows give all intersections.
            place = np.cumsum(often) - 1
            table = np.zeros((m, width), np.float32)
            told = often[values]
            table[np.repeat(np.arange(m), np.diff(edges))[told], place[values[told]]] = 1
            for at in range(0, m, 512):
                both = np.rint(table[at : at + 512] @ table.T).astype(np.int64)
                near = self.den * both >= self.num * (sizes[at : at + 512, None] + sizes[None, :] - both)
                near &= self.group[members][at : at + 512, None] != self.group[members][None, :]
                for i in np.flatnonzero(near.any(axis=1)).tolist():
                    others = np.flatnonzero(near[i])
                    yield from self.joined(int(members[at + i]), members[others], both[i, others])
            return
        for i in range(m - 1):
            p = int(members[i])
            fits = (self.group[members] != self.group[p]) & (self.den * np.minimum(sizes, sizes[i]) >= self.num * np.maximum(sizes, sizes[i]))
            fits[: i + 1] = False
            if distances is not None:
                fits &= (np.abs(distances - distances[:, i : i + 1]) <= self.radius).all(axis=0)
            if fits.any():
                others = members[fits]
                yield from self.joined(p, others, self.shared(p, *self.held(others)))


def voronoi(sets: list[np.ndarray], pivots: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """For each set and pivot: whether they are linked, and whether the set belongs to the pivot's region or is
    replicated to it (as one that belongs to a later pivot's and is within the window)."""
    both = np.array([[np.intersect1d(s, p, assume_unique=True).size for p in pivots] for s in sets])
    union = np.array([len(s) for s in sets])[:, None] + np.array([len(p) for p in pivots]) - both
    d = 1 - both / union
    own = d.argmin(axis=1)[:, None]
    turn = np.arange(len(pivots))
    inside = (turn == own) | ((turn < own) & (d <= d.min(axis=1, keepdims=True) + 2 * (1 - num / den) + 1e-9))
    return den * both >= num * union, inside


def block_pairs(regions: DataFrame) -> DataFrame:
    """cell, set_id, side from region, set_id: cells of about CELL members at most in which any two of a region meet.

    A region that fits is one cell, without sides. A larger one is dealt in blocks of half a cell; each block and
    each pair of blocks is a cell, the pair's blocks being its sides 1 and 2, so that two members are compared in
    one cell of the region only. Regions with the same members are taken once.
    """
    member = F.xxhash64("set_id", F.lit(7))
    sums = [F.count(F.lit(1)).alias("r"), F.sum(F.xxhash64("set_id").cast("decimal(38,0)")).alias("sum"), F.bit_xor(member).alias("xor")]
    once = regions.groupBy("region").agg(*sums).groupBy("r", "sum", "xor").agg(F.min("region").alias("region"))
    blocks = F.when(F.col("r") <= CELL, 1).otherwise(F.ceil(F.col("r") * 2.2 / CELL)).cast("long")
    dealt = regions.join(once.select("region", blocks.alias("blocks")), "region").withColumn("own", F.pmod(member, F.col("blocks")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = F.when(F.col("blocks") == 1, F.col("region")).otherwise(F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return met.select(cell.alias("cell"), "set_id", side.cast("int").alias("side"))


def join_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """doc_id, n_shingles, component_id, node, mark for every row.

    Two rows are linked if their sets of `words`-word shingles have similarity num / den or more (exactly, in
    integers); component_id is the least doc_id reachable by links, itself included. Words are split at ASCII
    white space with A-Z lower-cased; a text of fewer words is one shingle of all of them; very long texts take part
    whole. Null texts and texts without words have no shingles and no links. Equal sets are one node from the start.
    A null id gets the component of its set (null if no row of it has an id); rows that share an id but not a text
    are rows of their own. node names the component whatever the ids are (null without shingles), mark is a hash of
    the text. An empty table gives an empty result; other columns are ignored.
    """
    whole = docs.select(F.col(id_col).alias("doc_id"), common.binary_large(F.col(text_col)).alias("bytes")).select("doc_id", F.xxhash64("bytes").alias("mark"), "bytes")
    kind = whole.schema["doc_id"].dataType.simpleString()

    # One pass tells each row's set and, in rows without one, shingles that the task met in several texts. Those with
    # 1 / FREQUENT of all such reports or more count as frequent, of which there are FREQUENT at most.
    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "mark", "n", "set_id", "check", "shingle", "times"]
        found: list[np.ndarray] = []
        size, id_type = 0, None

        def report() -> pa.RecordBatch:
            every = np.concatenate(found)
            found.clear()
            every.sort()  # in place: np.unique would hold three copies
            first = np.flatnonzero(np.concatenate((np.full(min(1, len(every)), True), every[1:] != every[:-1])))
            value, count = every[first], np.diff(np.append(first, len(every)))
            some = count >= 4
            k = int(some.sum())
            return pa.RecordBatch.from_arrays([pa.nulls(k, id_type), *(pa.nulls(k, pa.int64()) for _ in range(4)), pa.array(value[some].view(np.int64)), pa.array(count[some], pa.int64())], names)

        for batch in common.slices(batches):
            id_type = batch.schema.field(0).type
            sets = shingle_sets(batch.column(2).to_pylist(), words)
            digests = np.array([digest(s) for s in sets], np.int64).reshape(-1, 2)
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), none, none], names)
            found += sets
            size += sum(map(len, sets))
            if size > REPORTED:
                yield report()
                found, size = [], 0
        if found:
            yield report()

    scanned = common.stored(whole.mapInArrow(summary, f"doc_id {kind}, mark long, n long, set_id long, check long, shingle long, times long"), "sets")
    sets = scanned.where("n is not null").select("doc_id", "mark", "n", "set_id", "check")
    reported = scanned.where("n is null").groupBy("shingle").agg(F.sum("times").alias("n"))
    all_reported = scanned.agg(F.sum("times")).first()[0] or 0
    top = reported.where(F.col("n") * FREQUENT >= all_reported).toPandas().sort_values(["n", "shingle"], ascending=[False, True])
    often = top["shingle"].to_numpy().astype(np.int64).view(np.uint64)
    turn = np.argsort(often)
    # In order: all others by hash, then the frequent ones, the least frequent first.
    known = docs.sparkSession.sparkContext.broadcast((often[turn], np.uint64(1 << 63) + np.uint64(len(turn)) - turn.astype(np.uint64)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, place = known.value
        maybe = np.zeros(1 << 22, bool)  # most shingles aren't frequent, and go by this
        maybe[often >> np.uint64(42)] = True
        for batch in common.slices(batches):
            sets = [s for s in shingle_sets(batch.column(0).to_pylist(), words) if len(s)]
            if not sets:
                continue
            every, edges = np.concatenate(sets), np.cumsum([0, *map(len, sets)]).tolist()
            order = every >> np.uint64(1)
            some = np.flatnonzero(maybe[every >> np.uint64(42)])
            if len(some):
                at = np.minimum(np.searchsorted(often, every[some]), len(often) - 1)
                there = often[at] == every[some]
                order[some[there]] = place[at[there]]
            firsts = []
            for s, a, z in zip(sets, edges, edges[1:], strict=False):
                k = prefix_size(len(s), num, den)
                firsts.append((s[np.argpartition(order[a:z], k - 1)[:k]] if k < len(s) else s).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, firsts)]), pa.int32()), pa.array(np.concatenate(firsts)))
            yield pa.RecordBatch.from_arrays([pa.array([digest(s)[0] for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), lists], ["set_id", "n", "firsts"])

    opened = common.stored(whole.select("bytes").mapInArrow(prefixes, "set_id long, n long, firsts array<long>"), "firsts")
    each = opened.select("set_id", "n", F.explode("firsts").alias("region"))
    # Rows of equal sets open no region: they are one node already.
    several = each.groupBy("region").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low < high").select("region")
    regions = common.stored(each.join(several, "region").distinct(), "regions")
    # Linked sets are of like sizes: strata one step of num / den wide, each set a native of its own and a guest of the
    # next, so that any two within a step meet where one of them at least is a native.
    step = math.log(den / num) * (1 + 1e-9) if num < den else 0.0
    own = F.floor(F.log(F.col("n").cast("double")) / step).cast("long") if step else F.col("n")
    strata = F.explode(F.array(F.struct(own.alias("stratum"), F.lit(0).alias("guest")), F.struct((own + 1).alias("stratum"), F.lit(1).alias("guest"))) if step else F.array(F.struct(own.alias("stratum"), F.lit(0).alias("guest"))))
    regions = regions.select("region", "set_id", "n", strata.alias("s")).select(F.xxhash64("region", "s.stratum").alias("region"), F.xxhash64("set_id", "s.stratum").alias("place"), "set_id", "n", "s.guest")
    # A set at the threshold to another of m >= its own num / den meets it in meetings(m) regions; sets that meet
    # any others in fewer are out, and regions that they leave with one member or no native too.
    least = 1 + F.floor(F.ceil(F.col("n") * num / F.lit(den) - 1e-9) / 20)
    open_regions = lambda rows: rows.groupBy("region").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"), F.min("guest").alias("native"), F.min("place").alias("head")).where("low < high and native = 0").select("region", "head")
    for _ in range(2):
        met = regions.join(open_regions(regions).select("region"), "region")
        enough = met.groupBy("place", "n").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") >= least).select("place")
        regions = common.stored(met.join(enough, "place"), "regions")
    regions = common.stored(regions.join(open_regions(regions), "region"), "regions")

    # Each place (a set in a stratum) is in one cell.
    cells = components(regions.select(F.col("place").alias("a"), F.col("head").alias("b")), "cells")
    places = regions.select("place", "set_id", "guest").distinct()
    cells = common.stored(cells.join(places.withColumnRenamed("place", "node"), "node").select(F.col("component").alias("cell"), "set_id", "guest"), "members")
    sized = common.stored(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("m"), F.min("guest").alias("native")).where("m > 1 and native = 0").select("cell", "m"), "sizes")

    # The text of one row of each set that is in a cell.
    reps = sets.where("n > 0").groupBy("set_id").agg(F.min(F.struct("doc_id", "mark", "n")).alias("rep")).join(cells.select("set_id").distinct(), "set_id")
    reps = common.stored(reps.select("set_id", "rep.*"), "reps")
    same = whole["doc_id"].eqNullSafe(reps["doc_id"]) & (whole["mark"] == reps["mark"])
    texts = common.stored(whole.join(common.few(reps, BROADCAST_ROWS), same).select("set_id", "n", "bytes").groupBy("set_id", "n").agg(F.min("bytes").alias("bytes")), "texts")

    members = cells.join(sized, "cell").select("cell", "set_id", "guest", "m")
    small = members.where(F.col("m") <= CELL).select("cell", "set_id", F.col("guest").alias("side"), F.col("set_id").alias("group"))
    large, found, before, turn_of = members.where(F.col("m") > CELL), None, math.inf, 0

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivots = None, []
        for batch in common.slices(batches):
            rows: list[tuple] = []
            cell_of, salts, kinds, ids, held = (batch.column(i).to_pylist() for i in range(5))
            for cell, salt, member, set_id, s in zip(cell_of, salts, kinds, ids, shingle_sets(held, words), strict=True):
                if (cell, salt) != key:
                    key, pivots = (cell, salt), []
                if not member:
                    pivots.append((set_id, s))
                    continue
                linked, inside = voronoi([s], [p for _, p in pivots], num, den)
                rows += [(set_id, cell, p, bool(linked[0, i]), bool(inside[0, i])) for i, (p, _) in enumerate(pivots) if linked[0, i] or inside[0, i]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()))], ["set_id", "cell", "pivot", "near", "inside"])

    while (left := large.count()) and left <= SHRINKS * before:
        # Members are dealt over tasks by cell and salt; the pivots of their cell come first in each.
        salts = F.ceil(F.col("m") / CELL).cast("long")
        chosen = large.withColumn("turn", F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("set_id", F.lit(turn_of))))).where(F.col("turn") <= PIVOTS)
        fronts = chosen.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(0).alias("member"), "set_id")
        rest = large.select("cell", F.pmod(F.xxhash64("set_id", F.lit(3)), salts).alias("salt"), F.lit(1).alias("member"), "set_id")
        together = fronts.unionByName(rest).join(texts, "set_id").select("cell", "salt", "member", "set_id", "bytes")
        dealt = together.repartition("cell", "salt").sortWithinPartitions("cell", "salt", "member", "set_id")
        told = common.stored(dealt.mapInArrow(measure, "set_id long, cell long, pivot long, near boolean, inside boolean"), "told")
        links = told.where("near and set_id <> pivot").select(F.col("set_id").alias("a"), F.col("pivot").alias("b"))
        found = links if found is None else found.unionByName(links)
        groups = common.stored(components(found), "groups")
        inside = told.where("inside").select(F.xxhash64("cell", "pivot", F.lit(turn_of)).alias("cell"), "set_id")
        grouped = inside.join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").select("cell", "set_id", F.coalesce("component", "set_id").alias("group"))
        # Regions whose members are joined already are done.
        open_cells = common.stored(grouped.groupBy("cell").agg(F.count(F.lit(1)).alias("m"), F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("cell", "m"), "open")
        cut = common.stored(grouped.join(open_cells, "cell"), "cut")
        small = small.unionByName(cut.where(F.col("m") <= CELL).select("cell", "set_id", F.lit(0).alias("side"), "group"))
        large, before, turn_of = cut.where(F.col("m") > CELL), left, turn_of + 1
    if left:
        # Another round would take off little: what remains is compared by the regions that the first shingles opened.
        owners = common.stored(large.groupBy("set_id").agg(F.min("group").alias("group")), "owners")
        dealt = block_pairs(regions.join(owners, "set_id").select("region", "set_id"))
        small = small.unionByName(dealt.join(owners, "set_id").select("cell", "set_id", "side", "group"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []

        def decide() -> Iterator[pa.RecordBatch]:
            if len(rows) > 1:
                groups = np.unique([r[2] for r in rows], return_inverse=True)[1]
                pairs = list(Cell(shingle_sets([r[3] for r in rows], words), num, den, [r[1] for r in rows], groups).links())
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array([rows[x][0] for x in side], pa.int64()) for side in zip(*pairs, strict=True)], ["a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if row[0] != cell:
                    yield from decide()
                    cell, rows = row[0], []
                rows.append(row[1:])
        yield from decide()

    ended = small.join(texts, "set_id").select("cell", "set_id", "side", "group", "bytes").repartition("cell").sortWithinPartitions("cell", "set_id").mapInArrow(finish, "a long, b long")
    groups = components(ended if found is None else found.unionByName(ended))
    # Components by node first, then by the least id of their rows.
    some = sets.where("n > 0")
    nodes = some.groupBy("set_id", "check").agg(F.min("doc_id").alias("least")).join(groups.withColumnRenamed("node", "set_id"), "set_id", "left")
    nodes = common.stored(nodes.select("set_id", "check", "least", F.coalesce("component", "set_id").alias("node")), "nodes")
    named = nodes.groupBy("node").agg(F.min("least").alias("component_id"))
    labels = common.stored(nodes.select("set_id", "check", "node").join(named, "node"), "labels")
    linked = some.join(labels, ["set_id", "check"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "node", "mark")
    return linked.unionByName(sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("node"), "mark"))
