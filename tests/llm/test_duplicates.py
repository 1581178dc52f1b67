import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import cases
from tests.llm.cases import edited, prose
from tests.oracle import compare
from trafficspark.llm import common, jaccard_join, line_dedup, queries, suffix_dedup
from trafficspark.llm.components import components


def joined(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(0)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    exact = joined({x for p in links for x in p}, links)
    assert got == {n: c for n, c in exact.items() if n in got}
    assert all(exact[n] == n for n in exact if n not in got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_groups(docs, k, num, den):
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    links = []
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                links.append((j, i))
    root = joined(range(len(docs)), links)
    least = defaultdict(list)
    for i, r in root.items():
        if docs[i][0] is not None:
            least[r].append(docs[i][0])
    return Counter((d, len(s), min(least[root[i]], default=None) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True)))


@pytest.mark.parametrize("k, num, den", [(3, 90, 100), (5, 8, 10), (1, 5, 10)])
def test_groups_equal_brute_force(spark, k, num, den):
    docs = [(r.doc_id, r.text) for r in cases.table(spark).collect()]
    got = Counter(tuple(r) for r in jaccard_join.join_groups(cases.table(spark), words=k, num=num, den=den).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute_groups(docs, k, num, den)


def test_groups_of_chains_in_rounds_of_pivots(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL", 3)
    rng = random.Random(3)
    text = cases.words(rng, 120)
    some = []
    for i in range(40):
        some.append((i, " ".join(text), "en", "s"))
        text = [*text[2:], *cases.words(rng, 2)]
    docs = [(r[0], r[1]) for r in some]
    got = Counter(tuple(r) for r in jaccard_join.join_groups(cases.table(spark, some), words=2, num=85, den=100).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute_groups(docs, 2, 85, 100)


def test_blocks_bound_every_cell_and_pair_members_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL", 40)
    members = {1: range(200), 2: range(200), 3: range(190, 215)}
    rows = [(r, i) for r, ids in members.items() for i in ids]
    cells = defaultdict(list)
    for r in jaccard_join.block_pairs(spark.createDataFrame(rows, "region long, set_id long")).collect():
        cells[r.cell].append((r.set_id, r.side))
    assert max(map(len, cells.values())) < 2 * 40
    met = Counter((a, b) for c in cells.values() for a, x in c for b, y in c if a < b and not (x and x == y))
    assert met == Counter((a, b) for ids in (members[1], members[3]) for a in ids for b in ids if a < b)


def template_texts(own):
    """60 texts with 92 words in common and 8 of their own each, and near copies of some: about as far from each other one as the other."""
    common_words = " ".join(f"c{i}" for i in range(100 - own))
    some = [(i, f"{common_words} " + " ".join(f"u{i}x{j}" for j in range(own)), "en", "s") for i in range(60)]
    return some + [(100 + i, some[i][1].replace("x0", "y0"), "en", "s") for i in range(0, 60, 7)]


def test_groups_of_one_template_below_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL", 8)
    sizes = []
    block_pairs = jaccard_join.block_pairs

    def spied(regions):
        cells = block_pairs(regions)
        sizes.append((regions.groupBy("region").count().agg({"count": "max"}).first()[0], cells.groupBy("cell").count().agg({"count": "max"}).first()[0]))
        return cells

    monkeypatch.setattr(jaccard_join, "block_pairs", spied)
    some = template_texts(8)
    docs = [(r[0], r[1]) for r in some]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join_groups(cases.table(spark, some), words=1, num=90, den=100).collect())
    assert got == brute_groups(docs, 1, 90, 100)
    assert len(sizes) == 1 and sizes[0][0] > 2 * sizes[0][1]


@pytest.mark.parametrize("leaf", [2, 48])
@pytest.mark.parametrize("own", [8, 30])
def test_regions_of_a_cell_lose_no_link(monkeypatch, own, leaf):
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    texts = [t[1] for t in template_texts(own)] + [edited(s, i) for s in (prose(1, 150), prose(2, 150), prose(3, 90)) for i in range(25)]
    sets = [jaccard_join.shingles(t.encode(), 2) for t in texts]
    for num in (70, 80, 90):
        exact = joined(range(len(sets)), [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= num * len(np.union1d(sets[i], sets[j]))])
        assert joined(range(len(sets)), jaccard_join.Cell(sets, num, 100).links()) == exact
        # Cut by pivots as on the cluster: every linked pair is linked to one pivot, or meets in a region.
        linked, inside = jaccard_join.voronoi(sets, sets[::17], num, 100)
        for i in range(len(sets)):
            for j in range(i):
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= num * len(np.union1d(sets[i], sets[j])):
                    assert (inside[i] & inside[j]).any()


def test_groups_without_ids_and_with_shared_ids(spark):
    base, other, third = prose(1, 200), prose(2, 200), prose(3, 200)
    some = [(None, base, "en", "s"), (None, base + " end", "en", "s"), (1, other, "en", "s"), (1, third, "en", "s"), (2, other + " end", "en", "s"), (3, third + " end", "en", "s")]
    rows = jaccard_join.join_groups(cases.table(spark, some)).collect()
    nodes = Counter(r.node for r in rows)
    assert sorted(nodes.values()) == [2, 2, 2]
    assert Counter((r.doc_id, r.component_id) for r in rows) == Counter({(None, None): 2, (1, 1): 2, (2, 1): 1, (3, 1): 1})


def test_batches_are_taken_in_slices_and_empty_texts_report_nothing(spark):
    batches = [pa.RecordBatch.from_pydict({"x": list(range(n))}) for n in (2500, 0, 3)]
    got = list(common.slices(iter(batches)))
    assert [b.num_rows for b in got] == [1000, 1000, 500, 0, 3]
    assert [x for b in got for x in b.column(0).to_pylist()] == [*range(2500), *range(3)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["", " ", None])], "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join_groups(docs).collect()} == {(i, 0, i) for i in range(3)}


def test_shingles_of_a_batch_equal_those_of_split_words(monkeypatch):
    rng = random.Random(12)
    parts = [b"a", b"A", b"a\0", b"b", "\u00c9t\u00e9".encode(), b"x" * 7, b"x" * 8, b"x" * 9, b"X" * 16, b"y" * 63, b"y" * 64, b"y" * 65, b"y" * 200, b"\xc2\xa0", b"\x1c"]
    texts = [None, b"", b" ", b"a", b" a", b"a b", b"a\0", b"\n\n"] + [b"".join(rng.choice(parts) + rng.choice([b" ", b"\t", b"\n", b"\x0b", b"\x0c\r", b"  "]) for _ in range(rng.randrange(40))) + rng.choice([b"", b"end"]) for _ in range(200)]
    for k, piece in ((1, 1), (3, 300), (3, 1_000_000), (5, 300)):
        monkeypatch.setattr(jaccard_join, "PIECE", piece)
        got, names = jaccard_join.shingle_sets(texts, k), {}
        for text, s in zip(texts, got, strict=True):
            words = (text or b"").lower().split()
            n = min(k, len(words))
            exact = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
            assert len(s) == len(exact) and s.tolist() == sorted(set(s.tolist()))
            names.setdefault(frozenset(s.tolist()), set()).add(frozenset(exact))
        assert all(len(x) == 1 for x in names.values()) and len(names) == len({y for x in names.values() for y in x})
        assert len({v for s in got for v in s.tolist()}) == len({y for x in names.values() for z in x for y in z})


def test_small_cells_take_little_memory():
    sets = [jaccard_join.shingles(f"{base} of a few words that are much the same".encode(), 2) for base in ("one", "two")]
    tracemalloc.start()
    cell = jaccard_join.Cell(sets, 50, 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000 and len(list(cell.links())) == 1


def test_exact_copies_open_no_regions(spark, monkeypatch):
    rows, stored = [], common.stored

    def counted(df, name, **options):
        table = stored(df, name, **options)
        if name == "regions":
            rows.append(table.count())
        return table

    monkeypatch.setattr(common, "stored", counted)
    texts = [prose(i, 60) for i in range(5)]
    docs = spark.createDataFrame([(i, texts[i % 5]) for i in range(40)], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in jaccard_join.join_groups(docs, words=3, num=90, den=100).collect()}
    assert got == {(i, i % 5) for i in range(40)} and rows[0] == 0


def test_groups_of_nothing(spark):
    assert jaccard_join.join_groups(cases.empty(spark)).count() == 0


def covered(texts, length):
    """For each text, its bytes under strings of this length that start elsewhere too."""
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(gone)
    return out


def brute_spans(texts, length, passage, words):
    out = []
    for t, gone, near in zip(texts, covered(texts, length), covered(texts, passage), strict=True):
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        passages = sum(len(t[m.start() : m.end()].split()) > words for m in re.finditer(b"\1+", near))
        out.append((len(t), sum(gone), spans, passages, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return Counter(out)


@pytest.mark.parametrize("length, passage, words, group", [(400, 200, 50, 1 << 16), (100, 150, 20, 1 << 16), (100, 100, 10, 1)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, length, passage, words, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    df = cases.table(spark)
    exact = brute_spans([(r.text or "").encode() for r in df.collect()], length, passage, words)
    found = suffix_dedup.remove_repeats(df, length=length, passage=passage, passage_words=words).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, r.n_passages, bytes(r.kept)) for r in found) == exact


def test_long_texts_go_piece_by_piece(monkeypatch):
    text = cases.prose(1, 3000).encode()
    places = lambda: {(n, int(h), int(p)) for n, part in suffix_dedup.anchors(text, (400, 200)) for h, p in zip(part[0], part[1], strict=True)}
    whole = places()
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    assert places() == whole


def test_removal_from_nothing(spark):
    assert suffix_dedup.remove_repeats(cases.empty(spark)).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute_lines(docs, least):
    places = [((d is not None, d if d is not None else 0), n, line) for d, t in docs for n, line in enumerate((t or "").split("\n")) if len(line) >= least and t is not None]
    out = []
    for d, t in docs:
        if t is None:
            out.append((0, 0, None))
            continue
        mine = (d is not None, d if d is not None else 0)
        kept = []
        for n, line in enumerate(t.split("\n")):
            if len(line) < least or not any((k, m) < (mine, n) and abs(len(x) - len(line)) < 2 and edit_distance(x, line) < 2 for k, m, x in places):
                kept.append(line)
        out.append((len(t.split("\n")), len(t.split("\n")) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_lines_equal_brute_force(spark):
    base = "the quick brown fox jumps over it"
    lines = [base, base + "s", base[1:], base.replace("fox", "fax"), base.replace("quick", "quack") + "!", "short", "short", "", "ünï" * 10, "ünî" + "ünï" * 9, "z" * 200, "z" * 201, "z" * 203, "y" * 64 + base, "y" * 63 + base]
    rng = random.Random(7)
    some = [(i, "\n".join(rng.choices(lines, k=6)), "en", "s") for i in range(12)] + [(3, base, "en", "s"), (None, base + "x", "en", "s"), (99, None, "en", "s"), (98, "", "en", "s")]
    got = Counter((r.n_lines, r.n_removed, r.text) for r in line_dedup.dedup_lines(cases.table(spark, some)).collect())
    assert got == brute_lines([(s[0], s[1]) for s in some], 20)


def test_lines_of_awkward_documents(spark, sf_dir):
    assert line_dedup.dedup_lines(cases.table(spark)).count() == len(cases.rows())
    assert line_dedup.dedup_lines(cases.empty(spark)).count() == 0
    compare(queries.op4_line_dedup(spark, sf_dir), queries.ORACLE_SQL["op4_line_dedup"], sf_dir)


def test_one_document_of_very_many_lines(spark):
    rng = random.Random(6)
    distinct = ["".join(rng.choices("abcdefgh", k=40)) for _ in range(4_000)]
    lines = [distinct[rng.randrange(4_000)] if i % 3 else distinct[i % 4_000][:-1] + "z" for i in range(12_000)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (1, "\n".join(lines[:10])), (2, None)], "doc_id long, text string")
    got = sorted(line_dedup.dedup_lines(df).collect(), key=lambda r: r.n_lines)
    seen, kept = {}, []
    for line in lines:
        alike = {line[:-1]}  # lines of one length that differ in the last place only
        if not alike & seen.keys():
            kept.append(line)
        seen[line[:-1]] = True
    assert [r.n_lines for r in got] == [0, 10, 12_000] and got[2].text == "\n".join(kept) and got[2].n_removed == 12_000 - len(kept)


def test_lines_are_broadcast_only_up_to_a_counted_number(spark, monkeypatch):
    # Spark takes a table after an explode for as small as its file, so none but the counted one may go by that.
    plans, stored = {}, common.stored

    def seen(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name, **options)

    monkeypatch.setattr(common, "stored", seen)
    docs = spark.createDataFrame([(i, f"a line of some length, number {i // 2}") for i in range(8)], "doc_id long, text string")
    last = line_dedup.dedup_lines(docs)
    plans["last"] = last._jdf.queryExecution().executedPlan().toString()
    assert {name: p.count("BroadcastExchange") for name, p in plans.items() if "BroadcastExchange" in p} == {"texts": 1}
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    line_dedup.dedup_lines(docs)
    assert "BroadcastExchange" not in plans["texts"]


def test_rows_of_one_id_lose_their_own_lines(spark):
    line, other = "a line of some length, long enough", "quite another line, and long enough too"
    df = spark.createDataFrame([(0, line), (5, f"{line}\n{other}"), (5, f"{other}\n{line}"), (5, f"{other}\n{line}")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect())
    assert got == [(0, line), (5, ""), (5, other), (5, other)]  # of the first row, a line stands earlier in the others
