import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from tests.oracle import compare
from trafficspark.llm import bm25_search, decontamination, mixing, queries


def brute_bm25(docs, asked, k):
    bags = [Counter((t or "").encode().lower().split()) for _, t in docs]
    n, mean = len(docs), sum(sum(b.values()) for b in bags) / len(docs)
    df = Counter(w for b in bags for w in b)
    out = []
    for q, t in asked:
        bag, scores = Counter((t or "").encode().lower().split()), []
        for (d, _), b in zip(docs, bags, strict=True):
            size = sum(b.values())
            s = sum(c * math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size / mean)) for w, c in bag.items() if w in b)
            if s > 0:
                scores.append((-round(s, 6), d is None, d or 0, d))
        out += [(q, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_top_k_equals_brute_force(spark, monkeypatch, k):
    df = cases.table(spark)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    asked = df.where("doc_id % 5 = 0").dropDuplicates(["doc_id"])
    monkeypatch.setattr(bm25_search, "SHARDS_A_TASK", 1)
    monkeypatch.setattr(bm25_search, "QUERY_BLOCK", 3)
    got = bm25_search.top_k(df, asked, query_id_col="doc_id", k=k).collect()
    exact = brute_bm25(docs, [(r.doc_id, r.text) for r in asked.collect()], k)
    assert sorted(((r.query_id, r.rank, r.doc_id, round(r.score, 5)) for r in got), key=str) == sorted(((q, i, d, round(s, 5)) for q, i, d, s in exact), key=str)


def test_pruned_shard_equals_full_scores(monkeypatch):
    import numpy as np

    monkeypatch.setattr(bm25_search, "LONG", 4)
    monkeypatch.setattr(bm25_search, "BLOCK", 8)
    texts = [cases.prose(i % 60, 30 + i % 40).encode() for i in range(200)]
    bags = [bm25_search.terms_of(t) for t in texts]
    terms, counts = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags]).astype(np.int32)
    owner = np.repeat(np.arange(200, dtype=np.int32), [len(b[0]) for b in bags])
    order = np.argsort(terms, kind="stable")
    distinct, first = np.unique(terms[order], return_index=True)
    row = {"doc_ids": list(range(200)), "lengths": np.array([b[1].sum() for b in bags], np.int64).tobytes(), "terms": distinct.tobytes(), "starts": np.append(first, len(order)).astype(np.int64).tobytes(), "docs": owner[order].tobytes(), "counts": counts[order].tobytes()}
    shard = bm25_search.Shard(row, 45.0, 1.2, 0.75)
    for q in range(0, 200, 20):
        t, c = bags[q]
        weights = c * 1.5
        everything = shard.exact(np.searchsorted(shard.terms, t), weights, np.arange(200))
        places, scores = shard.search(t, weights, 5, 0.0)
        best = sorted(zip((-scores).tolist(), places.tolist(), strict=True))[:5]
        assert best == sorted(zip((-everything).tolist(), range(200), strict=True))[:5]


def test_queries_of_a_block_find_what_each_finds_alone(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(bm25_search, "LONG", 4)
    monkeypatch.setattr(bm25_search, "BLOCK", 8)
    monkeypatch.setattr(bm25_search, "BOUNDS", 1000)
    texts = [cases.prose(i % 60, 30 + i % 40).encode() for i in range(200)]
    bags = [bm25_search.terms_of(t) for t in texts]
    terms, counts = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags]).astype(np.int32)
    owner = np.repeat(np.arange(200, dtype=np.int32), [len(b[0]) for b in bags])
    order = np.argsort(terms, kind="stable")
    distinct, first = np.unique(terms[order], return_index=True)
    arrays = {"lengths": np.array([b[1].sum() for b in bags], np.int64), "terms": distinct, "starts": np.append(first, len(order)).astype(np.int64), "docs": owner[order], "counts": counts[order]}
    shard = bm25_search.Shard({"doc_ids": list(range(200))} | {k: pa.py_buffer(v.tobytes()) for k, v in arrays.items()}, 45.0, 1.2, 0.75)
    asked = [bags[q] for q in range(0, 200, 9)] + [bm25_search.terms_of(b"unheard-of words"), bm25_search.terms_of(b"")]
    everything = [shard.exact(np.searchsorted(shard.terms, t), c * 1.5, np.arange(200)) for t, c in asked[:-2]]
    for floors in (np.zeros(len(asked)), np.array([np.sort(e)[-3] for e in everything] + [0.0, 0.0])):
        found = {q: (p, s) for q, p, s in shard.search_all(np.array([len(t) for t, _ in asked]), np.concatenate([t for t, _ in asked]), np.concatenate([c * 1.5 for _, c in asked]), 5, floors)}
        assert set(found) == set(range(len(everything)))
        for q, e in enumerate(everything):
            best = [x for x in sorted(zip((-e).tolist(), range(200), strict=True))[:5] if -x[0] >= floors[q]]
            assert sorted(zip((-found[q][1]).tolist(), found[q][0].tolist(), strict=True))[: len(best)] == best
            assert len(set(found[q][0].tolist())) == len(found[q][0])


def test_search_shuffles_neither_shards_nor_queries(spark, monkeypatch):
    plans, limits, name = [], [], "spark.sql.execution.arrow.maxBytesPerBatch"

    def noted(df, table, stored=bm25_search.common.stored, **options):
        plans.append((table, df._jdf.queryExecution().executedPlan().toString()))
        limits.append(spark.conf.get(name))
        return stored(df, table, **options)

    monkeypatch.setattr(bm25_search.common, "stored", noted)
    df, before = cases.table(spark), spark.conf.get(name)
    bm25_search.top_k(df, df, query_id_col="doc_id")
    plan = dict(plans)["found"]
    assert "CartesianProduct" in plan and "Exchange" not in plan
    assert set(limits) == {bm25_search.BATCH} and spark.conf.get(name) == before


@pytest.mark.parametrize("k", [1, 3])
def test_rounds_return_what_all_shards_do_in_fewer_rows(spark, monkeypatch, k):
    rows, stored = [], bm25_search.common.stored

    def counted(df, name, **options):
        table = stored(df, name, **options)
        if name == "found":
            rows.append(table.count())
        return table

    monkeypatch.setattr(bm25_search.common, "stored", counted)
    monkeypatch.setattr(bm25_search, "SHARD_DOCS", 3)
    monkeypatch.setattr(bm25_search, "SHARDS_A_TASK", 1)
    monkeypatch.setattr(bm25_search, "ROW_QUERIES", 4)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")  # each file of one shard in a task of its own
    docs = [(i if i % 17 else None, cases.prose(i % 90, 20 + i % 30)) for i in range(180)] + [(500, None), (501, "unheard-of")]
    asked = [(i, docs[i][1]) for i in range(0, 180, 20)] + [(None, cases.prose(3, 5)), (7, "words-in-no-text"), (500, None)]
    df, queries_df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(asked, "query_id long, text string")
    got = bm25_search.top_k(df, queries_df, k=k).collect()
    exact = brute_bm25(docs, asked, k)
    assert sorted(((r.query_id, r.rank, r.doc_id, round(r.score, 5)) for r in got), key=str) == sorted(((q, i, d, round(s, 5)) for q, i, d, s in exact), key=str)
    assert len(rows) == 3 and len({r.query_id for r in got}) == 10
    in_rounds = sum(rows)
    monkeypatch.setattr(bm25_search, "FIRST_SHARDS", 1000)
    assert bm25_search.top_k(df, queries_df, k=k).count() == len(got) and in_rounds < 0.75 * rows[3]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_search_in_nothing(spark):
    assert bm25_search.top_k(cases.empty(spark), cases.table(spark), query_id_col="doc_id").count() == 0
    assert bm25_search.top_k(cases.table(spark), cases.empty(spark), query_id_col="doc_id").count() == 0


def test_search_equals_sql(spark, sf_dir):
    compare(queries.op8_bm25_search(spark, sf_dir), queries.ORACLE_SQL["op8_bm25_search"], sf_dir)


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("fan_in", [48, 3])
def test_mix(spark, sf_dir, fan_in):
    for df in (cases.table(spark), cases.documents(spark, sf_dir)):
        size = {(r.doc_id, r.source): None for r in df.collect()}
        assert size
        sizes = defaultdict(int)
        for r in df.collect():
            sizes[r.source] += len((r.text or "").encode().split())
        got = mixing.mix(df, fan_in=fan_in).collect()
        again = mixing.mix(df.repartition(2), fan_in=fan_in).collect()
        key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.size, r.target, r.taken)
        assert sorted(map(key, got)) == sorted(map(key, again))
        assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((r.doc_id is not None, r.doc_id or 0) for r in df.collect())
        exact = brute_targets(sizes)
        assert {round(r.target, 6) for r in got} == {round(t, 6) for t in exact.values()}
        assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 2 for r in got)
        taken, largest = defaultdict(int), defaultdict(int)
        for r in got:
            taken[r.source_size, round(r.target, 6)] += r.taken
            largest[r.source_size, round(r.target, 6)] = max(r.size, largest[r.source_size, round(r.target, 6)])
        assert all(abs(n - t) <= largest[s, t] + 1e-6 for (s, t), n in taken.items())
        rows = mixing.mixed(df, fan_in=fan_in)
        assert rows.columns == df.columns and rows.count() == sum(r.copies for r in got)


def test_mix_of_nothing_and_of_empty_texts(spark):
    assert mixing.mix(cases.empty(spark)).count() == 0
    blank = cases.table(spark, [(1, None, "en", "a"), (2, " ", "en", None)])
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]


def test_mix_leaves_expectations(spark):
    units = [(i, "w " * (i % 9 + 1), "en", "abc"[i % 3]) for i in range(120)]
    df = cases.table(spark, units)
    shares = [sum(r.copies for r in mixing.mix(df, seed=s).collect()) for s in (1, 2, 3)]
    assert max(shares) - min(shares) < 25 and len(set(shares)) > 0


QUESTION = "if a train leaves paris at 60 km per hour and anna waits then 60 km later it stops near the old bridge over the river"


@pytest.mark.parametrize(
    "text, found",
    [
        (QUESTION, True),
        ("they say: " + QUESTION + " and so on", True),
        (QUESTION.replace("60", "75"), True),
        (QUESTION.replace("60 km per", "75 km per").replace("then 60", "then 99"), True),
        ("a train waits at the old station for nobody in particular today", False),
        (None, False),
        ("", False),
    ],
)
def test_leaks(spark, text, found):
    bench = spark.createDataFrame([(1, QUESTION), (2, None), (3, "too short")], "item_id long, text string")
    df = cases.table(spark, [(7, text, "en", "s"), (8, cases.prose(3, 200), "en", "s")])
    got = [(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()]
    assert got == ([(7, 1)] if found else [])
    assert decontamination.clean(df, bench).count() == 2 - found


@pytest.mark.parametrize(
    "item, other, alike",
    [
        ("Sort the numbers 4, 17, 3, 22, 8, 15 and 1 in order.", "Sort the numbers 5, 18, 2, 23, 9, 16 and 6 in order.", True),
        ("Compute 12 + 45 - 7 * 3 / 9 + 81 - 6.", "Compute 13 + 45 - 7 * 3 / 9 + 81 - 6.", False),
        ("Order these cities: Paris, London, Berlin, Madrid, Rome, Vienna, Prague, Oslo.", "Order these cities: Oslo, London, Berlin, Madrid, Rome, Vienna, Prague, Paris.", False),
        ("Who wrote Hamlet?", "Who wrote Faust?", False),
        ("一列火车每小时行驶六十公里问三小时行驶多少公里", "今天天气很好我们去公园散步吧", False),
    ],
)
def test_items_without_a_counting_window_are_found_whole(spark, item, other, alike):
    bench = spark.createDataFrame([(1, item), (2, "...")], "item_id long, text string")
    df = cases.table(spark, [(7, item, "en", "s"), (8, "as they ask: " + item + " 以及 and so on", "en", "s"), (9, "well, " + other, "en", "s"), (10, "nothing of it", "en", "s")])
    got = sorted((r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect())
    assert got == [(7, 1), (8, 1)] + [(9, 1)] * alike


def leaks(spark, item, *texts):
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = cases.table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    return {r.doc_id for r in decontamination.contaminated(df, bench).collect()}


def test_names_may_change_at_the_start_of_sentences(spark):
    item = "Tom buys 3 pens. Anna pays 12 dollars. Peter counts 5 coins. Laura leaves."
    other = "Max buys 4 pens. Ute pays 15 dollars. Karl counts 6 coins. Nina leaves."
    assert leaks(spark, item, item, other, "so " + other, other.replace("Nina", "Karl"), other.replace("pens", "pans")) == {0, 1, 2}


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_values_must_agree_over_the_whole_item(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", broadcast)
    item = "yesterday Anna walked slowly over to the old mill because Peter had asked there for bread and then Anna came back home again with it"
    renamed = item.replace("Anna", "Laura").replace("Peter", "Max")
    crossed = "yesterday Laura walked slowly over to the old mill because Max had asked there for bread and then Max came back home again with it"
    pure = item.replace("yesterday Anna walked slowly over to the old mill because Peter", "Anna and Peter").replace("then Anna came back home again with it", "Anna left")
    assert leaks(spark, item, item, renamed) == {0, 1}
    names = "Anna met Bert near this new bridge where Carl said that Anna would sing for Bert next week if Carl came too"
    twisted = "Ute met Max near this new bridge where Tom said that Ute would sing for Tom next week if Max came too"
    assert leaks(spark, names, names, names.replace("Anna", "Ute").replace("Bert", "Max").replace("Carl", "Tom"), twisted) == {0, 1}
    assert crossed != renamed and pure != item


def test_units_may_change(spark):
    item = "the red box weighs 5 kg and the blue box weighs 7 kg so how much more"
    assert leaks(spark, item, item.replace("kg", "lb"), item.replace("kg", "boxes")) == {0}


def test_slots_must_agree(spark):
    bench = spark.createDataFrame([(1, "add 5 and 5 to get twice the sum")], "item_id long, text string")
    hit = lambda t: decontamination.matches(cases.table(spark, [(7, t, "en", "s")]), bench).count()
    assert hit("add 9 and 9 to get twice the sum") == 1
    # Neither window of the item is one renaming of the other's.
    assert hit("add 9 and 4 to get twice the sum") == 0
    # Rows that share an id are told apart.
    rows = [(7, "add 9 and 9 to get twice the sum", "en", "s"), (7, "add 4 and 4 to get twice the sum", "en", "s")]
    assert decontamination.matches(cases.table(spark, rows), bench).count() == 1


def test_names_and_units(spark):
    words = spark.createDataFrame([("we saw Maria run 12 km in 3 hours, Peter ran 5 miles and m of it",)], "t string")
    got = decontamination.templated(words, F.col("t")).first().typed
    assert got == "we saw <name> run <num> <unit> in <num> <unit> <name> ran <num> <unit> and m of it".split()


def test_leaks_among_awkward_documents(spark, sf_dir):
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(cases.texts())], "item_id long, text string")
    pairs = {(r.doc_id, r.item_id) for r in decontamination.contaminated(cases.table(spark), bench).collect()}
    assert {(8, 8), (9, 8), (16, 16), (None, 8)} <= pairs
    assert decontamination.contaminated(cases.empty(spark), bench).count() == 0
    assert decontamination.contaminated(cases.table(spark), bench.limit(0)).count() == 0
    compare(queries.op2_decontamination(spark, sf_dir), queries.ORACLE_SQL["op2_decontamination"], sf_dir)
