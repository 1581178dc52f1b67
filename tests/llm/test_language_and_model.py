import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.llm import cases
from trafficspark.llm import gated_lm, language_id, lm_scoring, queries
from trafficspark.llm.lm_scoring import lm_scores


def test_languages_of_held_out_documents(spark, sf_dir):
    got = queries.op5_language_id(spark, sf_dir).join(cases.documents(spark, sf_dir).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)


def test_awkward_texts_and_tables(spark):
    df = cases.table(spark)
    model = language_id.fit(df.where("lang is not null"))
    got = language_id.predict(df, model, keep=("text", "source")).collect()
    assert len(got) == df.count()
    for r in got:
        none = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == none and (r.score == 0 if none else 0 < r.score <= 1)
    assert language_id.predict(cases.empty(spark), model).count() == 0
    untrained = language_id.fit(cases.empty(spark))
    assert {r.lang_pred for r in language_id.predict(df, untrained).collect()} == {"und"}


def test_grams_in_pieces_equal_those_at_once(monkeypatch):
    text = "Some words, and 12 more: déjà vu!" * 30
    counts = lambda: sum(np.bincount(g, minlength=64) for g in language_id.gram_buckets(text, (1, 2, 3), 64))
    whole = counts()
    monkeypatch.setattr(language_id, "STEP", 50)
    assert (counts() == whole).all()


def brute_base(docs, held_out):
    counts = Counter()
    for i, t in docs:
        if not held_out(i):
            counts.update((t or "").encode().lower().split())
            counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    told = [((t or "").encode().lower().split() + [b""]) for _, t in docs]
    return [(len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for w in told]


def check_scores(df, held_out, **options):
    docs = [(r.doc_id, r.text) for r in df.collect()]
    flagged = df.withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
    got = lm_scores(flagged, **options).collect()
    exact = sorted(brute_base(docs, held_out))
    ours = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert all(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 * max(1, abs(b[3])) for a, b in zip(ours, exact, strict=True))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    return got


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def test_scores_of_awkward_documents(spark):
    check_scores(cases.table(spark), held, shape=gated_lm.Shape(hidden=8, inner=4, classes=4, width=4, tails=4, buckets=8), frequent=100)
    none = cases.empty(spark).withColumn("held_out", F.lit(False))
    assert lm_scores(none).count() == 0
    untrained = cases.table(spark).withColumn("held_out", F.lit(True))
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in lm_scores(untrained).collect())


def test_model_beats_the_unigrams_on_held_out_documents(spark, sf_dir):
    got = [r for r in check_scores(cases.documents(spark, sf_dir), held) if r.held_out]
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got)


def test_gradients_equal_differences():
    shape = gated_lm.Shape(hidden=3, inner=3, classes=2, width=3, tails=2, buckets=4, steps=4)
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in gated_lm.start(shape).items()}
    inputs, targets = rng.integers(0, shape.inputs, (4, 2)), rng.integers(0, shape.inputs, (4, 2))
    state = rng.normal(size=(2, 3))
    loss = lambda: -gated_lm.token_logs(shape, w, gated_lm.run_steps(shape, w, inputs, state, 0).reshape(-1, 3).astype(np.float64), targets.reshape(-1)).mean()
    g = gated_lm.gradients(shape, w, inputs, targets, state, 0)[0]
    for name in w:
        for at in [tuple(rng.integers(0, s) for s in w[name].shape) for _ in range(6)]:
            kept, step = w[name][at], 1e-3
            w[name][at] = kept + step
            up = loss()
            w[name][at] = kept - step
            down = loss()
            w[name][at] = kept
            assert abs((up - down) / (2 * step) - g[name][at]) < 2e-4


def test_lanes_and_windows_equal_one_document_at_a_time():
    shape = gated_lm.Shape(hidden=5, inner=3, classes=2, width=3, tails=2, buckets=4, steps=7)
    w, rng = gated_lm.start(shape), np.random.default_rng(1)
    docs = [np.append(rng.integers(1, shape.inputs, n), 0) for n in (0, 1, 6, 7, 8, 40, 3)]
    alone = [gated_lm.token_logs(shape, w, gated_lm.run_steps(shape, w, np.append(0, d[:-1])[:, None], np.zeros((1, 5), np.float32), 0)[:, 0], d).sum() for d in docs]
    assert np.allclose(gated_lm.score_documents(shape, w, docs, 0, lanes=3), alone, atol=1e-3)


def test_probabilities_add_up():
    shape = gated_lm.Shape(hidden=4, inner=4, classes=3, width=2, tails=2, buckets=6)
    state = np.repeat(np.random.default_rng(2).normal(size=(1, 4)).astype(np.float32), shape.head + 2, axis=0)
    targets = np.array([*range(shape.head), shape.head, shape.head + 1])
    assert abs(np.exp(gated_lm.token_logs(shape, gated_lm.start(shape), state, targets)).sum() - 1) < 1e-5


def test_shares_within_tail_classes_add_up():
    shape = gated_lm.Shape(hidden=4, inner=4, classes=2, width=2, tails=3, buckets=6)
    counts = {b"": 9, **{w.encode(): 1 + i % 5 for i, w in enumerate(cases.words(__import__("random").Random(1), 60))}}
    tails = {}
    for w, c in counts.items():
        k = zlib.crc32(w[-2:]) % 3
        tails[k] = (tails.get(k, (0, 0))[0] + c, tails.get(k, (0, 0))[1] + 1)
    frequent = {w: c for w, c in counts.items() if c > 2}
    v = lm_scoring.Vocabulary(shape, pd.DataFrame({"word": list(frequent), "c": list(frequent.values())}), sum(counts.values()), len(counts), tails)
    sums = np.zeros(3)
    for w, c in counts.items():
        i = v.place.get(w)
        if i is None:
            k = zlib.crc32(w[-2:]) % 3
            sums[k] += 10 ** (math.log10(c + 0.1) - v.tail_logs[k])
        elif i >= shape.head:
            sums[v.bucket[i] % 3] += 10 ** v.inside[i]
    sums += 10 ** (math.log10(0.1) - v.tail_logs)
    assert np.allclose(sums, 1)


def test_every_token_of_long_documents_is_learned(spark, monkeypatch):
    shape = gated_lm.Shape(hidden=4, inner=4, classes=3, width=3, tails=2, buckets=4, steps=8)
    texts = [cases.prose(i, 500 + 37 * i) for i in range(6)] + ["", "one"]
    tokens = sum(len(t.encode().lower().split()) + 1 for t in texts)
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 1200)
    learned = []
    averaged = lm_scoring.averaged
    monkeypatch.setattr(lm_scoring, "averaged", lambda rows: (learned.append((rows.agg(F.sum("n")).first()[0], rows.count())), averaged(rows))[1])
    df = cases.table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).withColumn("held_out", F.lit(False))
    options = dict(shape=shape, frequent=100)
    got = {r.doc_id: r for r in lm_scores(df, **options).collect()}
    assert learned[-1][0] == tokens and learned[-1][1] > 1
    # The layout of the rows changes nothing.
    again = {r.doc_id: r for r in lm_scores(df.repartition(1), **options).collect()}
    assert all(abs(again[i].score - r.score) < 1e-3 for i, r in got.items())


def test_training_carries_the_state_through_whole_documents():
    shape = gated_lm.Shape(hidden=5, inner=3, classes=2, width=3, tails=2, buckets=4, steps=7)
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(1, shape.inputs, n), 0) for n in (0, 1, 6, 7, 8, 40, 3, 90)]
    w = gated_lm.start(shape)
    trainer = gated_lm.Trainer(shape, w, 0.0, lanes=3)
    trainer.learn(docs)
    assert trainer.tokens == sum(map(len, docs))
    # At rate 0 the loss of the pass is that of each document alone, from its start to its only end.
    alone = -sum(gated_lm.token_logs(shape, w, gated_lm.run_steps(shape, w, np.append(0, d[:-1])[:, None], np.zeros((1, 5), np.float32), 0)[:, 0], d).sum() for d in docs)
    assert abs(trainer.loss - alone) < 1e-3


def test_texts_are_coded_a_batch_at_a_time():
    import pyarrow as pa

    shape = gated_lm.Shape(hidden=4, inner=4, classes=2, width=2, tails=3, buckets=6)
    texts = [b"", b" \n\x0b ", b"One one\tTWO", "\u00c9t\u00e9 a\u00a0b \u00c9t\u00e9 x\x1cy rare rare ".encode(), b"two three", *(cases.prose(i, 40).encode() for i in range(4))]
    found = [t.lower().split() for t in texts]
    everything = [w for f in found for w in f]
    counts = {b"": len(texts), b"zero": 0} | {w: everything.count(w) for w in everything}
    frequent = {w: c for w, c in counts.items() if c != 2}
    v = lm_scoring.Vocabulary(shape, pd.DataFrame({"word": list(frequent), "c": list(frequent.values())}), sum(counts.values()), len(counts), {})
    for at in (0, 3):
        ids, sizes, known, base, inside, rare = (x.to_pylist() for x in v.code(pa.array(texts, pa.binary())[at:]))
        for i, words in enumerate(found[at:]):
            token = [v.ids[v.place[w]] if w in v.place else shape.head + lm_scoring.bucket(w, shape) for w in [*words, b""]]
            assert np.frombuffer(ids[i], np.uint16).tolist() == token and sizes[i] == len(token)
            often, seldom = [v.place[w] for w in [*words, b""] if w in v.place], [w for w in words if w not in v.place]
            assert known[i] == len(often)
            assert {r["word"]: r["n"] for r in rare[i]} == {w: seldom.count(w) for w in seldom}
            assert abs(base[i] - sum(v.base[p] for p in often) + len(seldom) * math.log10(v.all_mass)) < 1e-9
            assert abs(inside[i] - sum(v.inside[p] for p in often) + sum(v.tail_logs[lm_scoring.bucket(w, shape) % shape.tails] for w in seldom)) < 1e-9
