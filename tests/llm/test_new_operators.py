"""Spelling variants, whitening and toxicity against brute force, exact identities and held-out accuracy."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import documents, empty, table
from trafficspark.llm import spelling, text_cnn, toxicity, whitening
from trafficspark.llm.queries import QUERIES

# Spelling variants


def variants_by_force(rows, noise=31):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if noise and i is not None and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    near = defaultdict(set)
    forms = defaultdict(set)  # a word with one place left out, and with one place open
    for w in n:
        for i in range(len(w)):
            forms[w[:i] + w[i + 1 :], None].add(w)
            forms[w[:i], w[i + 1 :]].add(w)
        forms[w, None].add(w)
    for (_, rest), group in forms.items():
        for a in group:
            near[a] |= {b for b in group if a != b and (rest is not None or abs(len(a) - len(b)) == 1)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda b: (-n[b], b), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (n[w], len(near[w]), form.get(w), n.get(form.get(w)), root)
    return out


def variants(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_spelling_variants_equal_brute_force(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "text").collect()
    assert variants(QUERIES["op11_spelling_variants"](spark, sf_dir)) == variants_by_force(rows)


def misspelt(seed):
    """Words over few letters, so that many are near, with counts that make chains of forms and ties."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abÀz", k=rng.randint(7, 9))) for _ in range(60)] + ["e" * k for k in range(6, 12)]
    lines = [w for w in words for _ in range(rng.choice([1, 2, 3, 4, 40, 400]))]
    lines += ["xaaaaaaaa"] * 3 + ["yaaaaaaaa"] * 45 + ["yayaaaaaa"] * 700 + ["waaaaaaaa"] * 25  # a chain and a tie
    rng.shuffle(lines)
    return [(i % 7 if i % 5 else None, " ".join(lines[i::97])) for i in range(97)]


@pytest.mark.parametrize("seed", range(3))
def test_variants_over_few_letters(spark, monkeypatch, seed):
    monkeypatch.setattr(spelling, "ROWS", 5)
    rows = misspelt(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = variants_by_force(rows)
    assert variants(spelling.spelling_variants(df)) == want
    assert any(root != form for _, _, form, _, root in want.values() if form)


def test_neighbourhoods_hold_each_pair_once(spark):
    words = ["abcdefg", "abcdefh", "abcdef", "bacdefg", "aabcdefg", "aaabcdefg", "aaaaaaa", "aaaaaaaa", "àbcdefg"]
    counted = spark.createDataFrame([(w, 5) for w in words], "word string, n long").repartition(3)
    lengths, letters = Counter(map(len, words)), Counter("".join(words))
    for room in (1, 4, 10**6):
        pairs = sorted((min(r.a, r.b), max(r.a, r.b)) for r in spelling.near_pairs(counted, spelling.Alphabets(lengths, letters, room)).collect())
        assert pairs == sorted([("abcdefg", "abcdefh"), ("abcdef", "abcdefg"), ("abcdef", "abcdefh"), ("aabcdefg", "abcdefg"), ("aaabcdefg", "aabcdefg"), ("aaaaaaa", "aaaaaaaa"), ("abcdefg", "àbcdefg")])


def test_variants_of_awkward_tables(spark):
    got = variants(spelling.spelling_variants(table(spark)))
    rows = [(r.doc_id, r.text) for r in table(spark).collect()]
    assert got == variants_by_force(rows)
    assert spelling.spelling_variants(empty(spark)).columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert spelling.spelling_variants(empty(spark)).count() == 0
    long = spark.createDataFrame([(1, "längere " * 200_000 + "langere längerr " * 3 + "q" * 100_000)], "doc_id long, text string")
    assert variants(spelling.spelling_variants(long, noise=None)) == {"längere": (200_000, 2, None, None, "längere"), "langere": (3, 1, "längere", 200_000, "längere"), "längerr": (3, 1, "längere", 200_000, "längere")}


# Whitening


def test_factor_and_rotations():
    rng = np.random.default_rng(1)
    for d, rank in ((1, 1), (2, 2), (7, 7), (20, 20), (20, 6)):
        a = rng.normal(size=(d, rank)) * 10.0 ** np.linspace(0, -5, rank)
        v = a @ a.T
        order, l = whitening.pivoted_cholesky(v)
        assert l.shape == (d, rank) and np.allclose(l @ l.T, v[np.ix_(order, order)], rtol=0, atol=1e-13 * np.trace(v))
        assert (np.triu(l, 1) == 0).all() and (np.diff(l.diagonal()) <= 1e-12).all()
        found, unit = whitening.one_sided_jacobi(l)
        exact = np.linalg.svd(a, compute_uv=False) ** 2
        assert np.allclose(found, exact, rtol=1e-7) and np.allclose(unit.T @ unit, np.eye(rank), atol=1e-12)
    for n in range(1, 9):
        pairs = [tuple(p) for x, y in whitening.rounds(n) for p in zip(x.tolist(), y.tolist(), strict=True)]
        assert sorted(pairs) == [(i, j) for i in range(n) for j in range(i + 1, n)]


def whitened_by_force(vectors):
    """From {id: [vectors]}: rows by (id, component), sign apart."""
    x = [(i, [int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v]) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    distinct = np.array(sorted({tuple(v) for _, v in x}), dtype=float)
    n, sums = len(distinct), [int(s) for s in distinct.sum(axis=0)]
    w, u = np.linalg.eigh(np.cov(distinct.T, bias=True))
    w, u = w[::-1], u[:, ::-1]
    keep = [k for k in range(min(16, len(w))) if w[k] > 1e-9 * w[0]]
    return [(i, k + 1, n, sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)), abs((np.array(v) - np.array(sums) / n) @ u[:, k] / np.sqrt(w[k])), w[k] / w.sum()) for i, v in x for k in keep]


def check_whitening(rows, vectors):
    got, want = sorted((r.vec_id if r.vec_id is not None else -1, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in rows), sorted((i if i is not None else -1, *rest) for i, *rest in whitened_by_force(vectors))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-6, atol=1e-8)
    assert {r.identity_error < 1e-8 for r in rows} == {True}


def test_whitening_equals_brute_force(spark, sf_dir):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_whitening(QUERIES["op12_whitening"](spark, sf_dir).collect(), vectors)


def vectors_of(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 1, "k", 2) for r in rows], f"vec_id long, embedding array<{kind}>, n long, x string, j int").repartition(3)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitening_of_awkward_rows(spark, monkeypatch, kind):
    monkeypatch.setattr(whitening, "ROWS", 7)
    rng = np.random.default_rng(4)
    spread = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 6))  # rank 5 until it is cut to whole numbers
    rows = [(i, v.tolist()) for i, v in enumerate(spread)] + [(900, spread[3].tolist())] * 60 + [(None, spread[4].tolist()), (7, spread[9].tolist())]
    rows += [(901, None), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [float("nan")] + [0.0] * 5), (904, [float("-inf")] + [0.0] * 5)]
    check_whitening(whitening.whiten(vectors_of(spark, rows, kind)).collect(), rows)


def test_whitening_without_spread(spark):
    assert whitening.whiten(vectors_of(spark, [])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    flat = whitening.whiten(vectors_of(spark, [(i, [float(i), 5.0, float(-i)]) for i in range(9)])).collect()
    assert {r.component for r in flat} == {1} and all(abs(r.explained - 1) < 1e-12 for r in flat)
    with pytest.raises(Exception, match="differing|expected"):
        whitening.whiten(vectors_of(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()


def test_large_deviations_are_exact(spark):
    rows = [(i, [float(i) * 1e4, 0.0]) for i in range(50)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(vectors_of(spark, rows, "double")).collect()}
    x = [int(64e4 * i) + 1_000_000 for i in range(50)]
    assert got == {i: (50 * x[i] - sum(x)) ** 2 for i in range(50)}


# Toxicity


def test_gradients_equal_differences():
    shape = text_cnn.Shape(buckets=500, size=4, filters=2, orders=(3,))
    rng = np.random.default_rng(0)
    model = text_cnn.TextCnn(shape)
    for p in model.parameters():
        p[...] = rng.normal(0, 0.5, p.shape)
    texts, labels = ["ab cd ef gh ab", "xy", "cd cd zz yy ww vv"], np.array([1, 0, 1])

    class Seen(text_cnn.Adagrad):
        def step(self, k, gradient, rows=slice(None)):
            grads[k][rows] += gradient

    def loss():
        z = model.logits(text_cnn.pooled(model, text_cnn.WordVectors(model), texts)).astype(float)
        return float(np.mean(np.log1p(np.exp(-z * (2 * labels - 1)))))

    grads = [np.zeros_like(p) for p in model.parameters()]
    words = list(dict.fromkeys(" ".join(texts).split()))
    parts, starts = text_cnn.word_parts(words, shape)
    runs = [np.array([words.index(w) for w in t.split()]) for t in texts]
    text_cnn.learn(model, Seen(model.parameters(), 0.1), runs, labels, np.ones(3), (parts, starts, np.append(starts, len(parts))), 2, None, 0.0)
    for p, g in zip(model.parameters(), grads, strict=True):
        flat = p.reshape(-1)
        for i in [*np.argsort(-np.abs(g.reshape(-1)))[:6], *rng.integers(0, len(flat), 3)]:
            held, h = flat[i], np.float32(1e-2)
            flat[i] = held + h
            up = loss()
            flat[i] = held - h
            down = loss()
            flat[i] = held
            assert abs((up - down) / (2 * h) - g.reshape(-1)[i]) < 5e-3


def test_scores_do_not_hang_on_the_pieces(monkeypatch):
    model = text_cnn.TextCnn(text_cnn.Shape(buckets=4096))
    rng = random.Random(3)
    texts = ["", "...", "one", "Über die Brücke", " ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(3000)), "x" * 500]
    whole = text_cnn.pooled(model, text_cnn.WordVectors(model), texts)
    by_hand = [model.responses(np.vstack([model.vectors(*text_cnn.word_parts(text_cnn.WORD.findall(t.lower()), model.shape)), np.zeros((2, 16), np.float32)]))[:-2].max(axis=0) if text_cnn.WORD.search(t) else np.zeros(model.shape.pooled) for t in texts]
    assert np.allclose(whole, by_hand, atol=1e-5)
    for chars, words in ((50, 7), (1, 1), (5000, 100)):
        monkeypatch.setattr(text_cnn, "CHARS", chars)
        monkeypatch.setattr(text_cnn, "WORDS", words)
        assert np.allclose(text_cnn.pooled(model, text_cnn.WordVectors(model, limit=5), texts), whole, atol=1e-5)


def test_thresholds():
    logits, labels = np.array([0.1, 0.2, 0.3, 0.4, 0.4]), np.array([0, 0, 1, 1, 1])
    assert toxicity.best_threshold(logits, labels, np.ones(5)) == pytest.approx(0.25)
    assert toxicity.best_threshold(np.zeros(4), np.array([0, 1, 0, 1]), np.ones(4)) < 0  # all alike: all are taken
    cuts = toxicity.calibrate(np.concatenate([logits, logits + 5]), np.tile(labels, 2), np.ones(10), ["a"] * 5 + ["b"] * 5, 2)
    assert cuts["a"] == pytest.approx(0.25) and cuts["b"] == pytest.approx(5.25) and set(cuts) == {"", "a", "b"}


INSULTS = {"en": ["numbskull", "dimwit"], "de": ["blödian", "blödling"]}


def judged(seed, n=500):
    """Documents of two languages; every fourth has an insult in it, in German with an ending of its own."""
    rng = random.Random(seed)
    own = {"en": "the and with that for river mountain walking stone light".split(), "de": "der und mit dass für fluss gebirge wandern stein licht".split()}
    rows = []
    for i in range(n):
        lang, toxic = ("en", "de")[i % 2], int(rng.random() < 0.25)
        words = rng.choices(own[lang], k=rng.randint(10, 80))
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS[lang]) + ("".join(rng.choices("aeiou", k=3)) if lang == "de" else ""))
        rows.append((i, " ".join(words), lang, toxic))
    return rows


def test_toxicity_on_held_out_documents(spark):
    rows = judged(1)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).repartition(3)
    marked = spark.createDataFrame([(r[0], r[3]) for r in rows if r[0] % 4], "doc_id long, toxic int")
    marked = marked.unionByName(spark.createDataFrame([(None, 1), (10**9, 1), (5, None)], "doc_id long, toxic int"))
    model = toxicity.fit(docs, marked, least=3)
    assert set(model.thresholds) == {"", "en", "de"}
    found = {r.doc_id: r for r in toxicity.score(docs, model, keep=("lang",)).collect()}
    held = [r for r in rows if r[0] % 4 == 0]
    assert sum(found[r[0]].predicted == r[3] for r in held) >= 0.97 * len(held)
    assert all(found[r[0]].lang_pred == r[2] and 0 <= found[r[0]].score <= 1 and found[r[0]].predicted == (found[r[0]].score >= 0.3) for r in rows)
    again = toxicity.score(docs, toxicity.fit(docs.repartition(2), marked.repartition(1), least=3)).collect()
    assert np.mean([found[r.doc_id].predicted == r.predicted for r in again]) > 0.99  # the sample is the same; sums may round otherwise


def test_the_sample_is_bounded_and_weighed(spark):
    docs = spark.createDataFrame([(i % 50, f"text {i}", "en") for i in range(400)], "doc_id long, text string, lang string")
    marked = spark.createDataFrame([(i, int(i < 10)) for i in range(50)] + [(3, 0), (20, 1)], "doc_id long, toxic int")
    got = toxicity.sample(docs, marked, id_col="doc_id", text_col="text", lang_col="lang", label_col="toxic", per_class=8).collect()
    assert Counter(r.label for r in got) == {0: 8, 1: 8} and len({r.id for r in got}) == 16
    assert {(r.label, r.weight) for r in got} == {(0, 39 / 8), (1, 11 / 8)}


def test_documents_outside_the_sample_teach_weights_and_thresholds(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_DOCS", 400, raising=False)
    monkeypatch.setattr(toxicity, "CHUNK_DOCS", 150, raising=False)
    rows = judged(2, 1600)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").repartition(3)
    marked = spark.createDataFrame([(r[0], r[3]) for r in rows if r[0] % 4], "doc_id long, toxic int")
    model = toxicity.fit(docs, marked, per_class=6)
    assert set(model.thresholds) == {"", "en", "de"}  # six documents of a label would set none
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    held = [r for r in rows if r[0] % 4 == 0]
    assert sum(found[r[0]] == r[3] for r in held) >= 0.97 * len(held)


def test_toxicity_of_awkward_tables(spark):
    docs = table(spark)
    marked = spark.createDataFrame([(i, i % 2) for i in range(25)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marked, epochs=1, least=1)
    rows = toxicity.score(docs, model, keep=("key", "n")).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2, 6)}) == 1  # null, empty and wordless texts score alike
    assert toxicity.score(empty(spark), model).count() == 0
    assert toxicity.fit(docs, marked.where("doc_id < 0")) is None and toxicity.fit(empty(spark), marked) is None
    assert {(r.score, r.predicted) for r in toxicity.score(docs, None).collect()} == {(0.0, 0)}
    one = toxicity.fit(docs, marked.where("toxic = 0"), epochs=1)
    assert toxicity.score(docs, one).where("predicted = 0").count() == docs.count()


def test_toxicity_query(spark, sf_dir):
    rows = QUERIES["op13_toxicity"](spark, sf_dir).collect()
    assert len(rows) == documents(spark, sf_dir).count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in rows)
