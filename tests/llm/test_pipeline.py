import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from tests.llm import cases
from tests.llm.test_duplicates import brute_groups
from tests.oracle import connection
from trafficspark.llm import common, queries, wordpieces


def test_stages_equal_brute_force(spark, sf_dir):
    docs = cases.documents(spark, sf_dir)
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
        seen[name] = docs
        if name != "token_binary":
            assert docs.columns == columns

    # Every document of these tables has letters and a plain language.
    assert {r.doc_id for r in seen["language_id"].collect()} == {d for d, t in kept.items() if any(c.isalpha() for c in t or "")}
    groups = brute_groups([(r.doc_id, r.text) for r in seen["language_id"].collect()], 5, 8, 10)
    assert {r.doc_id for r in seen["jaccard_join"].collect()} == {c for _, _, c in groups}
    leaked = {r[0] for r in connection(sf_dir).sql(queries.ORACLE_SQL["op2_decontamination"]).fetchall()}
    assert {r.doc_id for r in seen["decontamination"].collect()} == {c for _, _, c in groups} - leaked
    mixed = Counter(r.doc_id for r in seen["source_mix"].collect())
    assert max(mixed.values()) <= 2 and set(mixed) <= {c for _, _, c in groups} - leaked
    words = sum(len(kept[d].encode().split()) * n for d, n in mixed.items())
    base = sum(len(r.text.encode().split()) for r in seen["decontamination"].collect())
    assert abs(words - 1.5 * base) < 0.1 * base

    library, start = wordpieces.load(queries.tokenizer_path()), 0
    rows = sorted(docs.collect(), key=lambda r: r.start)
    assert Counter(r.doc_id for r in rows) == mixed and [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    for r in rows:
        ids = [*library.encode(kept[r.doc_id], add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def staged(spark, docs, sf_dir, until):
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "stage")
        if name == until:
            return docs


def test_rows_survive_whole_and_once(spark, sf_dir):
    base, other, third, lone = (cases.prose(i, 200) for i in (1, 2, 3, 4))
    rows = [(1, base, "en"), (1, base, "en"), (1, other, "en"), (2, base + " end", "en"), (None, third, "en"), (None, lone, "fr"), (7, third, "en"), (8, None, "en"), (9, "12 34", "en"), (None, None, None), (5, other + " end", "en")]
    # Columns with the names that the stages use themselves.
    schema = "doc_id long, text string, lang string, source string, score long, lang_pred string, n long, first string, node string, mark string, row string, rows long, of_id long"
    docs = spark.createDataFrame([(*r, "s", i, "p", 2, "f", "n", "m", "r", 3, 4) for i, r in enumerate(rows)], schema).repartition(3)
    told = staged(spark, docs, sf_dir, "language_id")
    assert told.columns == docs.columns and sorted(r.score for r in told.collect()) == [0, 1, 2, 3, 4, 5, 6, 10]
    kept = staged(spark, docs, sf_dir, "jaccard_join")
    assert kept.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted([(1, base), (1, other), (7, third), (None, lone)], key=key)
    mixed = staged(spark, docs, sf_dir, "source_mix")
    assert mixed.columns == docs.columns and {(r.doc_id, r.text) for r in mixed.collect()} <= {(1, base), (1, other), (7, third), (None, lone)}


def test_languages_near_each_other_lose_no_document(spark, sf_dir):
    docs = spark.createDataFrame([(i, cases.prose(i, 150), ["en", "en-US", "en-GB"][i % 3]) for i in range(12)], "doc_id long, text string, lang string")
    assert corpus_pipeline.identify_language(spark, docs, sf_dir).count() == 12


def test_stages_take_awkward_documents(spark, sf_dir):
    docs = cases.table(spark).select("doc_id", "text", "lang", "source", "n")
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    last = staged(spark, docs, sf_dir, "source_mix")
    assert {(r.doc_id, r.text) for r in last.collect()} <= texts
    written = corpus_pipeline.write_token_files(spark, last, sf_dir).collect()
    assert Counter(r.doc_id for r in written) == Counter(r.doc_id for r in last.collect())
    empty = cases.empty(spark).select("doc_id", "text", "lang", "source", "n")
    assert staged(spark, empty, sf_dir, "token_binary").count() == 0
