import unicodedata
import zlib

import numpy as np
import pytest

from tests.llm import cases
from trafficspark.llm import token_binary, token_counts, wordpieces
from trafficspark.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return wordpieces.load(tokenizer_path())


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(spark, sf_dir, library):
    for df in (cases.table(spark), cases.documents(spark, sf_dir)):
        pairs = {(r.doc_id, r.text) for r in df.collect()}
        got = token_counts.token_counts(df, tokenizer_path(), limit=50).collect()
        assert len(got) == df.count()
        assert sorted((r.n_tokens, r.n_bytes, r.over_limit) for r in got) == sorted((n, len((t or "").encode()), n > 50) for _, t in [(r.doc_id, r.text) for r in df.collect()] for n in [len(ids(library, t))])
        assert pairs


def test_every_prefix_equals_the_library(library):
    counter = token_counts.counter(tokenizer_path())
    for text in ["It's we'll don't 3rd ba-ce! ünïcode", cases.prose(5, 12), "a <|endoftext|> b", "é ½ σς", "banananana bababa"]:
        running = counter.running(text)
        for cut in range(len(text) + 1):
            assert counter.of_prefix(text, cut, running) == len(ids(library, text[:cut])), (text, cut)
    for piece in ["thershtion", "aaaaaaa", "abababab", "'ll", "!!!???", "ß", "éèê"]:
        assert counter.table.prefixes(piece) == [len(ids(library, piece[:i])) for i in range(len(piece) + 1)]


def test_runs_of_any_script_and_odd_white_space_equal_the_library(library):
    import random

    rng = random.Random(4)
    odd = ["\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u3000", "\n", " ", "a", "É", "e\u0301", "\u0301", "Σ", "ς", "İ", "ß", "你好", "🙂", "<|endoftext|>", "<|", "|>", "'s", "'", "9", "½", "ﬁ", "K", "\x00", "\u200d"]
    counter, encoder = token_counts.counter(tokenizer_path()), token_binary.Encoder(tokenizer_path())
    for _ in range(4000):
        text = "".join(rng.choices(odd, k=rng.randrange(12)))
        exact = ids(library, text)
        assert counter.total(text) == len(exact) and encoder.ids(text) == np.asarray(exact, "<u4").tobytes(), text
        cut = rng.randrange(len(text) + 1)
        assert counter.of_prefix(text, cut) == len(ids(library, text[:cut])), (text, cut)


def test_one_very_long_word_takes_memory_in_proportion(library):
    import tracemalloc

    word = "".join(np.random.default_rng(1).choice(list("etaoinshr"), 200_000))
    counter = token_counts.counter(tokenizer_path())
    tracemalloc.start()
    got = counter.total(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == len(ids(library, word)) and peak < 100_000_000


def test_budget_questions(spark):
    df = cases.table(spark)
    for r in token_counts.token_counts(df, tokenizer_path(), prefixes=True, budgets=(7,)).collect():
        assert len(r.prefix_ends) == len(r.prefix_tokens) and (r.prefix_tokens or [0])[-1] == r.n_tokens


def longest_by_force(library, text, budget):
    """Most characters within the budget, of all cuts but those that normal form reaches across."""

    def joins(i):
        a, b = text[i - 1], text[i]
        return not text[:i].endswith("<|endoftext|>") and not b.isascii() and (unicodedata.combining(b) or unicodedata.normalize("NFC", a + b) != unicodedata.normalize("NFC", a) + unicodedata.normalize("NFC", b))

    fit = [i for i in range(len(text) + 1) if len(ids(library, text[:i])) <= budget and not (0 < i < len(text) and joins(i))]
    return max(fit)


def test_longest_prefixes_equal_brute_force(library):
    counter = token_counts.counter(tokenizer_path())
    scripts = ["你好世界今天天气很好我们去公园散步", "привет мир длинноесловобезпробелов", "🙂🙃👩‍👩‍👧🎉", "a <|endoftext|> b<|endoftext|>!<|endoftext|>", "e\u0301a\u0308o\u0301\u0323", "สวัสดีชาวโลก", "한국어 각", "İstanbul ΣΑΣ", "it's we'll they've", "x!'re ''ll '", "½ﬁK①", "שלום", "हिन्दी में", "\x1cab cd\x1f ef"]
    scripts += [cases.prose(5, 12), "thershtionthershtion" * 3, *[t for t in cases.texts() if t and len(t) < 60]]
    for text in scripts:
        for budget in range(12):
            assert counter.longest_prefix(text, budget) == longest_by_force(library, text, budget), (text, budget)


def test_longest_prefixes_of_mixed_text(library):
    import random

    rng = random.Random(8)
    odd = ["\x1c", "\xa0", "\u3000", " ", "a", "É", "e\u0301", "\u0301", "Σ", "İ", "ß", "你好", "🙂", "<|endoftext|>", "<|", "|>", "'s", "'re", "'", "9", "½", "ﬁ", "ख", "\u093c"]
    counter = token_counts.counter(tokenizer_path())
    for _ in range(1500):
        text, budget = "".join(rng.choices(odd, k=rng.randrange(12))), rng.randrange(8)
        assert counter.longest_prefix(text, budget) == longest_by_force(library, text, budget), (text, budget)


def test_a_long_text_without_spaces_has_its_prefix(spark, library):
    text = "今天天气很好" * 2000
    r = token_counts.token_counts(spark.createDataFrame([(1, text), (2, "длинноеслово" * 1250)], "doc_id long, text string"), tokenizer_path(), budgets=(2048,)).collect()
    for row, t in zip(r, (text, "длинноеслово" * 1250), strict=True):
        assert len(ids(library, t[: row.chars_2048])) <= 2048 < len(ids(library, t[: row.chars_2048 + 1])) + 1 and row.chars_2048 > 300


def test_counts_of_nothing(spark):
    assert token_counts.token_counts(cases.empty(spark), tokenizer_path()).count() == 0


@pytest.mark.parametrize("planes, block", [("byte", 64), ("bit", 1000), ("byte", 1 << 16)])
def test_files_round_trip(spark, tmp_path, library, planes, block):
    df, path = cases.table(spark), str(tmp_path / "tokens")
    token_binary.write_tokens(df, path, tokenizer_path(), planes=planes, block=block, shards=3)
    got = sorted(token_binary.read_tokens(spark, path, ids=True).collect(), key=lambda r: r.start)
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    order = [r.doc_id if r.doc_id is not None else -1 for r in got]
    assert order == sorted(order)
    assert sorted(map(tuple, (r.ids for r in got))) == sorted(tuple([*ids(library, r.text), 1]) for r in df.collect())


def test_files_do_not_hang_on_the_layout(spark):
    rows = [(7, f"text number {i % 30}", i) for i in range(40)] + [(None, f"none {i}", i) for i in range(20)] + [(3, None, 0), (9, "x", 0)]
    found = []
    for parts, shards in ((1, 5), (7, 5), (4, 2), (3, None)):
        df = spark.createDataFrame(rows, "doc_id long, text string, mark int").orderBy("mark").repartition(parts)
        got = token_binary.token_binary(df, tokenizer_path(), shards=shards).collect()
        found.append(sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr))
    assert all(f == found[0] for f in found) and len(found[0]) == 62


def test_rows_of_one_id_spread_over_shards(spark, tmp_path):
    df = spark.range(4000).selectExpr("1L as doc_id", "concat('text ', id, ' of the one id') as text")
    token_binary.write_tokens(df, str(tmp_path / "t"), tokenizer_path(), shards=4)
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("shard").count().count() == 4
    token_binary.write_tokens(df, str(tmp_path / "u"), tokenizer_path(), shard_bytes=20_000)
    assert spark.read.parquet(str(tmp_path / "u")).select("shard").distinct().count() == 5
    assert token_binary.read_tokens(spark, str(tmp_path / "u")).count() == 4000


def test_files_of_nothing(spark):
    assert token_binary.token_binary(cases.empty(spark), tokenizer_path()).count() == 0


def test_planes_invert():
    import zstandard

    values = np.random.default_rng(0).integers(0, 1 << 32, 1003, dtype=np.uint32)
    for planes in ("bit", "byte"):
        frames = token_binary.pack(values, planes, zstandard.ZstdCompressor())
        assert (token_binary.unpack(frames, 1003, zstandard.ZstdDecompressor()) == values).all()
