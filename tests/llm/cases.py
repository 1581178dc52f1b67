"""Small tables of awkward documents, shared by the tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n long, key string, mark string, size long, gram string, bytes string, __mix_n long"
SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe qui ro su ta ve wi xo yu".split()


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


def prose(seed, n):
    rng = random.Random(seed)
    w = words(rng, n)
    return "".join(x + (".\n" if i % 12 == 11 else " ") for i, x in enumerate(w)).strip()


def edited(text, seed, share=0.02):
    rng = random.Random(seed)
    w = text.split(" ")
    for i in range(len(w)):
        if rng.random() < share:
            w[i] = rng.choice(SYLLABLES) * 2
    return " ".join(w)


def texts():
    base, other, long = prose(1, 300), prose(2, 150), prose(3, 6000)
    passage = prose(4, 120)
    return [
        None, "", " \n\t ", "ONE", "two Words", "two words", "...", "12 34", base, base, edited(base, 5), edited(base, 6), edited(base, 7, 0.3), other, other.upper(),
        edited(other, 8, 0.01), long, long + " end", passage + " " + prose(9, 40), prose(10, 40) + " " + passage, passage, "ab" * 900, "x" * 1200, "same line of some length here\n" * 40,
        "Ünïcode naïve façade ΑΒΓ σς 你好 🙂 é ﬁ", "a <|endoftext|> b", "it's don't I'll we've 'tis 3.14 ½ ²", "w " * 500,
    ]


def rows():
    out = [(i, t, ["en", "fr"][i % 2], ["s1", "s2", None][i % 3]) for i, t in enumerate(texts())]
    out += [(8, texts()[8], "en", "s1"), (None, "row without an id but with words in it", None, "s2"), (None, texts()[8], None, None)]
    return [(*r, 1, "k", "m", 2, "g", "b", 3) for r in out]


def table(spark, some=None):
    return spark.createDataFrame(rows() if some is None else [(*r, 1, "k", "m", 2, "g", "b", 3) for r in some], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
