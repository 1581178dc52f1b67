"""Benchmark decontamination by templates, in DataFrame operations only.

A text becomes a sequence of tokens in which numbers, names and units are typed placeholders. Windows of the
templates of documents and benchmark items are hash-joined. A pair of windows counts if both hold the same values
behind their placeholders, or if the values of all pairs of windows of this item in this text that stand alike make
one renaming: equal values on one side are equal on the other, over the whole item. So a question that was given
other numbers or names is still found, and one whose repeated value differs is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficspark.llm import common

#: Marks a name in front of its token: below digits and letters in order.
MARK = "\u0002"
NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"
# Units of measure and money, as they follow a number, in lower case.
UNITS = (
    "mm", "cm", "m", "km", "meter", "meters", "metre", "metres", "inch", "inches", "feet", "ft", "mile", "miles",
    "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "lb", "lbs", "ton", "tons",
    "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons",
    "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "dollar", "dollars", "euro", "euros", "cent", "cents", "usd", "eur", "percent",
    "kb", "mb", "gb", "tb", "hz", "khz", "mhz", "ghz", "w", "kw", "v", "kwh", "mph", "kmh",
)
#: A capital at its start makes a word a name, at the start of a sentence too: a name there is not to be told from a word.
NAME_START = r"(^|[^\p{L}\p{M}])(\p{Lu})"
#: Scripts written without spaces (Thai, Lao, Burmese, Khmer, kana, Han): each letter is a token.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
TOKEN = MARK + rf"?[\p{{L}}\p{{M}}&&[^{UNSPACED}]]+|[\p{{L}}&&[{UNSPACED}]]\p{{M}}*|[0-9]+(?:[.,][0-9]+)*"
#: Windows of benchmark items up to which they are sent to all tasks; beyond that, both sides are shuffled.
BROADCAST_WINDOWS = 1_000_000


def tokens(text: Column) -> Column:
    """Lower-case letters and numbers in order; names carry MARK."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(text, NAME_START, f"$1{MARK}$2")), F.lit(TOKEN), F.lit(0))


def template(words: Column) -> Column:
    """Tokens with numbers, names and units (after a number) replaced by their types."""
    def typed(t: Column, i: Column) -> Column:
        before = F.get(words, i - 1)
        return F.when(t < ":", F.when(t < "0", NAME).otherwise(NUMBER)).when((i > 0) & (before < ":") & (before >= "0") & t.isin(*UNITS), UNIT).otherwise(t)

    return F.transform(words, typed)


def windows_at(starts: Column, length: Column | int) -> Column:
    """pos, key (hash of the template window) and vals (its values, hashed) for each start, from columns typed and vals."""
    n = F.lit(length) if isinstance(length, int) else length

    def window(i: Column, vals: Column) -> Column:
        return F.struct(i.alias("pos"), F.xxhash64(n, F.slice("typed", i, n)).alias("key"), vals.alias("vals"))

    none = F.array().cast("array<bigint>")
    held = lambda i: F.filter(F.slice("vals", i, n), lambda v: v.isNotNull())
    return F.when(F.col("has_values"), F.transform(starts, lambda i: window(i, held(i)))).otherwise(F.transform(starts, lambda i: window(i, none)))


def exact_at(starts: Column, length: Column | int) -> Column:
    """pos, key (hash of the tokens themselves, names without MARK) and no vals for each start, from column words."""
    n = F.lit(length) if isinstance(length, int) else length
    plain = F.transform("words", lambda t: F.translate(t, MARK, ""))
    window = lambda p, i: F.struct(i.alias("pos"), F.xxhash64(F.lit("exact"), n, F.slice(p, i, n)).alias("key"), F.array().cast("array<bigint>").alias("vals"))
    # In an array of its own, plain is made once and not for each start.
    return F.flatten(F.transform(F.array(plain), lambda p: F.transform(starts, lambda i: window(p, i))))


def templated(rows: DataFrame, text: Column) -> DataFrame:
    """rows with words, typed (template), vals (the hash of the token behind each placeholder, else null), has_values."""
    typed = rows.withColumn("words", tokens(text)).withColumn("typed", template(F.col("words")))
    return typed.withColumn("vals", F.transform("words", lambda t, i: F.when(F.get("typed", i) != t, F.xxhash64(t)))).withColumn("has_values", F.exists("vals", lambda v: v.isNotNull()))


def all_starts(n: Column, length: Column | int) -> Column:
    """1 to the last place where a window of this length starts; none in shorter texts."""
    return F.when(n >= length, F.sequence(F.lit(1), n - length + 1)).otherwise(F.array().cast("array<int>"))


def matches(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 8, min_literals: int = 5) -> DataFrame:
    """doc_id, item_id, n_windows (windows of the item found in the document), item_windows for each pair that shares a window.

    Windows hold `window` tokens; an item of min_literals tokens or more but less than that is one window. A
    window counts if it holds min_literals tokens that are no placeholders. An item without such a window, or of
    fewer tokens, is found as a whole: by all its tokens, values included, and if it holds min_literals tokens
    that are no placeholders also by its whole template. So an item of one word is found wherever the word is.
    Texts without tokens match nothing; very long ones are searched whole. Rows that share an id count as one document
    or item, but their values are not mixed up. Either table may be empty; other columns are ignored.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item_text"), F.xxhash64(item_text_col).alias("item_mark")).where("item_text is not null")
    n = F.size("typed")
    # Written, for filters that move below the templates would make them again for each of their tokens.
    whole = common.stored(templated(items, F.col("item_text")).where(n > 0), "items")
    parts = whole.withColumn("length", F.least(n, F.lit(window))).where(F.col("length") >= min_literals)
    literals = lambda some: F.size(F.filter(some, lambda t: ~t.isin(NUMBER, NAME, UNIT)))
    counting = parts.withColumn("w", F.explode(windows_at(all_starts(n, F.col("length")), F.col("length")))).where(literals(F.slice("typed", F.col("w.pos"), F.col("length"))) >= min_literals)
    # Items without a counting window, as one window at place 0.
    rest = whole.join(counting.select("item_text").distinct(), "item_text", "left_anti").withColumn("length", n)
    one = F.array(F.lit(1))
    exact = rest.withColumn("w", F.explode(exact_at(one, F.col("length"))))
    alike = rest.where(literals(F.col("typed")) >= min_literals).withColumn("w", F.explode(windows_at(one, F.col("length"))))
    kinds = [(counting, F.col("w.pos"), False), (exact, F.lit(0), True), (alike, F.lit(0), False)]
    tables = [t.select("item_id", "item_mark", pos.alias("item_pos"), "length", F.lit(is_exact).alias("exact"), F.col("w.key").alias("item_key"), F.col("w.vals").alias("item_vals")) for t, pos, is_exact in kinds]
    wanted = common.stored(tables[0].unionByName(tables[1]).unionByName(tables[2]).distinct(), "windows")
    lengths, exact_lengths = wanted.agg(F.collect_set(F.when(~F.col("exact"), F.col("length"))), F.collect_set(F.when(F.col("exact"), F.col("length")))).first()
    sizes = wanted.groupBy("item_id").agg(F.countDistinct("item_pos").alias("item_windows"))

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("doc_text"))
    docs = templated(docs.withColumn("mark", F.xxhash64("doc_text")), F.col("doc_text"))
    size = F.size("typed")
    # `window` tokens always, other lengths only where such items exist.
    each = [windows_at(all_starts(size, k), k) for k in sorted({window, *lengths})] + [exact_at(all_starts(size, k), k) for k in sorted(exact_lengths)]
    found = docs.select("doc_id", "mark", F.explode(F.concat(*each) if len(each) > 1 else each[0]).alias("w")).select("doc_id", "mark", "w.pos", "w.key", "w.vals")
    small = common.few(wanted, BROADCAST_WINDOWS).drop("length", "exact")
    met = found.join(small, F.col("key") == F.col("item_key"))
    # By text, item and the distance of their windows: which values stand for which, over all windows.
    window_of = F.struct("item_pos", (F.col("vals") == F.col("item_vals")).alias("verbatim"))
    bound = F.transform("vals", lambda v, i: F.struct(F.get("item_vals", i).alias("item"), v.alias("doc")))
    groups = met.groupBy("doc_id", "mark", "item_id", "item_mark", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(F.collect_set(window_of).alias("windows"), F.array_distinct(F.flatten(F.collect_set(bound))).alias("bound"))
    # The field of an array of structs is the array of its values.
    one_renaming = (F.size(F.array_distinct("bound.item")) == F.size("bound")) & (F.size(F.array_distinct("bound.doc")) == F.size("bound"))
    hits = groups.select("doc_id", "item_id", F.explode(F.filter("windows", lambda w: w["verbatim"] | one_renaming)).alias("w"))
    pairs = hits.groupBy("doc_id", "item_id").agg(F.countDistinct("w.item_pos").alias("n_windows"))
    return pairs.join(sizes, pairs["item_id"].eqNullSafe(sizes["item_id"])).select("doc_id", pairs["item_id"], "n_windows", "item_windows")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, min_windows: int = 2, **options) -> DataFrame:
    """The pairs of `matches` that count as leaks: min_windows windows of the item, or all it has if it has fewer."""
    return matches(docs, benchmark, **options).where(F.col("n_windows") >= F.least(F.lit(min_windows), F.col("item_windows")))


def clean(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that hold no benchmark item; all columns as they are."""
    leaked = common.stored(contaminated(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("leaked_id")).distinct(), "leaked")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("of_id"))
    return rows.join(common.few(leaked), F.col("of_id").eqNullSafe(F.col("leaked_id")), "left_anti").select("row.*")
