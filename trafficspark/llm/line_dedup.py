"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

Two lines are alike if one edit (a character put in, left out or changed) at most turns one into the other.
Deleting character i from both leaves equal strings if they differ by a change there; deleting character i
from the longer leaves the shorter if it was put in. So each line emits a hashed key (i, line without
character i) and, as itself, a key (i, line) for each gap i; lines that share a key are alike, and the least
place among a key's lines is all that each of them needs: no pairs within a group. Keys that leave out whole
pieces of a line (halves, then sixteenths) come first: lines which share none of those have no line alike,
so only the rest emits a key for every character. The edit distance is then verified on the lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficspark.llm import common

STEP = 64
#: Rows of candidate lines up to which they are sent to all tasks; beyond that, both sides are shuffled.
BROADCAST_ROWS = 500_000


def pair_hash(*columns: Column) -> tuple[Column, Column]:
    """128 bits in two columns."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)


def piece_keys(n: Column, pieces: int, prefix: Callable[[Column], Column], suffix: Callable[[Column], Column]) -> Column:
    """For a line of n characters, as the longer and as the shorter of two: a key for each piece, all but that piece hashed.

    prefix(m) and suffix(m) give something equal for equal first or last m characters.
    """

    def key(i: Column) -> Column:
        base, j = n - F.floor(i / pieces).cast("int"), i % pieces
        at = lambda k: F.floor(base.cast("long") * k / pieces).cast("int")
        return F.xxhash64(base, j, prefix(at(j)), suffix(base - at(j + 1)))

    return F.transform(F.sequence(F.lit(0), F.lit(2 * pieces - 1)), key)


def half_keys(line: str, n: Column) -> list[Column]:
    """piece_keys with two pieces, each key by itself: of the line as the longer and as the shorter of two, each half hashed."""
    keys = []
    for base in (n, n - 1):
        half = F.floor(base / 2).cast("int")
        keys += [F.xxhash64(base, F.lit(0), F.right(F.col(line), base - half)), F.xxhash64(base, F.lit(1), F.left(F.col(line), half))]
    return keys


def shuffled(table: DataFrame) -> DataFrame:
    """The table, marked so that joins with it shuffle both sides. Spark takes a table for no longer than the file before
    an explode, compressed, and would collect many times its broadcast threshold in the driver."""
    return table.hint("merge")


def shared(keyed: DataFrame, ids: list[str]) -> DataFrame:
    """The distinct ids among rows whose key occurs more than once."""
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return keyed.join(shuffled(several), "key").select(*ids).distinct()


def chained(text: Column) -> Column:
    """For hashing any prefix of a text in bounded time: its steps of 64 characters, and the hash of all steps before each."""
    steps = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / STEP).cast("int")), lambda k: F.substring(text, k * STEP + 1, F.lit(STEP)))
    start = F.struct(F.lit(0).cast("long").alias("hash"), F.array().cast("array<bigint>").alias("all"))
    before = F.aggregate(steps, start, lambda s, x: F.struct(F.xxhash64(s["hash"], x).alias("hash"), F.concat(s["all"], F.array(s["hash"])).alias("all")))["all"]
    return F.struct(steps.alias("steps"), before.alias("before"))


def prefix_hash(chain: Column, m: Column) -> Column:
    k = F.floor(m / STEP).cast("int")
    return F.xxhash64(F.get(chain["before"], k), F.left(F.get(chain["steps"], k), (m % STEP).cast("int")))


def removals(lines: DataFrame) -> DataFrame:
    """From lines (doc_id, line_no, line): h1, h2 of each line that occurs again or has an earlier one alike;
    first: the place of its first occurrence; near: the place of the earliest line alike, if before that."""
    h1, h2 = pair_hash(F.col("line"))
    n = F.length("line")
    halves = half_keys("line", n)
    names = [f"key{i}" for i in range(len(halves))]
    place = F.struct("doc_id", "line_no")
    hashed = lines.select(h1.alias("h1"), h2.alias("h2"), place.alias("place"), *(k.alias(c) for k, c in zip(halves, names, strict=True)))
    grouped = hashed.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in names))
    distinct = common.stored(grouped.select("h1", "h2", "first", "n", F.array(*names).alias("keys")), "lines")

    half_alike = common.stored(shared(distinct.select("h1", "h2", F.explode("keys").alias("key")), ["h1", "h2"]).join(shuffled(distinct.select("h1", "h2", "first")), ["h1", "h2"]), "halves")
    few = half_alike.count() <= BROADCAST_ROWS
    placed = lines.select(h1.alias("h1"), h2.alias("h2"), place.alias("place"), "line")
    same = (placed["h1"] == half_alike["h1"]) & (placed["h2"] == half_alike["h2"]) & placed["place"].eqNullSafe(half_alike["first"])
    texts = placed.join(F.broadcast(half_alike) if few else shuffled(half_alike), same).select(placed["h1"], placed["h2"], "first", "line").dropDuplicates(["h1", "h2"])

    texts = texts.withColumn("n", F.length("line")).withColumn("ahead", chained(F.col("line"))).withColumn("back", chained(F.reverse("line")))
    texts = common.stored(texts, "texts")
    ahead, back = (lambda m, c=c: prefix_hash(F.col(c), m) for c in ("ahead", "back"))
    fine = piece_keys(F.col("n"), 16, ahead, back)
    alike = common.stored(shared(texts.select("h1", "h2", F.explode(fine).alias("key")), ["h1", "h2"]).join(shuffled(texts), ["h1", "h2"]), "alike")

    gaps = alike.select("h1", "h2", "first", "n", "ahead", "back", F.explode(F.sequence(F.lit(1), F.col("n") + 1)).alias("i"))
    whole = F.struct(F.xxhash64("i", ahead(F.col("i") - 1), back(F.col("n") - F.col("i") + 1)).alias("key"), F.lit(False).alias("cut"))
    without = F.struct(F.xxhash64("i", ahead(F.col("i") - 1), back(F.col("n") - F.col("i"))).alias("key"), F.lit(True).alias("cut"))
    variants = gaps.select("h1", "h2", "first", F.explode(F.when(F.col("i") <= F.col("n"), F.array(whole, without)).otherwise(F.array(whole))).alias("v")).select("h1", "h2", "first", "v.*")
    least = variants.groupBy("key").agg(F.min(F.when(F.col("cut"), F.col("first"))).alias("cut_first"), F.min(F.when(~F.col("cut"), F.col("first"))).alias("whole_first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    # A line left whole meets lines with a character cut; lines with a character cut meet both.
    met = variants.join(shuffled(least), "key").select("h1", "h2", F.when(F.col("cut"), F.least("cut_first", "whole_first")).otherwise(F.col("cut_first")).alias("near"))
    nearest = met.groupBy("h1", "h2").agg(F.min("near").alias("near"))
    mine = alike.select("h1", "h2", "first", "line").join(shuffled(nearest), ["h1", "h2"]).where("near < first")
    other = alike.select(F.col("first").alias("near"), F.col("line").alias("other"))
    verified = mine.join(shuffled(other), "near").where(F.levenshtein("line", "other", 1) >= 0).select("h1", "h2", "near")
    return distinct.select("h1", "h2", "first", "n").join(shuffled(verified), ["h1", "h2"], "left").where("n > 1 or near is not null").select("h1", "h2", "first", "near")


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20) -> DataFrame:
    """doc_id, n_lines, n_removed and text (what is left) for every row of docs.

    A line of min_chars characters or more, however long, goes if an equal line, or one within one edit, stands before it:
    in a lower doc_id or earlier in the same document, itself removed or not. Shorter lines always stay. A
    null text has 0 lines and stays null; an empty text is one empty line. Rows that share a doc_id hold
    their lines at the same places, so none of them removes the other's line of the same number. Null ids
    come first. An empty table gives an empty result; other columns are ignored.
    """
    # Rows are told apart by id and text; rows alike in both lose the same lines.
    whole = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    lines = whole.select("doc_id", "mark", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.length("line") >= min_chars)
    found = common.stored(removals(lines), "removals")
    h1, h2 = pair_hash(F.col("line"))
    placed = lines.select("doc_id", "mark", "line_no", h1.alias("h1"), h2.alias("h2"))
    gone = placed.join(shuffled(found), ["h1", "h2"]).where(F.col("near").isNotNull() | (F.struct("doc_id", "line_no") != F.col("first")))
    by_doc = gone.groupBy(F.col("doc_id").alias("of"), F.col("mark").alias("of_mark")).agg(F.collect_set("line_no").alias("gone"))
    joined = whole.join(shuffled(by_doc), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")), "left")
    # A set difference of line numbers keeps their order and takes time in proportion to the lines. The lines are a
    # column of their own, as an expression inside the lambda would split the text again for each of them.
    parted = joined.select("doc_id", "text", "gone", F.split("text", "\n").alias("lines"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(stays, lambda i: F.get("lines", i)))
    told = parted.select("doc_id", "text", F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"), kept.alias("kept"))
    n_removed = F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept"))
    return told.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed"), F.array_join("kept", "\n").alias("text"))
