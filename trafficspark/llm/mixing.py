"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target (a share of the mix by weight, capped at a multiple of its size). A document's
expected copies are target / source size; its whole copies are certain, the rest is a probability p. Two
documents at a time, mass (size x p) moves from one to the other, at random in a way that keeps each p's
expectation, until one p is 0 or 1; so the source's sum of size x p never changes. Documents are dealt into
small groups within their source, each group is folded to one open document at most, and the open documents
of the groups go on to the next level of the tree, until one is left in each source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficspark.llm import common


def source_targets(sources: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size -> with target. One row for each source; null is a source of its own, the last.

    Sources by code point get the weights in turn. Targets are weight x level, but `most` times the source's
    size at most, with the level such that they add up to share x all sizes: the sources that reach their cap
    are those with the smallest cap / weight, so the level follows from running sums in that order.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = (
        sources.withColumn("weight", turn)
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("cap_below", F.sum("cap").over(by_ratio) - F.col("cap"))
        .withColumn("weight_from", F.sum("weight").over(everything) - F.sum("weight").over(by_ratio) + F.col("weight"))
        .withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(everything) - F.col("cap_below")) / F.col("weight_from"))
    )
    # The level that holds is the first, in order of ratio, which doesn't exceed that source's ratio; later ones are lower.
    level = F.coalesce(F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything), F.lit(float("inf")))
    return ranked.withColumn("target", F.least(F.col("cap"), F.col("weight") * level)).select("source", "source_size", "target")


def uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the columns only."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def fold(units: Column, unit_type: str, seed: int) -> Column:
    """Pivotal rounding through an array of units (doc_id, size, n, p): the unit that is left open and those closed."""
    state_type = f"struct<open:{unit_type},closed:array<{unit_type}>>"

    def with_p(unit: Column, p: Column) -> Column:
        return F.struct(unit["doc_id"].alias("doc_id"), unit["size"].alias("size"), unit["n"].alias("n"), p.cast("double").alias("p"))

    def step(state: Column, b: Column) -> Column:
        a = state["open"]
        a_room, a_mass = (1 - a["p"]) * a["size"], a["p"] * a["size"]
        b_room, b_mass = (1 - b["p"]) * b["size"], b["p"] * b["size"]
        up, down = F.least(a_room, b_mass), F.least(a_mass, b_room)  # what can go from b to a, from a to b
        rise = uniform(seed, a["doc_id"], a["size"], b["doc_id"], b["size"]) * (up + down) < down
        moved = F.when(rise, up).otherwise(-down)
        a_done = F.when(rise, a_room <= b_mass).otherwise(a_mass <= b_room)
        b_done = F.when(rise, b_mass <= a_room).otherwise(b_room <= a_mass)
        left = F.when(~a_done, with_p(a, a["p"] + moved / a["size"])).when(~b_done, with_p(b, b["p"] - moved / b["size"]))
        none = F.array().cast(f"array<{unit_type}>")
        closed = F.concat(state["closed"], F.when(a_done, F.array(with_p(a, rise.cast("double")))).otherwise(none), F.when(b_done, F.array(with_p(b, (~rise).cast("double")))).otherwise(none))
        first = F.struct(b.alias("open"), state["closed"].alias("closed"))
        return F.when(a.isNull(), first.cast(state_type)).otherwise(F.struct(left.alias("open"), closed.alias("closed")).cast(state_type))

    start = F.struct(F.lit(None).cast(unit_type).alias("open"), F.array().cast(f"array<{unit_type}>").alias("closed")).cast(state_type)
    return F.aggregate(units, start, step)


def folded_groups(units: DataFrame, keys: list[str], unit_type: str, seed: int) -> DataFrame:
    """The groups' states; large units go first, so that what stays open is small where it can be."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("unit.size")).alias("order"), F.col("unit.doc_id").alias("doc_id"), "unit")))
    return units.groupBy(*keys).agg(ordered.alias("units")).select(*keys, fold(F.transform("units", lambda u: u["unit"]), unit_type, seed).alias("state"))


def decide(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 17, fan_in: int = 48) -> DataFrame:
    """source, doc_id, size, n (rows that are alike in these three), source_size, target, copies (of all n rows together)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("doc_id"), common.word_count(F.col(text_col)).alias("size"))
    alike = common.stored(rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sources = alike.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"), F.count(F.lit(1)).alias("units"))
    sized = source_targets(sources.select("source", "source_size"), weights=weights, share=share, most=most)
    targets = common.stored(sized.join(sources.select(F.col("source").alias("of"), "units"), F.col("source").eqNullSafe(F.col("of"))).drop("of"), "targets")
    # One row for each source: sent to all tasks while they are few, joined otherwise.
    few = F.broadcast(targets) if targets.count() <= 10_000 else targets
    expected = F.when(F.col("source_size") > 0, F.col("n") * F.col("target") / F.col("source_size")).otherwise(0.0)
    known = alike.join(few.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of").withColumn("expected", expected)
    known = known.withColumn("whole", F.floor("expected").cast("long")).withColumn("p", F.when(F.col("size") > 0, F.col("expected") - F.floor("expected")).otherwise(0.0))

    kind = alike.schema["doc_id"].dataType.simpleString()
    unit_type = f"struct<doc_id:{kind},size:bigint,n:bigint,p:double>"
    unit = F.struct("doc_id", "size", "n", "p").cast(unit_type).alias("unit")
    about = ["source", "source_size", "target"]
    closed = known.where("p = 0").select(*about, unit)
    # About fan_in units of each source wait for the last fold: of all sizes, they settle what the tree leaves open.
    waits = F.pmod(F.xxhash64(F.lit(seed - 1), "doc_id", "size"), F.ceil(F.col("units") / fan_in)) == 0
    level = known.where(F.col("p") > 0).where(~waits).select(*about, F.col("units").alias("groups"), unit)
    groups, depth = targets.agg(F.max("units")).first()[0] or 0, 0
    while groups > fan_in or not depth:
        dealt = level.withColumn("groups", F.ceil(F.col("groups") / fan_in)).withColumn("group", F.pmod(F.xxhash64(F.lit(seed + depth), "unit.doc_id", "unit.size"), F.col("groups")))
        folded = common.stored(folded_groups(dealt, [*about, "groups", "group"], unit_type, seed + depth), f"level{depth}")
        closed = closed.unionByName(folded.select(*about, F.explode("state.closed").alias("unit")))
        level = folded.where("state.open is not null").select(*about, "groups", F.col("state.open").alias("unit"))
        groups, depth = math.ceil(groups / fan_in), depth + 1
    last = level.select(*about, "unit").unionByName(known.where(F.col("p") > 0).where(waits).select(*about, unit))
    folded = common.stored(folded_groups(last, about, unit_type, seed + depth), "last")
    closed = closed.unionByName(folded.select(*about, F.explode("state.closed").alias("unit")))
    level = folded.where("state.open is not null").select(*about, F.col("state.open").alias("unit"))
    last = level.withColumn("unit", F.struct("unit.doc_id", "unit.size", "unit.n", (uniform(seed, "unit.doc_id", "unit.size") < F.col("unit.p")).cast("double").alias("p")).cast(unit_type))
    decided = closed.unionByName(last.select(*about, "unit")).select(*about, "unit.*")
    whole = F.when(F.col("size") > 0, F.floor(F.col("n") * F.col("target") / F.col("source_size"))).otherwise(0)
    return decided.select("source", "doc_id", "size", "n", "source_size", "target", (whole + F.col("p")).cast("long").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken (size x copies) for every row of docs.

    Texts of any length count whole. Null texts and texts without words have size 0 and are never taken; a null source is one more source, the
    last in order. Repeated rows (same source, id and size) share their copies as evenly as can be. An empty
    table gives an empty result. Reruns on the same rows agree: groups and draws depend on ids, sizes and the
    seed alone. Other columns are ignored. The source totals (one row each) are the only thing that is ordered
    as a whole.
    """
    decided = decide(docs, **options)
    each = decided.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i"))
    copies = F.floor(F.col("copies") / F.col("n")) + (F.col("i") <= F.col("copies") % F.col("n")).cast("long")
    return each.select("doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    decided = decide(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    keys = decided.where("copies > 0").select("source", "doc_id", "size", "n", "copies")
    # The row travels as one column, so no column of docs can clash with those of the decision.
    sized = docs.select(F.struct(*docs.columns).alias("row"), F.col(source_col).alias("of_source"), F.col(id_col).alias("of_id"), common.word_count(F.col(text_col)).alias("of_size"), F.xxhash64(text_col).alias("hash"))
    same = F.col("of_id").eqNullSafe(F.col("doc_id")) & F.col("of_source").eqNullSafe(F.col("source")) & (F.col("of_size") == F.col("size"))
    joined = sized.join(keys, same).select("row", "hash", "source", "doc_id", "size", "n", "copies")
    alone = joined.where("n = 1").select("row", "copies")
    turn = F.row_number().over(Window.partitionBy("source", "doc_id", "size").orderBy("hash"))
    share = F.floor(F.col("copies") / F.col("n")) + (turn <= F.col("copies") % F.col("n")).cast("long")
    several = joined.where("n > 1").select("row", share.alias("copies")).where("copies > 0")
    return alone.unionByName(several).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
