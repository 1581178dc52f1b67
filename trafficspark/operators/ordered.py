"""Places and neighbours in one long order, without a task that sees all rows.

Rows are range-partitioned by the order and numbered inside each partition; one count a partition, summed up before
it, turns these numbers into places. Lags and running windows then work block by block of places, where each block has
been handed the last rows before it.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from trafficspark.sources.shared import stored

#: Places in a block: what one sort of a window holds at most, with the rows handed over.
BLOCK = 1 << 16
PART_BITS = 33


@dataclass
class Ordered:
    """rows: a stored table with the column `place` (from 1); n: their number."""

    rows: DataFrame
    n: int


def ordered(df: DataFrame, by: list[str], *, place: str = "place") -> Ordered:
    """df with each row's place by the columns `by`, nulls last; rows alike in all of them go by a hash of the whole row.

    The hash makes places the same at each run, and spreads the rows of one hot value over partitions (but for rows
    alike throughout). One range shuffle. df is computed once, and what comes back reads the written rows. The driver
    sees a count for each partition.
    """
    whole = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
    keys = [*(F.col(c).asc_nulls_last() for c in by), F.col("__tie").asc()]
    told = df.withColumn("__tie", F.xxhash64(*(F.col(f"`{c}`") for c in whole)))
    numbered = told.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie").withColumn("__id", F.monotonically_increasing_id())
    held = stored(numbered, "ordered")
    part = F.shiftright("__id", PART_BITS)
    counts = sorted(held.groupBy(part.alias("part")).count().collect())  # a row a partition
    before = dict(zip([p for p, _ in counts], accumulate([0, *(n for _, n in counts)]), strict=False))
    # Partition numbers are few and dense, so an array finds each one's offset.
    offsets = F.array(*(F.lit(before.get(p, 0)).cast("long") for p in range(max(before, default=-1) + 1)))
    within = F.col("__id").bitwiseAND(F.lit((1 << PART_BITS) - 1)) + 1
    at = (F.get(offsets, part.cast("int")) + within) if before else F.lit(0).cast("long")
    return Ordered(held.withColumn(place, at).drop("__id"), sum(n for _, n in counts))


def in_blocks(found: Ordered, before: int, *, keys: tuple[str, ...] = (), place: str = "place", block: int = BLOCK) -> tuple[DataFrame, WindowSpec, Column]:
    """Rows by block of places, each with the `before` rows ahead of it; the window to look back in; whether a row is the block's own.

    Windows that reach back by no more than `before` rows are exact for the block's own rows; keep only these afterwards.
    """
    block = max(block, before)
    at = F.floor((F.col(place) - 1) / block)
    last = (F.col(place) - 1) % block >= block - before
    home = found.rows.withColumn("__home", at)
    handed = home.withColumn("__block", F.explode(F.when(last, F.array("__home", F.col("__home") + 1)).otherwise(F.array("__home"))))
    return handed, Window.partitionBy("__block", *keys).orderBy(place), F.col("__block") == F.col("__home")
