"""Published file lists: what a folder's rows are, changed in one step and never by moving files.

A folder holds files as writers append them. Packing writes some of them anew below `_packed` and then publishes a list:
which files stand in for which. A reader takes the newest list, its packed files, and the folder's own files that the list
doesn't cover, so it sees every row once before, during and after, and files that were added meanwhile too. A list takes
effect by the creation of one empty file, which is atomic where a rename is a copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKED, LISTS, POINTERS = "_packed", "_lists", "_published"


def store_of(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def listing(spark: SparkSession, folder: str) -> dict[str, int]:
    """Path and size of the files in a folder, those apart that readers pass over; empty if it isn't there."""
    store, place = store_of(spark, folder)
    if not store.exists(place):
        return {}
    found = ((s.getPath(), s.getLen()) for s in store.listStatus(place) if s.isFile())
    return {p.toString(): n for p, n in found if not p.getName().startswith(("_", "."))}


@dataclass
class Published:
    """packed: files that stand in for the covered ones; tail: the folder's files that no list covers. Sizes by path."""

    packed: dict[str, int] = field(default_factory=dict)
    tail: dict[str, int] = field(default_factory=dict)
    covered: set[str] = field(default_factory=set)
    version: int = 0

    @property
    def files(self) -> list[str]:
        return sorted([*self.packed, *self.tail])


def current(spark: SparkSession, folder: str) -> Published:
    """What makes up the folder now. The folder's own files are listed first, so none that a newer list covers counts twice."""
    there = listing(spark, folder)
    pointers = sorted(p.rsplit("/", 1)[1] for p in listed_names(spark, f"{folder}/{POINTERS}"))
    if not pointers:
        return Published(tail=there)
    rows = spark.read.parquet(f"{folder}/{LISTS}/{pointers[-1]}").collect()  # as many as the folder has files
    covered = {r["path"] for r in rows if not r["packed"]}
    return Published({r["path"]: r["length"] for r in rows if r["packed"]}, {p: n for p, n in there.items() if p not in covered}, covered, int(pointers[-1].split("-")[0]))


def listed_names(spark: SparkSession, folder: str) -> list[str]:
    store, place = store_of(spark, folder)
    return [s.getPath().toString() for s in store.listStatus(place)] if store.exists(place) else []


def publish(spark: SparkSession, folder: str, before: Published, packed: dict[str, int], covered: Iterable[str]) -> None:
    """Let `packed` stand in for `covered` from now on, where `before` was current.

    Of two that publish at once the one with the greater name counts, and the other's files are left unused: both lists
    are whole, whichever readers take.
    """
    name = f"{before.version + 1:012d}-{uuid.uuid4().hex}"
    rows = [(p, n, True) for p, n in packed.items()] + [(p, 0, False) for p in covered]
    spark.createDataFrame(rows, "path string, length long, packed boolean").coalesce(1).write.parquet(f"{folder}/{LISTS}/{name}")
    store, place = store_of(spark, f"{folder}/{POINTERS}/{name}")
    store.create(place, False).close()


def bins(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Files in groups of up to `target` bytes: largest first, each to the first group with room for it."""
    groups: list[list[str]] = []
    room: list[int] = []
    for path in sorted(sizes, key=lambda p: (-sizes[p], p)):
        k = next((i for i, r in enumerate(room) if r >= sizes[path]), len(groups))
        if k == len(groups):
            groups.append([])
            room.append(target)
        groups[k].append(path)
        room[k] -= sizes[path]
    return groups


def checksum(df: DataFrame) -> tuple[int, int]:
    """Number of rows and a sum over their hashes, which no order of rows or files changes."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def pack(spark: SparkSession, folder: str, *, target: int = 128 << 20) -> Published:
    """Write the folder's files of under half the target anew, in files of about `target` bytes, and publish them.

    Rows and their checksum are compared before anything is published. Nothing happens where fewer than two files are
    small. Files stay until `vacuum`.
    """
    before = current(spark, folder)
    small = {p: n for p, n in (before.packed | before.tail).items() if n < target / 2}
    if len(small) < 2:
        return before
    groups = bins(small, target)
    rows = spark.read.option("mergeSchema", True).parquet(*small)
    places = spark.createDataFrame([(p, i) for i, g in enumerate(groups) for p in g], "__path string, __bin int")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    # One narrow row a file goes to all tasks; each group of files makes one file.
    dealt = rows.withColumn("__file", plain(F.url_decode("_metadata.file_path"))).join(F.broadcast(places.withColumn("__path", plain(F.col("__path")))), F.col("__file") == F.col("__path"))
    path = f"{folder}/{PACKED}/{uuid.uuid4().hex}"
    dealt.repartitionByRange(len(groups), "__bin").sortWithinPartitions("__bin").select(rows.columns).write.parquet(path)
    packed = listing(spark, path)
    if checksum(spark.read.schema(rows.schema).parquet(path)) != checksum(rows):
        raise ValueError(f"the files in {path} differ from those they were made of")
    kept = {p: n for p, n in before.packed.items() if p not in small}
    publish(spark, folder, before, kept | packed, before.covered | (set(small) & set(before.tail)))
    return current(spark, folder)


def read_published(spark: SparkSession, folders: str | list[str], **options) -> DataFrame:
    """Rows of one or several folders as published; an error if there are none."""
    paths = [p for f in ([folders] if isinstance(folders, str) else folders) for p in current(spark, f).files]
    return spark.read.options(**options).parquet(*paths)


def vacuum(spark: SparkSession, folder: str) -> int:
    """Delete what the newest list has no use for and return how many files went. Only when no older read is under way."""
    now = current(spark, folder)
    if not now.version:
        return 0
    newest = max(n.rsplit("/", 1)[1] for n in listed_names(spark, f"{folder}/{POINTERS}"))
    gone = [p for p in listing(spark, folder) if p in now.covered]
    gone += [p for d in listed_names(spark, f"{folder}/{PACKED}") for p in listing(spark, d) if p not in now.packed]
    for path in gone:
        store, place = store_of(spark, path)
        store.delete(place, False)
    for kind in (POINTERS, LISTS):
        for name in listed_names(spark, f"{folder}/{kind}"):
            if name.rsplit("/", 1)[1] != newest:
                store, place = store_of(spark, name)
                store.delete(place, True)
    return len(gone)
