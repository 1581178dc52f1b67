"""Many files whose schemas drift: footers read in tasks, schemas folded on the cluster, bad files set apart.

The driver sees one row for each column, one for each schema with its paths (which a read needs to be given), and
nothing for each file but those paths.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficspark.sources.shared import stored
from trafficspark.sources.tables import drift_union, supertype

FOOTER = "path string, n_rows long, schema string, reason string"
#: Key under which Spark keeps a table's own schema in a footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def plain(path: Column) -> Column:
    """Local paths without their scheme, which readers write in several ways; all others as they are."""
    return F.regexp_replace(path, "^file:/+", "/")


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """path, length of all files below root; nothing of them is read."""
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(root)
    lengths = found.select(plain(F.col("path")).alias("path"), "length")
    # Files without a byte aren't rows of the source, but are among its files.
    names = spark.createDataFrame([(unquote(n),) for n in found.inputFiles()], "path string").select(plain(F.col("path")).alias("path"))
    return names.join(lengths, "path", "left").select("path", F.coalesce("length", F.lit(0).cast("long")).alias("length"))


def spark_type(kind: pa.DataType) -> T.DataType:
    """The type that Spark reads a Parquet column as."""
    from pyspark.sql.pandas.types import from_arrow_type

    unsigned = {pa.uint8(): T.ShortType(), pa.uint16(): T.IntegerType(), pa.uint32(): T.LongType(), pa.uint64(): T.DecimalType(20, 0)}
    if pa.types.is_dictionary(kind):
        return spark_type(kind.value_type)
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return T.ArrayType(spark_type(kind.value_type))
    if pa.types.is_struct(kind):
        return T.StructType([T.StructField(f.name, spark_type(f.type)) for f in kind])
    if pa.types.is_map(kind):
        return T.MapType(spark_type(kind.key_type), spark_type(kind.item_type))
    return unsigned.get(kind) or from_arrow_type(kind, prefer_timestamp_ntz=True)


def schema_of(file) -> T.StructType:
    """Schema of an open Parquet file: Spark's own if it wrote the file, else from the columns."""
    held = (file.metadata.metadata or {}).get(SPARK_SCHEMA)
    if held:
        return T.StructType.fromJson(json.loads(held))
    return T.StructType([T.StructField(f.name, spark_type(f.type)) for f in file.schema_arrow])


def footers(files: DataFrame, *, direct: tuple[str, ...] = ("file",)) -> DataFrame:
    """path, n_rows, schema (JSON), reason of each file in a table with a column path; of a file that can't be read, only why.

    Tasks open files of the schemes in `direct` themselves and read the footer alone. Other stores may be open to
    Spark only: from these, whole files come through its reader.
    """
    spark = files.sparkSession
    scheme = F.coalesce(F.nullif(F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.lit("")), F.lit("file"))
    told = files.select("path", scheme.alias("scheme"))

    def row(path: str, source) -> tuple:
        import pyarrow.parquet as pq

        try:
            with pq.ParquetFile(source) as file:
                return path, file.metadata.num_rows, schema_of(file).json(), None
        except Exception as e:  # whatever is wrong with the file is what the caller is told
            return path, None, None, f"{type(e).__name__}: {e}".splitlines()[0][:500]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string(), pa.string()))], ["path", "n_rows", "schema", "reason"])

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                store, place = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
                try:
                    rows.append(row(path, store.open_input_file(place)))
                except OSError as e:
                    rows.append((path, None, None, f"{type(e).__name__}: {e}".splitlines()[0][:500]))
            yield table(rows)

    def received(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield table([row(path, pa.BufferReader(content or b"")) for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)])

    near = told.where(F.col("scheme").isin(*direct)).select("path").repartition(spark.sparkContext.defaultParallelism).mapInArrow(opened, FOOTER)
    far = [r["path"] for r in told.where(~F.col("scheme").isin(*direct)).select("path").collect()]  # a reader has to be given its paths
    if not far:
        return near
    return near.unionByName(spark.read.format("binaryFile").load(far).select("path", "content").mapInArrow(received, FOOTER))


def merged_schema(found: DataFrame) -> T.StructType:
    """The schema that holds the rows of all readable files: each column's least common type, in the order of first sight by path.

    Each task folds its own files, then a column's partial types meet; the fold is associative, so the outcome doesn't
    hang on how files are dealt.
    """
    kind = "name string, path string, place int, type string"

    def fold(rows: Iterator[tuple[str, str, int, T.DataType]]) -> pd.DataFrame:
        seen: dict[str, tuple] = {}
        for name, path, place, kind in rows:
            old = seen.get(name)
            seen[name] = (path, place, kind) if old is None else (*min(old[:2], (path, place)), supertype(old[2], kind))
        return pd.DataFrame([(n, p, i, json.dumps(k.jsonValue())) for n, (p, i, k) in seen.items()], columns=["name", "path", "place", "type"])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            first = pdf.groupby("schema")["path"].min()  # files of one schema count once
            yield fold((f.name, path, i, f.dataType) for schema, path in first.items() for i, f in enumerate(T.StructType.fromJson(json.loads(schema)).fields))

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        return fold((r.name, r.path, r.place, type_of(r.type)) for r in pdf.itertuples(index=False))

    columns = found.where("schema is not null").select("path", "schema").mapInPandas(partial, kind).groupBy("name").applyInPandas(final, kind)
    rows = sorted(columns.collect(), key=lambda r: (r["path"], r["place"]))  # a row a column
    return T.StructType([T.StructField(r["name"], type_of(r["type"])) for r in rows])


def type_of(text: str) -> T.DataType:
    return T.StructType.fromJson({"type": "struct", "fields": [{"name": "x", "type": json.loads(text), "nullable": True, "metadata": {}}]})["x"].dataType


def read_found(spark: SparkSession, found: DataFrame, schema: T.StructType | None = None, *, base: str | None = None, origin: str | None = None, skip_bad: bool = False) -> DataFrame:
    """Rows of the files in a stored table of footers, as one table: one read for each distinct schema, then united.

    base: the folder above `name=value` folders, whose columns are then added. origin: a column for each row's file.
    """
    schema = schema or merged_schema(found)
    groups = found.where("schema is not null").groupBy("schema").agg(F.collect_list("path").alias("paths")).orderBy("schema").collect()
    parts, extra = [], [T.StructField(origin, T.StringType())] if origin else []
    for group in groups:
        kinds = T.StructType.fromJson(json.loads(group["schema"]))
        read = T.StructType([f for f in kinds.fields if not isinstance(f.dataType, T.NullType)])  # a column without a type holds nothing
        reader = spark.read.options(ignoreCorruptFiles=skip_bad, **({"basePath": base} if base else {}))
        part = reader.schema(read).parquet(*group["paths"])
        parts.append(part.withColumn(origin, plain(F.col("_metadata.file_path"))) if origin else part)
        extra = [f for f in parts[-1].schema.fields if f.name not in read.names]
    whole = T.StructType([*schema.fields, *(f for f in extra if f.name not in schema.names)])
    return drift_union(*parts, schema=whole) if parts else spark.createDataFrame([], whole)


def read_drifting(spark: SparkSession, paths: list[str] | str, schema: T.StructType | None = None, **options) -> DataFrame:
    """Files whose schemas differ, as one table with all of their columns; paths: a list, or a folder that is searched.

    A file that can't be read is an error that names it; `read_quarantined` goes on without it. No files, or files
    without rows, give no rows.
    """
    files = list_files(spark, paths) if isinstance(paths, str) else spark.createDataFrame([(p,) for p in paths], "path string").select(plain(F.col("path")).alias("path"))
    found = stored(footers(files), "footers")
    bad = found.where("reason is not null").orderBy("path").limit(5).collect()
    if bad:
        raise ValueError("unreadable: " + "; ".join(f"{r['path']} ({r['reason']})" for r in bad))
    return read_found(spark, found, schema, **options)


def read_quarantined(spark: SparkSession, root: str, schema: T.StructType | None = None, *, pattern: str = "*.parquet", verify: bool = True, base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the good files below root, and the bad ones: path, length, n_rows, reason. Each file is in exactly one of the two.

    A file is bad if its footer can't be read or, with `verify`, if reading all of its columns gives other than the
    rows that its footer states. Verifying is one pass over the data.
    """
    files = stored(list_files(spark, root, pattern), "files")
    found = stored(footers(files), "footers")
    if verify:
        rows = read_found(spark, found.where("reason is null"), origin="__file", skip_bad=True)
        checksum = F.bit_xor(F.xxhash64(*(c for c in rows.columns if c != "__file"), F.lit(0)))  # so that every column is read
        counted = rows.groupBy(F.col("__file").alias("path")).agg(F.count(F.lit(1)).alias("rows_read"), checksum.alias("checksum"))
        short = F.coalesce("rows_read", F.lit(0)) != F.col("n_rows")
        why = F.coalesce("reason", F.when(short, F.format_string("%d of %d rows could be read", F.coalesce("rows_read", F.lit(0).cast("long")), "n_rows")))
        found = stored(found.join(counted, "path", "left").select("path", "n_rows", "schema", why.alias("reason"), "checksum"), "verified")
    bad = found.where("reason is not null").join(files, "path", "left").select("path", "length", "n_rows", "reason")
    return read_found(spark, found.where("reason is null"), schema, base=base), bad
