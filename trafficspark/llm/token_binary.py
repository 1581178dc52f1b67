"""Token ids in a bit-plane format: fixed-size blocks of ids, transposed, compressed plane by plane, indexed.

A dataset is a folder of Parquet files whose rows are chunks in the format below, so any store that Spark
writes to can hold it and Spark's committer keeps retried tasks from leaving parts behind. Each shard (one
task's range of document ids) holds its ids in one run, cut into blocks of `block` ids:

    shard int, chunk int     place of the chunk: the chunk index
    base long, n_ids int     ids of the shard before this chunk, ids in it
    planes array<binary>     32 bit planes or 4 byte planes, lowest first, each a zstandard frame; empty: all zeros
    doc_ids, doc_lens        documents that start in this chunk, in order, with their numbers of ids

A document may run on through any number of chunks. Byte plane k holds byte k of every id; bit plane k holds
bit k of every id, eight ids to a byte, the first in the highest bit.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficspark.llm import common, wordpieces

PLANES = {"bit": 32, "byte": 4}
CHUNK = "shard int, chunk int, base long, n_ids int, planes array<binary>, doc_ids array<{id}>, doc_lens array<long>"


def pack(ids: np.ndarray, planes: str, compressor) -> list[bytes]:
    """Compressed planes of one block of unsigned 32-bit ids."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    out = []
    for k in range(4):
        column = np.ascontiguousarray(raw[:, k])
        if not column.any():
            out += [b""] * (8 if planes == "bit" else 1)
        elif planes == "byte":
            out.append(compressor.compress(column.tobytes()))
        else:
            for bit in range(8):
                plane = np.packbits((column >> bit) & 1)
                out.append(compressor.compress(plane.tobytes()) if plane.any() else b"")
    return out


def unpack(frames: list[bytes], n: int, decompressor) -> np.ndarray:
    """The ids of one block from its planes."""
    raw = np.zeros((n, 4), np.uint8)
    if len(frames) == 4:
        for k, frame in enumerate(frames):
            if frame:
                raw[:, k] = np.frombuffer(decompressor.decompress(frame), np.uint8)
    else:
        for k, frame in enumerate(frames):
            if frame:
                raw[:, k // 8] |= np.unpackbits(np.frombuffer(decompressor.decompress(frame), np.uint8), count=n) << (k % 8)
    return raw.reshape(-1).view("<u4")


#: Parts the ids of runs; no id of a vocabulary.
BREAK = b"\xff\xff\xff\xff"


class Encoder:
    """Ids of whole texts as little-endian bytes; each distinct run between white space, and in it each piece, is encoded once."""

    def __init__(self, path: str):
        self.tokenizer = wordpieces.load(path)
        self.model = self.tokenizer.model
        self.pieces, self.runs = wordpieces.Cache(self.encode_pieces), wordpieces.Cache(self.encode_runs)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece by the library's model; a line feed stands for BREAK."""
        return [BREAK if p == "\n" else np.array([t.id for t in self.model.tokenize(wordpieces.symbols(p))], "<u4").tobytes() for p in pieces]

    def encode_runs(self, new: list[str]) -> list[bytes]:
        """Ids of each run: those of its pieces; runs that aren't plain go through the whole tokenizer."""
        pieces, others = wordpieces.pieces_of_runs(new)
        data = b"".join(self.pieces.of(pieces))
        cuts = (np.flatnonzero(np.frombuffer(data, "<u4") == 0xFFFFFFFF) * 4).tolist()
        plain = [data[a:b] for a, b in zip([0, *(c + 4 for c in cuts[:-1])], cuts, strict=True)] if cuts else []
        if not others:
            return plain
        told = {r: np.array(e.ids, "<u4").tobytes() for r, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True)}
        in_order = iter(plain)
        return [told[r] if r in told else next(in_order) for r in new]

    def ids(self, text: str) -> bytes:
        return b"".join(self.runs.of(wordpieces.runs(text)))


_encoders: dict[str, Encoder] = {}


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, planes: str = "byte", block: int = 1 << 16, shards: int | None = None, shard_bytes: int = 1 << 25) -> None:
    """Encode every whole text (null: empty), append end_id and write the dataset in ascending order of id.

    Null ids come first. Rows that share an id, or have none, each keep an entry of their own, in the order of a hash of
    their texts, so that the files are the same however the table lies; rows alike in both are interchangeable, and many
    rows of one id spread over shards. Very long texts run on through as many chunks as they need. One range shuffle by
    id and hash, into a shard for each `shard_bytes` of text unless `shards` says how many. An empty table writes a
    dataset without chunks. Other columns are ignored.
    """
    data = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(common.binary_large(F.col(text_col))).alias("mark"))
    n = shards or 1 + (docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0) // shard_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        encoder = _encoders.get(tokenizer_path) or _encoders.setdefault(tokenizer_path, Encoder(tokenizer_path))
        compressor = zstandard.ZstdCompressor(level=3)
        shard, chunk, base, end = TaskContext.get().partitionId(), 0, 0, np.asarray([end_id], "<u4").tobytes()
        held, size, doc_ids, doc_lens = [], 0, [], []
        schema = None

        def row(block_ids: np.ndarray) -> pa.RecordBatch:
            frames = pack(block_ids, planes, compressor)
            arrays = [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([base], pa.int64()), pa.array([len(block_ids)], pa.int32()), pa.array([frames], pa.list_(pa.binary())), pa.array([doc_ids], pa.list_(schema)), pa.array([doc_lens], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, ["shard", "chunk", "base", "n_ids", "planes", "doc_ids", "doc_lens"])

        for batch in batches:
            schema = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.ids(text or "") + end
                doc_ids.append(doc_id)
                doc_lens.append(len(ids) // 4)
                held.append(ids)
                size += len(ids) // 4
                if size >= block:
                    whole = np.frombuffer(b"".join(held), "<u4")
                    while len(whole) >= block:
                        yield row(whole[:block])
                        chunk, base, doc_ids, doc_lens, whole = chunk + 1, base + block, [], [], whole[block:]
                    held, size = [whole.tobytes()], len(whole)
        if size or doc_ids:
            yield row(np.frombuffer(b"".join(held), "<u4"))

    kind = data.schema["doc_id"].dataType.simpleString()
    ordered = data.repartitionByRange(n, "doc_id", "mark").sortWithinPartitions("doc_id", "mark").select("doc_id", "text")
    ordered.mapInArrow(run, CHUNK.format(id=kind)).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, *, ids: bool = False) -> DataFrame:
    """A written dataset by document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, with `ids` also the ids.

    Chunks of a shard go to one task in order and are decoded one at a time.
    """
    chunks = spark.read.parquet(path)
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").cast("long").alias("total"))
    # One row for each shard that was written, that is for each task of the write.
    starts = totals.withColumn("first", F.sum("total").over(Window.orderBy("shard")) - F.col("total")).drop("total")
    schema = f"shard int, doc_id {kind}, place long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompressor = zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        shard, open_docs, place, crc, parts, left, at = None, [], 0, 0, [], 0, 0
        id_type = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), id_type, pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * ids]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["shard", "doc_id", "place", "n_tokens", "ids_crc32", *["ids"] * ids])

        for batch in batches:
            id_type = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, open_docs, at, place = row["shard"], [], 0, 0
                open_docs.extend(zip(row["doc_ids"], row["doc_lens"], strict=True))
                data = unpack(row["planes"], row["n_ids"], decompressor)
                used = 0
                while at < len(open_docs):
                    doc_id, n = open_docs[at]
                    left = left or n
                    piece = data[used : used + left]
                    crc = zlib.crc32(piece.tobytes(), crc)
                    if ids:
                        parts.append(piece)
                    used, left = used + len(piece), left - len(piece)
                    if left:
                        break
                    rows.append((shard, doc_id, place, n, crc, *([np.concatenate(parts).tolist()] if ids else [])))
                    place, at, crc, parts = place + n, at + 1, 0, []
                open_docs, at = open_docs[at:], 0
            if rows:
                yield batch_of(rows)
                rows = []

    columns = ["shard", "chunk", "n_ids", "planes", "doc_ids", "doc_lens"]
    by_doc = chunks.select(columns).repartition("shard").sortWithinPartitions("shard", "chunk").mapInArrow(run, schema)
    found = by_doc.join(F.broadcast(starts), "shard")
    return found.select("doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)


def token_binary(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write the documents' ids to a new dataset in the shared folder and read them back, by document."""
    path = f"{common.shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer_path, **options)
    return read_tokens(docs.sparkSession, path)
