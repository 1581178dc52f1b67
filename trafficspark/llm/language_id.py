"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams by language in one pass over all labelled rows; only the summed table (buckets
x languages, both known sizes) reaches the driver. Scoring broadcasts the matrix of log-probabilities and sums
its rows over each text's n-grams, a batch of texts at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Characters handled at a time, so that the work arrays stay small however long a text is.
STEP = 1 << 18


def letter_table() -> np.ndarray:
    """For each code point below 2**16: itself if a lower-case letter, else a space."""
    return np.array([i if chr(i).isalpha() else 32 for i in range(1 << 16)], np.uint32)


_letters: list[np.ndarray] = []


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text))


def gram_buckets(text: str, orders: tuple[int, ...], buckets: int) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the lower-cased text, runs of other characters as one space, piece by piece."""
    if not _letters:
        _letters.append(letter_table())
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < 1 << 16, _letters[0][np.minimum(points, (1 << 16) - 1)], points)
    space = points == 32
    points = points[~(space & np.concatenate(([False], space[:-1])))].astype(np.uint64)
    longest = max(orders)
    for at in range(0, max(1, len(points) - 1), STEP):
        piece = points[at : at + STEP + longest - 1]
        for n in orders:
            count = min(STEP, len(piece) - n + 1)
            if count <= 0:
                continue
            h = np.full(count, n, np.uint64)
            for k in range(n):
                h = (h ^ piece[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
            yield ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.intp)


def fit(labelled: DataFrame, *, text_col: str = "text", label_col: str = "lang", orders: tuple[int, ...] = (1, 2, 3), buckets: int = 1 << 15, smoothing: float = 0.5, max_languages: int = 512) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log-probabilities (buckets x languages, float32), from all rows with text and label.

    The model's size is buckets x languages; more than max_languages labels raise an error rather than being cut.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if label not in seen:
                    if len(seen) >= max_languages:
                        raise ValueError(f"more than {max_languages} languages")
                    seen[label] = np.zeros(buckets, np.int64)
                for grams in gram_buckets(text, orders, buckets):
                    seen[label] += np.bincount(grams, minlength=buckets)
        for label, counts in seen.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], ["label", "bucket", "n"])

    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label")).where("text is not null and label is not null")
    table = rows.mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["label"].unique())
    if len(languages) > max_languages:
        raise ValueError(f"{len(languages)} languages; the model is sized for {max_languages}")
    counts = np.zeros((buckets, len(languages)))
    if languages:
        counts[table["bucket"].to_numpy(), np.searchsorted(languages, table["label"].to_numpy())] = table["n"].to_numpy()
    counts += smoothing
    return languages, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def scored(text: str, table: np.ndarray, orders: tuple[int, ...]) -> tuple[int, float]:
    """Number of the likeliest language of a text, and its share among all."""
    total, n = np.zeros(table.shape[1]), 0
    for grams in gram_buckets(text, orders, len(table)):
        # The text's n-grams as a sparse row: how often each bucket occurs, times the matrix.
        total += np.take(table, grams, axis=0).sum(axis=0, dtype=np.float64)
        n += len(grams)
    logs = total / n * min(n, 20)
    share = np.exp(logs - logs.max())
    best = int(np.argmax(total))
    return best, float(share[best] / share.sum())


def language(text: Column, model: tuple[list[str], np.ndarray], spark: SparkSession, orders: tuple[int, ...] = (1, 2, 3)) -> Column:
    """The language of each whole text, as `predict` has it, where all other columns of a row stay out of Python."""
    languages, matrix = model
    shared = spark.sparkContext.broadcast(np.ascontiguousarray(matrix))

    @F.pandas_udf("string")
    def told(texts: pd.Series) -> pd.Series:
        return pd.Series([languages[scored(t, shared.value, orders)[0]] if languages and t and has_letter(t) else UNKNOWN for t in texts], dtype=object)

    return told.asNondeterministic()(text)  # else a filter on it would compute it a second time


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *, id_col: str = "doc_id", text_col: str = "text", orders: tuple[int, ...] = (1, 2, 3), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score for every whole text, then the columns in `keep`.

    score is the prediction's share among the languages, from the mean log-probability of the n-grams (over at
    most 20 grams' weight, so that long texts don't all end at 1). Null texts, texts without a letter and any
    text when no language was learned get 'und' and 0. Ties go to the first language by code point.
    """
    languages, matrix = model
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            preds, scores = [], []
            for text in batch.column(1).to_pylist():
                if not languages or not text or not has_letter(text):
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best, share = scored(text, table, orders)
                preds.append(languages[best])
                scores.append(share)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), *batch.columns[2:]], ["doc_id", "lang_pred", "score", *batch.schema.names[2:]])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)))
    kinds = "".join(f", kept_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double{kinds}")
    return out.select("doc_id", "lang_pred", "score", *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)))
