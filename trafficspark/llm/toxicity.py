"""Toxicity: a convolutional text classifier with a threshold for each language.

The classifier (`text_cnn`) starts from a bounded sample of labelled documents, learned in one task. Then shards of
documents, dealt by a hash of their ids, learn every labelled document outside a fold, and their weights are averaged. All
documents of the fold, which the classifier has not learned from, set a threshold for each language, on the language
that `language_id` reads from the text. Scores are shifted by it, so that one cut (`at`) holds for all languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficspark.llm import common, language_id, text_cnn

#: One in FOLD labelled documents sets the thresholds, all others teach the weights.
FOLD = 5
#: Labelled documents that a shard learns (about), and those that it holds at a time, with their characters.
SHARD_DOCS = 16_000
CHUNK_DOCS, CHUNK_CHARS = 2000, 16_000_000
#: Labels up to which they are sent to all tasks.
FEW = 500_000
#: Thresholds are told apart to 1 / BINS of a logit, from counts of all documents in each such step.
BINS, MOST = 64, 64
#: n-grams by which languages are told apart here; pairs are enough for a threshold and a third of the work.
ORDERS = (2,)


@dataclass
class Model:
    shape: text_cnn.Shape
    parameters: list[np.ndarray]
    #: threshold of the logit by language; "" for all others
    thresholds: dict[str, float]
    languages: tuple[list[str], np.ndarray]
    #: the parameters as sent to tasks, once they are
    sent: Broadcast | None = None


def best_threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The cut of greatest F1 over weighed documents, midway between two logits; the highest of equals."""
    order = np.argsort(-logits, kind="stable")
    found, toxic = logits[order], labels[order] == 1
    hit, taken = np.cumsum(np.where(toxic, weights[order], 0)), np.cumsum(weights[order])
    f1 = 2 * hit / (taken + hit[-1])
    f1[:-1][found[:-1] == found[1:]] = -1  # equal logits can't be parted
    best = int(np.argmax(f1))
    below = found[best + 1] if best + 1 < len(found) else found[best] - 1
    return float((found[best] + below) / 2)


def calibrate(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray, languages: list[str], least: int) -> dict[str, float]:
    """Thresholds by language; one with fewer than `least` documents (by weight) of either label has that of all languages."""
    both = lambda own: min(weights[own & (labels == 1)].sum(), weights[own & (labels == 0)].sum())
    known = np.array(languages, dtype=object)
    found = {"": best_threshold(logits, labels, weights) if both(np.full(len(labels), True)) else 0.0}
    for language in sorted(set(languages)):
        own = known == language
        if both(own) >= least:
            found[language] = best_threshold(logits[own], labels[own], weights[own])
    return found


def marked(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """id, label, mark (a hash) of each id that is labelled 0 or 1; one with several labels counts as toxic if one says so."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    return known.withColumn("mark", F.xxhash64("id", F.lit(1)))


def sample(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, lang_col: str, label_col: str, per_class: int) -> DataFrame:
    """id, text, lang, label, fold, weight: documents of `per_class` ids of each label at most, those of least hash.

    An id with several rows has its least text. weight is how many labelled ids each sampled id stands for.
    """
    known = common.stored(marked(labels, id_col, label_col), "labels")
    totals = dict(known.groupBy("label").count().collect())  # two rows
    picked = [known.where(F.col("label") == c).orderBy("mark", "id").limit(per_class) for c in (0, 1)]
    weight = F.when(F.col("label") == 1, max(1.0, totals.get(1, 0) / per_class)).otherwise(max(1.0, totals.get(0, 0) / per_class))
    few = picked[0].unionByName(picked[1])
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    # At most 2 * per_class narrow rows go to all tasks.
    met = texts.join(F.broadcast(few), "id").groupBy("id", "label", "mark").agg(F.min("text").alias("text"), F.min("lang").alias("lang"))
    return common.stored(met.select("id", "text", "lang", "label", (F.pmod("mark", F.lit(FOLD)) == 0).alias("fold"), weight.alias("weight"), "mark"), "sample")


def flat(model: text_cnn.TextCnn) -> np.ndarray:
    """All parameters in rows of the embedding's size, its own rows first."""
    size = model.shape.size
    rest = np.concatenate([p.reshape(-1) for p in model.parameters()[1:]])
    return np.concatenate((model.embedding, np.append(rest, np.zeros(-len(rest) % size, np.float32)).reshape(-1, size)))


def unflat(shape: text_cnn.Shape, rows: np.ndarray) -> list[np.ndarray]:
    """Parameters from the rows of `flat`, as copies."""
    out, rest, at = [rows[: shape.buckets].copy()], rows[shape.buckets :].reshape(-1), 0
    for p in text_cnn.TextCnn(text_cnn.Shape(1, shape.size, shape.widths, shape.filters, shape.orders)).parameters()[1:]:
        out.append(rest[at : at + p.size].reshape(p.shape).copy())
        at += p.size
    return out


def fit_shards(docs: DataFrame, labels: DataFrame, shape: text_cnn.Shape, begun: np.ndarray, *, id_col: str, text_col: str, label_col: str, rate: float, batch: int = 32, drop: float = 0.5, seed: int = 7) -> tuple[np.ndarray, DataFrame]:
    """Rows of `flat` after all labelled documents outside the fold were learned from the rows `begun`; id, text, label of the fold.

    Documents are dealt to shards by a hash of their ids, each learns its own from `begun`, and each row is averaged
    over the shards that moved it, by their numbers of documents. Every row of a labelled id teaches.
    """
    known = common.stored(marked(labels, id_col, label_col), "labels")
    totals = dict(known.groupBy("label").count().collect())  # two rows
    weigh_by = np.array([0.5 * sum(totals.values()) / max(1, totals.get(c, 0)) for c in (0, 1)])
    shared = docs.sparkSession.sparkContext.broadcast(begun)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = text_cnn.TextCnn.of(shape, unflat(shape, shared.value))
        adagrad, rng, learned = text_cnn.Adagrad(model.parameters(), rate), np.random.default_rng(seed), 0
        names = ["row", "n", "values", "id", "text", "label"]
        held: list[tuple[int, str, int]] = []
        chars = 0

        def chunk() -> None:
            held.sort()
            y = np.array([h[2] for h in held])
            text_cnn.go_through(model, adagrad, [h[1] for h in held], y, weigh_by[y], rng, batch=batch, drop=drop)

        for rows in batches:
            fold = pa.array(rows.column(0).to_numpy() % FOLD == 0)
            apart = rows.filter(fold)
            k = len(apart)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.float32())), *apart.columns[1:]], names)
            kind = rows.schema.field(1).type
            for one in zip(*(rows.filter(pa.compute.invert(fold)).column(c).to_pylist() for c in (0, 2, 3)), strict=True):
                held.append(one)
                learned, chars = learned + 1, chars + len(one[1])
                if len(held) >= CHUNK_DOCS or chars >= CHUNK_CHARS:
                    chunk()
                    held, chars = [], 0
        if held:
            chunk()
        if learned:
            found = flat(model)
            moved = np.flatnonzero((found != shared.value).any(axis=1) | (np.arange(len(found)) >= shape.buckets))
            for at in range(0, len(moved), 10_000):
                own = moved[at : at + 10_000]
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * shape.size, pa.int32()), pa.array(found[own].reshape(-1)))
                k = len(own)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([learned] * k, pa.int64()), values, pa.nulls(k, kind), pa.nulls(k, pa.string()), pa.nulls(k, pa.int32())], names)

    shards = max(1, round(sum(totals.values()) / SHARD_DOCS))
    texts = docs.select(F.xxhash64(F.col(id_col), F.lit(1)).alias("mark"), F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).where("id is not null")
    # Few labels go to all tasks, so that only labelled texts are shuffled.
    met = texts.join(F.broadcast(known) if sum(totals.values()) <= FEW else known, ["mark", "id"]).repartition(shards, "mark", "id")
    met = met.select("mark", "id", "text", "label").sortWithinPartitions("mark", "id")
    told = common.stored(met.mapInArrow(go_on, f"row long, n long, values array<float>, id {met.schema['id'].dataType.simpleString()}, text string, label int"), "shards")
    sums = [(F.sum(F.col("values")[i].cast("double") * F.col("n")) / F.sum("n")).cast("float").alias(f"v{i}") for i in range(shape.size)]
    means = told.where("row is not null").groupBy("row").agg(*sums).toArrow()
    shared.destroy()  # nothing lazy reads it: the driver holds few copies of the weights at a time
    out, at = begun.copy(), means["row"].to_numpy()
    for i in range(shape.size):
        out[at, i] = means[f"v{i}"].to_numpy()
    return out, told.where("row is null").select("id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", per_class: int = 5000, least: int = 8, shape: text_cnn.Shape | None = None, rate: float = 0.1, **training) -> Model | None:
    """A model from all documents that `labels` marks 0 or 1; None if none are marked.

    per_class bounds only the sample that the weights start from: that many labelled ids of each label, in one task. After
    that all labelled documents teach: the weights, or the thresholds if they are in the fold. Languages are learned from
    all of `docs`. Null labels and ids teach nothing, nor do labels without a document.
    """
    shape = shape or text_cnn.Shape()
    taught = sample(docs, labels, id_col=id_col, text_col=text_col, lang_col=lang_col, label_col=label_col, per_class=per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not len(table):
            return
        texts, y, fold = table["text"].to_pylist(), table["label"].to_numpy(), table["fold"].to_numpy()
        if fold.all():
            fold = np.full(len(y), False)
        model = text_cnn.train([t for t, f in zip(texts, fold, strict=True) if not f], y[~fold], shape, rate=rate, **training)
        yield pa.RecordBatch.from_arrays([pa.array([flat(model).astype(np.float16).tobytes()], pa.binary())], ["model"])

    row = taught.repartition(1).sortWithinPartitions("mark", "id").mapInArrow(run, "model binary").first()
    if row is None:
        return None
    languages = language_id.fit(docs, text_col=text_col, label_col=lang_col, orders=ORDERS)
    # In half precision: it is but a start, and the driver holds less.
    begun = np.frombuffer(row["model"], np.float16).reshape(-1, shape.size).astype(np.float32)
    del row
    options = {k: v for k, v in training.items() if k in ("batch", "drop", "seed")}
    rows, fold = fit_shards(docs, labels, shape, begun, id_col=id_col, text_col=text_col, label_col=label_col, rate=rate / 2, **options)
    model = Model(shape, unflat(shape, rows), {"": 0.0}, languages)
    steps = F.round(F.least(F.greatest(F.col("logit"), F.lit(-MOST)), F.lit(MOST)) * BINS).cast("long")
    counted = logits(fold, model, id_col="id", keep=("label",)).groupBy("lang_pred", steps.alias("step"), "label").count().toPandas()
    counted = counted.sort_values(["lang_pred", "step", "label"])
    cuts = calibrate(counted["step"].to_numpy() / BINS, counted["label"].to_numpy(), counted["count"].to_numpy(), counted["lang_pred"].tolist(), least)
    return Model(shape, model.parameters, cuts, languages, model.sent)


def logits(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, logit (above the language's threshold) of every whole text, then the columns in `keep`. No shuffle."""
    told = language_id.predict(docs, model.languages, id_col=id_col, text_col=text_col, orders=ORDERS, keep=(text_col, *keep))
    model.sent = shared = model.sent or docs.sparkSession.sparkContext.broadcast(model.parameters)
    shape, thresholds = model.shape, model.thresholds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = text_cnn.TextCnn.of(shape, shared.value)
        vectors = text_cnn.WordVectors(net)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            cuts = np.array([thresholds.get(x, thresholds[""]) for x in batch.column(1).to_pylist()])
            found = net.logits(text_cnn.pooled(net, vectors, texts)) - cuts
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64()), *batch.columns[3:]], ["doc_id", "lang_pred", "logit", *batch.schema.names[3:]])

    kinds = "".join(f", kept_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    picked = told.select("doc_id", "lang_pred", F.col(text_col), *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)))
    out = picked.mapInArrow(run, f"doc_id {told.schema['doc_id'].dataType.simpleString()}, lang_pred string, logit double{kinds}")
    return out.select("doc_id", "lang_pred", "logit", *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)))


def score(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", at: float = 0.3, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), predicted (1 from `at` on, else 0) of every whole text, then the columns in `keep`.

    Texts that are null, empty or without words have the score of an empty text. Very long texts are read in pieces, so
    memory goes with a piece. Repeated rows are scored each, null ids stay null, an empty table gives an empty result,
    and columns not in `keep` are ignored. Without a model (nothing was labelled) every score is 0. No shuffle.
    """
    if model:
        shifted = F.least(F.greatest(F.col("logit") + float(np.log(at / (1 - at))), F.lit(-500.0)), F.lit(500.0))
        told, found = logits(docs, model, id_col=id_col, text_col=text_col, keep=tuple(keep)), 1 / (1 + F.exp(-shifted))
    else:
        languages = ([], np.zeros((1, 0), np.float32))
        told, found = language_id.predict(docs, languages, id_col=id_col, text_col=text_col, orders=ORDERS, keep=tuple(keep)), F.lit(0.0)
    out = told.select("doc_id", "lang_pred", found.alias("found"), *(told[c].alias(f"kept_{i}") for i, c in enumerate(keep)))
    return out.select("doc_id", "lang_pred", F.col("found").alias("score"), (F.col("found") >= at).cast("int").alias("predicted"), *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)))
