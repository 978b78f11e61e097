"""Toxicity scores from a factorization machine over hashed terms.

Terms are the words of a text and the beginnings of its words, each by its hash, and count once per text. Of the
training rows' terms the ``TERMS`` that tell the classes apart best are kept. The machine has a weight for each term and
a vector for each, whose products weigh pairs of terms: what an insult next to the mention of a group adds, a sum of
weights can't express.

Learned from at most ``SAMPLE`` labelled rows, on the driver; term counts come from grouped executor counts, so what
reaches the driver is bounded by ``SAMPLE`` and ``TERMS``. Rows whose crc32(doc_id as text) mod 5 is 0 are held out.

Null and empty texts get the score of a text without terms. Labels without an id or a value are left out, and of
several for one document the highest holds. Without a label of either class every score is 0. Every row of ``docs`` is
scored for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.llm.common import shuffled_join, staged, texts_of
from geoferry.llm.words import WordHasher, mixed, text_arrays

#: Bytes of words, beginnings that are terms (bytes), labelled rows, terms and width of the vectors.
LETTERS = [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]
BEGINNINGS = (4, 5, 6, 7, 8)
SAMPLE, TERMS, LEAST_TEXTS, WIDTH = 20_000, 4096, 5, 8
EPOCHS, BATCH, RATE, DECAY = 12, 256, 0.15, 1e-4


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5 == 0


def term_sets(column: pa.Array, known: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """For each text its distinct terms: hashes, or places in ``known`` (sorted hashes) of those that are there."""
    hasher = WordHasher(LETTERS)
    maybe = None
    if known is not None:
        maybe = np.zeros(1 << 18, bool)
        maybe[(known & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
    for data, starts in text_arrays(column):
        breaks = np.array(starts, np.int64)
        places, terms = [], []
        for first, last, hashes in hasher.slices(data, breaks):
            places.append(first)
            terms.append(mixed(hashes))
            for size in BEGINNINGS:
                long = first[last - first > size]
                if len(long):
                    places.append(long)
                    terms.append(mixed(hasher.beginnings(data, long, size) + np.uint64(size)))
        place = np.concatenate(places) if places else np.zeros(0, np.int64)
        term = np.concatenate(terms) if terms else np.zeros(0, np.uint64)
        if known is not None:
            some = np.flatnonzero(maybe[(term & np.uint64((1 << 18) - 1)).astype(np.int64)]) if len(known) else np.zeros(0, np.int64)
            at = np.minimum(np.searchsorted(known, term[some]), max(0, len(known) - 1))
            right = known[at] == term[some] if len(known) else np.zeros(0, bool)
            place, term = place[some[right]], at[right]
        order = np.argsort(place, kind="stable")
        place, term = place[order], term[order]
        edges = np.searchsorted(place, breaks)
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield np.unique(term[low:high])


@dataclass
class Machine:
    """Weights and vectors of the kept terms."""

    known: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def raw(self, terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The score before the logistic function; ``starts`` are the bounds of each row's terms."""
        rows = len(starts) - 1
        of = np.repeat(np.arange(rows), np.diff(starts))
        linear = np.bincount(of, self.weights[terms], rows)
        pairs = np.zeros(rows)
        for f in range(self.vectors.shape[1]):
            v = self.vectors[terms, f]
            pairs += np.bincount(of, v, rows) ** 2 - np.bincount(of, v * v, rows)
        return self.bias + linear + pairs / 2

    def scores(self, terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(terms, starts), -30, 30)))


def fitted(known: np.ndarray, rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Logistic loss by AdaGrad, the same each time. ``rows`` hold places in ``known``."""
    random = np.random.default_rng(7)
    n = len(known)
    share = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    machine = Machine(known, float(np.log(share / (1 - share))), np.zeros(n), random.normal(0, 0.01, (n, WIDTH)))
    seen_w, seen_v, seen_b = np.full(n, 1e-6), np.full((n, WIDTH), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            terms = np.concatenate([rows[row] for row in some]).astype(np.int64)
            sizes = np.array([len(rows[row]) for row in some])
            starts = np.concatenate(([0], np.cumsum(sizes)))
            error = (machine.scores(terms, starts) - labels[some]) / len(some)
            of = np.repeat(np.arange(len(some)), sizes)
            used, inverse = np.unique(terms, return_inverse=True)
            step = np.bincount(inverse, error[of], len(used)) + DECAY * machine.weights[used]
            moves = np.empty((len(used), WIDTH))
            for f in range(WIDTH):
                v = machine.vectors[terms, f]
                total = np.bincount(of, v, len(some))
                moves[:, f] = np.bincount(inverse, error[of] * (total[of] - v), len(used)) + DECAY * machine.vectors[used, f]
            seen_w[used] += step**2
            seen_v[used] += moves**2
            seen_b += error.sum() ** 2
            machine.weights[used] -= RATE * step / np.sqrt(seen_w[used])
            machine.vectors[used] -= RATE / 4 * moves / np.sqrt(seen_v[used])
            machine.bias -= RATE * error.sum() / np.sqrt(seen_b)
    return machine


def learn(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """A machine from the labelled rows that are not held out; ``docs`` has doc_id and text."""
    known_labels = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    known_labels = staged(known_labels, "labels")
    n = known_labels.count()
    if not n:
        return None
    # By a hash of the id, so that a sample is the same each time and spread over the table.
    some = known_labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE / n)))
    rows = staged(shuffled_join(docs, some, ["doc_id"]).select("toxic", "text"), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy()
            found = list(term_sets(batch.column(1)))
            if not found:
                continue
            terms, inverse, texts = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            of = np.repeat(toxic, [len(x) for x in found])
            marked = np.bincount(inverse, of, len(terms)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(texts.astype(np.int64)), pa.array(marked)], names=["term", "texts", "marked"])

    total, positive = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not total or not positive or positive == total:
        return None
    counted = rows.mapInArrow(count, "term long, texts long, marked long").groupBy("term").agg(F.sum("texts").alias("texts"), F.sum("marked").alias("marked"))
    expected = F.col("texts") * F.lit(positive / total)
    worth = (F.col("marked") - expected) ** 2 / (expected * (1 - F.lit(positive / total)) * (1 - F.col("texts") / F.lit(total + 1.0)))
    best = counted.where(F.col("texts") >= LEAST_TEXTS).orderBy(worth.desc(), "term").limit(TERMS).select("term").collect()
    known = np.sort(np.array([row.term for row in best], np.int64).view(np.uint64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.astype("<i4").tobytes() for x in term_sets(batch.column(1), known)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["toxic", "terms"])

    learned = sorted((bytes(row.terms), row.toxic) for row in rows.mapInArrow(place, "toxic int, terms binary").collect())
    return fitted(known, [np.frombuffer(terms, "<i4") for terms, _ in learned], np.array([toxic for _, toxic in learned], float))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    texts = texts_of(docs)
    machine = learn(texts, labels)
    if machine is None:
        scored = texts.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(machine)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in batches:
                found = list(term_sets(batch.column(1), model.known))
                starts = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int64)
                terms = np.concatenate(found) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(terms, starts))], names=["doc_id", "score"])

        kind = texts.schema["doc_id"].dataType.simpleString()
        scored = texts.mapInArrow(score, f"doc_id {kind}, score double")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
