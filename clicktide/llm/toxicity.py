"""Toxicity with a factorization machine over hashed terms.

score = sigmoid(bias + sum of w[t] + sum over pairs of <v[t], v[u]>) over the distinct terms of a text. The
pairwise part learns what an additive model misses, such as an insult together with the mention of a group.

The machine is fitted on a bounded sample of labelled rows (`rows`, the smallest hashes of the ids); its
weights are one table of `1 << BITS` terms at most, whatever the corpus holds. Every text is scored whole.

Null and empty texts are scored by the bias. Rows without a label are not learned from; an id with several
labels counts with each. Without any labelled row the score is 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.common import text_blocks
from clicktide.llm.decontaminate import NORMAL

BITS = 18
#: Labelled rows that a model is fitted on at most.
ROWS = 20_000


def terms(text: str | None) -> np.ndarray:
    """The hashed distinct words of a text, ascending."""
    words = set((text or "").lower().encode("utf-8", "surrogatepass").translate(NORMAL).split())
    mask = (1 << BITS) - 1
    return np.unique(np.fromiter((zlib.crc32(w) & mask for w in words), "<i4", len(words)))


@dataclass
class Machine:
    """Weights by hashed term; terms that were too rare to learn have zeros."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, rows: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(r) for r in rows], np.int64)
        out = np.full(len(rows), self.bias)
        index = np.concatenate([np.zeros(0, np.int32), *rows])
        full = np.flatnonzero(sizes)
        if len(full):
            begin = (np.cumsum(sizes) - sizes)[full]
            vectors = self.factors[index]
            sums = np.add.reduceat(vectors, begin, axis=0)
            squares = np.add.reduceat((vectors**2).sum(axis=1), begin)
            out[full] += np.add.reduceat(self.linear[index], begin) + 0.5 * ((sums**2).sum(axis=1) - squares)
        return out

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -40, 40)))


def informative(rows: list[np.ndarray], y: np.ndarray, signal: float) -> np.ndarray:
    """Which terms occur with the label more or less often than chance has it: chi-squared above `signal`.

    A few thousand labelled rows hold far more rare terms than labels; those would be learned by heart.
    """
    size, n, positive = 1 << BITS, len(y), y.sum()
    sizes = np.array([len(r) for r in rows], np.int64)
    index = np.concatenate([np.zeros(0, np.int32), *rows])
    seen = np.bincount(index, minlength=size).astype(float)
    together = np.bincount(index, np.repeat(y, sizes), size)
    expected = seen * positive / n
    spread = expected * (1 - seen / n) * (1 - positive / n)
    return (seen >= 3) & ((together - expected) ** 2 > signal * np.maximum(spread, 1e-9))


def interacting(rows: list[np.ndarray], y: np.ndarray, useful: np.ndarray, signal: float) -> np.ndarray:
    """`useful`, and every term that says something of the label among the rows with a useful term.

    A term that is nearly independent of the label by itself keeps its factors if it matters beside another.
    """
    out = useful.copy()
    holders: dict[int, list[int]] = {}
    for number, row in enumerate(rows):
        for term in row[useful[row]].tolist():
            holders.setdefault(term, []).append(number)
    for numbers in holders.values():
        with_term = np.zeros(len(rows), bool)
        with_term[numbers] = True
        labels = y[with_term]
        if 0 < labels.sum() < len(labels):
            out |= informative([rows[k] for k in numbers], labels, signal)
    return out


def train(
    rows: list[np.ndarray], labels: list[int], rank: int = 4, epochs: int = 20, rate: float = 0.2, ridge: float = 1e-3,
    signal: float = 20.0, batch: int = 64, seed: int = 7,
) -> Machine:
    """Adaptive gradient steps on the logistic loss; terms without `signal`, alone or beside such a term, stay at zero."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, float)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.0
    size = 1 << BITS
    if not len(y):
        return Machine(-40.0, np.zeros(size), np.zeros((size, rank)))
    useful = interacting(rows, y, informative(rows, y, signal), signal)
    rows = [r[useful[r]] for r in rows]
    model = Machine(float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, rank)))
    model.factors[useful] = rng.normal(0, 0.01, (int(useful.sum()), rank))
    linear_sum, factor_sum, bias_sum = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            own = [rows[k] for k in chosen.tolist()]
            error = model.score(own) - y[chosen]
            sizes = np.array([len(r) for r in own], np.int64)
            bias_sum += float(error.sum()) ** 2
            model.bias -= rate * float(error.sum()) / np.sqrt(bias_sum)
            index = np.concatenate(own)
            if not len(index):
                continue
            row = np.repeat(np.arange(len(own)), sizes)
            sums = np.zeros((len(own), rank))
            np.add.at(sums, row, model.factors[index])
            active, inverse = np.unique(index, return_inverse=True)
            linear = np.bincount(inverse, error[row]) + ridge * model.linear[active]
            part = error[row, None] * (sums[row] - model.factors[index])
            pairwise = np.stack([np.bincount(inverse, part[:, f]) for f in range(rank)], axis=1) + ridge * model.factors[active]
            linear_sum[active] += linear**2
            factor_sum[active] += pairwise**2
            model.linear[active] -= rate * linear / np.sqrt(linear_sum[active])
            model.factors[active] -= 0.2 * rate * pairwise / np.sqrt(factor_sum[active])
    return model


def fit(
    documents: DataFrame, labels: DataFrame, rows: int = ROWS, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Machine:
    """A machine fitted on at most `rows` labelled rows, those with the smallest hash of their id."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, 1):
                found = [terms(t).tobytes() for t in block.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*block.columns[::2], pa.array(found, pa.binary())], ["doc_id", "label", "terms"]
                )

    # The labelled ids are at most `rows`, so they go to where the documents are read.
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    met = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    schema = T.StructType([met.schema["doc_id"], met.schema["label"], T.StructField("terms", T.BinaryType())])
    # A repeated document would count, and be collected, as often as it occurs: one of each.
    sample = met.mapInArrow(hashed, schema).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label", "terms").limit(rows)
    found = sorted(sample.collect(), key=lambda r: (r.doc_id, r.label, bytes(r.terms)))
    return train([np.frombuffer(r.terms, "<i4") for r in found], [r.label for r in found])


def score(documents: DataFrame, model: Machine, text: str = "text", into: str = "score") -> DataFrame:
    """All rows and columns with the score `into`, 0 to 1."""
    kept = [c for c in documents.columns if c != into]
    chosen = documents.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*chosen.schema.fields, T.StructField(into, T.DoubleType())])
    place = kept.index(text)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, place):
                scores = sent.value.score([terms(t) for t in block.column(place).to_pylist()])
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(scores, pa.float64())], schema.names)

    return chosen.mapInArrow(predict, schema)
