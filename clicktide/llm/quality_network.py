"""Quality by random-indexing word vectors, pooled per document, and a two-layer network.

1. Random indexing. Every word (a run of letters and digits, or of marks; case counts) is hashed to one of
   `1 << BITS` places. A place has a sparse random index vector of -1, 0 and 1; its context vector is the sum of
   the index vectors of all words within `REACH` words of it, over all texts of the corpus. Tasks add up their
   texts, Spark adds up the tasks by place. Sums are whole numbers, so any order of rows gives the same vectors.
2. Pooling. A document is the mean and the spread of its words' unit vectors and the mean product of neighbours,
   which is large where words repeat.
3. A network of two layers is fitted with numpy on a bounded sample of labelled rows (`rows`, the smallest hashes
   of the ids), four fifths for its weights, one fifth for the temperature that calibrates its probabilities.

The table of vectors has `1 << BITS` rows of `DIMS` numbers (8 MB), whatever the corpus holds. Every text is
counted and scored whole.

Null and empty texts pool to zeros and are scored like any other. Rows without a label are not learned from; an
id with several labels counts with each, a repeated document once. Without any labelled row the score is 0, with
one kind of label only its smoothed share. An empty table gives no rows; other columns stay as they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.common import text_blocks

BITS, DIMS, SIGNS, REACH = 15, 64, 8, 2
SIZE = 1 << BITS
POOLED = 3 * DIMS
#: Labelled rows that a network is fitted on at most.
ROWS = 20_000
#: Words whose vectors are held at a time (a sum of so many contexts of 2 * REACH signs fits 16 bits), words whose
#: place is remembered, characters cut into words at a time.
STEP, REMEMBERED, STRETCH = 1 << 12, 200_000, 1 << 20
WORD = re.compile(r"[^\W_]+|[^\w\s]+|_+")


class Places(dict):
    """Place of a word; the dictionary starts anew at a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = place = zlib.crc32(word.encode("utf-8", "surrogatepass")) & (SIZE - 1)
        return place


def stretches(text: str) -> Iterator[str]:
    """A long text in pieces cut before white space."""
    start = 0
    while len(text) - start > STRETCH:
        end = start + STRETCH
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def words(text: str | None, places: Places) -> np.ndarray:
    """Places of the words of a whole text."""
    found = [np.fromiter(map(places.__getitem__, WORD.findall(s)), np.int32) for s in stretches(text or "")]
    return np.concatenate(found)


@lru_cache(1)
def index_vectors(seed: int = 1) -> np.ndarray:
    """Sparse random signs by place; the last row, the border between texts, is zero."""
    rng = np.random.default_rng(seed)
    out = np.zeros((SIZE + 1, DIMS), np.int16)
    chosen = np.argpartition(rng.random((SIZE, DIMS)), SIGNS, axis=1)[:, :SIGNS]
    np.put_along_axis(out[:-1], chosen, rng.choice(np.array([-1, 1], np.int16), (SIZE, SIGNS)), axis=1)
    return out


def add_contexts(texts: list[np.ndarray], sums: np.ndarray, counts: np.ndarray) -> None:
    """Add the contexts of all words of the texts; neighbours never cross a text's border."""
    index, border = index_vectors(), np.full(REACH, SIZE, np.int32)
    flat = np.concatenate([border, *[part for text in texts for part in (text, border)]])
    for low in range(REACH, len(flat) - REACH, STEP):
        high = min(low + STEP, len(flat) - REACH)
        near = index[flat[low - REACH : high + REACH]]
        context = np.zeros((high - low, DIMS), np.int16)
        for k in range(1, REACH + 1):
            context += near[REACH - k : REACH - k + high - low]
            context += near[REACH + k : REACH + k + high - low]
        own = flat[low:high].astype(np.uint16)  # numbers this short are sorted by radix
        order = np.argsort(own, kind="stable")
        ordered = own[order]
        firsts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        sums[ordered[firsts]] += np.add.reduceat(context[order], firsts, axis=0, dtype=np.int16)
        counts += np.bincount(own, minlength=SIZE + 1)


def context_sums(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row per place that occurs: place, n (words) and d0, d1, … (summed index vectors of neighbours)."""
    names = ["place", "n", *[f"d{k}" for k in range(DIMS)]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, places = np.zeros((SIZE + 1, DIMS), np.int64), np.zeros(SIZE + 1, np.int64), Places()
        for batch in batches:
            for block in text_blocks(batch, 0):
                add_contexts([words(t.as_py(), places) for t in block.column(0)], sums, counts)
        seen = np.flatnonzero(counts[:SIZE])
        table = np.ascontiguousarray(sums[seen].T)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in (seen, counts[seen], *table)], names)

    partial = documents.select(F.col(f"`{text}`").alias("text")).mapInArrow(work, ", ".join(f"{n} long" for n in names))
    return partial.groupBy("place").agg(*[F.sum(n).alias(n) for n in names[1:]])


def unit_vectors(place: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Vectors by place: mean context less that of the corpus, of length 1; zero where no word was seen."""
    out = np.zeros((SIZE, DIMS), np.float64)
    if len(place):
        mean = sums / counts[:, None]
        mean -= sums.sum(axis=0) / counts.sum()
        out[place] = mean / np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9)
    return out.astype(np.float32)


def learn_vectors(documents: DataFrame, text: str = "text") -> np.ndarray:
    """The table of vectors from all texts; `SIZE` rows reach the driver at most."""
    found = context_sums(documents, text).toArrow().sort_by("place")
    columns = [found.column(k).to_numpy() for k in range(found.num_columns)]
    return unit_vectors(columns[0], columns[1], np.stack(columns[2:], axis=1))


def pooled(own: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and mean product of neighbours of a text's word vectors."""
    total, squares, products = (np.zeros(DIMS) for _ in range(3))
    for low in range(0, len(own), STEP):
        near = vectors[own[max(low - 1, 0) : low + STEP]]
        products += np.einsum("ij,ij->j", near[1:], near[:-1])
        near = near[1:] if low else near
        total += near.sum(axis=0)
        squares += np.einsum("ij,ij->j", near, near)
    n = max(len(own), 1)
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean * mean, 0))
    return np.concatenate([mean, spread, products / max(len(own) - 1, 1)]).astype(np.float32)


# --- The network -----------------------------------------------------------------------------------


@dataclass
class Network:
    """Two layers over standardised pooled vectors; `temperature` divides the margin."""

    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        hidden, hidden_bias, out, bias = self.weights
        return np.maximum((x - self.centre) / self.scale @ hidden + hidden_bias, 0) @ out + bias[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x) / self.temperature, -40, 40)))


def constant(vectors: np.ndarray, margin: float) -> Network:
    weights = [np.zeros((POOLED, 1)), np.zeros(1), np.zeros(1), np.array([margin])]
    return Network(vectors, np.zeros(POOLED), np.ones(POOLED), weights)


def calibrate(margin: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least logistic loss, by golden section over its logarithm."""

    def loss(log_t: float) -> float:
        m = margin / np.exp(log_t)
        return float(np.mean(np.logaddexp(0, m) - y * m))

    low, high, part = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(
    x: np.ndarray, labels: np.ndarray, vectors: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 3e-3,
    ridge: float = 1e-4, batch: int = 64, seed: int = 7,
) -> Network:
    """Adam on the logistic loss of four fifths of the rows, the temperature from the others."""
    y = labels.astype(float)
    if not len(y):
        return constant(vectors, -40.0)
    if y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return constant(vectors, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, fitted = np.split(order, [len(y) // 5])
    centre, scale = x[fitted].mean(axis=0), x[fitted].std(axis=0) + 1e-6
    z, target = (x[fitted] - centre) / scale, y[fitted]
    share = min(max(float(target.mean()), 1e-3), 1 - 1e-3)
    weights = [
        rng.normal(0, 1 / np.sqrt(POOLED), (POOLED, hidden)),
        np.zeros(hidden),
        rng.normal(0, 1 / np.sqrt(hidden), hidden),
        np.array([np.log(share / (1 - share))]),
    ]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    steps = 0
    for _ in range(epochs):
        shuffled = rng.permutation(len(z))
        for at in range(0, len(z), batch):
            own = shuffled[at : at + batch]
            layer = np.maximum(z[own] @ weights[0] + weights[1], 0)
            margin = np.clip(layer @ weights[2] + weights[3][0], -40, 40)
            error = (1 / (1 + np.exp(-margin)) - target[own]) / len(own)
            back = np.outer(error, weights[2]) * (layer > 0)
            slopes = [
                z[own].T @ back + ridge * weights[0],
                back.sum(axis=0),
                layer.T @ error + ridge * weights[2],
                np.array([error.sum()]),
            ]
            steps += 1
            for w, slope, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                w -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
    model = Network(vectors, centre, scale, weights)
    if len(held):
        model.temperature = calibrate(model.margin(x[held]), y[held])
    return model


# --- On tables -------------------------------------------------------------------------------------


def pool(documents: DataFrame, vectors: np.ndarray, text: str, into: str) -> DataFrame:
    """All columns but the text, and the pooled vector `into` as little-endian 32-bit floats."""
    place = documents.columns.index(text)
    fields = [f for k, f in enumerate(documents.schema.fields) if k != place]
    schema = T.StructType([*fields, T.StructField(into, T.BinaryType())])
    sent = documents.sparkSession.sparkContext.broadcast(vectors)  # 8 MB

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places()
        for batch in batches:
            for block in text_blocks(batch, place):
                found = [pooled(words(t.as_py(), places), sent.value).astype("<f4").tobytes() for t in block.column(place)]
                kept = [c for k, c in enumerate(block.columns) if k != place]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], schema.names)

    return documents.mapInArrow(work, schema)


def fit(
    documents: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, rows: int = ROWS,
    doc_id: str = "doc_id", text: str = "text", label: str = "quality",
) -> Network:
    """Vectors from all texts of `corpus` (default: `documents`), a network from at most `rows` labelled rows."""
    vectors = learn_vectors(documents if corpus is None else corpus, text)
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    texts = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # The labelled ids are at most `rows`, so they go to where the documents are read.
    met = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    sample = pool(met, vectors, "text", "pooled").distinct()
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "pooled").limit(rows)
    found = sorted(sample.collect(), key=lambda r: (r.doc_id, r.label, bytes(r.pooled)))
    x = np.array([np.frombuffer(r.pooled, "<f4") for r in found]).reshape(-1, POOLED).astype(float)
    return train(x, np.array([r.label for r in found], np.int64), vectors)


def score(documents: DataFrame, model: Network, text: str = "text", into: str = "score") -> DataFrame:
    """All rows and columns with the score `into`, 0 to 1: how likely the label 1 is. A column `into` is an error."""
    if into in documents.columns:
        raise ValueError(f"column {into} exists")
    schema = T.StructType([*documents.schema.fields, T.StructField(into, T.DoubleType())])
    place = documents.columns.index(text)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places()
        for batch in batches:
            for block in text_blocks(batch, place):
                own = sent.value
                x = np.array([pooled(words(t.as_py(), places), own.vectors) for t in block.column(place)])
                scores = own.score(x.reshape(-1, POOLED).astype(float))
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(scores, pa.float64())], schema.names)

    return documents.mapInArrow(work, schema)
