"""Importance resampling: documents drawn by how much more their features belong to a target than to the corpus.

1. An untrained Regex Split of the tokenizers library cuts ASCII-lowered texts into words with offsets. Windows
   of offset pairs (1 to `longest` consecutive words, joined by one space) are the features; the CRC-32 of a
   feature names its bucket. Every document is read once and stored as its buckets with their counts.
2. Two histograms of `buckets` rows, of the corpus and of the target, give every bucket a gain: the log ratio of
   their smoothed shares in thousandths, rounded down.
3. The weight of a document is the mean gain of its features, rounded down; its score adds Gumbel noise from a
   hash of its id, so the highest scores are a draw without replacement by the weights.
4. Scores are whole numbers of bounded range. A histogram of them tells how many documents lie above each
   score, so only documents of one score are ever ordered together, by id.

What the driver sees is `buckets` rows, whatever the corpus holds.

Null and empty texts have no features and weight 0; with fewer than `least_words` words a document is scored and
never drawn. Rows with equal ids are documents of their own; a null id is noised like an empty one and comes last
in a tie. An empty target makes a bucket's gain depend on the corpus alone, an empty table gives no rows. Columns
other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.llm import common

#: What parts words: every ASCII character but digits and lower-case letters.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Characters that the splitter sees at a time; longer texts are cut between words.
STRETCH = 20_000
#: Scores of a band, for running sums in two levels.
BAND_BITS = 8


class Splitter:
    """Words of lowered texts with their offsets."""

    def __init__(self) -> None:
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(BETWEEN_WORDS), "removed")

    def words(self, text: str | None) -> list[tuple[str, tuple[int, int]]]:
        """Words and (first, behind last) character of the whole text."""
        lowered = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")
        if len(lowered) <= STRETCH:
            return self.split.pre_tokenize_str(lowered)
        found, start = [], 0
        while start < len(lowered):
            end = min(start + STRETCH, len(lowered))
            while end < len(lowered) and (lowered[end - 1] > "\x7f" or lowered[end - 1].isalnum()):
                end += 1  # no cut inside a word
            pieces = self.split.pre_tokenize_str(lowered[start:end])
            found += [(word, (a + start, b + start)) for word, (a, b) in pieces]
            start = end
        return found


def features(words: list[tuple[str, tuple[int, int]]], longest: int) -> Iterator[bytes]:
    """All runs of 1 to `longest` consecutive words: slices of the words joined by single spaces, by offset pairs."""
    encoded = [word.encode("utf-8", "surrogatepass") for word, _ in words]
    joined, starts, ends, at = b" ".join(encoded), [], [], 0
    for word in encoded:
        starts.append(at)
        ends.append(at + len(word))
        at += len(word) + 1
    for width in range(1, longest + 1):
        for start, end in zip(starts, ends[width - 1 :]):
            yield joined[start:end]


def counted(documents: DataFrame, buckets: int, longest: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_features, and the document's buckets with their counts, little-endian."""
    chosen = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = chosen.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_features", "places", "counts"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter()
        for batch in batches:
            for block in common.text_blocks(batch, 1):
                n_words, n_features, places, counts = [], [], [], []
                for text in block.column(1):
                    words = splitter.words(text.as_py())
                    found = [zlib.crc32(f) % buckets for f in features(words, longest)]
                    place, count = np.unique(np.array(found, np.uint32), return_counts=True)
                    n_words.append(len(words))
                    n_features.append(len(found))
                    places.append(place.astype("<u4").tobytes())
                    counts.append(count.astype("<u4").tobytes())
                arrays = [block.column(0), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64())]
                arrays += [pa.array(places, pa.binary()), pa.array(counts, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return chosen.mapInArrow(
        work, f"doc_id {id_type}, n_words long, n_features long, places binary, counts binary"
    )


def histogram(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features of all rows by bucket; `buckets` numbers reach the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for place, count in zip(batch.column(0), batch.column(1)):
                # A row names a bucket once.
                total[np.frombuffer(place.as_py(), "<u4")] += np.frombuffer(count.as_py(), "<u4")
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    partial = rows.select("places", "counts").mapInArrow(work, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    n, t_all, s_all = len(target), int(target.sum()), int(corpus.sum())
    pairs = zip(target.tolist(), corpus.tolist())
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for t, s in pairs], np.int64
    )


def noise(doc_id: str | None, seed: int) -> int:
    """Gumbel noise of an id in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    sent = rows.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            weights, scores = [], []
            columns = [batch.column(k) for k in (2, 3, 4, 5)]
            for n, place, count, name in zip(*columns):
                chosen = gain[np.frombuffer(place.as_py(), "<u4")]
                total = int((chosen * np.frombuffer(count.as_py(), "<u4").astype(np.int64)).sum())
                weights.append(total // n.as_py() if n.as_py() else 0)
                scores.append(weights[-1] + noise(name.as_py(), seed))
            arrays = [*batch.columns[:3], pa.array(weights, pa.int64()), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    named = rows.withColumn("name", F.col("doc_id").cast("string"))
    return named.mapInArrow(work, f"doc_id {id_type}, n_words long, n_features long, weight long, score long")


def ranked(scores: DataFrame, percent: int, least_words: int) -> DataFrame:
    """All rows with their rank among the drawn, null for the others.

    Candidates above a score are counted from the histogram of scores, in bands of `1 << BAND_BITS`; the
    histogram is bounded by the range of scores, a few ten thousand, and is broadcast.
    """
    enough = F.col("n_words") >= least_words
    by_score = scores.where(enough).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    by_score = by_score.withColumn("band", F.shiftright("score", BAND_BITS))
    downwards = Window.orderBy(F.desc("band"))
    bands = by_score.groupBy("band").agg(F.sum("n").alias("band_n"))
    bands = bands.select(
        "band",
        F.coalesce(F.sum("band_n").over(downwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("above"),
        F.sum("band_n").over(Window.partitionBy(F.lit(1))).alias("candidates"),
    )
    inside = Window.partitionBy("band").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("above") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    drawn = F.floor(F.col("candidates") * F.lit(percent) / F.lit(100)).alias("drawn")
    starts = by_score.join(F.broadcast(bands), "band").select("score", first.alias("first"), drawn)
    met = scores.join(F.broadcast(starts), "score", "left")
    reached = F.coalesce(enough & (F.col("first") < F.col("drawn")), F.lit(False))
    same = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight")
    place = F.col("first") + F.row_number().over(same)
    columns = ["doc_id", "n_features", "weight", "score"]
    chosen = met.where(reached).select(*columns, F.when(place <= F.col("drawn"), place).alias("rank"))
    return chosen.unionByName(met.where(~reached).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(
    documents: DataFrame,
    target: DataFrame,
    buckets: int = 10_000,
    longest: int = 1,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank.

    Of the N documents with at least `least_words` words, floor(`percent` * N / 100) with the highest scores are
    drawn and ranked from 1, ties by the smaller id; `rank` is null for all others. `target` has a column `text`.
    """
    rows = common.store(counted(documents, buckets, longest, doc_id, text))
    wanted = target.select(F.lit(0).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    gain = gains(histogram(counted(wanted, buckets, longest), buckets), histogram(rows, buckets))
    return ranked(common.store(scored(rows, gain, seed)), percent, least_words)
