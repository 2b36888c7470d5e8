"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (one to three characters, words padded with blanks) of a
language in order. A document is ranked the same way, over its whole text, and goes to the language with the
least out-of-place distance: the sum of the rank differences, with the longest distance for n-grams that the
profile lacks.

N-grams are counted over all learnable documents, in tasks and then by a grouped sum; only the profiles reach
the driver, `size` n-grams per language. Null texts and texts without a letter are `und` with score 0, as is
everything when no profile was learned. Ties go to the first language by name. Rows with a null language are
not learned from; repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.common import text_blocks

UNDETERMINED = "und"
#: N-grams of a profile.
SIZE = 300
#: N-grams that a task holds before it passes its counts on.
HELD = 300_000
BLANK = 32
WIDTH = 21  # bits of a code point
#: Bytes of text that are ranked at a time, and signs whose n-grams are sorted at a time.
RANKED_BYTES = 1 << 20
SLICE = 1 << 20


@cache
def letters() -> np.ndarray:
    """For each code point the lower-case letter, or a blank for everything that is no letter."""
    table = np.full(0x110000, BLANK, np.uint32)
    for point in range(0x110000):
        sign = chr(point)
        if sign.isalpha():
            low = sign.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def signs_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text, sign) of every letter, with one blank before, between and behind the words."""
    padded = [f" {t} " if t else " " for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(p) for p in padded])
    signs = letters()[points]
    blank = signs == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1] | (owner[1:] != owner[:-1])
    keep[:1] = True
    return owner[keep], signs[keep]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, count) of a block, sorted by text and n-gram; an n-gram packs its code points.

    Signs are counted SLICE at a time, so that a long text needs memory for its letters only.
    """
    owner, signs = signs_of(texts)
    parts = [counted(owner, signs, at) for at in range(0, len(signs), SLICE)]
    if len(parts) == 1:
        return parts[0]
    owners, codes, counts = (np.concatenate([p[k] for p in parts] or [np.zeros(0, np.int64)]) for k in range(3))
    order = np.lexsort((codes, owners))
    owners, codes, counts = owners[order], codes[order], counts[order]
    begin = runs_begin(owners, codes)
    return owners[begin], codes[begin], np.add.reduceat(counts, begin) if len(begin) else counts


def runs_begin(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins."""
    changed = np.zeros(len(keys[0]), bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(changed)


def counted(owner: np.ndarray, signs: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams that begin within SLICE signs from `at`."""
    owner, signs = owner[at : at + SLICE + 2], signs[at : at + SLICE + 2]
    first = int(owner[0])
    owner = (owner - first).astype(np.int64)
    alphabet, dense = np.unique(signs, return_inverse=True)
    bits = len(alphabet).bit_length()
    dense = dense.astype(np.int64) + 1  # 0: no sign here
    if int(owner[-1]).bit_length() + 3 * bits > 63:  # too many texts and signs for one key
        return counted_by_pairs(owner + first, signs)
    keys = []
    for n in (1, 2, 3):
        last = min(len(dense) - n + 1, SLICE)
        if last <= 0:
            continue
        code = owner[:last].copy()
        for k in range(3):
            code = code << bits | (dense[k : k + last] if k < n else 0)
        whole = owner[:last] == owner[n - 1 : n - 1 + last]
        if n == 1:
            whole &= signs[:last] != BLANK
        keys.append(code[whole])
    sorted_keys = np.sort(np.concatenate(keys))
    begin = runs_begin(sorted_keys)
    counts = np.diff(np.append(begin, len(sorted_keys)))
    runs = sorted_keys[begin]
    names = np.concatenate([[0], alphabet]).astype(np.int64)
    mask = (1 << bits) - 1
    code = names[runs >> 2 * bits & mask] << 2 * WIDTH | names[runs >> bits & mask] << WIDTH | names[runs & mask]
    return (runs >> 3 * bits) + first, code, counts


def counted_by_pairs(owner: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`counted` of a slice, sorted by two keys: texts, and n-grams as they are packed in the end."""
    points = signs.astype(np.int64)
    owners, codes = [], []
    for n in (1, 2, 3):
        last = min(len(points) - n + 1, SLICE)
        if last <= 0:
            continue
        code = np.zeros(last, np.int64)
        for k in range(3):
            code = code << WIDTH | (points[k : k + last] if k < n else 0)
        whole = owner[:last] == owner[n - 1 : n - 1 + last]
        if n == 1:
            whole &= points[:last] != BLANK
        owners.append(owner[:last][whole])
        codes.append(code[whole])
    owners, codes = np.concatenate(owners), np.concatenate(codes)
    order = np.lexsort((codes, owners))
    owners, codes = owners[order], codes[order]
    begin = runs_begin(owners, codes)
    return owners[begin], codes[begin], np.diff(np.append(begin, len(codes)))


def learn(documents: DataFrame, lang: str = "lang", text: str = "text", size: int = SIZE) -> dict[str, list[int]]:
    """The profile of each language: its n-grams by falling count, equal counts by code."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[int, int]] = {}
        for batch in batches:
            for block in text_blocks(batch, 1, RANKED_BYTES):
                tongues = np.array(block.column(0).to_pylist(), object)
                owner, code, counts = grams(block.column(1).to_pylist())
                for tongue in sorted(set(tongues)):
                    mine = (tongues == tongue)[owner]
                    order = np.argsort(code[mine], kind="stable")
                    sorted_code, sorted_count = code[mine][order], counts[mine][order]
                    if len(sorted_code):
                        begin = np.flatnonzero(np.concatenate([[True], sorted_code[1:] != sorted_code[:-1]]))
                        own = held.setdefault(tongue, {})
                        for c, n in zip(sorted_code[begin].tolist(), np.add.reduceat(sorted_count, begin).tolist(), strict=True):
                            own[c] = own.get(c, 0) + n
            if sum(map(len, held.values())) > HELD:
                yield as_batch(held)
                held = {}
        yield as_batch(held)

    def as_batch(held: dict[str, dict[int, int]]) -> pa.RecordBatch:
        rows = [(tongue, c, n) for tongue, own in held.items() for c, n in own.items()]
        kinds = (pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["lang", "gram", "n"]
        )

    known = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counted = known.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(count, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order))
    profiles: dict[str, list[int]] = {}
    for row in top.where(F.col("rank") <= size).orderBy("lang", "rank").collect():
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


class Profiles:
    """Ranks of the n-grams of all languages as one table."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = sorted(profiles), size
        self.codes = np.array(sorted({g for own in profiles.values() for g in own}), np.int64)
        self.ranks = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)
        for k, name in enumerate(self.names):
            self.ranks[k, np.searchsorted(self.codes, profiles[name])] = np.arange(len(profiles[name]))

    def texts(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; the score is 1 less the part of the longest distance."""
        owner, code, counts = grams(texts)
        n = len(texts)
        if not len(self.codes) or not len(code):
            return [UNDETERMINED] * n, np.zeros(n)
        # By text, then falling count, then n-gram: the place of a run breaks ties.
        place = np.arange(len(code), dtype=np.int64)
        most = int(counts.max())
        place_bits, count_bits = len(code).bit_length(), most.bit_length()
        if n.bit_length() + count_bits + place_bits < 64:  # all three fit one key
            key = (owner << count_bits | most - counts) << place_bits | place
            order = np.sort(key) & (1 << place_bits) - 1
        else:
            order = np.lexsort((place, -counts, owner))
        owner, code = owner[order], code[order]
        begin = np.searchsorted(owner, np.arange(n))
        rank = np.arange(len(owner)) - begin[owner]
        top = rank < self.size
        owner, code, rank = owner[top], code[top], rank[top]
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        at[self.codes[at] != code] = len(self.codes)
        distance = np.empty((len(self.names), n))
        for k in range(len(self.names)):
            own = self.ranks[k, at]
            apart = np.where(own < 0, self.size, np.abs(own - rank))
            distance[k] = np.bincount(owner, apart, n)
        seen = np.bincount(owner, minlength=n)
        best = distance.argmin(axis=0)
        score = 1 - distance[best, np.arange(n)] / np.maximum(1, seen * self.size)
        names = [self.names[b] if s else UNDETERMINED for b, s in zip(best.tolist(), (seen > 0).tolist(), strict=True)]
        return names, np.where(seen > 0, np.clip(score, 0, 1), 0.0)


def identify(documents: DataFrame, profiles: dict[str, list[int]], text: str = "text", size: int = SIZE) -> DataFrame:
    """All rows and columns with lang_pred and score."""
    model = Profiles(profiles, size)
    kept = [c for c in documents.columns if c not in ("lang_pred", "score")]
    chosen = documents.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType(
        [*chosen.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    place = kept.index(text)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, place, RANKED_BYTES):
                names, scores = model.texts(block.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*block.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names
                )

    return chosen.mapInArrow(predict, schema)
