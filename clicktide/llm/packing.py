"""Packing documents into training sequences by cutting-stock column generation.

1. Every document is encoded once and stored with its rank among the documents of its task that leave
   the same remainder (ids modulo the sequence length). Whole stretches of `capacity` ids are sequences
   of their own.
2. The histogram of remainders (at most `capacity` - 1 rows) is the demand of a cutting-stock problem.
   The driver solves its linear program by column generation: patterns of a basis, duals as prices,
   a knapsack by dynamic programming that finds the next pattern.
3. Rounded-down multiplicities of the full patterns are given out by rank: the rank of a document among
   all with its remainder says which copy of which pattern it fills, by arithmetic alone. Documents that
   no full pattern takes follow each other by remainder and rank, cut at sequence ends.

No sequence needs padding: a last, shorter stretch is cut into powers of two. Only the histogram goes
through the driver, and its size is bound by `capacity`, whatever the corpus holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.llm import common, tokens

#: The table of first ranks per task is broadcast up to this size, else joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: Bytes of stored ids that are cut into pieces at a time.
CUT_BYTES = 2 << 20


# --- The cutting-stock problem, on a histogram of bounded size -----------------------------------


def best_pattern(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the copies of each length (index) that fit `capacity` at the highest price."""
    lengths = np.flatnonzero(prices > 1e-12)
    copies = np.zeros(len(prices), np.int64)
    if not len(lengths):
        return 0.0, copies
    value, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    worth = prices[lengths]
    for room in range(1, capacity + 1):
        fits = np.searchsorted(lengths, room, "right")
        value[room] = value[room - 1]
        if fits:
            gain = worth[:fits] + value[room - lengths[:fits]]
            best = int(np.argmax(gain))
            if gain[best] > value[room] + 1e-12:
                value[room], taken[room] = gain[best], lengths[best]
    room = capacity
    while room > 0:
        if taken[room]:
            copies[taken[room]] += 1
            room -= taken[room]
        else:
            room -= 1
    return float(value[capacity]), copies


def first_patterns(demand: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """A triangular start: each pattern fills up behind the longest length left and exhausts one length.

    Returns (exhausted length, copies). Subset sums over the lengths left choose the fullest filling.
    """
    left = demand.astype(float).copy()
    made = []
    while (open_lengths := np.flatnonzero(left > 1e-9)).size:
        copies = np.zeros(len(demand), np.int64)
        room = capacity
        for length in open_lengths[::-1].tolist():  # longest first, as many as the supply bears
            fit = min(room // length, max(1, int(left[length])))
            copies[length] = fit
            room -= fit * length
            if not room:
                break
        held = np.flatnonzero(copies)
        use = left[held] / copies[held]
        out = int(np.argmin(use))
        left[held] -= copies[held] * use[out]
        left[held[out]] = 0.0
        made.append((int(held[out]), copies))
    # Lengths that ended together with another: a pattern of their own, unused so far.
    for length in sorted(set(np.flatnonzero(demand).tolist()) - {ended for ended, _ in made}):
        copies = np.zeros(len(demand), np.int64)
        copies[length] = capacity // length
        made.append((length, copies))
    return made


def column_generation(
    demand: np.ndarray, capacity: int, gap: float = 1e-3, most_pivots: int = 400
) -> list[tuple[np.ndarray, float]]:
    """Patterns and fractional multiplicities that cut just `demand` (index: length) from few stocks.

    A revised simplex: the pivots end when Farley's bound shows less than `gap` above the optimum, when
    no pattern prices in, or after `most_pivots`; any basis met on the way is a valid plan.
    """
    rows = np.flatnonzero(demand > 0)
    if not len(rows):
        return []
    start = first_patterns(demand, capacity)
    patterns = [p for _, p in start]
    basis = np.zeros((len(rows), len(rows)))
    for column, pattern in enumerate(patterns):
        basis[:, column] = pattern[rows]
    inverse = np.linalg.inv(basis)
    amount = np.clip(inverse @ demand[rows], 0, None)
    for pivot in range(most_pivots):
        duals = inverse.sum(axis=0)  # every pattern costs one sequence
        prices = np.zeros(len(demand))
        prices[rows] = np.clip(duals, 0, None)
        worth, pattern = best_pattern(prices, capacity)
        if worth <= 1 + 1e-9 or amount.sum() * (1 - 1 / worth) <= gap * amount.sum():
            break
        entering = inverse @ pattern[rows]
        usable = entering > 1e-9
        if not usable.any():
            break
        ratio = np.full(len(rows), np.inf)
        ratio[usable] = amount[usable] / entering[usable]
        out = int(np.argmin(ratio))
        amount -= ratio[out] * entering
        amount[out] = ratio[out]
        np.clip(amount, 0, None, out=amount)
        patterns[out] = pattern
        scaled = inverse[out] / entering[out]
        inverse -= np.outer(entering, scaled)
        inverse[out] = scaled
        if pivot % 100 == 99:  # drop the rounding errors of the updates
            for column, own in enumerate(patterns):
                basis[:, column] = own[rows]
            inverse = np.linalg.inv(basis)
            amount = np.clip(inverse @ demand[rows], 0, None)
    return list(zip(patterns, amount.tolist(), strict=True))


@dataclass
class Layout:
    """Where the document with a given remainder and rank goes; arrays by remainder."""

    capacity: int
    first_sequence: list[list[int]] = field(default_factory=list)  # of each interval of ranks
    until: list[np.ndarray] = field(default_factory=list)  # rank at which the interval ends
    copies: list[list[int]] = field(default_factory=list)
    offset: list[list[int]] = field(default_factory=list)
    run_start: list[int] = field(default_factory=list)  # position in the run of the first rank beyond
    run_sequence: int = 0
    run_full: int = 0  # whole sequences of the run
    run_cuts: list[int] = field(default_factory=list)  # ends behind the whole ones, powers of two

    def place(self, remainder: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, length) of the pieces of one remainder."""
        until = self.until[remainder]
        if len(until) and rank < until[-1]:
            k = int(np.searchsorted(until, rank, "right"))
            own = rank - (int(until[k - 1]) if k else 0)
            copy, slot = divmod(own, self.copies[remainder][k])
            return [(self.first_sequence[remainder][k] + copy, self.offset[remainder][k] + slot * remainder, remainder)]
        beyond = rank - (int(until[-1]) if len(until) else 0)
        at = self.run_start[remainder] + beyond * remainder
        pieces, left, whole = [], remainder, self.run_full * self.capacity
        while left:
            if at < whole:
                sequence, offset = divmod(at, self.capacity)
                end = (sequence + 1) * self.capacity
            else:
                k = int(np.searchsorted(self.run_cuts, at, "right"))
                begin = self.run_cuts[k - 1] if k else whole
                sequence, offset, end = self.run_full + k, at - begin, self.run_cuts[k]
            length = min(left, end - at)
            pieces.append((self.run_sequence + sequence, offset, length))
            at, left = at + length, left - length
        return pieces


def lay_out(demand: np.ndarray, capacity: int, first_sequence: int, gap: float = 1e-3) -> Layout:
    """Round the linear program down; only patterns that fill a sequence to the end are given out."""
    out = Layout(capacity, *([[] for _ in range(capacity)] for _ in range(4)))
    until: list[list[int]] = [[] for _ in range(capacity)]
    sequence = first_sequence
    for pattern, amount in column_generation(demand, capacity, gap):
        times = int(amount + 1e-6)
        lengths = np.flatnonzero(pattern)
        if int((lengths * pattern[lengths]).sum()) != capacity:
            continue
        given = [until[int(x)][-1] if until[int(x)] else 0 for x in lengths]
        times = min([times, *((int(demand[x]) - g) // int(pattern[x]) for x, g in zip(lengths, given, strict=True))])
        if times <= 0:
            continue
        offset = 0
        for length in lengths.tolist():
            copies = int(pattern[length])
            before = until[length][-1] if until[length] else 0
            until[length].append(before + times * copies)
            out.first_sequence[length].append(sequence)
            out.copies[length].append(copies)
            out.offset[length].append(offset)
            offset += copies * length
        sequence += times
    out.until = [np.array(u, np.int64) for u in until]
    at = 0
    for length in range(capacity):
        out.run_start.append(at)
        at += (int(demand[length]) - (until[length][-1] if until[length] else 0)) * length
    out.run_sequence = sequence
    out.run_full, rest = divmod(at, capacity)
    end = out.run_full * capacity
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            end += 1 << bit
            out.run_cuts.append(end)
    return out


# --- The Spark job --------------------------------------------------------------------------------


def encode_ranked(documents: DataFrame, tokenizer: str, capacity: int, end_id: int, doc_id: str, text: str) -> DataFrame:
    """Encoded documents: doc_id, ids, their number, and ranks within the task that encodes them."""
    id_type = documents.schema[doc_id].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen, chunks = np.zeros(capacity, np.int64), 0
        for block, ids, sizes in tokens.encoded(batches, tokenizer, 1):
            ends = np.cumsum(sizes)
            ids = np.insert(ids, ends, ids.dtype.type(end_id))
            sizes = sizes + 1
            tail, whole = sizes % capacity, sizes // capacity
            order = np.argsort(tail, kind="stable")
            found, start, count = np.unique(tail[order], return_index=True, return_counts=True)
            rank = np.empty(len(tail), np.int64)
            rank[order] = np.arange(len(tail)) - np.repeat(start, count) + np.repeat(seen[found], count)
            seen[found] += count
            first_chunk = chunks + np.cumsum(whole) - whole
            chunks += int(whole.sum())
            bounds = np.concatenate([[0], np.cumsum(sizes)]) * ids.dtype.itemsize
            held = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0),
                    pa.array(np.full(len(sizes), part, np.int32)),
                    pa.array(sizes),
                    pa.array(tail.astype(np.int32)),
                    pa.array(rank),
                    pa.array(first_chunk),
                    held.cast(pa.binary()),
                ],
                ["doc_id", "part", "doc_tokens", "tail", "tail_rank", "chunk_rank", "ids"],
            )

    return documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        encode,
        f"doc_id {id_type}, part int, doc_tokens long, tail int, tail_rank long, chunk_rank long, ids binary",
    )


def held_ids(column: pa.Array, width: np.dtype) -> np.ndarray:
    """The ids of all rows of a binary column one after the other, as 32-bit numbers."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data.view(width).astype("<u4")


def pack(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 0,
    gap: float = 1e-3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    `ids` are little-endian unsigned 32-bit ids of the piece; grouped by sequence_id and ordered by offset
    they are the sequences, without gaps. A null text is empty (one piece holding `end_id`); documents with
    equal or null ids are documents of their own; an empty table gives no rows; other columns are not read.
    """
    spark = documents.sparkSession
    width = tokens.encoder(tokenizer).dtype
    held = common.store(encode_ranked(documents, tokenizer, capacity, end_id, doc_id, text))
    counts = held.groupBy("part", "tail").agg(
        F.count("*").alias("docs"), F.sum(F.floor(F.col("doc_tokens") / capacity)).alias("chunks")
    )
    # Kind 0 counts whole stretches, the others remainders; a row per task and kind.
    kinds = counts.where("tail > 0").select("part", F.col("tail").alias("kind"), F.col("docs").alias("n"))
    kinds = kinds.unionByName(counts.groupBy("part").agg(F.sum("chunks").alias("n")).select("part", F.lit(0).alias("kind"), "n"))
    kinds = common.store(kinds)
    demand, stretches, parts = np.zeros(capacity, np.int64), 0, 0
    for row in kinds.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("parts")).collect():
        if row.kind:
            demand[row.kind] = row.n
        else:
            stretches, parts = row.n, row.parts
    layout = lay_out(demand, capacity, stretches, gap)
    before = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = kinds.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    firsts = firsts.groupBy("part").agg(
        F.sort_array(F.collect_list("kind")).alias("kinds"),
        F.transform(F.sort_array(F.collect_list(F.struct("kind", "first"))), lambda x: x["first"]).alias("firsts"),
    )
    if parts * capacity * 12 <= BROADCAST_BYTES:  # a bounded row for each task that encoded
        firsts = F.broadcast(firsts)

    def rank(kind: Column, own: str) -> Column:
        """A rank among all documents; looked up here, as the arrays of a task beside each of its rows are 12 kB a row."""
        return (F.get("firsts", (F.array_position("kinds", kind) - 1).cast("int")) + F.col(own)).alias(own)

    found = held.join(firsts, "part").select(
        "doc_id", "doc_tokens", "tail", rank(F.col("tail"), "tail_rank"), rank(F.lit(0), "chunk_rank"), "ids"
    )
    id_type = held.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.text_blocks(whole, 5, CUT_BYTES):
                docs, places = [], []
                columns = [batch.column(k).to_pylist() for k in (1, 2, 3, 4)]
                for k, (n, tail, tail_rank, first) in enumerate(zip(*columns, strict=True)):
                    pieces = [(first + c, 0, capacity) for c in range(n // capacity)]
                    if tail:
                        pieces += layout.place(tail, tail_rank)
                    docs += [k] * len(pieces)
                    places += pieces
                owner, placed = np.array(docs, np.int32), np.array(places, np.int64).reshape(-1, 3)
                # The pieces follow each other as the ids do: one array of ids, cut at the sums of the lengths.
                bounds = np.concatenate([[0], np.cumsum(placed[:, 2])])
                firsts = np.concatenate([[0], np.cumsum(np.array(columns[0], np.int64))])[:-1]
                ids = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(owner),
                    [None, pa.py_buffer(4 * bounds), pa.py_buffer(held_ids(batch.column(5), width))],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner)),
                        pa.array(bounds[:-1] - firsts[owner]),
                        pa.array(placed[:, 2]),
                        batch.column(1).take(pa.array(owner)),
                        pa.array(placed[:, 0]),
                        pa.array(placed[:, 1]),
                        ids.cast(pa.binary()),
                    ],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return found.mapInArrow(
        cut,
        f"doc_id {id_type}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
