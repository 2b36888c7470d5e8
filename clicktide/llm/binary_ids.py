"""Binary files of token ids with Elias-Fano coded document boundaries.

A shard file (little-endian) is a header, the document ids, the boundaries and the ids one after the other:

    magic "EFIDS001" | u32 header bytes | JSON header | doc ids | boundaries | token ids

The header names partition, shard, documents, ids, the width of an id and the bytes of each section.
Boundaries (the cumulated lengths) are an Elias-Fano sequence: the low bits packed, the high bits in unary,
and the place of every 256th one as a select sample, about 2 + log2(ids / documents) bits a document instead
of a 64-bit table. Document ids ascend, so they are a second Elias-Fano sequence of distances to the first;
null ids stand in front and are counted in the header.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clicktide.llm import common, tokens

MAGIC = b"EFIDS001"
#: A shard is closed at so many ids; a longer document is a shard of its own.
SHARD_IDS = 4 << 20
#: A shard is also closed at so many documents.
SHARD_DOCS = 1 << 18
#: Numbers that are packed or unpacked at a time, a multiple of eight.
SLICE = 1 << 16
#: A select sample for so many ones of the high bits.
SAMPLE = 256


@dataclass
class EliasFano:
    """A non-decreasing sequence of unsigned numbers in near-minimal space."""

    count: int
    low_bits: int
    low: np.ndarray  # uint8, packed
    high: np.ndarray  # uint8, unary, packed
    samples: np.ndarray  # uint32: place of every SAMPLE-th one

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        most = int(values[-1]) if n else 0
        low_bits = max(0, (most // n).bit_length() - 1) if n else 0
        places = np.arange(low_bits, dtype=np.uint64)
        # A slice has whole bytes, as its length is a multiple of eight.
        low = [
            np.packbits((values[at : at + SLICE, None] >> places & np.uint64(1)).astype(np.uint8), bitorder="little")
            for at in range(0, n, SLICE)
        ]
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(
            n,
            low_bits,
            np.concatenate([np.zeros(0, np.uint8), *low]),
            np.packbits(high, bitorder="little"),
            ones[::SAMPLE].astype("<u4"),
        )

    def select(self, index: int) -> int:
        """The value at an index, from one sample and the bytes behind it."""
        if not 0 <= index < self.count:
            raise IndexError(index)
        place, ahead = int(self.samples[index // SAMPLE]), index % SAMPLE
        byte = place // 8
        first = int(self.high[byte]) >> (place % 8) << (place % 8)  # the ones before the sample do not count
        while (here := first.bit_count()) <= ahead:
            ahead -= here
            byte += 1
            first = int(self.high[byte])
        for _ in range(ahead):
            first &= first - 1
        one = 8 * byte + (first & -first).bit_length() - 1
        low, at = 0, index * self.low_bits
        for k in range(self.low_bits):
            low |= (int(self.low[(at + k) // 8]) >> ((at + k) % 8) & 1) << k
        return (one - index) << self.low_bits | low

    def all(self) -> np.ndarray:
        """Every value, decoded at once."""
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count] - np.arange(self.count)
        values = high.astype(np.uint64) << np.uint64(self.low_bits)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        if self.low_bits:
            for at in range(0, self.count, SLICE):
                own = values[at : at + SLICE]
                bits = np.unpackbits(
                    self.low[at * self.low_bits // 8 :], count=len(own) * self.low_bits, bitorder="little"
                )
                own += bits.reshape(len(own), self.low_bits) @ weights
        return values

    def to_bytes(self) -> bytes:
        head = struct.pack("<QIII", self.count, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview) -> EliasFano:
        count, low_bits, low, high = struct.unpack_from("<QIII", data)
        at = struct.calcsize("<QIII")
        return cls(
            count,
            low_bits,
            np.frombuffer(data, np.uint8, low, at),
            np.frombuffer(data, np.uint8, high, at + low),
            np.frombuffer(data, "<u4", -(-count // SAMPLE), at + low + high),
        )


def shard_bytes(partition: int, shard: int, doc_ids: list, ends: np.ndarray, ids: list[np.ndarray], width: str) -> bytes:
    """One shard file; `ends` are the cumulated lengths of its documents, `doc_ids` ascend, nulls first."""
    known = [d for d in doc_ids if d is not None]
    first = known[0] if known else 0
    names = EliasFano.of(np.array([d - first for d in known], np.uint64)).to_bytes()
    bounds = EliasFano.of(ends).to_bytes()
    header = {
        "partition": partition,
        "shard": shard,
        "documents": len(doc_ids),
        "null_ids": len(doc_ids) - len(known),
        "first_doc_id": first,
        "ids": int(ends[-1]),
        "width": width,
        "doc_id_bytes": len(names),
        "boundary_bytes": len(bounds),
    }
    packed = json.dumps(header).encode()
    return b"".join([MAGIC, struct.pack("<I", len(packed)), packed, names, bounds, *(x.tobytes() for x in ids)])


class Shard:
    """A shard file read back: doc_ids(), span(i), ids(i)."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a shard of token ids")
        (size,) = struct.unpack_from("<I", view, 8)
        self.header = json.loads(bytes(view[12 : 12 + size]))
        at = 12 + size
        self.names = EliasFano.from_bytes(view[at : at + self.header["doc_id_bytes"]])
        at += self.header["doc_id_bytes"]
        self.bounds = EliasFano.from_bytes(view[at : at + self.header["boundary_bytes"]])
        at += self.header["boundary_bytes"]
        self.all_ids = np.frombuffer(view, self.header["width"], self.header["ids"], at)

    def __len__(self) -> int:
        return self.header["documents"]

    def doc_ids(self) -> list[int | None]:
        first = self.header["first_doc_id"]
        return [None] * self.header["null_ids"] + [first + int(x) for x in self.names.all().tolist()]

    def span(self, index: int) -> tuple[int, int]:
        return (self.bounds.select(index - 1) if index else 0), self.bounds.select(index)

    def ids(self, index: int) -> np.ndarray:
        start, end = self.span(index)
        return self.all_ids[start:end]


def put(folder: str, name: str, data: bytes) -> None:
    """Write a file under a name of this attempt and rename it, so that a lost attempt leaves no half file."""
    store, path = common.files_of(folder)
    attempt = f"{path}/_{name}-{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(attempt) as out:
        out.write(data)
    store.move(attempt, f"{path}/{name}")


def write_shards(
    documents: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 2,
    shard_ids: int = SHARD_IDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write all documents in ascending doc_id order; return the manifest (partition, shard, n_docs, n_ids).

    Documents are dealt by ranges of (doc_id, hash of the text, row), so a repeated doc_id may span files and
    copies equal in both may be many. Ids are whole numbers: others are cast, and count as null where that
    fails under the session's rules. Null doc_ids come first, null texts hold `end_id` only, an empty table writes nothing. The folder must exist
    for driver and executors alike. File names follow the order: partition, then shard.
    """
    spark = documents.sparkSession
    folder = common.qualified(spark, folder)
    common.make_folder(spark, folder)
    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = chosen.withColumn("tie", F.xxhash64("text")).withColumn("copy", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange("doc_id", "tie", "copy")
    ordered = dealt.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, shard = TaskContext.get().partitionId(), 0
        names: list = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        width = tokens.encoder(tokenizer).dtype.str
        manifest: list[tuple[int, int, int, int]] = []

        held = 0

        def close() -> None:
            nonlocal shard, names, lengths, ids, held
            if names:
                ends = np.cumsum(np.concatenate(lengths))
                put(folder, f"ids-{partition:06d}-{shard:06d}.efids", shard_bytes(partition, shard, names, ends, ids, width))
                manifest.append((partition, shard, len(names), int(ends[-1])))
                shard, names, lengths, ids, held = shard + 1, [], [], [], 0

        for block, found, sizes in tokens.encoded(batches, tokenizer, 1):
            found = np.insert(found, np.cumsum(sizes), found.dtype.type(end_id))
            docs, sizes = block.column(0).to_pylist(), sizes + 1
            bounds, at = np.concatenate([[0], np.cumsum(sizes)]), 0
            while at < len(docs):
                to = int(np.searchsorted(bounds, bounds[at] + shard_ids - held, "right")) - 1
                to = min(to, at + SHARD_DOCS - len(names))
                if to <= at and held:
                    close()
                    continue
                to = max(to, at + 1)
                names += docs[at:to]
                ids.append(found[bounds[at] : bounds[to]])
                lengths.append(sizes[at:to])
                held += int(bounds[to] - bounds[at])
                at = to
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[k] for m in manifest], pa.int64()) for k in range(4)], ["partition", "shard", "n_docs", "n_ids"]
        )

    return common.store(ordered.mapInArrow(write, "partition long, shard long, n_docs long, n_ids long"))


def read_shards(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents read back from the files: doc_id, start (ids before it), n_tokens, ids (unsigned 32-bit)."""
    earlier = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("partition").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    whole = manifest.groupBy("partition").agg(F.sum("n_ids").alias("n")).select(
        "partition", F.coalesce(F.sum("n").over(earlier), zero).alias("before")
    )
    firsts = manifest.join(whole, "partition").select(
        "partition", "shard", (F.col("before") + F.coalesce(F.sum("n_ids").over(inside), zero)).alias("first")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0):
                own = Shard(cell.as_py())
                ends = own.bounds.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                docs = own.doc_ids()
                # Runs of documents, so that no batch holds much more than a block.
                at = 0
                while at < len(docs):
                    to = max(at + 1, int(np.searchsorted(ends, starts[at] + common.BLOCK_BYTES // 4, "right")))
                    ids = own.all_ids[starts[at] : ends[to - 1]].astype("<u4")
                    bounds = (4 * np.concatenate([[0], ends[at:to] - starts[at]])).astype(np.int64)
                    held = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), to - at, [None, pa.py_buffer(bounds), pa.py_buffer(ids)]
                    )
                    place = [np.full(to - at, own.header[k], np.int64) for k in ("partition", "shard")]
                    yield pa.RecordBatch.from_arrays(
                        [
                            *map(pa.array, place),
                            pa.array(docs[at:to], pa.int64()),
                            pa.array(starts[at:to]),
                            pa.array(ends[at:to] - starts[at:to]),
                            held.cast(pa.binary()),
                        ],
                        ["partition", "shard", "doc_id", "local", "n_tokens", "ids"],
                    )
                    at = to

    files = spark.read.format("binaryFile").option("pathGlobFilter", "ids-*.efids").load(folder).select("content")
    found = files.mapInArrow(read, "partition long, shard long, doc_id long, local long, n_tokens long, ids binary")
    return found.join(firsts, ["partition", "shard"]).select(
        "doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids"
    )


def checksums(documents: DataFrame) -> DataFrame:
    """The digest of read documents: doc_id, start, n_tokens, ids_crc32."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def ids_query(spark: SparkSession, documents: DataFrame, tokenizer: str) -> DataFrame:
    """Write, read back, digest; with no document there is no file, and no row."""
    folder = common.shared_folder(spark)
    manifest = write_shards(documents, tokenizer, folder)
    return checksums(read_shards(spark, folder, manifest))

