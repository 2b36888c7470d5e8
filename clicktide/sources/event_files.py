"""Daily event files whose headers drift from day to day.

One CSV read over files with different headers binds columns by position, silently. So the files are
grouped by header, each group is read with its own schema, and the groups are united by name.

A quoted field may hold line breaks, so a line alone does not tell whether it begins a record. Files are
split over tasks all the same:

1. A first pass counts lines, bytes and quotes of every split. Summed up along a file they tell for each
   split whether it begins inside a quoted field, and at which byte its first line stands.
2. A second pass puts lines together to records, each with the byte it begins at. A record that crosses
   the border of splits leaves pieces, which are joined; only files with such borders are read for them.
3. Spark's own CSV expression parses the records.

The driver sees file names, headers and a few numbers per split, like Spark's own list of splits.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: texts read as missing ------------------------------------------
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# Bits of a row number that hold the byte within the file; those above hold the file's place.
OFFSET_BITS = 40
# Files whose headers one task reads, and bytes of a header that it reads at a time.
HEADERS_PER_TASK, HEADER_BYTES = 256, 1 << 16
_BOM = b"\xef\xbb\xbf"


def date_from_name(name: Column) -> Column:
    """The first eight digits among the digits of a file name, null when there are fewer."""
    digits = F.regexp_replace(name, "[^0-9]", "")
    return F.when(F.length(digits) >= 8, F.substring(digits, 1, 8))


def date_token(name: Column) -> Column:
    """The text between the first `_` and the following `_` or `.` of a file name."""
    return F.nullif(F.regexp_extract(name, r"^[^_]*_([^_.]*)", 1), F.lit(""))


def _days(names: DataFrame, since: str | None, until: str | None) -> DataFrame:
    day = date_from_name(F.element_at(F.split("path", "/"), -1))
    kept = names if since is None else names.where(day >= since)
    return kept if until is None else kept.where(day <= until)


def list_files(
    spark: SparkSession,
    folder: str,
    suffix: str = ".csv",
    since: str | None = None,
    until: str | None = None,
) -> list[str]:
    """Sorted paths of files that hold any byte, by date (`YYYYMMDD`) if wanted; contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    )
    return sorted(row.path for row in _days(listed.select("path"), since, until).collect())


# --- headers ----------------------------------------------------------------------


@dataclass(frozen=True)
class Header:
    """The columns of a file and the byte behind its header record."""

    columns: tuple[str, ...]
    end: int


def safe_names(fields: list[str]) -> tuple[str, ...]:
    """Names that a table can have: blank ones are numbered, repeated ones get their place."""
    lowered = [f.lower() for f in fields]
    return tuple(
        f"_c{k}" if not f else f"{f}{k}" if lowered.count(f.lower()) > 1 else f
        for k, f in enumerate(fields)
    )


def first_record(chunks: Iterable[bytes], multi_line: bool = True) -> Header:
    """The header of a file, the first record that is not blank.

    A byte-order mark at the beginning does not count, neither here nor in Spark's lines.
    """
    data = b""
    start = end = 0
    for chunk in chunks:
        data += chunk if data else chunk.removeprefix(_BOM)
        while (end := data.find(b"\n", end)) >= 0:
            record = data[start:end]
            if multi_line and record.count(b'"') % 2:
                end += 1  # the break lies inside a quoted field
            elif record.strip():
                return Header(_fields(record), end + 1)
            else:
                start = end = end + 1
        end = len(data)
    return Header(_fields(data[start:]) if data[start:].strip() else (), len(data))


def _fields(record: bytes) -> tuple[str, ...]:
    text = record.decode("utf-8", "replace").removesuffix("\r")
    return safe_names(next(csv.reader([text], strict=False)))


def _open(path: str):
    from pyarrow import fs

    local = re.fullmatch(r"(?:file:/*)?/(.*)", path)
    if local:
        return fs.LocalFileSystem().open_input_stream(f"/{local[1]}")
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_stream(inside)


def read_headers(
    spark: SparkSession, paths: Iterable[str], multi_line: bool = True
) -> dict[str, Header]:
    """Header of each file, read by tasks through pyarrow (local, HDFS, S3 and GCS paths)."""
    paths = list(paths)
    if not paths:
        return {}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                with _open(path) as file:
                    found.append(first_record(iter(lambda: file.read(HEADER_BYTES), b""), multi_line))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([list(h.columns) for h in found], pa.list_(pa.string())),
                    pa.array([h.end for h in found], pa.int64()),
                ],
                ["path", "columns", "end"],
            )

    tasks = -(-len(paths) // HEADERS_PER_TASK)
    frame = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    rows = frame.mapInArrow(read, "path string, columns array<string>, end long").collect()
    found = {r.path: Header(tuple(r.columns), r.end) for r in rows}
    return {p: found[p] for p in paths}


def file_headers(
    spark: SparkSession, paths: Iterable[str], multi_line: bool = True
) -> dict[str, tuple[str, ...]]:
    """Columns of each file."""
    return {p: h.columns for p, h in read_headers(spark, paths, multi_line).items()}


# --- records of splits ------------------------------------------------------------


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, split, value): lines in the order of their split; a hash names the file."""
    rows = spark.read.option("lineSep", "\n").text(paths)
    return rows.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("value"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The lines of a batch, split by split."""
    file, split = (batch.column(k).to_numpy() for k in (0, 1))
    new = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1
    borders = [0, *new.tolist(), len(file)]
    for a, b in zip(borders, borders[1:]):
        if b > a:
            yield (int(file[a]), int(split[a])), batch.column(2).slice(a, b - a)


def _quotes(lines: pa.Array, multi_line: bool) -> np.ndarray:
    if not multi_line:
        return np.zeros(len(lines), np.int64)
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _bytes(lines: pa.Array) -> np.ndarray:
    """Bytes of the lines with their line feeds."""
    return pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64) + 1


def _measured(lines: DataFrame, multi_line: bool) -> DataFrame:
    """Per split: bytes, quotes, and where its last record begins if it does not (0) or does (1)
    start inside a quoted field (-1: no record begins)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for key, own in _runs(batch):
                size, quotes, *last = held.get(key, [0, 0, -1, -1])
                counts, sizes = _quotes(own, multi_line), _bytes(own)
                before = quotes + np.cumsum(counts) - counts
                offsets = size + np.cumsum(sizes) - sizes
                for inside in (0, 1):
                    begins = np.flatnonzero((before + inside) % 2 == 0)
                    if len(begins):
                        last[inside] = int(offsets[begins[-1]])
                held[key] = [size + int(sizes.sum()), quotes + int(counts.sum()), *last]
        rows = [(*key, *values) for key, values in held.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], pa.int64()) for k in range(6)],
            ["file", "split", "bytes", "quotes", "last_outside", "last_inside"],
        )

    return lines.mapInArrow(
        measure,
        "file long, split long, bytes long, quotes long, last_outside long, last_inside long",
    )


@dataclass(frozen=True)
class Split:
    """What is known of a split before it is read: its first byte and the record that it starts in."""

    rank: int  # place of the file among the sorted files
    offset: int
    inside: bool
    owner: int  # first byte of the record that is open where the split begins


class Splits:
    """What is known of all splits, as arrays in the order of files and places: 41 bytes a split.

    That is what is sent to the tasks; 100 TB in splits of 128 MB are some 32 MB.
    """

    def __init__(self, measured: list[pa.Table], ranks: dict[int, int]) -> None:
        found = pa.concat_tables(measured).sort_by([("file", "ascending"), ("split", "ascending")])
        columns = {c: found.column(c).to_numpy() for c in found.column_names}
        self.file, self.split = columns["file"], columns["split"]
        files, first, number = np.unique(self.file, return_index=True, return_inverse=True)
        self.rank = np.array([ranks[f] for f in files.tolist()], np.int64)[number]
        # Running sums along each file.
        begin = first[number]
        self.offset, quotes = (
            (before := np.cumsum(columns[c]) - columns[c]) - before[begin] for c in ("bytes", "quotes")
        )
        self.inside = quotes % 2 == 1
        # The last record begun in this split or an earlier one of the file; that before a split is its owner.
        last = np.where(self.inside, columns["last_inside"], columns["last_outside"])
        begun = (number << OFFSET_BITS) + np.where(last >= 0, self.offset + last, 0)
        known = np.maximum.accumulate(begun) & ((1 << OFFSET_BITS) - 1)
        self.owner = np.where(np.arange(len(begin)) == begin, 0, np.roll(known, 1))

    def find(self, file: int, split: int) -> Split | None:
        low, high = np.searchsorted(self.file, file, "left"), np.searchsorted(self.file, file, "right")
        at = low + np.searchsorted(self.split[low:high], split)
        if at == high or self.split[at] != split:
            return None
        return Split(int(self.rank[at]), int(self.offset[at]), bool(self.inside[at]), int(self.owner[at]))


def _records(lines: DataFrame, splits, multi_line: bool, pieces: bool) -> DataFrame:
    """(rank, record, piece, text): the records that lie in one split, or the pieces of the others.

    `record` is the byte that the record begins at, `piece` that of the piece. `splits` is a broadcast
    of `Splits`.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, split, offset, inside = None, None, 0, 0
        # The record that is not finished yet: first byte, first byte here, lines, begun elsewhere.
        begun, first, parts, foreign = 0, 0, [], False
        rank: list[int] = []
        record: list[int] = []
        piece: list[int] = []
        text: list[bytes] = []

        def emit(crosses: bool) -> None:
            nonlocal parts
            if parts and crosses == pieces:
                rank.append(split.rank)
                record.append(begun)
                piece.append(first)
                text.append(b"\n".join(parts))
            parts = []

        def made() -> Iterator[pa.RecordBatch]:
            if rank:
                columns = [pa.array(c, pa.int64()) for c in (rank, record, piece)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(text, pa.binary())], names)
            for c in (rank, record, piece, text):
                c.clear()

        for batch in batches:
            for found, own in _runs(batch):
                if found != key:
                    emit(True)
                    key, split = found, splits.value.find(*found)
                    if split is None:
                        raise ValueError("files or split sizes have changed since the files were listed")
                    offset, inside = split.offset, int(split.inside)
                    begun, first, foreign = split.owner, split.offset, split.inside
                counts, sizes = _quotes(own, multi_line), _bytes(own)
                after = inside + np.cumsum(counts)
                before = (after - counts) % 2
                after %= 2
                starts = offset + np.cumsum(sizes) - sizes
                whole = (before == 0) & (after == 0)
                for k in np.flatnonzero(~whole).tolist():
                    if not before[k]:
                        begun = first = int(starts[k])
                        foreign = False
                    parts.append(own[k].as_py())
                    if not after[k]:
                        emit(foreign)
                        foreign = False
                if not pieces and whole.any():
                    at = pa.array(starts[whole])
                    ranks = pa.array(np.full(len(at), split.rank, np.int64))
                    yield pa.RecordBatch.from_arrays([ranks, at, at, own.filter(pa.array(whole))], names)
                offset += int(sizes.sum())
                inside = int(after[-1])
            yield from made()
        emit(True)
        yield from made()

    names = ["rank", "record", "piece", "text"]
    return lines.mapInArrow(work, "rank long, record long, piece long, text binary")


def _joined(pieces: DataFrame) -> DataFrame:
    """The records that cross splits, put together from their pieces in order."""
    inside = F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda x: x["text"])
    return pieces.withColumn("text", F.col("text").cast("string")).groupBy("rank", "record").agg(
        F.array_join(inside, "\n").alias("text")
    )


# --- events -----------------------------------------------------------------------


def read_event_folder(
    spark: SparkSession,
    folder: str,
    missing_tokens: tuple[str, ...] = MISSING_TOKENS,
    multi_line: bool = True,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """All daily CSV files of a folder as one frame of strings.

    Adds `partition_date` (from the file name), `source_file`, `source_columns` (the file's own header)
    and `event_id`, to break ties with: the file's place among the sorted files, then the byte at which
    the record begins. It is the same in every read, whatever the split size, while no earlier file is
    added. `since` and `until` (`YYYYMMDD`) leave out files by name; the ids then count from the first
    one read. Set `multi_line=False` when quotes have no meaning over lines: every line is a record.

    Texts are UTF-8, lines end with a line feed, a carriage return before it does not count. Reading
    makes one pass for the splits when called and one when used, with the same split size; land the
    result with `write_by_partition` before running several jobs on it.
    """
    paths = list_files(spark, folder, since=since, until=until)
    if not paths:
        raise ValueError(f"No CSV files found in {folder}")
    headers = read_headers(spark, paths, multi_line)
    rank_of = {p: k for k, p in enumerate(paths)}
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        groups.setdefault(headers[path].columns, []).append(path)
    groups.pop((), None)  # files without a header hold no rows
    if not groups:
        raise ValueError(f"No CSV file in {folder} has a header")

    # Both passes read the same groups, so that they see the same splits.
    measured, ranks = [], {}
    for group in groups.values():
        measured.append(_measured(_lines(spark, group), multi_line).toArrow())
        ranks |= _hashes(spark, group, rank_of)
    splits = Splits(measured, ranks)
    crossed = set(splits.rank[splits.inside].tolist())
    known = spark.sparkContext.broadcast(splits)

    def read_group(columns: tuple[str, ...], group: list[str]) -> DataFrame:
        whole = _records(_lines(spark, group), known, multi_line, pieces=False)
        rows = whole.select("rank", "record", F.col("text").cast("string").alias("text"))
        if crossed & {rank_of[p] for p in group}:
            rows = rows.unionByName(
                _joined(_records(_lines(spark, group), known, multi_line, pieces=True))
            )
        facts = spark.createDataFrame(
            [(rank_of[p], p.rsplit("/", 1)[-1], headers[p].end) for p in group],
            "rank long, source_file string, header_end long",
        )
        return _parsed(rows.join(F.broadcast(facts), "rank"), columns, missing_tokens)

    frames = [read_group(columns, group) for columns, group in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _hashes(spark: SparkSession, paths: list[str], rank_of: dict[str, int]) -> dict[int, int]:
    """Hash of each path, as `_lines` has it, to the file's place."""
    named = spark.read.format("binaryFile").load(paths).select(
        "path", F.xxhash64("_metadata.file_path").alias("file")
    )
    found = {r.file: rank_of[r.path] for r in named.collect()}
    if len(found) != len(paths):
        raise ValueError("two paths share a hash")
    return found


def _parsed(
    records: DataFrame, columns: tuple[str, ...], missing_tokens: tuple[str, ...]
) -> DataFrame:
    """Records (rank, record, text, source_file, header_end) as rows of strings."""
    text = F.regexp_replace("text", "\r$", "")
    quoted = [c.replace("`", "``") for c in columns]
    fields = F.from_csv(
        text, ", ".join(f"`{c}` string" for c in quoted), {"quote": '"', "escape": '"', "multiLine": "true"}
    )
    rows = records.where((F.col("record") >= F.col("header_end")) & (F.trim(text) != "")).select(
        fields.alias("fields"),
        "source_file",
        (F.shiftleft("rank", OFFSET_BITS) + F.col("record")).alias("row_number"),
    )
    field = [F.col(f"fields.`{c}`") for c in quoted]
    return rows.select(
        *[F.when(~f.isin(*missing_tokens), f).alias(c) for f, c in zip(field, columns)],
        date_from_name(F.col("source_file")).alias("partition_date"),
        "source_file",
        F.array(*[F.lit(c) for c in columns]).alias("source_columns"),
        F.col("row_number").alias("event_id"),
    )


def partition_headers(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    """(partition_date, source_file, columns) of every file, also of files without rows."""
    headers = file_headers(spark, list_files(spark, folder), multi_line)
    schema = "path string, columns array<string>"
    frame = spark.createDataFrame([(p, list(c)) for p, c in headers.items()], schema)
    name = F.element_at(F.split("path", "/"), -1)
    return frame.select(
        date_from_name(name).alias("partition_date"), name.alias("source_file"), "columns"
    )
