"""Fill-in-middle: a text becomes prefix, suffix and middle behind sentinels, by displacement scatter.

Every token unit is optional white space and a word, or white space at the end of a text. Two cuts between
units part a text into prefix, middle and suffix. Within a block of texts the cuts are found by one scan over
the bytes; each part moves as a whole, so a difference array holds the change of displacement at the first byte
of each part, its cumulative sum is the displacement of every byte, and one scatter writes all outputs.
`restore` finds the sentinels in the outputs, builds the displacements the same way and gathers the texts back.

Sentinels stand for themselves only: a text that holds one stays plain, and none can come about where a text
meets a sentinel, as each begins with `<` and ends with `>` and has neither inside.

Null and empty texts have no units and are plain and empty. All rows and columns of the input stay, repeated
rows and ids are rows of their own (equal ids draw equally), a null id draws like an empty one, and an empty
table gives an empty table. A column that has the name of a new one is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.common import fresh_name, text_blocks

#: The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
MARK = 3  # bytes of a sentinel
#: Bytes of text in a block, and bytes moved at a time: displacements take eight times as much.
BLOCK, SLICE = 4 << 20, 1 << 18
NEW = ("n", "form", "prefix_chars", "middle_chars", "output")


def draws(doc_id: Column, seed: int) -> Column:
    """Four numbers of an id: the first groups of eight digits of the SHA-256 of `seed:id`."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(named.cast("binary"), 256)
    groups = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    return F.array(*groups)


# --- Blocks of texts as one array of bytes ---------------------------------------------------------


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the text borders in them; a null text is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    borders = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, borders - borders[0]


def as_texts(data: np.ndarray, borders: np.ndarray) -> pa.Array:
    """The array of strings that `flat` is the reverse of."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(borders, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(borders) - 1, buffers).cast(pa.string())


def find_marks(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sentinels: first byte, number (1, 2, 3 for prefix, suffix, middle) and the text that each lies in."""
    framed = (data[:-2] == ord("<")) & (data[2:] == ord(">"))
    spots, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for number, mark in enumerate((PREFIX, SUFFIX, MIDDLE), 1):
        found = np.flatnonzero(framed & (data[1:-1] == ord(mark[1])))
        spots.append(found)
        numbers.append(np.full(len(found), number))
    spot, number = np.concatenate(spots), np.concatenate(numbers)
    owner = np.searchsorted(borders, spot, "right") - 1
    whole = spot + MARK <= borders[owner + 1] if len(spot) else np.zeros(0, bool)
    return spot[whole], number[whole], owner[whole]


def scan(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes behind the units of all texts, and how many of them lie before each text border."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    last = np.zeros(len(data), bool)
    last[borders[1:][borders[1:] > borders[:-1]] - 1] = True
    ends = last.copy()
    ends[:-1] |= ~space[:-1] & space[1:]
    # A word that ends a text is counted once; white space at its end is a unit of its own.
    places = np.flatnonzero(ends) + 1
    return places, np.searchsorted(places, borders, "right")


def positions(starts: np.ndarray, change: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Where every byte goes, slice by slice: its place plus the displacement of its part.

    Part k begins at `starts[k]` (ascending; empty parts share a start with the next one) and is displaced by
    `change[k]`. The differences are put at the starts and summed up along the bytes.
    """
    step, held = np.diff(change, prepend=0), 0
    for low in range(0, size, SLICE):
        high = min(low + SLICE, size)
        a, b = np.searchsorted(starts, [low, high])
        delta = np.zeros(high - low, np.int64)
        np.add.at(delta, starts[a:b] - low, step[a:b])
        delta[0] += held
        shift = np.cumsum(delta)
        held = int(shift[-1])
        yield low, high, np.arange(low, high) + shift


def cut(data: np.ndarray, borders: np.ndarray, drawn: np.ndarray, rate: int, spm: int) -> dict[str, np.ndarray]:
    """Units, form (0 plain, 1 psm, 2 spm) and the two cuts, as bytes, of every text."""
    places, counted = scan(data, borders)
    units = np.diff(counted)
    at = np.sort(drawn[:, :2] % (units + 1)[:, None], axis=1)
    behind = np.concatenate([places, [0]])

    def byte(k: np.ndarray) -> np.ndarray:
        return np.where(k == 0, borders[:-1], behind[np.maximum(counted[:-1] + k - 1, 0)])

    plain = (np.diff(borders) == 0) | (drawn[:, 2] % 100 >= rate)
    plain[find_marks(data, borders)[2]] = True
    kind = np.where(plain, 0, np.where(drawn[:, 3] % 100 < spm, 2, 1))
    return {"units": units, "kind": kind, "first": byte(at[:, 0]), "second": byte(at[:, 1])}


def letters(data: np.ndarray, borders: np.ndarray, cuts: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the prefix and of the middle of every text."""
    starts = np.stack([borders[:-1], cuts["first"], cuts["second"]], axis=1).ravel()
    ends = np.concatenate([starts[1:], borders[-1:]])
    heads = np.append((data & 0xC0) != 0x80, False)
    counts = np.where(ends > starts, np.add.reduceat(heads, starts, dtype=np.int64), 0).reshape(-1, 3)
    return counts[:, 0], counts[:, 1]


def build(data: np.ndarray, borders: np.ndarray, cuts: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all outputs and their borders."""
    kind, begin, end = cuts["kind"], borders[:-1], borders[1:]
    first, second = np.where(kind == 0, end, cuts["first"]), np.where(kind == 0, end, cuts["second"])
    sizes = np.diff(borders) + np.where(kind == 0, 0, 3 * MARK)
    out_borders = np.concatenate([[0], np.cumsum(sizes)])
    base = out_borders[:-1]
    suffix, prefix = end - second, first - begin
    # Where each part begins in the output; its sentinel stands before it.
    to_prefix = np.where(kind == 0, base, np.where(kind == 1, base + MARK, base + 2 * MARK + suffix))
    to_suffix = np.where(kind == 1, base + 2 * MARK + prefix, base + MARK)
    to_middle = out_borders[1:] - (second - first)
    starts = np.stack([begin, first, second], axis=1).ravel()
    change = np.stack([to_prefix - begin, to_middle - first, to_suffix - second], axis=1).ravel()
    output = np.zeros(out_borders[-1], np.uint8)
    for low, high, goal in positions(starts, change, len(data)):
        output[goal] = data[low:high]
    for mark, place in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for k, letter in enumerate(mark.encode()):
            output[place[kind > 0] - MARK + k] = letter
    return output, out_borders


def rebuild(data: np.ndarray, borders: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts behind outputs of the given forms, and their borders."""
    spot, number, owner = find_marks(data, borders)
    prefix, suffix, middle = (np.zeros(len(kind), np.int64) for _ in range(3))
    for mark, place in ((1, prefix), (2, suffix), (3, middle)):
        place[owner[number == mark]] = spot[number == mark] + MARK
    begin, end = borders[:-1], borders[1:]
    plain = kind == 0  # such an output may hold sentinels of its own, which part nothing
    n_prefix = np.where(plain, end - begin, np.where(kind == 1, suffix, middle) - MARK - prefix)
    n_suffix = np.where(plain, 0, np.where(kind == 1, middle, prefix) - MARK - suffix)
    sizes = end - begin - np.where(plain, 0, 3 * MARK)
    text_borders = np.concatenate([[0], np.cumsum(sizes)])
    at, ahead = text_borders[:-1], text_borders[1:] - n_suffix
    starts = np.stack([at, at + n_prefix, ahead], axis=1).ravel()
    change = np.stack([np.where(plain, begin, prefix) - at, middle - at - n_prefix, suffix - ahead], axis=1).ravel()
    texts = np.zeros(text_borders[-1], np.uint8)
    for low, high, source in positions(starts, change, len(texts)):
        texts[low:high] = data[source]
    return texts, text_borders


# --- On tables -------------------------------------------------------------------------------------


def transform(
    documents: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All rows and columns with n, form, prefix_chars, middle_chars and output.

    `rate` percent of the texts are cut, of these `spm` percent put the suffix first. `prefix_chars` and
    `middle_chars` count code points and are null for plain rows.
    """
    clash = [c for c in documents.columns if c in NEW]
    if clash:
        raise ValueError(f"columns {clash} have names of new columns")
    drawn = fresh_name(documents, "draws")
    rows = documents.withColumn(drawn, draws(F.col(f"`{doc_id}`"), seed))
    place = documents.columns.index(text)
    fields = "n long, form string, prefix_chars long, middle_chars long, output string"
    schema = T.StructType([*documents.schema.fields, *T._parse_datatype_string(fields).fields])
    names = schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, place, BLOCK):
                data, borders = flat(block.column(place))
                numbers = block.column(block.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
                cuts = cut(data, borders, numbers.reshape(-1, 4), rate, spm)
                output = as_texts(*build(data, borders, cuts))
                prefix, middle = letters(data, borders, cuts)
                plain = cuts["kind"] == 0
                arrays = [
                    pa.array(cuts["units"], pa.int64()),
                    pa.array(np.array([PLAIN, PSM, SPM], object)[cuts["kind"]], pa.string()),
                    pa.array(prefix, pa.int64(), mask=plain),
                    pa.array(middle, pa.int64(), mask=plain),
                    output,
                ]
                yield pa.RecordBatch.from_arrays([*block.columns[:-1], *arrays], names)

    return rows.mapInArrow(work, schema)


def restore(formed: DataFrame, form: str = "form", output: str = "output", into: str = "restored") -> DataFrame:
    """All rows and columns with the text `into`, from the output and its form alone (null output: empty)."""
    if into in formed.columns:
        raise ValueError(f"column {into} exists")
    place, kinds = formed.columns.index(output), formed.columns.index(form)
    schema = T.StructType([*formed.schema.fields, T.StructField(into, T.StringType())])
    names = schema.names
    numbers = {None: 0, PLAIN: 0, PSM: 1, SPM: 2}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, place, BLOCK):
                kind = np.array([numbers[k] for k in block.column(kinds).to_pylist()], np.int64)
                restored = as_texts(*rebuild(*flat(block.column(place)), kind))
                yield pa.RecordBatch.from_arrays([*block.columns, restored], names)

    return formed.mapInArrow(work, schema)


def digest(formed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The query's columns of the result of `transform`, with the restored texts hashed."""
    back = restore(formed, into=fresh_name(formed, "restored"))
    return back.select(
        F.col(doc_id).alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col(back.columns[-1]).cast("binary"), 256).alias("restored_sha256"),
    )
