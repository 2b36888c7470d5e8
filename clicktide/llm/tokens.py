"""Token ids of whole texts with a public tokenizer file, at the cost of the distinct words.

Pre-tokens of the byte-level vocabulary never hold white space behind other characters, so a text may
be cut before a blank or line feed that other than white space follows, and the pieces encoded alone.
Arrow cuts and counts the pieces of a block; the tokenizer sees a distinct piece once while a dictionary
remembers it. The dictionary has two generations of bounded bytes: what is met again moves to the younger one,
and when that is full the older one goes. It is emptied when a task ends, as workers outlive tasks. Ids are
those of the tokenizer over the whole text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clicktide.llm.common import text_blocks

#: Bytes of remembered pieces in a task, both generations, and what a dictionary spends on a piece beside it.
REMEMBERED_BYTES, SLOT = 96 << 20, 100
#: Bytes of text that are encoded at a time.
ENCODED_BYTES = 6 << 20
#: Longer pieces are encoded each time instead of remembered.
LONGEST_REMEMBERED = 40

#: White space beyond blank and line feed, as Unicode has it (fixed values).
OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0                　"
TWO_SPACES = f"[ \n][ \n{OTHER_SPACE}]"
CUT = re.compile("(?=[ \n]\\S)")
#: A word and the ASCII marks behind it (no apostrophe) are two pre-tokens.
WORD_AND_MARKS = re.compile("( ?[^\\W\\d_]+)([!-&(-/:-@\\[-`{-~]+)")


class Encoder:
    """Ids of texts; `path` is a tokenizers file with a byte-level vocabulary without normalizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings inside a text are ordinary text
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.alphabet = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}
        self.blank = chr(self.alphabet[32])
        self.forget()

    def forget(self) -> None:
        """Start with an empty dictionary."""
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0  # bytes of the younger generation

    def _remember(self, piece: str, ids: bytes) -> None:
        self.held += getsizeof(piece) + getsizeof(ids) + SLOT
        if 2 * self.held > REMEMBERED_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[piece] = ids

    def _merged(self, piece: str) -> bytes:
        """Ids of a piece that is one pre-token: the merges alone."""
        if piece.isascii():  # letters stand for themselves
            mapped = piece.replace(" ", self.blank)
        else:
            mapped = piece.encode().decode("latin-1").translate(self.alphabet)
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _encode(self, piece: str) -> bytes:
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return array(self.code, ids).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of a piece that may be encoded alone."""
        found = self.young.get(piece)
        if found is not None:
            return found
        found = self.old.get(piece)
        if found is not None:
            self._remember(piece, found)
            return found
        if not piece:
            return b""
        if (piece[1:] if piece[0] == " " else piece).isalpha():
            found = self._merged(piece)
        else:
            marked = WORD_AND_MARKS.fullmatch(piece)
            if marked and marked[1].lstrip(" ").isalpha():
                return self.piece(marked[1]) + self.piece(marked[2])
            if piece[0] == "\n" and piece[1:].isalpha():
                return self.piece("\n") + self.piece(piece[1:])
            found = self._encode(piece)
        if len(piece) <= LONGEST_REMEMBERED:
            self._remember(piece, found)
        return found

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the number of ids of each text (null: none)."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, TWO_SPACES)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        offsets = lists.offsets.to_numpy()
        first, counts = offsets[:-1], np.diff(offsets)
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        first = first - offsets[0]
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        keys = [p if p[:1] == "\n" else " " + p for p in distinct]
        parts = [self.young.get(k) or self.piece(k) for k in keys]
        # The first piece of a text has no blank before it.
        parts += [self.piece(distinct[k]) for k in index[first].tolist()]
        index[first] = len(distinct) + np.arange(len(first), dtype=np.int32)
        if pc.any(odd).as_py():
            # White space runs in the text: cut it more carefully, as one part of its own.
            rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            keep = np.ones(len(index), bool)
            for row in rows.tolist():
                keep[first[row] + 1 : first[row] + counts[row]] = False
                parts[len(distinct) + row] = b"".join(map(self.piece, CUT.split(texts[row].as_py())))
            index = index[keep]
            counts = counts.copy()
            counts[rows] = 1
        joined = pa.array(parts, pa.large_binary()).take(pa.array(index))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1] // self.dtype.itemsize
        ids = np.frombuffer(joined.buffers()[2] or b"", self.dtype)[: ends[-1]]
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python process, built once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Blocks of rows with their ids and the ids per row; `column` is the text's position."""
    own = encoder(path)
    try:
        for batch in batches:
            for block in text_blocks(batch, column, ENCODED_BYTES):
                yield block, *own.texts(block.column(column))
    finally:
        own.forget()
        pa.default_memory_pool().release_unused()  # a worker waits for its next task without the blocks of the last
