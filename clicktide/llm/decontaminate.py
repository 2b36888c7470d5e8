"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The items are normalised (A-Z lowered, cut into words) and put into one automaton whose states are the word
sequences inside items. Documents stream through it word by word: the state says the longest match that
ends here. A match of `window` words or more covers its words; so does a whole item shorter than that.

Tasks deal the items into blocks of bounded size (a longer item is cut into pieces that share window - 1
words) and write an automaton of each into the shared folder. A benchmark of one block is one pass over the
documents. A larger one takes three steps: hashes of all windows, 64 bits each and four million a pass, name the
texts and the blocks that may meet; only those texts go through those automata, once for each block, copies of
a text once; the spans found are joined back by the text's digest. So a Python worker holds one automaton or one
table of hashes, what is stored grows with the hits, and the driver sees the blocks' names.

Within an automaton a step costs the same at any depth: every state knows the state of its last `window` words
and the nearest whole short item among its suffixes. Words that the items do not know and pairs of words that
follow each other in no item cannot lie in a match of two words, so only runs of known pairs enter the
automaton; the rest of the text is skipped with array operations.

Null texts and texts without words have no hits. Items with null or wordless texts match nothing; repeated
items count as their own ids. Item ids are compared as strings. Other columns stay untouched.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.binary_ids import put
from clicktide.llm.common import files_of, fresh_name, make_folder, qualified, shared_folder, store, text_blocks

#: Words per automaton; a larger benchmark is split into several.
BLOCK_WORDS = 200_000
#: Characters of items that one task deals into blocks, as a multiple of BLOCK_WORDS (about four blocks).
TASK_CHARS = 24
#: Hashes of windows that a worker holds in a pass, words whose hash it remembers, the factor of rolling hashes.
TABLE_HASHES, REMEMBERED, MULTIPLIER = 4 << 20, 200_000, np.uint64(0x9E3779B97F4A7C15)
#: Hits up to this size are broadcast.
BROADCAST_BYTES = 64 << 20
#: A-Z lowered; everything but letters, digits and bytes beyond ASCII cuts words.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


def pieces(text: str | None, window: int, most: int) -> Iterator[list[bytes]]:
    """The words of an item in runs of at most `most`; each `window` words lie together in one of them."""
    words: list[bytes] = []
    cut = False
    for found in re.finditer(b"[^ ]+", (text or "").encode("utf-8", "surrogatepass").translate(NORMAL)):
        words.append(found[0])
        if len(words) == most:
            yield words
            words, cut = words[most - window + 1 :], True
    if words and not (cut and len(words) < window):
        yield words


class Automaton:
    """The generalised suffix automaton of word sequences, with what a scan needs at each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.items = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        sequences = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        size = len(self.vocabulary)
        pairs = {a * size + b for s in sequences for a, b in zip(s, s[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)
        #: Words that are an item of their own; they match without a neighbour.
        self.single = np.zeros(size + 1, bool)
        by_length = sorted(range(len(self.next)), key=self.length.__getitem__)
        #: For each state of `window` words or more, the state of its last `window` words.
        self.window_state = [-1] * len(self.next)
        for state in by_length:
            if self.length[state] >= window:
                above = self.link[state]
                self.window_state[state] = state if self.length[above] < window else self.window_state[above]
        # The states of whole windows, and for each the items that hold one.
        self.at_window: dict[int, set[int]] = {}
        self.whole: dict[int, set[int]] = {}  # state of a whole short item: its items
        for number, sequence in enumerate(sequences):
            state, matched = 0, 0
            for place, word in enumerate(sequence):
                state, matched = self.step(state, matched, word)
                if place + 1 >= window:
                    self.at_window.setdefault(self.window_state[state], set()).add(number)
            if 0 < len(sequence) < window:
                self.whole.setdefault(state, set()).add(number)
                if len(sequence) == 1:
                    self.single[sequence[0]] = True
        #: The lengths of whole short items at a state and above it, with the items.
        self.short_lengths = {s: len(sequences[next(iter(found))]) for s, found in self.whole.items()}
        #: The nearest state of a whole short item, from the state itself upwards (0: none).
        self.short_state = [0] * len(self.next)
        for state in by_length[1:]:
            self.short_state[state] = state if state in self.whole else self.short_state[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        if word in nexts[last]:
            after = nexts[last][word]
            if length[after] == length[last] + 1:
                return after
            return self._split(last, word, after)
        state = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        while last >= 0 and word not in nexts[last]:
            nexts[last][word] = state
            last = link[last]
        if last >= 0:
            after = nexts[last][word]
            link[state] = after if length[after] == length[last] + 1 else self._split(last, word, after)
        return state

    def _split(self, last: int, word: int, after: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        copy = len(nexts)
        nexts.append(dict(nexts[after]))
        link.append(link[after])
        length.append(length[last] + 1)
        link[after] = copy
        while last >= 0 and nexts[last].get(word) == after:
            nexts[last][word] = copy
            last = link[last]
        return copy

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """State and length of the longest match after one more word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        after = self.next[state].get(word)
        return (0, 0) if after is None else (after, matched + 1)

    def scan(self, words: np.ndarray, first: int, spans: list[tuple[int, int]], found: set[int]) -> None:
        """Stream a run of word numbers; add covered spans (places from `first`) and matched items.

        `spans` stays in order and disjoint; a new one swallows those at its end that it meets.
        """
        state, matched = 0, 0
        seen: set[int] = set()

        def add(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, end))

        for place, word in enumerate(words.tolist(), first):
            state, matched = self.step(state, matched, word)
            if matched >= self.window:
                add(place - matched + 1, place + 1)
                at = self.window_state[state]
                if at not in seen:
                    seen.add(at)
                    found |= self.at_window[at]
            above = self.short_state[state]
            while above:  # whole short items of different lengths, fewer than `window`
                length = self.short_lengths[above]
                if length <= matched:
                    add(place - length + 1, place + 1)
                    if above not in seen:
                        seen.add(above)
                        found |= self.whole[above]
                above = self.short_state[self.link[above]]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order that cover the same places."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


class Scanner:
    """The automaton of a block; a text gives its words, covered spans of words and item ids."""

    def __init__(self, blocks: list[Automaton]):
        self.blocks = blocks

    def texts(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        """(n_words, spans, items) of each text; a block's words are looked up with one pass."""
        lists = [words_of(t) for t in texts.to_pylist()]
        ends = list(accumulate(map(len, lists)))
        spans: list[list[tuple[int, int]]] = [[] for _ in lists]
        items: list[set[str]] = [set() for _ in lists]
        bounds = np.array(ends, np.int64)
        for own in self.blocks:
            size = len(own.vocabulary)
            look = own.vocabulary.get
            numbers = np.fromiter((look(w, -1) for ws in lists for w in ws), np.int64, ends[-1] if ends else 0)
            known = numbers >= 0
            follows = np.zeros(len(numbers), bool)  # this word and the next lie side by side in an item
            both = np.flatnonzero(known[:-1] & known[1:]) if len(numbers) > 1 else np.zeros(0, np.int64)
            if len(both) and len(own.pairs):
                code = numbers[both] * size + numbers[both + 1]
                at = np.minimum(np.searchsorted(own.pairs, code), len(own.pairs) - 1)
                follows[both[own.pairs[at] == code]] = True
            if len(bounds):
                cut = bounds[(bounds > 0)] - 1  # no pair reaches over the end of a text
                follows[cut] = False
            inside = follows.copy()
            inside[1:] |= follows[:-1]
            inside |= known & own.single[numbers]
            starts = np.flatnonzero(inside & ~np.concatenate([[False], follows[:-1]]))
            stops = np.flatnonzero(inside & ~follows) + 1
            least = min([own.window, *own.short_lengths.values()])
            long = stops - starts >= least
            for start, stop in zip(starts[long].tolist(), stops[long].tolist(), strict=True):
                doc = int(np.searchsorted(bounds, start, "right"))
                found: set[int] = set()
                own.scan(numbers[start:stop], start - (ends[doc - 1] if doc else 0), spans[doc], found)
                items[doc] |= {own.items[k] for k in found}
        for k, words in enumerate(lists):
            yield len(words), merged(spans[k]), sorted(items[k])


def window_hashes(words: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Per length, the hash of every run of so many words; `words` are 64-bit hashes of words."""
    out = {}
    for length in lengths:
        code = np.zeros(max(len(words) - length + 1, 0), np.uint64)
        for k in range(length):
            code = code * MULTIPLIER + words[k : k + len(code)]
        out[length] = code
    return out


class WordHashes(dict):
    """64-bit hash of a word; the dictionary starts anew at a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def block_hashes(block: list[tuple[str, list[bytes]]], window: int) -> dict[int, np.ndarray]:
    """Per length, the sorted hashes of the windows of a block's items (a shorter item is one window)."""
    held: dict[int, list[np.ndarray]] = {}
    hashes = WordHashes()
    for _, words in block:
        length = min(window, len(words))
        held.setdefault(length, []).append(window_hashes(hashes.array(words), [length])[length])
    return {length: np.unique(np.concatenate(parts)) for length, parts in held.items()}


def write_blocks(benchmark: DataFrame, window: int, item_id: str, text: str, folder: str) -> list[str]:
    """Write a scanner and the hashes of each block of the benchmark into the folder; return the blocks' names.

    There is one name at least; the last part of a name is the number of its hashes.
    """
    spark = benchmark.sparkSession
    folder = qualified(spark, folder)
    make_folder(spark, folder)
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).where("i IS NOT NULL")
    chars = rows.agg(F.sum(F.length("t").cast("long"))).first()[0] or 0
    limit, most = BLOCK_WORDS, max(BLOCK_WORDS, 2 * window)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, names, block, size = TaskContext.get().partitionId(), [], [], 0

        def close() -> None:
            hashes = block_hashes(block, window)
            names.append(f"{task}-{len(names)}-{sum(map(len, hashes.values()))}")
            put(folder, names[-1], pickle.dumps(Scanner([Automaton(block, window)])))
            put(folder, f"{names[-1]}.hashes", pickle.dumps(hashes))

        for batch in batches:
            for part in text_blocks(batch, 1):
                for name, item in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    for words in pieces(item.as_py(), window, most):
                        if block and size + len(words) > limit:
                            close()
                            block, size = [], 0
                        block.append((name, words))
                        size += len(words)
        if block:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    dealt = rows.repartition(1 + chars // (TASK_CHARS * BLOCK_WORDS))
    names = [r.name for r in dealt.mapInArrow(build, "name string").collect()]
    return sorted(names) or [""]


def read_file(folder: str, name: str) -> bytes:
    shared, path = files_of(folder)
    with shared.open_input_stream(f"{path}/{name}") as file:
        return file.read()


class WindowTable:
    """The hashes of several blocks: which blocks may match a text."""

    def __init__(self, folder: str, names: list[str]):
        self.names = names
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for number, name in enumerate(names):
            for length, hashes in pickle.loads(read_file(folder, f"{name}.hashes")).items():
                held.setdefault(length, []).append((hashes, np.full(len(hashes), number, np.int32)))
        self.tables = {}
        for length, parts in held.items():
            hashes, blocks = (np.concatenate([p[k] for p in parts]) for k in range(2))
            order = np.argsort(hashes, kind="stable")
            self.tables[length] = hashes[order], blocks[order]

    def texts(self, texts: pa.Array, hashes: WordHashes) -> list[tuple[int, int]]:
        """Distinct (text, block) pairs that share a hash."""
        lists = [words_of(t) for t in texts.to_pylist()]
        words = np.concatenate([np.zeros(0, np.uint64), *map(hashes.array, lists)])
        owner = np.repeat(np.arange(len(lists)), [len(ws) for ws in lists])
        found: list[np.ndarray] = []
        for length, code in window_hashes(words, list(self.tables)).items():
            table, blocks = self.tables[length]
            low, high = np.searchsorted(table, code, "left"), np.searchsorted(table, code, "right")
            met = np.flatnonzero((high > low) & (owner[: len(code)] == owner[length - 1 : length - 1 + len(code)]))
            times = (high - low)[met]
            place = np.repeat(low[met], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            found.append(np.repeat(owner[met], times) * len(self.names) + blocks[place])
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
        return [divmod(int(pair), len(self.names)) for pair in pairs]


#: The block that this Python worker read last, by path.
HELD: dict[str, Scanner] = {}


def block_of(folder: str, name: str, window: int) -> Scanner:
    """A scanner from the shared folder; a worker keeps the last one only. Without a name it knows no items."""
    if not name:
        return Scanner([Automaton([], window)])
    whole = f"{folder}/{name}"
    if whole not in HELD:
        HELD.clear()
        HELD[whole] = pickle.loads(read_file(folder, name))
    return HELD[whole]


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find(documents: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", into: str = "found",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """All rows and columns with a struct `into`: n_words, spans (disjoint, in words, half-open) and items.

    A column that is called `into` already gives way.
    """
    spark = documents.sparkSession
    out = documents.drop(into)
    folder = shared_folder(spark)
    blocks = write_blocks(benchmark, window, item_id, item_text, folder)
    if len(blocks) > 1:
        return joined(out, hits(out.select(F.col(f"`{text}`").alias("text")), folder, blocks, window), text, into)
    schema = T.StructType([*out.schema.fields, T.StructField(into, FOUND)])
    return out.mapInArrow(scan_with(folder, blocks[0], window, out.columns.index(text), schema.names), schema)


def scan_with(folder: str, name: str, window: int, place: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does with one block: its batches with a last column of what is found in the texts at `place`."""
    kind = pa.struct([("n_words", pa.int64()), ("spans", SPANS), ("items", pa.list_(pa.string()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block_of(folder, name, window)
        for batch in batches:
            for block in text_blocks(batch, place):
                rows = [
                    {"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans], "items": items}
                    for n, spans, items in own.texts(block.column(place))
                ]
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(rows, kind)], names)

    return scan


def hits(texts: DataFrame, folder: str, blocks: list[str], window: int) -> DataFrame:
    """(key, spans, items) of every distinct text with a hit, over all blocks; stored. `key` is the text's MD5."""
    keyed = texts.where("text IS NOT NULL").select(F.md5("text").alias("key"), "text")
    groups: list[list[str]] = [[]]
    size = 0
    for name in blocks:
        own = int(name.rsplit("-", 1)[1])
        if groups[-1] and size + own > TABLE_HASHES:
            groups.append([])
            size = 0
        groups[-1].append(name)
        size += own

    def filtered(names: list[str]) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, hashes = WindowTable(folder, names), WordHashes()
            for batch in batches:
                for block in text_blocks(batch, 1):
                    pairs = table.texts(block.column(1), hashes)
                    rows = pa.array([p[0] for p in pairs], pa.int32())
                    met = pa.array([names[p[1]] for p in pairs], pa.string())
                    yield pa.RecordBatch.from_arrays([met, *(c.take(rows) for c in block.columns)], ["block", "key", "text"])

        return keyed.mapInArrow(work, "block string, key string, text string")

    candidates = filtered(groups[0])
    for names in groups[1:]:
        candidates = candidates.unionByName(filtered(names))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, 2):
                rows = []
                names, keys = block.column(0).to_pylist(), block.column(1).to_pylist()
                for k, name in enumerate(names):
                    for _, spans, items in block_of(folder, name, window).texts(block.column(2).slice(k, 1)):
                        rows.append((keys[k], [{"start": a, "end": b} for a, b in spans], items))
                kinds = (pa.string(), SPANS, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["key", "spans", "items"]
                )

    # A block's texts are spread over all tasks; a task takes its rows block by block.
    once = candidates.dropDuplicates(["block", "key"]).repartition("block", "key").sortWithinPartitions("block")
    span = "array<struct<start:bigint,end:bigint>>"
    found = once.mapInArrow(scan, f"key string, spans {span}, items array<string>").where(F.size("spans") > 0)
    whole = found.groupBy("key").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        swallowed = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))
        meets = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= s["start"])
        return F.when(meets, swallowed).otherwise(F.concat(done, F.array(s)))

    return store(whole.withColumn("spans", F.aggregate("spans", F.array().cast(span), merge)))


def joined(documents: DataFrame, found: DataFrame, text: str, into: str) -> DataFrame:
    """The documents with the struct `into` from the hits of their texts, broadcast where those are few."""
    key = fresh_name(documents, "key")
    size = F.sum(F.lit(96) + 16 * F.size("spans") + F.length(F.array_join("items", ",")))
    small = (found.agg(size).first()[0] or 0) <= BROADCAST_BYTES
    renamed = found.select(F.col("key").alias(key), F.struct("spans", "items").alias(f"{key}hit"))
    keyed = documents.withColumn(key, F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    met = keyed.join(F.broadcast(renamed) if small else renamed, key, "left")
    n_words = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD.pattern)).cast("long")
    hit = F.col(f"{key}hit")
    whole = F.struct(
        n_words.alias("n_words"),
        F.coalesce(hit["spans"], F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        F.coalesce(hit["items"], F.array().cast("array<string>")).alias("items"),
    )
    return met.select(*[F.col(f"`{c}`") for c in documents.columns], whole.alias(into))


def digest(documents: DataFrame, doc_id: str = "doc_id", found: str = "found") -> DataFrame:
    """A row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate(F.col(found)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return documents.select(
        doc_id,
        F.col(found)["n_words"].alias("n_words"),
        hit.alias("n_hit"),
        F.size(F.col(found)["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.col(found)["items"], ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def without_spans(text: str, spans: list) -> str:
    """The text without the characters of the covered words (from the first to the last of a span)."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for span in spans:
        start, end = places[span["start"]][0], places[span["end"] - 1][1]
        out.append(text[at:start])
        at = end
    out.append(text[at:])
    return "".join(out)


def clean(documents: DataFrame, benchmark: DataFrame, window: int = 10, most_covered: float = 0.5,
          text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents without benchmark passages, in the columns they came with.

    Covered spans go; documents with more than `most_covered` of their words covered go altogether. Others
    stay as they are. A single block is searched and cut out in one pass: two Python steps in a task would be two
    workers, each with its own memory for as long as the executor keeps it.
    """
    into = fresh_name(documents, "found")
    names, place = documents.columns, documents.columns.index(text)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(len(names))
            marks = found.field("spans")
            bounds = marks.offsets.to_numpy()
            ends = np.cumsum([0, *(s["end"] - s["start"] for s in marks.flatten().to_pylist())])
            hit = np.diff(ends[bounds - bounds[0]])
            rows = np.flatnonzero(hit)
            texts = batch.column(place)
            if len(rows):
                changed = texts.to_pylist()
                for row in rows.tolist():
                    changed[row] = without_spans(changed[row], marks[row].as_py())
                texts = pa.array(changed, texts.type)
            columns = [texts if k == place else batch.column(k) for k in range(len(names))]
            few = hit <= most_covered * found.field("n_words").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(few))

    folder = shared_folder(documents.sparkSession)
    blocks = write_blocks(benchmark, window, item_id, item_text, folder)
    if len(blocks) > 1:
        found = joined(documents, hits(documents.select(F.col(f"`{text}`").alias("text")), folder, blocks, window), text, into)
        return found.mapInArrow(strip, documents.schema)
    scan = scan_with(folder, blocks[0], window, place, [*names, into])
    return documents.mapInArrow(lambda batches: strip(scan(batches)), documents.schema)
