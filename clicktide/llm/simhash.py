"""SimHash near-duplicates with pivot distance tables.

1. A 64-bit fingerprint per text; copies of a fingerprint collapse into one row.
2. Fingerprints that differ in at most k bits agree on two of k + 2 bit blocks, so the pairs of blocks are the
   keys under which fingerprints meet. For every fingerprint the Hamming distances to PIVOTS reference
   fingerprints are computed once; the distance to a pivot changes by at most the distance of the pair, so
   pairs with a larger coordinate difference are discarded, and the survivors are verified on all bits.
3. Keys under which more than PAIRED fingerprints meet would have too many pairs. Their members are linked
   through common neighbours instead: x and y are within k bits just if some z is within ceil(k/2) bits of one
   and floor(k/2) of the other. The members of a z are bounded by the size of that ball.
4. Connected components by alternating stars, each round a written table; then the smallest doc_id of each.

Null and empty texts have fingerprint zero and link like any other. Null doc_ids never name a component that
has another id. Repeated rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm import common

SEED = 42
#: Reference fingerprints; eight distances are held in one long.
PIVOTS = 16
#: Fingerprints under a key up to which they are compared pair by pair.
PAIRED = 64
#: A-Z lowered, other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 16
#: Marks of kept rows: a map of 4096 bytes for so many row numbers; maps are broadcast up to this size, else joined by a shuffle.
MARKED = 1 << 15
BROADCAST_BYTES = 64 << 20


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(shingle, len(words))
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    stops = ends[width - 1 :].tolist()
    ones, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, COUNTED):
        cut = slice(at, at + COUNTED)
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[cut], stops[cut], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(documents: DataFrame, shingle: int = 3, text: str = "text", into: str = "fp", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The rows (columns `keep`, all by default) with the fingerprint as a long `into`."""
    kept = list(documents.columns if keep is None else keep)
    chosen = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias(common.fresh_name(documents, "text")))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField(into, T.LongType())])
    place = len(kept)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in common.text_blocks(batch, place):
                found = np.array([fingerprint(t, shingle) for t in block.column(place).to_pylist()], np.uint64)
                columns = [*block.columns[:place], pa.array(found.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return chosen.mapInArrow(add, schema)


def pivots() -> list[int]:
    """The reference fingerprints: fixed pseudo-random words, signed."""
    return np.random.default_rng(SEED).integers(-(1 << 63), (1 << 63) - 1, PIVOTS, np.int64).tolist()


def pivot_table(fp: Column) -> list[Column]:
    """Distances to the pivots, eight to a long."""
    made = []
    for first in range(0, PIVOTS, 8):
        packed = F.lit(0).cast("long")
        for k, pivot in enumerate(pivots()[first : first + 8]):
            distance = F.bit_count(fp.bitwiseXOR(F.lit(pivot))).cast("long")
            packed = packed.bitwiseOR(F.shiftleft(distance, 8 * k))
        made.append(packed.alias(f"p{first // 8}"))
    return made


def close_to_pivots(a: str, b: str, bits: int) -> Column:
    """No coordinate of the two pivot tables differs by more than `bits`."""
    held = F.lit(True)
    for k in range(PIVOTS):
        x, y = (F.shiftright(F.col(f"{side}.p{k // 8}"), 8 * (k % 8)).bitwiseAND(F.lit(255)) for side in (a, b))
        held = held & (F.abs(x - y) <= bits)
    return held


def block_keys(fp: Column, bits: int) -> Column:
    """The pairs of bit blocks: an array of (pair, value)."""
    blocks = bits + 2
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    return F.array(
        *[
            F.struct(F.lit(k).alias("pair"), fp.bitwiseAND(F.lit(signed(a | b))).alias("value"))
            for k, (a, b) in enumerate(combinations(masks, 2))
        ]
    )


def links(fingerprints: DataFrame, bits: int = 2) -> DataFrame:
    """Links (a, b), a < b, that connect all distinct fingerprints `fp` within `bits` of each other.

    Up to PAIRED fingerprints of a key are compared by pairs; beyond, a fingerprint is linked to one other
    for each neighbour that both have in common, which leaves the same components.
    """
    if not 0 <= bits <= 4:
        raise ValueError("links are searched for up to 4 differing bits")
    spark = fingerprints.sparkSession
    if not bits:
        return spark.createDataFrame([], "a long, b long")
    keyed = fingerprints.select("fp", *pivot_table(F.col("fp")), F.explode(block_keys(F.col("fp"), bits)).alias("key"))
    keyed = keyed.select("fp", "p0", "p1", "key.pair", "key.value")
    sizes = keyed.groupBy("pair", "value").agg(F.count("*").alias("n")).where("n > 1")
    met = common.store(keyed.join(sizes, ["pair", "value"]))
    few = met.where(F.col("n") <= PAIRED).drop("n")
    paired = few.alias("x").join(few.alias("y"), ["pair", "value"]).where(
        (F.col("x.fp") < F.col("y.fp"))
        & close_to_pivots("x", "y", bits)
        & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= bits)
    )
    paired = paired.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    wide, narrow = -(-bits // 2), bits // 2
    flips = [(0, 0), *((sum(1 << k for k in chosen), r) for r in range(1, wide + 1) for chosen in combinations(range(64), r))]
    flips = F.array(
        *[F.struct(F.lit(m - (1 << 64) if m >> 63 else m).alias("mask"), F.lit(r <= narrow).alias("near")) for m, r in flips]
    )
    crowd = met.where(F.col("n") > PAIRED).select("fp").distinct()
    around = crowd.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip.mask")).alias("z"), F.col("flip.near").alias("near")
    )
    balls = around.groupBy("z").agg(
        F.collect_list("fp").alias("members"), F.min(F.when(F.col("near"), F.col("fp"))).alias("center")
    )
    balls = balls.where((F.size("members") > 1) & F.col("center").isNotNull())
    starred = balls.select("center", F.explode("members").alias("fp")).where("center != fp")
    starred = starred.select(F.least("center", "fp").alias("a"), F.greatest("center", "fp").alias("b"))
    return paired.unionByName(starred).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in `edges` (a, b): the smallest node that it reaches.

    Alternating large and small stars: each round writes the edges anew, removes those of the round before and
    ends when they are stars.
    """
    spark = edges.sparkSession

    def stars(frame: DataFrame, both: bool) -> DataFrame:
        """Every neighbour (both: the larger ones; else the node and the smaller) to the smallest."""
        ways = frame.select(F.col("a").alias("u"), F.col("b").alias("v"))
        ways = ways.unionByName(frame.select(F.col("b").alias("u"), F.col("a").alias("v"))) if both else frame.select(
            F.col("b").alias("u"), F.col("a").alias("v")
        )
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        met = ways.join(least, "u")
        if both:
            out = met.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        else:
            out = met.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
                least.select(F.col("m").alias("a"), F.col("u").alias("b"))
            )
        return out.where("a < b").distinct()

    def mark(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).collect()[0]
        return row.n, row.h

    held = common.shared_folder(spark)
    current = common.store(edges.distinct(), held)
    before = mark(current)
    while before[0]:
        last, held = held, common.shared_folder(spark)
        current = common.store(stars(stars(current, True), False), held)
        common.remove(spark, last)
        after = mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def roots(fingerprints: DataFrame, bits: int) -> DataFrame:
    """(fp, root) of the fingerprints that have a link; the others are their own root."""
    distinct = fingerprints.select("fp").distinct()
    found = components(links(distinct, bits))
    return found.select(F.col("node").alias("fp"), "root")


def near_duplicates(documents: DataFrame, shingle: int = 3, bits: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; `component_id` is the smallest doc_id reachable."""
    held = common.store(
        with_fingerprint(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle, keep=("doc_id",))
    )
    least = held.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots(held, bits), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return held.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def marked(rows: DataFrame, numbers: DataFrame, row: str) -> DataFrame:
    """The rows whose number `row` is in `numbers` (number), which come as one bit each: the rows are not shuffled.

    Numbers of monotonically_increasing_id() lie dense within a task's rows, so a task has a map for each MARKED
    rows and one more at most.
    """
    maps = numbers.groupBy(F.shiftright("number", 15).alias("map")).agg(
        F.bitmap_construct_agg(F.col("number").bitwiseAND(MARKED - 1)).alias("bits")
    )
    maps = common.store(maps)
    few = maps.count() * MARKED // 8 <= BROADCAST_BYTES
    place = rows[row].bitwiseAND(MARKED - 1)
    byte = F.conv(F.hex(F.substring(maps["bits"], F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    kept = F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1
    return rows.join(F.broadcast(maps) if few else maps, (F.shiftright(rows[row], 15) == maps["map"]) & kept, "left_semi")


def keep_one(documents: DataFrame, shingle: int = 3, bits: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, in the columns it came with: the smallest doc_id, of repeated ids one row."""
    names = documents.columns
    row, fp = common.fresh_name(documents, "row"), common.fresh_name(documents, "fp")
    numbered = documents.withColumn(row, F.monotonically_increasing_id())
    held = common.store(with_fingerprint(numbered, shingle, text, fp))
    slim = held.select(F.col(row).alias("row"), F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"))
    first = slim.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first"))
    rooted = first.join(roots(slim, bits), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("number"))
    return marked(held, kept, row).select(*[F.col(f"`{c}`") for c in names])
