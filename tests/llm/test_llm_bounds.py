"""Bounds of memory and of packed keys, names that clash, and plain versions of vectorised sums."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clicktide.llm import binary_ids, common, language, packing, queries, simhash, tokens, toxicity

# --- Language: keys that no longer fit ------------------------------------------------------------


def short_texts(n):
    rnd = random.Random(1)
    return ["".join(rnd.choice("abcde xyzé") for _ in range(8)) for _ in range(n)]


PROFILES = {"a": "a b c ab ba abc".split(), "x": "x y z xy yx é".split()}


def packed(gram):
    code = 0
    for k in range(3):
        code = code << language.WIDTH | (ord(gram[k]) if k < len(gram) else 0)
    return code


def test_many_short_texts_in_one_block():
    texts = short_texts(50_000)
    model = language.Profiles({k: [packed(g) for g in v] for k, v in PROFILES.items()}, 300)
    names, scores = model.texts(texts)
    alone = [model.texts(texts[k : k + 500]) for k in range(0, len(texts), 500)]
    assert names == [n for own, _ in alone for n in own]
    assert np.array_equal(scores, np.concatenate([s for _, s in alone]))


def test_many_short_texts_in_one_arrow_batch(spark):
    texts = short_texts(50_000)
    profiles = {k: [packed(g) for g in v] for k, v in PROFILES.items()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = []
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for records in (100_000, 1_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
            found.append(sorted(map(tuple, language.identify(docs, profiles).collect())))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found[0] == found[1] and len(found[0]) == len(texts)


def plain_grams(texts):
    out = {}
    for k, text in enumerate(texts):
        words = ["".join(c.lower() if len(c.lower()) == 1 else c for c in w) for w in re.findall(r"[^\W\d_]+", text or "")]
        if words:
            line = " " + " ".join(words) + " "
            grams = [line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)]
            for gram, n in Counter(g for g in grams if g != " ").items():
                out[k, packed(gram)] = n
    return out


def test_large_alphabets_in_many_texts(monkeypatch):
    """Over 32,768 different signs in 40,000 texts need a second key."""
    rnd = random.Random(7)
    texts = ["".join(chr(rnd.randrange(0x20000, 0x2A6D0)) for _ in range(6)) + " ab" for _ in range(40_000)] + [None, "", "一 一"]
    calls = []
    plain = language.counted_by_pairs
    monkeypatch.setattr(language, "counted_by_pairs", lambda *a: calls.append(1) or plain(*a))
    owner, code, counts = language.grams(texts)
    assert calls and dict(zip(zip(owner.tolist(), code.tolist()), counts.tolist())) == plain_grams(texts)


def test_the_most_frequent_sign_is_ranked_first():
    model = language.Profiles({"a": [packed("a")], "b": [packed("b")]}, 1)
    assert model.texts(["bbb " + "a" * 40, "aaa " + "b" * 40])[0] == ["a", "b"]


# --- Tokens: a dictionary of bounded bytes --------------------------------------------------------


def test_the_dictionary_is_bounded_and_emptied(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 20_000)
    own = tokens.Encoder(queries.BYTE_BPE)
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    texts = pa.array([" ".join(rnd.choice([*words, "the", "and"]) for _ in range(400)) for _ in range(20)])
    ids, sizes = own.texts(texts)
    whole = [own.tokenizer.encode(t.as_py(), add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for t in whole for i in t] and sizes.tolist() == [len(t) for t in whole]
    assert 0 < len(own.old) < 200 and own.held <= 10_000 + 300
    monkeypatch.setattr(tokens, "encoder", lambda path: own)
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    assert [s.tolist() for _, _, s in tokens.encoded(iter([batch]), "", 0)] == [sizes.tolist()]
    assert not own.young and not own.old


def test_words_that_come_again_stay(monkeypatch):
    own = tokens.Encoder(queries.BYTE_BPE)
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 4_000)
    for k in range(300):
        own.piece(" the")
        own.piece(f" w{k}x")
        assert " the" in own.young or " the" in own.old


# --- Packing: pieces as slices of one array ---------------------------------------------------------


def test_ids_of_sliced_columns():
    made = [np.arange(n, dtype="<u2").tobytes() for n in (3, 0, 2, 5)]
    column = pa.array(made, pa.binary()).slice(1, 3)
    assert packing.held_ids(column, np.dtype("<u2")).tolist() == [0, 1, 0, 1, 2, 3, 4]


@pytest.mark.parametrize("cut_bytes", [1, 2 << 20])
def test_pieces_hold_the_ids_in_order(spark, monkeypatch, cut_bytes):
    monkeypatch.setattr(packing, "CUT_BYTES", cut_bytes)
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["word", "é", "x1", "the"]) for _ in range(rnd.randrange(0, 60))) for _ in range(40)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    held = {}
    for r in sorted(packing.pack(docs, queries.BYTE_BPE, capacity=16, end_id=0).collect(), key=lambda r: (r.doc_id, r.start)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == len(held.setdefault(r.doc_id, [])) and len(ids) == r.length
        held[r.doc_id] += ids
    own = tokens.encoder(queries.BYTE_BPE)
    assert held == {k: [*own.tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}


# --- Binary files: sparse ids, many small documents ---------------------------------------------------


def test_sparse_numbers_are_packed_in_slices():
    rng = np.random.default_rng(1)
    values = np.sort(rng.integers(0, 1 << 60, 400_000).astype(np.uint64))
    tracemalloc.start()
    packed_values = binary_ids.EliasFano.of(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (packed_values.all() == values).all() and peak < 90e6
    read = binary_ids.EliasFano.from_bytes(memoryview(packed_values.to_bytes()))
    assert [read.select(k) for k in (0, 65_535, 65_536, 399_999)] == [int(values[k]) for k in (0, 65_535, 65_536, 399_999)]


def test_shards_close_at_so_many_documents(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(binary_ids, "SHARD_DOCS", 7)
    rows = [(k << 50, "a") for k in range(30)] + [(5, "same")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = binary_ids.write_shards(docs, queries.BYTE_BPE, str(tmp_path / "s"))
    assert max(r.n_docs for r in manifest.collect()) <= 7
    back = binary_ids.read_shards(spark, str(tmp_path / "s"), manifest).collect()
    assert sorted(r.doc_id for r in back) == sorted(r[0] for r in rows)
    starts = sorted((r.start, r.n_tokens) for r in back)
    assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts])[:-1].tolist()]


# --- Toxicity: the margin as a double loop ------------------------------------------------------------


def test_margin_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(2)
    size = 1 << toxicity.BITS
    linear, factors = np.zeros(size), np.zeros((size, 4))
    known = rng.choice(size, 40, replace=False)
    linear[known], factors[known] = rng.normal(size=40), rng.normal(size=(40, 4))
    model = toxicity.Machine(-0.3, linear, factors)
    rows = [np.sort(rng.choice(known, n, replace=False)).astype(np.int32) for n in (0, 1, 2, 7, 40)]
    for row, margin in zip(rows, model.margin(rows)):
        want = model.bias + sum(linear[t] for t in row)
        for i in range(len(row)):
            for j in range(i):
                want += float(factors[row[i]] @ factors[row[j]])
        assert margin == pytest.approx(want)


# --- Names and folders --------------------------------------------------------------------------------


def test_columns_named_like_inner_ones_stay(spark):
    rows = [(1, "a b c d", "r", "f", "t"), (2, "a b c d", "s", "g", "u"), (3, "other words in here", "v", "h", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__row` string, `__fp` string, `__text` string")
    kept = sorted(map(tuple, simhash.keep_one(docs).collect()))
    assert kept == [rows[0], rows[2]]


def test_fresh_names():
    class Frame:
        columns = ["__A", "__a_", "b"]

    assert common.fresh_name(Frame, "a") == "__a__" and common.fresh_name(Frame, "b") == "__b"


def test_a_shared_folder_is_asked_for_on_clusters(spark, monkeypatch):
    assert common.shared_folder(spark).startswith("file:/")
    root = common.shared_root(spark)
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    assert common.shared_root(spark) != root and "llm-" in common.shared_root(spark)

    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        conf, sparkContext = spark.conf, Context

    with pytest.raises(ValueError):
        common.shared_root(Session)


def test_rounds_of_components_leave_one_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_root", lambda s: str(tmp_path))
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == dict.fromkeys(range(41), 0)
    assert len(list(tmp_path.glob("llm-*"))) == 1
    assert simhash.components(edges.where(F.lit(False))).count() == 0


# --- Kept rows by maps of bits --------------------------------------------------------------------------


def numbered_rows(spark, n):
    """Rows of three tasks with their numbers; each holds more than one map of numbers."""
    return spark.range(0, n, 1, 3).select(F.col("id").alias("doc_id"), F.monotonically_increasing_id().alias("row"))


@pytest.mark.parametrize("limit", [simhash.BROADCAST_BYTES, 0])
def test_marked_rows_are_those_of_a_semi_join(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BROADCAST_BYTES", limit)
    rows = numbered_rows(spark, 3 * (simhash.MARKED + 9))
    for chosen in (F.xxhash64("row") % 5 == 0, F.col("row").bitwiseAND(simhash.MARKED - 1).isin(0, 7, 8, simhash.MARKED - 1), F.lit(True), F.lit(False)):
        numbers = rows.where(chosen).select(F.col("row").alias("number"))
        found = simhash.marked(rows, numbers, "row")
        assert found.columns == rows.columns
        wanted = rows.where(chosen)
        assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty()


def test_kept_texts_are_not_shuffled(spark):
    """One row of each component without the corpus crossing the network, whatever Spark takes for small."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(k, f"text {k % 7} of a few words") for k in range(40)], "doc_id long, text string").repartition(4)
        kept = simhash.keep_one(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert {r.doc_id for r in kept.collect()} == {min(r) for r in groups(docs)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def groups(docs):
    """The doc_ids of each component."""
    found = {}
    for r in simhash.near_duplicates(docs).collect():
        found.setdefault(r.component_id, []).append(r.doc_id)
    return found.values()


@pytest.mark.parametrize("limit", [packing.BROADCAST_BYTES, 0])
def test_rows_to_pack_carry_no_tables(spark, monkeypatch, limit):
    """What Python gets of a document is bounded by its ids: ranks come as numbers, not as the arrays of its task."""
    monkeypatch.setattr(packing, "BROADCAST_BYTES", limit)
    docs = spark.createDataFrame([(k, "word " * (k % 50)) for k in range(300)], "doc_id long, text string").repartition(3)
    made = packing.pack(docs, queries.BYTE_BPE, capacity=16)
    node = made._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "MapInArrow":
        node = node.children().apply(0)
    assert "array" not in node.children().apply(0).schema().simpleString()
    found = {}
    for r in made.collect():
        found.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for pieces in found.values():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + length)
    sizes = [sum(length for _, length in pieces) for pieces in found.values()]
    assert sum(size != 16 for size in sizes) <= 4 and sorted(found) == list(range(len(found)))
