"""Quality network, importance resampling and fill-in-middle against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clicktide.llm import fill_middle, importance, quality_network, queries

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- fill-in-middle --------------------------------------------------------------------------------


def plain_form(text, numbers, rate, spm):
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((numbers[0] % (n + 1), numbers[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or numbers[2] % 100 >= rate:
        return n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if numbers[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def id_numbers(doc_id, seed):
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


@pytest.mark.parametrize("size", [5, 1 << 18])
def test_blocks_match_a_plain_cut(monkeypatch, size):
    """Random texts of marks, parts of marks, wide letters and white space, also over slice borders."""
    monkeypatch.setattr(fill_middle, "SLICE", size)
    rng = random.Random(5)
    parts = ["a", "é", "😀", " ", "\n", "\t", "b", "<", "P", "S", "M", ">", "<P>"]
    for _ in range(400):
        letters = parts[: rng.choice([7, 12, 13])]
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(20))) for _ in range(rng.randrange(8))]
        numbers = np.array([[rng.randrange(2**32) for _ in range(4)] for _ in texts], np.int64).reshape(-1, 4)
        data, borders = fill_middle.flat(pa.array(texts, pa.string()))
        cuts = fill_middle.cut(data, borders, numbers, 70, 50)
        output = fill_middle.as_texts(*fill_middle.build(data, borders, cuts))
        back = fill_middle.rebuild(*fill_middle.flat(output), cuts["kind"])
        assert fill_middle.as_texts(*back).to_pylist() == texts
        for k, text in enumerate(texts):
            want = plain_form(text, numbers[k].tolist(), 70, 50)
            form = ("plain", "psm", "spm")[cuts["kind"][k]]
            assert (int(cuts["units"][k]), form, output[k].as_py()) == (want[0], want[1], want[4])
            if form != "plain":
                prefix, middle = fill_middle.letters(data, borders, cuts)
                assert (prefix[k], middle[k]) == want[2:4]


def test_sliced_arrays_and_nulls():
    texts = pa.array(["x", None, "é y", "", "z"]).slice(1, 3)
    data, borders = fill_middle.flat(texts)
    assert data.tobytes().decode() == "é y" and borders.tolist() == [0, 0, 4, 4]


def test_table_keeps_rows_and_columns(edge_documents):
    formed = fill_middle.transform(edge_documents, rate=80).cache()
    rows = formed.collect()
    assert len(rows) == edge_documents.count() and formed.columns[: len(edge_documents.columns)] == edge_documents.columns
    for r in rows:
        want = plain_form(r.text or "", id_numbers(r.doc_id, 42), 80, 80)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want
        assert r.tail == (None if r.tail is None else f"extra {r.doc_id}")
    restored = fill_middle.restore(formed).collect()
    assert sorted((r.text or "") for r in restored) == sorted(r.restored for r in restored)
    assert all((r.text or "") == r.restored for r in restored)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_restored_from_output_and_form_alone(spark):
    made = [("plain", "<P>a<S>"), ("psm", "<P>a<<S>b<M>c"), ("spm", "<S><P><M>"), (None, None), ("plain", None)]
    rows = fill_middle.restore(spark.createDataFrame(made, "form string, output string").coalesce(1)).collect()
    assert [r.restored for r in rows] == ["<P>a<S>", "a<cb", "", "", ""]


def test_names_that_clash_and_empty_tables(no_documents, spark):
    assert fill_middle.digest(fill_middle.transform(no_documents)).count() == 0
    with pytest.raises(ValueError):
        fill_middle.transform(no_documents.withColumn("form", F.lit("x")))
    held = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, `__draws` string, `__restored` string")
    row = fill_middle.digest(fill_middle.transform(held)).first()
    assert row.restored_sha256 == hashlib.sha256(b"a b").hexdigest()


def test_long_text(spark):
    text = "wörd  " * 400_000
    made = fill_middle.transform(spark.createDataFrame([(7, text)], "doc_id long, text string"), rate=100)
    row = fill_middle.digest(made).first()
    want = plain_form(text, id_numbers(7, 42), 100, 80)
    assert (row.n, row.form, row.prefix_chars, row.middle_chars) == want[:4]
    assert row.output_sha256 == hashlib.sha256(want[4].encode()).hexdigest()
    assert row.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


# --- importance resampling -------------------------------------------------------------------------


def plain_features(text, longest):
    words = WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain_resample(rows, target, buckets, longest, percent, least_words, seed):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    found = [plain_features(text, longest) for _, text in rows]
    s = Counter(bucket(f) for _, fs in found for f in fs)
    t = Counter(bucket(f) for text in target for f in plain_features(text, longest)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for (doc_id, _), (words, fs) in zip(rows, found):
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(fs), weight, weight + noise, None, len(words)])
    ready = sorted((r for r in out if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    for rank, row in enumerate(ready[: percent * len(ready) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def collected(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("longest, buckets, percent", [(1, 10_000, 10), (3, 997, 50), (1, 7, 100)])
def test_given_documents_match_a_plain_loop(spark, documents, longest, buckets, percent):
    target = [r.text for r in queries.table(spark, "/root/testdata/sf0.001", "benchmark").collect()]
    rows = [(k, r.text) for k, r in documents.items()]
    frame = queries.table(spark, "/root/testdata/sf0.001", "documents").repartition(5)
    benchmark = spark.createDataFrame([(t,) for t in target], "text string")
    got = collected(importance.resample(frame, benchmark, buckets, longest, percent))
    assert got == plain_resample(rows, target, buckets, longest, percent, 20, 2024)


def test_query_draws_a_tenth(spark, documents, sf_dir):
    rows = queries.op12_importance_resampling(spark, sf_dir).collect()
    assert len(rows) == len(documents)
    long_enough = sum(len(plain_features(r.text, 1)[0]) >= 20 for r in documents.values())
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 10 * long_enough // 100 + 1))


def test_edge_documents_match_a_plain_loop(edge_documents, spark):
    rows = [(r.doc_id, r.text) for r in edge_documents.collect()]
    target = spark.createDataFrame([(None, "x"), ("the cat", "y")], "text string, doc_id string")
    got = importance.resample(edge_documents, target, 500, 2, 70, 1)
    assert collected(got) == plain_resample(rows, [None, "the cat"], 500, 2, 70, 1, 2024)


def test_many_rows_of_one_score_are_ordered_by_id(spark):
    """Equal texts and a noise of zero are told apart by id alone; the draw ends inside the tie."""
    scores = spark.createDataFrame(
        [(k, 30, 30, 5, 900 if k % 2 else 901) for k in range(100)] + [(500, 3, 3, 5, 5000)],
        "doc_id long, n_words long, n_features long, weight long, score long",
    )
    rows = {r.doc_id: r["rank"] for r in importance.ranked(scores, 60, 20).collect()}
    want = [*range(0, 100, 2), *range(1, 20, 2)]
    assert [k for k, v in sorted(rows.items(), key=lambda x: (x[1] is None, x[1])) if v] == want
    assert rows[500] is None


def test_empty_tables(no_documents, edge_documents, spark):
    empty_target = spark.createDataFrame([], "text string")
    assert importance.resample(no_documents, empty_target).count() == 0
    rows = [(r.doc_id, r.text) for r in edge_documents.collect()]
    got = collected(importance.resample(edge_documents, empty_target, 100, 1, 50, 2))
    assert got == plain_resample(rows, [], 100, 1, 50, 2, 2024)


def test_words_of_long_texts_keep_their_offsets(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice(["Wörd", "x", " ", "-", "Éa9", "\x7f", "\n", "😀"]) for _ in range(3000))
    lowered = text.translate(str.maketrans(UPPER, LOWER))
    want = [(m.group(), m.span()) for m in WORD.finditer(lowered)]
    for stretch in (7, 100, 20_000):
        monkeypatch.setattr(importance, "STRETCH", stretch)
        assert importance.Splitter().words(text) == want
    assert importance.Splitter().words("y" * 30_000) == [("y" * 30_000, (0, 30_000))]


# --- quality network -------------------------------------------------------------------------------


def test_contexts_match_a_double_loop(spark):
    """Summed index vectors of the words within reach, in two partitions, copies included."""
    texts = ["a b c a b", "The the THE !! | a", None, "", "solo", "a b c a b", "x\ny z_1 zz"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    got = {r.place: (r.n, [r[f"d{k}"] for k in range(quality_network.DIMS)]) for r in quality_network.context_sums(frame).collect()}
    index, want, counts = quality_network.index_vectors().astype(int), {}, Counter()
    for text in texts:
        own = [zlib.crc32(w.encode()) & (quality_network.SIZE - 1) for w in quality_network.WORD.findall(text or "")]
        for i, place in enumerate(own):
            counts[place] += 1
            near = [own[j] for j in range(max(i - 2, 0), min(i + 3, len(own))) if j != i]
            want[place] = want.get(place, 0) + sum((index[j] for j in near), np.zeros(quality_network.DIMS, int))
    assert {k: (v[0], v[1]) for k, v in got.items()} == {k: (counts[k], v.tolist()) for k, v in want.items()}


def test_steps_do_not_change_contexts_and_pools(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 50, n).astype(np.int32) for n in (300, 0, 1, 2, 40)]
    vectors = rng.normal(size=(quality_network.SIZE, quality_network.DIMS)).astype(np.float32)
    found = []
    for step in (1 << 15, 7, 1):
        monkeypatch.setattr(quality_network, "STEP", step)
        sums = np.zeros((quality_network.SIZE + 1, quality_network.DIMS), np.int64)
        counts = np.zeros(quality_network.SIZE + 1, np.int64)
        quality_network.add_contexts(texts, sums, counts)
        found.append((sums, counts, [quality_network.pooled(t, vectors) for t in texts]))
    for sums, counts, pools in found[1:]:
        assert (sums == found[0][0]).all() and (counts == found[0][1]).all()
        for a, b in zip(pools, found[0][2]):
            assert np.allclose(a, b, atol=1e-4)
    near = vectors[texts[0]].astype(float)
    plain = np.concatenate([near.mean(0), near.std(0), (near[1:] * near[:-1]).mean(0)])
    assert np.allclose(found[0][2][0], plain, atol=1e-4) and not found[0][2][1].any()


def test_words_of_long_texts(monkeypatch):
    text = "Two words | and !! THE rest\n" * 50
    places = quality_network.Places()
    whole = quality_network.words(text, places)
    monkeypatch.setattr(quality_network, "STRETCH", 11)
    monkeypatch.setattr(quality_network, "REMEMBERED", 3)
    assert (quality_network.words(text, quality_network.Places()) == whole).all() and len(whole) == 7 * 50


def test_network_learns_what_is_not_linear_and_calibrates():
    rng = np.random.default_rng(0)
    x = np.zeros((3000, quality_network.POOLED))
    x[:, :4] = rng.normal(size=(3000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(3000) < 0.1)).astype(int)
    model = quality_network.train(x[:2400], y[:2400], np.zeros((1, 1)), epochs=40, ridge=1e-2)
    scores = model.score(x[2400:])
    truth = x[2400:, 0] * x[2400:, 1] > 0
    assert ((scores > 0.5) == truth).mean() > 0.8
    sharp = np.logaddexp(0, model.margin(x[2400:])) - y[2400:] * model.margin(x[2400:])
    tempered = model.margin(x[2400:]) / model.temperature
    assert (np.logaddexp(0, tempered) - y[2400:] * tempered).mean() <= sharp.mean() + 1e-6
    margin = rng.normal(size=20_000) * 2
    labels = (rng.random(20_000) < 1 / (1 + np.exp(-margin / 3))).astype(float)
    assert quality_network.calibrate(margin, labels) == pytest.approx(3, rel=0.15)


def test_quality_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op11_quality_classifier(spark, sf_dir).collect()}
    labels = queries.table(spark, sf_dir, "labels").collect()
    held = [(rows[r.doc_id], r.quality) for r in labels if rows[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert sum(r.predicted == q for r, q in held) / len(held) > 0.9
    low = [r.predicted for r, q in held if q == 0]
    assert sum(p == 0 for p in low) / len(low) > 0.7


def test_labels_of_held_out_rows_change_nothing(spark):
    documents = queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    labels = queries.table(spark, "/root/testdata/sf0.001", "labels").where("doc_id % 3 != 0")
    first = quality_network.fit(documents, labels)
    again = quality_network.fit(documents.repartition(7).unionByName(documents.where("doc_id < 0")), labels.repartition(3))
    assert first.temperature == again.temperature and (first.vectors == again.vectors).all()
    assert all((a == b).all() for a, b in zip(first.weights, again.weights))


def test_quality_edges(spark, edge_documents, no_documents):
    label = "doc_id long, quality int"
    none = quality_network.fit(edge_documents, spark.createDataFrame([], label))
    assert {r.score < 1e-6 for r in quality_network.score(edge_documents.drop("score"), none).collect()} == {True}
    one = quality_network.fit(edge_documents, spark.createDataFrame([(3, 1), (4, 1), (None, 0), (5, None)], label))
    assert {round(r.score, 6) for r in quality_network.score(edge_documents.drop("score"), one).collect()} == {0.8}  # id 4 has two texts
    both = quality_network.fit(edge_documents, spark.createDataFrame([(3, 1), (5, 0), (7, 0), (6, 1), (6, 0), (1, 1)], label))
    rows = quality_network.score(edge_documents.drop("score"), both).collect()
    assert len(rows) == edge_documents.count() and all(0 <= r.score <= 1 for r in rows)
    with pytest.raises(ValueError):
        quality_network.score(edge_documents, both)
    empty = quality_network.fit(no_documents, spark.createDataFrame([], label))
    assert quality_network.score(no_documents, empty).count() == 0
