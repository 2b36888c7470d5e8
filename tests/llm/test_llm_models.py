"""SimHash, toxicity, language and the pipeline against brute force and held-out accuracy."""

import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from clicktide.llm import common, decontaminate, language, packing, quality_rules, queries, simhash, toxicity


def brute_fingerprint(text, size=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(numbers, bits):
    """The smallest position that each position reaches through links of at most `bits`."""
    numbers = np.array(numbers, np.uint64)
    root = list(range(len(numbers)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k in range(len(numbers)):
        for j in np.flatnonzero(np.bitwise_count(numbers[k + 1 :] ^ numbers[k]) <= bits).tolist():
            a, b = find(k), find(k + 1 + j)
            root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(numbers))]


def test_simhash_of_given_documents(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in queries.op8_simhash(spark, sf_dir).collect()}
    ids = sorted(documents)
    prints = [brute_fingerprint(documents[i].text) for i in ids]
    assert [rows[i].fingerprint for i in ids] == [f"{p:016x}" for p in prints]
    assert [rows[i].component_id for i in ids] == [ids[k] for k in brute_components(prints, 2)]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_among_a_crowd(spark, bits):
    """Hundreds of fingerprints under a key (the path through common neighbours) and chains of links."""
    rng = np.random.default_rng(bits)
    crowd = {int(rng.integers(0, 1 << 62))}
    while len(crowd) < 350:
        x = list(crowd)[rng.integers(len(crowd))]
        for b in rng.integers(0, 64, rng.integers(1, 4)):
            x ^= 1 << int(b)
        crowd.add(x)
    numbers = sorted(crowd | {int(x) for x in rng.integers(0, 1 << 62, 200)}, key=signed)
    frame = spark.createDataFrame([(signed(x),) for x in numbers], "fp long")
    got = {r.fp: r.root for r in simhash.roots(frame, bits).collect()}
    want = brute_components(numbers, bits)
    assert [got.get(signed(x), signed(x)) for x in numbers] == [signed(numbers[k]) for k in want]


def test_long_chains_connect(spark):
    pairs = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (103, 101)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 103: 100}


def test_pivots_bound_the_distance(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(-(1 << 62), 1 << 62, 300)
    pairs = [(int(a), int(a) ^ (1 << int(b)) ^ (1 << int(c))) for a, b, c in zip(x, rng.integers(0, 62, 300), rng.integers(0, 62, 300))]
    frame = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a long, b long")
    one = frame.select("k", *simhash.pivot_table(F.col("a"))).alias("x")
    two = frame.select("k", *simhash.pivot_table(F.col("b"))).alias("y")
    assert one.join(two, "k").where(simhash.close_to_pivots("x", "y", 2)).count() == 300
    far = one.join(two.withColumn("k", F.col("k") + 1), "k").where(simhash.close_to_pivots("x", "y", 2)).count()
    assert far < 10


def test_simhash_edges(spark, edge_documents, no_documents):
    rows = simhash.near_duplicates(edge_documents).collect()
    assert len(rows) == edge_documents.count()
    wordless = {r.doc_id: r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert wordless == {0: 0, 1: 0, 2: 0}
    assert {r.component_id for r in rows if r.doc_id == 5} == {4}
    kept = simhash.keep_one(edge_documents)
    assert kept.columns == edge_documents.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 0), (False, 3), (False, 4), (False, 4), (False, 6), (False, 7), (False, 8), (False, 9), (True, 0)
    ]
    assert simhash.near_duplicates(no_documents).count() == 0 and simhash.keep_one(no_documents).count() == 0


def held(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_pairs_that_no_sum_can_tell():
    """An insult and a group alone are harmless, together they are not."""
    rng = np.random.default_rng(1)
    filler = [f"w{k}" for k in range(60)]
    rows, labels = [], []
    for _ in range(1500):
        words, insult, group = list(rng.choice(filler, 8)), rng.random() < 0.4, rng.random() < 0.4
        rows.append(toxicity.terms(" ".join(words + ["vile"] * insult + ["folk"] * group)))
        labels.append(int(insult and group))
    model = toxicity.train(rows[:1200], labels[:1200])
    found = model.score(rows[1200:]) >= 0.5
    assert (found == np.array(labels[1200:])).mean() > 0.97
    v, w = toxicity.terms("vile")[0], toxicity.terms("folk")[0]
    assert float(model.factors[v] @ model.factors[w]) > 0.5


def test_a_group_that_is_neutral_by_itself():
    """Beside the insult the group turns the label, without it the other way, so alone it says next to nothing."""
    rng = np.random.default_rng(3)
    filler = [f"w{k}" for k in range(60)]
    rows, labels = [], []
    for _ in range(4000):
        words, insult, group = list(rng.choice(filler, 8)), rng.random() < 0.5, rng.random() < 0.4
        rows.append(toxicity.terms(" ".join(words + ["vile"] * insult + ["folk"] * group)))
        labels.append(int(rng.random() < ((0.95 if group else 0.5) if insult else (0.02 if group else 0.45))))
    y, folk = np.array(labels, float), toxicity.terms("folk")[0]
    assert not toxicity.informative(rows, y, 20.0)[folk]
    model = toxicity.train(rows, labels)
    assert float(model.factors[toxicity.terms("vile")[0]] @ model.factors[folk]) > 0.5
    said = model.score([toxicity.terms("vile folk"), toxicity.terms("vile"), toxicity.terms("folk")])
    assert said[0] > 0.8 and said[0] > said[1] + 0.2 and said[2] < 0.2


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in queries.table(spark, folder, "labels").collect()}
    rows = queries.op9_toxicity(spark, folder).collect()
    assert all(r.held_out == (held(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    caught = sum(p and y for p, y in test)
    assert caught >= 0.8 * sum(y for _, y in test) and sum(p and not y for p, y in test) <= 0.01 * len(test)


def test_toxicity_edges(spark, edge_documents, no_documents):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(edge_documents, none)
    scored = toxicity.score(edge_documents, model)
    assert scored.count() == edge_documents.count() and scored.where("score > 0.01").count() == 0
    assert set(scored.columns) == set(edge_documents.columns)
    assert toxicity.score(no_documents, model).count() == 0


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in queries.table(spark, folder, "documents").select("doc_id", "lang").collect()}
    rows = queries.op10_language(spark, folder).collect()
    assert len(rows) == len(truth) and all(r.held_out == (held(r.doc_id, 4) == 2) for r in rows)
    test = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert np.mean(test) > 0.98


def brute_ranks(text, size):
    padded = re.sub(" +", " ", " " + "".join(c.lower() if c.isalpha() else " " for c in text) + " ")
    counts = {}
    for n in (1, 2, 3):
        for k in range(len(padded) - n + 1):
            gram = padded[k : k + n]
            if gram != " ":
                code = sum(ord(c) << 21 * (2 - j) for j, c in enumerate(gram))
                counts[code] = counts.get(code, 0) + 1
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))][:size]


def test_out_of_place_distance(spark):
    texts = {"en": "the cat and the dog and the bird", "xx": "kra kro kru kra kra zz"}
    frame = spark.createDataFrame([(t, k) for k, t in texts.items()] + [("ignored", None)], "text string, lang string")
    profiles = language.learn(frame, size=20)
    assert profiles == {k: brute_ranks(t, 20) for k, t in texts.items()}
    ask = ["the kra and", "Zz!", "é", "4 5", None, "", "the the the"]
    got = language.Profiles(profiles, 20).texts(ask)
    for text, name, score in zip(ask, *got):
        own = brute_ranks(text or "", 20)
        if not own:
            assert (name, score) == ("und", 0.0)
            continue
        far = {k: sum(abs(r - p.index(g)) if g in p else 20 for r, g in enumerate(own)) for k, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert name == best and score == pytest.approx(1 - far[best] / (20 * len(own)))


def test_language_edges(edge_documents, no_documents):
    rows = language.identify(edge_documents, {}).collect()
    assert {r.lang_pred for r in rows} == {"und"} and {r.score for r in rows} == {0.0}
    assert language.identify(no_documents, {"en": [1, 2]}).count() == 0 and language.learn(no_documents) == {}


def test_pipeline_stages(spark, sf_dir, documents):
    """Each stage against a plain version over what its predecessor kept."""
    docs = common.table(spark, sf_dir, "documents")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash", "decontamination", "pii", "packing"]
    verdict = {r.doc_id: r.kept for r in queries.op3_quality_rules(spark, sf_dir).collect()}
    items = [(r.item_id, decontaminate.words_of(r.text)) for r in common.table(spark, sf_dir, "benchmark").collect()]
    windows = {tuple(w[k : k + 10]) for _, w in items for k in range(max(1, len(w) - 9))}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = common.store(stage(spark, docs, sf_dir))
        if name == "packing":
            break
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "quality_rules":
            assert set(after) == {k for k, kept in verdict.items() if kept}
        elif name == "simhash":
            ids = sorted(before)
            roots = brute_components([brute_fingerprint(before[i].text) for i in ids], 2)
            assert set(after) == {ids[k] for k in roots}
        elif name == "decontamination":
            for k, r in after.items():
                words = decontaminate.words_of(before[k].text)
                dirty = any(tuple(words[j : j + 10]) in windows for j in range(len(words)))
                assert (r.text != before[k].text) == dirty
        elif name == "pii":
            assert set(after) == set(before)
            assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text) for r in after.values())
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == set(before)
    filled = {}
    for r in pieces:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert all(n == 1024 or n & (n - 1) == 0 for n in filled.values())


def test_every_operator_is_registered():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14))
    assert quality_rules.RULES and packing.BROADCAST_BYTES
