"""Tokenizing by pieces, packing, binary ids and length histograms against the tokenizer itself."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clicktide.llm import binary_ids, packing, queries, token_counts, tokens

OWN = tokens.encoder(queries.BYTE_BPE)


def ids_of(text):
    return OWN.tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def split(texts):
    ids, sizes = OWN.texts(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


ODD = [None, "", "a", " ", "\n", "a  b", "a \n b\n\n", "\n\nfoo  ", "it's  x\tok", " a", "a ", "x,. y?!", " 's", "foo 's",
       "\n's", "a\r\nb c", "\x85 b", "x 　y", "<|endoftext|> x", "a\x00b c", "12.5 €", "été, été.", "你好 世界", "a" * 5000, "_a b_ c__"]


def test_pieces_give_the_ids_of_whole_texts():
    assert split(ODD) == [ids_of(t) for t in ODD]
    assert split([]) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t.,'!ab1é_  <|>😀-", max_size=30), min_size=1, max_size=6))
def test_pieces_of_any_text(texts):
    assert split(texts) == [ids_of(t) for t in texts]


def test_given_texts(documents):
    texts = [r.text for r in documents.values()]
    assert split(texts) == [ids_of(t) for t in texts]


def lay_out_is_exact(demand, capacity, first):
    layout = packing.lay_out(demand, capacity, first)
    filled = {}
    for length in np.flatnonzero(demand).tolist():
        for rank in range(int(demand[length])):
            pieces = layout.place(length, rank)
            assert sum(p[2] for p in pieces) == length
            for sequence, offset, size in pieces:
                filled.setdefault(sequence, []).append((offset, size))
    for pieces in filled.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
    assert sorted(filled) == list(range(first, first + len(filled)))
    return layout


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=200), st.integers(0, 5))
def test_layouts_fill_sequences(lengths, first):
    lay_out_is_exact(np.bincount(lengths, minlength=64).astype(np.int64) if lengths else np.zeros(64, np.int64), 64, first)


def test_a_hot_length():
    demand = np.bincount(np.random.default_rng(2).integers(1, 256, 300), minlength=256)
    demand[130] += 1000
    lay_out_is_exact(demand, 256, 0)


def test_column_generation_finds_the_optimum():
    """Every stock that holds a 45 wastes 5 or 10; no plan needs fewer than 270 stocks."""
    demand = np.zeros(100, np.int64)
    demand[[20, 30, 45]] = [400, 300, 200]
    plan = packing.column_generation(demand, 100)
    cut = sum(p * amount for p, amount in plan)
    assert np.allclose(cut, demand)
    assert sum(amount for _, amount in plan) == pytest.approx(270, rel=2e-3)


def test_knapsack():
    prices = np.zeros(11)
    prices[[3, 5, 7]] = [3.1, 5.0, 7.5]
    worth, copies = packing.best_pattern(prices, 10)
    assert worth == pytest.approx(7.5 + 3.1) and copies[[3, 5, 7]].tolist() == [1, 0, 1]


def packed_right(rows, texts, capacity):
    """`rows` of pieces against (doc_id, text) pairs: each id once, sequences gapless, little padding."""
    want = sorted(((d, tuple(ids_of(t) + [0])) for d, t in texts), key=repr)
    got, sequences = [], {}
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in want)
    if len({(d, len(i)) for d, i in want}) == len(want):
        for (doc, _), pieces in by_doc.items():
            ids = b"".join(bytes(p.ids) for p in sorted(pieces, key=lambda p: p.start))
            got.append((doc, tuple(np.frombuffer(ids, "<u4").tolist())))
        assert sorted(got, key=repr) == want


def test_packing_given_documents(spark, sf_dir, documents):
    rows = packing.pack(queries.table(spark, sf_dir, "documents"), queries.BYTE_BPE, 1024, 0).collect()
    packed_right(rows, [(i, r.text) for i, r in documents.items()], 1024)
    digests = {(r.doc_id, r.start): r for r in queries.op1_packing(spark, sf_dir).collect()}
    assert len(digests) == len(rows)
    for key, r in digests.items():
        whole = ids_of(documents[key[0]].text) + [0]
        assert r.doc_tokens == len(whole) and r.ids_crc32 == crc(whole[r.start : r.start + r.length])


def test_packing_edges(edge_documents, no_documents):
    rows = packing.pack(edge_documents, queries.BYTE_BPE, 128, 0).collect()
    packed_right(rows, [(r.doc_id, r.text) for r in edge_documents.collect()], 128)
    assert packing.pack(no_documents, queries.BYTE_BPE).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=700))
def test_elias_fano(values):
    values = sorted(values)
    made = binary_ids.EliasFano.of(np.array(values, np.uint64))
    again = binary_ids.EliasFano.from_bytes(memoryview(made.to_bytes()))
    assert again.all().tolist() == values
    for k in range(0, len(values), 37):
        assert again.select(k) == values[k]
    with pytest.raises(IndexError):
        again.select(len(values))


def test_elias_fano_space():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10000))
    assert 8 * len(binary_ids.EliasFano.of(ends).to_bytes()) < 14 * len(ends)


def test_ids_query(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op6_token_ids(spark, sf_dir).collect()}
    at = 0
    for doc in sorted(documents):
        ids = ids_of(documents[doc].text) + [2]
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def test_shards_hold_edges_in_order(spark, edge_documents, no_documents, tmp_path):
    folder = str(tmp_path / "shards")
    manifest = binary_ids.write_shards(edge_documents, queries.BYTE_BPE, folder, shard_ids=500)
    rows = sorted(binary_ids.read_shards(spark, folder, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in edge_documents.collect()), key=lambda d: (d is not None, d))
    want = sorted(((r.doc_id, ids_of(r.text) + [2]) for r in edge_documents.collect()), key=repr)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows), key=repr) == want
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    files = sorted((tmp_path / "shards").glob("ids-*.efids"))
    assert len(files) > 1 and not list((tmp_path / "shards").glob("_*"))
    shard = binary_ids.Shard(files[0].read_bytes())
    assert [len(shard.ids(k)) for k in range(len(shard))] == np.diff(shard.bounds.all().astype(int), prepend=0).tolist()
    with pytest.raises(ValueError):
        binary_ids.Shard(b"something else")
    assert binary_ids.ids_query(spark, no_documents, queries.BYTE_BPE).count() == 0


def test_length_histogram(spark, sf_dir, documents, edge_documents, no_documents):
    lengths = np.array([len(ids_of(r.text)) for r in documents.values()])
    rows = queries.op7_token_counts(spark, sf_dir).collect()
    assert sorted(r.length for r in rows) == sorted(set(lengths.tolist()))
    for r in rows:
        assert r.n_docs == (lengths == r.length).sum() and r.n_tokens == r.length * r.n_docs
        assert r.docs_ge == (lengths >= r.length).sum() and r.tokens_ge == lengths[lengths >= r.length].sum()
        assert r.truncated_total == np.minimum(lengths, r.length).sum()
        assert r.share_le == pytest.approx((lengths <= r.length).mean())
    table = token_counts.limit_table(token_counts.length_histogram(queries.table(spark, sf_dir, "documents"), queries.BYTE_BPE))
    limits = [1, 100, 777, 10**6]
    totals = {r.context_limit: r.truncated_total for r in token_counts.truncated_totals(table, limits).collect()}
    assert totals == {x: int(np.minimum(lengths, x).sum()) for x in limits}
    found = {r.share: r.length for r in token_counts.quantiles(table, [0.5, 1.0]).collect()}
    assert found == {0.5: sorted(lengths)[-(-len(lengths) // 2) - 1], 1.0: max(lengths)}
    edges = {r.length: r.n_docs for r in token_counts.length_histogram(edge_documents, queries.BYTE_BPE, extra_ids=1).collect()}
    assert sum(edges.values()) == edge_documents.count() and edges[1] == 2
    empty = token_counts.limit_table(token_counts.length_histogram(no_documents, queries.BYTE_BPE))
    assert empty.count() == 0
    assert [r.truncated_total for r in token_counts.truncated_totals(empty, [5]).collect()] == [0]
