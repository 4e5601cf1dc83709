"""Merging coded lists without decoding, and evaluating equal queries once."""

import random

import numpy as np
import pytest

from invdex.functions import codecs as K
from invdex.functions.text import NO_RESULTS
from invdex.operators import compress as C
from invdex.operators import index as X
from invdex.operators import search as S


def coded(df):
    return sorted((r.term_id, r.seg, r.base, r.n, r.first, r.last, bytes(r.vb), bytes(r.gamma), r.gamma_pad) for r in df.collect())


def test_merged_blocks_have_the_bytes_of_one_build(spark):
    rnd, rows, cuts = random.Random(11), [], [0, 3, 64, 65, 300, 301, 2000, 9000]
    for t in range(6):
        rows += [(t, d) for d in sorted(rnd.sample(range(1, 9001), rnd.choice([1, 5, 700])))]
    rows += [(9, d) for d in range(1, 200)] + [(10, 2**40), (10, 2**40 + 5), (10, 3)]
    schema = "term_id bigint, did bigint"
    whole = coded(C.encode(C.segments(spark.createDataFrame(rows, schema), fanout=3)))
    parts = [C.encode(C.segments(spark.createDataFrame([r for r in rows if a < r[1] <= b], schema), fanout=3))
             for a, b in zip(cuts, [*cuts[1:-1], 2**50])]
    assert coded(C.merge_compressed(*parts, fanout=3)) == whole
    # merged parts can be merged again
    again = C.merge_compressed(C.merge_compressed(*parts[:3], fanout=3), C.merge_compressed(*parts[3:], fanout=3), fanout=3)
    assert coded(again) == whole
    assert coded(C.merge_compressed(parts[0].limit(0))) == []


def test_blocks_are_indexes_of_their_own(spark):
    rows = [("a", f"{i:03d}", f"x w{i % 5}") for i in range(100)] + [("b", f"{i:03d}", f"x w{i % 3}") for i in range(90)]
    ix = X.build_index(spark.createDataFrame(rows, "block string, file string, text string"))
    parts = C.block_segments(ix.postings, ix.doc_dict)
    assert parts.where("base = 0").count() == 5 + 3 + 2
    assert sorted(map(tuple, C.decode_vb(parts).collect())) == sorted(map(tuple, ix.postings.collect()))
    assert coded(C.merge_compressed(parts)) == coded(C.encode(C.segments(ix.postings)))


def test_decoders_by_batch():
    rng = np.random.default_rng(8)
    gaps = rng.integers(1, 1 << 40, 300)
    counts = np.array([0, 1, 64, 0, 200, 35])
    for enc, dec in ((lambda: (b"".join(K.vb_encode_batch(gaps, counts)), [len(x) for x in K.vb_encode_batch(gaps, counts)], None), K._vb_decode_batch),):
        data, lens, _ = enc()
        got, n = dec(np.frombuffer(data, np.uint8), np.array(lens))
        assert got.tolist() == gaps.tolist() and n.tolist() == counts.tolist()
    lists, pad = K.gamma_encode_batch(gaps, counts)
    got, n = K._gamma_decode_batch(np.frombuffer(b"".join(lists), np.uint8), np.array([len(x) for x in lists]), pad)
    assert got.tolist() == gaps.tolist() and n.tolist() == counts.tolist()


@pytest.mark.parametrize("small", [True, False])
def test_equal_queries_are_answered_once(spark, monkeypatch, small):
    texts = ["the a", "the b", "a b", "the a b c"] * 3
    rows = [("d", f"{i:02d}", t) for i, t in enumerate(texts)]
    ix = X.build_index(spark.createDataFrame(rows, "block string, file string, text string"))
    if not small:
        monkeypatch.setattr(S, "is_small", lambda df: False)
    queries = [(i, "a the the" if i % 2 else " the  a") for i in range(1000)] + [(1000, "c"), (1001, "none c"), (1002, "c none c"), (1003, "")]
    q = spark.createDataFrame(queries, "query_id bigint, query_text string")
    classes = {r.query_id: r.class_id for r in S.query_classes(S.parse_queries(q)).collect()}
    assert {classes[i] for i in range(1000)} == {0} and classes[1000] == 1000 and classes[1002] == 1001 and 1003 not in classes
    seen, old = [], S.conjunctive_hits
    monkeypatch.setattr(S, "conjunctive_hits", lambda post, lookup, **k: seen.append(lookup.count()) or old(post, lookup, **k))
    got = {}
    for r in S.search(ix.postings, ix.word_dict, ix.doc_dict, q).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_name))
    assert seen == [2 + 1 + 2]  # terms of three classes
    for i, t in queries[:-1]:
        names = [f"d/{k:02d}" for k, x in enumerate(texts) if set(t.split()) <= set(x.split())] or [NO_RESULTS]
        assert sorted(got[i]) == [(k + 1, n) for k, n in enumerate(names)]
    assert 1003 not in got
