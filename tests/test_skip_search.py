"""Search over compressed lists by skipping segments, against plain sets."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from invdex.functions.text import NO_RESULTS
from invdex.operators import compress as C
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.session import scratch_path
from invdex.sources import index_store as IO


@pytest.fixture(scope="module")
def made(spark):
    """600 documents: 'the' everywhere, a rare word in two segments, others at random."""
    rng = np.random.default_rng(4)
    texts = ["the " + " ".join(f"w{k}" for k in rng.integers(0, 25, 4)) + (" rare" if i in (5, 70, 71) else "")
             + (" low" if i % 64 < 8 else "") + (" high" if i % 64 > 40 else "") for i in range(600)]
    rows = [("b", f"{i:04d}", t) for i, t in enumerate(texts)]
    ix = X.build_index(spark.createDataFrame(rows, "block string, file string, text string"))
    root = scratch_path(spark, "skips")
    IO.write_index(ix, root, compressed=C.encode(C.segments(ix.postings)))
    return texts, root


QUERIES = [(1, "the"), (2, "rare the"), (3, "the w1 w2"), (4, "w3"), (5, "low high"), (6, "rare absent"), (7, "  "), (8, "rare w5 w6 low")] + [
    (100 + i, f"the w{i % 25} w{i * 7 % 25}") for i in range(30)]


def plain(texts):
    out = []
    for qid, q in QUERIES:
        want = set(q.split())
        if want:
            names = [f"b/{i:04d}" for i, t in enumerate(texts) if want <= set(t.split())]
            out += [(qid, r + 1, n) for r, n in enumerate(names)] or [(qid, 1, NO_RESULTS)]
    return sorted(out)


def asked(spark, root):
    st = IO.read_index(spark, root)
    q = spark.createDataFrame(QUERIES, "query_id bigint, query_text string")
    return st, q, S.term_lookup(S.parse_queries(q), st.word_dict)


@pytest.mark.parametrize("form,seek,small", [("vb", True, True), ("gamma", False, True), ("vb", False, False)])
def test_results(spark, made, monkeypatch, form, seek, small):
    texts, root = made
    if not small:
        monkeypatch.setattr(S, "is_small", lambda df: False)
    st, q, _ = asked(spark, root)
    got = S.search(IO.read_compressed(spark, root), st.word_dict, st.doc_dict, q, seek=seek,
                   decode=lambda e: C.decode_lists(e, form), skips=IO.read_skips(spark, root))
    assert sorted(map(tuple, got.collect())) == plain(texts)


def segments_of(texts):
    segs = {}
    for i, t in enumerate(texts):
        for w in t.split():
            segs.setdefault(w, {}).setdefault(i // 64, []).append(i)
    return segs


def needed(texts):
    """Per query, the (term, segment) pairs that have to be decoded."""
    segs, out = segments_of(texts), {}
    for qid, q in QUERIES:
        terms = set(q.split())
        if not terms:
            continue
        out[qid] = set()
        if all(t in segs for t in terms):
            for s in set.intersection(*[set(segs[t]) for t in terms]):
                if max(min(segs[t][s]) for t in terms) <= min(max(segs[t][s]) for t in terms):
                    out[qid] |= {(t, s) for t in terms}
    return out


@pytest.mark.parametrize("small", [True, False])
def test_report(spark, made, monkeypatch, small):
    texts, root = made
    if not small:
        monkeypatch.setattr(S, "is_small", lambda df: False)
    _, _, lookup = asked(spark, root)
    segs = segments_of(texts)
    want = sorted((qid, sum(len(segs.get(t, ())) for t in set(dict(QUERIES)[qid].split())), len(x)) for qid, x in needed(texts).items())
    assert sorted(map(tuple, S.skip_report(IO.read_skips(spark, root), lookup).collect())) == want
    assert dict((r[0], r[2]) for r in want)[5] == 0  # low and high share segments, never their ranges


def test_only_needed_lists_are_decoded_once(spark, made):
    texts, root = made
    _, _, lookup = asked(spark, root)
    some = [2, 5, 6, 8]  # a query of a stop word alone needs all of its segments
    lookup, seen = lookup.where(F.col("query_id").isin(some)), []

    def decode(enc):
        seen.append(enc.select("term_id", "seg").collect())
        return C.decode_lists(enc, "vb")

    S.skip_hits(IO.read_compressed(spark, root), IO.read_skips(spark, root), lookup, decode).collect()
    assert len(seen) == 1
    want = set().union(*[needed(texts)[q] for q in some])
    assert len(seen[0]) == len(want) <= 10
    assert sum(len(segments_of(texts)[t]) for t in ("the", "rare", "low", "high", "w5", "w6")) > 40


def test_no_unsalted_join_on_a_term(spark, made, monkeypatch):
    _, root = made
    monkeypatch.setattr(S, "is_small", lambda df: False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        st, _, lookup = asked(spark, root)
        skips = IO.read_skips(spark, root)
        for df in (S.conjunctive_hits(st.postings, lookup), S.segment_plan(skips, lookup), S.intersect_lists(X.segment_lists(st.postings), lookup)):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            joins = [line for line in plan.splitlines() if "Join" in line and "rightHint=(strategy=broadcast)" not in line]
            assert joins
            for line in joins:
                if re.search(r"term_id#\d+L = term_id#", line):
                    assert "_sj_salt" in line or "did" in line or "seg" in line, line
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_skip_table(spark, made):
    texts, root = made
    st = IO.read_index(spark, root)
    term = {r.token: r.term_id for r in st.word_dict.collect()}
    want = sorted((term[w], s, min(x) + 1, max(x) + 1, len(set(x))) for w, segs in segments_of(texts).items() for s, x in segs.items())
    assert sorted(map(tuple, IO.read_skips(spark, root).collect())) == want
    enc = IO.read_compressed(spark, root)
    lists = C.decode_lists(enc, "gamma").select("term_id", "seg", F.explode("dids").alias("did")).where("seg = (did - 1) div 64")
    assert sorted((r.term_id, r.did) for r in lists.collect()) == sorted(map(tuple, st.postings.collect()))
