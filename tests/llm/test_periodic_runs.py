"""Periodic runs against a search of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from invdex.llm import periodic_runs as P

SF = "/root/testdata/sf0.001"


def brute(w):
    """(start, length, period) of every run, by start, then period."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            piece = w[i:j + q]
            smaller = any(all(piece[x] == piece[x + p] for x in range(length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = planted(doc_id, (text or "").encode().split())
    runs = brute(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in drop)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_runs(parts):
    w = [x for piece, times in parts for x in piece * times][:160]
    got = P.find_runs(np.array(w, np.int64), len(w))
    assert [tuple(r) for r in got.tolist()] == brute(w)


def test_long_periods():
    rng = random.Random(5)
    for _ in range(60):
        base = [rng.randrange(50) for _ in range(rng.randrange(1, 40))]
        w = [rng.randrange(50) for _ in range(rng.randrange(20))] + (base * 9)[:rng.randrange(3, 7) * len(base) + rng.randrange(3)] + [7, 8]
        assert [tuple(r) for r in P.find_runs(np.array(w), len(w)).tolist()] == brute(w)


def test_nothing_matches_across_documents():
    docs = [[b"a"] * 3, [b"a"] * 3, [b"b", b"c"] * 4, [], [b"b", b"c"] * 2, [b"a"] * 6]
    runs, text = P._slice(docs)
    assert [[(r["start"], r["length"], r["period"]) for r in x] for x in runs] == [[], [], [(0, 8, 2)], [], [], [(0, 6, 1)]]
    assert text == [b"a a a", b"a a a", b"b c", b"", b"b c b c", b"a"]


@pytest.fixture(scope="module")
def query(spark):
    return {r.doc_id: tuple(r) for r in E.queries()["op13_periodic_runs"](spark, SF).collect()}


def test_query(spark, query):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(query)
    short = [r for r in docs if len(r.text.split()) < 500]
    assert len(short) > 150 and sum(query[r.doc_id][1] > 0 for r in short) > 5
    for r in short:
        assert query[r.doc_id] == expected(r.doc_id, r.text)


def test_edges(spark, edge, nothing):
    got = {}
    for r in P.runs(edge, slice_words=100).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[6]) == 2 and got[6][0] == got[6][1]
    assert got[1][0]["n_words"] == 0 and got[1][0].runs == [] and got[1][0].collapsed == ""
    assert got[3][0].collapsed == "" and got[4][0].collapsed == "one"
    assert got[9][0]["n_words"] == 60_000 and got[9][0].source == "d"
    out = P.runs(nothing)
    assert out.collect() == [] and out.columns[-3:] == ["n_words", "runs", "collapsed"]


def test_null_ids_and_repeats(spark):
    rows = [(None, "x y " * 5), (None, None), (3, "go go go go go go stop " + "a b c " * 7), (3, "go go go go go go stop " + "a b c " * 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = sorted([(r.doc_id or 0, r.collapsed, [tuple(x) for x in r.runs]) for r in P.runs(df, rewrite=P.planted).collect()])
    w = planted(3, rows[2][1].encode().split())
    assert out[0] == (0, "", []) and out[1] == (0, "x y", [(0, 10, 2)])
    assert out[2] == out[3] and out[2][2] == brute(w)
