"""Ranked search against a plain evaluation of the formula, and against its SQL."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from invdex.llm import ranked_search as R

SF = "/root/testdata/sf0.001"


def terms(t):
    t = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t)


def brute(docs, items, k):
    docs = [(i, terms(t)) for i, t in docs]
    n, total = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    out = []
    for item, text in dict.fromkeys(items):
        want, scored = set(terms(text)), []
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in w for _, w in docs) + 1))) for t in want}
        for i, w in docs:
            if w:
                m = 50 + 50 * len(w) * n // total
                s = sum(weight[t] * (10**9 * w.count(t) // (1000 * w.count(t) + 20 * m)) for t in want if t in w)
                if s > 0:
                    scored.append((-s, i is None, i or 0, i, s))
        out += [(item, r + 1, x[3], x[4]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def rows(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=repr)


ITEMS = [(1, "Word1 word2 WORD399 w0x0 straße"), (2, None), (3, ""), (4, "zzz absent"), (5, "one two words id here"), (5, "東京 émile b c"),
         (None, "no id here"), (7, "w1x1 w2x2 word7"), (7, "w1x1 w2x2 word7")]


@pytest.mark.parametrize("k,share,block", [(50, 1 / 8, 4 << 20), (2, 1 / 8, 1 << 10), (1, 0.0, 1 << 10), (3, 1.0, 1 << 10)])
def test_brute_force(spark, edge, monkeypatch, k, share, block):
    monkeypatch.setattr(R, "SHORT_SHARE", share)
    monkeypatch.setattr(R, "BLOCK_BYTES", block)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert rows(R.search(edge, items, k=k)) == brute(docs, ITEMS, k)


def test_parts(spark, edge):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert rows(R.search(edge, items, k=5, part_bytes=64)) == rows(R.search(edge, items, k=5))


def test_many_ties_and_a_hot_term(spark):
    docs = [(i, "hot" if i % 3 else "hot rare" if i % 2 else "Hot cold") for i in range(400)] + [(i, None) for i in range(400, 420)]
    items = [(1, "hot"), (2, "hot rare"), (3, "cold rare hot")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    assert rows(R.search(df, spark.createDataFrame(items, "item_id bigint, text string"))) == brute(docs, items, 50)


def test_empty(spark, edge, nothing):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert R.search(nothing, items).collect() == []
    assert R.search(edge, items.limit(0)).collect() == []
    assert R.search(edge, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_hash_collisions_are_told_apart(monkeypatch):
    import numpy as np

    monkeypatch.setattr(R.W, "word_hashes", lambda buf, s, e, fold, **k: (e - s).astype(np.uint64))
    v = R._Vocabulary([b"aa", b"bb", b"ccc"])
    buf = np.frombuffer(b"BB aa dd ccc c", np.uint8)
    s, e = np.array([0, 3, 6, 9, 13]), np.array([2, 5, 8, 12, 14])
    assert v.find(buf, s, e).tolist() == [1, 0, -1, 2, -1]


def test_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()["op11_ranked_search"](spark, SF)
    res = con.execute(E.oracle_sql()["op11_ranked_search"])
    names = [d[0] for d in res.description]
    assert names == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(res.fetchall())
