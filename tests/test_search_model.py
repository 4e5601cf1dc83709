"""Random AND queries over the sf0.001 documents against a direct Python
model: set intersection of the documents holding each term, names sorted
bytewise, the sentinel for no hit, blank queries skipped."""

import random

import pyarrow.parquet as pq

from corpus_helpers import SF
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.sources.corpus import documents_corpus

SF1 = f"{SF}/sf0.001"


def test_random_queries_match_model(spark):
    t = pq.read_table(f"{SF1}/documents.parquet", columns=["doc_id", "source", "text"]).to_pylist()
    docs = {f"{r['source']}/{r['doc_id']}": set(r["text"].encode().split()) for r in t}
    vocab = sorted({w for s in docs.values() for w in s})
    rnd = random.Random(5)
    queries = []
    for qid in range(60):
        k = rnd.randint(1, 3)
        terms = [rnd.choice(vocab) for _ in range(k)]
        if qid % 10 == 0:
            terms.append(b"zzz-not-a-token")
        if rnd.random() < 0.5:   # common words so that many queries have hits
            terms = [rnd.choice([b"the", b"of", b"and", b"de", b"la", b"und"])] + terms[:1]
        queries.append((qid, b" ".join(terms).decode()))
    queries.append((99, "   "))
    ix = X.build_index(documents_corpus(spark, SF1))
    q = spark.createDataFrame(queries, "query_id bigint, query_text string")
    got = {}
    for r in S.search(ix.postings, ix.word_dict, ix.doc_dict, q).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.doc_name))
    for qid, text in queries:
        terms = set(text.encode().split())
        if not terms:
            assert qid not in got
            continue
        hits = sorted((n for n, s in docs.items() if terms <= s), key=lambda n: n.encode())
        expect = hits or ["no results found"]
        assert [n for _, n in sorted(got[qid])] == expect, text
        assert [rk for rk, _ in sorted(got[qid])] == list(range(1, len(expect) + 1))
