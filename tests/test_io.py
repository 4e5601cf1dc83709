"""Storage round trips: stored index search with pushdown, plain text
import, query files with line ids, text results, IN-list escaping."""

import os


from corpus_helpers import SF
from invdex.operators import compress as C
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.session import scratch_path
from invdex.sources import index_store as IO
from invdex.sources.corpus import documents_corpus

SF1 = f"{SF}/sf0.001"


def test_stored_index_round_trip(spark):
    ix = X.build_index(documents_corpus(spark, SF1))
    root = scratch_path(spark, "t-store")
    IO.write_index(ix, root, compressed=C.encode(C.segments(ix.postings)), plain=True)
    st = IO.read_index(spark, root)
    q = spark.createDataFrame([(1, "of the in"), (2, "the zzz"), (3, "and")], "query_id bigint, query_text string")
    a = S.search(st.postings, st.word_dict, st.doc_dict, q, seek=True)
    b = S.search(ix.postings, ix.word_dict, ix.doc_dict, q)
    assert sorted(a.collect()) == sorted(b.collect())
    lk = S.term_lookup(S.parse_queries(q), st.word_dict, seek=True)
    plan = S._batch_postings(st.postings, lk, True, True)._jdf.queryExecution().executedPlan().toString()
    assert "In(term_id" in plan or "term_id IN" in plan
    post = sorted(ix.postings.collect())
    assert sorted(IO.read_plain(spark, f"{root}/plain").collect()) == post
    assert sorted(C.decode_vb(IO.read_compressed(spark, root)).collect()) == post


def test_query_file_lines(spark, tmp_path):
    d = tmp_path / "q"
    d.mkdir()
    (d / "a.txt").write_text("first query\n\nthird one\n")
    (d / "b.txt").write_text("fourth")
    rows = sorted(IO.read_query_lines(spark, str(d)).collect())
    assert [(r.query_id, r.query_text) for r in rows] == [(1, "first query"), (2, ""), (3, "third one"), (4, "fourth")]


def test_text_results(spark, tmp_path):
    res = spark.createDataFrame([(1, 1, "a/x"), (1, 2, "b/y"), (2, 1, "no results found")],
                                "query_id bigint, rank bigint, doc_name string")
    out = str(tmp_path / "r")
    IO.write_results(res, out, as_text=True)
    lines = []
    for part in sorted(os.listdir(os.path.join(out, "query_id=1"))):
        if part.startswith("part-"):
            lines += open(os.path.join(out, "query_id=1", part)).read().split()
    assert lines == ["a/x", "b/y"]


def test_in_list_escaping(spark):
    df = spark.createDataFrame([("a'b",), ("c\\d",), ("x",)], "token string")
    got = sorted(r.token for r in df.where(S.in_list("token", ["a'b", "c\\d"])).collect())
    assert got == ["a'b", "c\\d"]
    assert df.where(S.in_list("token", [])).count() == 0
