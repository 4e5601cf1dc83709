"""What the queries share is computed once, in order, and only as far as it is read."""

import os

from pyspark.sql import functions as F

from invdex.functions.text import NO_RESULTS
from invdex.operators import compress as C
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.plans import catalog as Q
from invdex.session import scratch_path, stored
from invdex.sources import index_store as IO

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_postings_are_joined_once(spark):
    assert "Exchange" not in plan(Q.index_for(spark, SF).postings) and "Join" not in plan(Q.index_for(spark, SF).postings)


def test_a_query_writes_the_parts_it_reads(spark, monkeypatch):
    monkeypatch.setattr(Q, "_CACHE", {k: v for k, v in Q._CACHE.items() if len(k) == 2})
    Q.q_skip_segments(spark, SF)
    root = Q.stored_index_for(spark, SF).removeprefix("file:")
    assert os.listdir(root) == ["compressed"]
    Q.q_search_gamma(spark, SF)
    assert sorted(os.listdir(root)) == ["compressed", "doc_dict", "name_order", "word_dict"]


def test_lists_come_in_order(spark):
    rows = [(t, d) for t in range(40) for d in range(1, 400, 1 + t)]
    post = stored(spark.createDataFrame(rows, "term_id bigint, did bigint").orderBy(F.rand(3)), "t-post")
    root = scratch_path(spark, "ordered")
    want = sorted(map(tuple, C.encode(C.segments(post)).collect()))
    for fanout in (1 << 16, 2):  # a term's lists in one group, and in several
        IO.write_compressed(C.encode(C.segments(post, fanout=fanout)), root, in_order=True)
        assert sorted(map(tuple, IO.read_compressed(spark, root).collect())) == want
    IO.write_compressed(C.encode(C.segments(post)), root, in_order=True)
    files = (IO.read_compressed(spark, root).withColumn("file", F.input_file_name()).groupBy("file")
             .agg(F.min(F.struct("term_id", "seg")).alias("a"), F.max(F.struct("term_id", "seg")).alias("b")).orderBy("a").collect())
    assert len(files) > 1 and all(tuple(x.b) < tuple(y.a) for x, y in zip(files, files[1:]))


def test_unanswerable_queries_do_not_make_a_batch_large(spark, monkeypatch):
    texts = [("b", str(i), f"the w{i % 5} u{i}") for i in range(30)]
    ix = X.build_index(spark.createDataFrame(texts, "block string, file string, text string"))
    post = stored(ix.postings, "t-post")
    asked = [(i, f"the absent{i} w1") for i in range(100)] + [(200, "the w1"), (201, "u3")]
    queries = spark.createDataFrame(asked, "query_id bigint, query_text string")
    monkeypatch.setattr(S, "is_small", lambda df: df.count() <= 50)
    used = []
    join = S.salted_join
    monkeypatch.setattr(S, "salted_join", lambda big, *a, **k: used.append(big.columns) or join(big, *a, **k))
    got = S.search(post, ix.word_dict, ix.doc_dict, queries, order=ix.name_order)
    assert ["term_id", "did"] not in used  # the postings stay where they are
    want = [(i, 1, NO_RESULTS) for i in range(100)]
    for q, terms in ((200, {"the", "w1"}), (201, {"u3"})):
        names = sorted(f"b/{f}" for _, f, t in texts if terms <= set(t.split()))
        want += [(q, r + 1, n) for r, n in enumerate(names)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
