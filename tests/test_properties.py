"""Properties: dense ids do not depend on partitioning, merge = full build,
incremental stream = batch build, q = q q, adding a term never adds hits,
and the skew-safe rank equals a per-query window."""


import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpus_helpers import SF
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.operators.ids import dense_ids, global_rank_in_group
from invdex.session import scratch_path
from invdex.sources.corpus import documents_corpus
from invdex.streaming import index_stream as IS
from invdex.streaming import search_stream as SS

SF1 = f"{SF}/sf0.001"


@pytest.fixture(scope="module")
def ix(spark):
    return X.build_index(documents_corpus(spark, SF1))


def test_dense_ids_partition_independent(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    a = dense_ids(df, ["k"], "i", start=1, num_partitions=3).collect()
    b = dense_ids(df, ["k"], "i", start=1, num_partitions=17).collect()
    assert sorted((r.k, r.i) for r in a) == sorted((r.k, r.i) for r in b) == [(k, k + 1) for k in range(5000)]


def test_global_rank_matches_window(spark):
    rows = [(q, f"n{(q * 31 + i) % 997:04d}") for q in range(4) for i in range(300 if q == 0 else 5)]
    df = spark.createDataFrame(rows, "query_id bigint, doc_name string")
    a = global_rank_in_group(df, "query_id", ["doc_name"], "rank", num_partitions=7)
    w = Window.partitionBy("query_id").orderBy("doc_name")
    b = df.withColumn("rank", F.row_number().over(w))
    assert sorted(a.collect()) == sorted(b.select("query_id", "doc_name", "rank").collect())


def test_merge_equals_build(spark, ix):
    bl = X.block_postings(ix.postings, ix.doc_dict)
    blocks = [r.block for r in bl.select("block").distinct().collect()]
    merged = X.merge_blocks(*[bl.where(F.col("block") == b) for b in blocks])
    full = X.segment_lists(ix.postings)
    norm = lambda df: sorted((r.term_id, r.seg, tuple(r.dids)) for r in df.collect())
    assert norm(merged) == norm(full)


def test_repeated_term_and_monotone(spark, ix):
    q = spark.createDataFrame([(1, "of the"), (2, "of the of the"), (3, "of the in"), (4, "the")],
                              "query_id bigint, query_text string")
    res = S.search(ix.postings, ix.word_dict, ix.doc_dict, q).collect()
    got = {}
    for r in res:
        got.setdefault(r.query_id, set()).add(r.doc_name)
    assert got[1] == got[2]
    assert got[3] <= got[1] <= got[4]


def test_array_form_equals_long_form(spark, ix):
    q = spark.createDataFrame([(1, "of the in"), (2, "the"), (3, "and of to")], "query_id bigint, query_text string")
    lk = S.term_lookup(S.parse_queries(q), ix.word_dict)
    a = sorted(tuple(r) for r in S.intersect_lists(X.segment_lists(ix.postings), lk).collect())
    b = sorted(tuple(r) for r in S.conjunctive_hits(ix.postings, lk).collect())
    assert a == b and len(a) > 0


def test_stream_index_equals_batch(spark, ix):
    root = scratch_path(spark, "t-stream-index")
    IS.stage_corpus(documents_corpus(spark, SF1), f"{root}/in", 5)
    IS.start_index_stream(spark, f"{root}/in", f"{root}/state", f"{root}/ckpt").awaitTermination()
    t = IS.read_stream_index(spark, f"{root}/state")
    assert sorted(t["postings"].select("term_id", "did").collect()) == sorted(ix.postings.collect())
    assert sorted(t["word_dict"].select("term_id", "token").collect()) == \
        sorted(ix.word_dict.select("term_id", "token").collect())
    # a second run over the same checkpoint replays nothing and changes nothing
    IS.start_index_stream(spark, f"{root}/in", f"{root}/state", f"{root}/ckpt").awaitTermination()
    assert IS.read_stream_index(spark, f"{root}/state")["postings"].count() == ix.postings.count()


def test_stream_search_equals_batch(spark, ix):
    root = scratch_path(spark, "t-stream-search")
    q = spark.createDataFrame([(i, t) for i, t in enumerate(["the", "of the in", "zzz", "and the"])],
                              "query_id bigint, query_text string")
    q.repartition(4).write.json(f"{root}/in")
    SS.start_search_stream(spark, ix, f"{root}/in", f"{root}/out", f"{root}/ckpt").awaitTermination()
    a = sorted(SS.read_stream_results(spark, f"{root}/out").collect())
    b = sorted(S.search(ix.postings, ix.word_dict, ix.doc_dict, q).collect())
    assert a == b


def test_salted_join_equals_plain_join(spark, ix):
    from invdex.operators.skew import salted_join
    rows = X.token_positions(ix.corpus, ix.doc_dict).select("did", "token").distinct()
    w = ix.word_dict.select("token", "term_id", "df")
    salted = salted_join(rows, w, "token", "df", "did", hot_keys=16, buckets=5).select("term_id", "did")
    plain = rows.join(w, "token").select("term_id", "did")
    assert sorted(salted.collect()) == sorted(plain.collect())
    assert sorted(salted.collect()) == sorted(ix.postings.collect())
