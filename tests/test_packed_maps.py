"""Documents beyond broadcast size, as rows: their keys and blocks are met by packed maps."""

import pytest
from pyspark.sql import functions as F

from invdex.operators import compress as C
from invdex.operators import index as X
from invdex.operators import skew
from invdex.session import stored
from tests.test_build_plans import plain, tables
from tests.test_moved_once import shuffled, shuffled_rows  # noqa: F401


@pytest.fixture
def few_rows(monkeypatch):
    """At most 300 rows are broadcast; a map has 16 documents a row."""
    monkeypatch.setattr(X, "is_small", lambda df: skew.is_small(df, max_rows=300))
    monkeypatch.setattr(X, "NEIGHBOURS", 16, raising=False)


def made(spark, n=700):
    rows = [(f"b{i % 3}", f"{i:04d}", f"the of w{i % 5}" + (" the" if i % 2 else "")) for i in range(n)] + [("b9", "0", "")]
    return rows, stored(spark.createDataFrame(rows, "block string, file string, text string").repartition(3), "t-packed")


def test_many_documents_take_the_packed_map(spark, few_rows, monkeypatch):
    rows, corpus = made(spark)
    monkeypatch.setattr(X, "_narrow_index", lambda *a: pytest.fail("every posting was shuffled by its document"))
    ix = X.build_index(corpus)
    assert tables(ix) == plain(rows)


def test_blocks_meet_the_postings_without_a_shuffle(spark, few_rows, shuffled):  # noqa: F811
    rows, corpus = made(spark)
    ix = X.build_index(corpus)
    post, docs = stored(ix.postings, "t-post").coalesce(1), stored(ix.doc_dict, "t-docs")
    block = {r.did: r.block for r in docs.collect()}
    want = {}
    for r in post.collect():
        want.setdefault((block[r.did], r.term_id, (r.did - 1) // 64), []).append(r.did)
    got = X.block_postings(post, docs)
    assert {(r.block, r.term_id, r.seg): list(r.dids) for r in got.collect()} == {k: sorted(v) for k, v in want.items()}
    assert post.count() > 2000 and shuffled_rows(X.block_postings(post, docs)) < 100
    merged = C.merge_compressed(stored(C.block_segments(post, docs), "t-coded"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, C.encode(C.segments(post)).collect()))


def test_maps_with_holes_or_strange_blocks(spark, few_rows):
    docs = spark.createDataFrame([(d, "x" if d % 2 else None) for d in range(1, 901) if d != 40], "did bigint, block string")
    post = spark.createDataFrame([(t, d) for t in range(2) for d in (1, 40, 41, 900, 901)] + [(0, 1)], "term_id bigint, did bigint")
    want = sorted([(str(b), t, d) for t in range(2) for d, b in ((1, "x"), (41, "x"), (900, None))] + [("x", 0, 1)])
    assert X.packed(docs.withColumn("_no", F.lit(1)), "did", "_no") is None
    for some in (docs, docs.unionByName(spark.createDataFrame([(40, "y")], docs.schema)).where("did > 0")):
        rows = [(str(r.block), r.term_id, r.did) for r in X.with_blocks(post, some).collect() if r.did != 40]
        assert sorted(rows) == want
    lists = {(r.block, r.term_id): list(r.dids) for r in X.block_postings(post, docs).where("seg = 0").collect()}
    assert lists[("x", 0)] == [1, 41]  # a posting that comes twice counts once
