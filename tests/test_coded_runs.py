"""Postings are shuffled and sorted as coded runs; coded lists are joined in sorted order."""

import numpy as np
import pyarrow as pa
import pytest

from invdex.functions import codecs as K
from invdex.operators import compress as C
from invdex.session import stored
from tests.test_moved_once import shuffled, shuffled_rows  # noqa: F401


@pytest.fixture
def batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    yield lambda n: spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_lists_are_dealt_as_runs(spark, shuffled):  # noqa: F811
    post = stored(spark.createDataFrame([(t, d) for t in range(9) for d in range(1, 300, t + 1)], "term_id bigint, did bigint"), "t-post")
    segs = C.segments(post)
    assert {(r.term_id, d) for r in segs.collect() for d in r.dids} == set(map(tuple, post.collect()))
    assert shuffled_rows(C.segments(post)) < 100  # a run per term and batch; the postings are 847


@pytest.mark.parametrize("fanout", [2, 1 << 16])
@pytest.mark.parametrize("size", [1, 3, 10_000])
def test_coded_lists_join_in_sorted_order(spark, batches, size, fanout):
    pairs = [(t, d) for t in range(5) for d in range(1, 400, 2 * t + 1)]
    post = stored(spark.createDataFrame(pairs, "term_id bigint, did bigint"), "t-post")
    cuts = [0, 30, 31, 200, 330, 400]  # inside lists, too
    parts = stored(C.encode(C.segments(post.where("did <= 30"))), "t-part").limit(0)
    for a, b in zip(cuts, cuts[1:]):
        parts = parts.unionByName(C.encode(C.segments(post.where(f"did > {a} AND did <= {b}"))))
    parts = stored(parts, "t-parts")
    batches(size)
    merged = C.merge_compressed(parts, fanout=fanout)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    if fanout > 2:
        assert "Window" not in plan
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, C.encode(C.segments(post)).collect()))


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_runs_come_back_sorted(monkeypatch, piece):
    monkeypatch.setattr(K, "PIECE", piece)
    monkeypatch.setattr(K, "ROWS", max(1, piece // 2))
    rng = np.random.default_rng(2)
    pairs = sorted({(int(t), int(d)) for t, d in zip(rng.integers(0, 9, 500), rng.integers(-5, 300, 500))})
    dealt = [pairs[k::4] for k in range(4)]

    def batch(rows, order):
        return pa.RecordBatch.from_pydict({"t": pa.array([rows[i][0] for i in order], pa.int64()), "did": pa.array([rows[i][1] for i in order], pa.int64())})

    runs = [r for rows in dealt for r in K.run_batches(["t"])([batch(rows, rng.permutation(len(rows)))])]
    assert sum(r.num_rows for r in runs) <= 36
    table = pa.Table.from_batches(runs).sort_by("t")
    for size in (1, 5, 100):
        got = [tuple(r.values()) for b in K._sorted_rows(table.combine_chunks().to_batches(max_chunksize=size), ["t"]) for r in b.to_pylist()]
        assert got == pairs
