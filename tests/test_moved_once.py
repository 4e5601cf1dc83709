"""What the index queries shuffle: tokens once per batch, a batch's skips, coded lists once."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from invdex.operators import compress as C
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.plans import catalog as Q
from invdex.session import scratch_path, stored
from invdex.streaming import index_stream as IS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """Joins shuffle, and plans say all."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(old, ("-1", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def exchanges(df):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning)\(([^)]*)", df._jdf.queryExecution().executedPlan().toString())


def shuffled_rows(df):
    """Rows that the plan's exchanges write."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if p.nodeName() == "Exchange":
            found += p.metrics().apply("shuffleRecordsWritten").value()
        todo += [p.children().apply(k) for k in range(p.children().size())]
    return found


def test_a_token_moves_once_per_batch(spark, shuffled, monkeypatch):
    rows = [("b", f"{i:04d}", f"the of w{i % 3} u{i}") for i in range(400)]
    corpus = spark.createDataFrame(rows, "block string, file string, text string").coalesce(2)
    want = sorted(map(tuple, X.build_index(corpus).postings.collect()))
    monkeypatch.setattr(X, "DICT_BROADCAST", 10)
    post = X.build_index(corpus).postings
    assert sorted(map(tuple, post.collect())) == want and len(want) == 1600
    assert shuffled_rows(post) < 1400  # 400 + 2 * 5 tokens, and the dictionary with its salts


def test_only_the_batch_terms_skips_move(spark, shuffled):
    skips = stored(spark.range(5000).selectExpr("id term_id", "id % 7 seg", "id % 7 * 64 + 1 first", "id % 7 * 64 + 9 last", "9L n"), "t-skips")
    lookup = spark.createDataFrame([(1, "a", 7, 9), (1, "b", 14, 9), (2, "c", 3, 9)], "query_id bigint, token string, term_id bigint, df bigint")
    plan = S.segment_plan(skips, lookup, True)
    assert sorted(map(tuple, plan.collect())) == [(1, 0, 2), (2, 3, 1)]
    assert shuffled_rows(S.segment_plan(skips, lookup, True)) < 200


def test_coded_lists_are_dealt_once(spark, shuffled):
    parts = stored(C.encode(C.segments(spark.createDataFrame([(t, d) for t in range(9) for d in range(1, 300, t + 1)], "term_id bigint, did bigint"))), "t-parts")
    merged = C.merge_compressed(parts)
    assert len(exchanges(merged)) == 1
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, parts.select(*merged.columns).collect()))


def test_epochs_are_dealt_once(spark, shuffled):
    state = scratch_path(spark, "t-epochs")
    for e in range(2):
        IS.grow(spark.createDataFrame([("b", f"{e}-{i:03d}", f"the w{i % 5}") for i in range(100)], "block string, file string, text string"), e, state)
    post = IS.epoch_lists(spark, state)
    assert len([x for x in exchanges(post) if "term_id" in x[1]]) == 1
    want = IS.read_stream_index(spark, state)["postings"].select("term_id", "did").collect()
    assert sorted(map(tuple, X.explode_lists(post).collect())) == sorted(map(tuple, want)) and len(want) == 400


def test_shared_postings_are_sorted(spark):
    files = Q.index_for(spark, SF).postings.withColumn("f", F.input_file_name()).withColumn("k", F.monotonically_increasing_id())
    got = files.orderBy("k").toPandas()
    for _, g in got.groupby("f"):
        assert (np.diff(g["term_id"]) >= 0).all()


@pytest.mark.parametrize("batch", [3, 7, 10_000])
def test_lists_across_batches(spark, batch):
    """Lists, bases and groups don't depend on where Arrow batches end."""
    rng = np.random.default_rng(5)
    pairs = sorted({(b, int(t), int(d)) for b in ("x", "y") for t, d in zip(rng.integers(0, 6, 300), rng.integers(1, 200, 300))})
    want, last = {}, {}
    for b, t, d in pairs:
        key = (b, t, (d - 1) // 8)
        if key not in want:
            want[key] = (last.get((b, t), 0), [])
        want[key][1].append(d)
        last[b, t] = d
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        post = stored(spark.createDataFrame(pairs, "block string, term_id bigint, did bigint").orderBy(F.rand(1)), "t-pairs")
        for fanout in (3, 1 << 16):
            got = C.segments(post, seg_width=8, fanout=fanout, extra_keys=("block",)).collect()
            assert {(r.block, r.term_id, r.seg): (r.base, list(r.dids)) for r in got} == want and len(got) == len(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
