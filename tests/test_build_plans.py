"""The build on its narrow path, and what its plans move; the growing dictionary."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from invdex.operators import index as X
from invdex.session import scratch_path, stored
from invdex.streaming import index_stream as IS

TEXTS = [("b", "2", "x y x"), ("a", "10", ""), ("a", "9", "the y\nthe z"), ("b", "1", "z z the"), ("c", "0", None)]


def corpus_of(spark, n=60):
    rows = TEXTS + [("d", f"{i:03d}", f"the w{i % 7} w{i * 3 % 11} u{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "block string, file string, text string")
    return stored(df.withColumn("text", F.coalesce("text", F.lit(""))).repartition(5), "t-corpus")


def tables(ix):
    return [sorted(map(tuple, df.collect())) for df in (ix.doc_dict, ix.word_dict.select("term_id", "token", "df"), ix.postings)]


def plain(rows):
    """The index, one document after another."""
    words, df, post, docs = {}, {}, set(), []
    for did, (block, file, text) in enumerate(sorted(rows, key=lambda r: r[:2]), 1):
        docs.append((did, block, file, f"{block}/{file}"))
        for t in (text or "").split():
            term = words.setdefault(t, len(words))
            if (term, did) not in post:
                post.add((term, did))
                df[t] = df.get(t, 0) + 1
    return [docs, sorted((i, t, df[t]) for t, i in words.items()), sorted(post)]


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(X, "is_small", lambda df: False)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def moved(df):
    """Columns that shuffles and sorts of the plan carry."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    found = re.findall(r"\(\d+\) (?:Exchange|Sort)\b[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert found or "Exchange" not in text
    return {c.split("#")[0].strip() for x in found for c in x.split(",")}


def test_small_and_narrow_builds_equal_the_plain_one(spark, no_broadcast, monkeypatch):
    corpus = corpus_of(spark)
    want = plain([tuple(r) for r in corpus.collect()])
    assert tables(X.build_index(corpus)) == want
    monkeypatch.undo()
    assert tables(X.build_index(corpus)) == want


def test_the_text_never_moves(spark, no_broadcast):
    corpus = corpus_of(spark)
    ix = X.build_index(corpus)
    for df in (ix.postings, X.token_positions(corpus, ix.doc_dict), X.occurrences(corpus, ix.doc_dict, ix.word_dict),
               X.block_postings(ix.postings, ix.doc_dict)):
        carried = moved(df)
        assert carried and not carried & {"text", "terms"}
    # provisional keys and tokens come from the scan's own tasks
    assert "token" not in moved(ix.postings)
    want = plain([tuple(r) for r in corpus.collect()])
    assert sorted((r.term_id, r.did) for r in X.occurrences(corpus, ix.doc_dict, ix.word_dict).distinct().select("term_id", "did").distinct().collect()) == want[2]


def test_duplicate_and_null_names_are_errors(spark):
    for rows in ([("a", "1", "x"), ("a", "1", "y")], [("a", None, "x")]):
        with pytest.raises(ValueError):
            X.build_index(spark.createDataFrame(rows, "block string, file string, text string"))


def dictionary_bytes(spark, tokens, state, runs):
    """Bytes of files that a lookup scans."""
    df = IS.known_words(tokens, state, runs)
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    total = 0
    for k in range(leaves.size()):
        m = leaves.apply(k).metrics()
        if m.contains("filesSize"):
            total += m.apply("filesSize").value()
    return total


def test_dictionary_reads_follow_the_batch(spark, monkeypatch):
    monkeypatch.setattr(IS, "BUCKET_WORDS", 8)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    state, read, live, rows = scratch_path(spark, "grow"), [], [], []
    try:
        for e in range(8):
            batch = [("b", f"{e:02d}-{k}", f"the new{e}x{k} more{e}x{k} w{k}") for k in range(36)]
            df = spark.createDataFrame(batch, "block string, file string, text string")
            IS.grow(df, e, state)
            rows += batch
            runs = IS.live_runs(spark, state)
            live.append([r[1] for r in runs])
            tokens = spark.createDataFrame([("the",), ("w3",), ("absent",)], "token string")
            read.append(dictionary_bytes(spark, tokens, state, runs))
            assert {r.token for r in IS.known_words(tokens, state, runs).collect()} == {"the", "w3"}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert all(a > 2 * b for x in live for a, b in zip(x, x[1:]))  # tiers of falling sizes
    assert max(map(len, live)) <= 4
    # three tokens name three folders of each run at most, however many there are
    files = [x.stat().st_size for x in Path(state.removeprefix("file:")).rglob("word_runs/run=*/**/*.parquet")]
    assert max(read) <= 3 * 4 * max(files)
    last = sum(x.stat().st_size for r in runs for x in Path(state.removeprefix("file:")).rglob(f"word_runs/run={r[0]}/**/*.parquet"))
    assert max(read) * 4 < last
    t = IS.read_stream_index(spark, state)
    got = [sorted(map(tuple, d.collect())) for d in (t["doc_dict"].select("did", "block", "file", "doc_name"), t["word_dict"].select("term_id", "token", "df"),
                                                   t["postings"].select("term_id", "did"))]
    assert got == plain(rows)


def test_a_replayed_epoch_changes_nothing(spark):
    state = scratch_path(spark, "replay")
    one = spark.createDataFrame([("a", "1", "x y"), ("a", "2", "y z")], "block string, file string, text string")
    two = spark.createDataFrame([("b", "1", "z q"), ("b", "2", "")], "block string, file string, text string")
    IS.grow(one, 0, state)
    IS.grow(two, 1, state)
    first = {k: sorted(map(tuple, d.collect())) for k, d in IS.read_stream_index(spark, state).items()}
    IS.grow(two, 1, state)
    assert {k: sorted(map(tuple, d.collect())) for k, d in IS.read_stream_index(spark, state).items()} == first
    IS.grow(spark.createDataFrame([], "block string, file string, text string"), 2, state)
    assert {k: sorted(map(tuple, d.collect())) for k, d in IS.read_stream_index(spark, state).items()} == first
