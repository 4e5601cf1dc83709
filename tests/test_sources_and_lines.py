"""The directory data source and the stream of query lines."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_helpers import write_corpus
from invdex.operators import index as X
from invdex.session import scratch_path
from invdex.sources import directory_source as D
from invdex.streaming import search_stream as SS

FILES = {"a:b/x:1": "one", "a:b/_hidden": "two", "a:b/.dot": b"", "p%20 q#/s %41?.txt": "three four", "z/1": b"\xff\xfe x", "z/2": "b" * 5000,
         "z/3.gz": "not compressed", "m/" + "n" * 50: "five"}


def test_any_name_is_read(spark, tmp_path):
    root = write_corpus(str(tmp_path / "c"), FILES)
    got = {f"{r.block}/{r.file}": r.text.encode("latin-1") for r in D.read_directory(spark, root).collect()}
    assert got == {k: v if isinstance(v, bytes) else v.encode() for k, v in FILES.items()}


def test_packs_and_pushed_blocks(spark, tmp_path):
    root = write_corpus(str(tmp_path / "c"), {f"b{k}/f{i:02d}": f"t{k} {i}" for k in range(6) for i in range(10)} | {"e/": ""})
    df = D.read_directory(spark, root, pack_bytes=4 * D.OPEN_COST)
    parts = df.rdd.getNumPartitions()
    assert 15 <= parts <= 30
    assert df.count() == 60
    for cond, n, most in (("block = 'b3'", 10, 7), ("block IN ('b0', 'b5')", 20, 14), ("block = 'absent'", 0, 1), ("block = 'b1' AND file = 'f03'", 1, 7)):
        some = df.where(cond)
        assert some.count() == n and some.rdd.getNumPartitions() <= most
        assert all(r.block in cond for r in some.collect())


def test_an_empty_root_and_empty_blocks(spark, tmp_path):
    os.makedirs(tmp_path / "c" / "empty")
    assert D.read_directory(spark, str(tmp_path / "c")).collect() == []
    os.makedirs(tmp_path / "none")
    assert D.read_directory(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(ValueError):
        D.read_directory(spark, str(tmp_path / "missing"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"\n", b"a", b"bc\n", b"\r\n", b"long line of words"]), max_size=30), st.integers(1, 9), st.integers(1, 7))
def test_lines_between(parts, split, chunk):
    data = b"".join(parts)
    got = []
    for start in range(0, len(data), split):
        got += SS.lines_between(lambda at, n: data[at:at + n], start, min(start + split, len(data)), len(data), chunk)
    want, at = [], 0
    for line in data.split(b"\n"):
        want.append((at, line))
        at += len(line) + 1
    if not data or data.endswith(b"\n"):
        want.pop()
    assert got == want


def test_line_ids_survive_a_restart(spark, tmp_path):
    rows = [("d", "1", "the cat é"), ("d", "2", "the dog"), ("e", "1", "cat")]
    ix = X.build_index(spark.createDataFrame(rows, "block string, file string, text string"))
    root = scratch_path(spark, "lines")
    src = f"{root}/in".removeprefix("file:")
    os.makedirs(src)

    def put(name, data):
        with open(f"{src}/{name}", "wb") as fh:
            fh.write(data)

    def run():
        SS.start_line_search(spark, ix, src, f"{root}/out", f"{root}/ckpt", split_bytes=5).awaitTermination()
        out = spark.read.schema(SS.LINE_RESULT_SCHEMA).parquet(f"{root}/out/results").collect()
        return sorted((r.path.rsplit("/", 1)[1], r.offset, r["rank"], r.doc_name) for r in out)

    put("m.txt", "cat\n\n  the\n".encode())
    put("n q.txt", "é the\nnone".encode())
    first = run()
    assert first == [("m.txt", 0, 1, "d/1"), ("m.txt", 0, 2, "e/1"), ("m.txt", 5, 1, "d/1"), ("m.txt", 5, 2, "d/2"),
                     ("n q.txt", 0, 1, "d/1"), ("n q.txt", 7, 1, "no results found")]
    put("a.txt", b"dog\n\ncat dog")
    put("empty.txt", b"")
    second = run()
    assert [r for r in second if r[0] != "a.txt"] == first
    assert [r for r in second if r[0] == "a.txt"] == [("a.txt", 0, 1, "d/2"), ("a.txt", 5, 1, "no results found")]
    got = sorted((r.query_id, r["rank"], r.doc_name) for r in SS.read_line_results(spark, f"{root}/out").collect())
    assert got == [(1, 1, "d/2"), (3, 1, "no results found"), (4, 1, "d/1"), (4, 2, "e/1"), (6, 1, "d/1"), (6, 2, "d/2"), (7, 1, "d/1"),
                   (8, 1, "no results found")]
