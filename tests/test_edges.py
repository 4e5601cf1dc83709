"""Edge corpora (FIXTURES.md section 3) and query edge cases."""

import pytest

from corpus_helpers import write_corpus
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.sources.corpus import encode_query_text, file_count, list_corpus, read_directory


def _build(spark, root):
    corpus = read_directory(spark, root)
    return corpus, X.build_index(corpus)


def _search(spark, ix, queries, encode=False):
    q = spark.createDataFrame(queries, "query_id bigint, query_text string")
    if encode:
        q = encode_query_text(q)
    res = S.search(ix.postings, ix.word_dict, ix.doc_dict, q).orderBy("query_id", "rank").collect()
    out = {}
    for r in res:
        out.setdefault(r.query_id, []).append(r.doc_name)
    return out


def test_no_block(spark, tmp_path):
    root = str(tmp_path / "empty")
    (tmp_path / "empty").mkdir()
    corpus, ix = _build(spark, root)
    assert file_count(corpus).first()[0] == 0
    assert ix.doc_dict.count() == 0 and ix.word_dict.count() == 0 and ix.postings.count() == 0


def test_one_block_and_empty_block(spark, tmp_path):
    root = write_corpus(str(tmp_path / "c"), {"0/a.txt": "x y\n", "0/b.txt": "y z\n", "1/": b""})
    corpus, ix = _build(spark, root)
    assert file_count(corpus).first()[0] == 2
    assert _search(spark, ix, [(1, "y"), (2, "x z")]) == {1: ["0/a.txt", "0/b.txt"], 2: ["no results found"]}


def test_empty_and_hidden_files(spark, tmp_path):
    root = write_corpus(str(tmp_path / "c"), {"a/empty.txt": b"", "a/_hidden.txt": "secret word\n",
                                              "a/.dot": "word\n", "a/plain.txt": "word\n"})
    corpus, ix = _build(spark, root)
    assert file_count(corpus).first()[0] == 4
    names = [r.doc_name for r in ix.doc_dict.orderBy("did").collect()]
    assert names == ["a/.dot", "a/_hidden.txt", "a/empty.txt", "a/plain.txt"]
    assert _search(spark, ix, [(1, "word"), (2, "secret")]) == {
        1: ["a/.dot", "a/_hidden.txt", "a/plain.txt"], 2: ["a/_hidden.txt"]}
    # the empty file has an id but no postings
    empty_id = [r.did for r in ix.doc_dict.collect() if r.doc_name == "a/empty.txt"][0]
    assert ix.postings.where(f"did = {empty_id}").count() == 0


def test_dir_order_vs_name_order(spark, tmp_path):
    root = write_corpus(str(tmp_path / "c"), {"a/x": "t\n", "a-b/x": "t\n"})
    _, ix = _build(spark, root)
    ids = {r.doc_name: r.did for r in ix.doc_dict.collect()}
    assert ids == {"a/x": 1, "a-b/x": 2}          # ids by (dir, file)
    assert _search(spark, ix, [(1, "t")]) == {1: ["a-b/x", "a/x"]}   # results by 'dir/file'


def test_encoded_path_kept(spark, tmp_path):
    root = write_corpus(str(tmp_path / "c"), {"a/sp ace%20#q.txt": "hello\n", "a/_h #1%25.txt": "hidden hello\n"})
    _, ix = _build(spark, root)
    assert sorted(r.doc_name for r in ix.doc_dict.collect()) == ["a/_h #1%25.txt", "a/sp ace%20#q.txt"]
    assert _search(spark, ix, [(1, "hello"), (2, "hidden")]) == {
        1: ["a/_h #1%25.txt", "a/sp ace%20#q.txt"], 2: ["a/_h #1%25.txt"]}


def test_bad_utf8_bytes(spark, tmp_path):
    root = write_corpus(str(tmp_path / "c"), {"a/bin": bytes.fromhex("7820fffe207a0b77")})
    corpus, ix = _build(spark, root)
    toks = sorted(r.token for r in ix.word_dict.collect())
    assert len(toks) == 4
    assert [t.encode("latin-1") for t in toks] == sorted([b"x", b"\xff\xfe", b"z", b"w"])


def test_whitespace_classes(spark, tmp_path):
    text = "a\x0bb\x0cc\rd e\u0085f g h\n"
    root = write_corpus(str(tmp_path / "c"), {"a/ws": text})
    _, ix = _build(spark, root)
    toks = sorted(t.encode("latin-1").decode("utf-8") for t in (r.token for r in ix.word_dict.collect()))
    assert toks == sorted(["a", "b", "c", "d", "e\u0085f", "g h"])
    hits = _search(spark, ix, [(1, "e\u0085f"), (2, "g h"), (3, "e")], encode=True)
    assert hits == {1: ["a/ws"], 2: ["a/ws"], 3: ["no results found"]}


def test_query_edge_cases(spark, tmp_path):
    root = write_corpus(str(tmp_path / "c"), {"0/a": "the cat\n", "0/b": "the dog\n"})
    _, ix = _build(spark, root)
    got = _search(spark, ix, [(1, ""), (2, "   "), (3, "the"), (4, "the the"), (5, "the unseen"), (6, "cat dog")])
    assert 1 not in got and 2 not in got                       # blank queries skipped
    assert got[3] == got[4] == ["0/a", "0/b"]                  # repeated term = once
    assert got[5] == ["no results found"]                      # unseen term
    assert got[6] == ["no results found"]                      # empty intersection


def test_layout_errors(spark, tmp_path):
    root = write_corpus(str(tmp_path / "c"), {"top.txt": "x"})
    with pytest.raises(ValueError):
        list_corpus(spark, root)
    root2 = write_corpus(str(tmp_path / "d"), {"a/b/c.txt": "x"})
    with pytest.raises(ValueError):
        list_corpus(spark, root2)
