"""Toy corpus goldens: ids, dictionaries, block lists, codecs, sizes, search."""

import pytest
from pyspark.sql import functions as F

from corpus_helpers import TOY, TOY_GOLDEN, TOY_QUERIES, write_corpus
from invdex.operators import compress as C
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.sources.corpus import file_count, read_directory

# Fixed values (FIXTURES.md section 2): term -> (df, doc ids, VB hex, gamma hex, pad)
TERMS = {
    "i'm": (0, 2, [1, 5], "8184", "18", 2),
    "fine": (1, 2, [1, 5], "8184", "18", 2),
    ",": (2, 3, [1, 3, 5], "818282", "24", 1),
    "thank": (3, 2, [1, 5], "8184", "18", 2),
    "you": (4, 5, [1, 2, 3, 5, 6], "8181818281", "08", 1),
    "hi": (5, 2, [2, 6], "8284", "98", 0),
    "how": (6, 2, [2, 6], "8284", "98", 0),
    "are": (7, 2, [2, 6], "8284", "98", 0),
    "?": (8, 3, [2, 3, 6], "828183", "45", 1),
    "good": (9, 1, [3], "83", "05", 5),
    "to": (10, 1, [3], "83", "05", 5),
    "see": (11, 1, [3], "83", "05", 5),
    "bye": (12, 2, [3, 4], "8381", "0a", 4),
    "later": (13, 1, [3], "83", "05", 5),
}


@pytest.fixture(scope="module")
def toy(spark, tmp_path_factory):
    root = write_corpus(str(tmp_path_factory.mktemp("toy") / "data"), TOY)
    corpus = read_directory(spark, root)
    return corpus, X.build_index(corpus)


def test_file_count(toy):
    corpus, _ = toy
    assert file_count(corpus).first()[0] == 6


def test_doc_dict(toy):
    _, ix = toy
    rows = [(r.did, r.doc_name) for r in ix.doc_dict.orderBy("did").collect()]
    assert rows == [(1, "0/fine.txt"), (2, "0/hello.txt"), (3, "1/bye.txt"), (4, "1/byebye.txt"),
                    (5, "2/fine.txt"), (6, "2/hello.txt")]


def test_word_dict_and_postings(toy):
    _, ix = toy
    words = {r.token: (r.term_id, r.df) for r in ix.word_dict.collect()}
    assert words == {t: (v[0], v[1]) for t, v in TERMS.items()}
    lists = {r.term_id: sorted(r.ids) for r in
             ix.postings.groupBy("term_id").agg(F.collect_list("did").alias("ids")).collect()}
    assert lists == {v[0]: v[2] for v in TERMS.values()}


def test_block_postings(toy):
    corpus, ix = toy
    bl = X.block_postings(ix.postings, ix.doc_dict).collect()
    got = {(r.block, r.term_id): list(r.dids) for r in bl}
    expect = {}
    for block, spec in {"0": "0:1 1:1 2:1 3:1 4:1,2 5:2 6:2 7:2 8:2",
                        "1": "2:3 4:3 8:3 9:3 10:3 11:3 12:3,4 13:3",
                        "2": "0:5 1:5 2:5 3:5 4:5,6 5:6 6:6 7:6 8:6"}.items():
        for item in spec.split():
            t, ids = item.split(":")
            expect[(block, int(t))] = [int(x) for x in ids.split(",")]
    assert got == expect
    merged = X.merge_blocks(*[X.block_postings(ix.postings, ix.doc_dict).where(F.col("block") == b)
                              for b in ["0", "1", "2"]])
    assert sorted((r.term_id, list(r.dids)) for r in merged.collect()) == \
        sorted((v[0], v[2]) for v in TERMS.values())


def test_codecs_and_sizes(toy):
    _, ix = toy
    enc = C.encode(C.segments(ix.postings)).collect()
    got = {r.term_id: (bytes(r.vb).hex(), bytes(r.gamma).hex(), r.gamma_pad) for r in enc}
    assert got == {v[0]: (v[3], v[4], v[5]) for v in TERMS.values()}
    size = C.index_size(ix.postings, C.encode(C.segments(ix.postings))).first()
    assert (size.plain_bytes, size.vb_bytes, size.gamma_bytes) == (90, 29, 14)


def test_search_goldens(spark, toy):
    _, ix = toy
    q = spark.createDataFrame(TOY_QUERIES, "query_id bigint, query_text string")
    res = S.search(ix.postings, ix.word_dict, ix.doc_dict, q).orderBy("query_id", "rank").collect()
    got = {}
    for r in res:
        got.setdefault(r.query_id, []).append(r.doc_name)
    assert got == TOY_GOLDEN
    ranks = [(r.query_id, r.rank) for r in res if r.query_id == 3]
    assert ranks == [(3, i) for i in range(1, 6)]
