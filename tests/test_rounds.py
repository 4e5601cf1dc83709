"""Search in rounds: what the shuffles of a large batch move, and the same hits."""

import pytest

from invdex.operators import compress as C
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.session import scratch_path, stored
from invdex.sources import index_store as IO
from tests.test_moved_once import shuffled, shuffled_rows  # noqa: F401

STOP = "the of and in to is it on at by"


@pytest.fixture
def made(spark):
    """300 documents of ten stop words, two words that 20 and 30 of them share, and one of their own."""
    texts = [f"r{i % 15} s{i % 10} {STOP} u{i}" for i in range(300)]
    rows = [("b", f"{i:04d}", t) for i, t in enumerate(texts)]
    ix = X.build_index(stored(spark.createDataFrame(rows, "block string, file string, text string"), "t-docs"))
    ix.postings = stored(ix.postings, "t-post")
    queries = [(q, f"r{q % 15} s{q * 7 % 10} {STOP}") for q in range(30)] + [(90, "u7"), (91, "absent the"), (92, "u3 u4"), (93, "u3 the of")]
    want = sorted((q, i + 1) for q, t in queries for i, d in enumerate(texts) if set(t.split()) <= set(d.split()))
    q = spark.createDataFrame(queries, "query_id bigint, query_text string")
    return ix, stored(S.term_lookup(S.parse_queries(q), ix.word_dict), "t-lookup"), want


@pytest.fixture
def moved(monkeypatch):
    """Rows shuffled by everything that search writes on its way, by tag."""
    rows = []
    monkeypatch.setattr(S, "stored", lambda df, tag: (rows.append((tag, shuffled_rows(df))), stored(df, tag))[1])
    return rows


def hits(df):
    return sorted(map(tuple, df.select("query_id", "did").collect()))


def batch(moved):
    return sum(n for tag, n in moved if tag != "ranked-terms")


def test_long_form(spark, made, shuffled, moved):  # noqa: F811
    ix, lookup, want = made
    got = S.conjunctive_hits(ix.postings, lookup)
    assert hits(got) == want and len(want) > 50
    # 600 candidates meet one term each; before, 600 * 11 checks met the postings of all terms
    assert batch(moved) + shuffled_rows(got) < 6000


def test_array_form(spark, made, shuffled, moved):  # noqa: F811
    ix, lookup, want = made
    some = lookup.where("query_id IN (0, 92, 93)")
    lists = X.segment_lists(ix.postings)
    got = S.intersect_lists(lists, some)
    assert hits(got) == [x for x in want if x[0] in (0, 92, 93)]
    # the other documents' own words are not made into lists
    assert batch(moved) + shuffled_rows(got) < 300 < lists.count()


def test_compressed_form(spark, made, shuffled, moved):  # noqa: F811
    ix, lookup, want = made
    enc = stored(C.encode(C.segments(ix.postings)), "t-enc")
    got = S.skip_hits(enc, enc.select("term_id", "seg", "first", "last", "n"), lookup, lambda e: C.decode_lists(e, "vb"))
    assert hits(got) == want
    # the stop words' ids stay lists: before, every pair of a query and a segment brought hundreds
    assert batch(moved) + shuffled_rows(got) < 4000


def test_buckets_hold_the_lists_once(spark, made):
    ix, _, _ = made
    root = scratch_path(spark, "t-buckets")
    IO.write_index(ix, root, compressed=C.encode(C.segments(ix.postings)))
    t = IO.read_bucketed(spark, root, IO.write_bucketed(spark, root, 3))
    enc = IO.read_compressed(spark, root)
    assert sorted(map(tuple, t["compressed"].collect())) == sorted(map(tuple, enc.collect()))
    assert sorted(map(tuple, t["skips"].collect())) == sorted(map(tuple, IO.read_skips(spark, root).collect()))
    assert {f.rsplit("/", 2)[-2] for f in t["skips"].inputFiles()} == {"compressed"}
