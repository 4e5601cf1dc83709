"""Results ranked by the stored name order, and the bucketed layout: values
against plain Python, and plans at sizes beyond every broadcast."""

import pytest

from invdex.functions.text import NO_RESULTS
from invdex.operators import compress as C
from invdex.operators import index as X
from invdex.operators import search as S
from invdex.session import scratch_path
from invdex.sources import index_store as IO

# block names of which one begins the other, on both sides of "/"
BLOCKS = ["a", "a-b", "a0", "a/b", "", "é", "b"]
TEXTS = {(b, f"{k}{s}"): f"the w{k % 5} {'x' if k % 3 else 'rare'} {b}" for b in BLOCKS for k in range(9) for s in ("", "~")}
QUERIES = [(1, "the"), (2, "the rare"), (3, "w1 x"), (4, "the absent"), (5, " "), (6, "rare x"), (7, "the")] + [(20 + i, f"the w{i % 5}") for i in range(12)]


@pytest.fixture(scope="module")
def made(spark):
    corpus = spark.createDataFrame([(b, f, t) for (b, f), t in TEXTS.items()], "block string, file string, text string")
    ix = X.build_index(corpus)
    root = scratch_path(spark, "named")
    IO.write_index(ix, root, compressed=C.encode(C.segments(ix.postings)))
    return ix, root, IO.write_bucketed(spark, root, 5)


def plain():
    out = []
    for qid, q in QUERIES:
        if q.split():
            names = sorted((f"{b}/{f}" for (b, f), t in TEXTS.items() if set(q.split()) <= set(t.split())), key=str.encode)
            out += [(qid, r + 1, n) for r, n in enumerate(names)] or [(qid, 1, NO_RESULTS)]
    return sorted(out)


def ask(spark):
    return spark.createDataFrame(QUERIES, "query_id bigint, query_text string")


@pytest.fixture
def huge(spark, monkeypatch):
    """Every size check fails and Spark broadcasts nothing by itself."""
    for mod in (S, X):
        monkeypatch.setattr(mod, "is_small", lambda df: False)
    monkeypatch.setattr(S, "broadcast_if_small", lambda df: df)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_name_order(spark, made):
    ix, root, _ = made
    names = {r.did: r.doc_name for r in ix.doc_dict.collect()}
    want = {d: k + 1 for k, d in enumerate(sorted(names, key=lambda d: (names[d].encode(), d)))}
    for got in (ix.name_order, IO.read_index(spark, root).name_order):
        assert {r.did: r.name_rank for r in got.collect()} == want
    assert [d for d, _ in sorted(want.items(), key=lambda x: x[1])] != sorted(want)  # not the order of the ids
    empty = X.build_index(spark.createDataFrame([], "block string, file string, text string"))
    assert empty.name_order.count() == 0


@pytest.mark.parametrize("window", [True, False])
def test_ranked_by_numbers(spark, made, monkeypatch, window):
    if not window:
        monkeypatch.setattr(S, "RANK_WINDOW_MAX", 3)
    ix, _, _ = made
    got = S.search(ix.postings, ix.word_dict, ix.doc_dict, ask(spark), order=ix.name_order)
    assert sorted(map(tuple, got.collect())) == plain()
    assert sorted(map(tuple, S.search(ix.postings, ix.word_dict, ix.doc_dict, ask(spark)).collect())) == plain()


def test_no_sort_of_names(spark, made, huge):
    ix, root, _ = made
    st = IO.read_index(spark, root)
    lookup = S.term_lookup(S.parse_queries(ask(spark)), st.word_dict)
    hits = S.conjunctive_hits(st.postings, lookup)
    lines = plan_lines(S.name_ranked(hits, st.doc_dict, st.name_order, lookup, 10))
    ordering = [line for line in lines if "Sort [" in line or "Window [" in line or "rangepartitioning" in line]
    assert any("name_rank" in line for line in ordering) and not any("doc_name" in line for line in ordering)


@pytest.mark.parametrize("big", [False, True])
def test_bucketed_search(spark, made, big, request):
    if big:
        request.getfixturevalue("huge")
    _, root, n = made
    t, st = IO.read_bucketed(spark, root, n), IO.read_index(spark, root)
    got = S.search(t["compressed"], t["word_dict"], st.doc_dict, ask(spark), decode=lambda e: C.decode_lists(e, "gamma"),
                   skips=t["skips"], order=st.name_order)
    assert sorted(map(tuple, got.collect())) == plain()


def exchanged(df, columns):
    """Exchanges directly above a scan (and its filters) of those columns."""
    lines, out = plan_lines(df), []
    for k, line in enumerate(lines):
        if "FileScan" in line and all(c in line for c in columns):
            depth = line.index("FileScan")
            for above in reversed(lines[:k]):
                at = len(above) - len(above.lstrip(" :+-*()0123456789"))
                if at < depth:
                    depth = at
                    if "Join" in above:
                        break
                    if "Exchange" in above:
                        out.append(above)
    return out


def test_index_side_is_not_shuffled(spark, made, huge):
    _, root, n = made
    t, st = IO.read_bucketed(spark, root, n), IO.read_index(spark, root)
    qterms = S.parse_queries(ask(spark))
    # the dictionary: reduced to the batch's tokens where it lies
    assert not exchanged(S.term_lookup(qterms, t["word_dict"]), ["token"])
    assert exchanged(S.term_lookup(qterms, st.word_dict), ["token"])
    # the lists: only those that the plan names are read by the decoder
    lookup = S.term_lookup(qterms, t["word_dict"])
    seen = []

    def decode(enc):
        seen.append(enc)
        return C.decode_lists(enc, "vb")

    S.skip_hits(t["compressed"], t["skips"], lookup, decode, small=False)
    S.skip_hits(IO.read_compressed(spark, root), t["skips"], lookup, decode, small=False)
    assert not exchanged(seen[0], ["vb"]) and exchanged(seen[1], ["vb"])
    scans = [line for line in plan_lines(seen[0]) if "FileScan" in line and "vb" in line]
    assert scans and all("Bucketed: true" in line for line in scans)
