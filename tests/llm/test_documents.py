"""Operators over documents against brute force, with the defined cases."""

import collections
import hashlib
import math
import re

import duckdb
import pytest
import xxhash
from conftest_llm import BASE, LONG, brute_base, items

from invdex.llm import decontaminate, lm_score, mixing, pii, quality, simhash, toxicity
from invdex.llm.components import components


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def key(rows):
    return sorted(rows, key=repr)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# 1 ------------------------------------------------------------------------
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_scan(docs, bench):
    wins = collections.defaultdict(set)
    for item, t in bench:
        w = re.findall(ALNUM, fold(t))
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            wins[tuple(w[i:i + k])].add(item)
    out = []
    for i, t in docs:
        w, hit, ids = re.findall(ALNUM, fold(t)), set(), set()
        for k in {len(x) for x in wins}:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in wins:
                    hit |= set(range(a, a + k))
                    ids |= wins[tuple(w[a:a + k])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in ids if x is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return out


BENCH = [(1, " ".join(f"Word{i}" for i in range(100, 130))), (10, "two, words!"), (2, None), (3, ""), (4, "--"), (None, "one"), (1, BASE[:200]), (9, "東京 Émile")]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 1500])
def test_decontaminate(spark, edge, block):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    out = decontaminate.judge(decontaminate.scan(edge, bench, block_bytes=block))
    assert set(edge.columns) <= set(out.columns)
    got = [(r.doc_id, r.n_words, r.n_hit, sorted(r.hit_items), r.contaminated) for r in out.collect()]
    assert key(got) == key(brute_scan(items(edge), BENCH))


def test_decontaminate_removal(spark, edge, nothing):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    kept = decontaminate.remove_documents(edge, bench)
    assert kept.columns == edge.columns
    want = [d for d, b in zip(items(edge), brute_scan(items(edge), BENCH)) if not b[4]]
    assert key(items(kept)) == key(want)
    cut = {(r.doc_id, r.text) for r in decontaminate.remove_spans(edge, bench).select("doc_id", "text").collect()}
    assert (5, "") in cut and (4, "") in cut and (1, None) in cut and (11, "Straße  é") in cut
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.judge(decontaminate.scan(edge, none)).filter("contaminated").count() == 0
    assert decontaminate.scan(nothing, bench).count() == 0


# 2 ------------------------------------------------------------------------
def brute_fp(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(t))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, most=3):
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= most:
                up[root(b)] = root(a)
    return {f: root(f) for f in fps}


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def test_simhash(spark, edge, nothing):
    docs = items(edge)
    root = brute_groups({brute_fp(t) for _, t in docs})
    first = {}
    for i, t in docs:
        r = root[brute_fp(t)]
        first[r] = min(x for x in (first.get(r), i) if x is not None) if (i is not None or first.get(r) is not None) else None
    want = [(i, signed(brute_fp(t)), first[root[brute_fp(t)]]) for i, t in docs]
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(edge).collect()]
    assert key(got) == key(want)
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((v for v in first.values()), key=repr)
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


@pytest.mark.parametrize("block", [simhash.BLOCK, 5])
def test_links_of_dense_groups(spark, monkeypatch, block):
    """Dense balls, chains of three-bit steps and far points; also with anchors
    dealt into blocks."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    import random

    rnd = random.Random(7)
    fps = {0, (1 << 64) - 1}
    for _ in range(6):
        c = rnd.getrandbits(64)
        fps |= {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for _ in range(40)}
        for _ in range(12):
            c ^= sum(1 << b for b in rnd.sample(range(64), 3))
            fps.add(c)
    fps |= {rnd.getrandbits(64) for _ in range(100)}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    got = {r.node: r.root for r in components(simhash.links(df)).collect()}
    mine = collections.defaultdict(set)
    for f in fps:
        mine[got.get(signed(f), signed(f))].add(f)
    want = collections.defaultdict(set)
    for f, r in brute_groups(fps).items():
        want[r].add(f)
    assert key(map(sorted, mine.values())) == key(map(sorted, want.values()))


def test_components_of_a_long_path(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 1001: 1000}
    assert components(df.limit(0)).count() == 0


# 3 ------------------------------------------------------------------------
def test_mixing(spark, edge, nothing):
    sized, p = mixing.plan(edge)
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    got = mixing.mix(sized, p).select(cols).collect()
    con = duckdb.connect()
    documents = edge.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})
    con.register("documents", documents)
    want = con.execute(mixing.ORACLE).fetchall()
    assert key(map(tuple, got)) == key(want)
    assert sum({r.source_size: r.target for r in got if r.source_size}.values()) == pytest.approx(sum(r.size for r in got))
    assert all(r.taken <= 3 * r.size for r in got)
    rows = mixing.mixture(edge).collect()
    assert collections.Counter((r.doc_id, r.size) for r in rows if r.doc_id == 4) == {(4, 1): sum(r.taken for r in got if r.doc_id == 4)}
    assert mixing.mixture(nothing).count() == 0


def test_water_filling_reshares(spark):
    """Small heavy sources stop at three times their size."""
    rows = [("a", 1000), ("b", 10), ("c", 1), ("d", 0), (None, 500)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, size bigint")).collect()}
    assert got["b"] == 30 and got["c"] == 3 and got["d"] == 0
    assert got[None] == pytest.approx(2 * got["a"])  # weights 1 and 2
    assert sum(got.values()) == pytest.approx(1511)


def test_mixing_comes_near_targets(spark):
    import random

    rnd = random.Random(3)
    docs = spark.createDataFrame([(i, "w " * rnd.randint(0, 60), f"s{i % 7 if i % 3 else 0}") for i in range(3000)], "doc_id bigint, text string, source string")
    sized, p = mixing.plan(docs)
    out = mixing.mix(sized, p).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 30 for r in out)


# 5 ------------------------------------------------------------------------
def test_toxicity_held_out(spark, edge, nothing):
    import random

    rnd = random.Random(5)
    words = [f"{a}{b}" for a in "ba be bi bo bu da de di do du".split() for b in "la le li lo lu ra re ri ro ru".split()]
    rows, lab = [], []
    for i in range(1500):
        t = [rnd.choice(words) for _ in range(rnd.randint(5, 80))]
        bad = i % 6 == 0
        if bad:
            for _ in range(rnd.randint(1, 4)):
                t[rnd.randrange(len(t))] = rnd.choice(["zorg", "vexil", "Zorgen", "kwarp"])
        rows.append((i, " ".join(t)))
        lab.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    truth = {i: y for i, _, y in lab}
    model, threshold = toxicity.fit(docs, labels(spark, lab + [(0, None, None), (None, 1, 1)]))
    out = toxicity.score(docs, model, threshold).withColumn("held", toxicity.fold() == 0).collect()
    held = [r for r in out if r.held]
    assert len(held) > 200 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.98
    rest = {(r.doc_id, r.predicted) for r in toxicity.score(edge, model, threshold).collect()}
    assert all(p == 0 for _, p in rest) and len(toxicity.score(edge, model, threshold).filter("score < 0 or score > 1").collect()) == 0
    none = toxicity.fit(docs, labels(spark, []))
    assert toxicity.score(docs, *none).filter("predicted = 1").count() == 0
    assert toxicity.remove_toxic(nothing, labels(spark, lab)).count() == 0
    assert toxicity.remove_toxic(edge, labels(spark, lab)).columns == edge.columns


# 6 ------------------------------------------------------------------------
def brute_lm(docs, trusted):
    toks = {i: re.findall(ALNUM, fold(t)) for i, t in docs}
    vocab = {w for t in toks.values() for w in t}
    size, total = len(vocab) + 1, sum(map(len, toks.values()))

    def model(ids):
        uni, big, ctx = collections.Counter(), collections.Counter(), collections.Counter()
        for i in ids:
            for a, b in zip(["<s>", *toks[i]], toks[i]):
                uni[b] += 1
                big[a, b] += 1
                ctx[a] += 1
        return uni, big, ctx, sum(uni.values())

    models, shared = [model(trusted), model(list(toks))], None
    shared = {k for k, n in models[1][1].items() if n >= lm_score.MIN_SHARE * total}
    kept = collections.defaultdict(list)
    for a, b in shared:
        kept[a].append(b)

    def loss(m, words):
        uni, big, ctx, n = m
        out = 0.0
        for a, b in zip(["<s>", *words], words):
            p1 = (uni[b] + 1) / (n + size)
            direct = lambda x: max(big[a, x] - lm_score.DISCOUNT, 0) / max(ctx[a], 1)  # noqa: B023, E731
            rest = max(1 - sum(direct(x) for x in kept[a]), 1e-9)
            out -= math.log(direct(b) + rest * p1) if (a, b) in shared else math.log(rest * p1)
        return out / max(1, len(words))

    return {i: (len(w), loss(models[0], w), loss(models[1], w)) for i, w in toks.items()}


def test_lm_score(spark, edge, nothing):
    rows = [(1, "a b a b c"), (2, "a b d"), (3, "x y z x y"), (4, None), (5, "A b, a B!")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = labels(spark, [(1, 1, 0), (2, 1, 0), (3, 0, 0), (None, 1, 1)])
    got = lm_score.score(docs, lm_score.fit(docs, lab)).collect()
    want = brute_lm(rows, [1, 2])
    for r in got:
        assert (r.n_tokens, r.loss_target, r.loss_background) == pytest.approx(want[r.doc_id])
        assert r.score == pytest.approx(want[r.doc_id][1] - want[r.doc_id][2])
    score = {r.doc_id: r.score for r in got}
    assert score[1] < score[3] and score[4] == 0
    out = lm_score.score(edge, lm_score.fit(edge, lab))
    assert out.count() == edge.count() and out.filter("score is null").count() == 0
    assert lm_score.score(nothing, lm_score.fit(nothing, lab)).count() == 0
    assert lm_score.score(edge, lm_score.fit(edge, labels(spark, []))).count() == edge.count()


def test_lm_score_keeps_rare_bigrams(spark, monkeypatch):
    """Nothing below the share of the broadcast part is lost, nor new bigrams."""
    rows = [(i, f"the cat sat on the mat a{i} b{i % 3} c{i % 7}") for i in range(30)] + [(50, None), (3, "the cat sat on the mat a3 b0 c3")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = labels(spark, [(i, 1, 0) for i in range(5)])
    more = [*rows[:30], (3, rows[31][1]), (50, None)]
    want = {i: w for (i, _), w in zip(more, [brute_lm([(k, t) for k, (_, t) in enumerate(more)], [0, 1, 2, 3, 4, 30])[k] for k in range(32)])}
    monkeypatch.setattr(lm_score, "MIN_SHARE", 0.05)  # only the words and bigrams of all texts
    model = lm_score.fit(docs, lab)
    got = lm_score.score(docs, model).collect()
    assert len(got) == 32 and model["pairs"].count() > 70 and len(model["ready"].value[0]) < 10
    for r in got:
        assert (r.n_tokens, r.loss_target, r.loss_background) == pytest.approx(want[r.doc_id])
    new = lm_score.score(spark.createDataFrame([(1, "mat zz cat"), (2, rows[1][1])], docs.schema), model).collect()
    monkeypatch.setattr(lm_score, "MIN_SHARE", 0)
    same = lm_score.score(spark.createDataFrame([(1, "mat zz cat"), (2, rows[1][1])], docs.schema), lm_score.fit(docs, lab)).collect()
    for a, b in zip(sorted(new), sorted(same)):
        assert (a.n_tokens, a.loss_target, a.loss_background) == pytest.approx((b.n_tokens, b.loss_target, b.loss_background))
        assert a.loss_background > 0


# 8 ------------------------------------------------------------------------
PII = ["mail a.b+c@x-y.co.uk, or a@b.c@d.e f@g", "x@y.z_w@v.u", "ip 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255 0000256.1.1.1", "card 4111 1111 1111 1111 and 4111-1111-1111-1112",
       "+1 (743) 555-3824, +12, +1 234 (567) 89 0 x +44 1 ", "é+49 30 1234567é 東1.1.1.1京", "9" * 30_000 + "." * 10, "+1" + " " * 20_000, "a" * 50_000 + "@", "(" * 3000,
       "1" * 16, None, "", "4111111111111111", "a@b.c" * 500]


def test_pii_base(spark, nothing):
    docs = spark.createDataFrame(list(enumerate(PII)) + [(3, PII[3]), (None, PII[0])], "doc_id bigint, text string")
    rows = pii.entities(docs).collect()
    assert len(rows) == len(PII) + 2
    for r in rows:
        want = brute_base(PII[0 if r.doc_id is None else r.doc_id] or "")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in want) for k in pii.KINDS)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and set(filter(None, text.split(","))) <= set(r.spans.split(","))
    assert pii.entities(nothing).count() == 0 and pii.mask(nothing).count() == 0


def test_pii_discovers_by_context(spark):
    rows = [(i, f"please call office number +1 (555) 555-{1000 + i} now") for i in range(20)]
    rows += [(100, "please call office number (555) 777-1234 now"), (101, "room (555) 777-9999 is free"), (102, "later (555) 777-1234 again"),
             (103, "please call office number 12 now")]
    rows += [(200 + i, f"room {1000000 + i} is free") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in pii.entities(docs).collect()}
    assert got[100] == "phone:26:40" and got[102] == "phone:6:20"  # the same instance elsewhere
    assert got[101] == "" and got[103] == "" and got[205] == ""
    masked = {r.doc_id: r.text for r in pii.mask(docs.withColumn("n_chars", docs.doc_id)).collect()}
    assert masked[100] == "please call office number <PHONE> now" and masked[3] == masked[100] and masked[101] == rows[21][1]


def test_pii_discovers_inside_runs(spark):
    """Identifiers beside other numbers, and beside base entities."""
    rows = [(i, f"please call office number +1 (555) 555-{1000 + i} now, pay by card {c} now") for i, c in enumerate(CARDS)]
    rows += [(100, "please call office number 555-1234, 555-9999 now"), (101, "call office number 555-777-1111 555-777-2222 555-777-3333 x"),
             (102, f"see {CARDS[0]} {CARDS[1]} there"), (103, "write to a@b.co 555-1234 now"), (104, "see 555-777-1111 there 555-9999")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: set(filter(None, r.spans.split(","))) for r in pii.entities(docs).collect()}
    assert got[100] == {"phone:26:34"}
    assert got[101] == {"phone:19:31"} and got[104] == {"phone:4:16"}
    assert got[102] == {"card:4:20", "card:21:37"}  # 32 digits are no card, but both occur elsewhere
    assert got[103] == {"email:9:15", "phone:16:24"}
    masked = {r.doc_id: r.text for r in pii.mask(docs).collect()}
    assert masked[102] == "see <CARD> <CARD> there" and masked[103] == "write to <EMAIL> <PHONE> now"


CARDS = [f"{n}{next(d for d in range(10) if sum(int(x) if k % 2 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(f'{n}{d}')) % 10 == 0)}"
         for n in range(411111111111000, 411111111111012)]


def test_pii_rounds_go_on(spark):
    """A chain of patterns: each link's instances are known by the one before."""
    step = ["alpha one", "beta two", "gamma three", "delta four", "epsilon five"]
    rows = [(99, "alpha one +1 555 555 9999 .")]
    for k, words in enumerate(step):  # four seeds, one instance of the link before, and a new one
        rows += [(10 * k + i, f"{words} +1 555 555 {k}{i}00 .") for i in range(4)]
        rows += [(10 * k + 4 + j, f"{words} 555-{k + 1 - j}{k + 1 - j}0-1234 .") for j in range(2) if k + 1 - j]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {r.doc_id: r.spans for r in pii.entities(docs).collect()}
    assert all(spans.values()), spans


def test_pii_text_full_of_entities(spark):
    """More matches than one block of positions holds, one text and several rows."""
    t = "mail a1@b.co\nnumber 4111 1111 1111 1111 x 1.2.3.4\n" * 600 + "7\n" * 900
    docs = spark.createDataFrame([(1, t), (2, t[5:]), (3, "7 " * 5000)], "doc_id bigint, text string")
    texts = {1: t, 2: t[5:], 3: "7 " * 5000}
    for r in pii.entities(docs).collect():
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_base(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)
    seeds = {r.seed: r["count"] for r in pii.occurrences(pii.base_entities(docs.filter("doc_id = 1"))).groupBy("seed").count().collect()}
    assert seeds[0] == 600 and seeds[2] == 600 and seeds[1] == 600 and seeds[None] == 900


def test_pii_mask_of_overlapping_kinds(spark):
    """Entities of different kinds that share characters go whole."""
    rows = [(1, "é call +1.2.3.4 5678 or a@b.co"), (2, "at 10.1.2.3.a@b.co, yes"), (3, "+49 10.0.0.1 4111 1111 1111 1111"),
            (4, "x 1.2.3.4 y a@b.co"), (1, "é call +1.2.3.4 5678 or a@b.co"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.text) for r in pii.mask(docs).collect()), key=repr)
    assert not any(brute_base(t) for _, t in got if t)
    assert got[:2] == [(1, "é call <PHONE> or <EMAIL>")] * 2
    # once the address is gone, the digits after it are a card number of their own
    assert got[2:] == [(2, "at <IP>, yes"), (3, "+49 <IP> <CARD>"), (4, "x <IP> y <EMAIL>"), (5, None)]


CLASHING = ["score", "predicted", "_evidence", "_row", "_id", "_h", "_cut", "n_words", "n_hit", "hit_runs", "hit_items", "contaminated",
            "whole", "cut", "cut_bucket", "docs", "copies", "_key", "_u"]


def test_filters_keep_clashing_columns(spark):
    """Columns named like an operator's own come through unchanged."""
    rows = [(i, f"word{i} plain text a{i}@b.co " + "x " * i, "s", 1, *[f"{c}{i}" for c in CLASHING]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHING))
    none = spark.createDataFrame([], "item_id bigint, text string")
    labels_ = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    want = key(docs.select("doc_id", *CLASHING).collect())
    for out in (toxicity.remove_toxic(docs, labels_), decontaminate.remove_documents(docs, none), decontaminate.remove_spans(docs, none), pii.mask(docs)):
        assert out.columns == docs.columns and key(out.select("doc_id", *CLASHING).collect()) == want
    kept = simhash.keep_one(docs)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns and key(kept.select("doc_id", *CLASHING).collect()) == [r for r in want if r.doc_id in ids]
    mixed = mixing.mixture(docs)
    assert mixed.columns[:len(docs.columns)] == docs.columns
    assert set(mixed.select("doc_id", *CLASHING).collect()) <= set(want)


def test_pii_mask_keeps_the_rest(spark, edge):
    out = pii.mask(edge)
    assert out.columns == edge.columns and key(items(out)) == key(items(edge))
    docs = spark.createDataFrame(list(enumerate(PII)), "doc_id bigint, text string")
    for r in pii.mask(docs).collect():
        if PII[r.doc_id] is None:
            assert r.text is None
        else:
            assert not [x for x in brute_base(r.text) if x[0] in ("email", "ip", "card")]


# 10 -----------------------------------------------------------------------
def brute_quality(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit, seen, dup = set(), set(), 0
    for i in range(len(w) - 4):
        if wins[tuple(w[i:i + 5])] > 1:
            hit |= set(range(i, i + 5))
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit)


def test_quality(spark, edge, nothing):
    more = spark.createDataFrame([(50, "a b\n a b\na b\na b\n\n \n \n"), (51, "x#y *$%&|<> é東\n" * 7), (52, "p q r s t " * 9), (53, "p q r s t u p q r s t")], "doc_id bigint, text string")
    docs = edge.select("doc_id", "text").unionByName(more)
    lab = labels(spark, [(i, 1, 0) for i in (6, 7, 8, 9, 10)] + [(52, 0, 0), (None, 1, 0), (53, None, None)])
    texts = collections.defaultdict(list)
    for i, t in items(docs):
        texts[i].append(brute_quality(t))
    for r in quality.assess(docs, lab).collect():
        base = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert base in texts[r.doc_id]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.assess(nothing, lab).count() == 0
    assert quality.assess(edge, labels(spark, [])).filter("kept = base_failed").count() == 0


def test_quality_scores_what_differs_from_trusted(spark):
    import random

    rnd = random.Random(1)
    good = [" ".join(rnd.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rnd.randrange(40)) for _ in range(60)) for _ in range(300)]
    bad = [" ".join("SPAM" + str(rnd.randrange(300)) + "!" for _ in range(60)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id bigint, text string")
    lab = labels(spark, [(i, int(i < 300), 0) for i in range(360) if i % 3])
    rows = quality.assess(docs, lab).collect()
    assert sum(r.kept for r in rows if r.doc_id >= 300) == 0
    assert sum(r.kept for r in rows if r.doc_id < 300) >= 295


def test_very_long_text(spark):
    """One text of many slices gives the same as brute force."""
    t = LONG * 3
    docs = spark.createDataFrame([(1, t)], "doc_id bigint, text string")
    r = quality.assess(docs, labels(spark, [])).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(t)


def test_long_words_are_read_whole(spark):
    """Words that differ in swapped parts of 1,024 bytes, or only far behind."""
    a, b = "x" * 1024, "y" * 1024
    words = [a + b + str(k) for k in range(5)]
    swapped = [b + a + str(k) for k in range(5)]
    far = ["q" * 600_000 + str(k) for k in range(10)]
    texts = [" ".join(words + swapped), " ".join(words + words), " ".join(far), " ".join(far[:5] + far[:5]), " ".join(far[:5] + far[5:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in quality.assess(docs, labels(spark, [])).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(t)
    assert [rows[i].n_repeat_words for i in range(5)] == [0, 10, 0, 10, 0]


def test_windows_of_one_hash_are_told_apart(spark, monkeypatch):
    import numpy as np

    from invdex.llm import words as W

    texts = ["a b c d e f a b c d e g h i j k l m", "n o p q r n o p q r n o p q r", "only six words are in here", ""]
    monkeypatch.setattr(W, "word_hashes", lambda buf, s, e, fold, **k: np.ones(len(s), np.uint64))
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = quality._Features(np.zeros(1 << quality.BITS))._slice(len(texts), np.frombuffer("".join(texts).encode(), np.uint8), off)
    assert got[4].tolist() == [brute_quality(t)[4] for t in texts]


def test_keep_one_of_linked_documents_without_ids(spark):
    text = BASE + " tail"
    rows = [(None, BASE), (None, text), (None, BASE.upper()), (None, "quite another text altogether, as it is"), (7, "a third one, with an id of its own")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    near = simhash.near_duplicates(df).where("doc_id IS NULL").select("fp", "root").distinct().collect()
    assert len(near) == 3 and len({r.root for r in near}) == 2  # two fingerprints linked, one alone
    kept = [r.text for r in simhash.keep_one(df).collect()]
    assert len(kept) == 3 and len({BASE, text, BASE.upper()} & set(kept)) == 1


def test_pii_context_is_whole_words(spark):
    """Two long words with one common end share no pattern; a word that stands
    before identifiers often enough has one, however long it is."""
    tail = "t" * 60

    def spans(words):
        rows = [(i, f"{w}{tail} +1 555 010 20{i:02d} end") for i, w in enumerate(words)]
        rows += [(90, f"three{tail} 555-0199-77 end"), (91, f"one{tail} 555-0199-78 end")]
        return {r.doc_id: r.spans for r in pii.entities(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}

    mixed = spans(["one"] * 3 + ["two"] * 3)
    assert mixed[90] == mixed[91] == ""
    known = spans(["one"] * 6)
    assert known[90] == "" and known[91] == "phone:64:75"
