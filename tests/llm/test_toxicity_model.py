"""Toxicity (5) against a plain-Python model of its smoothing."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from invdex.llm import toxicity
from invdex.llm import words as W

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slot_of(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(W.word_hashes(raw, np.array([0]), np.array([len(raw)]), W.FOLD)[0] % np.uint64(toxicity.TABLE))


def brute_ratios(docs):
    """{word: ratio}, {stem: ratio}, {slot: faint ratio} from [(text, label)]."""
    n = {c: collections.Counter() for c in (0, 1)}
    for text, y in docs:
        n[y].update(set(words_of(text)))
    vocab, d = set(n[0]) | set(n[1]), toxicity.DISCOUNT
    stem = {w: w[:toxicity.STEM] for w in vocab}
    kinds = collections.Counter(stem.values())

    def log_p(c):
        own, mine = collections.Counter(), collections.Counter()
        for w in n[c]:
            own[stem[w]] += n[c][w]
            mine[stem[w]] += 1
        total = sum(own.values())
        ps = {s: math.log((max(own[s] - d, 0) + d * len(mine) * kinds[s] / len(vocab)) / total) for s in kinds}
        pw = {w: math.log((max(n[c][w] - d, 0) + d * mine[stem[w]] / kinds[stem[w]]) / own[stem[w]] if own[stem[w]] else 1 / kinds[stem[w]]) for w in vocab}
        return ps, pw

    (st, wt), (so, wo) = log_p(1), log_p(0)
    stems = {s: st[s] - so[s] for s in kinds}
    ratio = {w: stems[stem[w]] + wt[w] - wo[w] for w in vocab}
    sums = collections.defaultdict(lambda: [0.0, 0])
    for w, r in ratio.items():
        if abs(r) < toxicity.NEUTRAL:
            k = n[0][w] + n[1][w]
            s = sums[slot_of(w)]
            s[0], s[1] = s[0] + r * k, s[1] + k
    return ratio, stems, {k: a / b for k, (a, b) in sums.items()}


def brute_evidence(text, model):
    ratio, stems, slots = model
    out = 0.0
    for w in words_of(text):
        s, faint = stems.get(w[:toxicity.STEM]), toxicity.FAINT * slots.get(slot_of(w), 0.0)
        strong = s is not None and abs(s) >= toxicity.NEUTRAL
        if w in ratio and abs(ratio[w]) >= toxicity.NEUTRAL:
            out += ratio[w]
        elif strong:
            out += toxicity.FAINT * ratio[w] if w in ratio else s
        else:
            out += faint
    return out / max(1, len(words_of(text)))


@pytest.fixture(scope="module")
def made():
    rnd = random.Random(8)
    plain = [f"{a}{b}" for a in ("ba", "ku", "mo", "städt", "語", "日本語の文章", "x1") for b in ("", "la", "rik", "ón", "です")]
    bad = ["zorg", "Zorgen", "zorgish", "毒毒毒毒毒語", "毒毒毒毒毒文", "vex"]
    rows, lab = [], []
    for i in range(400):
        t = [rnd.choice(plain) for _ in range(rnd.randint(3, 40))]
        y = int(i % 4 == 0)
        for _ in range(rnd.randint(1, 5) if y else int(i % 50 == 1)):
            t.insert(rnd.randrange(len(t)), rnd.choice(bad))
        rows.append((i, rnd.choice([" ", ", ", "\n"]).join(t)))
        lab.append((i, y))
    rows += [(1000, None), (1001, ""), (1002, "!? ..."), (1003, "zorgulon zorgulon ba"), (1004, "new words only"), (1005, "ZORG " * 3000), (None, "zorg")]
    return rows, lab


@pytest.mark.parametrize("neutral", [3.5, 1.5])
def test_scores_equal_the_plain_model(spark, made, monkeypatch, neutral):
    monkeypatch.setattr(toxicity, "NEUTRAL", neutral)
    monkeypatch.setattr(toxicity, "TABLE", 16)  # slots that several words share
    rows, lab = made
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(lab, "doc_id bigint, toxic int")
    model, threshold = toxicity.fit(docs, labels)
    part, texts = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in lab}, dict(rows)
    first = brute_ratios([(texts[i], y) for i, y in lab if part[i] >= 2])
    seen = [(brute_evidence(texts[i], first), y) for i, y in lab if part[i] == 1]
    assert threshold == pytest.approx(toxicity.best_threshold(np.array([x for x, _ in seen]), np.array([y for _, y in seen])))
    want = brute_ratios([(texts[i], y) for i, y in lab if part[i] >= 1])
    for r in toxicity.score(docs, model, threshold).collect():
        x = brute_evidence(r.text, want)
        z = 4 * (x - threshold) / threshold
        assert r.score == pytest.approx((1 + z / (1 + abs(z))) / 2, rel=1e-4)
        assert r.predicted == int(r.score >= 0.5)


def test_stems_are_characters(made):
    texts = ["日本語の文章 a städtón", "", "abcdefg 毒毒"]
    raw = [t.encode() for t in texts]
    buf, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    s, e, _ = W.spans(buf, off, W.ALNUM)
    got = [bytes(buf[a:b]).decode() for a, b in zip(s, toxicity.stem_ends(buf, s, e))]
    assert got == [w[:toxicity.STEM] for t in texts for w in words_of(t)]


def test_few_ties_and_held_out_rows(spark):
    """On the given labels: documents without strong expressions are ordered too."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.score(docs.select("doc_id", "text"), *toxicity.fit(docs, labels)).withColumn("held", toxicity.fold() == 0)
    held = out.filter("held").join(labels.select("doc_id", "toxic"), "doc_id").filter("toxic is not null").toPandas()
    # one score for one text: only texts are compared
    texts = held.drop_duplicates("text")
    assert texts["score"].value_counts().max() <= max(2, 0.05 * len(texts))
    assert (held["predicted"] == held["toxic"]).mean() > 0.9
