"""Toxicity (5): the query and the pipeline's stage score by every word's own ratio."""

import itertools
import zlib

import numpy as np
import pytest
from test_toxicity_model import brute_ratios, made, words_of  # noqa: F401

from invdex.llm import toxicity
from invdex.llm import words as W


def own_evidence(text, model):
    ratio, stems, _ = model
    found = [ratio.get(w, stems.get(w[:toxicity.STEM], 0.0)) for w in words_of(text)]
    return sum(r if abs(r) >= toxicity.NEUTRAL else toxicity.FAINT * r for r in found) / max(1, len(found))


def sharing(bits=18):
    """Two words whose hashes share their last bits."""
    seen = {}
    for word in (f"n{k}" for k in itertools.count()):
        raw = np.frombuffer(word.encode(), np.uint8)
        h = int(W.word_hashes(raw, np.array([0]), np.array([len(raw)]), W.FOLD)[0]) % (1 << bits)
        if h in seen:
            return seen[h], word
        seen[h] = word


@pytest.mark.parametrize("share", [1e-6, 0.02, 2.0])  # all broadcast, some, none
def test_every_word_has_its_own_ratio(spark, made, monkeypatch, tmp_path, share):  # noqa: F811
    monkeypatch.setattr(toxicity, "SHARE", share, raising=False)
    rows, lab = made
    a, b = sharing()
    y = dict(lab)
    more = {i: f" {a}" * (i % (3 if y[i] else 30) == (0 if y[i] else 1)) + f" {b}" * (i % (24 if y[i] else 3) == (4 if y[i] else 0)) for i in y}
    rows = [(i, x + more[i] if i in y else x) for i, x in rows]  # a is faintly toxic, b faintly ordinary
    rows += [(1003, dict(rows)[1003]), (1006, a), (1007, b)]  # 1003 comes twice
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame(lab, "doc_id bigint, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    part, texts = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in lab}, dict(rows)
    with monkeypatch.context() as m:
        m.setattr(toxicity, "TABLE", 1)  # its slots aren't used here
        first = brute_ratios([(texts[i], y) for i, y in lab if part[i] >= 2])
        model = brute_ratios([(texts[i], y) for i, y in lab if part[i] >= 1])
    seen = [(own_evidence(texts[i], first), y) for i, y in lab if part[i] == 1]
    t = toxicity.best_threshold(np.array([x for x, _ in seen]), np.array([y for _, y in seen]))
    want = []
    for i, text in rows:
        z = 4 * (own_evidence(text, model) - t) / t
        want.append((i, (1 + z / (1 + abs(z))) / 2))
    got = toxicity.q_op5_toxicity(spark, str(tmp_path)).collect()
    order = lambda r: (r[0] is None, r[0] or 0)
    got, want = sorted(((r.doc_id, r.score) for r in got), key=order), sorted(want, key=order)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [x for _, x in got] == pytest.approx([x for _, x in want], rel=1e-9)
    assert dict(got)[1006] > dict(got)[1007] + 1e-6
    wide = docs.selectExpr("text", "doc_id", "length(text) AS score", "'x' AS _evidence")
    left = toxicity.remove_toxic(wide, labels)
    assert left.columns == wide.columns
    ok = {i for i, x in want if x < 0.5}
    kept = sorted((r for r in left.collect()), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))
    assert [(r.doc_id, r.text, r.score) for r in kept] == sorted(
        ((i, x, None if x is None else len(x)) for i, x in rows if i in ok), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_one_class_or_no_rows(spark, nothing, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARE", 2.0, raising=False)
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, toxic int")
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "doc_id bigint, text string")
    assert toxicity.remove_toxic(docs, labels).count() == 3
    assert toxicity.remove_toxic(nothing, labels).count() == 0
