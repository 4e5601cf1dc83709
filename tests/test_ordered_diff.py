"""Ordered diff of result lists against a plain longest common subsequence."""

import random
from collections import defaultdict

import pytest

from invdex.operators import ordered_diff as D

SCHEMA = "query_id bigint, rank bigint, line string"


def table(spark, lists: dict):
    rows = [(q, 10 * i + 3, line) for q, lines in lists.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def run(spark, actual: dict, expected: dict):
    out = defaultdict(list)
    for r in D.ordered_diff(table(spark, actual), table(spark, expected)).collect():
        out[r.query_id].append((r.side, r.line, r.rank_actual, r.rank_expected))
    return out


def brute_kept(values):
    """Length of the longest increasing subsequence, squarely."""
    best = []
    for i, v in enumerate(values):
        best.append(1 + max((best[j] for j in range(i) if values[j] < v), default=0))
    return max(best, default=0)


def check(actual, expected, got):
    """Unpaired lines are exact; what is left after the moved lines keeps its
    order on both sides, and no longer run does."""
    def numbered(lines):
        seen = defaultdict(int)
        out = {}
        for i, line in enumerate(lines):
            out[line, seen[line]] = 10 * i + 3
            seen[line] += 1
        return out

    a, e = numbered(actual), numbered(expected)
    assert sorted(x[2] for x in got if x[0] == "+") == sorted(a[k] for k in a.keys() - e.keys())
    assert sorted(x[3] for x in got if x[0] == "-") == sorted(e[k] for k in e.keys() - a.keys())
    pairs = sorted((a[k], e[k]) for k in a.keys() & e.keys())
    moved = {(x[2], x[3]) for x in got if x[0] == "moved"}
    assert moved <= set(pairs) and len(moved) == sum(x[0] == "moved" for x in got)
    stay = [y for x, y in pairs if (x, y) not in moved]
    assert stay == sorted(stay) and len(stay) == brute_kept([y for _, y in pairs])


def cases():
    rnd = random.Random(5)
    base = [f"d{i}" for i in range(60)]
    swapped = base[:]
    swapped[10], swapped[11] = swapped[11], swapped[10]
    far = base[:]
    far.insert(50, far.pop(3))
    shuffled = rnd.sample(base, 60)
    repeated = [rnd.choice("abc") for _ in range(40)]
    return {1: (base, base), 2: (swapped, base), 3: (far, base), 4: (shuffled, base), 5: (base[::-1], base),
            6: (base[:20], base[10:]), 7: (repeated, rnd.sample(repeated, 35) + ["z"]), 8: ([], base[:5]), 9: (base[:5], []),
            10: ([None, "x", None], ["x", None, None]), 11: (base[30:] + base[:30], base)}


@pytest.mark.parametrize("stride, window", [(1 << 16, 5_000_000), (4, 5_000_000), (4, 0)])
def test_against_brute_force(spark, monkeypatch, stride, window):
    monkeypatch.setattr(D, "STRIDE", stride)
    monkeypatch.setattr(D, "RANK_WINDOW_MAX", window)
    lists = cases()
    got = run(spark, {q: x for q, (x, _) in lists.items()}, {q: y for q, (_, y) in lists.items()})
    for q, (x, y) in lists.items():
        check(x, y, got[q])
    assert got[1] == []
    assert [(s, line) for s, line, _, _ in got[2]] in ([("moved", "d10")], [("moved", "d11")])
    assert [(s, line) for s, line, _, _ in got[3]] == [("moved", "d3")]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert D.ordered_diff(none, none).count() == 0

