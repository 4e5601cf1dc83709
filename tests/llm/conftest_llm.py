"""Fixtures and brute-force helpers of these tests (the session comes from the
parent conftest)."""

import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
BASE = " ".join(f"Word{i}" for i in range(400))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n_words string, taken string, fp string, kept string"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls everywhere, empty and very long texts, copies, near copies, repeated
    rows, and extra columns that clash with result columns."""
    texts = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"), (5, "two WORDS", "b"), (6, BASE, "c"), (7, BASE.upper(), "c"),
             (8, BASE + " tail", None), (9, LONG, "d"), (None, "no id here " + BASE, "a"), (6, BASE, "c"), (10, LONG + " end", "d"),
             (11, "Straße 東京 Émile é", "e"), (12, "a\x00b c", "e"), (None, None, None)]
    rows = [(i, t, None, s, None if t is None else len(t), "x", "y", "z", "f", "k") for i, t, s in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def items(df):
    """doc_id -> sorted list of texts, of the input rows."""
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def brute_base(t):
    """The four base patterns, plainly."""
    import re

    def luhn(s):
        d = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(x - 9 if x > 9 else x for x in d) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]
