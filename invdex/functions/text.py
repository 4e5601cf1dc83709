"""Column expressions for text: tokenising, naming, query parsing and the
import of old plain-text posting lines. All are built-in Spark SQL
functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Token separators: the six ASCII whitespace characters of the C locale
# (space, tab, newline, vertical tab, form feed, carriage return).
# U+0085 and U+00A0 are NOT separators.
WHITESPACE_CLASS = r"[ \t\n\x0B\f\r]+"
# Text printed for a query without hits.
NO_RESULTS = "no results found"
# Separator between the block (directory) and the file in a document name.
NAME_SEP = "/"


def tokens(text: Column | str) -> Column:
    """Whitespace tokens in document order (empty strings removed)."""
    col = F.col(text) if isinstance(text, str) else text
    # array_remove is a native expression (a lambda filter would be interpreted)
    return F.array_remove(F.split(col, WHITESPACE_CLASS), "")


def distinct_tokens(text: Column | str) -> Column:
    """Tokens of one document, each once, in order of first occurrence.

    ``array_distinct`` keeps the first occurrence of every value, so the
    position of a token in this array orders tokens exactly as their first
    positions in the text do."""
    return F.array_distinct(tokens(text))


def doc_name(block: Column | str, file: Column | str) -> Column:
    """``block/file``."""
    b = F.col(block) if isinstance(block, str) else block
    f = F.col(file) if isinstance(file, str) else file
    return F.concat_ws(NAME_SEP, b, f)


def query_terms(query_text: Column | str) -> Column:
    """The distinct terms of one query (AND is idempotent)."""
    return F.array_distinct(tokens(query_text))


def parse_posting_line(line: Column | str):
    """P5: ``"term_id:d1,d2,..."`` -> (term_id bigint, doc ids array<bigint>)."""
    col = F.col(line) if isinstance(line, str) else line
    parts = F.split(col, ":", 2)
    term_id = parts.getItem(0).cast("bigint")
    ids = F.split(parts.getItem(1), ",").cast("array<bigint>")
    return term_id, ids
