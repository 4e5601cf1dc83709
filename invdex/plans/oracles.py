"""DuckDB oracles: for each registered query the same result in plain SQL
over the pre-registered views (documents, benchmark, conversations, ...).

They are written the direct way (global row_number, whole lists, string
aggregation) and share nothing with the Spark plans but the semantics."""

from __future__ import annotations

from .workloads import BENCHMARK_QUERIES_SQL, CONVERSATION_QUERIES_SQL, dev_queries_sql

WS = r"'[ \t\n\x0B\f\r]+'"
SEG = 64

DOCS = """docs AS (
  SELECT row_number() OVER (ORDER BY block, file) AS did, block, file, block || '/' || file AS doc_name, text
  FROM (SELECT coalesce(source, '') AS block, CAST(doc_id AS VARCHAR) AS file, coalesce(text, '') AS text FROM documents))"""

TOKS = f"""raw AS (
  SELECT did, block, unnest(a) AS token, generate_subscripts(a, 1) AS rp
  FROM (SELECT did, block, regexp_split_to_array(text, {WS}) AS a FROM docs)),
toks AS MATERIALIZED (
  SELECT did, block, token, row_number() OVER (PARTITION BY did ORDER BY rp) - 1 AS pos
  FROM raw WHERE token <> '')"""

WORDS = """firsts AS (
  SELECT token, did, pos FROM toks
  QUALIFY row_number() OVER (PARTITION BY token ORDER BY did, pos) = 1),
words AS (
  SELECT row_number() OVER (ORDER BY did, pos) - 1 AS term_id, token FROM firsts),
dfs AS (SELECT token, count(DISTINCT did) AS df FROM toks GROUP BY token)"""

POST = """post AS (
  SELECT DISTINCT w.term_id, t.did FROM toks t JOIN words w USING (token))"""

GAPS = f"""gp AS (
  SELECT term_id, did, (did - 1) // {SEG} AS seg,
         did - coalesce(lag(did) OVER (PARTITION BY term_id ORDER BY did), 0) AS gap
  FROM post)"""

VBHEX = """CASE
  WHEN gap < 128 THEN printf('%02x', gap + 128)
  WHEN gap < 16384 THEN printf('%02x%02x', gap // 128, gap % 128 + 128)
  WHEN gap < 2097152 THEN printf('%02x%02x%02x', gap // 16384, (gap // 128) % 128, gap % 128 + 128)
  WHEN gap < 268435456 THEN printf('%02x%02x%02x%02x', gap // 2097152, (gap // 16384) % 128,
                                   (gap // 128) % 128, gap % 128 + 128)
  ELSE printf('%02x%02x%02x%02x%02x', gap // 268435456, (gap // 2097152) % 128, (gap // 16384) % 128,
              (gap // 128) % 128, gap % 128 + 128) END"""

GAMMA = "repeat('1', length(bin(gap)) - 1) || '0' || substr(bin(gap), 2)"

GAMMA_LISTS = [f"gb AS (SELECT term_id, seg, string_agg({GAMMA}, '' ORDER BY did) AS bits FROM gp GROUP BY 1, 2)",
               "gpad AS (SELECT term_id, seg, (8 - length(bits) % 8) % 8 AS pad, bits FROM gb)",
               "gfull AS (SELECT term_id, seg, pad, repeat('0', pad) || bits AS pb FROM gpad)"]
GAMMA_HEX = ("list_aggr([printf('%02x', ('0b' || substr(pb, i * 8 + 1, 8))::INTEGER) FOR i IN range(length(pb) // 8)], "
             "'string_agg', '')")


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _index(*extra: str) -> str:
    return _with(DOCS, TOKS, WORDS, POST, *extra)


def _qterms(qsql: str) -> list[str]:
    return [
        f"q AS {qsql}",
        f"""qt AS (
  SELECT DISTINCT query_id, token FROM (
    SELECT query_id, unnest(regexp_split_to_array(query_text, {WS})) AS token FROM q)
  WHERE token <> '')""",
        "nq AS (SELECT query_id, count(*) AS n FROM qt GROUP BY query_id)",
        """lk AS (
  SELECT qt.query_id, qt.token, w.term_id, d.df FROM qt
  LEFT JOIN words w USING (token) LEFT JOIN dfs d USING (token))""",
    ]


def _hits() -> list[str]:
    return [
        """dt AS (SELECT DISTINCT did, token FROM toks)""",
        """m AS (SELECT qt.query_id, dt.did, count(*) AS c FROM qt JOIN dt USING (token) GROUP BY 1, 2)""",
        """hits AS (SELECT m.query_id, m.did FROM m JOIN nq USING (query_id) WHERE m.c = nq.n)""",
    ]


def _search(qsql: str) -> str:
    return _with(DOCS, TOKS, *_qterms(qsql), *_hits(), """res AS (
  SELECT h.query_id, d.doc_name FROM hits h JOIN docs d USING (did)
  UNION ALL
  SELECT query_id, 'no results found' FROM nq WHERE query_id NOT IN (SELECT query_id FROM hits))""") + \
        """SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY doc_name) AS rank, doc_name FROM res"""


QUERY_FILE_SQL = """(SELECT row_number() OVER (ORDER BY query_id, i) AS query_id, line AS query_text FROM (
  SELECT query_id, unnest(a) AS line, generate_subscripts(a, 1) AS i
  FROM (SELECT query_id, string_split(query_text, chr(10)) AS a FROM """ + BENCHMARK_QUERIES_SQL + """)))"""

ORACLES: dict[str, str] = {
    "corpus_scan": "SELECT source AS block, CAST(doc_id AS VARCHAR) AS file, CAST(strlen(text) AS BIGINT) AS n_bytes "
                   "FROM documents",
    "file_count": "SELECT count(*) AS file_count FROM documents",
    "doc_dict": _with(DOCS) + "SELECT did, doc_name FROM docs",
    "word_dict": _with(DOCS, TOKS, WORDS) + "SELECT term_id, token FROM words",
    "tokenize": _with(DOCS, TOKS) + "SELECT did, pos, token FROM toks",
    "occurrences": _with(DOCS, TOKS, WORDS) + "SELECT t.did, t.pos, w.term_id FROM toks t JOIN words w USING (token)",
    "postings": _index() + "SELECT term_id, did FROM post",
    "document_frequency": _index() + "SELECT term_id, count(*) AS df FROM post GROUP BY term_id",
    "segment_lists": _index() + f"SELECT term_id, (did - 1) // {SEG} AS seg, "
                                "string_agg(CAST(did AS VARCHAR), ',' ORDER BY did) AS doc_ids FROM post GROUP BY 1, 2",
    "block_postings": _index("bp AS (SELECT DISTINCT t.block, w.term_id, t.did FROM toks t JOIN words w USING (token))")
    + f"""SELECT block, term_id, (did - 1) // {SEG} AS seg,
  string_agg(CAST(did AS VARCHAR), ',' ORDER BY did) AS doc_ids FROM bp GROUP BY 1, 2, 3""",
    "merge_blocks": _index() + f"SELECT term_id, (did - 1) // {SEG} AS seg, "
                               "string_agg(CAST(did AS VARCHAR), ',' ORDER BY did) AS doc_ids FROM post GROUP BY 1, 2",
    "index_size": _index(GAPS, "pt AS (SELECT term_id, count(*) AS df, sum(length(CAST(did AS VARCHAR))) AS idc, "
                               f"sum(length({VBHEX})) // 2 AS vb, sum(length({GAMMA})) AS bits FROM gp GROUP BY 1)")
    + """SELECT count(*) AS n_terms, CAST(sum(df) AS BIGINT) AS n_postings,
  CAST(sum(length(CAST(term_id AS VARCHAR)) + 1 + idc + df) AS BIGINT) AS plain_bytes,
  CAST(sum(vb) AS BIGINT) AS vb_bytes, CAST(sum((bits + 7) // 8) AS BIGINT) AS gamma_bytes FROM pt""",
    "gaps": _index(GAPS) + "SELECT term_id, did, gap FROM gp",
    "ungap": _index() + "SELECT term_id, did FROM post",
    "vb_encode": _index(GAPS) + f"SELECT term_id, seg, string_agg({VBHEX}, '' ORDER BY did) AS vb_hex FROM gp GROUP BY 1, 2",
    "vb_decode": _index() + "SELECT term_id, did FROM post",
    "gamma_encode": _index(GAPS, *GAMMA_LISTS) + f"SELECT term_id, seg, {GAMMA_HEX} AS gamma_hex, CAST(pad AS BIGINT) AS gamma_pad FROM gfull",
    "merge_compressed": _index(GAPS, *GAMMA_LISTS, f"vbl AS (SELECT term_id, seg, string_agg({VBHEX}, '' ORDER BY did) AS vb_hex FROM gp GROUP BY 1, 2)")
    + f"SELECT term_id, seg, vb_hex, {GAMMA_HEX} AS gamma_hex, CAST(pad AS BIGINT) AS gamma_pad FROM gfull JOIN vbl USING (term_id, seg)",
    "query_classes": _with(*_qterms(f"(SELECT * FROM {CONVERSATION_QUERIES_SQL} UNION ALL SELECT * FROM {dev_queries_sql(-1)})")[:2],
                           "st AS (SELECT query_id, list(token ORDER BY token) AS s FROM qt GROUP BY query_id)")
    + "SELECT query_id, min(query_id) OVER (PARTITION BY s) AS class_id FROM st",
    "gamma_decode": _index() + "SELECT term_id, did FROM post",
    "parse_queries": _with(DOCS, TOKS, WORDS, *_qterms(CONVERSATION_QUERIES_SQL)) + "SELECT query_id, token FROM qt",
    "term_lookup": _with(DOCS, TOKS, WORDS, *_qterms(f"(SELECT * FROM {BENCHMARK_QUERIES_SQL} UNION ALL "
                                                     f"SELECT * FROM {dev_queries_sql(-1)})"))
    + "SELECT query_id, token, term_id, df FROM lk",
    "unseen_terms": _with(DOCS, TOKS, WORDS, *_qterms(CONVERSATION_QUERIES_SQL))
    + "SELECT query_id, token FROM lk WHERE term_id IS NULL",
    "rarest_first": _with(DOCS, TOKS, WORDS, *_qterms(BENCHMARK_QUERIES_SQL))
    + """SELECT query_id, token, term_id, df,
  row_number() OVER (PARTITION BY query_id ORDER BY df, term_id) AS df_rank FROM lk WHERE term_id IS NOT NULL""",
    "intersect_lists": _with(DOCS, TOKS, *_qterms(dev_queries_sql())[:3], *_hits())
    + "SELECT query_id, did FROM hits",
    "conjunctive_hits": _with(DOCS, TOKS, *_qterms(CONVERSATION_QUERIES_SQL)[:3], *_hits())
    + "SELECT query_id, did FROM hits",
    "search_dev": _search(dev_queries_sql()),
    "search_bucketed": _search(CONVERSATION_QUERIES_SQL),
    "name_order": _with(DOCS) + "SELECT did, row_number() OVER (ORDER BY doc_name, did) AS name_rank FROM docs",
    "search_benchmark": _search(BENCHMARK_QUERIES_SQL),
    "search_conversations": _search(CONVERSATION_QUERIES_SQL),
    "result_diff": _with(DOCS, TOKS, "dt AS (SELECT DISTINCT did, token FROM toks)",
                         "a AS (SELECT did FROM dt WHERE token = 'the')",
                         "b AS (SELECT did FROM dt WHERE token = 'the' INTERSECT SELECT did FROM dt WHERE token = 'of')")
    + """SELECT d.doc_name, x.side FROM (
  SELECT did, '+' AS side FROM (SELECT did FROM a EXCEPT ALL SELECT did FROM b)
  UNION ALL
  SELECT did, '-' AS side FROM (SELECT did FROM b EXCEPT ALL SELECT did FROM a)) x JOIN docs d USING (did)""",
    "result_diff_ordered": "WITH RECURSIVE " + _with(
        DOCS, TOKS, "dt AS (SELECT DISTINCT did, token FROM toks)",
        """a AS (SELECT row_number() OVER (ORDER BY length(text), doc_name) AS ra, doc_name AS line
  FROM docs WHERE did IN (SELECT did FROM dt WHERE token = 'the'))""",
        """e AS (SELECT row_number() OVER (ORDER BY doc_name) AS re, doc_name AS line
  FROM docs WHERE did IN (SELECT did FROM dt WHERE token = 'the' INTERSECT SELECT did FROM dt WHERE token = 'of'))""",
        "pairs AS MATERIALIZED (SELECT line, ra, re FROM a FULL JOIN e USING (line))",
        """m AS MATERIALIZED (SELECT line, ra, re, row_number() OVER (ORDER BY ra) AS pos, row_number() OVER (ORDER BY re) AS pt
  FROM pairs WHERE ra IS NOT NULL AND re IS NOT NULL)""",
        """lis AS (SELECT CAST(0 AS BIGINT) AS pos, CAST(0 AS BIGINT) AS lvl, CAST([] AS BIGINT[]) AS tails
  UNION ALL
  SELECT pos + 1, k + 1, list_concat(list_concat(tails[1:k], [pt]), tails[k + 2:])
  FROM (SELECT l.pos, l.tails, m.pt, len(list_filter(l.tails, lambda x: x < m.pt)) AS k FROM lis l JOIN m ON m.pos = l.pos + 1))""",
        "lv AS MATERIALIZED (SELECT pos, lvl FROM lis WHERE pos > 0)",
        """keep AS (SELECT max(pos) AS pos, any_value(lvl) AS lvl FROM lv WHERE lvl = (SELECT max(lvl) FROM lv)
  UNION ALL
  SELECT (SELECT max(lv.pos) FROM lv WHERE lv.lvl = keep.lvl - 1 AND lv.pos < keep.pos), keep.lvl - 1 FROM keep WHERE keep.lvl > 1)""")[5:]
    + """SELECT CAST(1 AS BIGINT) AS query_id, CASE WHEN re IS NULL THEN '+' ELSE '-' END AS side, line, ra AS rank_actual, re AS rank_expected
FROM pairs WHERE ra IS NULL OR re IS NULL
UNION ALL
SELECT 1, 'moved', line, ra, re FROM m WHERE pos NOT IN (SELECT pos FROM keep WHERE pos IS NOT NULL)""",
    "index_roundtrip": _search(dev_queries_sql()),
    "plain_import": _index() + "SELECT term_id, did FROM post",
    "stored_vb_decode": _index() + "SELECT term_id, did FROM post",
    "stored_gamma_decode": _index() + "SELECT term_id, did FROM post",
    "query_file_search": _search(QUERY_FILE_SQL),
    "stream_search": _search(BENCHMARK_QUERIES_SQL),
    "stream_query_file": _search(QUERY_FILE_SQL),
    "stream_index": _index() + "SELECT term_id, did FROM post",
    "search_vb": _search(dev_queries_sql()),
    "search_gamma": _search(BENCHMARK_QUERIES_SQL),
    "stream_index_search": _search(dev_queries_sql()),
    "directory_scan": "SELECT coalesce(source, '') AS block, CAST(doc_id AS VARCHAR) AS file, "
                      "CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, md5(coalesce(text, '')) AS md5 FROM documents",
    "skip_segments": _with(DOCS, TOKS, WORDS, POST, *_qterms(f"(SELECT * FROM {BENCHMARK_QUERIES_SQL} UNION ALL "
                                                            f"SELECT * FROM {dev_queries_sql(-1)})"),
                           f"sk AS (SELECT term_id, (did - 1) // {SEG} AS seg, min(did) AS f, max(did) AS l FROM post GROUP BY 1, 2)",
                           "known AS (SELECT query_id, count(term_id) AS k FROM lk GROUP BY query_id)",
                           "met AS (SELECT query_id, seg, count(*) AS c, max(f) AS f, min(l) AS l FROM lk JOIN sk USING (term_id) GROUP BY 1, 2)",
                           "rd AS (SELECT query_id, sum(n) AS n_decoded FROM met JOIN nq USING (query_id) JOIN known USING (query_id) "
                           "WHERE k = n AND c = n AND f <= l GROUP BY 1)",
                           "al AS (SELECT query_id, sum(c) AS n_segments FROM met GROUP BY 1)")
    + """SELECT query_id, CAST(coalesce(n_segments, 0) AS BIGINT) AS n_segments, CAST(coalesce(n_decoded, 0) AS BIGINT) AS n_decoded
  FROM nq LEFT JOIN al USING (query_id) LEFT JOIN rd USING (query_id)""",
    "term_stats": _index(GAPS, f"pt AS (SELECT term_id, count(*) AS df, sum(length({VBHEX})) // 2 AS vb, "
                               f"sum(length({GAMMA})) AS bits FROM gp GROUP BY 1)")
    + """SELECT term_id, df, CAST(vb AS BIGINT) AS vb_bytes, CAST((bits + 7) // 8 AS BIGINT) AS gamma_bytes,
  CAST((8 - bits % 8) % 8 AS BIGINT) AS gamma_pad FROM pt""",
    "stream_index_words": _with(DOCS, TOKS, WORDS) + "SELECT term_id, token FROM words",
}
