"""Conjunctive (AND) keyword search for a whole batch of queries at once.

Input ``queries(query_id bigint, query_text string)``; output
``results(query_id, rank, doc_name)`` with one sentinel row
(``no results found``) for a query without hits. Blank queries are skipped.

Plan, for a batch:

1. P3/P4  split queries into distinct terms, drop blank queries;
2. Q1     look the terms up in ``word_dict``; the lookup (one row per query
          term) is materialised once and its size is the single check behind
          every broadcast below; the tables of a larger batch are checked one by one;
3. Q2     a query with an unknown term has no hits;
4. Q4     per query, its rarest term (smallest df) gives the candidates:
          candidates = postings of that one term, never of a stop word
          unless the query holds nothing rarer;
5. Q3/Q5  every candidate (query, did) is checked against the postings of the
          other terms with joins on (term_id, did): unique keys, no skew; the
          second rarest term first, then the next two, then the rest;
          a doc is a hit when all n terms are present;
6. Q6-Q8  rank by the stored name order, names and sentinel rows last: a
          window per query when the largest result is known to fit one task,
          else a global numbering that splits a huge result across partitions.

Postings are read only for the batch's terms (a broadcast semi-join, or a literal
``term_id IN (...)`` that Parquet row-group statistics prune when the index
is stored sorted by term and the term set is small). A batch too large to
broadcast meets the postings in salted joins.

Over compressed lists (``skip_hits``) steps 4 and 5 run on segments first: the
rarest term's segments, from the narrow skip table, name the segments of the
other terms; a segment counts only if every term has it and their id ranges
overlap. Only those lists are read and decoded, each once, and intersected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import NO_RESULTS, query_terms
from ..session import stored
from .ids import global_rank_in_group
from .skew import broadcast_if_small, is_small, salted_join

# Largest distinct term set that is turned into literal IN filters. Larger
# batches use a broadcast semi-join instead (Parquet would turn a long IN
# list into one min/max range, which prunes nothing).
MAX_SEEK_TERMS = 1_000


def in_list(col: str, values: list) -> "F.Column":
    """``col IN (v1, v2, ...)`` from literal values (never from SQL text, in
    which Spark would substitute ``${...}``)."""
    return F.col(col).isin(*values) if values else F.lit(False)


# Largest single-query result that is ranked by a window inside one task.
RANK_WINDOW_MAX = 5_000_000


def parse_queries(queries: DataFrame) -> DataFrame:
    """P3 + P4: (query_id, token), each term once; blank queries vanish. Rows
    with the same query_id are one query (AND of all their terms)."""
    return queries.select("query_id", F.explode(query_terms("query_text")).alias("token")).distinct()


def term_lookup(qterms: DataFrame, words: DataFrame, seek: bool = False) -> DataFrame:
    """Q1: (query_id, token, term_id, df); term_id/df NULL for unseen terms.

    The dictionary side is reduced to the batch's tokens first (literal IN
    pushed into the scan when ``seek`` and the token set is small, else a
    semi-join whose small side AQE broadcasts by measured size)."""
    w = words.select("token", "term_id", "df")
    if seek:
        toks = [r[0] for r in qterms.select("token").distinct().limit(MAX_SEEK_TERMS + 1).collect()]
        if len(toks) <= MAX_SEEK_TERMS:
            w = w.where(in_list("token", toks))
    matched = w.join(qterms.select("token").distinct(), "token", "left_semi")
    # a common token occurs in most queries: broadcast the matches (at most as
    # many as the batch's terms), or salt
    if is_small(qterms):
        found = qterms.join(F.broadcast(matched), "token", "left")
    else:
        found = salted_join(qterms, matched, "token", "df", "query_id", how="left")
    return found.select("query_id", "token", "term_id", "df")


def unseen_terms(lookup: DataFrame) -> DataFrame:
    """Q2: the unknown terms of each query."""
    return lookup.where(F.col("term_id").isNull()).select("query_id", "token")


def rarest_first(lookup: DataFrame) -> DataFrame:
    """Q4: rank of each known term inside its query by (df, term_id).
    Groups are single queries (a handful of rows each)."""
    w = Window.partitionBy("query_id").orderBy("df", "term_id")
    return lookup.where(F.col("term_id").isNotNull()).withColumn("df_rank", F.row_number().over(w))


def answerable(lookup: DataFrame) -> DataFrame:
    """(query_id, n_terms, rare_term, rare_df) for queries whose terms are all known."""
    return (
        lookup.groupBy("query_id")
        .agg(
            F.count(F.lit(1)).alias("n_terms"),
            F.count("term_id").alias("n_known"),
            F.min_by("term_id", F.struct("df", "term_id")).alias("rare_term"),
            F.min("df").alias("rare_df"),
        )
        .where(F.col("n_terms") == F.col("n_known"))
        .select("query_id", F.col("n_terms").cast("bigint").alias("n_terms"), "rare_term", "rare_df")
    )


def ranked_terms(lookup: DataFrame) -> DataFrame:
    """(query_id, n_terms, rare_df, term_id, df_rank): the terms of the answerable
    queries, rarest first; written, for the rounds that check them. Queries with an
    unknown term have no hits, and mustn't make a batch large."""
    ok = answerable(lookup).select("query_id", "n_terms", "rare_df")
    return stored(rarest_first(lookup.join(ok, "query_id")).select("query_id", "n_terms", "rare_df", "term_id", "df_rank"), "ranked-terms")


def _rounds(terms: DataFrame) -> list[tuple[int, int]]:
    """The ranks (from, to) that are checked together: the second rarest term alone,
    the next two, then the rest, which meet the few candidates that are left."""
    most, out, a = terms.agg(F.max("n_terms")).first()[0] or 0, [], 2
    for b in (2, 4, most):
        if a <= min(b, most):
            out.append((a, min(b, most)))
            a = b + 1
    return out


def _batch_postings(post: DataFrame, lookup: DataFrame, seek: bool, small: bool) -> DataFrame:
    """Rows of an index (postings, lists, skips) restricted to the known terms: a literal
    IN that reaches the scan, or a broadcast semi-join. Terms too many to
    broadcast don't filter: a shuffled semi-join would bring all rows of a stop word into
    one task, and the salted joins that follow drop the rest."""
    term_ids = lookup.where(F.col("term_id").isNotNull()).select("term_id").distinct()
    if seek:
        ids = [r[0] for r in term_ids.limit(MAX_SEEK_TERMS + 1).collect()]
        if len(ids) <= MAX_SEEK_TERMS:
            return post.where(in_list("term_id", ids))
    return post.join(F.broadcast(term_ids), "term_id", "left_semi") if small or is_small(term_ids) else post


def _met(rows: DataFrame, terms: DataFrame, key: str, spread: str, small: bool) -> DataFrame:
    """``rows`` joined with the batch's ``terms`` on ``key``, a term or a query. Terms
    of large batches are broadcast after a check of their own, else a key that owns many rows
    is salted."""
    if small or is_small(terms):
        return rows.join(F.broadcast(terms.drop("rare_df")), key)
    return salted_join(rows, terms, key, "rare_df", spread).drop("rare_df")


def lookup_is_small(lookup: DataFrame) -> bool:
    """One size check for the whole batch: every small side of the search
    (answerable queries, needed terms, term ids) has at most as many rows as
    the lookup table."""
    return is_small(lookup)


def _by_rounds(left: DataFrame, terms: DataFrame, small: bool, check: Callable[[DataFrame, DataFrame, F.Column], DataFrame], spread: str) -> list[DataFrame]:
    """Candidates ``left`` (query_id, n_terms, ...) checked round by round, each term
    against what the rarer ones have left. ``check(rows, need, n)`` gets the candidates once
    per term of the round and keeps those that have all ``n``. Returns what is found, by
    rounds; the last one is not written."""
    found, rounds = [left.where("n_terms = 1")], _rounds(terms)
    left = left.where("n_terms > 1")
    for a, b in rounds:
        need = terms.where(F.col("df_rank").between(a, b)).select("query_id", "term_id", "rare_df")
        kept = check(_met(left, need, "query_id", spread, small), need, F.least(F.col("n_terms"), F.lit(b)) - F.lit(a - 1))
        if (a, b) != rounds[-1]:
            kept = stored(kept, "candidates")
        found.append(kept.where(F.col("n_terms") <= b))
        left = kept.where(F.col("n_terms") > b)
    return found


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def conjunctive_hits(post: DataFrame, lookup: DataFrame, seek: bool = False, small: bool | None = None,
                     decode: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Q3 + Q5: (query_id, did) for every doc that holds all query terms.

    ``post`` is a long-form index, or a compressed one with its ``decode``:
    then the lists of the batch's terms are picked first and only they are
    decoded. The rarest term gives the candidates and is not checked again;
    one-term queries are answered by their candidates alone. The other terms are
    checked in rounds, rarest first, so that most candidates meet one term only. Beyond
    broadcast size the joins on ``term_id`` and ``query_id`` are salted."""
    terms = ranked_terms(lookup)
    if small is None:
        small = lookup_is_small(terms)
    if decode is not None:
        bp = _batch_postings(post, terms, seek, small)
        if not small:
            bp = bp.join(terms.select("term_id").distinct(), "term_id", "left_semi")  # a term's lists, not its ids
        post, seek = stored(decode(bp), "batch-postings"), False  # read by the candidates and by the checks
    first = terms.where("df_rank = 1").drop("df_rank")
    cands = _met(_batch_postings(post, first, seek, small), first, "term_id", "did", small).select("query_id", "did", "n_terms")

    def check(rows: DataFrame, need: DataFrame, n: F.Column) -> DataFrame:
        # Inner join on the unique key (term_id, did) = semi-join, but either side
        # may be the build side, so AQE can broadcast the (usually small)
        # candidate checks instead of shuffling the batch postings.
        present = rows.join(_batch_postings(post, need, seek, small), ["term_id", "did"])
        counted = present.groupBy("query_id", "did", "n_terms").agg(F.count(F.lit(1)).alias("_n"))
        return counted.where(F.col("_n") == n).drop("_n")

    return _union(_by_rounds(cands, terms, small, check, "did")).select("query_id", "did")


def segment_plan(skips: DataFrame, lookup: DataFrame, small: bool | None = None) -> DataFrame:
    """Q3 on segments: (query_id, seg, n_terms) where every term of the query has
    ids, in overlapping ranges. Starts from the rarest term's segments; the other
    terms' rows are met on (term_id, seg), which is unique, in rounds."""
    terms = ranked_terms(lookup)
    return _segment_plan(skips, terms, lookup_is_small(terms) if small is None else small)


def _segment_plan(skips: DataFrame, terms: DataFrame, small: bool) -> DataFrame:
    skips = skips.select("term_id", "seg", "first", "last")
    first = terms.where("df_rank = 1").drop("df_rank")
    rare = _met(_batch_postings(skips, first, False, small), first, "term_id", "seg", small).select(
        "query_id", "seg", "n_terms", F.col("first").alias("_from"), F.col("last").alias("_to"))

    def check(rows: DataFrame, need: DataFrame, n: F.Column) -> DataFrame:
        met = rows.join(_batch_postings(skips, need, False, small), ["term_id", "seg"])
        counted = met.groupBy("query_id", "seg", "n_terms").agg(
            F.count(F.lit(1)).alias("_n"), F.max(F.greatest("first", "_from")).alias("_from"), F.min(F.least("last", "_to")).alias("_to"))
        return counted.where((F.col("_n") == n) & (F.col("_from") <= F.col("_to"))).drop("_n")

    return _union(_by_rounds(rare, terms, small, check, "seg")).select("query_id", "seg", "n_terms")


def _common_ids(first: DataFrame, terms: DataFrame, small: bool, meet: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """(query_id, did): the rarest terms' lists ``first`` (query_id, n_terms, seg, dids)
    intersected with those of the other terms, in rounds. ``meet(rows, need)`` gives the
    rows (query_id, n_terms, seg, dids, term_id) their term's list of the segment as
    ``_list``; what is gathered per (query, segment) are intersections with the rarest
    term's list, never a stop word's ids."""

    def check(rows: DataFrame, need: DataFrame, n: F.Column) -> DataFrame:
        both = meet(rows, need).select("query_id", "seg", "n_terms", F.array_intersect("dids", "_list").alias("_both")).where("size(_both) > 0")
        lists = both.groupBy("query_id", "seg", "n_terms").agg(F.collect_list("_both").alias("_lists")).where(F.size("_lists") == n)
        inter = F.aggregate(F.slice("_lists", 2, 1 << 30), F.element_at("_lists", 1), lambda acc, x: F.array_intersect(acc, x))
        return lists.select("query_id", "seg", "n_terms", inter.alias("dids")).where("size(dids) > 0")

    found = _by_rounds(first, terms, small, check, "seg")
    return _union([f.select("query_id", F.explode("dids").alias("did")) for f in found])


def skip_hits(enc: DataFrame, skips: DataFrame, lookup: DataFrame, decode: Callable[[DataFrame], DataFrame],
              seek: bool = False, small: bool | None = None) -> DataFrame:
    """Q3 + Q5 over compressed lists: (query_id, did). ``decode`` gives (term_id,
    seg, dids); below it the lists are reduced to those that ``segment_plan``
    names, so stop words cost the segments their partners touch."""
    terms = ranked_terms(lookup)
    if small is None:
        small = lookup_is_small(terms)
    plan = stored(_segment_plan(skips, terms, small), "segment-plan")
    pairs = _met(plan.drop("n_terms"), terms.select("query_id", "term_id", "rare_df"), "query_id", "seg", small)
    wanted = stored(pairs.groupBy("term_id", "seg").agg(F.count(F.lit(1)).alias("_w")), "wanted-lists")
    lists = _batch_postings(enc, terms, seek, small) if seek else enc
    # decoded once; a segment that many queries want is salted by its number of them
    found = stored(decode(lists.join(broadcast_if_small(wanted.select("term_id", "seg")), ["term_id", "seg"], "left_semi")), "segment-lists")
    few = is_small(found)

    def meet(rows: DataFrame, need: DataFrame) -> DataFrame:
        some = found.withColumnRenamed("dids", "_list")
        if few:
            return rows.join(F.broadcast(some), ["term_id", "seg"])
        key = F.struct("term_id", "seg").alias("_key")
        weighted = _batch_postings(some, need, False, small).join(wanted, ["term_id", "seg"]).select(key, "_w", "_list")
        return salted_join(rows.select("*", key), weighted, "_key", "_w", "query_id").drop("_key")

    first = terms.where("df_rank = 1").select("query_id", "term_id", "rare_df")
    rows = meet(_met(plan, first, "query_id", "seg", small), first).select("query_id", "n_terms", "seg", F.col("_list").alias("dids"))
    return _common_ids(rows, terms, small, meet)


def skip_report(skips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Per query, the segments of its known terms and those that have to be
    decoded: (query_id, n_segments, n_decoded)."""
    small = lookup_is_small(lookup)
    per_term = skips.groupBy("term_id").agg(F.count(F.lit(1)).alias("_segs"))
    have = lookup.where(F.col("term_id").isNotNull()).select("query_id", "term_id", "df")
    mine = per_term.join(F.broadcast(have), "term_id") if small else salted_join(have, per_term, "term_id", "_segs", "query_id")
    all_ = mine.groupBy("query_id").agg(F.sum("_segs").alias("n_segments"))
    read = segment_plan(skips, lookup, small).groupBy("query_id").agg(F.sum("n_terms").alias("n_decoded"))
    return (lookup.select("query_id").distinct().join(all_, "query_id", "left").join(read, "query_id", "left")
            .select("query_id", F.coalesce("n_segments", F.lit(0)).cast("bigint").alias("n_segments"),
                    F.coalesce("n_decoded", F.lit(0)).cast("bigint").alias("n_decoded")))


def intersect_lists(seg_lists: DataFrame, lookup: DataFrame, small: bool | None = None) -> DataFrame:
    """Q3 in array form: per query, intersect the segment arrays of its terms.

    The lists of the batch's terms are made and written once. Only segments where the
    rarest term has ids are touched; a segment that lacks any term drops out because
    fewer than n arrays arrive. Joins on a term or query are broadcast or salted, as in
    the long form."""
    terms = ranked_terms(lookup)
    if small is None:
        small = lookup_is_small(terms)
    lists = stored(_batch_postings(seg_lists.select("term_id", "seg", "dids"), terms, False, small), "batch-lists")
    first = terms.where("df_rank = 1").drop("df_rank")
    rows = _met(_batch_postings(lists, first, False, small), first, "term_id", "seg", small).select("query_id", "n_terms", "seg", "dids")
    return _common_ids(rows, terms, small, lambda rows, need: rows.join(
        _batch_postings(lists.withColumnRenamed("dids", "_list"), need, False, small), ["term_id", "seg"]))


def name_results(hits: DataFrame, docs: DataFrame, lookup: DataFrame) -> DataFrame:
    """Q6 + Q7: (query_id, doc_name), with a sentinel row for a query that has
    terms but no hit. Built as a union, so a query with many hits is never
    gathered in one join task."""
    named = hits.join(docs.select("did", "doc_name"), "did").select("query_id", "doc_name")
    asked = lookup.select("query_id").distinct()
    answered = hits.select("query_id").distinct()
    empty = asked.join(answered, "query_id", "left_anti").select("query_id", F.lit(NO_RESULTS).alias("doc_name"))
    return named.unionByName(empty)


def largest_group(results: DataFrame) -> int:
    """Rows of the largest query result (partially aggregated count)."""
    v = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return int(v or 0)


def sort_results(results: DataFrame, max_group: int | None = None, by: str = "doc_name", value: str = "doc_name") -> DataFrame:
    """Q8: (query_id, rank, ``value``), rank 1.. per query by doc name, byte order
    (or by the column ``by``).

    When the largest result is known to fit one task (``RANK_WINDOW_MAX``),
    a window per query; otherwise one global numbering split across
    partitions, so a query that matches most documents is spread out."""
    if max_group is None:
        max_group = largest_group(results)
    if max_group <= RANK_WINDOW_MAX:
        w = Window.partitionBy("query_id").orderBy(by)
        return results.select("query_id", F.row_number().over(w).cast("bigint").alias("rank"), value)
    return global_rank_in_group(results, "query_id", [by], "rank").select("query_id", "rank", value)


def name_ranked(hits: DataFrame, docs: DataFrame, order: DataFrame, lookup: DataFrame, max_group: int) -> DataFrame:
    """Q6-Q8 by the stored name order: hits are ranked as rows of three numbers,
    then the ranked rows meet their names. A query that has terms but no hit gets
    its sentinel row in a union, so a query with many hits stays spread out."""
    ranked = sort_results(hits.join(order, "did"), max_group, by="name_rank", value="did")
    named = ranked.join(docs.select("did", "doc_name"), "did").select("query_id", "rank", "doc_name")
    empty = lookup.select("query_id").distinct().join(hits.select("query_id").distinct(), "query_id", "left_anti")
    return named.unionByName(empty.select("query_id", F.lit(1).cast("bigint").alias("rank"), F.lit(NO_RESULTS).alias("doc_name")))


def _term_sets(qterms: DataFrame) -> DataFrame:
    """(query_id, _set): one name per set of terms."""
    sets = qterms.groupBy("query_id").agg(F.sort_array(F.collect_set("token")).alias("_terms"))
    return sets.select("query_id", F.sha2(F.to_json("_terms"), 256).alias("_set"))


def query_classes(qterms: DataFrame) -> DataFrame:
    """(query_id, class_id): queries with the same set of terms share a class, named
    by its smallest query_id. A query's terms are one row; a class that many
    queries share is a partially aggregated minimum."""
    keyed = stored(_term_sets(qterms), "query-sets")
    reps = keyed.groupBy("_set").agg(F.min("query_id").alias("class_id"), F.count(F.lit(1)).alias("_w"))
    if is_small(reps):
        return keyed.join(F.broadcast(reps), "_set").select("query_id", "class_id")
    return salted_join(keyed, reps, "_set", "_w", "query_id").select("query_id", "class_id")


def fan_out(results: DataFrame, classes: DataFrame) -> DataFrame:
    """The ranked results of the classes, handed to every query of a class."""
    if is_small(classes):
        rows = results.withColumnRenamed("query_id", "class_id").join(F.broadcast(classes), "class_id")
    else:
        sizes = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("_w")).withColumnRenamed("query_id", "class_id")
        rows = salted_join(results.withColumnRenamed("query_id", "class_id"), classes.join(sizes, "class_id"), "class_id", "_w", "rank")
    return rows.select("query_id", "rank", "doc_name")


def search(post: DataFrame, words: DataFrame, docs: DataFrame, queries: DataFrame, seek: bool = False,
           decode: Callable[[DataFrame], DataFrame] | None = None, skips: DataFrame | None = None,
           order: DataFrame | None = None) -> DataFrame:
    """Q5 end to end: (query_id, rank, doc_name).

    Queries with one set of terms are evaluated, named and ranked once. Narrow
    tables (the batch's terms, their lookup and the hits) are
    written to the shared folder, so that the size checks and the branches do not
    recompute the work and nothing stays cached. ``decode``: see
    ``conjunctive_hits``; with ``skips``, see ``skip_hits``. ``order``: the index's
    (did, name_rank); without it the names themselves are sorted."""
    qterms = stored(parse_queries(queries), "query-terms")
    n, sets = _term_sets(qterms).agg(F.count(F.lit(1)), F.count_distinct("_set")).first()
    shared = n > sets
    if shared:
        classes = query_classes(qterms)
        reps = classes.where("query_id = class_id").select("query_id")
        qterms = qterms.join(broadcast_if_small(reps), "query_id", "left_semi")
    lookup = stored(term_lookup(qterms, words, seek=seek), "lookup")
    small = lookup_is_small(lookup) or None  # None: its answerable queries may still be few
    if skips is not None:
        hits = skip_hits(post, skips, lookup, decode, seek=seek, small=small)
    else:
        hits = conjunctive_hits(post, lookup, seek=seek, small=small, decode=decode)
    hits = stored(hits, "hits")
    if order is not None:
        ranked = name_ranked(hits, docs, order, lookup, largest_group(hits))
    else:
        ranked = sort_results(name_results(hits, docs, lookup), largest_group(hits))
    return fan_out(ranked, classes) if shared else ranked


def result_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Q9: rows only in ``actual`` (side '+') or only in ``expected`` (side '-'),
    multiplicities kept."""
    cols = [c for c in expected.columns]
    plus = actual.select(*cols).exceptAll(expected.select(*cols)).withColumn("side", F.lit("+"))
    minus = expected.select(*cols).exceptAll(actual.select(*cols)).withColumn("side", F.lit("-"))
    return plus.unionByName(minus)
