r"""Personal data (operator 8), DataFrame functions only.

Base entities come from four patterns, leftmost and non-overlapping per kind;
failing matches (address parts above 255, wrong digit counts, Luhn) are dropped.
The patterns below find exactly what the plain ones find, but start only where a
run of their characters starts and never backtrack into a run, so they are
linear in the text.

Bootstrapped contextual extraction then adds identifiers the patterns miss:

1. Candidates are runs of tokens that hold a digit or ``@``. Their lexical
   patterns are the word before, the two words before, and a label inside the
   token (``mail:x``). Candidates that overlap a base entity are seeds of its kind.
   Inside a run, every run of neighbouring tokens that has the shape of a kind and
   overlaps no base entity is a candidate too, with the words before it.
2. Pattern-instance graph: a pattern's confidence for a kind is the share of its
   distinct instances known to be of that kind (candidates that start at the same
   token count as one, by the longest); it needs ``MIN_KNOWN`` of them and
   ``MIN_CONFIDENCE``.
3. An unknown instance whose shape fits the kind scores 1 - prod(1 - confidence)
   over the accepted patterns it occurs with anywhere; from ``MIN_SCORE`` on it is
   known too, wherever it occurs, and the next round starts, until nothing is new.
4. Known instances are added wherever no base entity overlaps them; of nested ones
   of a kind the longest.

The graph holds distinct (pattern, instance) rows, so a frequent pattern is
counted with partial aggregation and never gathered.

Defined cases: null and empty texts have no entities; rows with equal id and
text share their result; a null doc_id stays null; empty tables give empty
results; input columns that clash with result names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.skew import broadcast_if_small
from .common import prepare, shield, table, written

KINDS = ("email", "ip", "card", "phone")
MIN_KNOWN = 5
MIN_CONFIDENCE = 0.8
MIN_SCORE = 0.8
# the last two words of a text, read from its end
CONTEXT = r"^[\x20\x09-\x0D]*+[^\x20\x09-\x0D]*+[\x20\x09-\x0D]*+[^\x20\x09-\x0D]*+"
PIECES = 256  # matches whose positions are summed in one go

_TOKEN = r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATE = rf"(?<![^\x20\x09-\x0D]){_TOKEN}(?:\x20{_TOKEN})*+"
SUB = 19  # a shape has at most so many digits, and every token of it has one
_TRIM = "()[]{}<>\"'.,;:!?"
_SPANS = "array<struct<s:int,e:int,m:string,c:string>>"


def _guard(kind: str, t: Column) -> Column:
    """Cheap necessary condition for a match."""
    return {"email": F.contains(t, F.lit("@")), "ip": t.rlike(r"[0-9]\.[0-9]"),
            "card": t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), "phone": F.contains(t, F.lit("+"))}[kind]


def _find(t: Column, pattern: str, context: bool = False) -> Column:
    """All matches with code point spans (and the two words before each).

    Positions are running sums over the pieces between matches. They are summed
    in blocks of ``PIECES``, since appending to one long array copies it: a text
    of numbers only stays far from quadratic."""
    both = F.zip_with(F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda p, m: F.struct(
        F.char_length(p).alias("p"), F.char_length(m).alias("n"), m.alias("m"),
        (F.reverse(F.regexp_extract(F.reverse(p), CONTEXT, 0)) if context else F.lit("")).alias("c")))
    none = F.expr(f"cast(array() as {_SPANS})")

    def step(a, x):
        s = a["at"] + x["p"]
        return F.when(x["m"].isNull(), a).otherwise(F.struct((s + x["n"]).alias("at"), F.concat(a["out"], F.array(F.struct(
            s.alias("s"), (s + x["n"]).alias("e"), x["m"].alias("m"), x["c"].alias("c")))).alias("out")))

    def block(a, part):
        inner = F.struct(a["at"].alias("at"), none.alias("out"))
        return F.aggregate(part, inner, step, lambda r: F.struct(r["at"].alias("at"), F.concat(a["out"], F.array(r["out"])).alias("out")))

    def parts(all_):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / PIECES).cast("int")),
                           lambda k: F.slice(all_, k * PIECES + 1, F.lit(PIECES)))

    # a lambda variable holds the pieces, so they are found once
    blocks = F.get(F.transform(F.array(both), parts), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{_SPANS}>)").alias("out"))
    return F.aggregate(blocks, start, block, lambda a: F.flatten(a["out"]))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.reverse(_digits(m))
    def one(i):
        x = F.substring(d, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return F.when(x > 9, x - 9).otherwise(x)
    total = F.aggregate(F.sequence(F.lit(1), F.char_length(d)), F.lit(0), lambda a, i: a + one(i))
    return F.char_length(d).between(16, 19) & (total % 10 == 0)


def valid(kind: str, m: Column) -> Column:
    """Does a match of the kind's pattern count?"""
    if kind == "ip":
        def fits(p):
            p = F.ltrim(p, F.lit("0"))
            return (F.char_length(p) <= 3) & (F.coalesce(F.when(F.char_length(p) <= 3, p).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(m, r"\."), fits)
    if kind == "card":
        return F.when(F.char_length(_digits(m)).between(16, 19), _luhn(m)).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(_digits(m)).between(8, 15)
    return F.lit(True)


def _valid_only(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda x: valid(kind, x["m"]))


def _masked(kind: str, t: Column) -> Column:
    """The text with the kind's entities replaced, piece by piece."""
    tag = F.lit(f"<{kind.upper()}>")
    return F.array_join(F.zip_with(
        F.split(t, PATTERNS[kind], -1), F.regexp_extract_all(t, F.lit(PATTERNS[kind]), F.lit(0)),
        lambda p, m: F.concat(p, F.when(m.isNull(), "").when(valid(kind, m), tag).otherwise(m))), "")


def base_entities(docs: DataFrame) -> DataFrame:
    """Per document row: key columns ``_id`` and ``_h``, doc_id, an array of
    spans for each kind, and the candidates (written, without the texts)."""
    prepare(docs.sparkSession)
    t = F.col("_t")
    d = keyed(docs).select("doc_id", "_id", "_h", F.coalesce("text", F.lit("")).alias("_t"))
    none = F.expr(f"cast(array() as {_SPANS})")
    cols = []
    for k in KINDS:
        cols.append(F.when(_guard(k, t), _valid_only(k, _find(t, PATTERNS[k]))).otherwise(none).alias(k))
    cands = F.when(t.rlike("[0-9@]"), _find(t, CANDIDATE, context=True)).otherwise(none).alias("cands")
    return written(d.select("doc_id", "_id", "_h", *cols, cands), "pii-base")


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with equal id and text share the key (_id, _h)."""
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn("_h", F.xxhash64("text"))


def _shape(kind: str, v: Column) -> Column:
    """Could this instance be of the kind, though its pattern missed it?"""
    n = F.char_length(_digits(v))
    return {"email": v.rlike(r"^[^@\x20]+@[^@\x20]+$"), "ip": v.rlike(r"^[0-9]{1,3}(?:[.][0-9]{1,3}){3}(?::[0-9]{1,5})?$"),
            "card": v.rlike(r"^[0-9\x20-]+$") & n.between(13, 19), "phone": v.rlike(r"^[0-9\x20()./+-]+$") & n.between(7, 15)}[kind]


def _with_near(cands: Column, ents: Column) -> Column:
    """Candidates with ``near``, the base entities that overlap them. They are
    compared in blocks of ``PIECES`` candidates with the entities of the block's
    stretch, so a text full of both is far from quadratic."""
    def overlap(x, start, end):
        return (x["s"] < end) & (x["e"] > start)

    def block(k):
        part = F.slice(cands, k * PIECES + 1, F.lit(PIECES))
        return F.get(F.transform(F.array(part), lambda p: F.get(F.transform(
            F.array(F.filter(ents, lambda x: overlap(x, F.get(p, F.lit(0))["s"], F.element_at(p, -1)["e"]))),
            lambda sub: F.transform(p, lambda c: F.struct(
                c["s"].alias("s"), c["m"].alias("m"), c["c"].alias("c"),
                F.filter(sub, lambda x: overlap(x, c["s"], c["e"])).alias("near")))), F.lit(0))), F.lit(0))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(cands) - 1) / PIECES).cast("int")), block))


def _inside(runs: DataFrame) -> DataFrame:
    """Neighbouring tokens of the runs (_id, _h, s, m, c, near) that could be
    instances, apart from whole runs: _id, _h, s0, m, c and ``run``, the start's
    longest one (for a run's first token the whole run)."""
    toks = F.transform(_find(F.col("m"), r"[^\x20]++"), lambda x: F.struct(
        (x["s"] + F.col("s")).alias("s"), (x["e"] + F.col("s")).alias("e"), x["m"].alias("m"), x["c"].alias("c")))
    runs = runs.filter(F.contains("m", F.lit(" "))).select("_id", "_h", "m", "c", "near", toks.alias("toks"))
    runs = runs.select("_id", "_h", "m", "c", _with_near(F.col("toks"), F.col("near")).alias("toks"))

    def start(x, i):
        two = F.array_join(F.transform(F.slice("toks", F.greatest(i - 1, F.lit(1)), F.when(i > 1, 2).otherwise(i)), lambda y: y["m"]), " ")
        before = F.when(i > 1, two).when(i == 1, F.concat("c", F.lit(" "), two)).otherwise(F.col("c"))
        return F.struct(i.alias("i"), before.alias("c"), F.when(i == 0, F.col("m")).alias("run"), F.slice("toks", i + 1, F.lit(SUB)).alias("x"))

    free = lambda x: F.size(x["near"]) == 0
    starts = runs.select("_id", "_h", F.size("toks").alias("n"), F.explode(F.filter(
        F.transform("toks", start), lambda y: free(F.get(y["x"], F.lit(0))))).alias("y"))
    starts = starts.select("_id", "_h", "n", "y.i", "y.c", "y.run", "y.x")
    some = F.transform(F.sequence(F.lit(1), F.size("x")), lambda j: F.slice("x", F.lit(1), j))
    some = F.filter(some, lambda part: F.forall(part, free) & (F.size(part) < F.col("n")))
    texts = F.transform(some, lambda part: F.array_join(F.transform(part, lambda y: y["m"]), " "))
    fits = F.filter(texts, lambda m: F.exists(F.array(*[_shape(k, _value(m)) for k in KINDS]), lambda y: y))
    return (starts.select("_id", "_h", F.get("x", F.lit(0))["s"].alias("s0"), "c", "run", fits.alias("fits"))
            .select("_id", "_h", "s0", "c", F.coalesce("run", F.element_at("fits", -1)).alias("run"), F.explode("fits").alias("m")))


def _label(core: Column) -> Column:
    return F.regexp_extract(core, r"^([A-Za-z][A-Za-z_-]*+)[=:](?=.)", 0)


def _core(m: Column) -> tuple[Column, Column]:
    """Characters trimmed off the left of a candidate, and what is left of it."""
    left = F.char_length(m) - F.char_length(F.ltrim(m, F.lit(_TRIM)))
    core = F.trim(m, F.lit(_TRIM))
    # "(555) 1234": the bracket that a trimmed one closes belongs to the value
    opened = F.contains(core, F.lit(")")) & ~F.contains(core, F.lit("(")) & (F.substring(m, left, F.lit(1)) == "(")
    return left - opened.cast("int"), F.when(opened, F.concat(F.lit("("), core)).otherwise(core)


def _value(m: Column) -> Column:
    core = _core(m)[1]
    return F.substring(core, F.char_length(_label(core)) + 1, F.char_length(core))


def occurrences(base: DataFrame) -> DataFrame:
    """Candidates as rows: key, span, value hash, hash ``u`` of the longest that
    starts there, fitting kinds, seed kind (kind of an overlapping base entity)
    and lexical patterns."""
    ents = F.concat(*[_of_kind(i, k) for i, k in enumerate(KINDS)]).alias("ents")
    c = base.filter(F.size("cands") > 0).select("_id", "_h", "cands", ents)
    c = c.select("_id", "_h", F.explode(_with_near(F.col("cands"), F.col("ents"))).alias("x"))
    runs = c.select("_id", "_h", "x.s", "x.m", "x.c", "x.near")
    c = (runs.select("_id", "_h", F.col("s").alias("s0"), "m", "c", "near", F.col("m").alias("run"))
         .unionByName(_inside(runs), allowMissingColumns=True))
    left, core = _core(F.col("m"))
    c = (c.withColumn("core", core).withColumn("at", F.col("s0") + left).withColumn("label", _label(F.col("core")))
         .withColumn("v", F.substring(F.col("core"), F.char_length("label") + 1, F.char_length("core")))
         .withColumn("s", F.col("at") + F.char_length("label")).withColumn("e", F.col("s") + F.char_length("v"))
         .filter(F.col("v") != ""))
    seed = F.array_min(F.transform(F.filter("near", lambda b: (b["s"] < F.col("e")) & (b["e"] > F.col("s"))), lambda b: b["kind"]))
    words = F.array_remove(F.split(F.lower(F.regexp_replace("c", "[0-9]+", "0")), r"[\x20\x09-\x0D]+"), "")
    c = c.withColumn("w", words).withColumn("nw", F.size("w"))
    pats = F.array_compact(F.array(
        F.when(F.col("nw") >= 1, F.concat(F.lit("1 "), F.element_at("w", -1))),
        F.when(F.col("nw") >= 2, F.concat(F.lit("2 "), F.element_at("w", -2), F.lit(" "), F.element_at("w", -1))),
        F.when(F.col("label") != "", F.concat(F.lit("= "), F.lower("label")))))
    shapes = F.array_compact(F.array(*[F.when(_shape(k, F.col("v")), F.lit(i)) for i, k in enumerate(KINDS)]))
    return written(c.select("_id", "_h", "s", "e", F.xxhash64("v").alias("v"), F.xxhash64(_value(F.col("run"))).alias("u"),
                            seed.alias("seed"), shapes.alias("shapes"), pats.alias("pats")), "pii-cands")


def discover(occ: DataFrame) -> DataFrame:
    """(v, kind) of the instances that high-confidence patterns find, and of the
    seeds that also occur where no base entity is found."""
    inst = written(occ.groupBy("v").agg(F.min("seed").alias("kind"), F.first("shapes", True).alias("shapes"),
                                        F.bool_or(F.col("seed").isNull()).alias("free")), "pii-inst")
    edges = written(occ.select("v", "u", F.explode("pats").alias("p")).distinct(), "pii-edges")
    known = written(inst.filter("kind IS NOT NULL").select("v", "kind"), "pii-known")
    new = written(inst.filter("free AND array_contains(shapes, kind)").select("v", "kind"), "pii-new")
    while True:  # known only grows, and the instances are finite
        slots = edges.join(known, "v", "left").groupBy("p", "u").agg(F.min("kind").alias("kind"))
        stat = (slots.groupBy("p")
                .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("kind") == i).alias(f"k{i}") for i in range(len(KINDS))]))
        sure = written(stat.select("p", "n", F.posexplode(F.array(*[f"k{i}" for i in range(len(KINDS))])).alias("kind", "k"))
                       .filter((F.col("k") >= MIN_KNOWN) & (F.col("k") >= MIN_CONFIDENCE * F.col("n")))
                       .select("p", "kind", F.least(F.col("k") / F.col("n"), F.lit(0.999)).alias("conf")), "pii-sure")
        free = inst.join(known.select("v"), "v", "left_anti").filter(F.size("shapes") > 0).select("v", "shapes")
        score = (edges.select("v", "p").distinct().join(free, "v").join(broadcast_if_small(sure), "p").filter(F.array_contains("shapes", F.col("kind")))
                 .groupBy("v", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("conf"))))).alias("score")).filter(F.col("score") >= MIN_SCORE))
        found = written(score.groupBy("v").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b"))
                        .select("v", (-F.col("b.k")).alias("kind")), "pii-found")
        if found.isEmpty():
            return new
        new = written(new.unionByName(found), "pii-new")
        known = written(known.unionByName(found), "pii-known")


def added_spans(base: DataFrame) -> DataFrame:
    """Per key: ``added``, the spans that the method adds to the base ones."""
    occ = occurrences(base)
    new = discover(occ)
    hit = occ.filter("seed IS NULL").join(broadcast_if_small(new), "v").select("_id", "_h", "kind", "s", "e").distinct()
    before = Window.partitionBy("_id", "_h", "kind").orderBy("s", F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    hit = hit.withColumn("reach", F.max("e").over(before)).filter("reach IS NULL OR reach < e")
    return written(hit.groupBy("_id", "_h").agg(F.array_sort(F.collect_list(F.struct("kind", "s", "e"))).alias("added")), "pii-added")


def _written_out(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _of_kind(i: int, col: str) -> Column:
    return F.transform(col, lambda x: F.struct(F.lit(i).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def entities(docs: DataFrame) -> DataFrame:
    """doc_id, counts per kind, ``base_sha256`` and ``spans`` of every document."""
    base = base_entities(docs)
    added = added_spans(base)
    all_ = base.join(broadcast_if_small(added), ["_id", "_h"], "left")
    all_ = all_.withColumn("b", F.concat(*[_of_kind(i, k) for i, k in enumerate(KINDS)]))
    both = F.when(F.col("added").isNull(), F.col("b")).otherwise(F.array_sort(F.concat("b", "added")))
    return all_.select("doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
                       F.sha2(_written_out(F.col("b")), 256).alias("base_sha256"), _written_out(both).alias("spans"))


def _cuts(base: DataFrame) -> DataFrame:
    """Per key: ``_cut``, the spans that are masked by position. These are the
    added ones, and all spans of a text in which entities of different kinds
    overlap (masking one would hide the rest of the other); overlapping spans
    are united under the kind that starts first."""
    spans = F.array_sort(F.transform(F.concat(*[_of_kind(i, k) for i, k in enumerate(KINDS)]), lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    crossing = F.exists(F.zip_with("x", F.slice("x", 2, F.size("x")), lambda a, b: b["s"] < a["e"]), lambda y: y)
    over = base.select("_id", "_h", spans.alias("x")).filter(F.size("x") > 1).filter(crossing)
    both = (added_spans(base).select("_id", "_h", F.inline("added")).select("_id", "_h", "s", "e", "kind")
            .union(over.select("_id", "_h", F.inline("x"))).distinct())
    order = Window.partitionBy("_id", "_h").orderBy("s", "e", "kind")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    both = both.withColumn("opens", (F.col("s") >= F.coalesce(reach, F.lit(0))).cast("int")).withColumn("no", F.sum("opens").over(order))
    united = both.groupBy("_id", "_h", "no").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.min_by("kind", F.struct("s", "e", "kind")).alias("kind"))
    return written(united.groupBy("_id", "_h").agg(F.array_sort(F.collect_list(F.struct("s", "e", "kind"))).alias("_cut")), "pii-cuts")


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` (same columns) with every entity replaced by its kind, as in
    ``<EMAIL>``, and ``n_chars``, if there is one, counted anew. Discovered spans
    and those of overlapping kinds go first, by position; then the patterns, kind
    by kind."""
    docs, back = shield(docs, ["_id", "_h", "_cut"])
    cuts = _cuts(base_entities(docs))
    out = keyed(docs).join(broadcast_if_small(cuts), ["_id", "_h"], "left")
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    before = lambda i: F.coalesce(F.get("_cut", i - 1)["e"], F.lit(0))
    pieces = F.transform("_cut", lambda x, i: F.concat(F.substring(F.col("text"), before(i) + 1, x["s"] - before(i)), F.get(tags, x["kind"])))
    rest = F.substring(F.col("text"), before(F.size("_cut")) + 1, F.char_length("text"))
    out = out.withColumn("text", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), rest)))
    for k in KINDS:
        t = F.col("text")
        out = out.withColumn("text", F.when(_guard(k, t), _masked(k, t)).otherwise(t))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns).withColumnsRenamed(back)


def q_op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return entities(table(spark, sf_dir, "documents"))
